"""Domain-shaped inputs derived from the supplied tables.

``MARKET`` and ``NOTICES`` are lists of common table expressions in the shared SQL
subset. ``relation`` evaluates one of them in Spark; ``with_market`` and ``with_notices``
prefix an oracle with the same text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from noticelake.session import configure

AS_OF = "1998-06-01 00:00:00"
BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels",
]

MARKET = """
line AS (
  SELECT l_orderkey, l_linenumber, min(l_partkey) AS partkey, min(l_suppkey) AS suppkey, min(l_returnflag) AS flag,
         max(l_linestatus) AS line_status, CAST(sum(l_quantity) AS BIGINT) AS qty
  FROM lineitem GROUP BY l_orderkey, l_linenumber
),
sources AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, r_name AS family,
         CASE n_nationkey % 7 WHEN 0 THEN 'shwoo' WHEN 1 THEN 'judicial' WHEN 2 THEN 'pcc' WHEN 3 THEN 'moj_auction'
              WHEN 4 THEN 'moj_enforcement' WHEN 5 THEN 'customs' ELSE 'moj_enforcement_cms' END AS adapter_name
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
organizations AS (
  SELECT s_suppkey AS id,
         CASE s_nationkey % 6 WHEN 0 THEN '臺灣臺中地方法院' WHEN 1 THEN '臺灣士林地方法院' WHEN 2 THEN '臺灣橋頭地方法院'
              WHEN 3 THEN '高雄關' WHEN 4 THEN s_name ELSE '台北市動產質借處' END AS canonical_name
  FROM supplier
),
brands AS (
  SELECT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS id, upper(p_brand) AS canonical_name FROM part GROUP BY p_brand
),
models AS (
  SELECT p_partkey AS id, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_id, p_name || ' ' || p_type AS canonical_name,
         p_name AS model_code
  FROM part
),
cases AS (
  SELECT o_orderkey AS id, CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey % 100 END AS organization_id,
         CASE o_orderkey % 6 WHEN 0 THEN 'JUDICIAL_EXECUTION' WHEN 1 THEN 'PUBLIC_ASSET_DISPOSAL' WHEN 2 THEN 'SCRAP_DISPOSAL'
              WHEN 3 THEN 'CUSTOMS_FORFEITURE' WHEN 4 THEN 'IMPOUNDED_UNCLAIMED' ELSE 'ADMINISTRATIVE_ENFORCEMENT' END
           AS disposal_origin
  FROM orders
),
records AS (
  SELECT o_orderkey AS id, o_custkey % 25 AS source_id, 'REC-' || CAST(o_orderkey AS STRING) AS source_record_id,
         'https://notices.example.tw/r/' || CAST(o_orderkey AS STRING) AS official_url,
         o_orderpriority || ' 公告 ' || CAST(o_custkey AS STRING) AS original_title
  FROM orders
),
auction_events AS (
  SELECT o_orderkey AS id, o_orderkey AS case_id, o_orderkey AS record_id,
         CASE WHEN o_orderstatus = 'F' THEN
              CASE o_orderkey % 4 WHEN 0 THEN 'SOLD' WHEN 1 THEN 'UNSOLD' WHEN 2 THEN 'CANCELLED' ELSE 'EXPIRED' END
              WHEN o_orderstatus = 'P' THEN 'ANNOUNCED' ELSE 'SCHEDULED' END AS status,
         CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 5 END AS INT) AS round_number,
         CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS TIMESTAMP) AS ends_at,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS reserve_price,
         CASE WHEN o_orderkey % 3 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) + 100 END AS current_price,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) + 500 END AS sold_price,
         o_custkey % 1000 AS deposit, CAST(o_orderdate AS TIMESTAMP) AS payment_deadline,
         CAST(o_orderdate AS TIMESTAMP) AS pickup_deadline
  FROM orders
),
lots AS (
  SELECT o_orderkey AS id, o_orderkey AS event_id, '標的 ' || CAST(o_orderkey % 97 AS STRING) AS title,
         CAST(1 + o_custkey % 9 AS INT) AS lot_size, o_custkey % 9 > 0 AS bulk_lot,
         CASE o_custkey % 5 WHEN 0 THEN 'LICENSED_RECYCLER_ONLY' WHEN 1 THEN 'NATURAL_PERSON_ALLOWED' WHEN 2 THEN 'UNKNOWN'
              WHEN 3 THEN 'BUSINESS_ONLY' ELSE 'PUBLIC' END AS eligibility,
         CASE o_custkey % 7 WHEN 0 THEN '新竹縣竹北市' WHEN 1 THEN '花蓮倉庫' WHEN 2 THEN NULL ELSE '保管場' END AS storage_location,
         'MIXED' AS vehicle_type, 'UNKNOWN' AS vehicle_category, 'UNKNOWN' AS car_category,
         CASE o_orderkey % 8 WHEN 0 THEN 'SCRAP_ONLY' WHEN 1 THEN 'CANNOT_RELICENSE' WHEN 2 THEN 'UNKNOWN'
              ELSE 'NORMAL_TRANSFER' END AS registration_status,
         'UNKNOWN' AS has_key, 'UNKNOWN' AS can_start, 'UNKNOWN' AS can_test, '整批' AS condition_summary,
         CAST(o_orderkey % 101 AS INT) AS completeness
  FROM orders
),
vehicles AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS lot_id,
         CASE WHEN p_size > 40 THEN NULL ELSE CAST(replace(p_brand, 'Brand#', '') AS BIGINT) END AS brand_id,
         CASE WHEN p_size % 5 = 0 THEN partkey END AS model_id,
         CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_brand END AS original_brand,
         CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END AS original_model,
         CASE flag WHEN 'A' THEN 'MOTORCYCLE' WHEN 'N' THEN 'CAR' ELSE 'UNKNOWN' END AS vehicle_type,
         CASE WHEN flag <> 'A' THEN 'UNKNOWN' WHEN p_size % 2 = 0 THEN 'ORDINARY_HEAVY' ELSE 'LARGE_HEAVY' END AS vehicle_category,
         CASE WHEN flag <> 'N' THEN 'UNKNOWN' WHEN p_size % 2 = 0 THEN 'PASSENGER' ELSE 'TRUCK' END AS car_category,
         CAST(CASE WHEN p_size % 6 = 0 THEN NULL ELSE 1990 + p_size END AS INT) AS manufacture_year,
         CAST(CASE WHEN p_size % 4 = 0 THEN NULL ELSE 1 + p_size % 12 END AS INT) AS manufacture_month,
         CAST(CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size * 20 END AS INT) AS displacement_cc,
         CASE p_size % 3 WHEN 0 THEN '白色' WHEN 1 THEN '黑色' END AS color,
         CAST(CASE WHEN qty % 2 = 0 THEN NULL ELSE qty * 100 END AS INT) AS mileage_km,
         CASE qty % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'UNKNOWN' ELSE 'CONFLICTING' END AS has_key,
         CASE qty % 3 WHEN 0 THEN 'NO' WHEN 1 THEN 'CONFLICTING' ELSE 'UNKNOWN' END AS can_start,
         CASE qty % 2 WHEN 0 THEN 'YES' ELSE 'UNKNOWN' END AS can_test,
         CASE partkey % 9 WHEN 0 THEN 'SCRAP_ONLY' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'REGISTRABILITY_UNKNOWN'
              WHEN 3 THEN 'RE_REGISTRATION_REQUIRED' ELSE 'NORMAL_TRANSFER' END AS registration_status,
         CASE line_status WHEN 'O' THEN '車況良好' END AS condition_summary,
         CAST((partkey + l_orderkey) % 101 AS INT) AS completeness
  FROM line JOIN part ON partkey = p_partkey
),
photos AS (
  SELECT l_partkey * 1000 + l_suppkey AS id, l_orderkey * 10 + l_linenumber AS vehicle_id, CAST(NULL AS BIGINT) AS lot_id,
         l_orderkey AS record_id, CAST(l_quantity AS INT) AS sort_order,
         'https://img.example.tw/' || CAST(l_partkey AS STRING) || '/' || CAST(l_suppkey AS STRING) AS source_url,
         CASE WHEN l_linestatus = 'O' THEN 'p/' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) END AS storage_path
  FROM lineitem
  UNION ALL
  SELECT o_orderkey, NULL, o_orderkey, o_orderkey, CAST(o_custkey % 3 AS INT),
         'https://img.example.tw/lot/' || CAST(o_orderkey AS STRING),
         CASE WHEN o_orderstatus <> 'F' THEN 'lot/' || CAST(o_orderkey AS STRING) END
  FROM orders
),
identifiers AS (
  SELECT l_partkey * 1000 + l_suppkey AS id, l_orderkey * 10 + l_linenumber AS vehicle_id,
         CASE WHEN l_linestatus = 'O' THEN 'PLATE' WHEN l_returnflag = 'R' THEN 'FRAME' ELSE 'ENGINE' END AS identifier_type,
         'AB' || CAST(10000 + (l_partkey * 7 + l_suppkey) % 90000 AS STRING) AS normalized_value
  FROM lineitem
)"""

NOTICES = """
notice_keys AS (
  SELECT o_orderkey AS notice_id, o_orderkey % 12 AS kind, o_custkey % 6 AS cond, o_custkey % 5 AS reg, o_custkey % 4 AS elig,
         o_custkey % 8 AS place, 1 + o_orderkey % 4 AS n, CAST(floor(o_totalprice) AS BIGINT) AS price, o_custkey AS who,
         CAST(o_orderdate AS TIMESTAMP) AS day, o_orderkey % 24 AS hour24, o_custkey % 60 AS minute60, o_orderstatus AS state
  FROM orders
),
notices AS (
  SELECT *,
    CASE kind WHEN 0 THEN '普通輕型機車' WHEN 1 THEN '普通重型機車' WHEN 2 THEN '大型重型機車' WHEN 3 THEN '大型重機'
      WHEN 4 THEN '電動機車' WHEN 5 THEN '重型機車' WHEN 6 THEN '機車' WHEN 7 THEN '自用小客車' WHEN 8 THEN '小貨車'
      WHEN 9 THEN '休旅車' WHEN 10 THEN '汽、機車' ELSE '辦公桌椅' END AS noun,
    CASE cond WHEN 0 THEN '有鑰匙，可發動，可測試' WHEN 1 THEN '無鑰匙，無法發動，無法測試' WHEN 2 THEN '有鑰匙；現場註記無鑰匙'
      WHEN 3 THEN '目前不能發動，不可測試' WHEN 4 THEN '可發動；另一份紀錄載明無法發動；提供靜態測試' ELSE '車況如照片' END AS cond_text,
    CASE reg WHEN 0 THEN '已繳銷，可再領牌' WHEN 1 THEN '不可再領牌' WHEN 2 THEN '得辦理移轉過戶' WHEN 3 THEN '應重新領牌'
      ELSE '牌照狀態詳公告' END AS reg_text,
    CASE elig WHEN 0 THEN '限合格回收商投標' WHEN 1 THEN '投標人應備國民身分證' WHEN 2 THEN '須檢附公司或商業登記證明' ELSE '' END AS elig_text,
    CASE place WHEN 0 THEN '臺灣臺中地方法院' WHEN 1 THEN '新竹縣竹北市 臺灣新竹地方法院' WHEN 2 THEN '台北市中山區' WHEN 3 THEN '臺灣士林地方法院'
      WHEN 4 THEN '臺灣橋頭地方法院' WHEN 5 THEN '高雄港務倉庫' WHEN 6 THEN '中央保管場' ELSE '花蓮縣吉安鄉' END AS place_text,
    'TST-' || CAST(1000 + who % 9000 AS STRING) AS plate,
    CAST(year(day) - 1911 AS STRING) || '/' || lpad(CAST(month(day) AS STRING), 2, '0') || '/' || lpad(CAST(day(day) AS STRING), 2, '0')
      AS slash_date,
    CAST(year(day) - 1911 AS STRING) || '年' || CAST(month(day) AS STRING) || '月' || CAST(day(day) AS STRING) || '日'
      || CASE WHEN hour24 < 12 THEN '上午' ELSE '下午' END
      || CAST(CASE WHEN hour24 > 12 THEN hour24 - 12 ELSE hour24 END AS STRING) || '時' || CAST(minute60 AS STRING) || '分' AS worded_date,
    CAST(CAST(floor(price / 10000) AS BIGINT) AS STRING) || '萬' || CAST(price % 10000 AS STRING) || '元' AS amount_text
  FROM notice_keys
)"""


_REGISTERED: dict[tuple[str, str], str] = {}


def base_views(spark: SparkSession, sf_dir: str) -> str:
    """Temporary views of the supplied tables, made once per session; returns their prefix."""
    key = (spark._jsparkSession.sessionUUID(), sf_dir)
    if key not in _REGISTERED:
        prefix = f"supplied_{len(_REGISTERED)}_"
        for name in BASE_TABLES:
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(prefix + name)
        _REGISTERED[key] = prefix
    return _REGISTERED[key]


def needed(definitions: dict[str, str], text: str) -> list[str]:
    """Names of the definitions a statement uses, directly or through others, in order."""
    wanted: set[str] = set()
    frontier = [text]
    while frontier:
        words = set(re.findall(r"\w+", frontier.pop()))
        for name in (words & definitions.keys()) - wanted:
            wanted.add(name)
            frontier.append(definitions[name])
    return [n for n in definitions if n in wanted]


def definitions_of(ctes: str) -> dict[str, str]:
    parts = re.split(r",\n(?=\w+ AS \()", ctes.strip()) if ctes else []
    return {p.split(" ", 1)[0]: p for p in parts}


def spark_sql(spark: SparkSession, sf_dir: str, ctes: str, select: str) -> DataFrame:
    """Evaluate a statement over the supplied tables and the definitions it needs."""
    configure(spark)
    prefix = base_views(spark, sf_dir)
    own = definitions_of(ctes)
    supplied = {n: f"{n} AS (SELECT * FROM {prefix}{n})" for n in BASE_TABLES}
    used = needed({**supplied, **own}, select)
    body = ",\n".join({**supplied, **own}[n] for n in used)
    return spark.sql(f"WITH {body}\n{select}")


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.table(base_views(spark, sf_dir) + name)


def market(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The marketplace tables as frames."""
    names = ["sources", "organizations", "brands", "models", "cases", "records", "lots", "vehicles", "photos", "identifiers"]
    frames = {n: spark_sql(spark, sf_dir, MARKET, f"SELECT * FROM {n}") for n in names}
    frames["events"] = spark_sql(spark, sf_dir, MARKET, "SELECT * FROM auction_events")
    frames["lots"] = spark_sql(spark, sf_dir, MARKET, "SELECT *, array(title) AS fee_notes FROM lots")
    return frames


def notices(spark: SparkSession, sf_dir: str, select: str = "SELECT * FROM notices") -> DataFrame:
    return spark_sql(spark, sf_dir, NOTICES, select)


def spread_notices(spark: SparkSession, sf_dir: str, select: str) -> DataFrame:
    """The same over more tasks. Reading pages is CPU work, for which the small supplied files would give too few; keys are dealt, not pages."""
    keys = notices(spark, sf_dir, "SELECT * FROM notice_keys").repartition(spark.sparkContext.defaultParallelism, "notice_id")
    view = f"{base_views(spark, sf_dir)}notice_keys"
    keys.createOrReplaceTempView(view)
    made = definitions_of(NOTICES)["notices"]
    return spark.sql(f"WITH {made.replace('FROM notice_keys', f'FROM {view}')}\n{select}")


def with_market(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([MARKET, *more]) + "\n" + select


def with_notices(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([NOTICES, *more]) + "\n" + select
