"""Listing view, filters, paging and display over the marketplace tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.functions.classify import displacement_band
from noticelake.operators import listing, paging, presentation, read_model
from noticelake.operators.filters import PRESETS, Filters, apply_filters, keyword_matches_loosely, showcase
from noticelake.operators.query_params import normalize_queries
from noticelake.session import shared_dir, stored

from .derive import AS_OF, base, market, spark_sql, with_market
from .registry import Registry

c = F.col


def stamp(name: str):
    return F.date_format(c(name).cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias(name)


SHOWN = [
    "id", "vehicle_id", "listing_entity", "source_adapter", "source_auid", "official_title", "model_name", "brand_name",
    "manufacture_year", "displacement_cc", "vehicle_type", "vehicle_category", "car_category", "color", "mileage_km",
    "organization_name", "storage_location", "disposal_origin", "auction_status", "round_number", "reserve_price",
    "eligibility", "registration_status", "has_key", "can_start", "lot_size", "bulk_lot", "completeness",
    "primary_image_url", "plate_number", "county", "display_price", "has_cached_photo", "search_text",
]


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.listing_view(market(spark, sf_dir))


# The listing written with window functions and correlated existence, independently of
# the operator.
COUNTY_CASE = """
  CASE WHEN regexp_matches(txt, '新竹縣') THEN '新竹縣' WHEN regexp_matches(txt, '臺北市') THEN '臺北市'
       WHEN txt LIKE '%士林%' THEN '臺北市' WHEN txt LIKE '%橋頭%' THEN '高雄市' WHEN txt LIKE '%臺中%' THEN '臺中市'
       WHEN txt LIKE '%高雄%' THEN '高雄市' WHEN txt LIKE '%花蓮%' THEN '花蓮縣' END"""

ORACLE_LISTING = f"""
ctx AS (
  SELECT lots.*, s.adapter_name AS source_adapter, r.source_record_id AS source_auid, r.original_title AS official_title,
         o.canonical_name AS organization_name, k.disposal_origin, e.status AS auction_status, e.round_number, e.ends_at,
         e.reserve_price, e.current_price, e.sold_price,
         replace(concat_ws(' ', lots.storage_location, o.canonical_name), '台', '臺') AS txt
  FROM lots JOIN auction_events e ON e.id = lots.event_id JOIN cases k ON k.id = e.case_id
  JOIN records r ON r.id = e.record_id JOIN sources s ON s.id = r.source_id LEFT JOIN organizations o ON o.id = k.organization_id
),
vp AS (
  SELECT * FROM (SELECT vehicle_id, source_url, row_number() OVER (PARTITION BY vehicle_id ORDER BY sort_order, id) AS rn
                 FROM photos WHERE storage_path IS NOT NULL AND vehicle_id IS NOT NULL) x WHERE rn = 1
),
lp AS (
  SELECT * FROM (SELECT lot_id, source_url, row_number() OVER (PARTITION BY lot_id ORDER BY sort_order, id) AS rn
                 FROM photos WHERE storage_path IS NOT NULL AND lot_id IS NOT NULL) x WHERE rn = 1
),
pl AS (
  SELECT vehicle_id, arg_min(normalized_value, id) AS plate FROM identifiers WHERE identifier_type = 'PLATE' GROUP BY vehicle_id
),
raw_rows AS (
  SELECT v.id, v.id AS vehicle_id, 'vehicle' AS listing_entity, x.source_adapter, x.source_auid, x.official_title,
         coalesce(m.canonical_name, v.original_model, x.title) AS model_name, coalesce(b.canonical_name, v.original_brand) AS brand_name,
         v.manufacture_year, v.manufacture_month, v.displacement_cc, v.vehicle_type, v.vehicle_category, v.car_category, v.color,
         v.mileage_km, x.organization_name, x.storage_location, x.disposal_origin, x.auction_status, x.round_number, x.ends_at,
         x.reserve_price, x.current_price, x.sold_price, x.eligibility, v.registration_status, v.has_key, v.can_start, v.can_test,
         x.lot_size, x.bulk_lot, v.completeness, vp.source_url AS primary_image_url, pl.plate AS plate_number, x.txt
  FROM vehicles v JOIN ctx x ON x.id = v.lot_id LEFT JOIN brands b ON b.id = v.brand_id LEFT JOIN models m ON m.id = v.model_id
  LEFT JOIN vp ON vp.vehicle_id = v.id LEFT JOIN pl ON pl.vehicle_id = v.id
  UNION ALL
  SELECT x.id, NULL, 'lot', x.source_adapter, x.source_auid, x.official_title, x.title, NULL, NULL, NULL, NULL, x.vehicle_type,
         x.vehicle_category, x.car_category, NULL, NULL, x.organization_name, x.storage_location, x.disposal_origin,
         x.auction_status, x.round_number, x.ends_at, x.reserve_price, x.current_price, x.sold_price, x.eligibility,
         x.registration_status, x.has_key, x.can_start, x.can_test, x.lot_size, x.bulk_lot, x.completeness, lp.source_url, NULL, x.txt
  FROM ctx x LEFT JOIN lp ON lp.lot_id = x.id WHERE NOT EXISTS (SELECT 1 FROM vehicles v WHERE v.lot_id = x.id)
),
listing AS (
  SELECT *, {COUNTY_CASE} AS county, coalesce(sold_price, current_price, reserve_price) AS display_price,
         primary_image_url IS NOT NULL AS has_cached_photo,
         lower(concat_ws(' ', official_title, brand_name, model_name, plate_number, organization_name, storage_location, source_auid,
                         vehicle_type, vehicle_category, car_category)) AS search_text,
         disposal_origin = 'SCRAP_DISPOSAL' OR registration_status IN ('SCRAP_ONLY', 'CANNOT_RELICENSE')
           OR eligibility = 'LICENSED_RECYCLER_ONLY' AS scrap,
         auction_status IN ('SOLD', 'UNSOLD', 'WITHDRAWN', 'CANCELLED', 'EXPIRED')
           OR coalesce(ends_at < TIMESTAMP '{AS_OF}', false) AS ended
  FROM raw_rows
)"""
BRIEF = "id, listing_entity, display_price, completeness, strftime(ends_at, '%Y-%m-%d %H:%M:%S') AS auction_at"


def brief(df: DataFrame) -> DataFrame:
    return df.select("id", "listing_entity", "display_price", "completeness", stamp("auction_at"))


def listed(select: str, *more: str) -> str:
    return with_market(select, ORACLE_LISTING, *more)


query = Registry()


@query("listing_view", listed(f"SELECT {', '.join(SHOWN)} FROM listing"))
def listing_rows(spark, sf_dir):
    return view(spark, sf_dir).select(*SHOWN)


@query("listing_first_version", listed(
    "SELECT id, model_name, brand_name, organization_name, auction_status, plate_number, strftime(ends_at, '%Y-%m-%d %H:%M:%S') "
    "AS auction_at FROM listing WHERE listing_entity = 'vehicle'"))
def first_version(spark, sf_dir):
    return listing.first_version_view(market(spark, sf_dir)).select(
        "id", "model_name", "brand_name", "organization_name", "auction_status", "plate_number", stamp("auction_at"))


@query("listing_lots_without_vehicles", listed("SELECT id, model_name, county, has_cached_photo FROM listing WHERE listing_entity = 'lot'"))
def lot_listing(spark, sf_dir):
    t = market(spark, sf_dir)
    return listing.lot_rows(t).select("id", "model_name", "county", "has_cached_photo")


FLAGSHIP = Filters(market_view="active", vehicle_type="CAR", min_price=50_000, max_price=400_000)


@query("listing_active_page", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND NOT ended AND vehicle_type = 'CAR' AND display_price BETWEEN 50000 AND 400000 "
    "ORDER BY ends_at ASC NULLS LAST, id LIMIT 25"))
def active_page(spark, sf_dir):
    return brief(paging.page_rows(apply_filters(view(spark, sf_dir), FLAGSHIP, AS_OF), "auction_asc", 24))


_MODELS: dict[tuple[str, str], str] = {}


def model(spark: SparkSession, sf_dir: str) -> str:
    """The read model, built once per session from a listing of which every fifth row was another one, and refreshed since."""
    key = (spark._jsparkSession.sessionUUID(), sf_dir)
    if key not in _MODELS:
        path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
        rows, fifth = stored(view(spark, sf_dir)), c("id") % 5 == 0
        stale = rows.filter(~fifth | (c("id") % 10 == 0)).withColumns({
            "display_price": F.when(fifth, c("display_price") + 90_000).otherwise(c("display_price")), "completeness": F.when(fifth, F.lit(1)).otherwise(c("completeness")),
            "auction_at": F.when(fifth, F.lit(None)).otherwise(c("auction_at")), "search_text": F.when(fifth, F.lit("brand#1 stale")).otherwise(c("search_text")),
            "vehicle_type": F.when(fifth, F.lit("CAR")).otherwise(c("vehicle_type"))}).select(rows.columns)
        read_model.write_model(spark, stale.union(rows.filter("id % 10 = 3").withColumn("id", -c("id")).select(rows.columns)), path)
        read_model.refresh(spark, rows.filter(fifth), path, removed=rows.filter("id % 10 = 3").select((-c("id")).alias("id")), keep=1)
        _MODELS[key] = path
    return _MODELS[key]


@query("listing_model_page", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND NOT ended AND vehicle_type = 'CAR' AND display_price BETWEEN 50000 AND 400000 "
    "ORDER BY ends_at ASC NULLS LAST, id LIMIT 25"))
def model_page(spark, sf_dir):
    return brief(read_model.page_rows(spark, model(spark, sf_dir), FLAGSHIP, AS_OF, "auction_asc", 24))


@query("listing_model_keyset", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND (display_price < 300000 OR (display_price = 300000 AND id > 100) OR display_price IS NULL) "
    "ORDER BY display_price DESC NULLS LAST, id LIMIT 101"))
def model_keyset(spark, sf_dir):
    cursor = paging.encode_cursor("price_desc", 300_000, 100)
    return brief(read_model.page_rows(spark, model(spark, sf_dir), Filters(market_view="all"), AS_OF, "price_desc", 100, cursor))


@query("listing_model_counts", listed("""
SELECT 'active' AS view, count(*)::BIGINT AS total FROM listing WHERE NOT scrap AND NOT ended
UNION ALL SELECT 'ended', count(*) FROM listing WHERE NOT scrap AND ended UNION ALL SELECT 'scrap', count(*) FROM listing WHERE scrap
UNION ALL SELECT 'cars', count(*) FROM listing WHERE NOT scrap AND vehicle_type = 'CAR'
UNION ALL SELECT 'priced', count(*) FROM listing WHERE NOT scrap AND NOT ended AND vehicle_type = 'CAR' AND display_price BETWEEN 50000 AND 400000"""))
def model_counts(spark, sf_dir):
    path = model(spark, sf_dir)
    asked = {"active": Filters(), "ended": Filters(market_view="ended"), "scrap": Filters(market_view="scrap"),
             "cars": Filters(market_view="all", vehicle_type="CAR"), "priced": FLAGSHIP}
    counted = [read_model.count(spark, path, f, AS_OF).select(F.lit(name).alias("view"), "total") for name, f in asked.items()]
    return reduce(DataFrame.union, counted)


@query("listing_model_keyword", listed(f"SELECT {BRIEF} FROM listing WHERE contains(search_text, 'brand#1')"))
def model_keyword(spark, sf_dir):
    return brief(read_model.keyword_rows(spark, model(spark, sf_dir), " Brand#1 "))


@query("listing_model_keyword_loose", listed(
    "SELECT id, listing_entity, display_price, completeness, strftime(ends_at, '%Y-%m-%d %H:%M:%S') AS auction_at FROM listing "
    "WHERE contains(regexp_replace(lower(concat_ws(' ', concat_ws(' ', brand_name, model_name), brand_name, model_name, plate_number, "
    "official_title, organization_name, storage_location)), '\\s', '', 'g'), '公告1')"))
def model_keyword_loose(spark, sf_dir):
    return brief(read_model.keyword_rows(spark, model(spark, sf_dir), "公 告 1", loose=True))


# Keyset pages: the position is a row of the full order that exists at every scale.
KEYSET_AFTER = {"price_desc": ("display_price", 300_000), "price_asc": ("display_price", 120_000)}


def keyset_oracle(sort: str) -> str:
    column, mark = KEYSET_AFTER[sort]
    sign, way = ("<", "DESC") if sort.endswith("desc") else (">", "ASC")
    return listed(
        f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND ({column} {sign} {mark} OR ({column} = {mark} AND id > 100) OR {column} IS NULL) "
        f"ORDER BY {column} {way} NULLS LAST, id LIMIT 101")


def keyset(sort: str):
    def run(spark, sf_dir):
        rows = apply_filters(view(spark, sf_dir), Filters(market_view="all"), AS_OF)
        cursor = paging.encode_cursor(sort, KEYSET_AFTER[sort][1], 100)
        return brief(paging.page_rows(rows, sort, 100, cursor))

    return run


for _sort in KEYSET_AFTER:
    query(f"listing_{_sort}_keyset", keyset_oracle(_sort))(keyset(_sort))


@query("listing_null_value_keyset", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND ends_at IS NULL AND id > 1000 ORDER BY id LIMIT 101"))
def null_keyset(spark, sf_dir):
    rows = apply_filters(view(spark, sf_dir), Filters(market_view="all"), AS_OF)
    return brief(paging.page_rows(rows, "auction_desc", 100, paging.encode_cursor("auction_desc", None, 1000)))


@query("listing_completeness_page", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap ORDER BY completeness DESC NULLS LAST, id LIMIT 101"))
def completeness_page(spark, sf_dir):
    rows = apply_filters(view(spark, sf_dir), Filters(market_view="all"), AS_OF)
    return brief(paging.page_rows(rows, "completeness_desc", 100))


@query("listing_full_order", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND ended ORDER BY ends_at DESC NULLS LAST, id"))
def full_order(spark, sf_dir):
    return brief(paging.sort_listing(apply_filters(view(spark, sf_dir), Filters(market_view="ended"), AS_OF), "auction_desc"))


for _view, _where in {"scrap": "scrap", "ended": "NOT scrap AND ended", "active": "NOT scrap AND NOT ended", "all": "NOT scrap"}.items():
    def _run(spark, sf_dir, v=_view):
        return brief(apply_filters(view(spark, sf_dir), Filters(market_view=v), AS_OF))

    query(f"listing_{_view}", listed(f"SELECT {BRIEF} FROM listing WHERE {_where}"))(_run)


@query("listing_favorites", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND id IN (SELECT user_id * 10 + 1 FROM events WHERE event_type = 'purchase')"))
def favorites(spark, sf_dir):
    saved = base(spark, sf_dir, "events").filter(c("event_type") == "purchase").select((c("user_id") * 10 + 1).alias("id"))
    return brief(apply_filters(view(spark, sf_dir), Filters(market_view="favorites"), AS_OF, saved))


@query("listing_favorites_none", listed(f"SELECT {BRIEF} FROM listing WHERE false"))
def no_favorites(spark, sf_dir):
    return brief(apply_filters(view(spark, sf_dir), Filters(market_view="favorites"), AS_OF))


@query("listing_count", listed(
    "SELECT count(*) AS total FROM listing WHERE NOT scrap AND NOT ended AND vehicle_type = 'CAR' AND display_price BETWEEN 50000 AND 400000"))
def total(spark, sf_dir):
    return paging.count(apply_filters(view(spark, sf_dir), FLAGSHIP, AS_OF))


@query("keyword_search", listed(f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND contains(search_text, 'brand#1')"))
def keyword(spark, sf_dir):
    return brief(apply_filters(view(spark, sf_dir), Filters(market_view="all", keyword=" Brand#1 "), AS_OF))


@query("keyword_search_loose", listed(
    "SELECT id, listing_entity, display_price, completeness, strftime(ends_at, '%Y-%m-%d %H:%M:%S') AS auction_at FROM listing "
    "WHERE contains(regexp_replace(lower(concat_ws(' ', concat_ws(' ', brand_name, model_name), brand_name, model_name, plate_number, "
    "official_title, organization_name, storage_location)), '\\s', '', 'g'), '公告1')"))
def loose_keyword(spark, sf_dir):
    named = view(spark, sf_dir).withColumn("name", F.concat_ws(" ", "brand_name", "model_name"))
    return brief(named.filter(keyword_matches_loosely("公 告 1")))


@query("listing_equality_filters", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND source_adapter = 'pcc' AND disposal_origin = 'JUDICIAL_EXECUTION' "
    "AND eligibility = 'PUBLIC' AND registration_status = 'NORMAL_TRANSFER'"))
def equality(spark, sf_dir):
    f = Filters(market_view="all", source="pcc", disposal_origin="JUDICIAL_EXECUTION", eligibility="PUBLIC", registration="NORMAL_TRANSFER")
    return brief(apply_filters(view(spark, sf_dir), f, AS_OF))


@query("listing_brand_county_filters", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND brand_name = 'BRAND#12' AND county = '新竹縣' AND vehicle_type = 'MOTORCYCLE' "
    "AND vehicle_category = 'LARGE_HEAVY'"))
def brand_county(spark, sf_dir):
    f = Filters(market_view="all", brand="BRAND#12", county="新竹縣", vehicle_type="MOTORCYCLE", vehicle_class="LARGE_HEAVY")
    return brief(apply_filters(view(spark, sf_dir), f, AS_OF))


@query("listing_band_filter", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND (displacement_cc BETWEEN 126 AND 150 OR displacement_cc > 550 OR displacement_cc IS NULL)"))
def band_filter(spark, sf_dir):
    f = Filters(market_view="all", displacement_bands=["CC_126_150", "GT_550", "UNKNOWN"])
    return brief(apply_filters(view(spark, sf_dir), f, AS_OF))


@query("listing_photo_single", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND NOT ended AND NOT bulk_lot AND has_cached_photo"))
def photo_single(spark, sf_dir):
    return brief(apply_filters(view(spark, sf_dir), Filters(**PRESETS["photo_single"]), AS_OF))


@query("listing_preset_public", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND NOT ended AND eligibility = 'NATURAL_PERSON_ALLOWED'"))
def preset_public(spark, sf_dir):
    return brief(apply_filters(view(spark, sf_dir), Filters(**PRESETS["public_bidding"]), AS_OF))


@query("listing_within_week", listed(
    f"SELECT {BRIEF} FROM listing WHERE NOT scrap AND NOT ended AND ends_at BETWEEN TIMESTAMP '{AS_OF}' AND TIMESTAMP '{AS_OF}' + INTERVAL 7 DAY"))
def within_week(spark, sf_dir):
    return brief(apply_filters(view(spark, sf_dir), Filters(**PRESETS["within_week"]), AS_OF))


@query("listing_showcase", listed(
    f"SELECT {BRIEF} FROM listing WHERE ends_at >= TIMESTAMP '{AS_OF}' AND ends_at <= TIMESTAMP '{AS_OF}' + INTERVAL 30 DAY "
    "AND vehicle_category = 'ORDINARY_HEAVY' AND displacement_cc BETWEEN 251 AND 550"))
def showcase_list(spark, sf_dir):
    return brief(showcase(view(spark, sf_dir), "active", AS_OF, 30, "ORDINARY_HEAVY", ["CC_251_550"]))


@query("displacement_bands", """
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'UNKNOWN' WHEN p_size * 20 <= 125 THEN 'LE_125' WHEN p_size * 20 <= 150 THEN 'CC_126_150'
  WHEN p_size * 20 <= 250 THEN 'CC_151_250' WHEN p_size * 20 <= 550 THEN 'CC_251_550' ELSE 'GT_550' END AS band FROM part""")
def bands(spark, sf_dir):
    parts = spark_sql(spark, sf_dir, "", "SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size * 20 END AS cc FROM part")
    return parts.select("p_partkey", displacement_band(c("cc")).alias("band"))


@query("risk_badges", listed("""
SELECT id, listing_entity, concat_ws(',', CASE WHEN eligibility = 'LICENSED_RECYCLER_ONLY' THEN '限合格回收商' END,
  CASE WHEN eligibility = 'UNKNOWN' THEN '投標資格未確認' END,
  CASE WHEN registration_status IN ('SCRAP_ONLY', 'CANNOT_RELICENSE') THEN '不得領牌上路' END,
  CASE WHEN registration_status IN ('UNKNOWN', 'REGISTRABILITY_UNKNOWN') THEN '牌照狀態未確認' END,
  CASE WHEN can_start = 'NO' THEN '目前無法發動' END, CASE WHEN can_start = 'CONFLICTING' THEN '發動資訊衝突' END,
  CASE WHEN bulk_lot THEN '整批 ' || lot_size || ' 臺' END) AS badges FROM listing"""))
def badges(spark, sf_dir):
    return view(spark, sf_dir).select("id", "listing_entity", F.array_join(presentation.risk_badges(), ",").alias("badges"))


STATE = "CASE {0} WHEN 'YES' THEN '是' WHEN 'NO' THEN '否' WHEN 'UNKNOWN' THEN '未確認' ELSE '資料衝突' END"


@query("quick_summary", listed(f"""
SELECT id, listing_entity, concat_ws('｜', CASE WHEN eligibility = 'LICENSED_RECYCLER_ONLY' THEN '限合格回收商'
    WHEN eligibility IN ('PUBLIC', 'NATURAL_PERSON_ALLOWED') THEN '一般民眾可投標' ELSE '投標資格未確認' END,
  CASE WHEN coalesce(round_number, 0) <> 0 THEN '第' || round_number || '拍' ELSE '拍次未確認' END,
  coalesce('NT$ ' || format('{{:,}}', coalesce(current_price, reserve_price)), '價格未公開'), coalesce(county, storage_location, '地點未確認'),
  '有鑰匙：' || {STATE.format('has_key')}, '可發動：' || {STATE.format('can_start')}, '可測試：' || {STATE.format('can_test')}) AS summary
FROM listing"""))
def summary(spark, sf_dir):
    return view(spark, sf_dir).select("id", "listing_entity", presentation.quick_summary().alias("summary"))


@query("timeline", listed(f"""
SELECT id, listing_entity, CASE WHEN ended AND auction_status = 'SOLD' THEN '已成交' WHEN ended THEN '已截止／結果待確認'
    WHEN ends_at IS NULL THEN '截止時間未確認' WHEN days <= 0 THEN '今天截止' WHEN days = 1 THEN '明天截止' ELSE days || ' 天後截止' END AS timeline_label,
  CASE WHEN ended THEN 'ended' WHEN ends_at IS NULL THEN 'unknown' WHEN days <= 1 THEN 'critical' WHEN days <= 7 THEN 'soon' ELSE 'normal' END AS urgency,
  CASE WHEN sold_price IS NOT NULL THEN '成交價' WHEN current_price IS NOT NULL THEN '目前出價' ELSE '公告底價' END AS price_label
FROM (SELECT *, CAST(ceil(epoch(ends_at - TIMESTAMP '{AS_OF}') / 86400) AS INTEGER) AS days FROM listing) x"""))
def timeline(spark, sf_dir):
    parts = presentation.timeline(AS_OF)
    return view(spark, sf_dir).select(
        "id", "listing_entity", *[e.alias(n) for n, e in parts.items()], presentation.price_label().alias("price_label"))


@query("display_rows", listed("""
SELECT id, listing_entity, coalesce(nullif(concat_ws(' ', brand_name, model_name), ''), official_title) AS name,
  coalesce(organization_name, '未辨識機關') AS organization_name, CASE WHEN source_adapter = 'judicial' THEN 'DATE' ELSE 'DATETIME' END AS date_precision,
  coalesce('NT$ ' || format('{:,}', display_price), '價格未公開') AS price_text,
  CASE WHEN manufacture_year IS NULL THEN '未確認' ELSE manufacture_year || ' 年' || CASE WHEN manufacture_month IS NULL THEN '（月份未確認）'
    ELSE ' ' || manufacture_month || ' 月' END END AS manufacture_label,
  concat_ws(',', CASE WHEN vehicle_category = 'UNKNOWN' THEN '機車級別' END, CASE WHEN brand_name IS NULL THEN '廠牌' END,
    CASE WHEN model_name IS NULL THEN '型號' END, CASE WHEN manufacture_year IS NULL THEN '出廠年月' END, CASE WHEN mileage_km IS NULL THEN '里程' END,
    CASE WHEN has_key = 'UNKNOWN' THEN '鑰匙' END, CASE WHEN can_start = 'UNKNOWN' THEN '能否發動' END, CASE WHEN can_test = 'UNKNOWN' THEN '能否測試' END,
    CASE WHEN registration_status IN ('UNKNOWN', 'REGISTRABILITY_UNKNOWN') THEN '可否領牌' END,
    CASE WHEN eligibility = 'UNKNOWN' THEN '投標資格' END) AS missing
FROM listing"""))
def display(spark, sf_dir):
    return presentation.display_rows(view(spark, sf_dir), AS_OF).select(
        "id", "listing_entity", "name", "organization_name", "date_precision", "price_text", "manufacture_label",
        F.array_join("missing_facts", ",").alias("missing"))


@query("enum_labels", listed("""
SELECT id, listing_entity, CASE eligibility WHEN 'PUBLIC' THEN '公開投標' WHEN 'NATURAL_PERSON_ALLOWED' THEN '一般民眾可投標'
    WHEN 'BUSINESS_ONLY' THEN '限公司／商號' WHEN 'LICENSED_RECYCLER_ONLY' THEN '限合格回收商' ELSE '資格未確認' END AS eligibility_label,
  CASE registration_status WHEN 'NORMAL_TRANSFER' THEN '可正常過戶' WHEN 'RE_REGISTRATION_REQUIRED' THEN '需重新領牌'
    WHEN 'REGISTRABILITY_UNKNOWN' THEN '可否領牌未確認' WHEN 'CANNOT_RELICENSE' THEN '不得重新領牌' WHEN 'SCRAP_ONLY' THEN '僅供報廢'
    ELSE '牌照狀態未確認' END AS registration_label,
  CASE disposal_origin WHEN 'JUDICIAL_EXECUTION' THEN '司法強制執行法拍' WHEN 'ADMINISTRATIVE_ENFORCEMENT' THEN '行政執行拍賣'
    WHEN 'IMPOUNDED_UNCLAIMED' THEN '移置保管逾期未領' WHEN 'PUBLIC_ASSET_DISPOSAL' THEN '公有財產變賣'
    WHEN 'CUSTOMS_FORFEITURE' THEN '海關沒入／拍賣' ELSE '公務報廢財物' END AS origin_label
FROM listing"""))
def labels(spark, sf_dir):
    p = presentation
    return view(spark, sf_dir).select(
        "id", "listing_entity", p.label(c("eligibility"), p.ELIGIBILITY_LABELS).alias("eligibility_label"),
        p.label(c("registration_status"), p.REGISTRATION_LABELS).alias("registration_label"),
        p.label(c("disposal_origin"), p.ORIGIN_LABELS).alias("origin_label"))


@query("listing_photos", with_market("""
SELECT coalesce(vehicle_id, lot_id) AS listing_id, CASE WHEN vehicle_id IS NULL THEN 'lot' ELSE 'vehicle' END AS listing_entity, storage_path AS photo_path,
  min(sort_order) AS sort_order FROM photos WHERE storage_path IS NOT NULL GROUP BY 1, 2, 3"""))
def photo_list(spark, sf_dir):
    return listing.listing_photos(market(spark, sf_dir)["photos"])


# Query strings built from events: every parameter, valid and invalid, in several mixes.
REQUESTS = """
requests AS (
  SELECT event_id, 'view=' || CASE user_id % 4 WHEN 0 THEN 'ended' WHEN 1 THEN 'bogus' WHEN 2 THEN 'all' ELSE 'active' END
    || CASE event_id % 5 WHEN 0 THEN '&cc=le-125,126-150' WHEN 1 THEN '&carCategory=SUV&cc=gt-550' WHEN 2 THEN '&vehicleType=CAR'
       WHEN 3 THEN '&vehicleClass=LARGE_HEAVY&cc=nope' ELSE '&vehicleType=MIXED&cc=unknown' END
    || '&price=' || CAST(user_id * 100 AS STRING) || '-' || CASE WHEN event_id % 3 = 0 THEN '' ELSE CAST(user_id * 100 + 5000 AS STRING) END
    || '&within=' || CAST(event_id % 400 AS STRING) || '&limit=' || CAST(event_id % 130 AS STRING)
    || CASE event_type WHEN 'view' THEN '&keyword=%E6%A9%9F%E8%BB%8A+abc' WHEN 'click' THEN '&hasPhotos=true&sort=price_desc'
       WHEN 'error' THEN '&source=pcc&county=%E8%87%BA%E5%8C%97%E5%B8%82' ELSE '&excludeScrap=true&source=zzz' END AS query,
    user_id, event_type, event_id % 5 AS mix
  FROM events
)"""


@query("query_params", "WITH " + REQUESTS + """
SELECT event_id, view, mvt AS "vehicleType", mvc AS "vehicleClass", mcc AS "carCategory", bands, within, lim AS "limit", keyword, src AS source, county, sort,
  min_price, max_price,
  concat_ws('&', 'view=' || view, CASE WHEN event_type = 'view' THEN 'keyword=%E6%A9%9F%E8%BB%8A+abc' END,
    CASE WHEN event_type = 'error' THEN 'county=%E8%87%BA%E5%8C%97%E5%B8%82' END, CASE WHEN event_type = 'error' THEN 'source=pcc' END,
    'vehicleClass=' || mvc, 'vehicleType=' || mvt, 'carCategory=' || mcc,
    CASE mix WHEN 0 THEN 'cc=le-125&cc=126-150' WHEN 4 THEN 'cc=unknown' END,
    'price=' || CAST(min_price AS BIGINT) || '-' || coalesce(CAST(CAST(max_price AS BIGINT) AS VARCHAR), ''),
    CASE WHEN event_type = 'click' THEN 'hasPhotos=true' END, CASE WHEN event_type IN ('signup', 'purchase') THEN 'excludeScrap=true' END,
    'within=' || CAST(within AS BIGINT), CASE WHEN event_type = 'click' THEN 'sort=price_desc' END) AS canonical_query
FROM (SELECT event_id, event_type, mix,
  CASE user_id % 4 WHEN 0 THEN 'ended' WHEN 2 THEN 'all' ELSE 'active' END AS view,
  CASE mix WHEN 1 THEN 'CAR' WHEN 2 THEN 'CAR' ELSE 'MOTORCYCLE' END AS mvt, CASE mix WHEN 3 THEN 'LARGE_HEAVY' END AS mvc, CASE mix WHEN 1 THEN 'SUV' END AS mcc,
  CASE mix WHEN 0 THEN 'LE_125,CC_126_150' WHEN 4 THEN 'UNKNOWN' ELSE '' END AS bands,
  CASE WHEN user_id % 4 <> 0 AND event_id % 400 BETWEEN 1 AND 365 THEN CAST(event_id % 400 AS DOUBLE) END AS within,
  CAST(CASE WHEN event_id % 130 = 0 THEN 24 WHEN event_id % 130 > 100 THEN 100 ELSE event_id % 130 END AS INTEGER) AS lim,
  CASE WHEN event_type = 'view' THEN '機車 abc' END AS keyword, CASE WHEN event_type = 'error' THEN 'pcc' END AS src,
  CASE WHEN event_type = 'error' THEN '臺北市' END AS county, CASE WHEN event_type = 'click' THEN 'price_desc' ELSE 'auction_asc' END AS sort,
  CAST(user_id * 100 AS DOUBLE) AS min_price, CASE WHEN event_id % 3 <> 0 THEN CAST(user_id * 100 + 5000 AS DOUBLE) END AS max_price
 FROM requests) x""")
def query_params(spark, sf_dir):
    requests = spark_sql(spark, sf_dir, REQUESTS, "SELECT event_id, query FROM requests")
    parsed = normalize_queries(requests)
    return parsed.select(
        "event_id", "view", "vehicleType", "vehicleClass", "carCategory",
        F.coalesce(F.array_join("displacementBands", ","), F.lit("")).alias("bands"), "within", "limit", "keyword", "source", "county",
        "sort", c("minPrice").alias("min_price"), c("maxPrice").alias("max_price"), "canonical_query")


@query("applied_filters", "WITH " + REQUESTS + """
SELECT event_id, CAST(
    CASE WHEN mix IN (0, 1, 2, 3, 4) THEN 1 ELSE 0 END + CASE WHEN mix = 3 THEN 1 ELSE 0 END + CASE WHEN mix = 1 THEN 1 ELSE 0 END
    + CASE mix WHEN 0 THEN 2 WHEN 4 THEN 1 ELSE 0 END + 1
    + CASE WHEN user_id % 4 <> 0 AND event_id % 400 BETWEEN 1 AND 365 THEN 1 ELSE 0 END
    + CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 1 WHEN 'error' THEN 2 ELSE 0 END AS INTEGER) AS applied_count,
  concat_ws('・', CASE user_id % 4 WHEN 0 THEN '已結束' WHEN 2 THEN '全部紀錄' ELSE '進行中' END,
    CASE WHEN mix IN (1, 2) THEN '汽車' ELSE '機車' END,
    CASE WHEN user_id % 4 <> 0 AND event_id % 400 BETWEEN 1 AND 365 THEN (event_id % 400) || ' 天內' END,
    CASE WHEN mix = 3 THEN '大型重型機車' END) AS summary
FROM requests""")
def applied(spark, sf_dir):
    parsed = normalize_queries(spark_sql(spark, sf_dir, REQUESTS, "SELECT event_id, query FROM requests"))
    return presentation.applied_filters(parsed).select("event_id", "applied_count", "summary")


@query("cursor_codec", listed(
    "SELECT id, listing_entity, 'price_asc' AS sort, CAST(display_price AS VARCHAR) AS value, CAST(id AS VARCHAR) AS row_id FROM listing"))
def cursors(spark, sf_dir):
    rows = view(spark, sf_dir).withColumn("cursor", paging.cursor_column("price_asc"))
    place = c("place")
    return rows.withColumn("place", paging.cursor_position(c("cursor"))).select("id", "listing_entity", place["sort"].alias("sort"), place["value"].alias("value"), place["id"].alias("row_id"))
