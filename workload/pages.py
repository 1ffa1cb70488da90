"""Notice families, discovery lists and feeds over pages written from the derived notices.

Each query writes one official page per notice with Spark, reads it back with the
library and returns the facts; the oracle takes the same facts from the notice's keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from noticelake.functions.text import stable_id
from noticelake.operators import filters, identity, quality, versioned
from noticelake.plans import ingest, jobs, publish
from noticelake.plans.notices import normalize
from noticelake.session import shared_dir, stored
from noticelake.sources import feeds, html, lists, manifests, seeds

from .derive import AS_OF, notices, spread_notices, with_notices
from .registry import Registry

c = F.col
query = Registry()

TYPE = "CASE WHEN kind <= 6 THEN 'MOTORCYCLE' WHEN kind <= 9 THEN 'CAR' WHEN kind = 10 THEN 'MIXED' ELSE 'UNKNOWN' END"
CLASS = """CASE kind WHEN 0 THEN 'ORDINARY_LIGHT' WHEN 1 THEN 'ORDINARY_HEAVY' WHEN 2 THEN 'LARGE_HEAVY' WHEN 3 THEN 'LARGE_HEAVY'
  WHEN 4 THEN 'ELECTRIC_MOTORCYCLE' WHEN 5 THEN 'HEAVY_UNSPECIFIED' ELSE 'UNKNOWN' END"""
CATEGORY = "CASE kind WHEN 7 THEN 'PASSENGER' WHEN 8 THEN 'TRUCK' WHEN 9 THEN 'SUV' ELSE 'UNKNOWN' END"
KEY = "CASE cond WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'NO' ELSE 'UNKNOWN' END"
START = "CASE cond WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 3 THEN 'NO' WHEN 4 THEN 'NO' ELSE 'UNKNOWN' END"
TEST = "CASE cond WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 3 THEN 'NO' WHEN 4 THEN 'YES' ELSE 'UNKNOWN' END"
REG_SEIZED = """CASE reg WHEN 0 THEN 'RE_REGISTRATION_REQUIRED' WHEN 1 THEN 'SCRAP_ONLY' WHEN 2 THEN 'NORMAL_TRANSFER'
  WHEN 3 THEN 'RE_REGISTRATION_REQUIRED' ELSE 'UNKNOWN' END"""
REG_ENFORCE = "CASE reg WHEN 1 THEN 'SCRAP_ONLY' WHEN 2 THEN 'NORMAL_TRANSFER' WHEN 3 THEN 'RE_REGISTRATION_REQUIRED' ELSE 'UNKNOWN' END"
MIDNIGHT = "date_trunc('day', day)"
LOCAL = f"({MIDNIGHT} + to_hours(hour24) + to_minutes(minute60) - INTERVAL 8 HOUR)"
CONDITION_SCORE = "CASE cond WHEN 0 THEN 100 WHEN 1 THEN 100 WHEN 2 THEN 50 WHEN 3 THEN 75 WHEN 4 THEN 75 ELSE 25 END"


def shown(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def by_time(ts: str) -> str:
    return f"CASE WHEN {ts} < TIMESTAMP '{AS_OF}' THEN 'EXPIRED' ELSE 'SCHEDULED' END"


def total(identity_: str, auction: str, condition: str, registration: str, fees: str, media: str) -> str:
    return (f"CAST(round_even({identity_} * 0.2::DOUBLE + {auction} * 0.25::DOUBLE + {condition} * 0.15::DOUBLE + {registration} * 0.2::DOUBLE "
            f"+ {fees} * 0.1::DOUBLE + {media} * 0.1::DOUBLE, 0) AS INTEGER)")


def landed(spark, sf_dir, content: str, url: str = "'https://h.gov.tw/x/' || CAST(notice_id AS STRING)", more: str = ""):
    return spread_notices(spark, sf_dir, f"""SELECT CAST(notice_id AS STRING) AS source_record_id, {url} AS official_url, {content} AS content,
        place_text AS organization{more} FROM notices""")


def facts_of(records, *names: str):
    """The checked columns of normalized records in comparable types."""
    out = [c("source_record_id").cast("bigint").alias("notice_id")]
    for name in names:
        kind = records.schema[name].dataType.typeName()
        if kind == "timestamp":
            out.append(F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name))
        elif kind == "decimal":
            out.append(c(name).cast("bigint").alias(name))
        elif kind == "array":
            out.append(F.size(name).cast("bigint").alias(name))
        else:
            out.append(c(name))
    return records.select(*out)


# --- procurement ---------------------------------------------------------------------------
PROCUREMENT = """'<html><body><table><tr><th>機關名稱</th><td>' || place_text || '</td><th>機關代碼</th><td>3.76</td></tr><tr><th>標案案號</th><td>C-'
  || CAST(notice_id AS STRING) || '</td><th>公告次數</th><td>' || CAST(n AS STRING) || '</td></tr><tr><th>公告日期</th><td>' || slash_date
  || '</td></tr><tr><th>財物名稱</th><td>標售' || noun || CAST(n AS STRING) || '輛</td></tr><tr><th>截止投標</th><td>' || slash_date
  || ' 17:00</td></tr><tr><th>投標資格摘要</th><td>' || elig_text || '</td></tr><tr><th>保證金額度</th><td>新臺幣'
  || CAST(CAST(floor(price / 10) AS BIGINT) AS STRING) || '元整</td><th>變賣標的所在地</th><td>' || place_text || '</td></tr><tr><th>底價金額</th><td>'
  || amount_text || '</td></tr><tr><th>附加說明</th><td>' || reg_text || '</td></tr></table></body></html>'"""


@query("notices_procurement", with_notices(f"""
SELECT notice_id, place_text AS organization, 'C-' || notice_id AS official_case_number, CAST(n AS INTEGER) AS auction_round,
  {shown(MIDNIGHT + ' - INTERVAL 8 HOUR')} AS starts_at, {shown(MIDNIGHT + ' + INTERVAL 9 HOUR')} AS ends_at, price AS reserve_price,
  CAST(floor(price / 10) AS BIGINT) AS deposit, {by_time(MIDNIGHT + ' + INTERVAL 9 HOUR')} AS status,
  CASE elig WHEN 2 THEN 'BUSINESS_ONLY' WHEN 3 THEN 'UNKNOWN' ELSE 'SPECIAL_QUALIFICATION' END AS eligibility,
  CASE reg WHEN 0 THEN 'RE_REGISTRATION_REQUIRED' WHEN 1 THEN 'SCRAP_ONLY' ELSE 'REGISTRABILITY_UNKNOWN' END AS registration_status,
  CASE WHEN reg = 1 THEN 'SCRAP_DISPOSAL' ELSE 'PUBLIC_ASSET_DISPOSAL' END AS disposal_origin, {TYPE} AS vehicle_type, {CLASS} AS vehicle_class,
  {CATEGORY} AS car_category, CAST(CASE WHEN kind IN (3, 11) THEN 1 ELSE n END AS INTEGER) AS lot_size, kind IN (3, 11) OR n > 1 AS bulk_lot,
  place_text AS location, {total('(CASE WHEN kind IN (3, 11) THEN 50 ELSE 100 END)', '(CASE WHEN elig = 3 THEN 80 ELSE 100 END)', '25', '33', '33', '0')} AS completeness,
  CAST(8 + CASE WHEN elig = 3 THEN 0 ELSE 1 END + CASE WHEN reg = 1 THEN 1 ELSE 0 END + 1 + CASE WHEN kind IN (3, 11) THEN 0 ELSE 1 END
    + CASE WHEN kind <= 5 THEN 1 ELSE 0 END + CASE WHEN kind <= 10 THEN 1 ELSE 0 END + CASE WHEN kind BETWEEN 7 AND 9 THEN 1 ELSE 0 END AS BIGINT) AS evidence
FROM notices"""))
def procurement(spark, sf_dir):
    records, _ = normalize("pcc", landed(spark, sf_dir, PROCUREMENT), AS_OF)
    return facts_of(records, "organization", "official_case_number", "auction_round", "starts_at", "ends_at", "reserve_price", "deposit", "status",
                    "eligibility", "registration_status", "disposal_origin", "vehicle_type", "vehicle_class", "car_category", "lot_size", "bulk_lot",
                    "location", "completeness", "evidence")


# --- seized property -------------------------------------------------------------------------
SEIZED = """'<html><head><meta name="DC.Creator" content="' || place_text || '"></head><body><h2 class="title">' || CAST(year(day) - 1911 AS STRING)
  || '年度變價字第' || CAST(notice_id AS STRING) || '號' || noun || '拍賣公告</h2><section class="cp"><p>拍賣時間：中華民國' || worded_date
  || '。</p><p>拍賣物品：' || noun || CAST(n AS STRING) || '輛，車牌' || plate || '，廠牌：光陽，型號：SJ' || CAST(who AS STRING) || '，排氣量：'
  || CAST(n * 50 AS STRING) || 'cc。</p><p>核定底價：' || CAST(price AS STRING) || '元；' || cond_text || '；' || reg_text || '；' || elig_text
  || '。義務人：王小明</p></section></body></html>'"""


def seized_records(spark, sf_dir):
    return normalize("moj_auction", landed(spark, sf_dir, SEIZED), AS_OF)


SEIZED_SCORE = total("(CASE WHEN kind = 10 THEN 50 ELSE 100 END)", "(CASE WHEN elig <= 1 THEN 100 ELSE 80 END)", f"({CONDITION_SCORE})",
                     "(CASE WHEN reg = 4 THEN 33 ELSE 67 END)", "0", "0")


@query("notices_seized", with_notices(f"""
SELECT notice_id, place_text AS organization, CAST(year(day) - 1911 AS VARCHAR) || '年度變價字第' || notice_id || '號' AS official_case_number, {shown(LOCAL)} AS ends_at,
  price AS reserve_price, {by_time(LOCAL)} AS status, CASE elig WHEN 0 THEN 'LICENSED_RECYCLER_ONLY' WHEN 1 THEN 'NATURAL_PERSON_ALLOWED' ELSE 'UNKNOWN' END AS eligibility,
  {REG_SEIZED} AS registration_status, {TYPE} AS vehicle_type, {CLASS} AS vehicle_class, {CATEGORY} AS car_category,
  CASE WHEN kind <> 10 THEN 'KYMCO' END AS brand, CASE WHEN kind <> 10 THEN 'SJ' || who END AS model, CASE WHEN kind <> 10 THEN CAST(n * 50 AS INTEGER) END AS displacement_cc,
  CAST(n AS INTEGER) AS lot_size, kind = 10 OR n > 1 AS bulk_lot, {KEY} AS has_key, {START} AS can_start, {TEST} AS can_test, 1::BIGINT AS identifiers,
  {SEIZED_SCORE} AS completeness FROM notices WHERE kind <> 11"""))
def seized(spark, sf_dir):
    return facts_of(seized_records(spark, sf_dir)[0], "organization", "official_case_number", "ends_at", "reserve_price", "status", "eligibility",
                    "registration_status", "vehicle_type", "vehicle_class", "car_category", "brand", "model", "displacement_cc", "lot_size", "bulk_lot",
                    "has_key", "can_start", "can_test", "identifiers", "completeness")


@query("notices_seized_errors", with_notices(
    "SELECT notice_id, 'record names neither a car nor a motorcycle' AS error FROM notices WHERE kind = 11"))
def seized_errors(spark, sf_dir):
    return seized_records(spark, sf_dir)[1].select(c("source_record_id").cast("bigint").alias("notice_id"), "error")


# --- enforcement -----------------------------------------------------------------------------
ENFORCEMENT = """'<html><body><div class="title_h3">公告事項</div><ul><li>案號：A' || CAST(notice_id AS STRING) || '</li><li>開標日：' || date_format(day, 'yyyy/MM/dd')
  || ' 10:30:00</li><li>拍賣' || noun || CAST(n AS STRING) || '臺，車號' || plate || '，廠牌：光陽，型號：SJ' || CAST(who AS STRING) || '，里程：' || CAST(who AS STRING)
  || '公里，' || cond_text || '，' || reg_text || '。第' || CAST(n AS STRING) || '拍，底價' || CAST(price AS STRING) || '元。罰鍰自理</li></ul></body></html>'"""


@query("notices_enforcement", with_notices(f"""
SELECT notice_id, 'A' || notice_id AS official_case_number, {shown(MIDNIGHT + ' + INTERVAL 150 MINUTE')} AS ends_at, {by_time(MIDNIGHT + ' + INTERVAL 150 MINUTE')} AS status,
  place_text AS organization, {TYPE} AS vehicle_type, {CLASS} AS vehicle_class, CAST(n AS INTEGER) AS lot_size, CAST(n AS INTEGER) AS auction_round, price AS reserve_price,
  CAST(who AS INTEGER) AS mileage_km, {REG_ENFORCE} AS registration_status, {KEY} AS has_key, {START} AS can_start, {TEST} AS can_test,
  CASE WHEN kind <> 10 THEN 'KYMCO' END AS brand, 1::BIGINT AS fee_notes, 1::BIGINT AS identifiers FROM notices WHERE kind <> 11"""))
def enforcement(spark, sf_dir):
    records, _ = normalize("moj_enforcement", landed(spark, sf_dir, ENFORCEMENT), AS_OF)
    return facts_of(records, "official_case_number", "ends_at", "status", "organization", "vehicle_type", "vehicle_class", "lot_size", "auction_round",
                    "reserve_price", "mileage_km", "registration_status", "has_key", "can_start", "can_test", "brand", "fee_notes", "identifiers")


# --- branch post -----------------------------------------------------------------------------
BRANCH = """'<html><head><meta name="ContentTitle" content="公告' || noun || '拍賣（' || worded_date || '）"><meta name="DC.Creator" content="' || place_text
  || '"></head><body><section class="cp">' || noun || '一輛，廠牌：光陽，型號：SJ' || CAST(who AS STRING) || '，車牌：' || plate || '。拍賣地點：' || place_text || '；' || cond_text
  || '，' || reg_text || '，核定底價新臺幣' || CAST(price AS STRING) || '元。</section><div class="file_download"><a href="/media/' || CAST(notice_id AS STRING)
  || '/n.pdf?x=1">公告.pdf</a><a href="/media/2/p.jpg">照片</a><a href="https://other.tw/z.pdf">z.pdf</a></div></body></html>'"""


@query("notices_branch", with_notices(f"""
SELECT notice_id, {shown(LOCAL)} AS ends_at, {by_time(LOCAL)} AS status, place_text AS organization, {TYPE} AS vehicle_type, price AS reserve_price,
  {REG_ENFORCE} AS registration_status, {KEY} AS has_key, {START} AS can_start, CASE WHEN kind <> 10 THEN 'KYMCO' END AS brand, kind = 10 AS bulk_lot,
  'https://www.tpy.moj.gov.tw/media/' || notice_id || '/n.pdf?x=1' AS attachment FROM notices WHERE kind <> 11"""))
def branch(spark, sf_dir):
    url = "'https://www.tpy.moj.gov.tw/1/' || CAST(notice_id AS STRING) || '/post'"
    records, _ = normalize("moj_enforcement_cms", landed(spark, sf_dir, BRANCH, url), AS_OF)
    links = F.filter("evidence", lambda e: e["field_name"] == "official_attachment_url")
    checked = facts_of(records.withColumn("attachment", F.array_join(F.transform(links, lambda e: e["normalized_value"]), " ")),
                       "ends_at", "status", "organization", "vehicle_type", "reserve_price", "registration_status", "has_key", "can_start", "brand",
                       "bulk_lot", "attachment")
    return checked


# --- customs ---------------------------------------------------------------------------------
CUSTOMS = """'<html><body><main><article><h1>公告</h1><p>發文字號：測字第' || CAST(notice_id AS STRING) || '號。</p><p>標的物：' || noun || CAST(n AS STRING) || ' 輛，廠牌：測試牌，型號：S'
  || CAST(who AS STRING) || '，排氣量：' || CAST(n * 500 AS STRING) || ' c.c.，車牌：' || plate || '。</p><p>開標日期及地點：' || worded_date || '，四樓。</p><p>'
  || CASE elig WHEN 0 THEN '限具有許可者投標' WHEN 1 THEN '個人投標請攜帶國民身分證' ELSE '投標須知' END || '。</p><p>底價 ' || CAST(price AS STRING) || ' 元，保證金 '
  || CAST(who AS STRING) || ' 元。' || CASE reg WHEN 0 THEN '限退運出口' WHEN 1 THEN '不辦理登檢領照' WHEN 2 THEN '須經檢測合格後始得登檢' WHEN 3 THEN '僅供報廢' ELSE '' END
  || '。</p><a href="/download/' || CAST(notice_id AS STRING) || '.pdf">清冊</a><a href="https://example.com/n.pdf">其他</a></article></main></body></html>'"""


@query("notices_customs", with_notices(f"""
SELECT notice_id, '測字第' || notice_id || '號' AS official_case_number, {shown(LOCAL)} AS ends_at, {by_time(LOCAL)} AS status, {TYPE} AS vehicle_type,
  {CATEGORY} AS car_category, CAST(n AS INTEGER) AS lot_size, price AS reserve_price, who AS deposit, CAST(n * 500 AS INTEGER) AS displacement_cc,
  CASE elig WHEN 0 THEN 'SPECIAL_QUALIFICATION' WHEN 1 THEN 'NATURAL_PERSON_ALLOWED' ELSE 'UNKNOWN' END AS eligibility,
  CASE reg WHEN 0 THEN 'EXPORT_ONLY' WHEN 1 THEN 'CANNOT_RELICENSE' WHEN 2 THEN 'INSPECTION_REQUIRED' WHEN 3 THEN 'SCRAP_ONLY' ELSE 'UNKNOWN' END AS registration_status,
  {total('100', '(CASE WHEN elig <= 1 THEN 100 ELSE 80 END)', '0', '(CASE WHEN reg = 4 THEN 0 ELSE 100 END)', '50', '50')} AS completeness FROM notices WHERE kind <> 11"""))
def customs(spark, sf_dir):
    pages = landed(spark, sf_dir, CUSTOMS, "'https://web.customs.gov.tw/t/' || CAST(notice_id AS STRING)", ", '公告標售' AS title")
    records, _ = normalize("customs", pages, AS_OF)
    return facts_of(records, "official_case_number", "ends_at", "status", "vehicle_type", "car_category", "lot_size", "reserve_price", "deposit",
                    "displacement_cc", "eligibility", "registration_status", "completeness")


# --- online sale -----------------------------------------------------------------------------
SALE = """'<html><body><strong>【S' || CAST(notice_id AS STRING) || '】' || noun || CAST(n AS STRING) || '臺</strong><div>目前出價 ' || CAST(price AS STRING)
  || '元 / 5 人</div><table><tr><td>拍賣次數</td><td>' || CAST(n AS STRING) || '</td></tr><tr><td>底價</td><td>新台幣 ' || CAST(who AS STRING)
  || ' 元</td></tr><tr><td>拍賣開始與截止日</td><td>' || slash_date || '~' || slash_date || ' 12:00:00</td></tr><tr><td>拍賣單位</td><td>' || place_text
  || '</td></tr></table><p>廠牌：三陽牌</p><p>型號：M' || CAST(who AS STRING) || '</p><p>牌照異動登記：' || reg_text || '</p><div>物品說明：出廠年份：2011.05；排氣量：'
  || CAST(n * 50 AS STRING) || 'cc。車牌號碼：' || plate || '；引擎號碼：FD' || CAST(10000 + who AS STRING) || '。' || cond_text || '。無欠稅。手續費自付。</div><h2>其他條款</h2>'
  || '<a href="../../imageResize?p=' || CAST(notice_id AS STRING) || '&amp;w=2">附件</a></body></html>'"""


def sale_records(spark, sf_dir):
    return normalize("shwoo", landed(spark, sf_dir, SALE, "'https://shwoo.gov.taipei/shwoo/a/b/product?AUID=' || CAST(notice_id AS STRING)"), AS_OF)


@query("notices_sale", with_notices(f"""
SELECT notice_id, 'S' || notice_id AS official_case_number, noun || n || '臺' AS title, price AS current_price, who AS reserve_price, CAST(n AS INTEGER) AS auction_round,
  {shown(MIDNIGHT + ' + INTERVAL 4 HOUR')} AS ends_at, {by_time(MIDNIGHT + ' + INTERVAL 4 HOUR')} AS status, place_text AS organization, '三陽牌' AS brand, 'M' || who AS model,
  CASE reg WHEN 0 THEN 'RE_REGISTRATION_REQUIRED' WHEN 1 THEN 'SCRAP_ONLY' ELSE 'UNKNOWN' END AS registration_status, 'NATURAL_PERSON_ALLOWED' AS eligibility,
  CASE cond WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'CONFLICTING' ELSE 'UNKNOWN' END AS has_key,
  CASE cond WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 3 THEN 'NO' WHEN 4 THEN 'CONFLICTING' ELSE 'UNKNOWN' END AS can_start, 'NO' AS tax_arrears, 'UNKNOWN' AS fine_arrears,
  2011 AS manufacture_year, 5 AS manufacture_month, CAST(n * 50 AS INTEGER) AS displacement_cc, {TYPE} AS vehicle_type, CAST(n AS INTEGER) AS lot_size, n > 1 AS bulk_lot,
  2::BIGINT AS identifiers, 0::BIGINT AS vehicle_units, 1::BIGINT AS photo_urls, 1::BIGINT AS fee_notes FROM notices"""))
def sale(spark, sf_dir):
    return facts_of(sale_records(spark, sf_dir)[0], "official_case_number", "title", "current_price", "reserve_price", "auction_round", "ends_at", "status",
                    "organization", "brand", "model", "registration_status", "eligibility", "has_key", "can_start", "tax_arrears", "fine_arrears",
                    "manufacture_year", "manufacture_month", "displacement_cc", "vehicle_type", "lot_size", "bulk_lot", "identifiers", "vehicle_units",
                    "photo_urls", "fee_notes")


# --- court rows ------------------------------------------------------------------------------
COURT = """to_json(named_struct('rowid', CAST(notice_id AS STRING), 'crtnm', place_text, 'crm', CASE WHEN n = 1 THEN '' ELSE '115司執' || CAST(notice_id AS STRING) END,
  'crmyy', '115', 'crmid', '司執', 'crmno', CAST(notice_id AS STRING), 'saledate', replace(slash_date, '/', ''), 'saleno', CAST(n AS STRING), 'ttitle', noun, 'qty', CAST(n AS STRING),
  'sumprice', CASE WHEN n = 2 THEN 0 ELSE price END, 'deposit', CASE WHEN n = 3 THEN CAST(who AS STRING) END,
  'notes', '車牌：' || plate || '、AB-12。廠牌：山葉、出廠年月：2011年12月、型式：XC' || CAST(who AS STRING) || '、排氣量(馬力)：' || CAST(n * 50 AS STRING)
    || 'cc(HP)、顏色：白色、引擎：EN' || CAST(who AS STRING) || '。' || cond_text))"""


@query("notices_court", with_notices(f"""
SELECT notice_id, place_text AS organization, CASE WHEN n = 1 THEN '115司執字第' || notice_id || '號' ELSE '115司執' || notice_id END AS official_case_number,
  {shown(MIDNIGHT + ' - INTERVAL 8 HOUR')} AS ends_at, CAST(n AS INTEGER) AS auction_round, CASE WHEN n <> 2 AND price > 0 THEN price END AS reserve_price,
  CASE WHEN n = 3 THEN who END AS deposit, CASE WHEN {MIDNIGHT} < TIMESTAMP '{AS_OF}' + INTERVAL 8 HOUR - INTERVAL 8 HOUR THEN 'EXPIRED' ELSE 'SCHEDULED' END AS status,
  CAST(n AS INTEGER) AS lot_size, n > 1 AS bulk_lot, {TYPE} AS vehicle_type, CASE WHEN kind <> 10 THEN 'YAMAHA' END AS brand,
  CASE WHEN kind <> 10 THEN 'XC' || who END AS model, CASE WHEN kind <> 10 THEN 2011 END AS manufacture_year, CASE WHEN kind <> 10 THEN 12 END AS manufacture_month,
  CASE WHEN kind <> 10 THEN CAST(n * 50 AS INTEGER) END AS displacement_cc, '白色' AS color, {KEY} AS has_key, {START} AS can_start, 3::BIGINT AS identifiers,
  2::BIGINT AS vehicle_units FROM notices"""))
def court(spark, sf_dir):
    records, _ = normalize("judicial", landed(spark, sf_dir, COURT), AS_OF)
    return facts_of(records, "organization", "official_case_number", "ends_at", "auction_round", "reserve_price", "deposit", "status", "lot_size", "bulk_lot",
                    "vehicle_type", "brand", "model", "manufacture_year", "manufacture_month", "displacement_cc", "color", "has_key", "can_start",
                    "identifiers", "vehicle_units")


# --- evidence of records -----------------------------------------------------------------------
@query("record_evidence", with_notices("""
SELECT notice_id, 'official_case_number' AS field_name, CAST(year(day) - 1911 AS VARCHAR) || '年度變價字第' || notice_id || '號' AS source_text FROM notices WHERE kind <> 11
UNION ALL SELECT notice_id, 'organization', place_text FROM notices WHERE kind <> 11
UNION ALL SELECT notice_id, 'vehicle_type', noun FROM notices WHERE kind <> 11
UNION ALL SELECT notice_id, 'vehicle_class', noun FROM notices WHERE kind <= 5
UNION ALL SELECT notice_id, 'car_category', noun FROM notices WHERE kind BETWEEN 7 AND 9"""))
def record_evidence(spark, sf_dir):
    rows = seized_records(spark, sf_dir)[0].select(
        c("source_record_id").cast("bigint").alias("notice_id"), F.explode_outer("evidence").alias("e"))
    kept = ["official_case_number", "organization", "vehicle_type", "vehicle_class", "car_category"]
    return rows.filter(c("e.field_name").isin(kept)).select("notice_id", c("e.field_name").alias("field_name"), c("e.source_text").alias("source_text"))


# --- publishing --------------------------------------------------------------------------------
def public_rows(spark, sf_dir):
    records, _ = seized_records(spark, sf_dir)
    named = records.withColumns({"source_adapter": F.lit("moj_auction"), "source_name": F.lit("法務部查扣物集中拍賣")})
    return publish.public_projection(named, AS_OF)


@query("public_projection", with_notices(f"""
SELECT 'moj_auction-' || notice_id AS id, 'https://h.gov.tw/x/' || notice_id AS official_url, price AS reserve_price, {TYPE} AS vehicle_type, {CLASS} AS vehicle_category,
  {CATEGORY} AS car_category, CASE WHEN kind <> 10 THEN 'KYMCO' END AS brand_name,
  CASE WHEN {LOCAL} >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY THEN substr(plate, 1, 5) || '***' END AS plate_number,
  '有無鑰匙：' || CASE cond WHEN 0 THEN '是' WHEN 1 THEN '否' WHEN 2 THEN '否' ELSE '未確認' END || '；能否發動：'
    || CASE cond WHEN 0 THEN '是' WHEN 5 THEN '未確認' WHEN 2 THEN '未確認' ELSE '否' END || '；能否測試：'
    || CASE cond WHEN 0 THEN '是' WHEN 4 THEN '是' WHEN 1 THEN '否' WHEN 3 THEN '否' ELSE '未確認' END AS condition_summary,
  n > 1 OR kind = 10 AS bulk_lot, 64::BIGINT AS checksum_length,
  lower(CAST(year(day) - 1911 AS VARCHAR) || '年度變價字第' || notice_id || '號' || noun || '拍賣公告 ' || CAST(year(day) - 1911 AS VARCHAR) || '年度變價字第' || notice_id || '號 '
    || place_text || ' ' || CASE WHEN kind <> 10 THEN 'kymco' ELSE '' END || ' ' || CASE WHEN kind <> 10 THEN 'sj' || who ELSE '' END || ' '
    || CASE WHEN {LOCAL} >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY THEN substr(plate, 1, 5) || '***' ELSE '' END || '  ') AS search_text
FROM notices WHERE kind <> 11"""))
def public_projection(spark, sf_dir):
    return public_rows(spark, sf_dir).select(
        "id", "official_url", c("reserve_price").cast("bigint").alias("reserve_price"), "vehicle_type", "vehicle_category", "car_category", "brand_name",
        "plate_number", "condition_summary", "bulk_lot", F.length("content_checksum").cast("bigint").alias("checksum_length"), "search_text")


def arrived(spark, sf_dir, content: str):
    """Landed pages as a collector hands them over."""
    return landed(spark, sf_dir, content).withColumns({
        "fetched_at": F.lit(AS_OF).cast("timestamp"), "mime_type": F.lit("text/html"), "checksum_sha256": F.sha2("content", 256), "http_status": F.lit(200)})


# The second time the pages of n = 1 state another price.
SEIZED_LATER = SEIZED.replace("核定底價：' || CAST(price AS STRING)", "核定底價：' || CAST(price + CASE WHEN n = 1 THEN 7 ELSE 0 END AS STRING)")


@query("publish_job", with_notices(f"""
SELECT 'run' AS part, CAST(run AS VARCHAR) AS id, count(*) AS discovered_count, count(*) FILTER (WHERE kind <> 11) AS parsed_count,
  count(*) FILTER (WHERE kind <> 11 AND (run = 1 OR n = 1)) AS changed_count, count(*) FILTER (WHERE kind = 11) AS failed_count, 'PARTIAL' AS status,
  NULL::BIGINT AS reserve_price, NULL AS plate_number FROM notices, (VALUES (1), (2)) r(run) GROUP BY run
UNION ALL SELECT 'row', 'moj_auction-' || notice_id, NULL, NULL, NULL, NULL, NULL, price + CASE WHEN n = 1 THEN 7 ELSE 0 END,
  CASE WHEN {LOCAL} >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY THEN substr(plate, 1, 5) || '***' END FROM notices WHERE kind <> 11"""))
def publish_job(spark, sf_dir):
    """Two runs of the publishing job over the same pages, some changed, and the public table they leave."""
    path = f"{shared_dir(spark)}/publish-{uuid.uuid4().hex}"
    runs = [
        jobs.publish_job(spark, "moj_auction", "法務部查扣物集中拍賣", arrived(spark, sf_dir, content), path, AS_OF, number)
        for number, content in ((1, SEIZED), (2, SEIZED_LATER))
    ]
    counters = ["discovered_count", "parsed_count", "changed_count", "failed_count"]
    ran = runs[0].union(runs[1]).select(
        F.lit("run").alias("part"), c("run_id").cast("string").alias("id"), *counters, "status", F.lit(None).cast("bigint").alias("reserve_price"),
        F.lit(None).cast("string").alias("plate_number"))
    rows = versioned.read_table(spark, f"{path}/public").select(
        F.lit("row").alias("part"), "id", *[F.lit(None).cast("bigint").alias(n) for n in counters], F.lit(None).cast("string").alias("status"),
        c("reserve_price").cast("bigint").alias("reserve_price"), "plate_number")
    return ran.union(rows)


@query("reprocess_job", with_notices("""
SELECT notice_id, version AS parser_version, price AS reserve_price, CAST(n AS INTEGER) AS lot_size, CAST(year(day) - 1911 AS VARCHAR) || '年度變價字第' || notice_id || '號' AS case_number,
  2::BIGINT AS versions FROM notices, (VALUES ('1.3.0'), ('1.4.0')) v(version) WHERE kind <> 11"""))
def reprocess_job(spark, sf_dir):
    """Pages saved under an older parser, parsed again under this one: two snapshots of one payload, all else as it was."""
    path = f"{shared_dir(spark)}/reprocess-{uuid.uuid4().hex}"
    brands, models = seeded_brands(spark)
    pages = arrived(spark, sf_dir, SEIZED)
    jobs.save_job(spark, "moj_auction", "法務部查扣物集中拍賣", pages, path, AS_OF, 1, brands, models, "1.3.0")
    contents = pages.select("checksum_sha256", F.encode("content", "utf-8").alias("content"))
    jobs.reprocess_job(spark, "moj_auction", "法務部查扣物集中拍賣", contents, path, AS_OF, 2, brands, models, "1.3.0")
    t = jobs.saved(spark, path)
    events = t["events"].select("record_id", c("id").alias("event_id"), "case_id", c("reserve_price").cast("bigint").alias("reserve_price"))
    versions = t["snapshots"].groupBy("record_id", "payload_checksum").agg(F.count(F.lit(1)).alias("versions"))
    return (
        t["snapshots"].join(versions, ["record_id", "payload_checksum"]).join(t["records"].select(c("id").alias("record_id"), "source_record_id"), "record_id").join(events, "record_id")
        .join(t["lots"].select("event_id", "lot_size"), "event_id").join(t["cases"].select(c("id").alias("case_id"), c("official_case_number").alias("case_number")), "case_id")
        .select(c("source_record_id").cast("bigint").alias("notice_id"), "parser_version", "reserve_price", "lot_size", "case_number", "versions"))


CHECK_NAMES = [
    "public_url_https", "public_plate_masked", "public_plate_retention", "public_no_photos", "public_text_personal_data", "public_text_role_name",
    "public_document_links",
]


@query("public_quality", " UNION ALL ".join(f"SELECT '{n}' AS check_name, 0::BIGINT AS violations" for n in CHECK_NAMES))
def public_quality(spark, sf_dir):
    return quality.row_checks(public_rows(spark, sf_dir), quality.public_checks(AS_OF))


BROKEN_KINDS = {
    "public_url_https": "kind = 0", "public_plate_masked": "kind = 1", "public_plate_retention": "kind = 3", "public_no_photos": "kind = 4",
    "public_text_personal_data": "kind IN (5, 6, 7)", "public_text_role_name": "kind = 8", "public_document_links": "kind = 9",
}


@query("public_quality_seeded", with_notices(" UNION ALL ".join(
    f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {where}) AS violations FROM notices" for name, where in BROKEN_KINDS.items())))
def public_quality_seeded(spark, sf_dir):
    """Every promise of the public table broken by one kind of notice, and by no other."""
    rows = notices(spark, sf_dir, f"""SELECT 'r' || CAST(notice_id AS STRING) AS source_record_id, CASE WHEN kind = 0 THEN 'http://h.gov.tw/x' ELSE 'https://h.gov.tw/x' END AS official_url,
        CASE kind WHEN 1 THEN plate ELSE substr(plate, 1, 5) || '***' END AS plate_number, noun AS official_title,
        CASE kind WHEN 3 THEN TIMESTAMP '{AS_OF}' - INTERVAL 31 DAY ELSE TIMESTAMP '{AS_OF}' END AS ends_at,
        CASE kind WHEN 5 THEN '證號A1' || CAST(10000000 + who AS STRING) WHEN 6 THEN 'a' || CAST(who AS STRING) || '@mail.tw' WHEN 7 THEN '電話0912-345-' || CAST(100 + who % 900 AS STRING)
          WHEN 8 THEN '車主：王小明' ELSE place_text END AS description, kind FROM notices""")
    blank = F.lit(None).cast("string")
    rows = rows.withColumns({
        "photo_urls": F.when(c("kind") == 4, F.array(F.lit("https://h.gov.tw/p.jpg"))).otherwise(F.array().cast("array<string>")), "fee_notes": F.array(F.lit("費用")),
        "documents": F.array(F.struct(F.when(c("kind") == 9, "https://h.gov.tw/a?m=a%40b.tw").otherwise("https://h.gov.tw/a.pdf").alias("url"))),
        **{n: blank for n in quality.PUBLIC_TEXT_FIELDS if n not in rows.columns},
    })
    return quality.row_checks(rows, quality.public_checks(AS_OF))


@query("public_redaction_backfill", with_notices(f"""
SELECT id, official_url, official_title, note, plate_number, photos, documents, md5(concat_ws('|', 'pcc', substr(id, 5), official_url, official_title, plate_number, '["' || note || '"]', '[]',
  CASE WHEN documents = 0 THEN '[]' ELSE '[{{"label":"官方附件","url":"https://h.gov.tw/a.pdf"}}]' END, '{AS_OF}')) AS content_checksum FROM (
SELECT 'pcc-' || CASE WHEN n = 1 THEN 'redacted-' || substr(md5('pcc:A1' || (10000000 + who)), 1, 20) ELSE CAST(notice_id AS VARCHAR) END AS id,
  CASE WHEN n IN (1, 2) THEN 'https://h.gov.tw/' ELSE 'https://h.gov.tw/x/' || notice_id END AS official_url,
  '車主：已隱去，牌照' || substr(plate, 1, 5) || '***' AS official_title, '電話聯絡電話已隱藏' AS note,
  CASE WHEN {LOCAL} >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY THEN substr(plate, 1, 5) || '***' END AS plate_number, 0::BIGINT AS photos,
  CASE WHEN n = 3 THEN 0 ELSE 1 END::BIGINT AS documents FROM notices) x"""))
def redaction_backfill(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT 'pcc' AS source_adapter, CASE WHEN n = 1 THEN 'A1' || CAST(10000000 + who AS STRING) ELSE CAST(notice_id AS STRING) END AS source_record_id,
        CASE n WHEN 1 THEN 'https://h.gov.tw/x?id=A1' || CAST(10000000 + who AS STRING) WHEN 2 THEN 'https://h.gov.tw/p/' || plate
          ELSE 'https://h.gov.tw/x/' || CAST(notice_id AS STRING) END AS official_url, '車主王小明，牌照' || plate AS official_title, plate AS plate_number,
        worded_date, n, notice_id FROM notices""")
    from noticelake.functions.dates import official_datetime

    blank = F.lit(None).cast("string")
    document = F.struct(F.lit("官方附件").alias("label"), F.when(c("n") == 3, "https://h.gov.tw/a?m=a%40b.tw").otherwise("https://h.gov.tw/a.pdf").alias("url"))
    table = rows.withColumns({
        "id": F.concat_ws("-", "source_adapter", "source_record_id"), "ends_at": official_datetime(c("worded_date")),
        "fee_notes": F.array(F.lit("電話0912345678")), "photo_urls": F.array(F.lit("https://h.gov.tw/p.jpg")), "documents": F.array(document),
        "source_name": F.lit("來源"), "last_synced_at": F.lit(AS_OF).cast("timestamp"),
        **{n: blank for n in ("official_case_number", "organization_name", "brand_name", "model_name", "color", "location", "description", "condition_summary")},
    })
    out = publish.redact_public_table(table, AS_OF)
    return out.select(
        "id", "official_url", "official_title", F.get("fee_notes", F.lit(0)).alias("note"), "plate_number", F.size("photo_urls").cast("bigint").alias("photos"),
        F.size("documents").cast("bigint").alias("documents"), "content_checksum")


@query("public_visible", with_notices("SELECT notice_id, noun AS official_title FROM notices WHERE n <> 2 AND kind <> 11"))
def public_visible(spark, sf_dir):
    """What anonymous readers see: active rows; an unknown state is none."""
    rows = notices(spark, sf_dir, "SELECT notice_id, noun AS official_title, CASE WHEN kind = 11 THEN NULL ELSE n <> 2 END AS active FROM notices")
    return filters.visible(rows).select("notice_id", "official_title")


# --- relational tables of a batch ----------------------------------------------------------------
@query("ingest_tables", with_notices("""
SELECT 'organizations' AS table_name, count(DISTINCT place_text) AS row_count FROM notices WHERE kind <> 11
UNION ALL SELECT t, count(*) FROM notices, (VALUES ('records'), ('artifacts'), ('snapshots'), ('cases'), ('events'), ('lots')) v(t) WHERE kind <> 11 GROUP BY t
UNION ALL SELECT t, count(*) FROM notices, (VALUES ('vehicles'), ('identifiers'), ('observations')) v(t) WHERE kind <> 11 AND kind <> 10 AND n = 1 GROUP BY t
UNION ALL SELECT 'photos', 0::BIGINT UNION ALL SELECT 'documents', 0::BIGINT
UNION ALL SELECT 'evidence', CAST(sum(5 + CASE WHEN kind <= 5 THEN 1 ELSE 0 END + CASE WHEN kind BETWEEN 7 AND 9 THEN 1 ELSE 0 END
    + CASE WHEN reg <= 3 THEN 1 ELSE 0 END + CASE WHEN elig <= 1 THEN 1 ELSE 0 END) AS BIGINT) FROM notices WHERE kind <> 11"""))
def ingest_tables(spark, sf_dir):
    return table_counts(spark, saved_tables(spark, sf_dir)[0])


def seeded_brands(spark):
    brands = seeds.brands(spark).withColumn("id", stable_id(c("canonical_name")))
    return brands, seeds.models(spark).select(stable_id(c("brand")).alias("brand_id"), stable_id(c("model_code")).alias("id"), "canonical_name", "model_code")


def saved_tables(spark, sf_dir):
    pages = landed(spark, sf_dir, SEIZED)
    # Thirteen tables are derived from the records: parse once, and let each read its columns.
    records = stored(normalize("moj_auction", pages, AS_OF)[0].withColumn("source_adapter", F.lit("moj_auction")))
    artifacts = pages.select(
        F.lit("moj_auction").alias("source_adapter"), "source_record_id", "official_url", F.lit(AS_OF).cast("timestamp").alias("fetched_at"),
        F.lit("text/html").alias("mime_type"), F.sha2("content", 256).alias("checksum_sha256"), F.lit(0).alias("artifact_no"))
    brands, models = seeded_brands(spark)
    incoming = ingest.table_rows(records, artifacts, brands, models, AS_OF)
    return ingest.save({}, incoming), incoming


def table_counts(spark, saved):
    """One query per table, so that the shuffle files of one are gone before the next begins; thirteen numbers come back."""
    return spark.createDataFrame([(name, df.count()) for name, df in saved.items()], "table_name string, row_count long")


# --- discovery -----------------------------------------------------------------------------------
# Twenty notices make one list page.
def list_pages(spark, sf_dir, row: str, open_tag: str, close_tag: str):
    rows = notices(spark, sf_dir, f"SELECT CAST(floor(notice_id / 20) AS BIGINT) AS page_no, notice_id, {row} AS row FROM notices")
    grouped = rows.groupBy("page_no").agg(F.array_sort(F.collect_list(F.struct("notice_id", "row"))).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["row"]), "")
    return grouped.select("page_no", F.concat(F.lit(open_tag), body, F.lit(close_tag)).alias("html"))


@query("search_rows", with_notices("""
SELECT CAST(90000000 + notice_id AS VARCHAR) AS source_record_id, place_text AS organization, 'C-' || notice_id AS case_number, '標售' || noun AS title,
  'https://web.pcc.gov.tw' || CASE n WHEN 1 THEN '/opas/aspam/public/readOneAspamDetailOld' WHEN 2 THEN '/opas/aspam/public/readOneAspamDetailNew'
    ELSE '/opas/aspam/public/readOneAspamDetail' END || '?pk=' || (90000000 + notice_id) AS official_url
FROM notices WHERE kind IN (0, 1, 2, 4, 5, 6, 10)"""))
def search_rows(spark, sf_dir):
    row = """'<tr><td>1</td><td>' || place_text || '</td><td>Ｃ-' || CAST(notice_id AS STRING) || '</td><td>1</td><td>標售' || noun || '</td><td>' || slash_date
        || '</td><td><select><option>請選擇</option><option value="formView' || CASE n WHEN 1 THEN 'New' WHEN 2 THEN 'Old' ELSE 'Normal' END || '('
        || CAST(90000000 + notice_id AS STRING) || ',x);">檢視</option></select></td></tr>'"""
    pages = html.with_page(list_pages(spark, sf_dir, row, "<table><tbody>", "</tbody></table>"), "html")
    return lists.search_rows(pages).select("source_record_id", "organization", "case_number", "title", "official_url")


CENTRAL_ROW = """'<tr><td data-title="標題"><a href="' || CASE n WHEN 1 THEN '/1724/1726/' || CAST(notice_id AS STRING) || '/post' WHEN 2 THEN '/x?nodeId=' || CAST(notice_id AS STRING)
  WHEN 3 THEN '/media/m' || CAST(notice_id AS STRING) || '/f.pdf' ELSE 'https://other.tw/1724/1726/1' END || '">' || noun || '拍賣</a></td><td data-title="單位">' || place_text
  || '</td><td data-title="張貼日">115-08-01</td></tr>'"""


@query("central_list", with_notices("""
SELECT CASE n WHEN 1 THEN CAST(notice_id AS VARCHAR) WHEN 2 THEN 'node-' || notice_id ELSE 'media-m' || notice_id || '-f.pdf' END AS source_record_id, noun || '拍賣' AS title,
  place_text AS organization, '115-08-01' AS published_date FROM notices WHERE n <= 3 AND kind <> 11"""))
def central_list(spark, sf_dir):
    pages = list_pages(spark, sf_dir, CENTRAL_ROW, '<table class="table_list"><tbody>', "</tbody></table>")
    return lists.central_list(html.with_page(pages, "html")).select("source_record_id", "title", "organization", "published_date")


@query("exact_rows", with_notices("""
SELECT CAST(floor(notice_id / 20) AS BIGINT) AS page_no, count(*) AS row_slices, 64::BIGINT AS checksum_length FROM notices GROUP BY 1"""))
def exact_rows(spark, sf_dir):
    pages = list_pages(spark, sf_dir, CENTRAL_ROW, '<table class="table_list"><tbody>', "</tbody></table>")
    rows = lists.exact_rows(pages, "html")
    return rows.groupBy("page_no").agg(F.count(F.lit(1)).alias("row_slices"), F.max(F.length("checksum_sha256")).cast("bigint").alias("checksum_length"))


@query("sale_links", with_notices("""
SELECT CAST(CAST(floor(notice_id / 2) AS BIGINT) AS VARCHAR) AS source_record_id,
  arg_max(noun || notice_id, CASE WHEN n = 4 THEN -1000000000 - floor(notice_id / 20) * 10000 + notice_id ELSE notice_id END) AS title, bool_and(n = 4) AS result_record
FROM notices WHERE n <> 4 OR noun LIKE '%車%' OR noun LIKE '%重機%' GROUP BY floor(notice_id / 2)"""))
def sale_links(spark, sf_dir):
    row = "'<a href=\"/p?AUID=' || CAST(CAST(floor(notice_id / 2) AS BIGINT) AS STRING) || '\">' || noun || CAST(notice_id AS STRING) || '</a>'"
    rows = notices(spark, sf_dir, f"SELECT CAST(floor(notice_id / 20) AS BIGINT) AS page_no, n = 4 AS result_record, notice_id, {row} AS row FROM notices")
    grouped = rows.groupBy("page_no", "result_record").agg(F.array_sort(F.collect_list(F.struct("notice_id", "row"))).alias("rows"))
    pages = grouped.select("page_no", "result_record", F.lit(False).alias("recycler_only"), F.array_join(F.transform("rows", lambda r: r["row"]), "").alias("html"))
    links = lists.sale_links(html.with_page(pages, "html"))
    return lists.merge_sale_links(links, ["車", "重機"]).select("source_record_id", "title", "result_record")


@query("office_candidates", with_notices("""
SELECT 'taichung-id' || notice_id AS source_record_id, '公告標售' || noun AS title, '115-08-10' AS published_date,
  'https://web.customs.gov.tw/taichung/singlehtml/396?cntId=id' || notice_id AS official_url FROM notices WHERE n <> 2"""))
def office_candidates(spark, sf_dir):
    row = """'<tr><td>1</td><td><a href="/' || CASE n WHEN 2 THEN 'keelung' ELSE 'taichung' END || '/singlehtml/396?cntId=id' || CAST(notice_id AS STRING) || '">公告標售' || noun
        || '</a></td><td>115-08-10</td></tr>'"""
    pages = list_pages(spark, sf_dir, row, "<table><tbody>", '</tbody></table><a href="?page=2">2</a>').withColumns({
        "office": F.lit("taichung"), "organization": F.lit("臺中關"), "list_url": F.lit("https://web.customs.gov.tw/taichung/multiplehtml/396"),
        "current_url": F.lit("https://web.customs.gov.tw/taichung/multiplehtml/396")})
    return lists.office_candidates(html.with_page(pages, "html")).select("source_record_id", "title", "published_date", "official_url")


@query("office_page_links", with_notices("""
SELECT CAST(floor(notice_id / 20) AS BIGINT) AS page_no, 'https://web.customs.gov.tw/taichung/multiplehtml/396?page=' || p AS target_url
FROM notices, (VALUES (2), (3)) v(p) GROUP BY ALL"""))
def office_page_links(spark, sf_dir):
    tail = '<a href="?page=2">2</a><a href="/taichung/multiplehtml/396?page=3">下一頁</a><a href="?page=9">其他</a><a href="/x?page=4">4</a>'
    pages = list_pages(spark, sf_dir, "noun", "<p>", "</p>" + tail).withColumns({
        "office": F.lit("taichung"), "list_url": F.lit("https://web.customs.gov.tw/taichung/multiplehtml/396"),
        "current_url": F.lit("https://web.customs.gov.tw/taichung/multiplehtml/396")})
    return lists.office_page_links(html.with_page(pages, "html")).select("page_no", "target_url")


@query("branch_lists", with_notices("""
SELECT CAST(notice_id AS VARCHAR) AS branch, CAST(k AS INTEGER) AS list_no, 'https://www.tpy.moj.gov.tw' || CASE WHEN k = 1 THEN '/1/' || notice_id || '/' ELSE '/' || k || '/' END AS list_url
FROM notices, (VALUES (1), (2), (3)) v(k)"""))
def branch_lists(spark, sf_dir):
    pages = notices(spark, sf_dir, """SELECT CAST(notice_id AS STRING) AS branch, 'www.tpy.moj.gov.tw' AS host,
        '<a href="/2/" title="更多 電子公布欄">更多</a><a href="/3/">最新消息</a><a href="/4/">不動產拍賣公告</a><a href="https://other.tw/">動產拍賣公告</a><a href="/1/'
        || CAST(notice_id AS STRING) || '/Lpsimplelist">動產拍賣公告</a><a href="/2/">電子公布欄</a>' AS html FROM notices""")
    return lists.branch_lists(html.with_page(pages, "html"))


RECENT_ROW = """'<tr><td data-title="標題"><a href="/9/' || CAST(notice_id AS STRING) || CASE n WHEN 3 THEN '/file' ELSE '/post' END || '">' || noun || CASE cond WHEN 5 THEN '公告' ELSE '拍賣' END
  || '</a></td><td data-title="張貼日/發布日期" class="date">' || CASE n WHEN 4 THEN '無' ELSE replace(slash_date, '/', '-') END || '</td></tr>'"""


def recent(spark, sf_dir):
    pages = list_pages(spark, sf_dir, RECENT_ROW, '<table class="table_list"><tbody>', "</tbody></table>").withColumns({
        "branch": F.lit("tpy"), "organization": F.lit("臺北分署"), "host": F.lit("www.tpy.moj.gov.tw"), "page_url": F.lit("https://www.tpy.moj.gov.tw/9/")})
    return lists.recent_notices(html.with_page(pages, "html"), AS_OF)


RECENT = f"{MIDNIGHT} - INTERVAL 8 HOUR >= TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY AND kind <> 11 AND cond <> 5 AND n <> 4"


@query("recent_notices", with_notices(f"""
SELECT 'tpy-' || notice_id AS source_record_id, noun || '拍賣' AS title, 'https://www.tpy.moj.gov.tw/9/' || notice_id || '/post' AS official_url
FROM notices WHERE {RECENT} AND n <> 3"""))
def recent_notices(spark, sf_dir):
    return recent(spark, sf_dir)[0].select("source_record_id", "title", "official_url")


@query("recent_notice_rejects", with_notices(f"""
SELECT error, count(*) AS row_count FROM (SELECT CASE WHEN n = 4 THEN 'publication date is not an ROC date' WHEN {RECENT} AND n = 3
  THEN 'vehicle row without a same-host HTML post' END AS error FROM notices) x WHERE error IS NOT NULL GROUP BY error"""))
def recent_rejects(spark, sf_dir):
    return recent(spark, sf_dir)[1].groupBy("error").agg(F.count(F.lit(1)).alias("row_count"))


@query("attachment_links", with_notices("""
SELECT notice_id, 3::BIGINT AS seized, 'https://auction.moj.gov.tw/a' || notice_id || '.pdf' AS first_seized, 2::BIGINT AS enforcement, 1::BIGINT AS branch, 15::BIGINT AS sale FROM notices"""))
def attachment_links(spark, sf_dir):
    body = """'<div class="file_download"><a href="/a' || CAST(notice_id AS STRING) || '.pdf">a.pdf</a><a href="/a' || CAST(notice_id AS STRING)
        || '.pdf">again</a><a href="/b.zip">b</a><a href="https://other.tw/c.pdf">c</a></div><section class="cp"><img src="/i.png"></section><div id="slider"><img src="/s.png"></div><a href="/File/Download?x=1">f</a>'"""
    rows = notices(spark, sf_dir, f"""SELECT notice_id, {body} || array_join(transform(sequence(1, 15), i -> '<a href="/imageResize?i=' || CAST(i AS STRING) || '">p</a>'), '') AS html
        FROM notices""")
    pages = html.with_page(rows, "html")
    base = F.lit("https://auction.moj.gov.tw/1724/1726/1/post")
    found = {s: lists.attachment_urls(k, base) for s, k in (("seized", "moj_auction"), ("enforcement", "moj_enforcement"),
                                                           ("branch", "moj_enforcement_cms"), ("sale", "shwoo"))}
    return pages.select("notice_id", *[F.size(v).cast("bigint").alias(k) for k, v in found.items()], F.get(found["seized"], F.lit(0)).alias("first_seized"))


# --- feeds, manifests, matching ------------------------------------------------------------------
def feed_rows(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT place_text AS `機關名稱`, 'Ｃ-' || CAST(who AS STRING) AS `標案案號`, CAST(n AS STRING) AS `公告次數`,
        CASE WHEN cond = 5 THEN '' ELSE '標售' || noun END AS `財物名稱`, slash_date AS `公告日期`, notice_id AS arrival FROM notices""")
    return feeds.feed_items(rows)


FEED = """
kept AS (SELECT *, 'open-data-' || substr(sha256(place_text || chr(0) || 'C-' || who || chr(0) || n), 1, 24) AS source_record_id FROM notices
  WHERE cond <> 5 AND kind IN (0, 1, 2, 4, 5, 6, 10)),
feed AS (SELECT source_record_id, place_text AS organization, 'C-' || who AS case_number, CAST(n AS VARCHAR) AS announcement_count, arg_max('標售' || noun, notice_id) AS title,
  arg_max(slash_date, notice_id) AS announcement_date FROM kept GROUP BY 1, 2, 3, 4)"""


@query("feed_items", with_notices("SELECT * FROM feed", FEED))
def feed_items(spark, sf_dir):
    return feed_rows(spark, sf_dir)


@query("feed_match", with_notices("""
SELECT source_record_id, CASE WHEN m = 1 THEN 'ok' ELSE 'expected one match, found ' || m END AS outcome
FROM (SELECT f.source_record_id, count(c.notice_id) AS m FROM feed f LEFT JOIN notices c ON c.place_text = f.organization AND 'C-' || c.who = f.case_number
  AND CAST(c.n AS VARCHAR) = f.announcement_count AND '標售' || c.noun = f.title AND c.slash_date = f.announcement_date AND c.reg <> 4 GROUP BY 1) x""", FEED))
def feed_match(spark, sf_dir):
    from noticelake.functions.dates import normalized_yyyymmdd

    keys = ["organization", "case_number", "announcement_count", "title", "day_key"]
    left = feed_rows(spark, sf_dir).withColumn("day_key", normalized_yyyymmdd(c("announcement_date")))
    right = notices(spark, sf_dir, """SELECT place_text AS organization, 'C-' || CAST(who AS STRING) AS case_number, CAST(n AS STRING) AS announcement_count, '標售' || noun AS title,
        date_format(day, 'yyyyMMdd') AS day_key, 'https://web.pcc.gov.tw/' || CAST(notice_id AS STRING) AS official_url FROM notices WHERE reg <> 4""")
    matched, unmatched = identity.match_exactly_one(left, right, keys, ["official_url"])
    return matched.select("source_record_id", F.lit("ok").alias("outcome")).unionByName(unmatched.select("source_record_id", c("error").alias("outcome")))


@query("court_items", with_notices("""
SELECT CAST(CAST(floor(notice_id / 2) AS BIGINT) AS VARCHAR) AS source_record_id, arg_max(noun, notice_id) AS title,
  'https://aomp109.judicial.gov.tw/judbp/wkw/WHD1A02/DO_VIEWPDF.htm?filenm=%2Fa%2F' || arg_max(notice_id, notice_id) || '.pdf' AS official_url
FROM notices WHERE cond <> 5 GROUP BY floor(notice_id / 2)"""))
def court_items(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT CAST(floor(notice_id / 20) AS BIGINT) AS arrival, notice_id, to_json(named_struct('rowid', CAST(floor(notice_id / 2) AS BIGINT), 'filenm',
        CASE WHEN cond = 5 THEN '' ELSE '/a/' || CAST(notice_id AS STRING) || '.pdf' END, 'ttitle', noun)) AS row FROM notices""")
    grouped = rows.groupBy("arrival").agg(F.array_sort(F.collect_list(F.struct("notice_id", "row"))).alias("rows"))
    joined = F.array_join(F.transform("rows", lambda r: r["row"]), ",")
    payloads = grouped.select("arrival", F.concat(F.lit('{"total":"x","count":20,"data":[],"rows":['), joined, F.lit("]}")).alias("content"))
    return feeds.court_items(payloads).select("source_record_id", "title", "official_url")


@query("result_totals", with_notices("""
SELECT CAST(floor(notice_id / 20) AS BIGINT) AS arrival, CASE WHEN floor(notice_id / 20) % 2 = 0 THEN 77 ELSE CAST(count(*) AS INTEGER) END AS total FROM notices GROUP BY 1,
  floor(notice_id / 20)"""))
def result_totals(spark, sf_dir):
    rows = notices(spark, sf_dir, "SELECT CAST(floor(notice_id / 20) AS BIGINT) AS arrival, to_json(named_struct('rowid', notice_id)) AS row FROM notices")
    grouped = rows.groupBy("arrival").agg(F.array_join(F.collect_list("row"), ",").alias("joined"))
    head = F.when(c("arrival") % 2 == 0, '{"total":"n/a","totalCount":77,"result":[').otherwise('{"result":[')
    return grouped.select("arrival", feeds.result_total(F.concat(head, c("joined"), F.lit("]}"))).alias("total"))


@query("manifest_enforcement", with_notices("""
SELECT CASE WHEN n <= 2 THEN CAST(notice_id AS VARCHAR) END AS source_record_id, 'https://www.tpkonsale.moj.gov.tw/Detail/' || CASE n WHEN 3 THEN 'Other' ELSE 'Chattel' END || '?NO=' || notice_id AS official_url,
  CASE n WHEN 3 THEN 'not an official detail link' WHEN 4 THEN 'title is missing' END AS error FROM notices"""))
def manifest_enforcement(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT 'https://www.tpkonsale.moj.gov.tw/Detail/' || CASE n WHEN 3 THEN 'Other' ELSE 'Chattel' END || '?NO=' || CAST(notice_id AS STRING) AS official_url,
        CASE n WHEN 4 THEN ' ' ELSE noun END AS title, place_text AS organization, CAST(n AS STRING) AS auction_round FROM notices""")
    valid, rejected = manifests.split_manifest(rows, "enforcement")
    return valid.select("source_record_id", "official_url", F.lit(None).cast("string").alias("error")).unionByName(
        rejected.select(F.lit(None).cast("string").alias("source_record_id"), "official_url", "error"))


@query("manifest_court", with_notices("""
SELECT CASE n WHEN 1 THEN CAST(notice_id AS VARCHAR) WHEN 2 THEN 'manual-' || substr(sha256('/a/' || notice_id || '.PDF'), 1, 24) END AS source_record_id,
  CASE n WHEN 3 THEN 'not an official document link' WHEN 4 THEN 'missing official fields: crm, ttitle' END AS error, count(*) AS row_count FROM notices GROUP BY 1, 2"""))
def manifest_court(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT 'https://aomp109.judicial.gov.tw/judbp/wkw/WHD1A02/DO_VIEWPDF.htm?filenm=%2Fa%2F' || CAST(notice_id AS STRING) || CASE n WHEN 3 THEN '.txt' ELSE '.PDF' END
        AS official_url, CASE n WHEN 1 THEN CAST(notice_id AS STRING) END AS source_record_id, place_text AS crtnm, CASE n WHEN 4 THEN '' ELSE 'x' END AS crm, slash_date AS saledate,
        '1' AS saleno, CASE WHEN n < 4 THEN noun END AS ttitle FROM notices""")
    for name in manifests.COURT_FIELDS:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    valid, rejected = manifests.split_manifest(rows, "court")
    both = valid.select("source_record_id", F.lit(None).cast("string").alias("error")).unionByName(
        rejected.select(F.lit(None).cast("string").alias("source_record_id"), "error"))
    return both.groupBy("source_record_id", "error").agg(F.count(F.lit(1)).alias("row_count"))


@query("sitemap_check", with_notices("SELECT notice_id, n <> 2 AS sitemap_ok FROM notices"))
def sitemap_check(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, '<urlset><url><loc> http' || CASE n WHEN 2 THEN '' ELSE 's' END || '://www.tpy.moj.gov.tw/' || CAST(notice_id AS STRING)
        || '</loc></url></urlset>' AS content FROM notices""")
    return feeds.sitemap_ok(rows, "www.tpy.moj.gov.tw").select("notice_id", "sitemap_ok")
