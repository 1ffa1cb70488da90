"""Text, date, classification, fact and redaction functions over derived notice sentences.

The oracles state the expected answer from the keys a sentence was built from, so they
share no pattern with the functions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from noticelake.functions import classify, dates, facts, redact, text, urls
from noticelake.functions.mentions import plates_for_type

from .derive import AS_OF, notices, with_notices
from .registry import Registry

c = F.col
query = Registry()


def stamp(column, name: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name)


LOT_TEXT = "'拍賣' || noun || CAST(n AS STRING) || '輛，過戶前應繳清汽車燃料使用費。'"


@query("classify_notices", with_notices("""
SELECT notice_id,
  CASE kind WHEN 0 THEN 'ORDINARY_LIGHT' WHEN 1 THEN 'ORDINARY_HEAVY' WHEN 2 THEN 'LARGE_HEAVY' WHEN 3 THEN 'LARGE_HEAVY'
    WHEN 4 THEN 'ELECTRIC_MOTORCYCLE' WHEN 5 THEN 'HEAVY_UNSPECIFIED' ELSE 'UNKNOWN' END AS vehicle_class,
  CASE WHEN kind <= 5 THEN noun END AS class_text,
  CASE WHEN kind <= 6 THEN 'MOTORCYCLE' WHEN kind <= 9 THEN 'CAR' WHEN kind = 10 THEN 'MIXED' ELSE 'UNKNOWN' END AS vehicle_type,
  CASE WHEN kind <= 10 THEN noun END AS type_text,
  CASE kind WHEN 7 THEN 'PASSENGER' WHEN 8 THEN 'TRUCK' WHEN 9 THEN 'SUV' ELSE 'UNKNOWN' END AS car_category,
  CASE WHEN kind BETWEEN 7 AND 9 THEN noun END AS category_text
FROM notices"""))
def classify_notices(spark, sf_dir):
    lots = notices(spark, sf_dir, f"SELECT notice_id, {LOT_TEXT} AS lot FROM notices")
    found = lots.select(
        "notice_id", classify.vehicle_class(c("lot")).alias("a"), classify.vehicle_type(c("lot")).alias("b"),
        classify.car_category(c("lot")).alias("k"))
    return found.select(
        "notice_id", c("a.value").alias("vehicle_class"), c("a.text").alias("class_text"), c("b.value").alias("vehicle_type"),
        c("b.text").alias("type_text"), c("k.value").alias("car_category"), c("k.text").alias("category_text"))


@query("amounts", with_notices(
    "SELECT notice_id, price AS worded, price AS plain, price AS grouped, CAST(NULL AS BIGINT) AS absent, price % 1000 AS wide FROM notices"))
def amounts(spark, sf_dir):
    rows = notices(spark, sf_dir, "SELECT notice_id, amount_text, price FROM notices")
    wide = F.translate((c("price") % 1000).cast("string"), "0123456789", text.FULL_WIDTH_DIGITS)
    return rows.select(
        "notice_id", text.amount(c("amount_text")).alias("worded"),
        text.amount(F.concat(F.lit("新臺幣"), c("price").cast("string"), F.lit("元整"))).alias("plain"),
        text.amount(F.concat(F.lit("底價 "), F.format_number("price", 0), F.lit(" 元"))).alias("grouped"),
        text.amount(F.lit("價格，未公開")).alias("absent"), text.amount(wide).alias("wide"))


@query("official_dates", with_notices("""
SELECT notice_id, strftime(d + INTERVAL 10 HOUR + INTERVAL 30 MINUTE - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS slash,
  strftime(d - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS compact, strftime(d - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS listed,
  strftime(d + to_hours(hour24) + to_minutes(minute60) - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS worded,
  strftime(d - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS western, CAST(NULL AS VARCHAR) AS impossible, strftime(d, '%Y%m%d') AS digits
FROM (SELECT *, date_trunc('day', day) AS d FROM notices) x"""))
def official_dates(spark, sf_dir):
    rows = notices(spark, sf_dir, "SELECT notice_id, slash_date, worded_date, day FROM notices")
    roc = F.replace(c("slash_date"), F.lit("/"), F.lit(""))
    return rows.select(
        "notice_id", stamp(dates.roc_datetime(F.concat(F.lit("截止 "), c("slash_date"), F.lit(" 10:30"))), "slash"),
        stamp(dates.roc_compact_date(roc), "compact"),
        stamp(dates.roc_list_date(F.replace(c("slash_date"), F.lit("/"), F.lit("-"))), "listed"),
        stamp(dates.official_datetime(F.concat(F.lit("拍賣時間：中華民國"), c("worded_date"))), "worded"),
        stamp(dates.roc_datetime(F.date_format("day", "yyyy/MM/dd")), "western"),
        stamp(dates.roc_datetime(F.concat(F.split("slash_date", "/")[0], F.lit("/13/40"))), "impossible"),
        dates.normalized_yyyymmdd(c("slash_date")).alias("digits"))


@query("four_state_facts", with_notices("""
SELECT notice_id, CASE cond WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'NO' ELSE 'UNKNOWN' END AS has_key,
  CASE cond WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 3 THEN 'NO' WHEN 4 THEN 'NO' ELSE 'UNKNOWN' END AS can_start,
  CASE cond WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 3 THEN 'NO' WHEN 4 THEN 'YES' ELSE 'UNKNOWN' END AS can_test,
  CASE cond WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'CONFLICTING' ELSE 'UNKNOWN' END AS key_conflict,
  CASE cond WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 3 THEN 'NO' WHEN 4 THEN 'CONFLICTING' ELSE 'UNKNOWN' END AS start_conflict,
  CASE reg WHEN 0 THEN 'NO' WHEN 1 THEN 'CONFLICTING' WHEN 2 THEN 'YES' ELSE 'UNKNOWN' END AS tax
FROM notices"""))
def four_state_facts(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, cond_text AS t, CASE reg WHEN 0 THEN '無欠稅' WHEN 1 THEN '無欠稅；另載有欠稅'
        WHEN 2 THEN '欠稅未繳' ELSE '' END AS tax FROM notices""")
    t = c("t")
    return rows.select(
        "notice_id", facts.four_state(t, facts.KEY_PLAIN).alias("has_key"), facts.four_state(t, facts.START).alias("can_start"),
        facts.four_state(t, facts.TEST).alias("can_test"), facts.four_state_or_conflict(t, facts.KEY_PLAIN).alias("key_conflict"),
        facts.four_state_or_conflict(t, facts.START).alias("start_conflict"), facts.four_state_or_conflict(c("tax"), facts.TAX).alias("tax"))


@query("eligibility_registration", with_notices("""
SELECT notice_id, CASE reg WHEN 0 THEN 'RE_REGISTRATION_REQUIRED' WHEN 1 THEN 'SCRAP_ONLY' WHEN 2 THEN 'NORMAL_TRANSFER'
    WHEN 3 THEN 'RE_REGISTRATION_REQUIRED' ELSE 'UNKNOWN' END AS seized,
  CASE reg WHEN 1 THEN 'SCRAP_ONLY' WHEN 2 THEN 'NORMAL_TRANSFER' WHEN 3 THEN 'RE_REGISTRATION_REQUIRED' ELSE 'UNKNOWN' END AS enforcement,
  CASE reg WHEN 0 THEN 'RE_REGISTRATION_REQUIRED' WHEN 1 THEN 'SCRAP_ONLY' ELSE 'REGISTRABILITY_UNKNOWN' END AS procurement,
  CASE reg WHEN 0 THEN 'RE_REGISTRATION_REQUIRED' WHEN 1 THEN 'SCRAP_ONLY' ELSE 'UNKNOWN' END AS sale,
  CASE elig WHEN 0 THEN 'LICENSED_RECYCLER_ONLY' WHEN 1 THEN 'NATURAL_PERSON_ALLOWED' ELSE 'UNKNOWN' END AS bid_seized,
  CASE elig WHEN 2 THEN 'BUSINESS_ONLY' WHEN 3 THEN 'UNKNOWN' ELSE 'SPECIAL_QUALIFICATION' END AS bid_procurement,
  CASE elig WHEN 1 THEN 'NATURAL_PERSON_ALLOWED' ELSE 'UNKNOWN' END AS bid_customs,
  CASE WHEN n = 1 THEN 'LICENSED_RECYCLER_ONLY' ELSE 'NATURAL_PERSON_ALLOWED' END AS bid_sale
FROM notices"""))
def eligibility_registration(spark, sf_dir):
    rows = notices(spark, sf_dir, "SELECT notice_id, reg_text AS r, elig_text AS e, n FROM notices")
    return rows.select(
        "notice_id", facts.registration_seized(c("r")).alias("seized"), facts.registration_enforcement(c("r")).alias("enforcement"),
        facts.registration_procurement(c("r")).alias("procurement"), facts.registration_sale(c("r")).alias("sale"),
        facts.eligibility_seized(c("e")).alias("bid_seized"), facts.eligibility_procurement(c("e")).alias("bid_procurement"),
        facts.eligibility_customs(c("e")).alias("bid_customs"), facts.eligibility_sale(c("e"), c("n") == 1).alias("bid_sale"))


@query("status_origin", with_notices(f"""
SELECT notice_id, CASE WHEN state = 'F' THEN 'SOLD' WHEN d < TIMESTAMP '{AS_OF}' THEN 'EXPIRED' WHEN kind < 11 THEN 'SCHEDULED' ELSE 'ANNOUNCED' END AS seized,
  CASE WHEN kind < 11 AND d < TIMESTAMP '{AS_OF}' THEN 'EXPIRED' ELSE 'SCHEDULED' END AS scheduled,
  CASE WHEN state = 'P' THEN 'CANCELLED' WHEN state = 'F' THEN 'SOLD' WHEN d < TIMESTAMP '{AS_OF}' THEN 'EXPIRED' WHEN kind < 11 THEN 'SCHEDULED'
    ELSE 'ANNOUNCED' END AS customs,
  CASE WHEN n = 1 THEN 'IMPOUNDED_UNCLAIMED' WHEN n = 2 THEN 'CRIMINAL_SEIZURE_OR_FORFEITURE' WHEN place = 5 THEN 'CUSTOMS_FORFEITURE'
    WHEN n = 3 AND kind IN (6, 10) THEN 'SCRAP_DISPOSAL' ELSE 'PUBLIC_ASSET_DISPOSAL' END AS origin
FROM (SELECT *, CASE WHEN kind < 11 THEN day END AS d FROM notices) x"""))
def status_origin(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, CASE WHEN kind < 11 THEN day END AS d,
        CASE state WHEN 'F' THEN '本件已拍賣完畢，得標結果如下' WHEN 'P' THEN '取消標售' ELSE '' END AS t,
        CASE n WHEN 1 THEN '逾期未領回' WHEN 2 THEN '沒收' WHEN 3 THEN '報廢' ELSE '' END || noun AS lot,
        CASE place WHEN 5 THEN '財政部高雄海關' ELSE place_text END AS org FROM notices""")
    now, ends = dates.instant(AS_OF), c("d").cast("timestamp")
    return rows.select(
        "notice_id", facts.status_seized(c("t"), ends, now).alias("seized"), facts.status_scheduled(ends, now).alias("scheduled"),
        facts.status_customs(c("t"), ends, now).alias("customs"), facts.origin_procurement(c("lot"), c("org")).alias("origin"))


@query("county", with_notices("""
SELECT notice_id, CASE place WHEN 0 THEN '臺中市' WHEN 1 THEN '新竹縣' WHEN 2 THEN '臺北市' WHEN 3 THEN '臺北市' WHEN 4 THEN '高雄市'
  WHEN 5 THEN '高雄市' WHEN 7 THEN '花蓮縣' END AS county, CASE place WHEN 1 THEN '新竹縣' WHEN 2 THEN '台北市' WHEN 7 THEN '花蓮縣' END AS prefix,
  CASE place WHEN 0 THEN '臺灣臺' WHEN 1 THEN '新竹縣' WHEN 2 THEN '台北市' WHEN 3 THEN '臺灣士' WHEN 4 THEN '臺灣橋' WHEN 5 THEN '高雄港'
  WHEN 6 THEN '中央保' ELSE '花蓮縣' END AS jurisdiction FROM notices"""))
def county(spark, sf_dir):
    return notices(spark, sf_dir, "SELECT notice_id, place_text AS p FROM notices").select(
        "notice_id", classify.county(c("p")).alias("county"), classify.county_prefix(c("p")).alias("prefix"),
        facts.jurisdiction(c("p")).alias("jurisdiction"))


@query("plates_masked", with_notices("""
SELECT notice_id, plate AS plates, replace(plate, '-', '') AS normalized, substr(plate, 1, 5) || '***' AS masked,
  substr(plate, 1, 5) || '*** 等 ' || n || ' 面' AS masked_text, 'AB-*' || '*、' || substr(plate, 1, 5) || '***' AS masked_list FROM notices"""))
def plates_masked(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, plate, n, '日期 12-34，牌照 ' || plate || '，車號' || lower(replace(plate, '-', '－'))
        || '，共' || CAST(n AS STRING) || '面' AS t FROM notices""")
    plates = facts.plates(c("t"))
    return rows.select(
        "notice_id", F.array_join(plates, ",").alias("plates"), text.normalize_identifier(c("plate")).alias("normalized"),
        redact.mask_plate(c("plate")).alias("masked"),
        redact.mask_plate(F.concat(c("plate"), F.lit(" 等 "), c("n").cast("string"), F.lit(" 面"))).alias("masked_text"),
        redact.mask_plate_list(F.concat(F.lit("AB-12、A、"), c("plate"))).alias("masked_list"))


@query("vehicle_identity", with_notices("""
SELECT notice_id, CASE kind % 4 WHEN 0 THEN 'KYMCO' WHEN 1 THEN 'YAMAHA' WHEN 2 THEN '鈴木牌' ELSE 'HONDA' END AS brand, 'M' || who AS model,
  CAST(year(day) AS INTEGER) AS manufacture_year, CAST(month(day) AS INTEGER) AS manufacture_month, CAST(n * 50 AS INTEGER) AS displacement_cc,
  '白色' AS color, plate AS plates FROM notices"""))
def vehicle_identity(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, CASE kind % 4 WHEN 0 THEN '廠牌：光陽，' WHEN 1 THEN '廠商：台灣山葉，' WHEN 2 THEN '廠牌名稱：鈴木牌；'
        ELSE 'Honda 機車，' END || '型式： M' || CAST(who AS STRING) || '、排氣量：' || CAST(n * 50 AS STRING) || 'cc，出廠年月：'
        || CAST(year(day) - 1911 AS STRING) || '年' || CAST(month(day) AS STRING) || '月，車色:白色。車牌 ' || plate AS t FROM notices""")
    found = facts.vehicle_identity(c("t"))
    return rows.select("notice_id", *[e.alias(k) for k, e in found.items() if k != "plates"],
                       F.array_join(found["plates"], ",").alias("plates"))


@query("sentences_labels", with_notices("""
SELECT notice_id, '開標日期及地點：' || worded_date AS sentence, CAST(NULL AS VARCHAR) AS none, plate AS label, '手續費 100 元,拖吊費 ' || n AS fees,
  'notice:' || notice_id AS token_text FROM notices"""))
def sentences_labels(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, '公告。 開標日期及地點：' || worded_date || '；標號： ' || plate || '，其他。手續費 100 元。拖吊費 '
        || CAST(n AS STRING) || '。手續費 100 元' AS t FROM notices""")
    return rows.select(
        "notice_id", text.fact_sentence(c("t"), "開標日期").alias("sentence"), text.fact_sentence(c("t"), "不存在").alias("none"),
        text.label_value(c("t"), ["案號", "標號"]).alias("label"),
        F.array_join(text.distinct_sentences(c("t"), "手續費|拖吊費"), ",").alias("fees"),
        F.array_join(text.tokens(F.concat(F.lit("Notice NOTICE "), c("notice_id").cast("string"))), ":").alias("token_text"))


@query("plates_by_mention", with_notices("""
SELECT notice_id, 'MOT-1111' || CASE WHEN n = 1 THEN ',' || plate ELSE '' END AS motorcycle, 'CAR-2222' || CASE WHEN n = 2 THEN ',' || plate ELSE '' END AS car,
  'MOT-1111,CAR-2222,' || plate AS mixed FROM notices"""))
def plates_by_mention(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, '機車一輛車號MOT-1111' || repeat('甲', 120) || '小客車一輛車號CAR-2222' || repeat('乙', 120)
        || CASE n WHEN 1 THEN '重機' WHEN 2 THEN '轎車' ELSE '' END || '另案' || plate AS t FROM notices""")
    rows = rows.withColumn("plates", facts.plates(c("t")))

    def kept(kind: str):
        return F.array_join(plates_for_type(c("t"), c("plates"), F.lit(kind)), ",")

    return rows.select("notice_id", kept("MOTORCYCLE").alias("motorcycle"), kept("CAR").alias("car"), kept("MIXED").alias("mixed"))


@query("lot_sizes", with_notices("""
SELECT notice_id, CAST(CASE WHEN kind = 11 THEN 2 ELSE n END AS INTEGER) AS first_count, CAST(CASE WHEN kind = 11 THEN 2 ELSE n + 2 END AS INTEGER) AS summed,
  CAST(n AS INTEGER) AS ahead FROM notices"""))
def lot_sizes(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, noun || CAST(n AS STRING) || '輛、汽車2臺' AS t, CAST(n AS STRING) || '部報廢汽車' AS a, kind FROM notices""")
    counts = facts.counts_before_or_after(c("t"), "(?:機車|重機|小客車|小貨車|休旅車|汽車)")
    none = F.array().cast("array<string>")
    return rows.select(
        "notice_id", facts.lot_size_seized(counts, F.lit(False), none).alias("first_count"),
        facts.lot_size_seized(counts, F.lit(True), none).alias("summed"),
        facts.lot_size_seized(facts.counts_before_or_after(c("a"), "汽車"), F.lit(False), none).alias("ahead"))


@query("prices_rounds", with_notices("""
SELECT notice_id, price AS reserve, price + 7 AS sold, CAST(n AS INTEGER) AS round, CAST(who AS INTEGER) AS mileage, price AS bid FROM notices"""))
def prices_rounds(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, '第 ' || CAST(n AS STRING) || ' 拍，核定底價新臺幣' || CAST(price AS STRING) || '元，拍定金額：'
        || CAST(price + 7 AS STRING) || '元。里程：' || CAST(who AS STRING) || ' km，目前出價 ' || CAST(price AS STRING) || ' 元' AS t FROM notices""")
    t = c("t")
    return rows.select(
        "notice_id", facts.money_after(t, "(?:核定)?底價").alias("reserve"), facts.money_after(t, "拍定金額|拍定價格").alias("sold"),
        facts.auction_round(t).alias("round"), facts.mileage(t, "里程數|里程").alias("mileage"), facts.money_before_yuan(t, "目前出價").alias("bid"))


@query("case_numbers", with_notices("""
SELECT notice_id, CASE WHEN n = 1 THEN 'PCC-' || notice_id ELSE '115年' || who || '號' END AS case_number,
  'open-data-' || substr(sha256(place_text || chr(0) || who || chr(0) || n), 1, 24) AS feed_id FROM notices"""))
def case_numbers(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, place_text, CAST(who AS STRING) AS who, CAST(n AS STRING) AS n,
        CASE WHEN n > 1 THEN '115年' || CAST(who AS STRING) || '號' END AS stated FROM notices""")
    return rows.select(
        "notice_id", facts.case_number_or_default(c("stated"), F.lit("pcc"), c("notice_id").cast("string")).alias("case_number"),
        text.feed_record_id(c("place_text"), c("who"), c("n")).alias("feed_id"))


@query("relevance", with_notices("""
SELECT notice_id, n <> 4 AND kind IN (0, 1, 2, 4, 5, 6, 10) AS procurement, kind <> 11 AND n <> 4 AS central, kind <> 11 AND n <> 2 AS branch,
  CASE WHEN n = 3 THEN '標售公務車' END AS generic FROM notices"""))
def relevance(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, noun || CASE n WHEN 4 THEN '（廢電力機車）' ELSE '' END AS title,
        noun || CASE n WHEN 2 THEN '報廢' ELSE '拍賣' END AS branch, CASE n WHEN 3 THEN '公告標售公務車一批' WHEN 1 THEN '標售作廢車輛通行證及車輛貼紙' ELSE '公告' END AS g
        FROM notices""")
    return rows.select(
        "notice_id", facts.is_procurement_vehicle(c("title")).alias("procurement"), facts.is_central_list_vehicle(c("title")).alias("central"),
        facts.is_vehicle_auction(c("branch")).alias("branch"), facts.generic_vehicle_evidence(c("g")).alias("generic"))


@query("legacy_backfill", with_notices("""
SELECT notice_id, CASE kind WHEN 0 THEN 'ORDINARY_LIGHT' WHEN 1 THEN 'ORDINARY_HEAVY' WHEN 2 THEN 'LARGE_HEAVY' WHEN 4 THEN 'ELECTRIC_MOTORCYCLE'
    WHEN 5 THEN 'HEAVY_UNSPECIFIED' ELSE 'UNKNOWN' END AS vehicle_class,
  CASE WHEN kind IN (0, 1, 2, 4, 5) THEN 'MOTORCYCLE' ELSE 'UNKNOWN' END AS vehicle_type FROM notices"""))
def legacy_backfill(spark, sf_dir):
    rows = notices(spark, sf_dir, "SELECT notice_id, noun FROM notices").withColumn("vehicle_class", classify.class_of_legacy_text(c("noun")))
    return rows.select("notice_id", "vehicle_class", classify.type_from_class(F.lit("UNKNOWN"), c("vehicle_class")).alias("vehicle_type"))


@query("clean_normalize", with_notices("""
SELECT notice_id, 'A ' || who || ' B' AS cleaned, 'ABC' || who || ' 車' AS folded, '機車 x ' || who AS term FROM notices"""))
def clean_normalize(spark, sf_dir):
    rows = notices(spark, sf_dir, "SELECT notice_id, CAST(who AS STRING) AS w FROM notices")
    return rows.select(
        "notice_id", text.clean(F.concat(F.lit("　A \n"), c("w"), F.lit("\t　B "))).alias("cleaned"),
        text.nfkc_clean(F.concat(F.lit("ＡＢＣ"), c("w"), F.lit("　⾞"))).alias("folded"),
        text.safe_search_term(F.concat(F.lit(" 機車%(x),"), c("w"))).alias("term"))


@query("sanitize_notices", with_notices("""
SELECT notice_id, '牌照' || substr(plate, 1, 5) || '***，引擎車輛識別碼已隱藏，電話聯絡電話已隱藏，信箱 聯絡信箱已隱藏，車主：已隱去，證號身分證字號已隱去。' AS public_text,
  '[已移除身分證字號] 車主：[已移除姓名]' AS private_text, n = 1 AS leaks FROM notices"""))
def sanitize_notices(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, plate, n, 'ENG' || CAST(10000 + who AS STRING) AS engine,
        '牌照' || lower(plate) || '，引擎ENG' || CAST(10000 + who AS STRING) || '，電話0912-' || CAST(100 + who % 900 AS STRING) || '-456，信箱 a'
        || CAST(who AS STRING) || '@mail.tw，車主王小明，證號A1' || CAST(10000000 + who AS STRING) || '。' AS t,
        'A1' || CAST(10000000 + who AS STRING) || '　車主：王小明' AS p,
        CASE n WHEN 1 THEN 'x-A1' || CAST(10000000 + who AS STRING) ELSE 'x-' || CAST(who AS STRING) END AS record FROM notices""")
    ids = F.array(
        F.struct(F.lit("PLATE").alias("type"), c("plate").alias("value")), F.struct(F.lit("ENGINE").alias("type"), c("engine").alias("value")))
    return rows.select(
        "notice_id", redact.sanitize(c("t"), redact.replacements(ids)).alias("public_text"), redact.redact_private(c("p")).alias("private_text"),
        redact.leaks(c("record")).alias("leaks"))


@query("record_id_redaction", with_notices("""
SELECT notice_id, CASE WHEN n = 1 THEN 'redacted-' || substr(sha256('pcc' || chr(0) || plate || '-' || who), 1, 20) ELSE CAST(who AS VARCHAR) END AS public_id,
  substr(sha256(plate), 1, 2) || '/' || sha256(plate) || CASE WHEN n = 1 THEN '.html' WHEN n = 2 THEN '.pdf' WHEN n = 3 THEN '.jpg' ELSE '.bin' END AS path
FROM notices"""))
def record_id_redaction(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, plate, CASE n WHEN 1 THEN plate || '-' || CAST(who AS STRING) ELSE CAST(who AS STRING) END AS record,
        CASE n WHEN 1 THEN 'text/html' WHEN 2 THEN 'application/pdf' WHEN 3 THEN 'image/jpeg' ELSE 'x/y' END AS mime FROM notices""")
    ids = F.array(F.struct(F.lit("PLATE").alias("type"), c("plate").alias("value")))
    return rows.select("notice_id", redact.redacted_record_id(F.lit("pcc"), c("record"), ids).alias("public_id"),
                       text.content_path(F.sha2("plate", 256), c("mime")).alias("path"))


@query("plate_clearing", with_notices(f"""
SELECT notice_id, CASE WHEN kind < 11 AND day >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY THEN plate END AS plate_number FROM notices"""))
def plate_clearing(spark, sf_dir):
    from noticelake.operators.retention import clear_expired_plates

    rows = notices(spark, sf_dir, "SELECT notice_id, plate AS plate_number, CASE WHEN kind < 11 THEN day END AS ends_at FROM notices")
    return clear_expired_plates(rows, AS_OF).select("notice_id", "plate_number")


@query("url_shapes", with_notices("""
SELECT notice_id, n = 1 AS registered, n IN (1, 3) AS government, CASE n WHEN 2 THEN 'h.example.tw' WHEN 3 THEN 'x.gov.taipei' ELSE 'web.customs.gov.tw' END AS host,
  'https://web.customs.gov.tw/t/p?cntId=' || who AS joined FROM notices"""))
def url_shapes(spark, sf_dir):
    rows = notices(spark, sf_dir, """SELECT notice_id, CASE n WHEN 1 THEN 'https://web.customs.gov.tw/a?x=' WHEN 2 THEN 'http://h.example.tw:80/a?x='
        WHEN 3 THEN 'https://X.gov.taipei/b?x=' ELSE 'https://user@web.customs.gov.tw/%64ownload/?x=' END || CAST(who AS STRING) AS u,
        '../p?cntId=' || CAST(who AS STRING) AS ref, n FROM notices""")
    return rows.select(
        "notice_id", urls.is_registered(c("u"), ["web.customs.gov.tw"], ("/download/",)).alias("registered"),
        (urls.is_government(c("u")) & urls.has_no_credentials(c("u"))).alias("government"), urls.host(c("u")).alias("host"),
        urls.join_url(F.lit("https://web.customs.gov.tw/t/list/572"), c("ref")).alias("joined"))
