from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticelake.functions import classify, dates, facts, redact, text, urls


def test_clean_collapses_unicode_space(evaluate):
    assert evaluate(text.clean, ["a　 b\n c ", None, " "]) == ["a b c", "", ""]


def test_nfkc_folds_width_and_radical(evaluate):
    assert evaluate(text.nfkc_clean, ["ＡＢ１２　⾞", None]) == ["AB12 車", ""]


def test_slash_dates(evaluate):
    got = evaluate(dates.roc_datetime, ["115/08/12 12:00:00", "公告115/8/3", "2026/08/20 10:30", "115/13/40", "無", "１１５/０８/１２"])
    assert got == [datetime(2026, 8, 12, 4), datetime(2026, 8, 2, 16), datetime(2026, 8, 20, 2, 30), None, None,
                   datetime(2026, 8, 11, 16)]


def test_compact_and_list_dates(evaluate):
    assert evaluate(dates.roc_compact_date, ["1150819", "990101", "11508", "1159999"]) == [
        datetime(2026, 8, 18, 16), datetime(2009, 12, 31, 16), None, None]
    assert evaluate(dates.roc_list_date, ["115-07-27", "115.7.27 x", "abc"]) == [
        datetime(2026, 7, 26, 16), datetime(2026, 7, 26, 16), None]
    assert evaluate(dates.normalized_yyyymmdd, ["115/8/3", "20260803", "x1", None]) == ["20260803", "20260803", "1", ""]


def test_official_datetime(evaluate):
    got = evaluate(dates.official_datetime, [
        "拍賣時間：中華民國115年8月20日上午10時30分", "115年8月20日下午2時", "115年8月20日上午12時5分", "115年8月25日）普通", "115/08/12 09:00", "x"])
    assert got == [datetime(2026, 8, 20, 2, 30), datetime(2026, 8, 20, 6), datetime(2026, 8, 19, 16, 5),
                   datetime(2026, 8, 24, 16), datetime(2026, 8, 12, 1), None]


def test_amounts(evaluate):
    assert evaluate(text.amount, ["新臺幣2,500元整", "1萬6千元", "12萬元", "1萬6,000元", ",", "免", None, "１萬元", "2億3萬"]) == [
        2500, 16000, 120000, 16000, None, None, None, 10000, 200030000]


def test_classes(evaluate):
    texts = ["普通輕型機車一輛", "普通重型機車一輛", "大型重型機車一輛", "大型重機一部", "電動機車一輛", "重型機車一輛", "排氣量 124cc 機車一輛"]
    assert evaluate(lambda c: classify.vehicle_class(c)["value"], texts) == [
        "ORDINARY_LIGHT", "ORDINARY_HEAVY", "LARGE_HEAVY", "LARGE_HEAVY", "ELECTRIC_MOTORCYCLE", "HEAVY_UNSPECIFIED", "UNKNOWN"]


def test_types_and_categories(evaluate):
    texts = ["普通重型機車一輛", "自用小客車一輛", "汽車一輛、機車一輛", "報廢汽、機車及報廢財產一批", "機車過戶前應繳清汽車燃料使用費", "冰箱"]
    assert evaluate(lambda c: classify.vehicle_type(c)["value"], texts) == [
        "MOTORCYCLE", "CAR", "MIXED", "MIXED", "MOTORCYCLE", "UNKNOWN"]
    assert evaluate(lambda c: classify.car_category(c)["value"], ["自用小客車一輛", "大貨車一輛", "suv", "汽車", "機車"]) == [
        "PASSENGER", "TRUCK", "SUV", "OTHER", "UNKNOWN"]


def test_counties(evaluate):
    assert evaluate(classify.county, ["臺灣臺中地方法院", "新竹縣竹北市 臺灣新竹地方法院", "臺灣士林地方法院", "臺灣橋頭地方法院", "台北市", None]) == [
        "臺中市", "新竹縣", "臺北市", "高雄市", "臺北市", None]


def test_bands(evaluate):
    values = [50, 125, 126, 150, 151, 250, 251, 550, 551, None, 0]
    assert evaluate(classify.displacement_band, values, "int") == [
        "LE_125", "LE_125", "CC_126_150", "CC_126_150", "CC_151_250", "CC_151_250", "CC_251_550", "CC_251_550", "GT_550",
        "UNKNOWN", None]


def test_legacy_classes(evaluate):
    assert evaluate(classify.class_of_legacy_text, ["普通重型電動機車", "LARGE_HEAVY", "重機"]) == [
        "ELECTRIC_MOTORCYCLE", "LARGE_HEAVY", "UNKNOWN"]


def test_four_states_respect_negation(evaluate):
    assert evaluate(lambda c: facts.four_state(c, facts.START), ["不能發動", "可發動", "無"]) == ["NO", "YES", "UNKNOWN"]
    assert evaluate(lambda c: facts.four_state_or_conflict(c, facts.START), ["不能發動", "可發動；另載無法發動", "能發動"]) == [
        "NO", "CONFLICTING", "YES"]
    assert evaluate(lambda c: facts.four_state_or_conflict(c, facts.TEST), ["不可測試", "僅提供靜態功能測試，無法提供道路行駛測試"]) == [
        "NO", "YES"]


def test_registration(evaluate):
    assert evaluate(facts.registration_sale, ["不可再領牌", "已繳銷(可再領牌) 不可再領牌", "已繳銷(可再領牌)", "需檢驗", "無牌照", ""]) == [
        "SCRAP_ONLY", "REGISTRABILITY_UNKNOWN", "RE_REGISTRATION_REQUIRED", "INSPECTION_REQUIRED", "REGISTRABILITY_UNKNOWN",
        "UNKNOWN"]
    assert evaluate(facts.registration_procurement, ["不可再領牌", "可再領牌", "報廢機車", "x"]) == [
        "SCRAP_ONLY", "RE_REGISTRATION_REQUIRED", "SCRAP_ONLY", "REGISTRABILITY_UNKNOWN"]


def test_plates(evaluate):
    got = evaluate(facts.plates, ["車牌 abc－123、ABC-123", "日期 12-34", "車牌號碼：123-456", "XTST-3001Y"])
    assert got == [["ABC-123"], [], ["123-456"], []]


def test_mask_plate_golden(evaluate):
    values = ["ABC-123", "AB-12", "1234-AB", "ABC123", "ABC-123 等 2 面", "A", "AB-1", "AB-1234", "", "A1", "AB-12-3456"]
    assert evaluate(redact.mask_plate, values) == [
        "ABC-***", "AB-**", "1234-**", "ABC***", "ABC-*** 等 2 面", None, "A*-*", "AB-1***", None, "**", "AB-**-3456"]


def test_sanitize_hides_everything(evaluate):
    raw = "車主：王小明，電話 0912-345-678，信箱a@b.tw，A123456789，引擎號碼：ABC12345，RFGHM12VRBS017215"
    out = evaluate(redact.sanitize, [raw])[0]
    for secret in ("王小明", "0912", "a@b.tw", "A123456789", "ABC12345", "RFGHM12VRBS017215"):
        assert secret not in out
    assert evaluate(redact.sanitize, [out])[0] == out


def test_known_identifier_replacement(spark):
    row = spark.sql(r"""select '牌照 abc-123 與 XABC-123，引擎 E$1\\Q' as t,
        array(struct('PLATE' as type, 'ABC-123' as value), struct('ENGINE' as type, 'E$1\\Q' as value)) as ids""")
    got = row.select(redact.replace_known(F.col("t"), redact.replacements(F.col("ids")))).first()[0]
    assert got == "牌照 ABC-*** 與 XABC-123，引擎 車輛識別碼已隱藏"


def test_url_sanitize(evaluate):
    values = ["https://x.gov.tw/a?id=A123456789", "https://x.gov.tw/a?n=%E8%BB%8A%E4%B8%BB%E7%8E%8B%E5%B0%8F%E6%98%8E", "https://x.gov.tw/a?q=%zz"]
    assert evaluate(redact.sanitize_url, values) == ["https://x.gov.tw/", "https://x.gov.tw/", values[2]]


def test_url_shapes(evaluate):
    values = ["https://web.customs.gov.tw/a", "http://web.customs.gov.tw/a", "https://u@web.customs.gov.tw/a",
              "https://web.customs.gov.tw:8443/a", "https://web.customs.gov.tw:443/a", "https://web.customs.gov.tw/%64ownload/x", None]
    assert evaluate(lambda c: urls.is_registered(c, ["web.customs.gov.tw"], ("/download/",)), values) == [
        True, False, False, False, True, False, False]
    assert evaluate(lambda c: urls.is_government(c), ["https://a.gov.tw/", "https://gov.taipei/", "https://xgov.tw/"]) == [True, True, False]


def test_join_url(evaluate):
    base = "https://h.tw/a/b/page?x=1"
    assert evaluate(lambda c: urls.join_url(F.lit(base), c), ["https://z/q", "/r", "?p=2", "c", "../../d?x", "//k/z", "#f"]) == [
        "https://z/q", "https://h.tw/r", "https://h.tw/a/b/page?p=2", "https://h.tw/a/b/c", "https://h.tw/d?x", "https://k/z",
        "https://h.tw/a/b/page?x=1#f"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.from_regex(r"\A[A-Z0-9]{1,4}[-－][A-Z0-9]{1,4}\Z"), min_size=30, max_size=30))
def test_mask_never_leaks(evaluate, plates):
    for plain, masked in zip(plates, evaluate(redact.mask_plate, plates)):
        assert masked is None or (masked != plain and masked.count("*") >= 2)
