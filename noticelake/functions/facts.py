"""Facts stated in notice text: four-state answers, eligibility, registration, status.

NO is looked for before YES, and a YES wording directly behind a negation does not
count. A missing statement stays UNKNOWN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import (
    amount, ascii_digits, blank_to_null, clean, extract, extract_all, label_value, let, to_int,
)

# The wording each source uses for a negative and a positive answer.
# a negation is looked for behind the first character of the positive wording
CAN = "可(?<![不無未]可)"
CAN_OR_ABLE = "(?:可(?<![不無未]可)|能(?<![不無未]能))"
KEY_PLAIN = ("無鑰匙", "有鑰匙")
KEY_ATTACHED = ("無鑰匙", "有鑰匙|附鑰匙")
KEY_COURT = (
    r"(?:無|沒有)\s*(?:機車)?鑰匙|(?:機車)?鑰匙(?:未交付|未扣得)",
    r"(?:有|附)\s*(?:機車)?鑰匙",
)
START = ("無法發動|不能發動|發不動", f"{CAN_OR_ABLE}發動")
START_COURT = ("(?:無法|不能)(?:發動|啟動)|發不動", f"{CAN_OR_ABLE}(?:發動|啟動)")
TEST = ("無法測試|不可測試|不得測試", f"{CAN}測試|提供.{{0,8}}測試")
TEST_COURT = ("(?:無法|不能|不得)測試", f"{CAN_OR_ABLE}測試")
TEST_BRANCH = ("(?:無法|不可|不得)測試", f"{CAN}測試")
TAX = ("無欠稅", "有欠稅|欠稅未繳")
FINE = ("無道路交通違規|無罰鍰", "欠繳罰鍰|罰鍰未繳")
FUEL = ("無欠燃料費", "欠燃料")

RECYCLER = "廢機動車輛回收|合格回收商|回收業資格"
RECYCLER_PROCUREMENT = "廢機動車輛回收|廢棄物回收|回收清除機構|回收業資格"
RECYCLER_SALE = "應回收廢棄物回收業登記證"
BUSINESS = "公司或商業登記|投標人應為依法設立之公司|營業稅納稅證明"
SCRAP_STATED = "不得再領牌|不可再領牌|僅供報廢"
SCRAP_EXPLICIT = "僅能依廢棄物處理|不得再領牌|不可再領牌"
SCRAP_INFERRED = "(?:報廢|廢)(?:汽(?:、|及|與|和)?機車|汽車|機車|機動車輛|車輛)"
RELICENSE = "可(?<!不可)再領牌"


def four_state(c: Column, wording: tuple[str, str]) -> Column:
    """NO wins over YES (the source repeats negated phrases)."""
    no, yes = wording
    return F.when(c.rlike(no), "NO").when(c.rlike(yes), "YES").otherwise("UNKNOWN")


def four_state_or_conflict(c: Column, wording: tuple[str, str]) -> Column:
    """Both statements present, apart from negated repeats, is CONFLICTING."""
    no, yes = wording
    return (
        F.when(c.rlike(no) & c.rlike(yes), "CONFLICTING").when(c.rlike(no), "NO").when(c.rlike(yes), "YES")
        .otherwise("UNKNOWN")
    )


# --- eligibility -----------------------------------------------------------------
def eligibility_seized(c: Column) -> Column:
    return (
        F.when(c.rlike(RECYCLER), "LICENSED_RECYCLER_ONLY")
        .when(c.rlike("國民身分證|有意承購者|到場競買"), "NATURAL_PERSON_ALLOWED")
        .otherwise("UNKNOWN")
    )


def eligibility_enforcement(c: Column) -> Column:
    return F.when(c.rlike(RECYCLER), "LICENSED_RECYCLER_ONLY").otherwise("UNKNOWN")


def eligibility_procurement(qualification: Column) -> Column:
    return (
        F.when(qualification.rlike(RECYCLER_PROCUREMENT), "LICENSED_RECYCLER_ONLY")
        .when(qualification.rlike(BUSINESS), "BUSINESS_ONLY")
        .when(qualification != "", "SPECIAL_QUALIFICATION")
        .otherwise("UNKNOWN")
    )


def eligibility_sale(c: Column, recycler_only: Column) -> Column:
    return F.when(F.coalesce(recycler_only, F.lit(False)) | c.rlike(RECYCLER_SALE), "LICENSED_RECYCLER_ONLY").otherwise(
        "NATURAL_PERSON_ALLOWED"
    )


def eligibility_customs(c: Column) -> Column:
    return (
        F.when(c.rlike("限具有|主管機關.{0,8}許可|輸入許可文件"), "SPECIAL_QUALIFICATION")
        .when(c.rlike("個人|國民身分證"), "NATURAL_PERSON_ALLOWED")
        .otherwise("UNKNOWN")
    )


# --- registration ----------------------------------------------------------------
def registration_seized(c: Column) -> Column:
    return (
        F.when(c.rlike(SCRAP_STATED), "SCRAP_ONLY")
        .when(c.rlike(f"{RELICENSE}|重新領牌"), "RE_REGISTRATION_REQUIRED")
        .when(c.rlike("得辦理移轉過戶|可辦理移轉過戶"), "NORMAL_TRANSFER")
        .otherwise("UNKNOWN")
    )


def registration_enforcement(c: Column, extra_transfer: str = "") -> Column:
    transfer = "得辦理移轉過戶|可辦理移轉過戶" + (f"|{extra_transfer}" if extra_transfer else "")
    return (
        F.when(c.rlike(SCRAP_STATED), "SCRAP_ONLY")
        .when(c.rlike("繳銷重領|重新領牌|讓渡重領牌照"), "RE_REGISTRATION_REQUIRED")
        .when(c.rlike(transfer), "NORMAL_TRANSFER")
        .otherwise("UNKNOWN")
    )


def registration_procurement(c: Column) -> Column:
    return (
        F.when(c.rlike(RELICENSE), "RE_REGISTRATION_REQUIRED")
        .when(c.rlike(f"{SCRAP_EXPLICIT}|{SCRAP_INFERRED}"), "SCRAP_ONLY")
        .otherwise("REGISTRABILITY_UNKNOWN")
    )


def registration_sale(c: Column) -> Column:
    can, cannot = c.rlike(RELICENSE), c.rlike("不可再領牌|報廢無法再領牌")
    return (
        F.when(can & cannot, "REGISTRABILITY_UNKNOWN")
        .when(cannot, "SCRAP_ONLY")
        .when(c.contains("已繳銷") & can, "RE_REGISTRATION_REQUIRED")
        .when(c.rlike("需檢驗|檢驗合格"), "INSPECTION_REQUIRED")
        .when(c.contains("無牌照"), "REGISTRABILITY_UNKNOWN")
        .otherwise("UNKNOWN")
    )


def registration_customs(c: Column) -> Column:
    return (
        F.when(c.rlike("限退運出口|不得提領進口"), "EXPORT_ONLY")
        .when(c.rlike("不辦理登檢領照|不得(?:再)?領牌"), "CANNOT_RELICENSE")
        .when(c.rlike("檢測合格.{0,20}(?:登檢|領照)"), "INSPECTION_REQUIRED")
        .when(c.rlike("僅供報廢|報廢車"), "SCRAP_ONLY")
        .otherwise("UNKNOWN")
    )


# --- disposal origin -------------------------------------------------------------
def origin_procurement(c: Column, organization: Column) -> Column:
    return (
        F.when(c.rlike("交通違規移置|逾期未領回|移置保管"), "IMPOUNDED_UNCLAIMED")
        .when(c.rlike("扣押|沒收|沒入|贓物"), "CRIMINAL_SEIZURE_OR_FORFEITURE")
        .when(organization.contains("海關"), "CUSTOMS_FORFEITURE")
        .when(c.rlike(f"{SCRAP_EXPLICIT}|{SCRAP_INFERRED}"), "SCRAP_DISPOSAL")
        .otherwise("PUBLIC_ASSET_DISPOSAL")
    )


# --- status ----------------------------------------------------------------------
def _by_time(ends_at: Column, now: Column, otherwise: str) -> Column:
    return F.when(ends_at < now, "EXPIRED").when(ends_at.isNotNull(), "SCHEDULED").otherwise(otherwise)


def status_seized(c: Column, ends_at: Column, now: Column) -> Column:
    sold = c.rlike(r"已拍賣完畢|拍定(?:金額|價格|日期)|以新臺幣[\d,]+元拍定")
    return F.when(sold, "SOLD").otherwise(_by_time(ends_at, now, "ANNOUNCED"))


def status_enforcement(c: Column, sold_price: Column, ends_at: Column, now: Column) -> Column:
    sold = sold_price.isNotNull() | c.contains("已拍定")
    return F.when(sold, "SOLD").otherwise(_by_time(ends_at, now, "ANNOUNCED"))


def status_by_date(ends_at: Column, now: Column) -> Column:
    """A court date has no time of day: it expires when its Taipei day is over."""
    def day(t):
        return F.to_date(F.convert_timezone(None, F.lit("Asia/Taipei"), t.cast("timestamp_ntz")))

    return F.when(day(ends_at) < day(now), "EXPIRED").otherwise("SCHEDULED")


def status_scheduled(ends_at: Column, now: Column) -> Column:
    return F.when(ends_at < now, "EXPIRED").otherwise("SCHEDULED")


def status_announced(ends_at: Column, now: Column) -> Column:
    return _by_time(ends_at, now, "ANNOUNCED")


def status_sale(c: Column, sold_price: Column, result_record: Column, ends_at: Column, now: Column) -> Column:
    result = F.coalesce(result_record, F.lit(False))
    cancelled = c.rlike("(?:本標案|本拍賣|本公告|本案)(?:已|業經|因故)?取消|狀態[：:]?已取消")
    return (
        F.when(cancelled, "CANCELLED")
        .when(sold_price.isNotNull() & (result | c.contains("結案")), "SOLD")
        .when(result, "UNKNOWN")
        .otherwise(status_scheduled(ends_at, now))
    )


def status_customs(c: Column, ends_at: Column, now: Column) -> Column:
    sold = "得標結果|決標結果|已售出|已拍定|拍定金額|得標金額|決標金額|得標價款"
    return (
        F.when(c.rlike("不予開標|取消標售|停止標售"), "CANCELLED").when(c.rlike(sold), "SOLD")
        .otherwise(_by_time(ends_at, now, "ANNOUNCED"))
    )


# --- numbers -----------------------------------------------------------------------
def money_after(c: Column, wording: str) -> Column:
    """Digits that follow a wording within eight non-digits."""
    return amount(extract(ascii_digits(c), rf"(?:{wording})\D{{0,8}}([\d,]+)", 1))


def money_before_yuan(c: Column, wording: str) -> Column:
    return amount(extract(ascii_digits(c), rf"{wording}\s*([\d,]+)\s*元", 1))


def auction_round(c: Column, suffix: str = "拍") -> Column:
    return to_int(extract(ascii_digits(c), rf"第\s*(\d+)\s*(?:{suffix})", 1))


def mileage(c: Column, wording: str) -> Column:
    return amount(extract(ascii_digits(c), rf"(?i)(?:{wording})[：:]?\s*([\d,]+)", 1)).cast("int")


# --- lot size ----------------------------------------------------------------------
def counts_before_or_after(c: Column, noun: str, units: str = "臺台輛部", gap: str = r"[^。]{0,12}") -> Column:
    """Every stated vehicle count: behind the noun, or before it when none is behind."""
    digits = ascii_digits(c)
    ahead = extract_all(digits, rf"(\d+)\s*[{units}]{gap}{noun}", 1)
    found = let(
        extract_all(digits, rf"{P.NOUN_ENDS.get(noun, noun)}\s*(\d+)\s*[{units}]", 1),
        lambda behind: F.when(F.size(behind) > 0, behind).otherwise(ahead),
    )
    return F.transform(found, lambda n: n.try_cast("int"))


def lot_size_seized(counts: Column, mixed: Column, plates: Column) -> Column:
    total = F.aggregate(counts, F.lit(0), lambda a, n: a + F.coalesce(n, F.lit(0)))
    return (
        F.when((F.size(counts) > 0) & mixed, total)
        .when(F.size(counts) > 0, F.get(counts, F.lit(0)))
        .otherwise(F.greatest(F.lit(1), F.size(plates)))
    )


# --- identity ----------------------------------------------------------------------
def brand_name(raw: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in P.BRAND_ALIASES.items() for x in pair])
    return let(raw, lambda r: F.coalesce(F.try_element_at(lookup, r), r))


def scan_brand(c: Column, names: list[str]) -> Column:
    """First known brand, in list order, that occurs anywhere in the text."""
    return let(F.upper(c), lambda upper: F.coalesce(*[F.when(upper.contains(n), F.lit(n)) for n in names]))


def western_year(raw: Column) -> Column:
    return let(to_int(raw), lambda year: F.when(year < 1911, year + 1911).otherwise(year))


def plates(c: Column, numeric_needs_label: bool = True) -> Column:
    """Distinct plate tokens; all-digit ones only behind a plate label.

    Labelled tokens are collected once per text and looked up for the all-digit ones.
    """
    token = P.PLATE_TOKEN
    found = extract_all(c, token)
    if numeric_needs_label:
        found = let(
            extract_all(c, f"{P.PLATE_LABEL_BEFORE}({token})", 1),
            lambda labelled: F.filter(extract_all(c, token), lambda t: t.rlike("[A-Za-z]") | F.array_contains(labelled, t)),
        )
    return F.array_distinct(F.transform(found, lambda t: F.upper(F.translate(t, "－", "-"))))


def vehicle_identity(c: Column) -> dict[str, Column]:
    """Brand, model, year, month, displacement, colour and plates of a free text."""
    brand_raw = F.coalesce(label_value(c, ["廠牌名稱", "廠牌", "廠商"]), scan_brand(c, P.BRAND_SCAN))
    made = ascii_digits(label_value(c, ["出廠年月", "出廠日期", "出廠年份", "年份", "製造年月"]))
    year_month = r"(\d{2,4})\D*(\d{1,2})?"
    return {
        "brand": brand_name(brand_raw),
        "model": label_value(c, ["型號", "型式", "車型"]),
        "manufacture_year": western_year(extract(made, year_month, 1)),
        "manufacture_month": to_int(extract(made, year_month, 2)),
        "displacement_cc": amount(label_value(c, ["排氣量", "汽缸容量"])).cast("int"),
        "color": label_value(c, ["顏色", "車色"]),
        "plates": plates(c),
    }


def jurisdiction(location: Column) -> Column:
    return F.coalesce(F.substring(blank_to_null(location), 1, 3), F.lit("臺灣"))


def case_number_or_default(case_number: Column, source: Column, record_id: Column) -> Column:
    return F.coalesce(case_number, F.concat(F.upper(source), F.lit("-"), record_id))


def generic_vehicle_evidence(c: Column) -> Column:
    """Wording that names vehicles without a type; road passes are not vehicles."""
    return F.coalesce(*[
        let(extract(c, p), lambda hit: F.when(~hit.contains(P.PASS_CARD), blank_to_null(clean(hit))))
        for p in P.GENERIC_VEHICLE_WORDING
    ])


def is_procurement_vehicle(c: Column) -> Column:
    return c.rlike(P.PROCUREMENT_TERMS) & ~c.rlike(P.RAIL_TERMS)


def is_central_list_vehicle(c: Column) -> Column:
    return c.rlike(P.CENTRAL_LIST_TERMS) & ~c.contains("電力機車")


def is_vehicle_auction(c: Column) -> Column:
    return let(clean(c), lambda t: t.rlike(P.BRANCH_VEHICLE_TERMS) & t.rlike(P.BRANCH_AUCTION_TERMS))
