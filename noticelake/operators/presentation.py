"""Display columns of a listing row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import county_prefix
from ..functions.dates import instant
from .filters import UNSELLABLE, is_ended
from .listing import display_price

c = F.col

# Display labels.
ELIGIBILITY_LABELS = {
    "PUBLIC": "公開投標", "NATURAL_PERSON_ALLOWED": "一般民眾可投標", "BUSINESS_ONLY": "限公司／商號",
    "LICENSED_RECYCLER_ONLY": "限合格回收商", "SPECIAL_QUALIFICATION": "需特殊資格", "BULK_PURCHASE_ONLY": "限整批投標",
    "UNKNOWN": "資格未確認",
}
REGISTRATION_LABELS = {
    "NORMAL_TRANSFER": "可正常過戶", "RE_REGISTRATION_REQUIRED": "需重新領牌", "INSPECTION_REQUIRED": "需檢驗／認證",
    "REGISTRABILITY_UNKNOWN": "可否領牌未確認", "DEREGISTERED": "已繳銷", "CANNOT_RELICENSE": "不得重新領牌",
    "SCRAP_ONLY": "僅供報廢", "EXPORT_ONLY": "僅供出口", "UNKNOWN": "牌照狀態未確認",
}
CLASS_LABELS = {
    "ORDINARY_LIGHT": "普通輕型機車", "ORDINARY_HEAVY": "普通重型機車", "LARGE_HEAVY": "大型重型機車",
    "ELECTRIC_MOTORCYCLE": "電動機車", "HEAVY_UNSPECIFIED": "重型機車（級別未明）", "UNKNOWN": "機車級別未確認",
}
FOUR_STATE_LABELS = {"YES": "有／可", "NO": "無／不可", "UNKNOWN": "未確認", "CONFLICTING": "官方資料衝突"}
SUMMARY_STATES = {"YES": "是", "NO": "否", "UNKNOWN": "未確認", "CONFLICTING": "資料衝突"}
ORIGIN_LABELS = {
    "JUDICIAL_EXECUTION": "司法強制執行法拍", "ADMINISTRATIVE_ENFORCEMENT": "行政執行拍賣",
    "CRIMINAL_SEIZURE_OR_FORFEITURE": "刑事扣押／沒收", "IMPOUNDED_UNCLAIMED": "移置保管逾期未領",
    "PUBLIC_ASSET_DISPOSAL": "公有財產變賣", "CUSTOMS_FORFEITURE": "海關沒入／拍賣", "SCRAP_DISPOSAL": "公務報廢財物",
    "OTHER": "其他", "UNKNOWN": "處分性質未確認",
}
VIEW_LABELS = {"active": "進行中", "ended": "已結束", "favorites": "我的收藏", "scrap": "報廢／回收", "all": "全部紀錄"}


def label(value: Column, labels: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), value)


def risk_badges() -> Column:
    """Risks of a row in fixed order."""
    lot = F.concat(F.lit("整批 "), c("lot_size").cast("string"), F.lit(" 臺"))
    rules = [
        (c("eligibility") == "LICENSED_RECYCLER_ONLY", F.lit("限合格回收商")),
        (c("eligibility") == "UNKNOWN", F.lit("投標資格未確認")),
        (c("registration_status").isin(UNSELLABLE), F.lit("不得領牌上路")),
        (c("registration_status").isin("UNKNOWN", "REGISTRABILITY_UNKNOWN"), F.lit("牌照狀態未確認")),
        (c("can_start") == "NO", F.lit("目前無法發動")),
        (c("can_start") == "CONFLICTING", F.lit("發動資訊衝突")),
        (c("bulk_lot"), lot),
    ]
    return F.array_compact(F.array(*[F.when(test, text) for test, text in rules]))


def money(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("NT$ "), F.call_function("format_number", value, F.lit("#,##0.###"))), F.lit("價格未公開"))


def quick_summary() -> Column:
    open_to_all = c("eligibility").isin("NATURAL_PERSON_ALLOWED", "PUBLIC")
    who = (
        F.when(c("eligibility") == "LICENSED_RECYCLER_ONLY", "限合格回收商").when(open_to_all, "一般民眾可投標")
        .otherwise("投標資格未確認")
    )
    round_text = F.when(c("round_number") != 0, F.concat(F.lit("第"), c("round_number").cast("string"), F.lit("拍")))
    states = [
        F.concat(F.lit(f"{name}："), label(c(column), SUMMARY_STATES))
        for name, column in (("有鑰匙", "has_key"), ("可發動", "can_start"), ("可測試", "can_test"))
    ]
    return F.concat_ws(
        "｜", who, F.coalesce(round_text, F.lit("拍次未確認")), money(F.coalesce("current_price", "reserve_price")),
        F.coalesce("county", "storage_location", F.lit("地點未確認")), *states)


def price_label(detail: bool = False) -> Column:
    sold, current, reserve = ("官方成交價" if detail else "成交價"), "目前出價", "公告底價"
    return F.when(c("sold_price").isNotNull(), sold).when(c("current_price").isNotNull(), current).otherwise(reserve)


def days_left(as_of) -> Column:
    """Whole days until the deadline, rounded up."""
    micros = F.unix_micros(c("auction_at").cast("timestamp")) - F.unix_micros(instant(as_of))
    return F.ceil(micros / F.lit(86_400_000_000.0)).cast("int")


def timeline(as_of, detail: bool = False) -> dict[str, Column]:
    """``timeline_label`` and ``urgency`` of a card, or the deadline text of a detail page."""
    days = days_left(as_of)
    ended = is_ended(as_of)
    ended_label = F.lit("已截止／結果以官方公告為準") if detail else F.when(
        c("auction_status") == "SOLD", "已成交").otherwise("已截止／結果待確認")
    text = (
        F.when(ended, ended_label).when(c("auction_at").isNull(), "截止時間未確認").when(days <= 0, "今天截止")
        .when(days == 1, "明天截止").otherwise(F.concat(days.cast("string"), F.lit(" 天後截止")))
    )
    urgency = (
        F.when(ended, "ended").when(c("auction_at").isNull(), "unknown").when(days <= 1, "critical")
        .when(days <= 7, "soon").otherwise("normal")
    )
    return {"timeline_label": text, "urgency": urgency}


def missing_facts() -> Column:
    unstated = c("registration_status").isin("UNKNOWN", "REGISTRABILITY_UNKNOWN")
    rules = [
        (c("vehicle_category") == "UNKNOWN", "機車級別"), (F.coalesce(c("brand_name"), F.lit("")) == "", "廠牌"),
        (F.coalesce(c("model_name"), F.lit("")) == "", "型號"), (F.coalesce(c("manufacture_year"), F.lit(0)) == 0, "出廠年月"),
        (c("mileage_km").isNull(), "里程"), (c("has_key") == "UNKNOWN", "鑰匙"), (c("can_start") == "UNKNOWN", "能否發動"),
        (c("can_test") == "UNKNOWN", "能否測試"), (unstated, "可否領牌"), (c("eligibility") == "UNKNOWN", "投標資格"),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(text)) for test, text in rules]))


def manufacture_label() -> Column:
    month = F.when(
        F.coalesce(c("manufacture_month"), F.lit(0)) != 0, F.concat(F.lit(" "), c("manufacture_month").cast("string"), F.lit(" 月"))
    ).otherwise("（月份未確認）")
    year = F.when(F.coalesce(c("manufacture_year"), F.lit(0)) != 0, c("manufacture_year").cast("string"))
    return F.coalesce(F.concat(year, F.lit(" 年"), month), F.lit("未確認"))


def display_rows(listing: DataFrame, as_of) -> DataFrame:
    """Listing rows with names, defaults, date precision, badges and summaries."""
    joined = F.nullif(F.concat_ws(" ", F.nullif("brand_name", F.lit("")), F.nullif("model_name", F.lit(""))), F.lit(""))
    classed = F.when(c("vehicle_category") != "UNKNOWN", "MOTORCYCLE").otherwise("UNKNOWN")
    return listing.withColumns({
        "official_title": F.coalesce("official_title", F.lit("未命名標售")),
        "organization_name": F.coalesce("organization_name", F.lit("未辨識機關")),
        "source_name": F.coalesce("source_name", F.lit("未辨識來源")),
        "vehicle_type": F.coalesce(c("vehicle_type"), classed),
        "county": F.coalesce(c("county"), county_prefix(c("storage_location"))),
        "favorite_supported": c("vehicle_id").isNotNull(),
        "date_precision": F.when(c("source_adapter") == "judicial", "DATE").otherwise("DATETIME"),
    }).withColumns({
        "name": F.coalesce(joined, c("official_title")),
        "display_price": display_price(),
        "price_label": price_label(),
        "price_text": money(display_price()),
        "risk_badges": risk_badges(),
        "quick_summary": quick_summary(),
        "missing_facts": missing_facts(),
        "manufacture_label": manufacture_label(),
        **timeline(as_of),
    })


# Parameters counted as applied filters on the search page.
COUNTED = [
    "vehicleType", "county", "source", "origin", "brand", "vehicleClass", "carCategory", "eligibility", "registration",
    "within", "keyword",
]


def applied_filters(queries: DataFrame) -> DataFrame:
    """Number of applied filters and the summary line of normalized requests."""
    flags = [c(n) for n in ("hasPhotos", "singleVehicle")]
    priced = c("minPrice").isNotNull() | c("maxPrice").isNotNull()
    bands = F.coalesce(F.size("displacementBands"), F.lit(0))
    terms = [F.when(c(n).isNotNull(), 1).otherwise(0) for n in COUNTED] + [F.when(f, 1).otherwise(0) for f in [*flags, priced]]
    total = sum(terms, F.greatest(bands, F.lit(0)))
    kinds = {"MOTORCYCLE": "機車", "CAR": "汽車", "MIXED": "汽機車混合批次", "UNKNOWN": "車種未確認"}
    summary = F.concat_ws(
        "・", F.coalesce(label(c("view"), VIEW_LABELS), F.lit("進行中")),
        F.coalesce(label(c("vehicleType"), kinds), F.lit("全部車輛")),
        F.concat(c("within").cast("bigint").cast("string"), F.lit(" 天內")), label(c("vehicleClass"), CLASS_LABELS))
    return queries.withColumns({"applied_count": total, "summary": summary})
