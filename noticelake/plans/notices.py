"""Notice normalizers, one per official family: landed pages -> records and errors.

Every family is one narrow job over the landed table: read tags once, derive the text
fields, classify, and shape the record. Nothing shuffles. ``as_of`` decides what has
expired. Input columns: ``source_record_id``, ``official_url``, ``content`` and the
optional discovery columns of ``records.landed``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import classify, dates, facts, urls
from ..functions import patterns as P
from ..functions.mentions import plates_for_type
from ..functions.redact import redact_private
from ..functions.text import (
    amount, ascii_digits, blank_to_null, clean, distinct_sentences, extract, extract_all, fact_sentence, first_sentence,
    holds, label_value, sentences, to_int,
)
from ..operators.completeness import completeness, customs_scores, has_items, has_text, is_known, never
from ..sources.html import Page, article_scope, has_class, line_fields, lookup, lookup_containing, with_page
from ..sources.lists import attachment_urls
from ..sources.manifests import COURT_FIELDS
from .records import (
    evidence, evidence_list, identifier, iso_taipei, item, landed, link_evidence, plate_identifier, present_identifiers,
    outcome_rows, separable_units, split, suppress_for_mixed, units_of,
)

c = F.col
VEHICLE_LOT = rf"{P.VEHICLE_NOUN}[^。]{{0,8}}(?:一批|整批)"


def _classified(df: DataFrame, text: str, class_text: str | None = None) -> DataFrame:
    """Type, category and class with the wording they rest on."""
    return df.withColumns({
        "type_found": classify.vehicle_type(c(text)),
        "class_found": classify.vehicle_class(c(class_text or text)),
    }).withColumns({
        "category_found": classify.car_category(c(text), c("type_found.value")),
    }).withColumns({
        "vehicle_type": c("type_found.value"),
        "car_category": c("category_found.value"),
        "vehicle_class": c("class_found.value"),
    })


def _classification_evidence(fallback: Column | None = None, **options) -> list[Column]:
    type_text = c("type_found.text") if fallback is None else F.coalesce(c("type_found.text"), fallback)
    return [
        evidence("vehicle_type", c("type_found.value"), type_text, **options),
        evidence("vehicle_class", c("class_found.value"), c("class_found.text"), **options),
        evidence("car_category", c("category_found.value"), c("category_found.text"), **options),
    ]


def _unclassify_mixed(df: DataFrame, extra: list[str] | None = None, also: Column | None = None) -> DataFrame:
    mixed = c("vehicle_type") == "MIXED"
    df = suppress_for_mixed(df, mixed if also is None else mixed | also, extra)
    return df.withColumns({n: F.when(mixed, "UNKNOWN").otherwise(c(n)) for n in ("vehicle_class", "car_category")})


def _identified(df: DataFrame, text: str) -> DataFrame:
    """Identity facts of a free text, plates limited to the lot's own vehicle type."""
    df = df.withColumns(facts.vehicle_identity(c(text)))
    return df.withColumn("plates", plates_for_type(c(text), c("plates"), c("vehicle_type")))


def _conditions(text: str, key, start, test) -> dict[str, Column]:
    return {n: facts.four_state(c(text), w) for n, w in (("has_key", key), ("can_start", start), ("can_test", test))}


def _plates_present() -> Column:
    return has_items(c("plates"))


def _identity_flags() -> list[Column]:
    return [_plates_present(), has_text(c("brand")), has_text(c("model")), has_text(c("vehicle_type"))]


def _auction_flags() -> list[Column]:
    return [
        has_text(c("organization")), c("ends_at").isNotNull(), c("reserve_price").isNotNull(), has_text(c("status")),
        is_known(c("eligibility")),
    ]


def _condition_flags(last: Column) -> list[Column]:
    return [is_known(c("has_key")), is_known(c("can_start")), is_known(c("can_test")), last]


# --- seized property (central portal) --------------------------------------------------
def normalize_seized(pages: DataFrame, as_of) -> DataFrame:
    """Seized-property detail page, or the exact central list row when no detail was landed."""
    now = dates.instant(as_of)
    p = Page()
    heading = p.first("h2", where=lambda n: has_class(n, "title"))
    row = p.first("tr")
    cells = p.inside(row, "td", where=lambda n: n["attr_data_title"].isNotNull())

    def cell(label: str) -> Column:
        return p.text(F.try_element_at(F.filter(cells, lambda n: n["attr_data_title"] == label), F.lit(-1)))

    title_cell = F.get(F.filter(cells, lambda n: n["attr_data_title"] == "標題"), F.lit(0))
    row_link = F.get(p.inside(title_cell, "a", where=lambda n: n["attr_href"].isNotNull()), F.lit(0))
    creator = p.first("meta", where=lambda n: n["attr_name"] == "DC.Creator")
    body = p.first("section", where=lambda n: has_class(n, "cp"))
    df = with_page(landed(pages), "content").withColumns({
        "page_title": F.when(heading.isNotNull(), p.text(heading)).when(row_link.isNotNull(), p.text(row_link)),
        "creator": F.when(creator.isNotNull(), clean(creator["attr_content"])).otherwise(
            F.coalesce(F.when(heading.isNull(), blank_to_null(cell("單位"))), clean(c("organization")))),
        "body": F.when(body.isNotNull(), p.text(body)).otherwise(""),
    }).drop("page", "organization")
    df = df.withColumns({
        "title": F.coalesce(c("page_title"), clean(c("title"))),
        "organization": F.coalesce(blank_to_null(c("creator")), F.lit("未辨識檢察機關")),
    }).withColumn("combined", redact_private(F.concat_ws(" ", "title", "body"))).withColumn("sentences", sentences(c("combined")))
    text, parts = c("combined"), c("sentences")
    df = df.withColumn("auction_sentence", F.coalesce(first_sentence(parts, "拍賣(?:時間|日期)"), text))
    df = _identified(_classified(df, "combined"), "combined").withColumns({
        "official_case_number": extract(text, r"(\d{2,3}年度(?:變價|執沒|扣押物|偵)字第[\d、,，至-]+號)", 1),
        "ends_at": dates.official_datetime(c("auction_sentence")),
        "auction_round": facts.auction_round(text, "次|拍"),
        "reserve_price": facts.money_after(text, "(?:核定)?底價"),
        "sold_price": facts.money_after(text, "拍定金額|拍定價格|成交價"),
        "location": label_value(text, ["拍賣地點", "放置地點", "觀覽地點"]),
        "eligibility": facts.eligibility_seized(text),
        "registration_status": facts.registration_seized(text),
        "counts": facts.counts_before_or_after(text, P.VEHICLE_NOUN),
        "condition_summary": first_sentence(parts, "車況|刮傷|損壞|發動|鑰匙"),
        "description": blank_to_null(c("body")),
        **_conditions("combined", facts.KEY_PLAIN, facts.START, facts.TEST),
    }).withColumns({
        "status": facts.status_seized(text, c("ends_at"), now),
        "lot_size": facts.lot_size_seized(c("counts"), c("vehicle_type") == "MIXED", c("plates")),
    }).withColumn("bulk_lot", (c("lot_size") > 1) | (c("vehicle_type") == "MIXED") | (holds(text, ["一批", "整批"]) & text.rlike(VEHICLE_LOT)))
    found = [
        evidence("title", c("title"), c("title")),
        evidence("official_case_number", c("official_case_number"), c("official_case_number")),
        evidence("organization", c("organization"), c("organization")),
        evidence("ends_at", iso_taipei(c("ends_at")), F.when(c("ends_at").isNotNull(), c("auction_sentence"))),
        *_classification_evidence(),
        evidence("registration_status", c("registration_status"), first_sentence(parts, "領牌|過戶|報廢")),
        evidence("eligibility", c("eligibility"), first_sentence(parts, "身分證|承購|競買|回收商")),
    ]
    df = _unclassify_mixed(df.withColumn("evidence", evidence_list(found)))
    media = has_items(c("photo_urls")) | (F.coalesce(c("pdf_count"), F.lit(0)) > 0)
    df = df.withColumns({
        "official_title": c("title"),
        "disposal_origin": F.lit("CRIMINAL_SEIZURE_OR_FORFEITURE"),
        "identifiers": F.transform("plates", plate_identifier),
        "vehicle_units": separable_units(c("plates")),
        **completeness({
            "identity": _identity_flags(), "auction": _auction_flags(), "condition": _condition_flags(has_text(c("body"))),
            "registration": [is_known(c("registration_status")), _plates_present(), never()],
            "fees": [never()] * 3, "media": [media],
        }),
        "error": F.when(c("vehicle_type") == "UNKNOWN", "record names neither a car nor a motorcycle"),
    })
    return df


# --- enforcement detail -----------------------------------------------------------------
def normalize_enforcement(pages: DataFrame, as_of) -> DataFrame:
    """Enforcement detail page: the list under the notice heading."""
    now = dates.instant(as_of)
    p = Page()
    heading = p.first("div", where=lambda n: has_class(n, "title_h3") & p.text(n).contains("公告事項"))
    listing = F.get(p.select("ul", where=lambda n: n["pos"] > heading["pos"]), F.lit(0))
    lines = F.coalesce(F.transform(p.inside(listing, "li"), p.text), F.array().cast("array<string>"))
    df = with_page(landed(pages), "content").withColumn("lines", lines).drop("page")
    df = df.withColumn("combined", redact_private(F.array_join("lines", " "))).withColumn("sentences", sentences(c("combined")))
    text, parts = c("combined"), c("sentences")
    own_line = F.get(F.filter("lines", lambda s: ~s.startswith("案號") & ~s.startswith("開標日")), F.lit(0))
    date_text = extract(ascii_digits(text), r"開標日[：:]\s*[\d/]+(?:\s+[\d:]+)?")
    case_text = extract(text, r"(?i)案號[：:]\s*[A-Z0-9-]+")
    df = df.withColumns({"case_text": case_text, "date_text": date_text})
    transfer = facts.registration_enforcement(text, "本區新領")
    df = _identified(_classified(df, "combined"), "combined").withColumns({
        "official_case_number": F.coalesce(extract(c("case_text"), r"(?i)[：:]\s*([A-Z0-9-]+)", 1), c("source_record_id")),
        "ends_at": dates.official_datetime(c("date_text")),
        "description": F.coalesce(own_line, c("title")),
        "organization": F.coalesce(item("organization"), F.lit("法務部行政執行署（分署未確認）")),
        "mileage_km": facts.mileage(text, "里程數|里程|儀表板?所示里程數"),
        "counts": facts.counts_before_or_after(text, P.VEHICLE_NOUN),
        "auction_round": F.coalesce(facts.auction_round(text), c("auction_round")),
        "sold_price": facts.money_after(text, "拍定金額|拍定價格"),
        "reserve_price": facts.money_after(text, "(?:核定)?底價"),
        "eligibility": facts.eligibility_enforcement(text),
        "registration_status": transfer,
        "location": label_value(text, ["拍賣地點", "放置地點", "觀覽地點", "地點"]),
        "fee_note": first_sentence(parts, "欠稅|燃料費|養護費|罰鍰|鑑定費"),
        "condition_summary": first_sentence(parts, "車況|刮傷|漏油|發動|鑰匙"),
        **_conditions("combined", facts.KEY_ATTACHED, facts.START, facts.TEST),
    }).withColumns({
        "title": clean(F.when(c("title") != c("source_record_id"), blank_to_null(c("title")))),
        "status": facts.status_enforcement(text, c("sold_price"), c("ends_at"), now),
        "lot_size": F.coalesce(F.get("counts", F.lit(0)), F.greatest(F.lit(1), F.size("plates"))),
        "fee_notes": F.array_compact(F.array("fee_note")),
    }).withColumns({
        "title": F.coalesce(blank_to_null(c("title")), clean(c("description"))),
        "bulk_lot": (c("lot_size") > 1) | (c("vehicle_type") == "MIXED") | (holds(text, ["一批", "整批"]) & text.rlike(VEHICLE_LOT)),
    })
    found = [
        evidence("official_case_number", c("official_case_number"), c("case_text")),
        evidence("ends_at", iso_taipei(c("ends_at")), c("date_text")),
        *_classification_evidence(),
        evidence("registration_status", c("registration_status"), first_sentence(parts, "領牌|過戶|報廢|牌照狀態")),
        evidence("has_key", c("has_key"), first_sentence(parts, "鑰匙")),
    ]
    df = _unclassify_mixed(df.withColumn("evidence", evidence_list(found))).withColumns({
        "official_title": c("title"),
        "disposal_origin": F.lit("ADMINISTRATIVE_ENFORCEMENT"),
        "identifiers": F.transform("plates", plate_identifier),
        "vehicle_units": separable_units(c("plates")),
    })
    df = df.withColumns({
        **completeness({
            "identity": _identity_flags(), "auction": _auction_flags(),
            "condition": _condition_flags(has_text(c("description"))),
            "registration": [is_known(c("registration_status")), _plates_present(), never()],
            "fees": [has_items(c("fee_notes")), never(), never()], "media": [has_items(c("photo_urls"))],
        }),
        "error": F.when(c("vehicle_type") == "UNKNOWN", "record names neither a car nor a motorcycle"),
    })
    return df


# --- court result row -------------------------------------------------------------------
COURT_ROW = T.StructType([T.StructField(n, T.StringType()) for n in COURT_FIELDS])


def normalize_court(pages: DataFrame, as_of) -> DataFrame:
    """One structured court result row per landed JSON object."""
    now = dates.instant(as_of)
    df = landed(pages).withColumn("row", F.from_json("content", COURT_ROW))
    df = df.withColumn(
        "error", F.when(c("row").isNull() | ~F.ltrim(c("content")).startswith("{"), "court artifact is not one result object"))

    def raw(name: str) -> Column:
        return clean(c(f"row.{name}"))

    composed = F.when(
        (raw("crmyy") != "") & (raw("crmid") != "") & (raw("crmno") != ""),
        F.concat(raw("crmyy"), raw("crmid"), F.lit("字第"), raw("crmno"), F.lit("號")),
    )
    fee_raw = c("row.fee_notes")
    fee_list = F.when(fee_raw.startswith("["), F.from_json(fee_raw, T.ArrayType(T.StringType()))).otherwise(F.array(fee_raw))
    df = df.withColumns({
        "title": F.coalesce(blank_to_null(raw("ttitle")), clean(c("title"))),
        "notes": raw("notes"),
        "organization": F.coalesce(blank_to_null(raw("crtnm")), F.lit("未辨識法院")),
        "ends_at": F.coalesce(dates.official_datetime(c("row.sale_time")), dates.roc_compact_date(c("row.saledate"))),
        "auction_round": amount(c("row.saleno")).cast("int"),
        "quantity": F.coalesce(F.nullif(amount(c("row.qty")), F.lit(0)), F.lit(1)).cast("int"),
        "official_case_number": F.coalesce(blank_to_null(raw("crm")), composed),
        "reserve_price": amount(c("row.sumprice")),
        "deposit": amount(c("row.deposit")),
        "fee_notes": F.filter(F.transform(F.coalesce(fee_list, F.array().cast("array<string>")), clean), lambda s: s != ""),
        "pictures": amount(F.coalesce(F.get_json_object("metadata", "$.pic_cnt"), c("row.pic_cnt"))),
    }).withColumns({
        "reserve_price": F.when(c("reserve_price") > 0, c("reserve_price")),
        "identity_text": F.upper(clean(F.concat_ws(" ", raw("registeno"), "title", "notes"))),
        "class_text": F.concat_ws(" ", "title", "notes"),
    })
    notes = c("notes")
    displacement_text = label_value(notes, ["排氣量(馬力)", "排氣量（馬力）", "排氣量", "汽缸容量"])
    made = ascii_digits(label_value(notes, ["出廠年月", "製造年月"]))
    compact = F.regexp_replace(made, r"\D", "")
    separated = r"(\d{2,4})\D+(\d{1,2})"
    brand_raw = F.coalesce(label_value(notes, ["廠牌", "廠牌名稱"]), facts.scan_brand(c("class_text"), list(P.BRAND_ALIASES)[::-1]))
    df = _classified(df, "identity_text", "class_text").withColumns({
        "plates": facts.plates(c("identity_text"), numeric_needs_label=False),
        "brand_raw": brand_raw,
        "brand": facts.brand_name(brand_raw),
        "model": label_value(notes, ["型式", "型號", "車型"]),
        "displacement_text": displacement_text,
        "displacement_cc": amount(displacement_text).cast("int"),
        "color": label_value(notes, ["顏色", "車色"]),
        "mileage_km": amount(label_value(notes, ["里程數", "里程"])).cast("int"),
        "location": F.coalesce(blank_to_null(raw("location")), label_value(notes, ["物品所在地", "拍賣地點"])),
        "engine": label_value(notes, ["引擎號碼", "引擎號", "引擎"]),
        "frame": label_value(notes, ["車身號碼", "車架號碼", "車台號碼"]),
        "made": made,
        "manufacture_year": facts.western_year(
            F.coalesce(extract(made, separated, 1), extract(compact, r"^(\d{4})\d{2}$", 1))),
        "manufacture_month": to_int(F.coalesce(extract(made, separated, 2), extract(compact, r"^\d{4}(\d{2})$", 1))),
        "status": facts.status_by_date(c("ends_at"), now),
        **_conditions("notes", facts.KEY_COURT, facts.START_COURT, facts.TEST_COURT),
    })

    def structured(name: str, value: Column, source: Column, key: str, trust: str | Column = "OFFICIAL_EXPLICIT") -> Column:
        return evidence(name, value, source, key, trust, "STRUCTURED")

    joined = blank_to_null(F.array_join("plates", "、"))
    price_trust = F.when(c("reserve_price").isNull(), "OFFICIAL_INFERRED").otherwise("OFFICIAL_EXPLICIT")
    day = F.substring(iso_taipei(c("ends_at")), 1, 10)
    found = [
        structured("official_case_number", c("official_case_number"), c("official_case_number"), "crm"),
        structured("organization", c("organization"), c("row.crtnm"), "crtnm"),
        structured("ends_at", day, c("row.saledate"), "saledate"),
        structured("auction_round", c("auction_round"), c("row.saleno"), "saleno"),
        structured("lot_size", c("quantity"), c("row.qty"), "qty"),
        structured("reserve_price", c("reserve_price"), c("row.sumprice"), "sumprice", price_trust),
        structured("deposit", c("deposit"), c("row.deposit"), "deposit"),
        structured("title", c("title"), c("row.ttitle"), "ttitle"),
        structured("disposal_origin", F.lit("JUDICIAL_EXECUTION"), c("organization"), "crtnm", "OFFICIAL_INFERRED"),
        structured("plate", joined, joined, "notes"),
        structured("brand", c("brand"), c("brand_raw"), "notes"),
        structured("model", c("model"), c("model"), "notes"),
        structured("manufacture_year", c("manufacture_year"), c("made"), "notes"),
        structured("displacement_cc", c("displacement_cc"), c("displacement_text"), "notes"),
        structured("color", c("color"), c("color"), "notes"),
        structured("mileage_km", c("mileage_km"), c("mileage_km").cast("string"), "notes"),
        structured("location", c("location"), c("location"), "notes"),
        structured("has_key", c("has_key"), fact_sentence(notes, "鑰匙"), "notes"),
        structured("can_start", c("can_start"), fact_sentence(notes, "發動|啟動"), "notes"),
        structured("can_test", c("can_test"), fact_sentence(notes, "測試"), "notes"),
        structured("engine", c("engine"), c("engine"), "notes"),
        structured("frame", c("frame"), c("frame"), "notes"),
        structured("vehicle_class", c("class_found.value"), c("class_found.text"), "ttitle/notes"),
        structured("vehicle_type", c("type_found.value"), c("type_found.text"), "ttitle/notes"),
        structured("car_category", c("category_found.value"), c("category_found.text"), "ttitle/notes"),
    ]
    df = _unclassify_mixed(df.withColumn("evidence", evidence_list(found))).withColumns({
        "official_title": c("title"),
        "disposal_origin": F.lit("JUDICIAL_EXECUTION"),
        "lot_size": c("quantity"),
        "bulk_lot": c("quantity") > 1,
        "description": blank_to_null(notes),
        "condition_summary": blank_to_null(notes),
        "photo_urls": F.array().cast("array<string>"),
        "identifiers": F.concat(
            F.transform("plates", plate_identifier),
            present_identifiers(identifier("ENGINE", c("engine")), identifier("FRAME", c("frame"))),
        ),
        "vehicle_units": separable_units(c("plates")),
        **completeness({
            "identity": [_plates_present(), has_text(c("brand")), has_text(c("model")), has_text(c("official_case_number"))],
            "auction": [has_text(c("organization")), c("ends_at").isNotNull(), c("auction_round").isNotNull(),
                        c("reserve_price").isNotNull(), has_text(c("status"))],
            "condition": _condition_flags(has_text(notes)),
            "registration": [never(), _plates_present(), never()],
            "fees": [c("deposit").isNotNull(), has_items(c("fee_notes")), never()],
            "media": [F.coalesce(c("pictures") > 0, F.lit(False))],
        }),
    })
    return df


# --- procurement detail -----------------------------------------------------------------
def normalize_procurement(pages: DataFrame, as_of) -> DataFrame:
    """Asset-sale detail: rows of one or two label/value pairs."""
    now = dates.instant(as_of)
    df = with_page(landed(pages), "content").withColumn("pairs", Page().paired_cells()).drop("page")

    def of(label: str) -> Column:
        return lookup(c("pairs"), label)

    df = df.withColumns({
        "title": F.coalesce(blank_to_null(of("財物名稱")), c("title")),
        "organization": F.coalesce(of("機關名稱"), F.lit("未辨識機關")),
        "qualification": F.coalesce(of("投標資格摘要"), F.lit("")),
        "additional": F.coalesce(of("附加說明"), F.lit("")),
        "official_case_number": of("標案案號"),
        "round_text": of("公告次數"), "announced_text": of("公告日期"), "deadline_text": of("截止投標"),
        "reserve_text": of("底價金額"), "deposit_text": F.coalesce(of("保證金額度"), F.lit("")),
        "organization_text": of("機關名稱"), "viewing": of("現場查看時間"),
        "location": F.coalesce(*[blank_to_null(of(x)) for x in ("變賣標的所在地", "開標地點", "機關地址")]),
    }).drop("pairs").withColumn(
        "combined", clean(F.array_join(F.transform(F.array("title", "qualification", "additional"), blank_to_null), " ")))
    text = c("combined")
    plain_title = F.translate(c("title"), "⾞", "車")
    scrap_explicit, scrap_inferred = text.rlike(facts.SCRAP_EXPLICIT), text.rlike(facts.SCRAP_INFERRED)
    df = _classified(df, "combined").withColumns({
        "starts_at": dates.roc_datetime(c("announced_text")),
        "ends_at": dates.roc_datetime(c("deadline_text")),
        "reserve_price": amount(c("reserve_text")),
        "deposit": F.when(c("deposit_text").contains("免收保證金"), F.lit(0).cast("bigint")).otherwise(amount(c("deposit_text"))),
        "eligibility": facts.eligibility_procurement(c("qualification")),
        "registration_status": facts.registration_procurement(text),
        "disposal_origin": facts.origin_procurement(text, c("organization")),
        "auction_round": amount(c("round_text")).cast("int"),
        "counted": F.get(facts.counts_before_or_after(plain_title, P.PROCUREMENT_NOUN, "輛台部", r"[^，。]{0,8}"), F.lit(0)),
        "count_text": F.coalesce(
            extract(ascii_digits(plain_title), rf"{P.PROCUREMENT_NOUN}\s*\d+\s*[輛台部]"),
            extract(ascii_digits(plain_title), rf"\d+\s*[輛台部][^，。]{{0,8}}{P.PROCUREMENT_NOUN}")),
    }).withColumn("status", facts.status_scheduled(c("ends_at"), now))
    scrap_text = F.when(scrap_explicit, F.coalesce(blank_to_null(c("additional")), c("title"))).when(scrap_inferred, c("title"))
    scrap_trust = F.when(scrap_explicit, "OFFICIAL_EXPLICIT").otherwise("OFFICIAL_INFERRED")
    found = [
        evidence("organization", c("organization"), c("organization_text"), "organization"),
        evidence("official_case_number", c("official_case_number"), c("official_case_number"), "official_case_number"),
        evidence("auction_round", c("auction_round"), c("round_text"), "auction_round"),
        evidence("starts_at", iso_taipei(c("starts_at")), c("announced_text"), "starts_at"),
        evidence("ends_at", iso_taipei(c("ends_at")), c("deadline_text"), "ends_at"),
        evidence("reserve_price", c("reserve_price"), c("reserve_text"), "reserve_price"),
        evidence("deposit", c("deposit"), c("deposit_text"), "deposit"),
        evidence("eligibility", c("eligibility"), c("qualification"), "eligibility"),
        evidence("location", c("location"), c("location"), "location"),
        evidence("registration_status", c("registration_status"), scrap_text, "財物名稱／附加說明", scrap_trust),
        evidence("disposal_origin", c("disposal_origin"), c("title"), "財物名稱", "OFFICIAL_INFERRED"),
        evidence("lot_size", c("counted"), F.when(c("counted").isNotNull(), c("count_text")), "財物名稱"),
        *_classification_evidence(row="財物名稱／附加說明"),
    ]
    df = df.withColumns({
        "evidence": evidence_list(found),
        "official_title": c("title"),
        "lot_size": F.coalesce(F.nullif(c("counted"), F.lit(0)), F.lit(1)),
        "bulk_lot": F.coalesce(c("counted") != 1, F.lit(True)),
        "fee_notes": F.filter(F.array("deposit_text"), lambda s: s != ""),
        "description": blank_to_null(clean(F.concat_ws(" ", *[blank_to_null(c(x)) for x in ("qualification", "viewing", "additional")]))),
        "condition_summary": blank_to_null(c("additional")),
        "photo_urls": F.array().cast("array<string>"),
        **completeness({
            "identity": [has_text(c("official_case_number")), c("counted").isNotNull()],
            "auction": _auction_flags(),
            "condition": [never(), never(), never(), has_text(c("additional"))],
            "registration": [is_known(c("registration_status")), never(), never()],
            "fees": [c("deposit").isNotNull(), never(), never()], "media": [never()],
        }),
        "error": F.when(blank_to_null(c("title")).isNull(), "detail page has no title"),
    })
    return df


# --- online sale detail -----------------------------------------------------------------
SALE_PLATE = r"(?i)[A-Z0-9]{2,4}[－-][A-Z0-9]{2,4}"


def normalize_sale(pages: DataFrame, as_of) -> DataFrame:
    """Online-sale detail: heading, two-cell rows and ``label：value`` lines."""
    now = dates.instant(as_of)
    p = Page()
    heading = F.coalesce(p.first("strong"), p.first("h1"), p.first("title"))
    photos = p.select(where=lambda n: ((n["tag"] == "a") & n["attr_href"].contains("imageResize"))
                      | ((n["tag"] == "img") & n["attr_src"].contains("/image?")))
    targets = F.transform(photos, lambda n: urls.join_url(c("official_url"), F.coalesce(n["attr_href"], n["attr_src"])))
    df = with_page(landed(pages), "content").withColumns({
        "full_text": p.all_text(), "pairs": p.first_two_cells(), "lines": line_fields(p.strings),
        "heading": p.text(heading), "photo_urls": F.array_distinct(targets),
    }).drop("page")

    def of(label: str) -> Column:
        return lookup(c("pairs"), label)

    bracket = r"[【\[]([^】\]]+)[】\]](.+)"
    full = c("full_text")
    piece = F.get(F.filter(F.split(full, r"[。；\n]"), lambda s: s.contains("押標金")), F.lit(0))
    values = F.transform(F.concat("pairs", "lines"), lambda x: x["value"])
    df = df.withColumns({
        "official_case_number": extract(c("heading"), bracket, 1),
        "title": clean(F.coalesce(extract(c("heading"), bracket, 2), blank_to_null(of("物品名稱")), c("title"))),
        "period": F.split(F.coalesce(of("拍賣開始與截止日"), F.lit("")), "~", 2),
        "reserve_text": of("底價"), "round_text": of("拍賣次數"), "unit": of("拍賣單位"), "location": of("放置地點"),
        "deposit_text": F.coalesce(blank_to_null(of("押標金")), piece),
        "payment_text": lookup_containing(c("pairs"), "繳款期限", "付款期限"),
        "pickup_text": lookup_containing(c("pairs"), "領取期限", "提貨期限"),
        "registration_text": F.coalesce(lookup(c("lines"), "牌照異動登記"), F.lit("")),
        "brand": lookup(c("lines"), "廠牌"), "model": lookup(c("lines"), "型號"),
        "description": blank_to_null(clean(F.regexp_extract(full, "物品說明[:：]\\s*(.+?)(?:其他條款|注意事項)", 1))),
        "other_values": F.array_join(values, " "),
        "organization": F.coalesce(of("拍賣單位"), F.lit("未辨識機關")),
        "current_price": facts.money_before_yuan(full, "目前出價"),
        "sold_price": facts.money_before_yuan(full, "得標金額"),
    }).drop("pairs", "lines").withColumns({
        "combined": clean(F.concat_ws(" ", blank_to_null(c("registration_text")), c("description"))),
        "starts_at": dates.roc_datetime(F.get("period", F.lit(0))),
        "ends_at": dates.roc_datetime(F.get("period", F.lit(1))),
    }).withColumns({
        "identity_text": clean(F.concat_ws(" ", "title", "combined", "other_values")),
        "class_text": F.concat_ws(" ", "title", "combined"),
    })
    text = c("combined")
    digits = ascii_digits(text)
    made = r"出廠(?:年份|年月)[：:]?\s*(\d{4})[.年/-]?(\d{1,2})?"
    df = _classified(df, "identity_text", "class_text").withColumns({
        "reserve_price": amount(c("reserve_text")),
        "deposit": amount(c("deposit_text")),
        "auction_round": amount(c("round_text")).cast("int"),
        "payment_deadline": dates.roc_datetime(c("payment_text")),
        "pickup_deadline": dates.roc_datetime(c("pickup_text")),
        "status": facts.status_sale(full, c("sold_price"), c("result_record"), c("ends_at"), now),
        "fee_notes": distinct_sentences(text, "手續費|規費|拖吊費|保管費|過戶費|稅費|燃料費"),
        "registration_status": facts.registration_sale(text),
        "eligibility": facts.eligibility_sale(text, c("recycler_only")),
        "has_key": facts.four_state_or_conflict(text, facts.KEY_PLAIN),
        "can_start": facts.four_state_or_conflict(text, facts.START),
        "can_test": facts.four_state_or_conflict(text, facts.TEST),
        "tax_arrears": facts.four_state_or_conflict(text, facts.TAX),
        "fine_arrears": facts.four_state_or_conflict(text, facts.FINE),
        "fuel_fee_arrears": facts.four_state(text, facts.FUEL),
        "manufacture_year": to_int(extract(digits, made, 1)),
        "manufacture_month": to_int(extract(digits, made, 2)),
        "displacement_cc": amount(extract(digits, r"排氣量[：:]?\s*([\d,]+)\s*[cC][cC]", 1)).cast("int"),
        "color": extract(text, r"車身號碼[：:]?\s*[A-Z0-9-]+\s*([一-鿿]{1,3}色)", 1),
        "mileage_km": facts.mileage(text, "里程|公里數"),
        "plates": F.array_distinct(extract_all(c("identity_text"), SALE_PLATE)),
        "engine": extract(text, r"(?i)引擎號碼[：:]?\s*([A-Z0-9-]+)", 1),
        "frame": extract(text, r"(?i)車身號碼[：:]?\s*([A-Z0-9-]+)", 1),
        "lot_size": F.coalesce(to_int(extract(ascii_digits(c("title")), r"(\d+)\s*[臺台輛部]", 1)), F.lit(1)),
        "visible_damage": F.get(F.filter(F.split(text, "[。；]"), lambda s: s.rlike("生鏽|損壞|破損|刮傷")), F.lit(0)),
    })

    def phrase(pattern: str) -> Column:
        return F.coalesce(F.get(F.filter(F.split(text, "[。；]"), lambda s: s.rlike(pattern)), F.lit(0)), text)

    found = [
        evidence("reserve_price", c("reserve_price"), c("reserve_text"), "reserve_price"),
        evidence("auction_round", c("auction_round"), c("round_text"), "auction_round"),
        evidence("registration_status", c("registration_status"), c("registration_text"), "registration_status"),
        evidence("brand", c("brand"), c("brand"), "brand"),
        evidence("model", c("model"), c("model"), "model"),
        evidence("deposit", c("deposit"), c("deposit_text"), "deposit"),
        evidence("payment_deadline", iso_taipei(c("payment_deadline")), c("payment_text"), "payment_deadline"),
        evidence("pickup_deadline", iso_taipei(c("pickup_deadline")), c("pickup_text"), "pickup_deadline"),
        evidence("can_start", c("can_start"), F.when(is_known(c("can_start")), phrase("發不動|無法發動|不能發動|可發動|能發動"))),
        evidence("can_test", c("can_test"), F.when(is_known(c("can_test")), phrase("測試"))),
        evidence("tax_arrears", c("tax_arrears"), F.when(text.rlike(facts.TAX[0]), "無欠稅")),
        evidence("fine_arrears", c("fine_arrears"), F.when(text.rlike(facts.FINE[0]), "無道路交通違規事件")),
        *_classification_evidence(),
    ]
    first_plate = F.get("plates", F.lit(0))
    several = (c("lot_size") > 1) & (F.size("plates") >= 2)
    df = df.withColumns({
        "evidence": evidence_list(found),
        "official_title": F.coalesce(blank_to_null(c("heading")), c("title")),
        "bulk_lot": c("lot_size") > 1,
        "condition_summary": c("description"),
        "identifiers": present_identifiers(
            identifier("PLATE", first_plate), identifier("ENGINE", c("engine")), identifier("FRAME", c("frame"))),
        "vehicle_units": F.when(several, units_of(c("plates"))),
    })
    df = df.withColumns({
        **completeness({
            "identity": [has_text(c("vehicle_type")), has_text(c("brand")), has_text(c("model")),
                         c("manufacture_year").isNotNull(), has_items(c("identifiers"))],
            "auction": [has_text(c("unit")), c("ends_at").isNotNull(), c("reserve_price").isNotNull(), has_text(c("status")),
                        is_known(c("eligibility"))],
            "condition": _condition_flags(has_text(c("description"))),
            "registration": [is_known(c("registration_status")), _plates_present(), is_known(c("tax_arrears"))],
            "fees": [is_known(c(n)) for n in ("tax_arrears", "fine_arrears", "fuel_fee_arrears")],
            "media": [has_items(c("photo_urls"))],
        }),
        "error": F.when(blank_to_null(c("heading")).isNull(), "detail page has no heading"),
    })
    return df


# --- branch post ------------------------------------------------------------------------
def normalize_branch_post(pages: DataFrame, as_of) -> DataFrame:
    """Branch CMS post: meta title, body section and PDF links."""
    now = dates.instant(as_of)
    p = Page()
    named = p.first("meta", where=lambda n: n["attr_name"].isin("ContentTitle", "DC.Title"))
    heading = p.first("h2", where=lambda n: has_class(n, "title"))
    creator = p.first("meta", where=lambda n: n["attr_name"] == "DC.Creator")
    body = p.first("section", where=lambda n: has_class(n, "cp"))
    df = with_page(landed(pages), "content").withColumns({
        "title": F.coalesce(blank_to_null(clean(named["attr_content"])),
                            F.when(heading.isNotNull(), p.text(heading)).otherwise(clean(c("title")))),
        "body": F.when(body.isNotNull(), p.text(body)).otherwise(""),
        "organization": F.coalesce(
            blank_to_null(F.when(creator.isNotNull(), clean(creator["attr_content"])).otherwise(clean(c("organization")))),
            F.lit("法務部行政執行署（分署未確認）")),
        "attachment_urls": F.coalesce(c("attachment_urls"), attachment_urls("moj_enforcement_cms", c("official_url"))),
    }).drop("page").withColumn("combined", redact_private(F.concat_ws(" ", "title", "body"))).withColumn("sentences", sentences(c("combined")))
    text, parts = c("combined"), c("sentences")
    relevant = facts.is_vehicle_auction(c("title")) | facts.is_vehicle_auction(text)
    df = _identified(_classified(df, "combined"), "combined").withColumns({
        "official_case_number": extract(text, r"(\d{2,3}年度[^。；;]{0,20}?字第[\d、,，至-]+號)", 1),
        "ends_at": dates.official_datetime(text),
        "auction_round": facts.auction_round(text),
        "reserve_price": facts.money_after(text, "(?:核定)?底價"),
        "location": label_value(text, ["拍賣地點", "放置地點", "觀覽地點", "地點"]),
        "registration_status": facts.registration_enforcement(text),
        "eligibility": facts.eligibility_enforcement(text),
        "lot_size": F.greatest(F.lit(1), F.size("plates")),
        "description": blank_to_null(c("body")),
        "condition_summary": first_sentence(parts, "車況|刮傷|損壞|漏油|發動|鑰匙"),
        **_conditions("combined", facts.KEY_ATTACHED, facts.START, facts.TEST_BRANCH),
    }).withColumns({
        "status": facts.status_announced(c("ends_at"), now),
        "bulk_lot": c("vehicle_type").isin("UNKNOWN", "MIXED") | (c("lot_size") > 1) | text.rlike("一批|整批|及其他動產"),
        "error": F.when(~relevant, "post does not name a vehicle auction"),
    })
    found = [
        evidence("official_title", c("title"), c("title")),
        *_classification_evidence(F.when(text.contains("車輛"), F.lit("車輛"))),
        evidence("registration_status", c("registration_status"), first_sentence(parts, "領牌|過戶|報廢")),
        evidence("has_key", c("has_key"), first_sentence(parts, "鑰匙")),
    ]
    df = df.withColumn("evidence", evidence_list(found, link_evidence(c("attachment_urls"), "官方 PDF 附件", "HTML")))
    mixed, unknown = c("vehicle_type") == "MIXED", c("vehicle_type") == "UNKNOWN"
    df = suppress_for_mixed(df, mixed | unknown, ["color"]).withColumns({
        "official_title": c("title"),
        "disposal_origin": F.lit("ADMINISTRATIVE_ENFORCEMENT"),
        "identifiers": F.transform("plates", plate_identifier),
        "vehicle_units": separable_units(c("plates")),
        "photo_urls": F.array().cast("array<string>"),
    })
    media = (F.coalesce(c("pdf_count"), F.lit(0)) > 0) | has_items(c("attachment_urls"))
    df = df.withColumns(completeness({
        "identity": _identity_flags(), "auction": _auction_flags(), "condition": _condition_flags(has_text(c("body"))),
        "registration": [is_known(c("registration_status")), _plates_present(), never()],
        "fees": [never()] * 3, "media": [media],
    }))
    return df


# --- customs notice ---------------------------------------------------------------------
def normalize_customs(pages: DataFrame, as_of) -> DataFrame:
    """Customs announcement: the longest article scope and its download links."""
    now = dates.instant(as_of)
    p = Page()
    df = with_page(landed(pages), "content").withColumn("scope", article_scope(p))
    scoped = F.when(c("scope").isNotNull(), p.text(c("scope"))).otherwise(p.all_text())
    anchors = p.select("a", where=lambda n: n["attr_href"].isNotNull()
                       & (c("scope").isNull() | ((n["pos"] > c("scope.pos")) & (n["pos"] < c("scope.end")))))
    links = F.transform(anchors, lambda n: F.struct(
        urls.join_url(c("official_url"), n["attr_href"]).alias("url"),
        F.coalesce(blank_to_null(p.text(n)), F.lit("官方附件")).alias("label")))
    official = F.filter(links, lambda x: (urls.scheme(x["url"]) == "https") & (urls.host(x["url"]) == "web.customs.gov.tw")
                        & F.lower(urls.decode(urls.path(x["url"]))).startswith("/download/"))
    unique = F.aggregate(
        official, F.array().cast("array<struct<url:string,label:string>>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: y["url"] == x["url"]), acc).otherwise(F.concat(acc, F.array(x))))
    df = df.withColumns({"scope_text": scoped, "attachments": unique}).drop("page", "scope")
    df = df.withColumn("combined", clean(F.concat_ws(" ", c("title"), "scope_text"))).withColumn("sentences", sentences(c("combined")))
    text, parts = c("combined"), c("sentences")
    df = df.withColumns({
        "case_sentence": first_sentence(parts, r"(?:發文字號|標號|案號)\s*[：:]"),
        "auction_sentence": first_sentence(parts, "開標日期|開標時間"),
        "location_sentence": first_sentence(parts, "開標地點|看貨地點|存放地點"),
    })
    made = ascii_digits(label_value(text, ["出廠年月", "出廠日期", "出廠年份", "年份", "製造年月"]))
    counts = F.transform(extract_all(ascii_digits(text), r"(\d+)\s*輛", 1), lambda n: n.try_cast("int"))
    df = _classified(df, "combined").withColumns({
        "generic": facts.generic_vehicle_evidence(text),
        "organization": F.coalesce(item("organization"), F.lit("財政部關務署（關別未確認）")),
        "official_case_number": extract(c("case_sentence"), r"(?:發文字號|標號|案號)\s*[：:]\s*([^，,；;。\s]+)", 1),
        "ends_at": dates.official_datetime(c("auction_sentence")),
        "reserve_price": facts.money_after(text, "標售底價|底價"),
        "deposit": facts.money_after(text, "保證金|押標金"),
        "location": label_value(c("location_sentence"), ["開標地點", "看貨地點", "存放地點"]),
        "brand": label_value(text, ["廠牌名稱", "廠牌"]),
        "model": label_value(text, ["型號", "型式", "車型"]),
        "displacement_cc": amount(label_value(text, ["排氣量", "汽缸容量"])).cast("int"),
        "manufacture_year": facts.western_year(extract(made, r"(\d{2,4})", 1)),
        "plates": facts.plates(text, numeric_needs_label=False),
        "counts": counts,
        "registration_status": facts.registration_customs(text),
        "eligibility": facts.eligibility_customs(text),
        "description": blank_to_null(c("scope_text")),
    }).withColumns({
        "status": facts.status_customs(text, c("ends_at"), now),
        "lot_size": F.coalesce(F.array_max("counts"), F.greatest(F.lit(1), F.size("plates"))),
    })
    found = [
        evidence("title", c("title"), c("title")),
        evidence("organization", c("organization"), c("organization")),
        evidence("official_case_number", c("official_case_number"), c("case_sentence")),
        evidence("ends_at", iso_taipei(c("ends_at")), c("auction_sentence")),
        *_classification_evidence(c("generic")),
        evidence("location", c("location"), c("location_sentence")),
    ]
    attached = F.transform("attachments", lambda x: evidence("official_attachment_url", x["url"], x["label"], method="HTML_LINK"))
    typed = c("vehicle_type") != "UNKNOWN"
    df = df.withColumns({
        "evidence": evidence_list(found, attached),
        "official_title": c("title"),
        "disposal_origin": F.lit("CUSTOMS_FORFEITURE"),
        "bulk_lot": (c("lot_size") > 1) | (c("vehicle_type") == "MIXED"),
        "identifiers": F.transform("plates", plate_identifier),
        "photo_urls": F.array().cast("array<string>"),
        **customs_scores(
            [_plates_present(), has_text(c("brand")), has_text(c("model")), typed],
            _auction_flags(), c("registration_status"), c("deposit"), c("attachments")),
        "error": F.when(~typed & c("generic").isNull(), "notice names no vehicle in the landed HTML"),
    })
    return df


NORMALIZERS: dict[str, Callable[[DataFrame, object], DataFrame]] = {
    "shwoo": normalize_sale,
    "judicial": normalize_court,
    "pcc": normalize_procurement,
    "moj_auction": normalize_seized,
    "moj_enforcement": normalize_enforcement,
    "moj_enforcement_cms": normalize_branch_post,
    "customs": normalize_customs,
}


def normalize(source: str, pages: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """Records and errors of one source's landed pages."""
    return split(NORMALIZERS[source](pages, as_of))


def outcomes(source: str, pages: DataFrame, as_of, carry: Iterable[str] = ()) -> DataFrame:
    """One row per landed page: its record's fields, ``error`` (NULL for a record) and the page's own columns to carry on."""
    return outcome_rows(NORMALIZERS[source](pages, as_of), carry)

