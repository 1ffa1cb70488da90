"""Marketplace query strings -> filters: one request in Python, a table of them in Spark."""

from __future__ import annotations

from urllib.parse import parse_qsl

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import COUNTIES
from ..functions.urls import decode_form, repair_escapes
from ..schemas import (
    BID_ELIGIBILITIES, CAR_CATEGORIES, DISPOSAL_ORIGINS, REGISTRATION_STATUSES, SOURCES, VEHICLE_CLASSES, VEHICLE_TYPES,
)
from .filters import VIEWS, Filters
from .paging import DEFAULT_LIMIT, MAX_LIMIT, SORTS

c = F.col
# The query codes of the displacement bands.
BAND_CODES = {
    "le-125": "LE_125", "126-150": "CC_126_150", "151-250": "CC_151_250", "251-550": "CC_251_550", "gt-550": "GT_550",
    "unknown": "UNKNOWN",
}
CHOICES = {
    "source": SOURCES, "origin": DISPOSAL_ORIGINS, "county": COUNTIES, "eligibility": BID_ELIGIBILITIES,
    "registration": REGISTRATION_STATUSES, "vehicleClass": VEHICLE_CLASSES, "vehicleType": VEHICLE_TYPES,
    "carCategory": CAR_CATEGORIES,
}
FLAGS = ["hasPhotos", "singleVehicle", "excludeScrap"]
MAX_NUMBER = 9_007_199_254_740_991.0


def normalize_queries(df: DataFrame, query: str = "query") -> DataFrame:
    """Add one typed column per parameter plus ``limit``, ``cursor`` and ``canonical_query``.

    Unknown values, out-of-range numbers and contradictory type filters drop out.
    """
    pairs = F.transform(
        F.filter(F.split(F.regexp_replace(c(query), r"^\?", ""), "&"), lambda p: p != ""),
        lambda p: F.struct(
            _form(F.regexp_extract(p, r"^[^=]*", 0)).alias("key"),
            _form(F.regexp_extract(p, r"^[^=]*=?(.*)$", 1)).alias("value")),
    )
    df = df.withColumn("_pairs", pairs)

    def first(key: str) -> Column:
        return F.get(F.filter("_pairs", lambda p: p["key"] == key), F.lit(0))["value"]

    def choice(key: str, allowed: list[str]) -> Column:
        value = first(key)
        return F.when(value.isin(allowed), value)

    def number(text: Column, maximum: float = MAX_NUMBER) -> Column:
        value = F.when(F.trim(text) != "", F.trim(text).try_cast("double"))
        return F.when(value.between(0, maximum), value)

    def words(key: str) -> Column:
        return F.nullif(F.trim(first(key)), F.lit(""))

    codes = F.create_map(*[F.lit(x) for pair in BAND_CODES.items() for x in pair])
    cc_parts = F.flatten(F.transform(F.filter("_pairs", lambda p: p["key"] == "cc"), lambda p: F.split(p["value"], ",")))
    price = F.split(first("price"), "-")
    asked = first("limit").try_cast("double")
    df = df.withColumns({
        "view": F.coalesce(choice("view", VIEWS), F.lit("active")),
        "sort": F.coalesce(choice("sort", list(SORTS)), F.lit("auction_asc")),
        "keyword": words("keyword"),
        "brand": words("brand"),
        **{k: choice(k, v) for k, v in CHOICES.items()},
        **{k: F.coalesce(first(k) == "true", F.lit(False)) for k in FLAGS},
        "_cc": F.filter(cc_parts, lambda p: p.isin(list(BAND_CODES))),
        "_price_low": number(F.get(price, F.lit(0))), "_price_high": number(F.get(price, F.lit(1))),
        "_min": number(first("minPrice")), "_max": number(first("maxPrice")),
        "_within": number(first("within"), 365),
        "limit": F.floor(F.least(F.greatest(
            F.coalesce(F.nullif(F.nanvl(asked, F.lit(0.0)), F.lit(0.0)), F.lit(float(DEFAULT_LIMIT))), F.lit(1.0)),
            F.lit(float(MAX_LIMIT)))).cast("int"),
        "cursor": first("cursor"),
    }).withColumns({
        "within": F.when((c("view") != "ended") & (c("_within") > 0), c("_within")),
        "minPrice": F.coalesce("_min", "_price_low"),
        "maxPrice": F.coalesce("_max", "_price_high"),
        "_bands": F.array_distinct(F.transform("_cc", lambda p: F.try_element_at(codes, p))),
    })
    return _exclusive(df).withColumn("canonical_query", _canonical()).drop(
        "_pairs", "_cc", "_price_low", "_price_high", "_min", "_max", "_within", "_bands", "_moto")


def _form(text: Column) -> Column:
    return decode_form(repair_escapes(text))


def _exclusive(df: DataFrame) -> DataFrame:
    """Car category means cars only; class or engine size means motorcycles only."""
    has_car = c("carCategory").isNotNull()
    moto = c("vehicleClass").isNotNull() | (F.size("_bands") > 0)
    kind = F.when(has_car, "CAR").when(moto, "MOTORCYCLE").otherwise(c("vehicleType"))
    return df.withColumn("_moto", F.coalesce(~has_car & moto, F.lit(False))).withColumns({
        "vehicleType": kind,
        "vehicleClass": F.when(c("_moto"), c("vehicleClass")),
        "displacementBands": F.when(c("_moto") & (F.size("_bands") > 0), c("_bands")),
    })


def _canonical() -> Column:
    def text(key: str, name: str | None = None) -> Column:
        return F.concat(F.lit(f"{key}="), F.url_encode(c(name or key)))

    def plain(value: Column) -> Column:
        whole = value == F.floor(value)
        return F.coalesce(F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string")), F.lit(""))

    priced = c("minPrice").isNotNull() | c("maxPrice").isNotNull()
    cc = F.array_join(F.transform("_cc", lambda p: F.concat(F.lit("cc="), p)), "&")
    return F.concat_ws(
        "&", text("view"), text("keyword"), text("county"), text("source"), text("origin"), text("brand"),
        text("vehicleClass"), text("vehicleType"), text("carCategory"),
        F.when(c("displacementBands").isNotNull(), cc), text("eligibility"), text("registration"),
        F.when(priced, F.concat(F.lit("price="), plain(c("minPrice")), F.lit("-"), plain(c("maxPrice")))),
        *[F.when(c(k), F.lit(f"{k}=true")) for k in FLAGS],
        F.when(c("within").isNotNull(), F.concat(F.lit("within="), plain(c("within")))),
        F.when(c("sort") != "auction_asc", text("sort")),
    )


def parse_query(query: str) -> tuple[Filters, int, str | None]:
    """One request: its filters, page size and cursor."""
    pairs = parse_qsl(query.removeprefix("?"), keep_blank_values=True)
    first = {k: v for k, v in reversed(pairs)}

    def choice(key: str, allowed) -> str | None:
        return first[key] if first.get(key) in allowed else None

    def number(text: str | None, maximum: float = MAX_NUMBER) -> float | None:
        try:
            value = float(text or "")
        except ValueError:
            return None
        return value if 0 <= value <= maximum else None

    view = choice("view", VIEWS) or "active"
    codes = [part for k, v in pairs if k == "cc" for part in v.split(",")]
    low, _, high = (first.get("price") or "").partition("-")
    filters = Filters(
        market_view=view, sort=choice("sort", SORTS) or "auction_asc",
        keyword=(first.get("keyword") or "").strip() or None, brand=(first.get("brand") or "").strip() or None,
        source=choice("source", SOURCES), disposal_origin=choice("origin", DISPOSAL_ORIGINS),
        county=choice("county", COUNTIES), eligibility=choice("eligibility", BID_ELIGIBILITIES),
        registration=choice("registration", REGISTRATION_STATUSES), vehicle_type=choice("vehicleType", VEHICLE_TYPES),
        vehicle_class=choice("vehicleClass", VEHICLE_CLASSES), car_category=choice("carCategory", CAR_CATEGORIES),
        displacement_bands=list(dict.fromkeys(BAND_CODES[x] for x in codes if x in BAND_CODES)),
        has_photos=first.get("hasPhotos") == "true", single_vehicle=first.get("singleVehicle") == "true",
        exclude_scrap=first.get("excludeScrap") == "true",
        auction_within_days=None if view == "ended" else number(first.get("within"), 365) or None,
        min_price=_first_given(number(first.get("minPrice")), number(low)),
        max_price=_first_given(number(first.get("maxPrice")), number(high.partition("-")[0])),
    )
    motorcycles = not filters.car_category and bool(filters.vehicle_class or filters.displacement_bands)
    if filters.car_category:
        filters.vehicle_type = "CAR"
    if motorcycles:
        filters.vehicle_type = "MOTORCYCLE"
    else:
        filters.vehicle_class, filters.displacement_bands = None, []
    asked = number(first.get("limit"), float("inf")) if not (first.get("limit") or "").startswith("-") else 1
    return filters, int(min(max(asked or DEFAULT_LIMIT, 1), MAX_LIMIT)), first.get("cursor")


def _first_given(*values):
    return next((v for v in values if v is not None), None)
