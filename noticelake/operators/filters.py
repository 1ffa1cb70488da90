"""Marketplace predicates and the filter set they are combined from."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.classify import displacement_band
from ..functions.dates import instant
from ..functions.text import safe_search_term
from ..schemas import ENDED_STATUSES

c = F.col
UNSELLABLE = ["SCRAP_ONLY", "CANNOT_RELICENSE"]
VIEWS = ["active", "ended", "favorites", "scrap", "all"]


@dataclass
class Filters:
    """One marketplace request. ``None`` and empty mean: do not filter."""

    market_view: str = "active"
    sort: str = "auction_asc"
    keyword: str | None = None
    source: str | None = None
    disposal_origin: str | None = None
    county: str | None = None
    brand: str | None = None
    eligibility: str | None = None
    registration: str | None = None
    vehicle_type: str | None = None
    vehicle_class: str | None = None
    car_category: str | None = None
    displacement_bands: list[str] = field(default_factory=list)
    has_photos: bool = False
    single_vehicle: bool = False
    exclude_scrap: bool = False
    auction_within_days: float | None = None
    min_price: float | None = None
    max_price: float | None = None


# Named presets of the search page.
PRESETS = {
    "public_bidding": {"eligibility": "NATURAL_PERSON_ALLOWED", "exclude_scrap": True},
    "normal_transfer": {"registration": "NORMAL_TRANSFER"},
    "photo_single": {"has_photos": True, "single_vehicle": True},
    "within_week": {"auction_within_days": 7},
}

EQUALITY = {
    "source": "source_adapter", "disposal_origin": "disposal_origin", "county": "county", "brand": "brand_name",
    "eligibility": "eligibility", "registration": "registration_status", "vehicle_type": "vehicle_type",
    "vehicle_class": "vehicle_category", "car_category": "car_category",
}


def is_scrap() -> Column:
    return F.coalesce(
        (c("disposal_origin") == "SCRAP_DISPOSAL") | c("registration_status").isin(UNSELLABLE)
        | (c("eligibility") == "LICENSED_RECYCLER_ONLY"),
        F.lit(False),
    )


def is_ended(as_of) -> Column:
    """Ended by status or by a passed deadline; a missing deadline has not passed."""
    return F.coalesce(c("auction_status").isin(ENDED_STATUSES), F.lit(False)) | F.coalesce(
        c("auction_at") < instant(as_of), F.lit(False))


def in_bands(bands: list[str]) -> Column:
    """Any of the selected bands; UNKNOWN selects missing sizes only."""
    return F.coalesce(displacement_band(c("displacement_cc")).isin(bands), F.lit(False))


def keyword_matches(keyword: str) -> Column:
    """Case-insensitive substring of the stored search text; wildcards are plain characters."""
    return c("search_text").contains(F.lower(safe_search_term(F.lit(keyword))))


def squeezed(text: Column) -> Column:
    """A text without any white space."""
    return F.regexp_replace(text, P.SPACE, "")


def loose_text() -> Column:
    """The seven displayed fields in lower case without white space."""
    fields = ["name", "brand_name", "model_name", "plate_number", "official_title", "organization_name", "storage_location"]
    return squeezed(F.lower(F.array_join(F.filter(F.array(*fields), lambda x: x != ""), " ")))


def keyword_matches_loosely(keyword: str) -> Column:
    """The same ignoring all white space, over the seven displayed fields."""
    return loose_text().contains(squeezed(F.lower(F.trim(F.lit(keyword)))))


def within_days(as_of, days: float) -> Column:
    now = instant(as_of)
    until = F.timestamp_micros((F.unix_micros(now) + F.lit(int(days * 86_400_000_000))).cast("bigint"))
    return c("auction_at").between(now, until)


def apply_filters(df: DataFrame, filters: Filters, as_of, favorites: DataFrame | None = None) -> DataFrame:
    """Keep the listing rows a request selects. ``favorites`` has one ``id`` per saved row."""
    view = filters.market_view
    df = df.filter(is_scrap() if view == "scrap" else ~is_scrap())
    if view == "active":
        df = df.filter(~is_ended(as_of))
    elif view == "ended":
        df = df.filter(is_ended(as_of))
    elif view == "favorites":
        if favorites is None:
            return df.filter(F.lit(False))
        df = df.join(favorites.select("id").distinct(), "id", "left_semi")
    if filters.keyword and filters.keyword.strip():
        df = df.filter(keyword_matches(filters.keyword))
    for name, column in EQUALITY.items():
        value = getattr(filters, name)
        if value:
            df = df.filter(c(column) == value)
    if filters.displacement_bands:
        df = df.filter(in_bands(filters.displacement_bands))
    if filters.single_vehicle:
        df = df.filter(~c("bulk_lot"))
    if filters.has_photos:
        df = df.filter(c("has_cached_photo"))
    if filters.exclude_scrap:
        df = df.filter(~c("registration_status").isin(UNSELLABLE))
    if filters.min_price is not None:
        df = df.filter(c("display_price") >= filters.min_price)
    if filters.max_price is not None:
        df = df.filter(c("display_price") <= filters.max_price)
    if filters.auction_within_days:
        df = df.filter(within_days(as_of, filters.auction_within_days))
    return df


def visible(df: DataFrame) -> DataFrame:
    """Anonymous readers see active public rows only."""
    return df.filter(c("active"))


def showcase(df: DataFrame, view: str, as_of, within: float | None = None, vehicle_class: str | None = None,
             bands: list[str] | None = None) -> DataFrame:
    """Demonstration list: a strict "now" boundary and no scrap rule."""
    now = instant(as_of)
    df = df.filter(c("auction_at") >= now if view == "active" else c("auction_at") < now)
    if within is not None:
        df = df.filter(within_days(as_of, within))
    if vehicle_class:
        df = df.filter(c("vehicle_category") == vehicle_class)
    return df.filter(in_bands(bands)) if bands else df
