"""Vehicle class, type and category from explicit official wording only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import VEHICLE_CLASSES
from . import patterns as P
from .text import clean, first_match, holds, let, matches


def _pair(value: str | Column, source: Column) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.struct(value.alias("value"), source.alias("text"))


def _unknown() -> Column:
    return _pair("UNKNOWN", F.lit(None).cast("string"))


def _first_wording(c: Column, wording: list[tuple[str, str]]) -> Column:
    chain = None
    for value, pattern in wording:
        hit = _pair(value, F.regexp_extract(c, pattern, 0))
        chain = F.when(matches(c, pattern), hit) if chain is None else chain.when(matches(c, pattern), hit)
    return chain


def vehicle_class(c: Column) -> Column:
    """Motorcycle class struct<value,text>; displacement is never proof of a class."""
    return let(clean(c), lambda t: _first_wording(t, P.CLASS_WORDING).otherwise(_unknown()))


def vehicle_type(c: Column) -> Column:
    """MOTORCYCLE, CAR or MIXED with the wording that says so; fuel-fee text is no car."""
    lot = let(clean(c), lambda t: F.when(holds(t, P.NEEDED[P.FUEL_FEE_WORDING]), F.regexp_replace(t, P.FUEL_FEE_WORDING, "燃料費")).otherwise(t))
    words = let(lot, lambda t: F.array(*[
        first_match(t, p) for p in (P.COMBINED_VEHICLE_WORDING, P.MOTORCYCLE_WORDING, P.CAR_WORDING)]))
    return let(words, _type_of_words)


def _type_of_words(words: Column) -> Column:
    both, moto, car = (F.get(words, F.lit(i)) for i in range(3))
    return (
        F.when(both != "", _pair("MIXED", both))
        .when((moto != "") & (car != ""), _pair("MIXED", F.concat(moto, F.lit("、"), car)))
        .when(moto != "", _pair("MOTORCYCLE", moto))
        .when(car != "", _pair("CAR", car))
        .otherwise(_unknown())
    )


def car_category(c: Column, known_type: Column | None = None) -> Column:
    """Body or use category; a car without one is OTHER. known_type: the text's vehicle type, where that is known already."""
    return let(
        clean(c),
        lambda t: _first_wording(t, P.CATEGORY_WORDING)
        .when((vehicle_type(t)["value"] if known_type is None else known_type) == "CAR", _pair("OTHER", F.lit("汽車")))
        .otherwise(_unknown()),
    )


def displacement_band(cc: Column) -> Column:
    """Band of an engine size; missing is UNKNOWN, zero and below belong to no band."""
    return (
        F.when(cc.isNull(), "UNKNOWN")
        .when(cc <= 0, F.lit(None).cast("string"))
        .when(cc <= 125, "LE_125")
        .when(cc <= 150, "CC_126_150")
        .when(cc <= 250, "CC_151_250")
        .when(cc <= 550, "CC_251_550")
        .otherwise("GT_550")
    )


def county(c: Column) -> Column:
    """Explicit county in a text, else the seat hinted at by a court or office name."""
    return let(F.translate(F.coalesce(c, F.lit("")), "台", "臺"), _county)


def _county(value: Column) -> Column:
    explicit = F.regexp_extract(value, "|".join(P.COUNTIES), 0)
    chain = F.when(explicit != "", explicit)
    for hint, name in P.COUNTY_HINTS:
        chain = chain.when(value.contains(hint), F.lit(name))
    return chain


def county_prefix(c: Column) -> Column:
    """County at the very start of an address, for display when none was stored."""
    return F.nullif(F.regexp_extract(c, r"^(臺北市|新北市|桃園市|臺中市|臺南市|高雄市|基隆市|新竹市|嘉義市|[^市縣]{2,3}[縣市])", 1), F.lit(""))


# Free-text classes of earlier records.
LEGACY_CLASSES = {
    "普通輕型機車": "ORDINARY_LIGHT", "普通重型機車": "ORDINARY_HEAVY", "大型重型機車": "LARGE_HEAVY",
    "電動機車": "ELECTRIC_MOTORCYCLE", "普通重型電動機車": "ELECTRIC_MOTORCYCLE", "重型機車": "HEAVY_UNSPECIFIED",
}


def class_of_legacy_text(c: Column) -> Column:
    """Enumerated class of an earlier free-text column; enumerated values pass through."""
    known = {**LEGACY_CLASSES, **{name: name for name in VEHICLE_CLASSES}}
    lookup = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, c), F.lit("UNKNOWN"))


def type_from_class(vehicle_type_column: Column, class_column: Column) -> Column:
    """Back-fill: a known motorcycle class makes an unknown type MOTORCYCLE."""
    return F.when((vehicle_type_column == "UNKNOWN") & (class_column != "UNKNOWN"), "MOTORCYCLE").otherwise(
        vehicle_type_column
    )
