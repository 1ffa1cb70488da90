"""Republic-of-China dates. All results are instants; notices are in Taipei time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import ascii_digits, blank_to_null, let

ZONE = "Asia/Taipei"


def instant(as_of: Column | datetime | str) -> Column:
    """The caller's reference time as a timestamp Column."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def _gregorian(year: Column) -> Column:
    return F.when(year < 1911, year + 1911).otherwise(year)


def _make(parts: Column) -> Column:
    """Timestamp from [year, month, day, hour?, minute?, second?] strings; impossible -> NULL."""

    def number(i: int, default: int | None = None) -> Column:
        value = blank_to_null(F.get(parts, F.lit(i))).try_cast("int")
        return value if default is None else F.coalesce(value, F.lit(default))

    return F.try_make_timestamp(
        let(number(0), _gregorian), number(1), number(2), number(3, 0), number(4, 0),
        number(5, 0).cast("decimal(16,6)"), F.lit(ZONE),
    )


def roc_datetime(c: Column) -> Column:
    """``115/08/12 12:00:00``. Four-digit years from 1911 on are kept as they are."""
    found = let(ascii_digits(c), lambda t: F.when(t.contains("/"), F.regexp_extract(t, P.SLASH_DATE, 0)))
    return let(F.split(found, r"[/:\s]+"), _make)


def roc_list_date(c: Column) -> Column:
    """``115-08-12`` with dash, dot or slash, as printed in announcement lists."""
    return let(F.split(F.regexp_extract(ascii_digits(c), P.LIST_DATE, 0), r"[-/.]"), _make)


def roc_compact_date(c: Column) -> Column:
    """``1150819``: two or three year digits, month, day; other lengths are no date."""
    digits = F.regexp_replace(ascii_digits(c), r"\D", "")
    return let(F.split(F.regexp_replace(digits, r"^(\d{2,3})(\d{2})(\d{2})$", "$1-$2-$3"), "-"), _make)


def official_datetime(c: Column) -> Column:
    """Slash date first, else ``115年8月20日上午10時30分`` with the 12-hour rule."""
    return let(ascii_digits(c), lambda digits: F.coalesce(roc_datetime(digits), _worded(digits)))


def _worded(digits: Column) -> Column:
    found = F.regexp_extract(digits, "(?U)" + P.WORDED_DATE, 0)
    fields = F.regexp_replace(found, "(?U)" + P.WORDED_DATE, "$1|$2|$3|$4|$5|$6")
    return let(F.split(fields, r"\|"), _from_words)


def _from_words(parts: Column) -> Column:
    half = F.get(parts, F.lit(3))
    hour24 = let(
        F.coalesce(blank_to_null(F.get(parts, F.lit(4))).try_cast("int"), F.lit(0)),
        lambda hour: F.when((half == "下午") & (hour < 12), hour + 12).when((half == "上午") & (hour == 12), F.lit(0))
        .otherwise(hour),
    )
    return let(F.concat(F.slice(parts, 1, 3), F.array(hour24.cast("string")), F.slice(parts, 6, 1)), _make)


def normalized_yyyymmdd(c: Column) -> Column:
    """Eight digits stay; ``115/8/3`` becomes 20260803; anything else keeps its digits."""
    digits = F.regexp_replace(ascii_digits(F.coalesce(c, F.lit(""))), r"\D", "")
    parts = F.split(F.trim(ascii_digits(c)), "/")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i)).try_cast("int")

    roc = F.concat(
        F.lpad((part(0) + 1911).cast("string"), 4, "0"), F.lpad(part(1).cast("string"), 2, "0"),
        F.lpad(part(2).cast("string"), 2, "0"),
    )
    is_roc = F.trim(ascii_digits(c)).rlike(r"^\d{2,3}/\d{1,2}/\d{1,2}$")
    return F.when(F.length(digits) == 8, digits).when(is_roc, roc).otherwise(digits)


def retention_deadline(ends_at: Column, fetched_at: Column, months: int = 12) -> Column:
    """Twelve months after the end, or after fetching when no end is known.

    Month arithmetic on the instant keeps the time of day.
    """
    return F.coalesce(ends_at, fetched_at) + F.make_ym_interval(F.lit(0), F.lit(months))
