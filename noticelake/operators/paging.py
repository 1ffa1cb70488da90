"""Sorting, keyset pages and cursors.

A page is a filter on the position of the last row plus ``orderBy`` and ``limit``, which
Spark runs as one top-n: each task keeps n+1 rows and nothing is sorted globally.
"""

from __future__ import annotations

import base64
import json
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import let

c = F.col

# sort name -> (column, ascending)
SORTS = {
    "auction_asc": ("auction_at", True),
    "auction_desc": ("auction_at", False),
    "price_asc": ("display_price", True),
    "price_desc": ("display_price", False),
    "completeness_desc": ("completeness", False),
}
DEFAULT_LIMIT, MAX_LIMIT = 24, 100


def sort_order(sort: str) -> list[Column]:
    """Missing values last in both directions; the id breaks ties."""
    column, ascending = SORTS[sort]
    key = c(column).asc_nulls_last() if ascending else c(column).desc_nulls_last()
    return [key, c("id").asc()]


def sort_listing(df: DataFrame, sort: str = "auction_asc") -> DataFrame:
    return df.orderBy(*sort_order(sort))


def clamp_limit(limit: float | None) -> int:
    return int(min(max(limit or DEFAULT_LIMIT, 1), MAX_LIMIT))


def after(df: DataFrame, sort: str, value, row_id) -> DataFrame:
    """Rows behind a position: beyond its value, equal with a greater id, or missing."""
    column, ascending = SORTS[sort]
    key = c(column)
    if value is None:
        return df.filter(key.isNull() & (c("id") > row_id))
    mark = F.lit(value).cast(df.schema[column].dataType)
    beyond = key > mark if ascending else key < mark
    return df.filter(beyond | ((key == mark) & (c("id") > row_id)) | key.isNull())


def page_rows(df: DataFrame, sort: str = "auction_asc", limit: int = DEFAULT_LIMIT, cursor: str | None = None) -> DataFrame:
    """One row more than the page, so that the caller can tell whether another follows."""
    position = decode_cursor(cursor)
    if position and position["sort"] == sort:
        df = after(df, sort, position["value"], position["id"])
    return df.orderBy(*sort_order(sort)).limit(clamp_limit(limit) + 1)


def page(df: DataFrame, sort: str = "auction_asc", limit: int = DEFAULT_LIMIT, cursor: str | None = None):
    """A page as at most 100 driver rows and the cursor of the next one (or None)."""
    size = clamp_limit(limit)
    rows = page_rows(df, sort, size, cursor).collect()
    shown = rows[:size]
    more = len(rows) > size
    return shown, encode_cursor(sort, shown[-1][SORTS[sort][0]], shown[-1]["id"]) if more else None


def count(df: DataFrame) -> DataFrame:
    """Exact number of rows a request selects, beside its page."""
    return df.agg(F.count(F.lit(1)).alias("total"))


# --- cursors -----------------------------------------------------------------------------
def encode_cursor(sort: str, value, row_id) -> str:
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    if isinstance(value, Decimal):
        value = float(value)
    body = json.dumps({"version": 1, "sort": sort, "value": value, "id": str(row_id)}, separators=(",", ":"))
    return base64.urlsafe_b64encode(body.encode()).decode().rstrip("=")


def decode_cursor(cursor: str | None) -> dict | None:
    """The position a cursor names; anything unreadable means: start at the first page."""
    if not cursor:
        return None
    try:
        position = json.loads(base64.urlsafe_b64decode(cursor + "=" * (-len(cursor) % 4)))
    except (ValueError, UnicodeDecodeError):
        return None
    usable = (
        isinstance(position, dict) and position.get("version") == 1 and position.get("sort") in SORTS
        and isinstance(position.get("id"), str)
        and isinstance(position.get("value"), (str, int, float, type(None))) and not isinstance(position.get("value"), bool)
    )
    return position if usable else None


CURSOR = T.StructType([
    T.StructField("version", T.IntegerType()), T.StructField("sort", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("id", T.StringType()),
])


def cursor_column(sort: str) -> Column:
    """Cursor of every row of a listing, computed in the JVM."""
    body = F.to_json(
        F.struct(F.lit(1).alias("version"), F.lit(sort).alias("sort"), c(SORTS[sort][0]).alias("value"),
                 c("id").cast("string").alias("id")),
        {"ignoreNullFields": "false"},
    )
    # base64 in its URL form; single replacements, since translating looks every character up
    encoded = F.base64(F.encode(body, "utf-8"))
    for mark, instead in (("\r\n", ""), ("+", "-"), ("/", "_"), ("=", "")):
        encoded = F.replace(encoded, F.lit(mark), F.lit(instead))
    return encoded


def cursor_position(cursor: Column) -> Column:
    """Decoded cursor struct, or NULL for one that is unreadable. A cursor is decoded once, however many fields are checked."""
    usual = F.replace(F.replace(cursor, F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))
    plain = F.decode(F.try_to_binary(usual, F.lit("base64")), "utf-8")
    return let(F.from_json(plain, CURSOR), lambda p: F.when(
        (p["version"] == 1) & p["sort"].isin(list(SORTS)) & p["id"].isNotNull(), p))
