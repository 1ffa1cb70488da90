"""Unnesting arrays, and keeping finished columns finished."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, items: Column | str, name: str, *keep: str | Column, position: str | None = None) -> DataFrame:
    """One row per array element with the kept columns, and its position if named.

    The outer form is used and empty arrays are dropped afterwards: for the inner form the
    optimizer derives a size filter and pushes it, with the whole array expression, below
    the projections that computed it.
    """
    pos = position or "_position"
    flat = df.select(*keep, F.posexplode_outer(items).alias(pos, name)).filter(F.col(pos).isNotNull())
    return flat if position else flat.drop(pos)


def settle(df: DataFrame) -> DataFrame:
    """Keep later filters above the columns of ``df``.

    A filter on a derived column is normally rewritten into the expressions below it; over
    a long chain of text rules that means computing everything twice or more. The filter
    on the (non-deterministic) partition number holds for every row and ends the rewrite.
    """
    return df.withColumn("_part", F.spark_partition_id()).filter(F.col("_part") >= 0).drop("_part")
