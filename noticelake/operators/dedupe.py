"""First, last and top-k rows per key.

All are ranked windows filtered on the rank. Spark turns such a filter into a group
limit that runs before the shuffle as well as after it, so each task ships at most k
rows per key and a key holding a third of the table never reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each key in the given order; keep the rank if named."""
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def first_per_key(df: DataFrame, keys: list[str], arrival: Column) -> DataFrame:
    return top_per_key(df, keys, [arrival.asc()])


def last_per_key(df: DataFrame, keys: list[str], arrival: Column) -> DataFrame:
    return top_per_key(df, keys, [arrival.desc()])

