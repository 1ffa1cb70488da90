"""Registry of sources: access policies and endpoints, kept up to date by keyed upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .upsert import upsert

c = F.col


def upsert_policies(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """One policy per source_id; the latest review wins."""
    return upsert(stored, incoming, ["source_id"], None, c("reviewed_at"))


def upsert_endpoints(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """One endpoint per (source_id, endpoint_url); a stored one keeps its id, the other columns follow the incoming row."""
    return upsert(stored, incoming, ["source_id", "endpoint_url"], {"id": "keep"})


def resolve_endpoints(values: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Endpoint values by adapter_name with their source_id, and those whose adapter is no known source."""
    known = sources.select("adapter_name", c("id").alias("source_id")).distinct()
    found = values.join(known, "adapter_name")
    return found, values.join(known, "adapter_name", "left_anti").withColumn("error", F.lit("no source with this adapter"))
