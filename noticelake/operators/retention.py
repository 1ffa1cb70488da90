"""Retention of private artifacts and of publicly shown plates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import instant, retention_deadline
from ..functions.redact import plate_still_public

c = F.col
REASON = "12-month private artifact retention expired"


def backfill_deadlines(artifacts: DataFrame, events: DataFrame) -> DataFrame:
    """Fill missing deadlines: the record's latest end, else fetching, plus twelve months."""
    ends = events.groupBy("record_id").agg(F.max("ends_at").alias("_ends"))
    deadline = F.coalesce(c("retention_until"), retention_deadline(c("_ends"), c("fetched_at")))
    return artifacts.join(ends, "record_id", "left").withColumn("retention_until", deadline).drop("_ends")


def retention_plan(artifacts: DataFrame, tombstones: DataFrame, as_of, within: tuple[str, ...] = ()) -> DataFrame:
    """Expired artifacts without a tombstone. Order by (retention_until, id) when listing them.

    ``within``: columns of both frames, where an id is unique only beside them.
    """
    due = artifacts.filter(c("retention_until") <= instant(as_of))
    buried = tombstones.select(c("artifact_id").alias("id"), *within).distinct()
    return due.join(buried, ["id", *within], "left_anti").select("id", "storage_path", "checksum_sha256", "retention_until")


def tombstones_for(plan: DataFrame, as_of) -> DataFrame:
    return plan.select(
        c("id").alias("artifact_id"), "storage_path", "checksum_sha256", F.lit(REASON).alias("reason"),
        instant(as_of).alias("deleted_at"))


def clear_expired_plates(listings: DataFrame, as_of) -> DataFrame:
    """Hide plates whose auction end is unknown or more than thirty days ago."""
    keep = plate_still_public(c("ends_at"), instant(as_of))
    return listings.withColumn("plate_number", F.when(keep, c("plate_number")))
