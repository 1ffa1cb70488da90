"""Stream forms run to completion over the supplied events; the batch result is the oracle."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from noticelake.operators import versioned
from noticelake.session import shared_dir
from noticelake.streaming import jobs

from .derive import base
from .history import MONTH, SIGHTINGS
from .registry import Registry

c = F.col
query = Registry()


def events_stream(spark, sf_dir):
    schema = base(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"


@query("stream_changes", "WITH " + SIGHTINGS + " SELECT DISTINCT record_id, payload_checksum, parser_version FROM sightings")
def stream_changes(spark, sf_dir):
    """New (record, checksum, version) keys only, each once for ever."""
    stream = events_stream(spark, sf_dir).select(
        c("user_id").alias("record_id"), c("ts").cast("timestamp").alias("observed_at"),
        F.md5(F.concat("event_type", F.floor(c("value") / 25).cast("bigint").cast("string"))).alias("payload_checksum"),
        F.concat(F.lit("1."), (c("event_id") % 2).cast("string")).alias("parser_version"))
    out = fresh(spark, "changes")
    jobs.first_seen_sink(stream, f"{out}/rows", f"{out}/checkpoint", jobs.CHANGE_KEY).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("record_id", "payload_checksum", "parser_version")


@query("stream_landing", """SELECT sha256(event_type || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)) AS checksum_sha256,
  substr(sha256(event_type || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)), 1, 2) || '/' || sha256(event_type || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)) || '.txt' AS storage_path,
  event_type || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS content FROM events GROUP BY ALL""")
def stream_landing(spark, sf_dir):
    """Every artifact once, by the digest of its bytes and its path."""
    stream = events_stream(spark, sf_dir).select(
        F.concat("event_type", F.floor("value").cast("bigint").cast("string")).alias("content"), F.lit("text/plain").alias("mime_type"),
        c("ts").cast("timestamp").alias("fetched_at"))
    out = fresh(spark, "landing")
    jobs.first_seen_sink(jobs.landed(stream), f"{out}/rows", f"{out}/checkpoint", jobs.LANDING_KEY).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("checksum_sha256", "storage_path", "content")


@query("stream_latest_records", """SELECT user_id AS record_id, arg_max(event_type, event_id) AS title, max(event_id) AS event_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen
  FROM events GROUP BY user_id""")
def stream_latest(spark, sf_dir):
    """Deltas of a versioned table, merged when read."""
    stream = events_stream(spark, sf_dir).select(
        c("user_id").alias("record_id"), c("event_type").alias("title"), "event_id", c("ts").cast("timestamp").alias("first_seen"))
    out = fresh(spark, "latest")
    jobs.upsert_sink(stream, f"{out}/rows", f"{out}/checkpoint", ["record_id"], {"first_seen": "min"}, "event_id", 8).awaitTermination()
    return versioned.read_table(spark, f"{out}/rows").select("record_id", "title", "event_id", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


@query("stream_run_windows", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, user_id % 25 AS source_id, count(*) AS discovered_count, count(*) FILTER (WHERE event_type <> 'error') AS parsed_count,
  count(*) FILTER (WHERE event_type = 'error') AS failed_count FROM events GROUP BY 1, 2""")
def stream_windows(spark, sf_dir):
    """Daily windows; the counters sum to the events."""
    stream = events_stream(spark, sf_dir).select(
        (c("user_id") % 25).alias("source_id"), c("ts").cast("timestamp").alias("observed_at"), F.when(c("event_type") == "error", "failed").alias("error"))
    out = fresh(spark, "windows")
    jobs.windows_sink(stream, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    rows = jobs.read_windows(spark, f"{out}/rows")
    return rows.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "source_id", "discovered_count", "parsed_count", "failed_count")


@query("stream_plate_expiry", f"""
SELECT event_id, CASE WHEN ts >= {MONTH} - INTERVAL 30 DAY + INTERVAL 20 DAY THEN 'AB-' || user_id END AS plate_number FROM events""")
def stream_plates(spark, sf_dir):
    """What the stored files themselves hold once the expired plates are swept."""
    stream = events_stream(spark, sf_dir).select("event_id", c("ts").cast("timestamp").alias("ends_at"), F.concat(F.lit("AB-"), c("user_id").cast("string")).alias("plate_number"))
    out = fresh(spark, "plates")
    jobs.plate_sink(stream, f"{out}/rows", f"{out}/checkpoint", ["event_id"]).awaitTermination()
    jobs.sweep_plates(spark, f"{out}/rows", "2024-02-04 00:00:00")
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/rows/data").select("event_id", "plate_number")
