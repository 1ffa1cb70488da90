"""Streams over landing folders. Each equals its batch operator on the same input.

All run with ``availableNow``, so the batch result is the reference. Late rows are rows like others: keys that were seen are kept in
keyed state on the executors' disks (checkpointed, never behind a watermark), counters and records in tables beside the stream.
No batch reads what earlier batches wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import instant
from ..functions.redact import plate_still_public, public_since
from ..functions.text import content_path
from ..operators import versioned
from ..operators.retention import clear_expired_plates
from ..operators.upsert import SNAPSHOT_KEY

c = F.col


def read_stream(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", per_batch: int = 1000) -> DataFrame:
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", per_batch).load(path)


def landed(artifacts: DataFrame) -> DataFrame:
    """Artifacts with the checksum and path that identify their content."""
    body = c("content").cast("binary")
    return artifacts.withColumn("checksum_sha256", F.sha2(body, 256)).withColumn("storage_path", content_path(c("checksum_sha256"), c("mime_type")))


def _replace_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """Write one batch's rows in its own partition; a repeated batch replaces itself."""
    rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


CHANGE_KEY = SNAPSHOT_KEY
LANDING_KEY = ["checksum_sha256", "storage_path"]


def with_disk_state(spark: SparkSession) -> SparkSession:
    """State in RocksDB with changelogs: its size follows the executors' disks, and a batch writes what it changed."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def first_seen_sink(stream: DataFrame, path: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Each key once for ever, in the first batch that has it, whatever its delay.

    A batch looks its own keys up in the state and reads nothing else. Of rows of one batch with one key any one stays, so columns
    beside the keys tell of one sighting in that batch.
    """
    with_disk_state(stream.sparkSession)
    return (
        stream.dropDuplicates(keys).writeStream.foreachBatch(lambda batch, batch_id: _replace_batch(batch, batch_id, path))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def run_windows(outcomes: DataFrame, window: str = "1 day") -> DataFrame:
    """Run counters per tumbling window of the observation time."""
    failed = c("error").isNotNull()
    return (
        outcomes.groupBy(F.window("observed_at", window).alias("w"), "source_id")
        .agg(F.count(F.lit(1)).alias("discovered_count"), F.count_if(~failed).alias("parsed_count"),
             F.count_if(failed).alias("failed_count"))
        .select(c("w.start").alias("window_start"), "source_id", "discovered_count", "parsed_count", "failed_count")
    )


def windows_sink(stream: DataFrame, path: str, checkpoint: str, window: str = "1 day") -> StreamingQuery:
    """Partial counters of every batch; late rows count and the last window is no exception. Read them with read_windows()."""
    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: _replace_batch(run_windows(batch, window), batch_id, path))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    counters = ["discovered_count", "parsed_count", "failed_count"]
    return spark.read.parquet(path).groupBy("window_start", "source_id").agg(*[F.sum(n).alias(n) for n in counters])


def upsert_sink(stream: DataFrame, path: str, checkpoint: str, keys: list[str], rules: dict[str, str], order: str,
                buckets: int = versioned.LEAST_BUCKETS, name: str = "upsert") -> StreamingQuery:
    """Keep the latest row per key in a versioned table. A batch appends its own rows; one that comes twice changes nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        versioned.upsert_batch(batch.sparkSession, path, batch, keys, rules, c(order), buckets, (name, batch_id))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


NO_END = "no-end"


def plate_sink(stream: DataFrame, path: str, checkpoint: str, keys: list[str], name: str = "plates") -> StreamingQuery:
    """Append listings as they come, each to the files of the day its auction ends on. Without an end no plate is stored."""

    def add(batch: DataFrame, batch_id: int) -> None:
        day = F.coalesce(F.date_format("ends_at", "yyyy-MM-dd"), F.lit(NO_END))
        rows = batch.withColumn("plate_number", F.when(c("ends_at").isNotNull(), c("plate_number"))).withColumn("bucket", day)
        versioned.append_rows(batch.sparkSession, path, rows, keys, (name, batch_id))

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sweep_plates(spark: SparkSession, path: str, as_of) -> list[str]:
    """Remove plates that have expired by ``as_of`` from the stored files; the days that were rewritten.

    Only days that can hold such a plate are read. Their listings move to files without plates, and the files that had them are
    deleted with the versions that named them. A sweep that dies leaves the table as it was; the next one does its work.
    """
    found = versioned.manifest(spark, path)
    end = spark.range(1).select(F.date_format(public_since(instant(as_of)), "yyyy-MM-dd")).first()[0]
    due = [b for b in versioned.buckets_of(found) if b[0].isdigit() and b <= end]
    if due:
        gone = F.lit(f"cleared-{found['version'] + 1}")

        def cleared(rows: DataFrame) -> DataFrame:
            kept = plate_still_public(c("ends_at"), instant(as_of))
            return clear_expired_plates(rows, as_of).withColumn("bucket", F.when(kept, c("bucket")).otherwise(gone))

        versioned.rewrite(spark, path, due, cleared)
        versioned.vacuum(spark, path, keep=1)
    return due


def read_plates(spark: SparkSession, path: str, as_of) -> DataFrame:
    """The listings with every plate cleared that has expired by ``as_of``, swept or not."""
    return clear_expired_plates(versioned.read_table(spark, path), as_of)
