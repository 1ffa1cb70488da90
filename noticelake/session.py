"""Session defaults that the library's results depend on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # shuffle files go with the query that wrote them; else they stay until the driver collects its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # long texts: a batch between Spark and Python stays at some megabytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "noticelake") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach; a local one only where the cluster names none."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    fallback = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def stored(df):
    """The rows as a compressed table in the shared folder: for wide rows, of which later steps read some columns each."""
    path = f"{shared_dir(df.sparkSession)}/stored-{os.urandom(8).hex()}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Reliable checkpoint in the shared folder: survives the loss of executors."""
    spark = df.sparkSession
    spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
