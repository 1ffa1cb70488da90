"""Landed artifacts: files or page tables with checksum, media type and kept headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_path

# Media types each source may land, and response headers worth keeping.
ALLOWED_TYPES = {
    "moj_auction": ["text/html", "application/pdf", "application/zip", "application/x-zip-compressed", "image/"],
    "moj_enforcement": ["text/html", "application/pdf", "image/"],
    "moj_enforcement_cms": ["text/html", "application/pdf"],
    "customs": ["text/html"],
    "pcc": ["text/html"],
    "shwoo": ["text/html", "image/"],
    "judicial": ["application/json", "application/pdf"],
}
KEPT_HEADERS = {
    "moj_auction": ["cache-control", "content-length", "content-type", "etag", "last-modified", "location"],
    "moj_enforcement_cms": [
        "cache-control", "content-disposition", "content-length", "content-type", "etag", "last-modified",
    ],
    "shwoo": ["etag", "last-modified", "content-type", "content-length"],
}


def sniffed_type(content_type: Column, content: Column) -> Column:
    """Bare lower-case media type; a generic one with PDF bytes is a PDF."""
    bare = F.lower(F.trim(F.regexp_extract(content_type, r"^[^;]*", 0)))
    is_pdf = F.substring(content, 1, 4).cast("binary") == F.lit(b"%PDF")
    return F.when((bare == "application/octet-stream") & is_pdf, "application/pdf").otherwise(bare)


def is_allowed_type(mime_type: Column, source: str) -> Column:
    exact = [t for t in ALLOWED_TYPES[source] if not t.endswith("/")]
    families = [t for t in ALLOWED_TYPES[source] if t.endswith("/")]
    ok = mime_type.isin(exact)
    for family in families:
        ok = ok | mime_type.startswith(family)
    return F.coalesce(ok, F.lit(False))


def kept_headers(headers: Column, source: str) -> Column:
    """Headers reduced to the reproducibility allowlist, names in lower case."""
    lowered = F.transform_keys(headers, lambda k, _: F.lower(k))
    return F.map_filter(lowered, lambda k, _: k.isin(KEPT_HEADERS[source]))


def with_checksum(df: DataFrame, content: str = "content") -> DataFrame:
    """Add checksum, size and content-addressed storage path."""
    body = F.col(content).cast("binary")
    return (
        df.withColumn("checksum_sha256", F.sha2(body, 256))
        .withColumn("content_length", F.octet_length(body).cast("bigint"))
        .withColumn("storage_path", content_path(F.col("checksum_sha256"), F.col("mime_type")))
    )


def read_files(spark: SparkSession, path: str, pattern: str | None = None, max_bytes: int | None = None) -> DataFrame:
    """Scan a folder of landed files. One above ``max_bytes``, if given, keeps its row without content, and says so in ``error``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    too_large = F.col("length") > F.lit(max_bytes).cast("bigint")
    files = files.withColumn("error", F.when(too_large, F.lit(f"larger than {max_bytes} bytes")))
    files = files.withColumn("content", F.when(F.col("error").isNull(), F.col("content")))
    name = F.regexp_extract("path", r"[^/]*$", 0)
    extension = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    types = {"html": "text/html", "htm": "text/html", "json": "application/json", "xml": "application/xml",
             "pdf": "application/pdf", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg"}
    by_extension = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    declared = F.coalesce(F.try_element_at(by_extension, extension), F.lit("application/octet-stream"))
    return with_checksum(
        files.select(
            "path", name.alias("filename"), F.col("modificationTime").alias("fetched_at"),
            sniffed_type(declared, F.col("content")).alias("mime_type"), "content", "error",
        )
    )


def accepted(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Split artifacts into those of an allowed type and rejected rows with the reason."""
    ok = is_allowed_type(F.col("mime_type"), source)
    rejected = df.filter(~ok).withColumn("error", F.concat(F.lit("unsupported media type: "), F.col("mime_type")))
    return df.filter(ok), rejected


def document_index(artifacts: DataFrame) -> DataFrame:
    """One document row per PDF artifact of a record."""
    return artifacts.filter(F.col("mime_type") == "application/pdf").select(
        "source_record_id", F.col("checksum_sha256").alias("artifact_id"),
        F.concat(F.col("title"), F.lit("－官方拍賣公告")).alias("title"),
        F.lit("OFFICIAL_AUCTION_NOTICE").alias("document_type"), "official_url",
    ).dropDuplicates(["source_record_id", "artifact_id"])
