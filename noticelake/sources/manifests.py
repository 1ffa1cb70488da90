"""Human-reviewed manifests: JSON arrays of official links, split into valid and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls
from ..functions.text import blank_to_null

# The official link shapes and the fields a court row must bring.
ENFORCEMENT_HOST, ENFORCEMENT_PATH = "www.tpkonsale.moj.gov.tw", "/Detail/Chattel"
COURT_HOST, COURT_PATH = "aomp109.judicial.gov.tw", "/judbp/wkw/WHD1A02/DO_VIEWPDF.htm"
COURT_REQUIRED = ["crtnm", "crm", "saledate", "saleno", "ttitle"]

ENFORCEMENT_SCHEMA = T.StructType([
    T.StructField(n, T.StringType()) for n in ("official_url", "title", "organization", "auction_round")
])
COURT_FIELDS = [
    "official_url", "source_record_id", "rowid", "filenm", "crtnm", "crm", "crmyy", "crmid", "crmno", "saledate",
    "sale_time", "saleno", "ttitle", "registeno", "qty", "unit", "notes", "sumprice", "saleamt", "deposit", "fee_notes",
    "location", "pic_cnt",
]
COURT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in COURT_FIELDS])


def _required(name: str) -> Column:
    return blank_to_null(F.trim(F.coalesce(F.col(name), F.lit(""))))


def read_manifest(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Read landed manifest files of a kind: ``enforcement`` or ``court``."""
    schema = ENFORCEMENT_SCHEMA if kind == "enforcement" else COURT_SCHEMA
    rows = spark.read.schema(schema).option("multiLine", "true").json(path)
    return split_manifest(rows, kind)


def split_manifest(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    return _enforcement(rows) if kind == "enforcement" else _court(rows)


def _enforcement(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    url = F.col("official_url")
    numbers = urls.query_values(url, "NO")
    shape = (
        (urls.scheme(url) == "https") & (urls.host(url) == ENFORCEMENT_HOST) & (urls.path(url) == ENFORCEMENT_PATH)
        & (F.size(numbers) == 1)
    )
    error = F.when(~F.coalesce(shape, F.lit(False)), "not an official detail link").when(
        _required("title").isNull(), "title is missing"
    )
    judged = rows.withColumn("error", error)
    valid = judged.filter(F.col("error").isNull()).select(
        F.get(numbers, F.lit(0)).alias("source_record_id"), "official_url", F.trim("title").alias("title"),
        _required("organization").alias("organization"), _required("auction_round").try_cast("int").alias("auction_round"),
    )
    return valid, judged.filter(F.col("error").isNotNull()).select("official_url", "error")


def _court(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    url = F.col("official_url")
    files = urls.query_values(url, "filenm")
    shape = (
        (urls.scheme(url) == "https") & (urls.host(url) == COURT_HOST) & (urls.path(url) == COURT_PATH)
        & (F.size(files) == 1) & F.lower(F.get(files, F.lit(0))).endswith(".pdf")
    )
    missing = F.array_compact(F.array(*[F.when(_required(n).isNull(), F.lit(n)) for n in COURT_REQUIRED]))
    error = F.when(~F.coalesce(shape, F.lit(False)), "not an official document link").when(
        F.size(missing) > 0, F.concat(F.lit("missing official fields: "), F.array_join(missing, ", "))
    )
    judged = rows.withColumn("error", error)
    record_id = F.coalesce(
        _required("source_record_id"),
        F.concat(F.lit("manual-"), F.substring(F.sha2(F.get(files, F.lit(0)), 256), 1, 24)),
    )
    kept = [n for n in COURT_FIELDS if n not in ("official_url", "source_record_id", "rowid", "filenm")]
    metadata = F.to_json(F.struct(
        F.coalesce(_required("rowid"), record_id).alias("rowid"),
        F.coalesce(_required("filenm"), F.get(files, F.lit(0))).alias("filenm"), *kept,
    ))
    valid = judged.filter(F.col("error").isNull()).select(
        record_id.alias("source_record_id"), "official_url", F.trim("ttitle").alias("title"), metadata.alias("metadata")
    )
    return valid, judged.filter(F.col("error").isNotNull()).select("official_url", "error")
