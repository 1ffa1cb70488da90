"""XML feed, sitemap and JSON result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import facts, urls
from ..functions.text import blank_to_null, feed_record_id, nfkc_clean
from ..operators.dedupe import last_per_key
from ..operators.unnest import unnest

# Element and attribute names of the open-data feed.
FEED_ROOT = "財物變賣公告名單"
FEED_ROW = "財物變賣公告"
FEED_UPDATED = "更新時間"
FEED_FIELDS = {
    "機關名稱": "organization", "標案案號": "case_number", "公告次數": "announcement_count",
    "財物名稱": "title", "公告日期": "announcement_date",
}
FEED_ROW_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in FEED_FIELDS])


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Vehicle rows of landed feed files, last row of an id winning.

    Row elements are split by the XML reader, so a large feed is read in parallel; the
    update time sits on the root and is read by a second, one-row-per-file scan.
    """
    order = F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id()).alias("arrival")
    rows = (
        spark.read.format("xml").option("rowTag", FEED_ROW).schema(FEED_ROW_SCHEMA).load(path)
        .select("*", F.col("_metadata.file_path").alias("file"), order)
    )
    return feed_items(rows).join(feed_updates(spark, path), "file", "left").drop("file")


def feed_updates(spark: SparkSession, path: str) -> DataFrame:
    """Update time of each feed file, from the line that opens its root element."""
    opening = F.regexp_extract("value", f"<{FEED_ROOT}[^>]*>", 0)
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        blank_to_null(nfkc_clean(F.regexp_extract(opening, f'{FEED_UPDATED}="([^"]*)"', 1))).alias("feed_updated_at"),
    ).filter(opening != "")


def feed_items(rows: DataFrame) -> DataFrame:
    """Cleaned, complete vehicle rows with a stable id, from frames with the feed's fields.

    ``arrival`` orders repeated ids; extra columns pass through.
    """
    extra = [c for c in rows.columns if c not in FEED_FIELDS]
    cleaned = rows.select(*extra, *[nfkc_clean(F.col(f"`{zh}`")).alias(en) for zh, en in FEED_FIELDS.items()])
    complete = cleaned
    for name in FEED_FIELDS.values():
        complete = complete.filter(F.col(name) != "")
    kept = complete.filter(facts.is_procurement_vehicle(F.col("title"))).withColumn(
        "source_record_id", feed_record_id(F.col("organization"), F.col("case_number"), F.col("announcement_count"))
    )
    return last_per_key(kept, ["source_record_id"], F.col("arrival")).drop("arrival")


def sitemap_ok(pages: DataFrame, host: str, xml: str = "content") -> DataFrame:
    """Per landed sitemap: does any location use HTTPS on the expected host?"""
    locations = F.regexp_extract_all(F.col(xml), F.lit(r"<(?:\w+:)?loc>\s*([^<\s]+)\s*</"), F.lit(1))
    good = F.exists(locations, lambda u: (urls.scheme(u) == "https") & (urls.host(u) == F.lit(host)))
    return pages.withColumn("sitemap_ok", F.coalesce(good, F.lit(False)))


# --- JSON result rows of the court query -------------------------------------------
RESULT_KEYS = ["data", "rows", "result"]
TOTAL_KEYS = ["total", "recordsTotal", "totalCount", "count"]
EXCLUDED_TITLE = "電力機車"
PDF_URL = "https://aomp109.judicial.gov.tw/judbp/wkw/WHD1A02/DO_VIEWPDF.htm"


def result_rows(payload: Column) -> Column:
    """Row objects, as JSON strings, under the first non-empty of the known keys."""
    arrays = [F.from_json(F.get_json_object(payload, f"$.{k}"), T.ArrayType(T.StringType())) for k in RESULT_KEYS]
    filled = [F.when(F.size(a) > 0, a) for a in arrays]
    rows = F.coalesce(*filled, F.array().cast("array<string>"))
    return F.filter(rows, lambda r: r.startswith("{"))


def result_total(payload: Column) -> Column:
    """First total that reads as a whole number, else the number of rows present."""
    totals = [F.trim(F.get_json_object(payload, f"$.{k}")).try_cast("int") for k in TOTAL_KEYS]
    return F.coalesce(*totals, F.size(result_rows(payload)))


def court_items(payloads: DataFrame, payload: str = "content", arrival: str = "arrival") -> DataFrame:
    """Discovered court rows from landed query results; a later payload wins per row id."""
    row = F.col("row")
    exploded = unnest(payloads, result_rows(F.col(payload)), "row", arrival, position="row_no")
    shaped = exploded.select(
        F.struct(F.col(arrival), F.col("row_no")).alias("arrival"),
        F.trim(F.get_json_object(row, "$.rowid")).alias("source_record_id"),
        F.trim(F.get_json_object(row, "$.filenm")).alias("filename"),
        F.trim(F.get_json_object(row, "$.ttitle")).alias("title"),
        row.alias("metadata"),
    ).filter(
        (F.col("source_record_id") != "") & (F.col("filename") != "") & (F.col("title") != "")
        & ~F.col("title").contains(EXCLUDED_TITLE)
    )
    latest = last_per_key(shaped, ["source_record_id"], F.col("arrival"))
    return latest.withColumn(
        "official_url", F.concat(F.lit(PDF_URL + "?filenm="), F.url_encode(F.col("filename")))
    ).drop("arrival")
