"""The read model gives what a scan of the listing gives, from a few ranges, before and after refreshes."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from noticelake.operators import paging, read_model, versioned
from noticelake.operators.filters import Filters, apply_filters, keyword_matches, keyword_matches_loosely

c = F.col
AS_OF = "2026-03-10 12:00:00"
SCHEMA = """id long, vehicle_type string, auction_status string, auction_at timestamp, display_price long, completeness int, disposal_origin string,
  registration_status string, eligibility string, search_text string, brand_name string, model_name string, plate_number string, official_title string,
  organization_name string, storage_location string, bulk_lot boolean, has_cached_photo boolean"""
WORDS = ["red", "kymco", "sym", "機車", "汽車", "trial", "a_b", "100%", "Ａ車", "x"]


def listing_rows(ids, seed):
    draw = random.Random(seed)
    out = []
    for i in ids:
        at = None if draw.random() < 0.2 else datetime(2026, 3, 1) + timedelta(hours=draw.randrange(500))
        title = " ".join(draw.choices(WORDS, k=draw.randrange(5)))
        out.append((i, draw.choice(["CAR", "MOTORCYCLE", "MIXED"]), draw.choice(["SCHEDULED", "SOLD", "ANNOUNCED", None]), at, draw.choice([None, *range(0, 900, 7)]), draw.randrange(101),
                    draw.choice(["SCRAP_DISPOSAL", "PUBLIC_ASSET_DISPOSAL"]), "UNKNOWN", "UNKNOWN", title.lower(), draw.choice(WORDS), None, None, title, None, draw.choice([None, "倉 庫"]), False, True))
    return out


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    """A listing of 600 rows of which a part was changed, added and removed since the model was written."""
    path = str(tmp_path_factory.mktemp("model") / "m")
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first, second = listing_rows(range(600), 1), listing_rows([*range(0, 600, 9), *range(600, 640)], 2)
    read_model.write_model(spark, frame(first), path, ranges=12)
    versions_before = versioned.manifest(spark, f"{path}/completeness")
    touched = read_model.refresh(spark, frame([(*second[0][:5], 3, *second[0][6:])]), path)
    assert len(touched["completeness"]) <= 2  # the range that the row left, and the one that it entered
    kept = {p["folder"] for p in versioned.manifest(spark, f"{path}/completeness")["parts"]} & {p["folder"] for p in versions_before["parts"]}
    assert kept
    read_model.refresh(spark, frame(second), path, removed=spark.createDataFrame([(5,), (7,), (9999,)], "id long"))
    now = {r[0]: r for r in first} | {r[0]: r for r in second}
    del now[5], now[7]
    return path, frame(list(now.values())).cache()


def test_rows_and_counts(spark, model):
    path, listing = model
    for column in read_model.CLUSTERS:
        assert sorted(map(str, read_model.rows(spark, path, column).select(listing.columns).collect())) == sorted(map(str, listing.collect()))
    for filters in (Filters(), Filters(market_view="ended"), Filters(market_view="scrap"), Filters(market_view="all", vehicle_type="CAR"), Filters(min_price=300)):
        assert read_model.count(spark, path, filters, AS_OF).first()[0] == apply_filters(listing, filters, AS_OF).count(), filters


@pytest.mark.parametrize("sort", list(paging.SORTS))
def test_pages_equal_those_of_a_scan(spark, model, sort):
    path, listing = model
    for filters in (Filters(market_view="all"), Filters(vehicle_type="CAR", min_price=100)):
        cursor, seen = None, []
        want = [r.id for r in paging.sort_listing(apply_filters(listing, filters, AS_OF), sort).collect()]
        for _ in range(4):
            rows = read_model.page_rows(spark, path, filters, AS_OF, sort, 30, cursor).collect()
            seen += [r.id for r in rows[:30]]
            if len(rows) <= 30:
                break
            cursor = paging.encode_cursor(sort, rows[29][paging.SORTS[sort][0]], rows[29]["id"])
        assert seen == want[: len(seen)] and len(seen) >= min(100, len(want))


def test_a_page_opens_a_few_ranges(spark, model):
    path, _ = model
    filters = Filters(market_view="all", vehicle_type="CAR", min_price=5)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    page = read_model.page_rows(spark, path, filters, AS_OF, "price_asc", 5)
    plan = page._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(vehicle_type,CAR)" in plan and "GreaterThanOrEqual(display_price,5)" in plan
    opened = set(re.findall(r"\b0000\d\d\b", " ".join(re.findall(r"PartitionFilters: \[[^]]*\]", plan))))
    assert "000000" in opened and len(opened) <= 3  # of twelve


@pytest.mark.parametrize("keyword", ["kymco", "mco sy", "機車", "機車 汽", "a_b", "100%", "red trial x", "zzz", "x", "", "ａ車 "])
def test_keywords_equal_a_scan(spark, model, keyword):
    path, listing = model
    named = listing.withColumn("name", F.concat_ws(" ", "brand_name", "model_name"))
    for loose, check in ((False, keyword_matches(keyword)), (True, keyword_matches_loosely(keyword))):
        got = sorted(r.id for r in read_model.keyword_rows(spark, path, keyword, loose).collect())
        assert got == sorted(r.id for r in named.filter(check).collect()), (keyword, loose)


def test_postings_name_ranges_not_listings(spark, model):
    """Their number follows the distinct runs: it does not grow with the listings that hold them."""
    path, _ = model
    postings = versioned.read_buckets(spark, f"{path}/postings", merge=False)
    assert "id" not in postings.columns
    writes = len(versioned.manifest(spark, f"{path}/postings")["parts"])
    assert postings.count() <= writes * postings.select("kind", "gram", "place").distinct().count()
