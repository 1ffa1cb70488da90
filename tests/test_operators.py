import itertools
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from noticelake.operators import evidence, filters, identity, paging, quality, query_params, retention, runs, upsert, versioned
from noticelake.operators.completeness import completeness, has_items, is_known
from noticelake.sources import feeds, seeds

c = F.col


def as_dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# --- policy and runs -------------------------------------------------------------------
@pytest.mark.parametrize("decision,status,expected", [
    ("ALLOW", "SUCCEEDED", "ACTIVE"), ("ALLOW", "PARTIAL", "PARTIAL"), ("ALLOW", "FAILED", "DEGRADED"),
    ("MANUAL_ONLY", "SUCCEEDED", "PARTIAL"), ("MANUAL_ONLY", "PARTIAL", "PARTIAL"), ("MANUAL_ONLY", "FAILED", "DEGRADED"),
    ("REVIEW_REQUIRED", "SUCCEEDED", "DEGRADED"), ("DISABLED", "SUCCEEDED", "DISABLED"), (None, "SUCCEEDED", "DEGRADED"),
])
def test_source_status(spark, decision, status, expected):
    row = spark.range(1).select(runs.source_status(F.lit(decision).cast("string"), F.lit(status)).alias("s")).first()
    assert row.s == expected


def test_run_status(spark):
    rows = spark.createDataFrame([(0, 3, 3, 0), (29, 3, 29, 3), (0, 0, 0, 1), (5, 0, 5, 0), (5, 0, 5, 1)], "p int, f int, d int, w int")
    got = [r[0] for r in rows.select(runs.run_status(c("p"), c("f"), c("d"), c("w"))).collect()]
    assert got == ["FAILED", "PARTIAL", "PARTIAL", "SUCCEEDED", "PARTIAL"]


# --- upsert ------------------------------------------------------------------------------
def test_upsert_matches_brute_force_with_hot_and_null_keys(spark):
    rnd = random.Random(7)
    keys = [None, "hot", "a", "b"]
    def row(i, hot):
        return ("hot" if hot and rnd.random() < .4 else rnd.choice(keys), rnd.choice([None, "x", "y"]), rnd.randrange(100), i)
    old = {k: (k, "o", 50, 0) for k in [None, "hot", "z"]}
    new = [row(i, True) for i in range(1, 200)]
    schema = "k string, v string, n int, at int"
    merged = upsert.upsert(spark.createDataFrame(list(old.values()), schema), spark.createDataFrame(new, schema), ["k"],
                           {"v": "coalesce", "n": "max"}, c("at"))
    want = {}
    for k, v, n, at in [*old.values(), *new]:
        p = want.get(k)
        want[k] = (k, v if v is not None or p is None else p[1], n if p is None else max(n, p[2]), at)
    assert {r.k: tuple(r) for r in merged.collect()} == want
    again = upsert.upsert(merged, spark.createDataFrame(new, schema), ["k"], {"v": "coalesce", "n": "max"}, c("at"))
    assert {r.k: tuple(r) for r in again.collect()} == want


def test_versioned_table_merges_batches_by_rules(spark, workdir):
    path, rules = f"{workdir}/t", {"v": "coalesce", "low": "min", "high": "max", "first": "keep"}
    draw, want, schema = random.Random(3), {}, "k int, at int, v string, low int, high int, first string, last string"
    for batch in range(1, 8):
        rows = [(draw.choice([None, *range(30)]), i, draw.choice([None, "x", "y"]), draw.randrange(9), draw.randrange(9), f"f{batch}-{i}", f"l{batch}-{i}") for i in range(40)]
        frame = spark.createDataFrame(rows, schema)
        narrow = batch in (3, 5)
        versioned.upsert_batch(spark, path, frame.drop("last", "low") if narrow else frame, ["k"], rules, c("at"), buckets=3, batch_id=("s", batch), deltas=3)
        versioned.upsert_batch(spark, path, frame, ["k"], rules, c("at"), batch_id=("s", batch))  # a repeated batch is skipped
        newest, oldest = {}, {}
        for k, at, v, low, high, first, last in rows:
            old = want.get(k)
            mine = newest.setdefault(k, {"v": None, "low": None, "high": high, "first": None, "last": None, "at": -1, "v_at": -1})
            mine["high"] = max(mine["high"], high)
            mine["low"] = low if mine["low"] is None else min(mine["low"], low)
            if v is not None:
                mine["v"] = v
            mine["last"], mine["at"] = last, at
            oldest.setdefault(k, first)
        for k, mine in newest.items():
            old = want.get(k)
            lows = [x for x in (old and old["low"], None if narrow else mine["low"]) if x is not None]
            want[k] = {
                "v": mine["v"] if mine["v"] is not None else old and old["v"], "low": min(lows) if lows else None, "high": max(mine["high"], old["high"] if old else 0),
                "first": old["first"] if old else oldest[k], "last": (old["last"] if old else None) if narrow else mine["last"], "at": mine["at"],
            }
        got = {r.k: r.asDict() for r in versioned.read_table(spark, path).collect()}
        assert got == {k: {"k": k, **x} for k, x in want.items()}, batch
    found = versioned.manifest(spark, path)
    assert found["streams"] == {"s": 7} and any(p["kind"] == "base" for p in found["parts"])
    some = spark.createDataFrame([(4,), (7,), (999,)], "k int")
    assert {r.k for r in versioned.lookup(spark, path, some).collect()} == {4, 7} & want.keys()
    before = sorted(map(str, versioned.read_table(spark, path).collect()))
    versioned.compact(spark, path, bucket_bytes=500, file_bytes=300)  # more buckets, and several files in each
    made = versioned.manifest(spark, path)
    assert made["buckets"] > 3 and [p["kind"] for p in made["parts"]] == ["base"]
    assert sorted(map(str, versioned.read_table(spark, path).collect())) == before
    assert sorted(map(str, versioned.read_table(spark, path, found["version"]).collect())) == before
    versioned.upsert_batch(spark, path, spark.createDataFrame([(4, 1, "z", 0, 0, "f", "l")], schema), ["k"], rules, c("at"))
    assert versioned.vacuum(spark, path, keep=1) > 0 and versioned.read_table(spark, path).count() == len(want)
    assert len(versioned.versions(spark, path)) == 1


def test_a_dead_write_leaves_the_version_before(spark, workdir, monkeypatch):
    path = f"{workdir}/t"
    rows = lambda *ids: spark.createDataFrame([(i, f"v{i}") for i in ids], "k int, v string")
    versioned.upsert_batch(spark, path, rows(1, 2), ["k"])
    with monkeypatch.context() as broken:
        broken.setattr(versioned, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            versioned.upsert_batch(spark, path, rows(1, 3), ["k"])
    assert {r.k for r in versioned.read_table(spark, path).collect()} == {1, 2}
    stale = versioned.manifest(spark, path)
    versioned.upsert_batch(spark, path, rows(5), ["k"])
    with pytest.raises(versioned.Conflict):
        versioned.commit(spark, path, stale)
    assert versioned.vacuum(spark, path) == 1  # what the dead write left
    assert {r.k for r in versioned.read_table(spark, path).collect()} == {1, 2, 5}


def test_a_batch_reads_no_stored_rows(spark, workdir):
    path = f"{workdir}/t"
    versioned.upsert_batch(spark, path, spark.range(1000).withColumn("v", c("id") % 7), ["id"], buckets=8)
    found = versioned.manifest(spark, path)
    one = found["parts"][0]["buckets"][:1]
    plan = versioned._read(spark, path, found, one)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and one[0] in plan and "Exchange" not in plan


def test_columns_that_a_batch_lacks_stay(spark):
    old = spark.createDataFrame([(1, "reviewed", 5), (2, "x", 6)], "k int, note string, n int")
    merged = upsert.upsert(old, spark.createDataFrame([(1, 7), (3, 8)], "k int, n int"), ["k"])
    assert {tuple(r) for r in merged.collect()} == {(1, "reviewed", 7), (2, "x", 6), (3, None, 8)}


def test_new_rows_treat_null_keys_as_equal(spark):
    old = spark.createDataFrame([(None, 1)], "k string, n int")
    new = spark.createDataFrame([(None, 2), ("a", 3), ("a", 4)], "k string, n int")
    assert as_dicts(upsert.new_rows(old, new, ["k"], [c("n")])) == [{"k": "a", "n": 3}]


# --- paging -----------------------------------------------------------------------------
@pytest.mark.parametrize("sort", list(paging.SORTS))
def test_pages_concatenate_to_the_full_order(spark, sort):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, 1, 2, 3]), rnd.randrange(4), rnd.choice([None, "2026-01-01", "2026-01-02"])) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, display_price long, completeness int, d string").withColumn("auction_at", F.to_timestamp("d")).cache()
    full = [r.id for r in paging.sort_listing(df, sort).collect()]
    seen, cursor = [], None
    for _ in range(20):
        shown, cursor = paging.page(df.withColumn("id", c("id")), sort, 7, cursor)
        seen += [r.id for r in shown]
        if cursor is None:
            break
    assert seen == full


def test_cursors_of_a_column_are_decoded_once(spark):
    """A cursor's fields are checked on one decoded struct, and no character is translated by lookup."""
    rows = spark.createDataFrame([(n * 7919, float(n) if n % 5 else None) for n in range(200)], "id long, display_price double")
    cursors = rows.withColumn("cursor", paging.cursor_column("price_asc"))
    assert {(r.id, r.cursor) for r in cursors.collect()} == {(r.id, paging.encode_cursor("price_asc", r.display_price, r.id)) for r in rows.collect()}
    read = cursors.select("id", paging.cursor_position(c("cursor")).alias("p"))
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "translate(" not in plan
    assert all(r.p["id"] == str(r.id) and r.p["sort"] == "price_asc" for r in read.collect())
    bad = spark.createDataFrame([("!!!",), ("",), (None,), ("eyJ2IjoyfQ",)], "cursor string")
    assert {r.p for r in bad.select(paging.cursor_position(c("cursor")).alias("p")).collect()} == {None}


def test_cursor_codec_rejects_garbage():
    good = paging.encode_cursor("price_asc", Decimal("12"), 5)
    assert paging.decode_cursor(good)["value"] == 12.0
    for bad in (None, "", "x" * 600, "!!!", paging.encode_cursor("price_asc", 1, 1)[:-4] + "zz"):
        assert paging.decode_cursor(bad) is None or isinstance(paging.decode_cursor(bad), dict)
    assert paging.clamp_limit(0) == 24 and paging.clamp_limit(1000) == 100 and paging.clamp_limit(2.9) == 2


# --- queries ------------------------------------------------------------------------------
QUERIES = [
    "view=ended&within=7&cc=le-125&cc=126-150,nope", "carCategory=SUV&cc=gt-550", "vehicleType=CAR&vehicleClass=LARGE_HEAVY",
    "view=zzz&sort=price_desc&price=100-&limit=500", "minPrice=-1&maxPrice=9&limit=0&keyword=%20%E6%A9%9F%E8%BB%8A+x", "vehicleType=MIXED&source=customs",
]


def test_query_table_agrees_with_single_parser(spark):
    df = spark.createDataFrame([(i, q) for i, q in enumerate(QUERIES)], "i int, query string")
    rows = query_params.normalize_queries(df).orderBy("i").collect()
    for query, row in zip(QUERIES, rows):
        f, limit, _ = query_params.parse_query(query)
        assert (row.view, row.sort, row.vehicleType, row.vehicleClass, row.carCategory, row.keyword, row.source) == (
            f.market_view, f.sort, f.vehicle_type, f.vehicle_class, f.car_category, f.keyword, f.source)
        assert (row.displacementBands or []) == f.displacement_bands and row.within == f.auction_within_days
        assert (row.minPrice, row.maxPrice, row.limit) == (f.min_price, f.max_price, limit)


def test_unknown_filters_keep_active_default(spark):
    assert query_params.parse_query("view=bogus&limit=2.7")[0].market_view == "active"
    assert filters.Filters().sort == "auction_asc"


# --- identity -------------------------------------------------------------------------------
def test_star_links_connect_every_group(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["PLATE", "FRAME"]), "hot" if i % 3 == 0 else str(rnd.randrange(30))) for i in range(200)]
    links = identity.identity_links(spark.createDataFrame(rows, "vehicle_id int, identifier_type string, normalized_value string")).collect()
    parent = {i: i for i in range(200)}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for link in links:
        parent[find(link.left_id)] = find(link.right_id)
    for (i, t, v), (j, t2, v2) in itertools.combinations(rows, 2):
        if (t, v) == (t2, v2):
            assert find(i) == find(j)
    assert len(links) < 400


def test_duplicates_find_every_vehicle_with_a_match(spark):
    rnd = random.Random(11)
    names = ["brand", "model", "year", "location", "day"]
    rows = [(i, *[rnd.choice(["a", "b", None]) for _ in names]) for i in range(80)]
    df = spark.createDataFrame(rows, "vehicle_id int, brand string, model string, year string, location string, day string")
    found = {x for r in identity.duplicate_candidates(df).collect() for x in (r.left_id, r.right_id)}
    weight = [Decimal(identity.DUPLICATE_WEIGHTS[n]) for n in names]
    want = set()
    for a, b in itertools.combinations(rows, 2):
        if sum(w for w, x, y in zip(weight, a[1:], b[1:]) if x is not None and x == y) >= Decimal(identity.PROPOSE_FROM):
            want |= {a[0], b[0]}
    assert found == want


def test_exactly_one_match(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "i int, k string")
    right = spark.createDataFrame([("a", "u"), ("b", "v"), ("b", "w")], "k string, url string")
    matched, unmatched = identity.match_exactly_one(left, right, ["k"], ["url"])
    assert as_dicts(matched) == [{"i": 1, "k": "a", "url": "u"}]
    assert {r.i: r.matches for r in unmatched.collect()} == {2: 2, 3: 0}


# --- others ----------------------------------------------------------------------------------
def test_completeness_groups(spark):
    row = spark.range(1).select(F.lit("x").alias("a"), F.array().cast("array<string>").alias("l"), F.lit("UNKNOWN").alias("u")).select(
        completeness({"identity": [c("a") == "x", has_items(c("l"))], "auction": [F.lit(True)], "condition": [is_known(c("u"))],
                      "registration": [F.lit(True)], "fees": [F.lit(True)], "media": [F.lit(True)]})["completeness"].alias("t")).first()
    assert row.t == 75


def test_resolved_evidence_prefers_authority(spark):
    rows = spark.createDataFrame([(1, "v", 1, "f", "LLM_EXTRACTED", 1.0, 9), (2, "v", 1, "f", "OFFICIAL_EXPLICIT", 0.1, 1), (3, "v", 1, "f", "OFFICIAL_EXPLICIT", 0.1, 1)],
                                 "id int, entity_type string, entity_id int, field_name string, trust string, confidence double, created_at int")
    assert [r.id for r in evidence.resolved_evidence(rows).collect()] == [2]


def test_a_tombstone_buries_only_its_own_artifact(spark):
    """Ids that are unique only beside another column: the tombstone of one must not bury the other."""
    due = spark.createDataFrame([(7, 1, "p", "x", "1997-01-01 00:00:00"), (7, 2, "p", "y", "1997-01-01 00:00:00")],
                                "id long, record_id long, storage_path string, checksum_sha256 string, retention_until string")
    due = due.withColumn("retention_until", c("retention_until").cast("timestamp"))
    tombstones = spark.createDataFrame([(7, 1)], "artifact_id long, record_id long")
    assert [r.checksum_sha256 for r in retention.retention_plan(due, tombstones, "1998-06-01 00:00:00", within=("record_id",)).collect()] == ["y"]
    assert retention.retention_plan(due, tombstones, "1998-06-01 00:00:00").count() == 0


def test_retention_and_plates(spark):
    rows = spark.createDataFrame([("a", "2026-08-12"), ("b", "2026-08-09"), ("c", "2026-07-01"), ("d", None)], "plate_number string, d string").withColumn(
        "ends_at", F.to_timestamp("d"))
    got = [r.plate_number for r in retention.clear_expired_plates(rows, "2026-08-10 00:00:00").orderBy("d").collect()]
    assert got == [None, None, "b", "a"]


def test_seeds(spark):
    counts = {r[0]: r[1] for r in seeds.organizations(spark).groupBy("organization_type").count().collect()}
    assert counts["DISTRICT_COURT"] == 22 and counts["ADMINISTRATIVE_ENFORCEMENT_BRANCH"] == 13 and counts["CUSTOMS"] == 4
    assert seeds.endpoints(spark).count() == 28
    assert quality.duplicate_keys(seeds.sources(spark), ["name"], "n").first().violations == 0


def test_xml_feed_file(spark, workdir):
    body = '<?xml version="1.0" encoding="UTF-8"?><財物變賣公告名單 更新時間="115/08/10">' + "".join(
        f"<財物變賣公告><機關名稱>機關{i % 3}</機關名稱><標案案號>C{i % 3}</標案案號><公告次數>1</公告次數><財物名稱>{n}</財物名稱><公告日期>20260803</公告日期></財物變賣公告>"
        for i, n in enumerate(["報廢機車", "廢電力機車", "公務車輛", "桌椅", "舊車輛", ""])) + "</財物變賣公告名單>"
    with open(f"{workdir}/feed.xml", "w", encoding="utf-8") as f:
        f.write(body)
    rows = {r.organization: r for r in feeds.read_feed(spark, workdir).collect()}
    assert {k: r.title for k, r in rows.items()} == {"機關0": "報廢機車", "機關2": "公務車輛", "機關1": "舊車輛"}
    assert rows["機關0"].feed_updated_at == "115/08/10" and rows["機關0"].source_record_id.startswith("open-data-")


def test_court_payload_keys(spark):
    payload = json.dumps({"total": "zz", "recordsTotal": "7", "rows": [{"rowid": 5, "filenm": "a b.pdf", "ttitle": "機車"}, {"rowid": "", "ttitle": "x"}, 3]})
    df = spark.createDataFrame([(1, payload)], "arrival int, content string")
    (r,) = feeds.court_items(df).collect()
    assert r.source_record_id == "5" and r.official_url.endswith("filenm=a+b.pdf") and json.loads(r.metadata)["ttitle"] == "機車"
    assert df.select(feeds.result_total(c("content"))).first()[0] == 7


# --- identity components and duplicate groups --------------------------------------------
def test_identity_components_of_chains_and_random_links(spark):
    draw = random.Random(11)
    links = [(i, i + 1, "PLATE") for i in range(100, 140)] + [(draw.randrange(60), draw.randrange(60), draw.choice(["FRAME", "ENGINE", "OFFICIAL_LINK"])) for _ in range(45)]
    links += [(500, 500, "PLATE"), (700, 600, "VIN")]
    parent = {n: n for a, b, _ in links for n in (a, b)}

    def root(n):
        return n if parent[n] == n else root(parent[n])

    for a, b, _ in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    kinds = {}
    for a, b, kind in links:
        kinds.setdefault(root(a), set()).add(kind)
    linked = {n for a, b, _ in links if a != b for n in (a, b)}
    got = identity.identity_components(spark.createDataFrame(links, "left_id long, right_id long, link_type string")).collect()
    assert {r.vehicle_id: r.component_id for r in got} == {n: root(n) for n in linked}
    assert all(set(r.signals) == kinds[r.component_id] and r.algorithm == identity.IDENTITY_ALGORITHM for r in got)


def test_identity_components_read_their_links_once(spark):
    """Links may be costly to find; before, they were found for the rounds and again for the signals."""
    links = [(10, 11, "FRAME"), (11, 12, "PLATE"), (12, 13, "CASE_LOT"), (5, 13, "VIN"), (20, 21, "PLATE")]
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    found = spark.createDataFrame(spark.sparkContext.parallelize(links, 2).map(counted), "left_id long, right_id long, link_type string")
    got = {r.vehicle_id: (r.component_id, r.signals) for r in identity.identity_components(found).collect()}
    chain = (5, ["CASE_LOT", "FRAME", "PLATE", "VIN"])
    assert got == {5: chain, 10: chain, 11: chain, 12: chain, 13: chain, 20: (20, ["PLATE"]), 21: (20, ["PLATE"])}
    assert read.value == len(links)


def test_duplicates_show_their_own_score(spark):
    """2 and 3 agree on all five signals, though 1 is the smallest of both and agrees with them on fewer."""
    rows = [(1, "a", "m", 1, "x", "d1"), (2, "a", "m", 1, "x", "d2"), (3, "a", "m", 1, "x", "d2"), (4, "a", "m", 1, "y", "d3"), (5, "b", None, 1, "x", "d2"), (6, "a", "m", 2, "z", "d9")]
    got = {r.vehicle_id: (r.group_id, r.signals, str(r.score), r.size) for r in identity.duplicate_groups(
        spark.createDataFrame(rows, "vehicle_id int, brand string, model string, year int, location string, day string")).collect()}
    assert got == {1: (1, "brand,model,year,location", "0.9000", 3), 2: (2, "brand,model,year,location,day", "1.0000", 2), 3: (2, "brand,model,year,location,day", "1.0000", 2)}
