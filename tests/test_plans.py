import pytest
from pyspark.sql import functions as F

from noticelake.functions.text import stable_id
from noticelake.operators import constraints, listing, upsert, versioned
from noticelake.plans import ingest
from noticelake.plans import jobs as jobs_
from noticelake.plans.notices import normalize
from noticelake.session import configure, cut_lineage
from noticelake.sources import artifacts as art
from noticelake.sources import seeds
from noticelake.streaming import jobs

c = F.col
AS_OF = "2026-08-10 00:00:00"
PAGE = """<meta name="DC.Creator" content="臺灣屏東地方檢察署"><h2 class="title">115年度變價字第{n}號{noun}拍賣公告</h2>
<section class="cp">拍賣時間：115年8月20日上午10時。{noun}{k}輛，{plates}，廠牌：光陽，型號：SJ25。車主：王小明，電話0912345678。</section>"""


@pytest.fixture(scope="module")
def batch(spark):
    rows = [("1", PAGE.format(n=1, noun="普通重型機車", k=1, plates="車牌TST-3001")),
            ("2", PAGE.format(n=2, noun="機車", k=2, plates="車牌TST-3002、TST-4003")),
            ("3", PAGE.format(n=3, noun="汽、機車", k=9, plates="")), ("4", "<h2 class='title'>桌椅</h2>")]
    pages = spark.createDataFrame([(i, f"https://auction.moj.gov.tw/1724/1726/{i}/post", t) for i, t in rows],
                                  "source_record_id string, official_url string, content string")
    records, errors = normalize("moj_auction", pages, AS_OF)
    records = cut_lineage(records.withColumns({"source_adapter": F.lit("moj_auction"), "source_name": F.lit("來源")}))
    landed = pages.withColumns({
        "source_adapter": F.lit("moj_auction"), "fetched_at": F.lit(AS_OF).cast("timestamp"), "mime_type": F.lit("text/html"),
        "checksum_sha256": F.sha2("content", 256), "artifact_no": F.lit(0)})
    return pages, records, errors, landed


def test_tables_are_idempotent_and_feed_the_listing(spark, batch):
    _, records, _, landed = batch
    brands = seeds.brands(spark).withColumn("id", stable_id(c("canonical_name")))
    models = seeds.models(spark).select(stable_id(c("brand")).alias("brand_id"), stable_id(c("model_code")).alias("id"), "canonical_name", "model_code")
    incoming = ingest.table_rows(records, landed, brands, models, AS_OF)
    first = {k: cut_lineage(v) for k, v in ingest.save({}, incoming).items()}
    second = ingest.save(first, incoming)
    for name in first:
        assert second[name].count() == first[name].count(), name
        assert second[name].exceptAll(first[name]).count() == 0, name
    assert first["vehicles"].count() == 3 and first["lots"].count() == 3 and first["identifiers"].count() == 3
    tables = dict(first)
    tables["lots"] = first["lots"]
    tables["records"] = first["records"].withColumn("source_id", c("source_adapter"))
    tables["sources"] = seeds.sources(spark).withColumn("id", c("adapter_name"))
    tables["brands"], tables["models"] = brands, models
    rows = {r.id: r for r in listing.listing_view(tables).collect()}
    assert sorted(r.listing_entity for r in rows.values()) == ["lot", "vehicle", "vehicle", "vehicle"]
    assert {r.plate_number for r in rows.values()} == {None, "TST3001", "TST3002", "TST4003"}
    assert {r.brand_name for r in rows.values() if r.listing_entity == "vehicle"} == {"KYMCO"}


def counted(pages, spark):
    """The pages, and how many times one of them was read."""
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    return pages.mapInArrow(seen, pages.schema), reads


def test_publish_job(spark, batch, workdir):
    pages, _, _, landed = batch
    path = f"{workdir}/tables"
    arrived, reads = counted(landed.drop("source_adapter"), spark)
    run = jobs_.publish_job(spark, "moj_auction", "來源", arrived, path, AS_OF, 1).first()
    assert reads.value == 4  # each page once in the whole job
    assert (run.discovered_count, run.fetched_count, run.parsed_count, run.failed_count, run.changed_count, run.status) == (4, 4, 3, 1, 3, "PARTIAL")
    assert run.run_warnings == ["Parse success rate fell below 90%"] and run.warning_count == 2
    rows = {r.source_record_id: r for r in versioned.read_table(spark, f"{path}/public").collect()}
    assert rows["1"].plate_number == "TST-3***"
    assert rows["2"].plate_number == "TST-3***、TST-4***" and rows["3"].plate_number is None
    text = " ".join(str(r) for r in rows.values())
    for secret in ("TST-3001", "王小明", "0912345678"):
        assert secret not in text
    assert all(r.violations == 0 for r in jobs_.public_checks(spark, path, AS_OF).collect())
    assert versioned.read_table(spark, f"{path}/artifacts").select("parser_version").distinct().first()[0] == "1.4.0"
    # the same pages again change nothing; a repeated run is skipped
    for number in (2, 2):
        again = jobs_.publish_job(spark, "moj_auction", "來源", arrived, path, AS_OF, number).first()
        assert (again.parsed_count, again.changed_count) == (3, 0)
    assert versioned.read_table(spark, f"{path}/snapshots").count() == 3 and versioned.read_table(spark, f"{path}/public").count() == 3
    # a month after the end the plates leave the table, its search text and its files, though nothing is published
    later = "2026-10-01 00:00:00"
    none = jobs_.publish_job(spark, "moj_auction", "來源", landed.drop("source_adapter").limit(0), path, later, 3).first()
    assert none.status == "PARTIAL" and none.run_warnings == ["Discovery returned zero records; prior data was preserved"]
    stored = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/public/data").select("plate_number", "search_text").collect()
    assert versioned.read_table(spark, f"{path}/public").count() == 3
    assert all(r.plate_number is None and "tst-" not in r.search_text for r in stored)
    jobs_.export_feed(spark, path, 1, f"{workdir}/feed")
    assert spark.read.json(f"{workdir}/feed/rows").count() == 3 and spark.read.json(f"{workdir}/feed/failures").count() == 1


def test_reprocess_job_equals_the_first_parse(spark, batch, workdir):
    _, records, _, landed = batch
    path = f"{workdir}/tables"
    brands = seeds.brands(spark).withColumn("id", stable_id(c("canonical_name")))
    models = seeds.models(spark).select(stable_id(c("brand")).alias("brand_id"), stable_id(c("model_code")).alias("id"), "canonical_name", "model_code")
    arrived = landed.drop("source_adapter").withColumns({"http_status": F.lit(200), "filename": F.lit("a.html")})
    first = jobs_.save_job(spark, "moj_auction", "來源", arrived, path, AS_OF, 1, brands, models, "1.3.0").first()
    assert (first.parsed_count, first.changed_count) == (3, 3)
    before = {name: df.count() for name, df in jobs_.saved(spark, path).items()}
    contents, reads = counted(landed.select("checksum_sha256", F.encode("content", "utf-8").alias("content")), spark)
    run = jobs_.reprocess_job(spark, "moj_auction", "來源", contents, path, AS_OF, 2, brands, models, "1.3.0").first()
    assert reads.value == 4 and (run.discovered_count, run.parsed_count, run.changed_count) == (3, 3, 3)
    tables = jobs_.saved(spark, path)
    assert tables["snapshots"].groupBy("parser_version").count().orderBy("parser_version").collect() == [("1.3.0", 3), ("1.4.0", 3)]
    same = {name: df.count() for name, df in tables.items()}
    assert {n for n in before if before[n] != same[n]} == {"snapshots", "observations"}
    payloads = tables["snapshots"].groupBy("record_id").agg(F.countDistinct("payload_checksum").alias("n")).select("n").distinct().collect()
    assert [r.n for r in payloads] == [1]
    art = tables["artifacts"].first()
    assert (art.http_status, art.filename, art.extraction_status, art.run_id) == (200, "a.html", "PARSED", "1") and art.content_length > 100
    assert tables["lots"].filter("completeness_groups like '{\"auction\":%'").count() == 3
    assert tables["evidence"].select("parser_name").distinct().first()[0] == "moj_auction"
    checked = constraints.violations({**tables, "brands": brands, "models": models}).collect()
    assert len(checked) > 60 and [r for r in checked if r.violations] == []
    # three records have no artifact of another version
    none = jobs_.reprocess_job(spark, "moj_auction", "來源", contents, path, AS_OF, 3, brands, models, "9.9").first()
    assert none.discovered_count == 0


def test_landed_files_and_materialized_listing(spark, workdir):
    with open(f"{workdir}/a.html", "w") as f:
        f.write("<p>x</p>")
    with open(f"{workdir}/b.bin", "wb") as f:
        f.write(b"%PDF-1.7")
    files = {r.filename: r for r in art.read_files(spark, workdir, max_bytes=100).collect()}
    assert files["a.html"].mime_type == "text/html" and files["b.bin"].mime_type == "application/pdf"
    assert files["b.bin"].storage_path.endswith(".pdf")
    rows = spark.createDataFrame([(i, "CAR" if i % 3 else "MIXED", None if i % 5 == 0 else f"2026-01-{i % 28 + 1:02d}") for i in range(60)],
                                 "id int, vehicle_type string, d string").withColumn("auction_at", F.to_timestamp("d"))
    listing.materialize(rows, f"{workdir}/listing")
    back = spark.read.parquet(f"{workdir}/listing")
    assert back.count() == 60 and back.filter("vehicle_type = 'CAR'").count() == 40


def test_a_stream_keeps_late_rows_and_old_keys(spark, workdir):
    schema = "record_id long, payload_checksum string, parser_version string, observed_at timestamp"
    days = ["2026-03-01", "2026-01-01", "2026-05-01", "2026-01-02"]
    for i, day in enumerate(days):
        rows = [(1, "a", "1", None), (i, "b", "1", None)]
        spark.createDataFrame(rows, schema).withColumn("observed_at", F.to_timestamp(F.lit(day))).coalesce(1).write.mode("append").parquet(f"{workdir}/in")
        for out, start in (("seen", jobs.first_seen_sink), ("windows", jobs.windows_sink)):
            stream = jobs.read_stream(spark, f"{workdir}/in", spark.read.parquet(f"{workdir}/in").schema)
            if out == "windows":
                stream = stream.select(F.col("record_id").alias("source_id"), "observed_at", F.lit(None).cast("string").alias("error"))
            more = (jobs.CHANGE_KEY,) if out == "seen" else ()
            start(stream, f"{workdir}/{out}", f"{workdir}/{out}-state", *more).awaitTermination()
    seen = sorted((r.record_id, r.payload_checksum) for r in spark.read.parquet(f"{workdir}/seen").collect())
    assert seen == [(0, "b"), (1, "a"), (1, "b"), (2, "b"), (3, "b")]
    assert jobs.read_windows(spark, f"{workdir}/windows").agg(F.sum("discovered_count")).first()[0] == 8


def test_batches_of_a_stream_read_their_own_rows_alone(spark, workdir):
    """Twenty files in as many batches: each takes in its own rows, the state keeps every key once, and nothing reads the sink."""
    for i in range(20):
        spark.range(i * 5, i * 5 + 10).selectExpr("id AS record_id", "'a' AS payload_checksum", "'1' AS parser_version").coalesce(1).write.mode("append").parquet(f"{workdir}/in")
    stream = jobs.read_stream(spark, f"{workdir}/in", spark.read.parquet(f"{workdir}/in").schema, per_batch=1)
    query = jobs.first_seen_sink(stream, f"{workdir}/seen", f"{workdir}/state", jobs.CHANGE_KEY)
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [10] * 20
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 105 and "rocksdbPutCount" in progress[-1]["stateOperators"][0]["customMetrics"]
    rows = spark.read.parquet(f"{workdir}/seen")
    assert rows.count() == rows.select("record_id").distinct().count() == 105


def test_expired_plates_leave_the_files(spark, workdir):
    path = f"{workdir}/plates"
    rows = [(i, f"2026-0{m}-{d:02d} 10:00:00" if m else None, f"AB-{i:04d}") for i, (m, d) in enumerate([(1, 5), (1, 6), (2, 1), (2, 1), (3, 1), (None, 0)])]
    spark.createDataFrame(rows, "id int, d string, plate_number string").withColumn("ends_at", F.to_timestamp("d")).drop("d").coalesce(1).write.parquet(f"{workdir}/in")
    stream = jobs.read_stream(spark, f"{workdir}/in", spark.read.parquet(f"{workdir}/in").schema)
    jobs.plate_sink(stream, path, f"{workdir}/state", ["id"]).awaitTermination()
    files = lambda: {r.id: r.plate_number for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/data").collect()}
    assert files() == {0: "AB-0000", 1: "AB-0001", 2: "AB-0002", 3: "AB-0003", 4: "AB-0004", 5: None}
    assert jobs.sweep_plates(spark, path, "2026-02-05 09:00:00") == ["2026-01-05", "2026-01-06"]
    assert files() == {0: None, 1: "AB-0001", 2: "AB-0002", 3: "AB-0003", 4: "AB-0004", 5: None}
    # a sweep that dies on its way changes nothing, the next one does both days' work; days that are done are not read again
    assert jobs.sweep_plates(spark, path, "2026-03-20 00:00:00") == ["2026-01-06", "2026-02-01"]
    assert files() == {0: None, 1: None, 2: None, 3: None, 4: "AB-0004", 5: None}
    assert {r.id: r.plate_number for r in jobs.read_plates(spark, path, "2026-05-01 00:00:00").collect()} == dict.fromkeys(range(6))
    assert jobs.sweep_plates(spark, path, "2026-03-20 00:00:00") == []


def test_large_files_are_reported(spark, workdir):
    for name, size in (("a.html", 5), ("b.html", 500)):
        with open(f"{workdir}/{name}", "wb") as f:
            f.write(b"x" * size)
    files = {r.filename: r for r in art.read_files(spark, workdir, max_bytes=100).collect()}
    assert files["a.html"].error is None and files["b.html"].content is None and "100" in files["b.html"].error


def test_ties_have_one_order(spark):
    rows = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 4), (2, "x", 1)], "k int, v string, t int")
    stored = rows.limit(0)
    for keep in (lambda d: upsert.upsert(stored, d, ["k"], None, c("t")), lambda d: upsert.new_rows(stored, d, ["k"])):
        assert len({str(sorted(map(tuple, keep(rows.orderBy(order)).collect()))) for order in ("v", "t", F.desc("v"))}) == 1


def test_page_is_read_once_whatever_is_filtered(spark, batch):
    _, _, _, _ = batch
    pages = spark.createDataFrame([("1", "https://h.gov.tw/", PAGE.format(n=1, noun="機車", k=1, plates=""))],
                                  "source_record_id string, official_url string, content string")
    records, _ = normalize("pcc", pages, AS_OF)
    plan = records.filter((c("status") == "SOLD") & (c("lot_size") > 3))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_a_batch_is_dealt_once_and_stored_keys_keep_their_rows(spark, workdir, monkeypatch):
    path = f"{workdir}/once"
    kinds = "a string, b int, note string"
    first = spark.createDataFrame([("x", 1, "old"), (None, 2, "old"), ("x", 1, "old")], kinds)
    second = spark.createDataFrame([("x", 1, "new"), (None, 2, "new"), ("y", None, "new"), ("y", None, "new"), (None, None, "new")], kinds)

    def dealt_again(*_):
        raise AssertionError("rows that one aggregation has dealt are dealt again")

    monkeypatch.setattr(type(first), "repartition", dealt_again)
    assert jobs_.insert_new(spark, path, first, ["a", "b"], ("s", 1)) == 2
    assert jobs_.insert_new(spark, path, second, ["a", "b"], ("s", 2)) == 2
    assert jobs_.insert_new(spark, path, second, ["a", "b"], ("s", 2)) == 0
    assert jobs_.insert_new(spark, path, second, ["a", "b"], ("s", 3)) == 0
    rows = [tuple(r) for r in versioned.read_table(spark, path).collect()]
    assert sorted(rows, key=str) == sorted([("x", 1, "old"), (None, 2, "old"), ("y", None, "new"), (None, None, "new")], key=str)


def test_shuffle_files_go_with_their_query(spark):
    assert configure(spark).conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    rows = spark.range(1000).groupBy((c("id") % 7).alias("k")).count()
    assert sorted(rows.collect()) == sorted(rows.collect())
