"""A long listing is written where it is read, changed rows leave their ranges without a shuffle of the others, and runs of characters are cut in batches."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from noticelake.operators import read_model, versioned

from test_read_model import SCHEMA, listing_rows

c = F.col


def expected(rows):
    return {(place, kind, text[i : i + 3]) for place, *texts in rows for kind, text in zip(("exact", "loose"), texts) for i in range(len(text or "") - 2)}


def test_runs_equal_plain_slices(monkeypatch):
    draw = random.Random(3)
    letters = "ab 車機𠮷\x00\U0010ffff1"
    rows = [(draw.choice("pq"), *[draw.choice([None, "", "".join(draw.choices(letters, k=draw.randrange(9)))]) for _ in range(2)]) for _ in range(400)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("place", "exact", "loose"), r)) for r in rows[i : i + 50]],
                                          pa.schema([(n, pa.string()) for n in ("place", "exact", "loose")])) for i in range(0, 400, 50)]
    for held, chars in ((1 << 20, 1 << 20), (60, 11)):
        monkeypatch.setattr(read_model, "HELD_RUNS", held)
        monkeypatch.setattr(read_model, "CUT_CHARS", chars)
        got = [tuple(r.values()) for b in read_model._runs(batches) for r in b.to_pylist()]
        assert set(got) == expected(rows)
        assert held == 60 or len(got) == len(set(got))
    assert list(read_model._runs([])) == [] and len(read_model._runs_of([""], np.zeros(1, np.int64))[0]) == 0


def test_long_listing_and_its_refresh(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(read_model, "LONG", 0)
    path = str(tmp_path / "m")
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first, second = listing_rows(range(300), 1), listing_rows([*range(0, 300, 9), *range(300, 320)], 2)
    read_model.write_model(spark, frame(first), path, ranges=6)
    read_model.refresh(spark, frame(second), path, removed=spark.createDataFrame([(5,), (7,)], "id long"), keep=1)
    now = {r[0]: r for r in first} | {r[0]: r for r in second}
    del now[5], now[7]
    for column in read_model.CLUSTERS:
        assert sorted(map(str, read_model.rows(spark, path, column).select(*SCHEMA_NAMES).collect())) == sorted(map(str, frame(list(now.values())).collect()))
        # the versions before are gone with their files
        assert len(versioned.versions(spark, f"{path}/{column}")) == 1
        named = {p["folder"] for p in versioned.manifest(spark, f"{path}/{column}")["parts"]}
        assert {f"data/{n}" for n, _ in versioned._children(spark, f"{path}/{column}/data")} == named


SCHEMA_NAMES = [x.split()[0] for x in SCHEMA.replace("\n", " ").split(", ")]


def test_rows_leave_their_ranges_without_moving_the_others(spark):
    kept = spark.range(2000).select("id", (c("id") % 4).cast("string").alias("bucket"), F.lit("wide").alias("text"))
    leaving = spark.createDataFrame([(i, str(i % 4)) for i in range(0, 2000, 5)] + [(0, "1")], "id long, bucket string")
    want = sorted(i for i in range(2000) if i % 5)
    for most in (1000, 150, 10):
        left = read_model._without(kept, leaving, most)
        assert sorted(r.id for r in left.collect()) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = read_model._without(kept, leaving, 150)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastExchange") >= 3
        assert sorted(r.id for r in read_model._without(kept, leaving, 10).collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert read_model._without(kept, leaving.limit(0)).count() == 2000
