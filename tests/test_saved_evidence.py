"""Evidence is compared within its record, where the join has put it, and one query counts one table."""

from pyspark.sql import functions as F

from noticelake.plans import ingest
from workload import pages

SCHEMA = ("entity_type string, entity_id string, field_name string, artifact_id string, text_digest string, record_id string, normalized_value string")


def rows(spark):
    found = [("vehicle", f"v{r}", name, f"a{r}", name, f"r{r}", "x") for r in range(4) for name in ("title", "organization", "title")]
    return spark.createDataFrame([*found, ("lot", "v0", "title", None, "title", "r0", None)], SCHEMA)


def test_evidence_does_not_move_again(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parsed = spark.createDataFrame([(f"r{r}", r) for r in range(4)], "record_id string, no int")
        joined = rows(spark).join(parsed, "record_id").drop("no").select(*rows(spark).columns)
        saved = ingest.save({}, {"evidence": joined})["evidence"]
        plan = saved.filter("entity_type is not null")._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "text_digest" in line.split("ENSURE")[0]]
        assert dealt == []
        again = ingest.save({"evidence": saved}, {"evidence": joined})["evidence"]
        assert saved.count() == again.count() == 9
        assert sorted(map(str, saved.collect())) == sorted(map(str, rows(spark).distinct().collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_are_counted_one_by_one(spark):
    frames = {"a": spark.range(3), "b": spark.range(0)}
    counted = pages.table_counts(spark, frames)
    assert sorted(map(tuple, counted.collect())) == [("a", 3), ("b", 0)]
    assert "Union" not in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.dtypes == [("table_name", "string"), ("row_count", "bigint")]
