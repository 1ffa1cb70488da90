"""How the workload's inputs are laid out."""

from workload import pages

SMALL = "/root/testdata/sf0.001"


def test_keys_are_dealt_not_pages(spark):
    landed = pages.landed(spark, SMALL, pages.SEIZED)
    dealt = [line for line in landed._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert len(dealt) == 1 and "hashpartitioning(notice_id" in dealt[0]
    assert landed.count() == spark.read.parquet(f"{SMALL}/orders.parquet").count()
