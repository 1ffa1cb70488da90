import __spark_entry__ as entry
from workload import catalog, check

SMALL = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "listing_entity", "display_price", "completeness", "auction_at"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 120


def test_samples_match_their_oracles(spark):
    con = check.connect(SMALL)
    names = ["listing_active_page", "query_params", "official_dates", "notices_seized", "upsert_records", "identity_exact", "public_quality",
             "stream_latest_records", "listing_detail"]
    failed = {n: note for n in names for ok, note in [check.compare(spark, con, n, SMALL)] if not ok}
    assert not failed


def test_names_follow_the_contract():
    for name in catalog.queries():
        assert "pipeline" not in name and not name.startswith("op")
