"""Upserts, change detection, evidence, runs, identity, retention and quality over derived tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from noticelake.functions.text import stable_id
from noticelake.operators import constraints, dedupe, evidence, identity, listing, quality, registry, retention, runs, upsert, versioned
from noticelake.operators.completeness import completeness, has_text, is_known, never
from noticelake.schemas import AUCTION_STATUSES, DISPOSAL_ORIGINS
from noticelake.session import cut_lineage, shared_dir
from noticelake.sources import seeds

from .derive import AS_OF, base, market, notices, spark_sql, with_market, with_notices
from .registry import Registry

c = F.col
query = Registry()
MONTH = "TIMESTAMP '2024-01-15 00:00:00'"

# --- upserts and change detection ------------------------------------------------------------
# A user is a record, an event one sighting of it; the middle of the month splits stored from incoming.
SIGHTINGS = """
sightings AS (
  SELECT user_id AS record_id, event_id, CAST(ts AS TIMESTAMP) AS seen_at, event_type AS title,
         CASE WHEN value < 50 THEN NULL ELSE event_type END AS path, CAST(floor(value) AS BIGINT) AS amount,
         md5(event_type || CAST(CAST(floor(value / 25) AS BIGINT) AS STRING)) AS payload_checksum, '1.' || CAST(event_id % 2 AS STRING) AS parser_version
  FROM events
)"""


def sightings(spark, sf_dir, where: str = "true"):
    return spark_sql(spark, sf_dir, SIGHTINGS, f"SELECT * FROM sightings WHERE {where}")


LATEST = "SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY event_id DESC) AS rn FROM sightings WHERE {0}"
MERGED = f"""
old AS (SELECT record_id, title, path, amount, seen_at AS first_seen, seen_at AS last_seen FROM ({LATEST.format('seen_at < ' + MONTH)}) x WHERE rn = 1),
new AS (SELECT record_id, arg_max(title, event_id) AS title, arg_max(path, event_id) FILTER (WHERE path IS NOT NULL) AS path,
  max(amount) AS amount, min(seen_at) AS first_seen, max(seen_at) AS last_seen FROM sightings WHERE seen_at >= {MONTH} GROUP BY record_id)"""


@query("upsert_records", "WITH " + SIGHTINGS + "," + MERGED + """
SELECT coalesce(o.record_id, n.record_id) AS record_id, coalesce(n.title, o.title) AS title, coalesce(n.path, o.path) AS path,
  greatest(o.amount, n.amount) AS amount, strftime(least(o.first_seen, n.first_seen), '%Y-%m-%d %H:%M:%S') AS first_seen,
  strftime(greatest(o.last_seen, n.last_seen), '%Y-%m-%d %H:%M:%S') AS last_seen, coalesce(o.title, n.title) AS kept
FROM old o FULL JOIN new n ON o.record_id = n.record_id""".replace("coalesce(o.title, n.title) AS kept", "coalesce(o.title, k.title) AS kept").replace(
    "FROM old o FULL JOIN new n ON o.record_id = n.record_id",
    f"FROM old o FULL JOIN new n ON o.record_id = n.record_id LEFT JOIN (SELECT record_id, arg_min(title, event_id) AS title FROM sightings WHERE seen_at >= {MONTH} "
    "GROUP BY record_id) k ON k.record_id = n.record_id"))
def upsert_records(spark, sf_dir):
    def shaped(df):
        return df.select("record_id", "title", "path", "amount", c("seen_at").alias("first_seen"), c("seen_at").alias("last_seen"),
                         c("title").alias("kept"), "event_id")

    stored = dedupe.last_per_key(sightings(spark, sf_dir, f"seen_at < {MONTH}"), ["record_id"], c("event_id"))
    merged = upsert.upsert(
        shaped(stored).drop("event_id"), shaped(sightings(spark, sf_dir, f"seen_at >= {MONTH}")), ["record_id"],
        {"path": "coalesce", "amount": "max", "first_seen": "min", "last_seen": "max", "kept": "keep"}, c("event_id"))
    stamp = lambda n: F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n)
    return merged.select("record_id", "title", "path", "amount", stamp("first_seen"), stamp("last_seen"), "kept")


THIRDS = """
thirds AS (
  SELECT user_id AS record_id, event_id, CAST(ts AS TIMESTAMP) AS seen_at, event_type AS title, CASE WHEN value < 50 THEN NULL ELSE event_type END AS path,
         CAST(floor(value) AS BIGINT) AS amount, CASE WHEN CAST(ts AS TIMESTAMP) < TIMESTAMP '2024-01-11 00:00:00' THEN 1 WHEN CAST(ts AS TIMESTAMP) < TIMESTAMP '2024-01-21 00:00:00' THEN 2 ELSE 3 END AS batch
  FROM events
)"""


@query("upsert_table_rows", "WITH " + THIRDS + """
SELECT record_id, arg_max(title, CAST(batch AS BIGINT) * 1000000000 + event_id) AS title, arg_max(path, CAST(batch AS BIGINT) * 1000000000 + event_id) FILTER (WHERE path IS NOT NULL) AS path,
  max(amount) FILTER (WHERE batch <> 2) AS amount, arg_min(title, CAST(batch AS BIGINT) * 1000000000 + event_id) AS kept,
  arg_max(title, CAST(batch AS BIGINT) * 1000000000 + event_id) FILTER (WHERE batch <> 2) AS note, strftime(min(seen_at), '%Y-%m-%d %H:%M:%S') AS first_seen
FROM thirds GROUP BY record_id""")
def upsert_table_rows(spark, sf_dir):
    """Three batches into a versioned table. The second one lacks two columns, and compaction comes between the second and the third."""
    path = f"{shared_dir(spark)}/versioned-{uuid.uuid4().hex}"
    rules = {"path": "coalesce", "amount": "max", "first_seen": "min", "kept": "keep"}
    rows = spark_sql(spark, sf_dir, THIRDS, "SELECT *, title AS kept, title AS note, seen_at AS first_seen FROM thirds")
    for batch in (1, 2, 3):
        own = rows.filter(c("batch") == batch).select(
            "record_id", "event_id", "title", "path", "kept", "first_seen", *(["amount", "note"] if batch != 2 else []))
        versioned.upsert_batch(spark, path, own, ["record_id"], rules, c("event_id"))
        if batch == 2:
            versioned.compact(spark, path)
    return versioned.read_table(spark, path).select(
        "record_id", "title", "path", "amount", "kept", "note", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


@query("change_detection", "WITH " + SIGHTINGS + f"""
SELECT n.record_id, n.payload_checksum, n.parser_version, n.event_id, k.record_id IS NULL AS new_snapshot, k.record_id IS NULL OR r.record_id IS NULL AS changed
FROM (SELECT record_id, payload_checksum, parser_version, min(event_id) AS event_id FROM sightings WHERE seen_at >= {MONTH} GROUP BY ALL) n
LEFT JOIN (SELECT DISTINCT record_id, payload_checksum, parser_version FROM sightings WHERE seen_at < {MONTH}) k USING (record_id, payload_checksum, parser_version)
LEFT JOIN (SELECT DISTINCT record_id FROM sightings WHERE seen_at < {MONTH}) r ON r.record_id = n.record_id""")
def change_detection(spark, sf_dir):
    stored = sightings(spark, sf_dir, f"seen_at < {MONTH}")
    incoming = sightings(spark, sf_dir, f"seen_at >= {MONTH}").withColumn("observed_at", c("event_id"))
    return upsert.detect_changes(stored, incoming, stored).select(
        "record_id", "payload_checksum", "parser_version", "event_id", "new_snapshot", "changed")


@query("insert_ignore", "WITH " + SIGHTINGS + f"""
SELECT record_id, path, min(event_id) AS event_id FROM sightings s WHERE seen_at >= {MONTH}
  AND NOT EXISTS (SELECT 1 FROM sightings o WHERE o.seen_at < {MONTH} AND o.record_id = s.record_id AND o.path IS NOT DISTINCT FROM s.path) GROUP BY record_id, path""")
def insert_ignore(spark, sf_dir):
    new = upsert.new_rows(sightings(spark, sf_dir, f"seen_at < {MONTH}"), sightings(spark, sf_dir, f"seen_at >= {MONTH}"), ["record_id", "path"], [c("event_id")])
    return new.select("record_id", "path", "event_id")


@query("append_only_check", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'REMOVED' ELSE 'ALTERED' END AS problem FROM events WHERE event_type IN ('error', 'signup')""")
def append_only_check(spark, sf_dir):
    old = base(spark, sf_dir, "events").select("event_id", "event_type", "value")
    new = old.filter(c("event_type") != "error").withColumn("value", F.when(c("event_type") == "signup", c("value") + 1).otherwise(c("value")))
    return upsert.append_only_violations(old, new, ["event_id"])


@query("dedupe_lineitem", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) x WHERE rn = 1""")
def dedupe_lineitem(spark, sf_dir):
    rows = base(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    arrival = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    return dedupe.last_per_key(rows, ["l_orderkey", "l_linenumber"], arrival).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("first_k_per_group", """
SELECT l_suppkey, rank, l_orderkey FROM (SELECT l_suppkey, l_orderkey, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice)
  AS INTEGER) AS rank FROM lineitem) x WHERE rank <= 20""")
def first_k(spark, sf_dir):
    rows = base(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    order = [c(n).asc() for n in ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]
    return dedupe.top_per_key(rows, ["l_suppkey"], order, 20, "rank").select("l_suppkey", "rank", "l_orderkey")


# --- evidence --------------------------------------------------------------------------------------
EVIDENCE = """
evidence AS (
  SELECT l_orderkey * 100000 + l_partkey AS id, 'vehicle' AS entity_type, l_partkey AS entity_id, l_linestatus AS field_name,
    CASE l_suppkey % 8 WHEN 0 THEN 'OFFICIAL_EXPLICIT' WHEN 1 THEN 'CROSS_SOURCE_CONFIRMED' WHEN 2 THEN 'OFFICIAL_INFERRED' WHEN 3 THEN 'SYSTEM_CALCULATED'
      WHEN 4 THEN 'LLM_EXTRACTED' WHEN 5 THEN 'THIRD_PARTY_REFERENCE' WHEN 6 THEN 'UNKNOWN' ELSE 'SOMETHING_ELSE' END AS trust,
    CAST(floor(l_quantity / 10) AS BIGINT) AS confidence, l_shipdate AS created_at, l_suppkey AS supplier, l_orderkey AS record_id
  FROM lineitem
)"""


@query("resolved_evidence", "WITH " + EVIDENCE + """
SELECT entity_id, field_name, id, trust, confidence FROM (SELECT *, row_number() OVER (PARTITION BY entity_type, entity_id, field_name ORDER BY
  CASE supplier % 8 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 5 WHEN 5 THEN 6 ELSE 7 END, confidence DESC, created_at DESC, id) AS rn
  FROM evidence) x WHERE rn = 1""")
def resolved(spark, sf_dir):
    rows = spark_sql(spark, sf_dir, EVIDENCE, "SELECT * FROM evidence")
    return evidence.resolved_evidence(rows).select("entity_id", "field_name", "id", "trust", "confidence")


STORED = """
artifacts AS (
  SELECT l_orderkey * 100000 + l_partkey AS id, l_orderkey AS record_id, l_shipdate AS fetched_at, CASE l_linenumber % 3 WHEN 0 THEN 'application/json' WHEN 1 THEN 'text/html'
    ELSE 'application/pdf' END AS mime_type, CASE l_returnflag WHEN 'R' THEN '1.3.0' ELSE '1.4.0' END AS parser_version,
    'https://h.tw/' || CAST(l_partkey AS STRING) AS official_url, 'p/' || CAST(l_suppkey AS STRING) AS storage_path, CAST(l_extendedprice AS STRING) AS checksum_sha256
  FROM lineitem
),
snapshots AS (
  SELECT l_orderkey * 100000 + l_suppkey AS id, l_orderkey AS record_id, l_shipdate AS observed_at, l_partkey AS part,
    CASE WHEN l_suppkey % 3 = 0 THEN '{"eligibility":"LICENSED_RECYCLER_ONLY"}' WHEN l_suppkey % 3 = 1 THEN '{"eligibility":"PUBLIC"}' ELSE '{}' END AS payload
  FROM lineitem
)"""


@query("reprocess_queue", with_market("""
SELECT r.source_record_id, a.id AS artifact_id, a.mime_type, CASE WHEN s.payload LIKE '%RECYCLER%' THEN 'LICENSED_RECYCLER_ONLY' WHEN s.payload LIKE '%PUBLIC%' THEN 'PUBLIC'
  ELSE 'UNKNOWN' END AS eligibility, coalesce(s.payload LIKE '%RECYCLER%', false) AS recycler_only
FROM records r JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY fetched_at DESC, CASE mime_type WHEN 'application/json' THEN 0 ELSE 1 END, id) AS rn
  FROM artifacts WHERE mime_type IN ('application/json', 'text/html') AND parser_version = '1.4.0') x WHERE rn = 1) a ON a.record_id = r.id
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY observed_at DESC, id) AS rn FROM snapshots) x WHERE rn = 1) s ON s.record_id = r.id""", STORED))
def reprocess_queue(spark, sf_dir):
    records = market(spark, sf_dir)["records"].withColumnRenamed("id", "record_id")
    artifacts = spark_sql(spark, sf_dir, STORED, "SELECT * FROM artifacts")
    snapshots = spark_sql(spark, sf_dir, STORED, "SELECT * FROM snapshots")
    queue = evidence.reprocessable(records, artifacts, snapshots, "1.4.0")
    return queue.select("source_record_id", "artifact_id", "mime_type", "eligibility", "recycler_only")


@query("photo_artifacts", with_market("""
SELECT p.record_id, p.source_url, arg_min(a.id, (a.fetched_at, a.id)) AS artifact_id FROM (SELECT l_orderkey AS record_id, 'https://h.tw/' || l_partkey AS source_url FROM lineitem
  WHERE l_linestatus = 'O' GROUP BY ALL) p LEFT JOIN (SELECT * FROM artifacts WHERE mime_type <> 'text/html') a ON a.record_id = p.record_id AND a.official_url = p.source_url GROUP BY ALL""", STORED).replace(
    "arg_min(a.id, (a.fetched_at, a.id))", "max(a.best)").replace("(SELECT * FROM artifacts WHERE mime_type <> 'text/html') a",
    "(SELECT record_id, official_url, id AS best FROM (SELECT *, row_number() OVER (PARTITION BY record_id, official_url ORDER BY fetched_at DESC, id) AS rn FROM artifacts WHERE mime_type <> 'text/html') y WHERE rn = 1) a"))
def photo_artifacts(spark, sf_dir):
    links = spark_sql(spark, sf_dir, "", "SELECT DISTINCT l_orderkey AS record_id, 'https://h.tw/' || CAST(l_partkey AS STRING) AS source_url FROM lineitem WHERE l_linestatus = 'O'")
    landed = spark_sql(spark, sf_dir, STORED, "SELECT * FROM artifacts WHERE mime_type <> 'text/html'")
    return evidence.match_artifacts(links, landed).select("record_id", "source_url", "artifact_id")


# --- runs and source health -------------------------------------------------------------------------
# One run per user and day; its events are the items.
RUNS = """
items AS (
  SELECT user_id * 100 + day(ts) AS run_id, user_id % 25 AS source_id, event_id AS record_id, event_type <> 'error' OR event_id % 3 = 0 AS fetched,
    event_type NOT IN ('error') AND event_id % 50 <> 0 AS parsed, event_type = 'purchase' AS changed,
    CASE WHEN event_type = 'error' OR event_id % 50 = 0 THEN 'failed' END AS error, CASE WHEN event_type = 'view' AND event_id % 40 = 1 THEN 'partial' END AS partial_warning,
    CAST(ts AS TIMESTAMP) AS seen_at
  FROM events
),
policies AS (
  SELECT CAST(n_nationkey AS BIGINT) AS source_id, CASE n_nationkey % 4 WHEN 0 THEN 'ALLOW' WHEN 1 THEN 'MANUAL_ONLY' WHEN 2 THEN 'REVIEW_REQUIRED' ELSE 'DISABLED' END AS decision
  FROM nation WHERE n_name <> 'NATION_24'
)"""
COUNTED = """
counted AS (SELECT run_id, source_id, count(*) AS discovered_count, count(*) FILTER (WHERE fetched) AS fetched_count, count(*) FILTER (WHERE parsed) AS parsed_count,
  count(*) FILTER (WHERE changed) AS changed_count, count(*) FILTER (WHERE error IS NOT NULL OR partial_warning IS NOT NULL) AS failed_count FROM items GROUP BY run_id, source_id),
finished AS (SELECT *, CASE WHEN parsed_count = 0 AND failed_count > 0 THEN 'FAILED' WHEN failed_count > 0 OR (fetched_count > 0 AND parsed_count < 0.9 * fetched_count)
  THEN 'PARTIAL' ELSE 'SUCCEEDED' END AS status, failed_count + CASE WHEN fetched_count > 0 AND parsed_count < 0.9 * fetched_count THEN 1 ELSE 0 END AS warning_count FROM counted)"""


def outcomes(spark, sf_dir):
    return spark_sql(spark, sf_dir, RUNS, "SELECT * FROM items")


ALL_RUNS = """
all_runs AS (SELECT run_id, source_id, CAST(NULL AS VARCHAR(20)) AS run_error FROM items GROUP BY run_id, source_id
  UNION ALL SELECT CAST(-1 - n_nationkey AS BIGINT), CAST(n_nationkey AS BIGINT), CASE WHEN n_nationkey % 2 = 0 THEN 'no answer' END FROM nation)"""


@query("run_accounting", "WITH " + RUNS + "," + COUNTED + "," + ALL_RUNS + """
SELECT * FROM finished UNION ALL SELECT run_id, source_id, 0, 0, 0, 0, 0, CASE WHEN run_error IS NULL THEN 'PARTIAL' ELSE 'FAILED' END,
  CASE WHEN run_error IS NULL THEN 1 ELSE 2 END FROM all_runs WHERE run_id < 0""")
def run_accounting(spark, sf_dir):
    """Runs with items, runs that discovered nothing, and runs that failed before the first item."""
    every = spark_sql(spark, sf_dir, RUNS + "," + ALL_RUNS, "SELECT * FROM all_runs")
    return runs.finish_runs(outcomes(spark, sf_dir), every).drop("run_warnings")


@query("run_warnings", "WITH " + RUNS + """ SELECT run_id, record_id || ': ' || coalesce(error, partial_warning) AS warning FROM items
  WHERE error IS NOT NULL OR partial_warning IS NOT NULL""")
def run_warnings(spark, sf_dir):
    return runs.item_warnings(outcomes(spark, sf_dir))


STATUS = """CASE coalesce(decision, 'REVIEW_REQUIRED') WHEN 'DISABLED' THEN 'DISABLED' WHEN 'REVIEW_REQUIRED' THEN 'DEGRADED'
  WHEN 'MANUAL_ONLY' THEN CASE status WHEN 'FAILED' THEN 'DEGRADED' ELSE 'PARTIAL' END
  ELSE CASE status WHEN 'SUCCEEDED' THEN 'ACTIVE' WHEN 'PARTIAL' THEN 'PARTIAL' ELSE 'DEGRADED' END END"""


@query("source_status", "WITH " + RUNS + "," + COUNTED + f" SELECT run_id, source_id, status, {STATUS} AS source_status FROM finished LEFT JOIN policies USING (source_id)")
def source_status(spark, sf_dir):
    finished = runs.finish_runs(outcomes(spark, sf_dir))
    return runs.apply_policies(finished, spark_sql(spark, sf_dir, RUNS, "SELECT * FROM policies")).select("run_id", "source_id", "status", "source_status")


@query("source_gate", "WITH " + RUNS + """ SELECT record_id, CASE WHEN decision = 'ALLOW' OR (decision = 'MANUAL_ONLY' AND changed) THEN 'open'
  WHEN decision IS NULL THEN 'no reviewed access policy' ELSE 'access is ' || decision END AS outcome FROM items LEFT JOIN policies USING (source_id)""")
def source_gate(spark, sf_dir):
    items = outcomes(spark, sf_dir).withColumn("has_manifest", c("changed"))
    allowed, blocked = runs.gate(items, spark_sql(spark, sf_dir, RUNS, "SELECT * FROM policies"))
    return allowed.select("record_id", F.lit("open").alias("outcome")).unionByName(blocked.select("record_id", c("error").alias("outcome")))


HEALTH_NOW = "2024-01-20 00:00:00"
HEALTH = f"""
timed AS (SELECT f.*, s.started_at FROM finished f JOIN (SELECT run_id, min(seen_at) AS started_at FROM items GROUP BY run_id) s USING (run_id)),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY started_at DESC, run_id DESC) AS rn FROM timed) x WHERE rn = 1),
successes AS (SELECT source_id, max(started_at) AS last_successful_at FROM timed WHERE status = 'SUCCEEDED' GROUP BY source_id),
health AS (SELECT CAST(n_nationkey AS BIGINT) AS source_id, n_name AS name, l.status AS last_run_status, coalesce(discovered_count, 0) AS discovered_count,
  CAST(round(100.0 * parsed_count / nullif(fetched_count, 0), 1) AS VARCHAR) AS parse_success_rate,
  CAST(CASE WHEN failed_count > 0 THEN 1 ELSE 0 END + CASE WHEN l.status = 'FAILED' THEN 1 ELSE 0 END
    + CASE WHEN last_successful_at < TIMESTAMP '{HEALTH_NOW}' - INTERVAL 36 HOUR THEN 1 ELSE 0 END AS BIGINT) AS warnings,
  CASE n_nationkey % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PLANNED' ELSE 'DEGRADED' END AS status
  FROM nation LEFT JOIN latest l ON l.source_id = n_nationkey LEFT JOIN successes s ON s.source_id = n_nationkey)"""


def health_frame(spark, sf_dir):
    items = outcomes(spark, sf_dir)
    started = items.groupBy("run_id").agg(F.min("seen_at").alias("started_at"))
    finished = runs.finish_runs(items).join(started, "run_id").withColumn(
        "warnings", F.array_compact(F.array(F.when(c("failed_count") > 0, F.lit("items failed")))))
    successes = finished.filter(c("status") == "SUCCEEDED").groupBy("source_id").agg(F.max("started_at").alias("last_successful_at"))
    sources = spark_sql(spark, sf_dir, "", """SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, n_name AS adapter_name,
        CASE n_nationkey % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PLANNED' ELSE 'DEGRADED' END AS status FROM nation""")
    sources = sources.join(successes.withColumnRenamed("source_id", "id"), "id", "left")
    return runs.source_health(sources, finished, HEALTH_NOW)


@query("latest_run_health", "WITH " + RUNS + "," + COUNTED + "," + HEALTH + " SELECT source_id, name, last_run_status, discovered_count, parse_success_rate, warnings FROM health")
def latest_run_health(spark, sf_dir):
    return health_frame(spark, sf_dir).select(
        "source_id", "name", "last_run_status", c("discovered_count").cast("bigint").alias("discovered_count"),
        c("parse_success_rate").cast("double").cast("string").alias("parse_success_rate"), F.size("warnings").cast("bigint").alias("warnings"))


@query("source_metrics", "WITH " + RUNS + "," + COUNTED + "," + HEALTH + """ SELECT count(*) FILTER (WHERE status = 'ACTIVE') AS active,
  count(*) FILTER (WHERE status IN ('ACTIVE', 'PARTIAL', 'DEGRADED')) AS monitored, CAST(sum(warnings) AS BIGINT) AS warnings FROM health""")
def source_metrics(spark, sf_dir):
    return runs.source_metrics(health_frame(spark, sf_dir))


@query("branch_health", """
SELECT CAST(c_nationkey AS BIGINT) AS source_id, count(*) FILTER (WHERE c_acctbal > 0) || '/' || count(*) AS message,
  CASE WHEN bool_and(c_acctbal > 0) THEN 'ACTIVE' WHEN bool_or(c_acctbal > 0) THEN 'PARTIAL' ELSE 'DEGRADED' END AS status FROM customer GROUP BY c_nationkey""")
def branch_health(spark, sf_dir):
    checks = base(spark, sf_dir, "customer").select(c("c_nationkey").cast("bigint").alias("source_id"), (c("c_acctbal") > 0).alias("healthy"))
    return runs.branch_health(checks).select("source_id", "message", "status")


# --- identity ------------------------------------------------------------------------------------------
@query("identity_exact", with_market("""
SELECT left_id, right_id, arg_min(link_type, priority) AS link_type, min(priority) AS priority FROM (
  SELECT first_id AS left_id, vehicle_id AS right_id, identifier_type AS link_type, CAST(CASE identifier_type WHEN 'FRAME' THEN 1 WHEN 'ENGINE' THEN 3 ELSE 4 END AS INTEGER) AS priority
  FROM (SELECT DISTINCT vehicle_id, identifier_type, normalized_value, min(vehicle_id) OVER (PARTITION BY identifier_type, normalized_value) AS first_id FROM identifiers) x
  WHERE vehicle_id <> first_id) y GROUP BY left_id, right_id"""))
def identity_exact(spark, sf_dir):
    return identity.identity_links(market(spark, sf_dir)["identifiers"].select("vehicle_id", "identifier_type", "normalized_value"))


@query("identity_case_lots", """
SELECT left_id, right_id, 'CASE_LOT' AS link_type, 5 AS priority FROM (
  SELECT o_orderkey AS right_id, min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority) AS left_id FROM orders) x WHERE left_id <> right_id""")
def identity_case_lots(spark, sf_dir):
    lots = base(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("vehicle_id"), c("o_custkey").cast("string").alias("case_number"), c("o_orderpriority").alias("lot_number"))
    nothing = lots.select("vehicle_id", F.lit("PLATE").alias("identifier_type"), F.lit("").alias("normalized_value"))
    return identity.identity_links(nothing, lots)


CANDIDATES = """
goods AS (SELECT o_orderkey AS vehicle_id, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS brand, o_orderstatus AS model,
  CAST(o_custkey % 20 AS INT) AS year, 'L' || CAST(o_custkey % 7 AS STRING) AS location, CAST(o_orderdate AS DATE) AS day FROM orders)"""


@query("duplicate_candidates", "WITH " + CANDIDATES + """,
pairs AS (
  SELECT min(vehicle_id) OVER (PARTITION BY brand, model, year, location) AS left_id, vehicle_id AS right_id FROM goods WHERE brand IS NOT NULL
  UNION SELECT min(vehicle_id) OVER (PARTITION BY brand, model, year, day), vehicle_id FROM goods WHERE brand IS NOT NULL
  UNION SELECT min(vehicle_id) OVER (PARTITION BY brand, model, location, day), vehicle_id FROM goods WHERE brand IS NOT NULL)
SELECT left_id, right_id, CAST(CAST(0.6 + CASE WHEN a.year = b.year THEN 0.15 ELSE 0 END + CASE WHEN a.location = b.location THEN 0.15 ELSE 0 END
  + CASE WHEN a.day = b.day THEN 0.1 ELSE 0 END AS DECIMAL(5, 4)) AS VARCHAR) AS score,
  concat_ws(',', 'brand', 'model', CASE WHEN a.year = b.year THEN 'year' END, CASE WHEN a.location = b.location THEN 'location' END, CASE WHEN a.day = b.day THEN 'day' END) AS matching_signals
FROM pairs JOIN goods a ON a.vehicle_id = left_id JOIN goods b ON b.vehicle_id = right_id WHERE left_id <> right_id""")
def duplicate_candidates(spark, sf_dir):
    found = identity.duplicate_candidates(spark_sql(spark, sf_dir, CANDIDATES, "SELECT * FROM goods"))
    return found.select("left_id", "right_id", c("score").cast("string").alias("score"), "matching_signals")


@query("duplicate_groups", "WITH " + CANDIDATES + """,
sets AS (
  SELECT vehicle_id, 1.0 AS score, 'brand,model,year,location,day' AS signals, min(vehicle_id) OVER w AS group_id, count(*) OVER w AS size FROM goods WHERE brand IS NOT NULL
    WINDOW w AS (PARTITION BY brand, model, year, location, day)
  UNION ALL SELECT vehicle_id, 0.9, 'brand,model,year,location', min(vehicle_id) OVER w, count(*) OVER w FROM goods WHERE brand IS NOT NULL WINDOW w AS (PARTITION BY brand, model, year, location)
  UNION ALL SELECT vehicle_id, 0.85, 'brand,model,location,day', min(vehicle_id) OVER w, count(*) OVER w FROM goods WHERE brand IS NOT NULL WINDOW w AS (PARTITION BY brand, model, location, day)
  UNION ALL SELECT vehicle_id, 0.85, 'brand,model,year,day', min(vehicle_id) OVER w, count(*) OVER w FROM goods WHERE brand IS NOT NULL WINDOW w AS (PARTITION BY brand, model, year, day)
)
SELECT vehicle_id, group_id, signals, CAST(CAST(score AS DECIMAL(5, 4)) AS VARCHAR) AS score, size FROM sets WHERE size > 1
QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY score DESC, signals) = 1""")
def duplicate_groups(spark, sf_dir):
    found = identity.duplicate_groups(spark_sql(spark, sf_dir, CANDIDATES, "SELECT * FROM goods"))
    return found.select("vehicle_id", "group_id", "signals", c("score").cast("string").alias("score"), "size")


# The four vehicles of an order are tied one to the next by frame, plate and lot; every third order's last one to its customer's first order.
CHAIN = """
chained AS (SELECT o_orderkey AS k, o_orderkey % 3 = 0 AS tied, min(o_orderkey) OVER (PARTITION BY o_custkey) AS head FROM orders)"""


@query("identity_components", "WITH " + CHAIN + """,
roots AS (SELECT k, CASE WHEN tied THEN head ELSE k END AS root FROM chained)
SELECT k * 10 + i AS vehicle_id, root * 10 + 1 AS component_id,
  'CASE_LOT,FRAME,' || CASE WHEN bool_or(k % 3 = 0) OVER (PARTITION BY root) THEN 'OFFICIAL_LINK,' ELSE '' END || 'PLATE' AS signals
FROM roots, (VALUES (1), (2), (3), (4)) v(i)""")
def identity_components(spark, sf_dir):
    keys = spark_sql(spark, sf_dir, CHAIN, "SELECT * FROM chained")
    k, text = c("k"), c("k").cast("string")
    pair = lambda kind, i: F.explode(F.array(*[F.struct(F.lit(kind).alias("identifier_type"), F.concat(F.lit(kind), text).alias("normalized_value"), (k * 10 + j).alias("vehicle_id")) for j in (i, i + 1)]))
    identifiers = keys.select(pair("FRAME", 1).alias("x")).union(keys.select(pair("PLATE", 2).alias("x"))).select("x.*")
    lots = keys.select(F.explode(F.array(k * 10 + 3, k * 10 + 4)).alias("vehicle_id"), F.concat(F.lit("C"), text).alias("case_number"), F.lit("1").alias("lot_number"))
    official = keys.filter("tied").select((k * 10 + 4).alias("left_id"), (c("head") * 10 + 1).alias("right_id"))
    found = identity.identity_components(identity.identity_links(identifiers, lots, official))
    return found.select("vehicle_id", "component_id", F.array_join("signals", ",").alias("signals"))


@query("brand_resolution", with_market("""
SELECT v.id AS vehicle_id, b.id AS brand_id, m.id AS model_id FROM vehicles v
LEFT JOIN (SELECT id, canonical_name AS name FROM brands UNION ALL SELECT id, 'Brand#' || id FROM brands) b ON b.name = v.original_brand
LEFT JOIN (SELECT brand_id, name, min(id) AS id FROM (SELECT brand_id, id, canonical_name AS name FROM models UNION SELECT brand_id, id, model_code FROM models) x GROUP BY brand_id, name) m
  ON m.brand_id = b.id AND m.name = v.original_model"""))
def brand_resolution(spark, sf_dir):
    t = market(spark, sf_dir)
    vehicles = t["vehicles"].select(c("id").alias("vehicle_id"), c("original_brand").alias("brand"), c("original_model").alias("model"))
    brands = t["brands"].withColumn("aliases", F.array(F.concat(F.lit("Brand#"), c("id").cast("string"))))
    return identity.resolve_brands(vehicles, brands, t["models"]).select("vehicle_id", "brand_id", "model_id")


@query("counterparts", "WITH " + CANDIDATES + """ SELECT vehicle_id AS left_id, vehicle_id + 1 AS right_id,
  CASE WHEN year % 2 = 0 THEN vehicle_id + 1 ELSE vehicle_id END AS counterpart FROM goods""")
def counterparts(spark, sf_dir):
    pairs = spark_sql(spark, sf_dir, CANDIDATES, "SELECT vehicle_id AS left_id, vehicle_id + 1 AS right_id, year FROM goods")
    own = F.when(c("year") % 2 == 0, c("left_id")).otherwise(c("right_id"))
    return pairs.select("left_id", "right_id", identity.counterpart(own).alias("counterpart"))


# --- retention -----------------------------------------------------------------------------------------
RETAINED = """
kept_artifacts AS (
  SELECT l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey AS id, l_orderkey AS record_id, CAST(l_shipdate AS TIMESTAMP) AS fetched_at,
    'p/' || CAST(l_suppkey AS STRING) AS storage_path, CAST(l_partkey AS STRING) AS checksum_sha256, CAST(NULL AS TIMESTAMP) AS retention_until FROM lineitem
)"""


@query("retention_plan", with_market("""
SELECT a.id, strftime(coalesce(e.ends_at, a.fetched_at) + INTERVAL 12 MONTH, '%Y-%m-%d %H:%M:%S') AS retention_until
FROM kept_artifacts a LEFT JOIN auction_events e ON e.record_id = a.record_id
WHERE coalesce(e.ends_at, a.fetched_at) + INTERVAL 12 MONTH <= TIMESTAMP '1998-06-01 00:00:00' AND a.record_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""", RETAINED))
def retention_plan(spark, sf_dir):
    artifacts = spark_sql(spark, sf_dir, RETAINED, "SELECT * FROM kept_artifacts")
    dated = retention.backfill_deadlines(artifacts, market(spark, sf_dir)["events"])
    buried = artifacts.join(base(spark, sf_dir, "orders").filter(c("o_orderstatus") == "P").select(c("o_orderkey").alias("record_id")), "record_id", "left_semi")
    # from part 100,000 on, ids of other lines and orders run into each other
    plan = retention.retention_plan(dated, buried.select(c("id").alias("artifact_id"), "record_id"), AS_OF, within=("record_id",))
    return plan.select("id", F.date_format("retention_until", "yyyy-MM-dd HH:mm:ss").alias("retention_until"))


@query("retention_tombstones", with_market("""
SELECT a.id AS artifact_id, '12-month private artifact retention expired' AS reason, 0::BIGINT AS still_due
FROM kept_artifacts a LEFT JOIN auction_events e ON e.record_id = a.record_id
WHERE coalesce(e.ends_at, a.fetched_at) + INTERVAL 12 MONTH <= TIMESTAMP '1998-06-01 00:00:00'""", RETAINED))
def retention_tombstones(spark, sf_dir):
    """Tombstones of all that is due; once they are kept, nothing is due any more."""
    artifacts = spark_sql(spark, sf_dir, RETAINED, "SELECT * FROM kept_artifacts")
    dated = cut_lineage(retention.backfill_deadlines(artifacts, market(spark, sf_dir)["events"]))
    none = dated.select(c("id").alias("artifact_id")).limit(0)
    made = retention.tombstones_for(retention.retention_plan(dated, none, AS_OF), AS_OF)
    again = retention.retention_plan(dated, made, AS_OF).select(c("id").alias("artifact_id"), F.lit(1).cast("bigint").alias("still_due"))
    return made.join(again, "artifact_id", "left").select("artifact_id", "reason", F.coalesce("still_due", F.lit(0).cast("bigint")).alias("still_due"))


# --- completeness, history, documents, quality -------------------------------------------------------------
@query("completeness", with_market("""
SELECT id, overall, i AS identity, a AS auction, k AS condition FROM (SELECT *, CAST(round_even(i * 0.2::DOUBLE + a * 0.25::DOUBLE + k * 0.15::DOUBLE + r * 0.2::DOUBLE + 0 * 0.1::DOUBLE + m * 0.1::DOUBLE, 0) AS INTEGER) AS overall
FROM (SELECT id, CAST(round_even(100.0 * ((original_brand IS NOT NULL)::INT + (original_model IS NOT NULL)::INT + (displacement_cc IS NOT NULL)::INT) / 3, 0) AS INTEGER) AS i,
  CAST(round_even(100.0 * ((manufacture_year IS NOT NULL)::INT + (color IS NOT NULL)::INT + (vehicle_type <> '')::INT + (mileage_km IS NOT NULL)::INT + 1) / 5, 0) AS INTEGER) AS a,
  CAST(round_even(100.0 * ((has_key <> 'UNKNOWN')::INT + (can_start <> 'UNKNOWN')::INT + (can_test <> 'UNKNOWN')::INT + (condition_summary IS NOT NULL)::INT) / 4, 0) AS INTEGER) AS k,
  CASE WHEN registration_status <> 'UNKNOWN' THEN 100 ELSE 0 END AS r, CASE WHEN car_category <> 'UNKNOWN' THEN 100 ELSE 0 END AS m FROM vehicles) x) y"""))
def completeness_scores(spark, sf_dir):
    v = market(spark, sf_dir)["vehicles"]
    scores = completeness({
        "identity": [has_text(c("original_brand")), has_text(c("original_model")), c("displacement_cc").isNotNull()],
        "auction": [c("manufacture_year").isNotNull(), has_text(c("color")), has_text(c("vehicle_type")), c("mileage_km").isNotNull(), F.lit(True)],
        "condition": [is_known(c("has_key")), is_known(c("can_start")), is_known(c("can_test")), has_text(c("condition_summary"))],
        "registration": [is_known(c("registration_status"))], "fees": [never()], "media": [is_known(c("car_category"))]})
    groups = scores["completeness_groups"]
    return v.select("id", scores["completeness"].alias("overall"), *[groups[n].alias(n) for n in ("identity", "auction", "condition")])


@query("price_history", """
SELECT user_id AS vehicle_id, event_id, CAST(CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS BIGINT) AS current_price,
  CAST(greatest(max(CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) + 10 ELSE CAST(floor(value) AS BIGINT) END) OVER (PARTITION BY user_id), 1) AS BIGINT) AS scale,
  event_type AS status FROM events""")
def price_history(spark, sf_dir):
    rows = spark_sql(spark, sf_dir, "", """SELECT user_id AS vehicle_id, event_id AS observed_at, to_json(named_struct('current_price', CASE WHEN event_type = 'view' THEN NULL ELSE
        CAST(floor(value) AS BIGINT) END, 'reserve_price', CAST(floor(value) AS BIGINT) + 10, 'auction_round', 2, 'status', event_type)) AS payload FROM events""")
    points = listing.price_history(rows)
    return points.select("vehicle_id", c("observed_at").alias("event_id"), c("current_price").cast("bigint").alias("current_price"),
                         c("scale").cast("bigint").alias("scale"), "status")


@query("listing_detail", with_market("""
SELECT section, count(*) AS row_count FROM (
  SELECT 'evidence' AS section FROM lineitem
  UNION ALL SELECT 'history' FROM lineitem
  UNION ALL SELECT 'photo' FROM (SELECT DISTINCT vehicle_id, storage_path FROM photos WHERE storage_path IS NOT NULL AND vehicle_id IN (SELECT id FROM vehicles)) p
  UNION ALL SELECT 'duplicate' FROM vehicles v, (VALUES (1), (2)) s(k) WHERE (k = 1 AND v.id IN (SELECT id FROM vehicles)) OR (k = 2 AND v.id + 1 IN (SELECT id FROM vehicles))
  UNION ALL SELECT 'document' FROM vehicles) x GROUP BY section"""))
def listing_detail(spark, sf_dir):
    t = market(spark, sf_dir)
    line = base(spark, sf_dir, "lineitem")
    vehicle = (c("l_orderkey") * 10 + c("l_linenumber")).alias("vehicle_id")
    tables = {
        "records": t["records"], "photos": t["photos"],
        "evidence": line.select(
            c("l_partkey").alias("id"), F.lit("vehicle").alias("entity_type"), vehicle.alias("entity_id"), F.lit("brand").alias("field_name"),
            c("l_returnflag").alias("source_text"), c("l_orderkey").alias("record_id"), F.lit("OFFICIAL_EXPLICIT").alias("trust"), F.lit(1).alias("confidence")),
        "observations": line.select(vehicle, c("l_shipdate").alias("observed_at"), F.lit("{}").alias("payload")),
        "duplicates": t["vehicles"].select(c("id").alias("left_id"), (c("id") + 1).alias("right_id"), F.lit(0.9).alias("score"), F.lit("PENDING").alias("review_status")),
        "documents": t["records"].select(c("id"), c("id").alias("record_id"), c("original_title").alias("title"), F.lit("NOTICE").alias("document_type"), "official_url",
                                         c("id").alias("artifact_id")),
        "artifacts": t["records"].select("id", F.lit("p").alias("storage_path")),
    }
    ids = t["vehicles"].select("id", F.lit("vehicle").alias("listing_entity"), c("lot_id").alias("source_record_id"))
    return listing.listing_detail(tables, ids).groupBy("section").agg(F.count(F.lit(1)).alias("row_count"))


@query("document_links", with_market("""
SELECT r.id, r.original_title AS title, r.official_url AS url, l.record_id IS NOT NULL AS cached FROM records r LEFT JOIN (SELECT DISTINCT l_orderkey AS record_id FROM lineitem) l ON l.record_id = r.id"""))
def document_links(spark, sf_dir):
    records = market(spark, sf_dir)["records"]
    documents = records.select("id", c("id").alias("record_id"), c("original_title").alias("title"), F.lit("NOTICE").alias("document_type"), "official_url", c("id").alias("artifact_id"))
    stored = base(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("id"), F.lit("p").alias("storage_path")).distinct()
    return listing.document_links(documents, stored).select("id", "title", "url", "cached")


@query("quality_report", with_market("""
SELECT 'status_domain' AS check_name, count(*) FILTER (WHERE status = 'UNSOLD') AS violations FROM auction_events
UNION ALL SELECT 'origin_domain', count(*) FILTER (WHERE disposal_origin NOT IN ('JUDICIAL_EXECUTION', 'PUBLIC_ASSET_DISPOSAL', 'SCRAP_DISPOSAL', 'CUSTOMS_FORFEITURE', 'IMPOUNDED_UNCLAIMED', 'ADMINISTRATIVE_ENFORCEMENT')) FROM cases
UNION ALL SELECT 'round_positive', count(*) FILTER (WHERE round_number < 1) FROM auction_events
UNION ALL SELECT 'completeness_range', count(*) FILTER (WHERE completeness > 90) FROM lots
UNION ALL SELECT 'photo_owner', 0 UNION ALL SELECT 'line_key', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) x)
UNION ALL SELECT 'vehicle_key', 0
UNION ALL SELECT 'organization_reference', (SELECT count(*) FROM cases WHERE organization_id IS NOT NULL AND organization_id NOT IN (SELECT id FROM organizations WHERE canonical_name <> '高雄關'))"""))
def quality_report(spark, sf_dir):
    t = market(spark, sf_dir)
    q = quality
    statuses = [s for s in AUCTION_STATUSES if s != "UNSOLD"]
    return q.report(
        q.row_checks(t["events"], {"status_domain": q.outside_domain("status", statuses), "round_positive": q.outside_range("round_number", 1)}),
        q.row_checks(t["cases"], {"origin_domain": q.outside_domain("disposal_origin", DISPOSAL_ORIGINS)}),
        q.row_checks(t["lots"], {"completeness_range": q.outside_range("completeness", 0, 90)}),
        q.row_checks(t["photos"], {"photo_owner": q.not_exactly_one("vehicle_id", "lot_id") | (c("sort_order") < 0)}),
        q.duplicate_keys(base(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "line_key"),
        q.duplicate_keys(t["vehicles"], ["id"], "vehicle_key"),
        q.orphans(t["cases"], t["organizations"].filter(c("canonical_name") != "高雄關"), "organization_id", "id", "organization_reference"),
    )


# Every table of the catalogue over the orders' keys. Remainders by 50 say which promise a row breaks: 6 a required column, 7 a domain, 8 a
# range, 9 a key (the row comes twice), 10 a reference (13 a photo's lot), 11 a rule between columns.
BROKEN = {"required": 6, "domain": 7, "range": 8, "unique": 9, "reference": 10}


def seeded_table(keys, table, least):
    k, text = c("k"), c("k").cast("string")

    def broken(kind: str, bad, good):
        return F.when(k % 50 == BROKEN[kind], bad).otherwise(good)

    columns = {n: F.concat(F.lit(n), text) for key in table.keys for n in key}
    columns |= {n: broken("reference", F.concat(F.lit("lost"), text), F.concat(F.lit("id"), text)) for n in table.references}
    columns |= {n: broken("domain", F.lit("?"), F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))) for n, values in table.domains.items()}
    columns |= {n: broken("range", F.lit(low - 1 if most is None or low else most + 1), F.lit(1)) for n, (low, most) in table.ranges.items()}
    columns |= {n: broken("required", F.lit(None).cast("string"), columns.get(n, F.lit(n))) for n in table.required}
    if "one_owner" in table.rules:
        lost = F.concat(F.lit("lost"), text)
        columns["lot_id"] = F.when(k % 50 == 11, F.concat(F.lit("id"), text)).when(k % 50 == 13, lost)
        columns["vehicle_id"] = F.when(k % 50 != 13, columns["vehicle_id"])
    if "pair" in table.rules:
        left, right = table.references
        other = F.concat(F.lit("id"), F.when(k == least[0], F.lit(least[1])).otherwise(F.lit(least[0])).cast("string"))
        columns[right] = F.when(k % 50 == 11, columns[left]).when(k % 50 == 10, F.concat(F.lit("lost-"), text)).otherwise(other)
    if "https" in table.rules:
        columns["official_url"] = F.when(k % 50 == 11, "http://h.gov.tw/").otherwise("https://h.gov.tw/")
    columns.setdefault("id", F.concat(F.lit("id"), text))
    rows = keys.select("k", *[v.alias(n) for n, v in columns.items()])
    return rows.union(rows.filter(k % 50 == BROKEN["unique"])).drop("k")


def expected_violations() -> str:
    """The counts that the remainders say, as SQL."""
    out = []
    for name, table in constraints.CATALOGUE.items():
        for check in constraints.checks_of(name, table):
            kind = check.rsplit(".", 1)[1]
            where = f"o_orderkey % 50 = {BROKEN.get(kind, 11)}"
            where = "o_orderkey % 50 = 13" if check == "photos.lot_id.reference" else where
            out.append(f"SELECT '{check}' AS check_name, count(*) FILTER (WHERE {where}) AS violations FROM orders")
    return " UNION ALL ".join(out)


@query("constraint_report", expected_violations())
def constraint_report(spark, sf_dir):
    """Every declared promise, each broken by some rows."""
    keys = base(spark, sf_dir, "orders").select(c("o_orderkey").alias("k"))
    least = [r["k"] for r in keys.orderBy("k").limit(2).collect()]
    return constraints.violations({name: seeded_table(keys, table, least) for name, table in constraints.CATALOGUE.items()})


@query("seeded_organizations", with_notices("""
SELECT place_text AS canonical_name, CASE WHEN place_text LIKE '臺灣%地方法院' THEN 'DISTRICT_COURT' ELSE 'GOVERNMENT_AGENCY' END AS organization_type, count(*) AS notices
FROM notices GROUP BY 1, 2"""))
def seeded_organizations(spark, sf_dir):
    """Organizations named by notices merged over the seed: seeded types stay."""
    seeded = seeds.organizations(spark).select("canonical_name", "jurisdiction", "organization_type")
    named = notices(spark, sf_dir, "SELECT place_text AS canonical_name, '臺灣' AS jurisdiction, 'GOVERNMENT_AGENCY' AS organization_type FROM notices")
    merged = upsert.upsert(seeded, named, ["canonical_name", "jurisdiction"], {"organization_type": "keep"})
    counts = named.groupBy("canonical_name").agg(F.count(F.lit(1)).alias("notices"))
    return merged.join(counts, "canonical_name").select("canonical_name", "organization_type", "notices")


@query("surrogate_keys", with_notices("SELECT count(*) AS keys, count(*) AS distinct_keys FROM notices"))
def surrogate_keys(spark, sf_dir):
    keys = notices(spark, sf_dir, "SELECT notice_id, plate, CASE WHEN n > 1 THEN n END AS n FROM notices").select(
        stable_id(c("notice_id"), c("plate"), c("n")).alias("k"))
    return keys.groupBy("k").count().agg(F.sum("count").alias("keys"), F.count(F.lit(1)).alias("distinct_keys"))


# --- registry ------------------------------------------------------------------------------------
ENDPOINTS = """
stored AS (SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_custkey % 40 AS BIGINT) AS source_id, 'https://h.gov.tw/' || c_custkey AS endpoint_url, 'LIST' AS kind FROM customer),
incoming AS (SELECT CAST(o_orderkey + 1000000000 AS BIGINT) AS id, CAST(o_custkey % 40 AS BIGINT) AS source_id, 'https://h.gov.tw/' || o_custkey AS endpoint_url, 'DETAIL' AS kind
  FROM orders)"""
POLICIES = """
stored AS (SELECT CAST(c_custkey AS BIGINT) AS source_id, 'ALLOW' AS decision, CAST('1994-06-01' AS TIMESTAMP) AS reviewed_at FROM customer),
incoming AS (SELECT CAST(o_custkey AS BIGINT) AS source_id, 'P' || o_orderkey AS decision, CAST(o_orderdate AS TIMESTAMP) + o_orderkey * INTERVAL 1 SECOND AS reviewed_at FROM orders)"""


@query("registry_endpoints", "WITH " + ENDPOINTS + """
SELECT coalesce(s.id, i.id) AS id, coalesce(s.source_id, i.source_id) AS source_id, coalesce(s.endpoint_url, i.endpoint_url) AS endpoint_url, coalesce(i.kind, s.kind) AS kind
FROM stored s FULL JOIN (SELECT min(id) AS id, source_id, endpoint_url, kind FROM incoming GROUP BY source_id, endpoint_url, kind) i USING (source_id, endpoint_url)""")
def registry_endpoints(spark, sf_dir):
    stored, incoming = (spark_sql(spark, sf_dir, ENDPOINTS, f"SELECT * FROM {t}") for t in ("stored", "incoming"))
    once = incoming.groupBy("source_id", "endpoint_url", "kind").agg(F.min("id").alias("id"))
    return registry.upsert_endpoints(stored, once.select(*stored.columns))


@query("registry_policies", "WITH " + POLICIES + """
SELECT source_id, arg_max(decision, reviewed_at) AS decision, strftime(max(reviewed_at), '%Y-%m-%d %H:%M:%S') AS reviewed_at FROM (SELECT * FROM stored UNION ALL SELECT * FROM incoming) x
GROUP BY source_id""")
def registry_policies(spark, sf_dir):
    stored, incoming = (spark_sql(spark, sf_dir, POLICIES, f"SELECT * FROM {t}") for t in ("stored", "incoming"))
    return registry.upsert_policies(stored, incoming).withColumn("reviewed_at", F.date_format("reviewed_at", "yyyy-MM-dd HH:mm:ss"))


@query("registry_resolved", """SELECT s_suppkey AS id, n_nationkey::BIGINT AS source_id, NULL AS error FROM supplier JOIN nation ON 'NATION_' || (s_suppkey % 30) = n_name
UNION ALL SELECT s_suppkey, NULL, 'no source with this adapter' FROM supplier WHERE 'NATION_' || (s_suppkey % 30) NOT IN (SELECT n_name FROM nation)""")
def registry_resolved(spark, sf_dir):
    values = base(spark, sf_dir, "supplier").select(c("s_suppkey").alias("id"), F.concat(F.lit("NATION_"), (c("s_suppkey") % 30).cast("string")).alias("adapter_name"))
    sources = base(spark, sf_dir, "nation").select(c("n_name").alias("adapter_name"), c("n_nationkey").cast("bigint").alias("id"))
    found, lost = registry.resolve_endpoints(values, sources)
    return found.select("id", "source_id", F.lit(None).cast("string").alias("error")).union(lost.select("id", F.lit(None).cast("bigint"), "error"))


@query("pair_checks", """SELECT 'link_self' AS check_name, count(*) FILTER (WHERE l_partkey = l_suppkey) AS violations FROM lineitem
UNION ALL SELECT 'link_unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1) x""")
def pair_checks(spark, sf_dir):
    return quality.pair_checks(base(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey", "link")
