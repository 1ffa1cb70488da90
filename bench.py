"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from noticelake.session import local_session  # noqa: E402
from workload import catalog  # noqa: E402

HEADLINE = [
    "listing_view", "listing_active_page", "listing_price_desc_keyset", "listing_count", "listing_favorites", "keyword_search",
    "query_params", "classify_notices", "official_dates", "plates_masked", "sanitize_documents", "audit_counts", "notices_procurement",
    "notices_sale", "public_projection", "upsert_records", "change_detection", "dedupe_lineitem", "resolved_evidence", "identity_exact",
    "duplicate_candidates", "retention_plan", "run_accounting", "price_history", "page_links",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8, "bench")
    queries = catalog.queries()
    queries["displacement_bands"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total seconds of the headline queries, cold plans", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None, "cpus": cores,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
