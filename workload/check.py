"""Compare queries with their oracles: python -m workload.check [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from noticelake.session import local_session

from . import catalog
from .derive import BASE_TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float) and value.is_integer():
        return repr(int(value))
    return repr(value) if isinstance(value, (int, float)) else str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = catalog.queries()[name](spark, sf_dir)
    got = df.collect()
    took = time.time() - started
    oracle = catalog.oracle_sql().get(name)
    if oracle is None:
        return True, f"{len(got)} rows, no oracle, {took:.1f}s"
    result = con.execute(oracle)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    types = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows(df.columns, got), rows(names, want)
    if a == b:
        odd = [n for n, t in df.dtypes if not same_type(t, types[n])]
        note = f" TYPES {[(n, dict(df.dtypes)[n], types[n]) for n in odd]}" if odd else ""
        return True, f"{len(got)} rows, {took:.1f}s, oracle {time.time() - started - took:.1f}s{note}"
    only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
    return False, f"{len(got)} vs {len(want)} rows\n   columns {sorted(names)}\n   spark {only_a}\n   oracle {only_b}"


SAME = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "timestamp": "TIMESTAMP"}


def same_type(spark_type: str, duck_type: str) -> bool:
    return SAME.get(spark_type) == duck_type or spark_type.upper() == duck_type.upper()


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in args or catalog.queries():
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as exc:  # noqa: BLE001
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
