"""All registered queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import corpus, history, market, notices, pages, streams

MODULES = [market, notices, corpus, pages, history, streams]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for module in MODULES for name, fn in module.query.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.query.oracles.items()}
