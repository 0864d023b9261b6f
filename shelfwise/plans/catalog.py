"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver's tables
(through the fixture mapping of ``shelfwise.sources.fixtures``). The oracle
is an independent formulation in plain SQL over the same tables; queries
whose result is not expressible in SQL (trained models) have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all():
    # Importing the modules fills the registry.
    from shelfwise.plans import q_gold, q_clean, q_report, q_model, q_io  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
