"""Registered queries: name -> Spark callable (spark, sf_dir) and, where the
operator is SQL-expressible, the DuckDB oracle statement.

Every query reads the driver's tables (or views Spark derives from them) in
full; no id subsets or row caps.  Limits appear only where they are the
feature (top-k reports).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from ledgerflow.plans import q_models, q_positions, q_parsing, q_reporting  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
