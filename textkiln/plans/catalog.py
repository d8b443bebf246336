"""Registry of named queries and their DuckDB oracle SQL.

Every query takes ``(spark, sf_dir)``, reads the driver tables (or data Spark
derives from them) and returns a DataFrame.  Oracles are plain SQL over the
same tables; they are independent formulations, not generated from the Spark
plans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
# SQL that follows a query at small parameters only; pytest compares the two there.
SMALL_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, small: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        if small is not None:
            SMALL_ORACLES[name] = small.strip()
        return fn

    return register


def load_all() -> None:
    """Import the modules that register queries."""
    from textkiln.plans import corpus_queries, category_queries, token_queries  # noqa: F401
