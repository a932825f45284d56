"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables.  The
oracle SQL computes the same rows with DuckDB (tables are pre-registered as
views); queries whose semantics SQL cannot state have no oracle entry and are
checked against brute force on fixtures in ``tests/`` instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so that its queries register themselves."""
    import importlib
    for mod in ("corpus", "hyps", "text_jobs", "scoring", "parallel", "subwords", "routing", "streams"):
        try:
            importlib.import_module(f"tessera.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"tessera.plans.{mod}":
                raise
