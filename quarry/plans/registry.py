"""Registry of named queries and their oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads the test tables (or
data Spark derives from them).  The oracle is ANSI SQL over the same tables,
run by an independent engine; queries without one are checked by rows and by
our own tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.session import apply_session_conf

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_session_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return run
    return deco
