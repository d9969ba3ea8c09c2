"""Harmonic mean as a native (JVM, codegen, partially aggregated) expression.

Semantics of the (count, sum of reciprocals) buffer:
* a zero value contributes +Infinity, so any zero makes the result 0.0;
* no values -> NaN (0 / 0.0);
* reciprocals that cancel to 0.0 -> +Infinity (n / 0.0);
* nulls are skipped, as SQL aggregates do.

Because it is built from ``count`` and ``sum`` it works in batch, in SQL and
in streaming aggregation (where grouped pandas UDFs are refused), and Spark
combines it map-side before the shuffle, so a hot key never gathers its
raw rows in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _inf() -> Column:
    return F.lit(float("inf"))


def _nan() -> Column:
    return F.lit(float("nan"))


def reciprocal(value: Column | str) -> Column:
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(v == 0, _inf()).otherwise(F.lit(1.0) / v)


def finish(n: Column, s: Column) -> Column:
    return (F.when(n == 0, _nan())
            .when(s == 0, _inf())
            .otherwise(n.cast("double") / s))


def harmonic_mean(value: Column | str) -> Column:
    """Aggregate expression: ``n / sum(1/v)`` with the rules above."""
    v = F.col(value) if isinstance(value, str) else value
    return finish(F.count(v), F.sum(reciprocal(v)))


# SQL surface: two inlined SQL functions, so plain SQL keeps the partial
# aggregation:  hm_finish(count(v), sum(hm_inv(v))).
SQL_FUNCTIONS = (
    "CREATE OR REPLACE TEMPORARY FUNCTION hm_inv(v DOUBLE) RETURNS DOUBLE "
    "RETURN CASE WHEN v = 0 THEN double('inf') ELSE 1D / v END",
    "CREATE OR REPLACE TEMPORARY FUNCTION hm_finish(n BIGINT, s DOUBLE) RETURNS DOUBLE "
    "RETURN CASE WHEN n = 0 THEN double('NaN') WHEN s = 0 THEN double('inf') ELSE n / s END",
)


def register_sql(spark: SparkSession) -> None:
    for stmt in SQL_FUNCTIONS:
        spark.sql(stmt)
