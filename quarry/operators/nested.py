"""Nested-document operators: explode, field paths, projections, null drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_events(docs: DataFrame, array_col: str = "events", alias: str = "event",
                   keep: tuple[str, ...] = ("description", "link", "title")) -> DataFrame:
    """One row per array element; null or empty arrays give no row.
    Columns of ``keep`` that a narrow read schema left out are skipped."""
    return docs.select(*[c for c in keep if c in docs.columns], F.explode(array_col).alias(alias))


def explode_geometry(events: DataFrame, event_col: str = "event",
                     inner: str = "geometry", alias: str = "geometry") -> DataFrame:
    """Second level of the two-level explode."""
    return events.select(event_col, F.explode(f"{event_col}.{inner}").alias(alias))


def explode_nested(docs: DataFrame) -> DataFrame:
    """documents -> (event, geometry) rows: events first, then each geometry."""
    return explode_geometry(explode_events(docs))


def na_drop(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows whose listed columns are null -- or NaN (F1)."""
    return df.na.drop(subset=subset)


def event_measurements(docs: DataFrame) -> DataFrame:
    """Flagship projection: event id, categories, date, magnitude; no nulls.

    Columns: event, category (array<struct<id,title>>), date, magnitudeValue.
    """
    rows = explode_nested(docs).select(
        F.col("event.id").alias("event"),
        F.col("event.categories").alias("category"),
        F.col("geometry.date"),
        F.col("geometry.magnitudeValue"),
    )
    return na_drop(rows, ["magnitudeValue"])


def field_through_array(array_of_struct: str | Column, field: str) -> Column:
    """``arr.field`` over array<struct> -> array of that field."""
    c = F.col(array_of_struct) if isinstance(array_of_struct, str) else array_of_struct
    return c.getField(field)


def project(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """select + alias: ``{new_name: column or path}``."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def offset_range(df: DataFrame, index_col: str, start_exclusive: int, end_inclusive: int) -> DataFrame:
    """Rows with ``start < index <= end`` -- the half-open offset range (F2)."""
    c = F.col(index_col)
    return df.where((c > F.lit(start_exclusive)) & (c <= F.lit(end_inclusive)))
