"""Window, aggregate and UDF queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import udfs
from quarry.functions.harmonic import harmonic_mean as harmonic_expr
from quarry.operators import nested, timewindows, twophase, windows
from quarry.operators.aggregates import harmonic
from quarry.plans.documents import _MEAS_KEPT, measurement_docs
from quarry.plans.registry import query
from quarry.session import write_table
from quarry.sources import fixtures, readers, schemas


def _cents_text(arr: str | Column) -> Column:
    """Array of money-like values -> "655,1231,..." (integer cents)."""
    return F.array_join(F.transform(arr, lambda x: F.round(x.cast("double") * 100)
                                    .cast("bigint").cast("string")), ",")


def _ntz(c: str) -> Column:
    return F.col(c).cast("timestamp_ntz")


# ------------------------------------------------------------------ windows
@query("window_running_avg", _MEAS_KEPT + """
SELECT event, category_ids, date,
       round(avg(magnitudeValue) OVER (PARTITION BY category_ids ORDER BY date), 4) AS WindowSpecAvg
FROM kept""")
def window_running_avg(spark, sf_dir):
    """Running average per category ordered by date (RANGE frame)."""
    meas = nested.event_measurements(measurement_docs(spark, sf_dir))
    meas = meas.select("event", F.col("category.id").alias("ids"), "date", "magnitudeValue")
    out = windows.running_average(meas, ["ids"], "date", "magnitudeValue", "WindowSpecAvg")
    return out.select("event", F.array_join("ids", "|").alias("category_ids"), "date",
                      F.round("WindowSpecAvg", 4).alias("WindowSpecAvg"))


@query("window_array_key", _MEAS_KEPT + """
SELECT event, category_ids, date,
       count(*) OVER (PARTITION BY category_ids) AS category_rows,
       round(avg(magnitudeValue) OVER (PARTITION BY category_ids), 4) AS category_avg
FROM kept""")
def window_array_key(spark, sf_dir):
    """Whole-partition aggregates over an array partition key.

    A whole-partition window is an aggregate joined back: partial
    aggregation before the shuffle, a small table joined to the rows.
    """
    meas = nested.event_measurements(measurement_docs(spark, sf_dir))
    meas = meas.select("event", F.col("category.id").alias("ids"), "date", "magnitudeValue")
    out = windows.partition_aggregate(meas, ["ids"], F.count(F.lit(1)).alias("category_rows"),
                                      F.avg("magnitudeValue").alias("category_avg"))
    return out.select("event", F.array_join("ids", "|").alias("category_ids"), "date",
                      "category_rows", F.round("category_avg", 4).alias("category_avg"))


@query("lag_list", """
SELECT CAST(user_id AS VARCHAR) AS COD, ts AS Fecha, CAST(value AS FLOAT) AS Valor,
       array_to_string(list_transform(
           coalesce(list(CAST(value AS FLOAT)) OVER (PARTITION BY user_id ORDER BY ts, CAST(value AS FLOAT)
                    ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), []),
           lambda x: CAST(round(CAST(x AS DOUBLE) * 100) AS BIGINT)), ',') AS laggedValues
FROM events""")
def lag_list(spark, sf_dir):
    """W2 + A8 + W4: the previous 10 values of each series, oldest first."""
    narrow = schemas.prune(schemas.SERIES_DOC_SCHEMA, ["COD", "Data.Fecha", "Data.Valor"])
    docs = readers.read_json(spark, fixtures.series_documents(spark, sf_dir), narrow, multi_line=False,
                             timestamp_format=fixtures.MICROS_TS_FORMAT)
    rows = docs.select("COD", F.explode("Data").alias("Data")).select(
        "COD", F.col("Data.Fecha").alias("Fecha"), F.col("Data.Valor").alias("Valor"))
    # written once: documents are dearer to parse than the narrow rows are to read again
    rows = write_table(rows, "series_rows")
    # rows at one time are ordered by their values, so equal rows are interchangeable
    lagged = windows.lag_list(rows, ["COD"], ["Fecha", "Valor"], "Valor", 10, "laggedValues")
    return lagged.select("COD", _ntz("Fecha").alias("Fecha"), "Valor",
                         _cents_text("laggedValues").alias("laggedValues"))


@query("sequence_windows", """
WITH w AS (
  SELECT user_id, ts, event_id, value,
         list(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                           ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING) AS h
  FROM events)
SELECT user_id, ts, event_id,
       array_to_string(list_transform(h, lambda x: CAST(round(x * 100) AS BIGINT)), ',') AS history,
       value AS target
FROM w WHERE len(h) = 50""")
def sequence_windows(spark, sf_dir):
    """Fixed 50-step history -> next value, per user."""
    ev = fixtures.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    seq = windows.sequence_windows(ev, ["user_id"], ["ts", "event_id"], "value", 50)
    return seq.select("user_id", "ts", "event_id", _cents_text("history").alias("history"), "target")


# ----------------------------------------------------------- harmonic mean
def _hm_sql(v: str) -> str:
    inv = f"CASE WHEN {v} = 0 THEN 'inf'::DOUBLE ELSE 1.0 / {v} END"
    return (f"CASE WHEN count({v}) = 0 THEN 'nan'::DOUBLE WHEN sum({inv}) = 0 THEN 'inf'::DOUBLE "
            f"ELSE count({v}) / sum({inv}) END")


@query("harmonic_mean", f"SELECT round({_hm_sql('value')}, 6) AS val_harmonicmean FROM events")
def harmonic_mean(spark, sf_dir):
    """A4: ungrouped harmonic mean (one row)."""
    ev = fixtures.table(spark, sf_dir, "events")
    return harmonic(ev, "value").select(F.round("val_harmonicmean", 6).alias("val_harmonicmean"))


@query("harmonic_mean_grouped", f"""
SELECT user_id, round({_hm_sql('value')}, 6) AS val_harmonicmean FROM events GROUP BY user_id""")
def harmonic_mean_grouped(spark, sf_dir):
    """A5: harmonic mean per user."""
    ev = fixtures.table(spark, sf_dir, "events")
    return (harmonic(ev, "value", ["user_id"])
            .select("user_id", F.round("val_harmonicmean", 6).alias("val_harmonicmean")))


@query("udaf_two_phase", f"""
SELECT user_id, round({_hm_sql('value')}, 6) AS val_harmonicmean FROM events GROUP BY user_id""")
def udaf_two_phase(spark, sf_dir):
    """U1 + A6: a user-defined aggregator (zero, reduce, merge, finish): partial
    buffers per task, merged by key."""
    ev = fixtures.table(spark, sf_dir, "events")
    out = twophase.aggregate(ev, ["user_id"], "value", twophase.HARMONIC_MEAN, "hm")
    return out.select("user_id", F.round("hm", 6).alias("val_harmonicmean"))


@query("harmonic_mean_zero", f"""
SELECT user_id, count(*) FILTER (WHERE v = 0) AS zeros, round({_hm_sql('v')}, 6) AS val_harmonicmean
FROM (SELECT user_id, CAST(floor(value) AS BIGINT) AS v FROM events) GROUP BY user_id""")
def harmonic_mean_zero(spark, sf_dir):
    """Integer datapoints (floor of value) -- a zero makes the mean 0.0."""
    ev = fixtures.table(spark, sf_dir, "events").select("user_id", F.floor("value").alias("v"))
    return ev.groupBy("user_id").agg(
        F.count(F.when(F.col("v") == 0, 1)).alias("zeros"),
        F.round(harmonic_expr("v"), 6).alias("val_harmonicmean"))


# ------------------------------------------------------------ time windows
# 1e-9 lifts means that end in exactly half a unit (245.77 / 8) off the tie: the
# order of a sum then does not decide how they are rounded.
_STATS_SQL = """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       round(sum(value) + 1e-9, 4) AS sum_value, round(max(value) + 1e-9, 4) AS max_value,
       round(min(value) + 1e-9, 4) AS min_value, round(avg(value) + 1e-9, 4) AS avg_value,
       round(stddev_pop(value) + 1e-9, 4) AS stddev_value
FROM events GROUP BY 1, 2"""


def flat_stats(df: DataFrame) -> DataFrame:
    return df.select(_ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"),
                     *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in
                       ("sum_value", "max_value", "min_value", "avg_value", "stddev_value")])


@query("window_stats", _STATS_SQL)
def window_stats(spark, sf_dir):
    """A3: five statistics per 1-hour tumbling event-time window."""
    ev = fixtures.events_flat(spark, sf_dir)
    return flat_stats(timewindows.window_stats(ev, "ts", "value", "1 hour"))


# Lines of `documents` with their arrival clock (see fixtures.document_lines).
LINES_SQL = """
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
lines AS (
  SELECT doc_id, unnest(range(0, len(p))) AS line_no, unnest(p) AS line FROM parts),
arrivals AS (
  SELECT doc_id, line_no, line,
         epoch_us(TIMESTAMP '2024-01-01 00:00:00') + doc_id * 1000000 + line_no AS us
  FROM lines)
"""

CONCAT_SQL = LINES_SQL + """
, win AS (
  SELECT (us // 3000000) * 3000000 - j * 3000000 AS start_us, us, line
  FROM arrivals, range(0, 5) AS t(j))
SELECT make_timestamp(start_us) AS window_start, make_timestamp(start_us + 15000000) AS window_end,
       md5(string_agg(line, '' ORDER BY us)) AS text_md5,
       length(string_agg(line, '' ORDER BY us)) AS n_chars,
       count(*) AS n_lines
FROM win GROUP BY start_us"""


def flat_concat(df: DataFrame) -> DataFrame:
    return df.select(_ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"),
                     F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n_chars"),
                     F.col("n_lines"))


@query("concat_window", CONCAT_SQL)
def concat_window(spark, sf_dir):
    """A9 + T3 (batch): every line of a 15 s window, every 3 s, in arrival order."""
    lines = readers.read_json(spark, fixtures.landed_lines(spark, sf_dir), fixtures.LINES_SCHEMA, multi_line=False,
                              timestamp_format=fixtures.MICROS_TS_FORMAT)
    return flat_concat(timewindows.window_concat(lines, "arrival", "line", "15 seconds", "3 seconds", number="number"))


# ------------------------------------------------------------ SQL surfaces
@query("udaf_sql", f"""
SELECT user_id, round({_hm_sql('value')}, 6) AS harmonic_mean, count(*) AS n FROM events GROUP BY user_id""")
def udaf_sql(spark, sf_dir):
    """The harmonic mean called from SQL through registered functions."""
    udfs.register_all(spark)
    fixtures.table(spark, sf_dir, "events").createOrReplaceTempView("quarry_events")
    return spark.sql("""
        SELECT user_id, round(hm, 6) AS harmonic_mean, n FROM (
          SELECT user_id, hm_finish(count(value), sum(hm_inv(value))) AS hm, count(*) AS n
          FROM quarry_events GROUP BY user_id)""")


@query("scalar_udf", """
SELECT event_id, event_type, round(log10(1 + value), 6) AS log_magnitude FROM events""")
def scalar_udf(spark, sf_dir):
    """A scalar user function called from SQL."""
    udfs.register_all(spark)
    fixtures.table(spark, sf_dir, "events").createOrReplaceTempView("quarry_events")
    return spark.sql("""
        SELECT event_id, event_type, round(log_magnitude(value), 6) AS log_magnitude
        FROM quarry_events""")
