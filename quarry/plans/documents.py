"""Queries over nested documents and CSV (S1-S6, P, F, E, A1-A2, O).

The nested event documents are derived from ``events`` (see
``quarry.sources.fixtures``): user -> event id, event_type -> category,
each row -> one geometry entry, and "error" rows carry no magnitude.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import nested, ordering
from quarry.operators.aggregates import group_average
from quarry.plans.registry import query
from quarry.sources import fixtures, readers, schemas, splitjson

# The flat form of the documents' measurements, for the oracle.
_MEAS = """
WITH meas AS (
  SELECT CAST(user_id AS VARCHAR) AS event, event_type AS category_ids,
         CAST(ts AS DATE) AS date,
         CASE WHEN event_type <> 'error' THEN value END AS magnitudeValue
  FROM events)
"""
_MEAS_KEPT = _MEAS + ", kept AS (SELECT * FROM meas WHERE magnitudeValue IS NOT NULL AND NOT isnan(magnitudeValue))\n"


#: Bytes of a block of a document.
SPLIT_BYTES = 16 << 20

# The four leaves the measurement analytics use.
MEASUREMENT_FIELDS = ["events.id", "events.categories.id",
                      "events.geometry.date", "events.geometry.magnitudeValue"]


def event_docs(spark: SparkSession, sf_dir: str, form: str = "structtype",
               multi_line: bool = False) -> DataFrame:
    """The derived documents.  Each is written on one line, so analytics read
    them as JSON Lines; the scan queries (S1-S4) use the whole-file reader."""
    return readers.read_event_docs(spark, fixtures.event_documents(spark, sf_dir), form,
                                   multi_line=multi_line)


def measurement_docs(spark: SparkSession, sf_dir: str, fields: list[str] | None = None) -> DataFrame:
    """The documents read with only the given leaves (narrow schema);
    default: the measurement leaves."""
    return readers.read_json(spark, fixtures.event_documents(spark, sf_dir),
                             schemas.prune(schemas.EVENT_DOC_SCHEMA, fields or MEASUREMENT_FIELDS),
                             multi_line=False)


def _id_date_value(rows: DataFrame, value_type: str = "double") -> DataFrame:
    return rows.select(F.col("event.id").alias("event"),
                       F.col("geometry.date").cast("date").alias("date"),
                       F.col("geometry.magnitudeValue").cast(value_type).alias("magnitudeValue"))


_ID_DATE_VALUE_SQL = _MEAS + "SELECT event, date, magnitudeValue FROM meas"


@query("json_infer", _ID_DATE_VALUE_SQL)
def json_infer(spark, sf_dir):
    """Schema inferred (date arrives as text and is cast)."""
    return _id_date_value(nested.explode_nested(event_docs(spark, sf_dir, "infer", multi_line=True)))


@query("json_structtype", _ID_DATE_VALUE_SQL)
def json_structtype(spark, sf_dir):
    """Nested StructType declared in code."""
    return _id_date_value(nested.explode_nested(event_docs(spark, sf_dir, "structtype", multi_line=True)))


@query("json_split_scan", _ID_DATE_VALUE_SQL)
def json_split_scan(spark, sf_dir):
    """The same documents in blocks, so that one document is read by
    many tasks; events are the elements of its array."""
    element = schemas.EVENT_DOC_SCHEMA["events"].dataType.elementType
    events = splitjson.read_array(spark, fixtures.event_documents(spark, sf_dir), "events", element, SPLIT_BYTES)
    return _id_date_value(events.select(F.col("events").alias("event"), F.explode("events.geometry").alias("geometry")))


_FLAWED_SQL = """
WITH l AS (SELECT event_id, user_id, CAST(round(value * 100) AS BIGINT) AS cents,
                  event_id % 11 = 3 AS bad, event_id % 13 = 5 AS broken FROM events),
r AS (SELECT *, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"cents":'
                || CASE WHEN bad THEN '"n/a"' ELSE CAST(cents AS VARCHAR) END || CASE WHEN broken THEN '' ELSE '}' END AS raw,
             CASE WHEN broken THEN 'broken' WHEN bad THEN 'bad_field' ELSE 'good' END AS kind FROM l)
"""


def _flawed(spark: SparkSession, sf_dir: str) -> readers.Checked:
    return readers.read_json_checked(spark, fixtures.flawed_events(spark, sf_dir), fixtures.FLAWED_SCHEMA)


@query("json_corrupt_records", _FLAWED_SQL + """
SELECT kind, CASE WHEN NOT broken THEN event_id END AS event_id, CASE WHEN NOT broken THEN user_id END AS user_id,
       CASE WHEN kind = 'good' THEN cents END AS cents, CASE WHEN kind <> 'good' THEN raw END AS raw FROM r""")
def json_corrupt_records(spark, sf_dir):
    """A permissive read: a row survives a bad field, a broken record
    is kept as text."""
    return _flawed(spark, sf_dir).table.select(
        F.col("_kind").alias("kind"), "event_id", "user_id", "cents", F.col(readers.CORRUPT).alias("raw"))


@query("json_reject_counts", _FLAWED_SQL + "SELECT kind, count(*) AS n FROM r GROUP BY kind")
def json_reject_counts(spark, sf_dir):
    """How many records are good, have a bad field, or are broken."""
    return _flawed(spark, sf_dir).counts()


@query("json_ddl", _ID_DATE_VALUE_SQL)
def json_ddl(spark, sf_dir):
    """S3: schema as DDL text."""
    return _id_date_value(nested.explode_nested(event_docs(spark, sf_dir, "ddl", multi_line=True)))


@query("json_dataclass", _MEAS + """
SELECT event, date, CAST(CAST(magnitudeValue AS FLOAT) AS DOUBLE) AS magnitudeValue FROM meas""")
def json_dataclass(spark, sf_dir):
    """Schema derived from classes (FLOAT magnitude, numeric coordinates)."""
    rows = nested.explode_nested(event_docs(spark, sf_dir, "dataclass", multi_line=True))
    return _id_date_value(rows)


@query("json_series", """
SELECT CAST(user_id AS VARCHAR) AS COD, 'user ' || CAST(user_id AS VARCHAR) AS Nombre,
       CAST(user_id AS VARCHAR) AS meta_codigo, ts AS Fecha, event_type AS T3_TipoDato,
       CAST(year(ts) AS SMALLINT) AS Anyo, CAST(value AS FLOAT) AS Valor
FROM events""")
def json_series(spark, sf_dir):
    """S5 + P5: time-series documents; metadata repeated beside each point."""
    docs = readers.read_series_docs(spark, fixtures.series_documents(spark, sf_dir),
                                    timestamp_format=fixtures.MICROS_TS_FORMAT)
    rows = docs.select("COD", "Nombre", "T3_Unidad", "T3_Escala", "MetaData",
                       F.explode("Data").alias("Data"))
    return rows.select("COD", "Nombre",
                       F.col("MetaData").getItem(0).getField("Codigo").alias("meta_codigo"),
                       F.col("Data.Fecha").cast("timestamp_ntz").alias("Fecha"),
                       F.col("Data.T3_TipoDato").alias("T3_TipoDato"),
                       F.col("Data.Anyo").alias("Anyo"),
                       F.col("Data.Valor").alias("Valor"))


_PRICES_SQL = """
SELECT DATE '1990-01-01' + CAST(p_partkey AS INTEGER) AS Date, CAST(p_size AS FLOAT) AS Open,
       CAST(p_partkey AS FLOAT) AS High, CAST(length(p_name) AS FLOAT) AS Low,
       CAST(p_retailprice AS FLOAT) AS Close, p_size AS Volume, p_brand AS Name
FROM part"""


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_csv(spark, fixtures.prices_csv(spark, sf_dir), schemas.PRICES_CSV_SCHEMA)


@query("csv_scan", _PRICES_SQL)
def csv_scan(spark, sf_dir):
    """CSV with header, separator and a fixed schema."""
    return prices(spark, sf_dir)


@query("sort_asc", _PRICES_SQL + " ORDER BY Date")
def sort_asc(spark, sf_dir):
    """O2: ascending sort by date (range exchange + local sort)."""
    return ordering.sort_asc(prices(spark, sf_dir), "Date")


@query("project_alias", _MEAS + """
SELECT event AS event_id, date AS day, 'Point' AS kind, 'units' AS unit FROM meas""")
def project_alias(spark, sf_dir):
    """Select with renames and struct paths."""
    rows = nested.explode_nested(measurement_docs(spark, sf_dir, [
        "events.id", "events.geometry.date", "events.geometry.type", "events.geometry.magnitudeUnit"]))
    return nested.project(rows, {"event_id": "event.id", "day": "geometry.date",
                                 "kind": "geometry.type", "unit": "geometry.magnitudeUnit"})


@query("array_field_project", """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS event, event_type AS category_ids,
       upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS category_titles
FROM events""")
def array_field_project(spark, sf_dir):
    """A field through an array of structs gives an array of that field."""
    ev = nested.explode_events(measurement_docs(spark, sf_dir, ["events.id", "events.categories"]))
    return ev.select(
        F.col("event.id").alias("event"),
        F.array_join(nested.field_through_array("event.categories", "id"), "|").alias("category_ids"),
        F.array_join(nested.field_through_array("event.categories", "title"), "|").alias("category_titles"),
    ).distinct()


@query("na_drop", _MEAS_KEPT + "SELECT event, date, magnitudeValue FROM kept")
def na_drop(spark, sf_dir):
    """rows with a null (or NaN) magnitude are dropped."""
    rows = _id_date_value(nested.explode_nested(measurement_docs(spark, sf_dir)))
    return nested.na_drop(rows, ["magnitudeValue"])


@query("explode_array", """
SELECT CAST(user_id AS VARCHAR) AS event, count(*) AS n_geometry FROM events GROUP BY user_id""")
def explode_array(spark, sf_dir):
    """One row per array element; geometry entries counted per event."""
    ev = nested.explode_events(measurement_docs(spark, sf_dir, ["events.id", "events.geometry.date"]))
    return (ev.groupBy(F.col("event.id").alias("event"))
            .agg(F.sum(F.size("event.geometry")).alias("n_geometry")))


@query("explode_nested", _MEAS + """
SELECT event, category_ids, date, magnitudeValue FROM meas""")
def explode_nested(spark, sf_dir):
    """Events, then each event's geometry."""
    rows = nested.explode_nested(measurement_docs(spark, sf_dir))
    return rows.select(F.col("event.id").alias("event"),
                       F.array_join("event.categories.id", "|").alias("category_ids"),
                       F.col("geometry.date").alias("date"),
                       F.col("geometry.magnitudeValue").alias("magnitudeValue"))


def grouped_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: average magnitude per (event, category ids, date) -- the flagship."""
    meas = nested.event_measurements(measurement_docs(spark, sf_dir))
    g = group_average(meas, ["event", F.col("category.id"), "date"], "magnitudeValue", "avg_magnitude")
    return g.select("event", F.array_join("id", "|").alias("category_ids"), "date",
                    F.round("avg_magnitude", 4).alias("avg_magnitude"))


_GROUP_AVG_SQL = _MEAS_KEPT + """
, g AS (SELECT event, category_ids, date, round(avg(magnitudeValue), 4) AS avg_magnitude
        FROM kept GROUP BY event, category_ids, date)
"""


@query("group_avg", _GROUP_AVG_SQL + "SELECT * FROM g")
def group_avg(spark, sf_dir):
    return grouped_average(spark, sf_dir)


@query("sort_desc_topk", _GROUP_AVG_SQL +
       "SELECT * FROM g ORDER BY date DESC NULLS LAST, event, category_ids LIMIT 100")
def sort_desc_topk(spark, sf_dir):
    """O1 + O3: the flagship's 100 latest groups (a top-k, not a full sort)."""
    return ordering.top_k(grouped_average(spark, sf_dir), 100,
                          [F.col("date").desc_nulls_last(), F.col("event"), F.col("category_ids")])


@query("group_array_key", _MEAS_KEPT + """
SELECT category_ids, round(avg(magnitudeValue), 4) AS avg_magnitude, count(*) AS n
FROM kept GROUP BY category_ids""")
def group_array_key(spark, sf_dir):
    """A2: an array column as the grouping key."""
    meas = nested.event_measurements(measurement_docs(spark, sf_dir))
    g = meas.groupBy(F.col("category.id").alias("ids")).agg(
        F.avg("magnitudeValue").alias("avg_magnitude"), F.count(F.lit(1)).alias("n"))
    return g.select(F.array_join("ids", "|").alias("category_ids"),
                    F.round("avg_magnitude", 4).alias("avg_magnitude"), "n")


@query("limit_rows", """
SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 20""")
def limit_rows(spark, sf_dir):
    """First rows; ordered so that the result is defined."""
    ev = fixtures.table(spark, sf_dir, "events").select("event_id", "ts")
    return ordering.first_rows(ev, 20, [F.col("ts"), F.col("event_id")])
