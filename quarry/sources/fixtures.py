"""Input documents derived from the test tables.

The analytics read nested JSON documents, CSV files and polled payloads; the
test tables are flat Parquet.  Each builder here turns a table into the input
format with Spark (so the work grows with the table), writes it once per
session under the shared scratch folder and returns the path.

Size rules that keep every document bounded at any scale:
* rows are spread over documents by a hash of the row id, never by a user or
  series key, so one hot user cannot make one huge document;
* the document count grows with the row count (``rows_per_doc``).
"""

from __future__ import annotations

import hashlib
import math
import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ordering import numbered
from quarry.session import shared_dir, write_table

ROWS_PER_EVENT_DOC = 100_000     # rows per multi-line document (one task each)
ROWS_PER_SERIES_DOC = 50_000     # rows per time-series document (JSON lines)
ROWS_PER_EVENT_FILE = 2_000_000  # rows of an event file that lands for a stream
MIN_DOCS = 8                     # keep some parallelism on tiny inputs
PAYLOAD_ROWS = 5                 # datapoints per polled payload
PAYLOADS_PER_FILE = 2000         # payloads per landed file (= one offset step, ~300 KB)
MICROS_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

_lock = threading.Lock()
_cache: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _cached(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    where = sf_dir if "://" in sf_dir else os.path.abspath(sf_dir)
    key = (spark.sparkContext.applicationId, where, kind)
    with _lock:
        if key in _cache:
            return _cache[key]
    # the whole path, not its last part, tells inputs apart
    place = f"{os.path.basename(os.path.normpath(sf_dir))}-{hashlib.sha256(key[1].encode()).hexdigest()[:12]}"
    path = shared_dir(spark, "fixtures", place, kind)
    build(path)
    with _lock:
        _cache[key] = path
    return path


def _doc_count(df: DataFrame, rows_per_doc: int, minimum: int = 1) -> int:
    # Parquet row counts come from footers; this is a metadata-only job.
    n = df.count()
    return max(minimum, math.ceil(n / rows_per_doc))


def events_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with a proper TIMESTAMP (session zone is UTC)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# --------------------------------------------------------------------------
# F-A1: nested event documents, one multi-line JSON document per file.
# user -> event id, event_type -> category, each row -> one geometry entry.
# An "error" row carries no magnitude (JSON null), which the analytics drop.
# --------------------------------------------------------------------------
def event_documents(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        ev = events_flat(spark, sf_dir)
        ndocs = _doc_count(ev, ROWS_PER_EVENT_DOC, MIN_DOCS)
        geometry = F.struct(
            F.array(F.col("user_id").cast("double"),
                    F.get_json_object("props", "$.k").cast("double")).alias("coordinates"),
            F.to_date("ts").alias("date"),
            F.lit("units").alias("magnitudeUnit"),
            F.when(F.col("event_type") != "error", F.col("value")).alias("magnitudeValue"),
            F.lit("Point").alias("type"),
        )
        per_event = (
            ev.select(F.pmod(F.xxhash64("event_id"), F.lit(ndocs)).alias("doc"),
                      "user_id", "event_type", "event_id", geometry.alias("g"))
            .groupBy("doc", "user_id", "event_type")
            .agg(F.sort_array(F.collect_list(F.struct("event_id", "g"))).alias("gs"))
            .select(
                "doc",
                F.struct(
                    F.array(F.struct(F.col("event_type").alias("id"),
                                     F.initcap("event_type").alias("title"))).alias("categories"),
                    F.lit(None).cast("string").alias("closed"),
                    F.concat(F.lit("events of user "), F.col("user_id").cast("string")).alias("description"),
                    F.transform("gs", lambda x: x["g"]).alias("geometry"),
                    F.col("user_id").cast("string").alias("id"),
                    F.concat(F.lit("https://example.org/users/"), F.col("user_id").cast("string")).alias("link"),
                    F.array(F.struct(F.lit("SRC").alias("id"),
                                     F.lit("https://example.org/src").alias("url"))).alias("sources"),
                    F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("title"),
                ).alias("event"),
            )
        )
        docs = (per_event.groupBy("doc")
                .agg(F.collect_list("event").alias("events"))
                .select(F.concat(F.lit("document "), F.col("doc").cast("string")).alias("description"),
                        "events", F.lit("https://example.org/events").alias("link"),
                        F.lit("events").alias("title")))
        (docs.write.mode("overwrite")
         .option("maxRecordsPerFile", 1)
         .option("dateFormat", "yyyy-MM-dd")
         .json(path))
    return _cached(spark, sf_dir, "event_docs", build)


# --------------------------------------------------------------------------
# F-A2: time-series documents (JSON lines).  One document per (series,
# fragment); a series is cut into fragments by a hash of the row id, so a
# document never holds more than about ROWS_PER_SERIES_DOC rows.
# --------------------------------------------------------------------------
def series_documents(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        ev = events_flat(spark, sf_dir)
        nfrag = _doc_count(ev, ROWS_PER_SERIES_DOC, 1)
        uid = F.col("user_id").cast("string")
        docs = (
            ev.select("user_id", F.pmod(F.xxhash64("event_id"), F.lit(nfrag)).alias("frag"),
                      F.struct("event_id", F.struct(
                          F.col("ts").alias("Fecha"),
                          F.col("event_type").alias("T3_TipoDato"),
                          F.date_format("ts", "yyyy-MM").alias("T3_Periodo"),
                          F.year("ts").cast("smallint").alias("Anyo"),
                          F.col("value").cast("float").alias("Valor"),
                      ).alias("d")).alias("row"))
            .groupBy("user_id", "frag")
            .agg(F.sort_array(F.collect_list("row")).alias("rows"))
            .select(
                uid.alias("COD"),
                F.concat(F.lit("user "), uid).alias("Nombre"),
                F.lit("units").alias("T3_Unidad"),
                F.lit(" ").alias("T3_Escala"),
                F.array(F.struct(
                    F.lit(1).alias("Id"),
                    F.struct(F.lit(1).alias("Id"), F.lit("user").alias("Nombre"),
                             F.lit("USR").alias("Codigo")).alias("Variable"),
                    uid.alias("Nombre"), uid.alias("Codigo"))).alias("MetaData"),
                F.transform("rows", lambda r: r["d"]).alias("Data"),
            )
        )
        docs.write.mode("overwrite").option("timestampFormat", MICROS_TS_FORMAT).json(path)
    return _cached(spark, sf_dir, "series_docs", build)


# --------------------------------------------------------------------------
# F-A8: events as JSON lines, of which some are flawed: in every 11th the value
# is no number, in every 13th the closing brace is missing.
# --------------------------------------------------------------------------
FLAWED_SCHEMA = "event_id BIGINT, user_id BIGINT, cents BIGINT"


def flawed_events(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        ev = table(spark, sf_dir, "events")
        cents = F.when(F.col("event_id") % 11 == 3, '"n/a"').otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string"))
        line = F.format_string('{"event_id":%d,"user_id":%d,"cents":%s', F.col("event_id").cast("bigint"),
                               F.col("user_id").cast("bigint"), cents)
        end = F.when(F.col("event_id") % 13 == 5, "").otherwise("}")
        ev.select(F.concat(line, end).alias("value")).write.mode("overwrite").text(path)
    return _cached(spark, sf_dir, "flawed_events", build)


# --------------------------------------------------------------------------
# F-A3: daily-prices CSV made from `part` (label p_retailprice).
# --------------------------------------------------------------------------
def prices_csv(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        part = table(spark, sf_dir, "part")
        out = part.select(
            F.date_add(F.lit("1990-01-01").cast("date"), F.col("p_partkey").cast("int")).alias("Date"),
            F.col("p_size").cast("float").alias("Open"),
            F.col("p_partkey").cast("float").alias("High"),
            F.length("p_name").cast("float").alias("Low"),
            F.col("p_retailprice").cast("float").alias("Close"),
            F.col("p_size").alias("Volume"),
            F.col("p_brand").alias("Name"),
        )
        out.write.mode("overwrite").option("header", True).option("sep", ",").csv(path)
    return _cached(spark, sf_dir, "prices_csv", build)


# --------------------------------------------------------------------------
# F-A4: satellite telemetry CSV made from `events`.
# --------------------------------------------------------------------------
def telemetry_csv(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        ev = events_flat(spark, sf_dir)
        out = ev.select(
            F.concat(F.lit("evt"), F.col("event_id").cast("string")).alias("Name"),
            F.unix_timestamp("ts").cast("int").alias("Timestamp"),
            F.col("value").cast("float").alias("FloatValue"),
            F.get_json_object("props", "$.k").cast("int").alias("IntegerValue"),
            F.col("event_type").alias("Parameter"),
            F.concat(F.lit("sat"), F.col("user_id").cast("string")).alias("Satellite"),
            F.concat(F.lit("reading of "), F.col("event_type")).alias("ShortDesc"),
            F.lit("units").alias("Units"),
        )
        out.write.mode("overwrite").option("header", True).option("sep", ",").csv(path)
    return _cached(spark, sf_dir, "telemetry_csv", build)


# --------------------------------------------------------------------------
# F-A5: polled payloads landed as files.  Payload n holds the events with
# event_id in [5n, 5n+5) (ids are dense and rise with time), newest first,
# value in integer cents.  Files hold PAYLOADS_PER_FILE payloads each and are
# numbered; a stream offset is a file number.
# --------------------------------------------------------------------------
def landed_payloads(spark: SparkSession, sf_dir: str) -> str:
    from quarry.sources.poll import payload_body, write_landed

    def build(path: str) -> None:
        ev = events_flat(spark, sf_dir)
        rows = ev.select(
            F.floor(F.col("event_id") / PAYLOAD_ROWS).alias("payload"),
            "event_id",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts_text"),
            F.round(F.col("value") * 100).cast("bigint").alias("v"),
        )
        payloads = (rows.groupBy("payload")
                    .agg((F.min("event_id") + 1).alias("first_index"),
                         payload_body(F.collect_list(F.struct("event_id", "ts_text", "v"))).alias("body")))
        write_landed(payloads, path, PAYLOADS_PER_FILE)
    return _cached(spark, sf_dir, "payloads", build)


# --------------------------------------------------------------------------
# F-A7: the events as files that land one after the other.  The first half of
# the time comes first, then the second half in two files, and last the late
# tenth of the first half, which was held back.
# --------------------------------------------------------------------------
def event_halves(spark: SparkSession, sf_dir: str) -> int:
    """The middle of the events' time, in microseconds, cut to the hour."""
    low, high = events_flat(spark, sf_dir).agg(
        F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    return ((low or 0) + (high or 0)) // 2 // 3_600_000_000 * 3_600_000_000


def event_files(spark: SparkSession, sf_dir: str) -> int:
    """Files of each slice of ``landed_events``."""
    return _doc_count(table(spark, sf_dir, "events"), ROWS_PER_EVENT_FILE)


def landed_events(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        files = event_files(spark, sf_dir)
        cut = F.timestamp_micros(F.lit(event_halves(spark, sf_dir)))
        ev = events_flat(spark, sf_dir)
        early, tenth, even = F.col("ts") < cut, F.col("event_id") % 10 == 0, F.col("event_id") % 2 == 0
        slices = (early & ~tenth, ~early & even, ~early & ~even, early & tenth)
        for n, part in enumerate(slices):
            # appended one by one: the file source takes files by the time they appeared
            ev.where(part).withColumn("slice", F.lit(n)).repartition(files).write.mode("append").partitionBy("slice").parquet(path)
    return _cached(spark, sf_dir, "landed_events", build)


# --------------------------------------------------------------------------
# F-A6: text lines with an arrival clock.  Every line of every document is
# one arrival; document d, line i arrives at 2024-01-01 + d seconds + i microseconds.
# --------------------------------------------------------------------------
TEXT_EPOCH = "2024-01-01 00:00:00"


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    arrival = (F.lit(TEXT_EPOCH).cast("timestamp")
               + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                    F.col("doc_id").cast("decimal(18,6)")
                                    + F.col("line_no").cast("decimal(18,6)") / 1000000))
    return lines.select("doc_id", "line_no", arrival.alias("arrival"), "line")


LINES_SCHEMA = "doc_id BIGINT, line_no INT, arrival TIMESTAMP, line STRING, number BIGINT, slice INT, file INT"
#: Lines of a slice that lands at once, its files, and the least number of slices.
LINES_PER_SLICE, SLICE_FILES, LEAST_SLICES = 4_000_000, 16, 4


def landed_lines(spark: SparkSession, sf_dir: str) -> str:
    """The lines in the order in which they arrived, numbered, in slices that
    landed one after the other.  Every slice has ``SLICE_FILES`` files (the last
    may have fewer), so a stream that takes so many files takes a slice."""
    def build(path: str) -> None:
        lines = document_lines(spark, sf_dir)
        lines = write_table(numbered(lines, [F.col(c).asc_nulls_first() for c in ("arrival", "doc_id", "line_no")]),
                            "numbered_lines")
        rows = lines.count()
        size = max(SLICE_FILES, min(LINES_PER_SLICE, math.ceil(rows / LEAST_SLICES)))
        for n in range(max(1, math.ceil(rows / size))):
            part = lines.where((F.col("number") >= n * size) & (F.col("number") < (n + 1) * size))
            # appended one by one: the file source takes files by the time they appeared
            (part.withColumn("slice", F.lit(n)).withColumn("file", (F.col("number") % SLICE_FILES).cast("int"))
             .repartition(SLICE_FILES, "file").write.mode("append").partitionBy("slice", "file")
             .option("timestampFormat", MICROS_TS_FORMAT).option("compression", "gzip").json(path))
    return _cached(spark, sf_dir, "lines", build)
