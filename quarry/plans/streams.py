"""Streaming queries.

Each query runs a Structured Streaming job with the available-now trigger
over inputs derived from the test tables, writes to a durable sink and
returns the sink's table; the oracle is the equivalent batch SQL.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import harmonic as hm
from quarry.operators import nested, timewindows, twophase
from quarry.plans.analytics import CONCAT_SQL, LINES_SQL, _STATS_SQL, _hm_sql, flat_concat, flat_stats
from quarry.plans.registry import query
from quarry.session import list_names
from quarry.sources import fixtures, poll
from quarry.streaming import events as sev
from quarry.streaming import late, runner, sinks, supervise


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner.file_stream(spark, sf_dir, "events.parquet")


def landed_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in four slices that landed one after the other; a batch each."""
    path = fixtures.landed_events(spark, sf_dir)
    return runner.file_stream(spark, path, None, schema=spark.read.parquet(path).schema,
                              max_files_per_trigger=fixtures.event_files(spark, sf_dir))


#: Landed files that a micro-batch takes at most, and the batches that small inputs are cut into.
FILES_PER_BATCH, LEAST_BATCHES = 64, 4


def files_per_batch(files: int) -> int:
    """Files of a micro-batch: several batches on small inputs, and batches of
    bounded size, not a few files each, on large ones."""
    return max(1, min(FILES_PER_BATCH, files // LEAST_BATCHES))


def _landed(spark: SparkSession, path: str) -> list[str]:
    return [n for n in list_names(spark, path) if n.startswith("file_no=")]


def lines_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text lines in the order of arrival, a landed slice to a batch."""
    return runner.file_stream(spark, fixtures.landed_lines(spark, sf_dir), None, "json", fixtures.LINES_SCHEMA,
                              fixtures.SLICE_FILES, timestampFormat=fixtures.MICROS_TS_FORMAT)


# -------------------------------------------------------- windowed streams
@query("stream_tumbling", _STATS_SQL)
def stream_tumbling(spark, sf_dir):
    """T2 + T5 + T8: hourly window statistics, complete output mode."""
    runner.use_rocksdb_state(spark)
    agg = sev.windowed_stats(events_stream(spark, sf_dir), "ts", "value", "1 hour", "2 minutes")
    return flat_stats(runner.run(agg, "tumbling_complete", "complete").table())


@query("stream_tumbling_append", f"""
SELECT * FROM ({_STATS_SQL})
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE""")
def stream_tumbling_append(spark, sf_dir):
    """T1 + T9: append mode emits only windows closed by the watermark."""
    runner.use_rocksdb_state(spark)
    agg = sev.windowed_stats(events_stream(spark, sf_dir), "ts", "value", "1 hour", "2 minutes")
    return flat_stats(runner.run(agg, "tumbling_append", "append").table())


@query("stream_tumbling_update", _STATS_SQL)
def stream_tumbling_update(spark, sf_dir):
    """Update mode over several batches; the newest row of every window."""
    runner.use_rocksdb_state(spark)
    # nothing is late without a watermark
    agg = sev.windowed_stats(landed_event_stream(spark, sf_dir), "ts", "value", "1 hour", None)
    return flat_stats(runner.run(agg, "tumbling_update", "update", keys=["window"]).table())


@query("stream_late_rows", f"""
WITH half AS (SELECT (epoch_us(min(ts)) + epoch_us(max(ts))) // 2 // 3600000000 * 3600000000 AS us FROM events),
kept AS (SELECT e.* FROM events e, half WHERE NOT (epoch_us(ts) < us AND event_id % 10 = 0))
{_STATS_SQL.replace("FROM events", "FROM kept")}""")
def stream_late_rows(spark, sf_dir):
    """Rows older than the watermark are dropped (update mode): the last
    file holds a tenth of the first half of the time, after the second half."""
    runner.use_rocksdb_state(spark)
    agg = sev.windowed_stats(landed_event_stream(spark, sf_dir), "ts", "value", "1 hour", "2 minutes")
    return flat_stats(runner.run(agg, "late_rows", "update", keys=["window"]).table())


@query("stream_late_table", f"""
WITH half AS (SELECT (epoch_us(min(ts)) + epoch_us(max(ts))) // 2 // 3600000000 * 3600000000 AS us FROM events)
SELECT event_id, user_id, ts, value, epoch_us(ts) < us AND event_id % 10 = 0 AS late FROM events, half""")
def stream_late_table(spark, sf_dir):
    """The rows that the watermark would drop, as a table beside the kept ones."""
    found = late.divide(landed_event_stream(spark, sf_dir), "late_table", "ts", "1 hour", "2 minutes")
    both = (found.kept().withColumn("late", F.lit(False)).unionByName(found.late().withColumn("late", F.lit(True))))
    return both.select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value", "late")


# ----------------------------------------------------------- polled source
_DATAPOINTS_SQL = """
WITH p AS (
  SELECT event_id, ts, value, event_id // 5 AS payload,
         max(event_id) OVER (PARTITION BY event_id // 5) AS last_id
  FROM events)
SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS timestamp,
       CAST(round(value * 100) AS BIGINT) AS value,
       payload * 5 + 1 + (last_id - event_id) AS index
FROM p"""


def _datapoints_out(df: DataFrame) -> DataFrame:
    return df.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "value", "index")


@query("poll_source_stream", _DATAPOINTS_SQL)
def poll_source_stream(spark, sf_dir):
    """S7 + S10: the landed payloads as a stream, append to Parquet."""
    stream = poll.datapoint_file_stream(spark, fixtures.landed_payloads(spark, sf_dir), FILES_PER_BATCH)
    return _datapoints_out(runner.run(stream, "poll_source", "append").table())


#: Landed files per step of the source that numbers its offsets.
FILES_PER_STEP = 2


@query("poll_offset_log", _DATAPOINTS_SQL)
def poll_offset_log(spark, sf_dir):
    """The same payloads by file number, in steps that the offset log bounds."""
    path = fixtures.landed_payloads(spark, sf_dir)
    consumer = uuid.uuid4().hex

    def build(_):
        return poll.datapoint_stream(spark, path, startFile=0, maxFilesPerTrigger=FILES_PER_STEP, consumer=consumer)

    return _datapoints_out(supervise.run_until_drained(spark, build, "offset_log")[0].table())


@query("supervised_stream", _DATAPOINTS_SQL)
def supervised_stream(spark, sf_dir):
    """S10 + T4: a processing-time run that fails in its first attempt, resumes
    from its checkpoint and ends when the input is drained."""
    path = fixtures.landed_payloads(spark, sf_dir)
    files = len(_landed(spark, path))

    def build(attempt):
        points = poll.datapoint_file_stream(spark, path, max(1, files // 3))
        if attempt:
            return points
        # the injected failure: one payload in the middle of the numbers
        middle = files // 2 * fixtures.PAYLOADS_PER_FILE * fixtures.PAYLOAD_ROWS + 1
        failing = F.when(F.col("index") == middle, F.raise_error(F.lit("injected failure")).cast("bigint")).otherwise(F.col("index"))
        return points.withColumn("index", failing)

    result, failures = supervise.run_until_drained(spark, build, "supervised")
    if failures != 1:
        raise RuntimeError(f"the injected failure was met {failures} times")
    return _datapoints_out(result.table())


@query("payload_decode", _DATAPOINTS_SQL)
def payload_decode(spark, sf_dir):
    """Payload wire text -> (timestamp, value, index), batch."""
    landed = spark.read.schema(poll.LANDED_SCHEMA).json(fixtures.landed_payloads(spark, sf_dir))
    return _datapoints_out(poll.decode_payloads(landed))


@query("offset_range", f"""
WITH d AS ({_DATAPOINTS_SQL}), b AS (SELECT max(index) AS n FROM d)
SELECT d.* FROM d, b WHERE d.index > b.n // 4 AND d.index <= (3 * b.n) // 4""")
def offset_range(spark, sf_dir):
    """rows of the offset range (n/4, 3n/4] of the landed datapoints."""
    path = fixtures.landed_payloads(spark, sf_dir)
    landed = poll.landed_files(spark, path)
    numbers = [int(n.split("=")[1]) for n in _landed(spark, path)]
    last = poll.decode_payloads(landed.where(F.col("file_no") == max(numbers, default=-1)))
    n = last.agg(F.max("index")).first()[0] or 0              # the newest file holds the last index
    per_file = fixtures.PAYLOAD_ROWS * fixtures.PAYLOADS_PER_FILE
    inside = landed.where(F.col("file_no").between(n // 4 // per_file, (3 * n) // 4 // per_file))
    return _datapoints_out(nested.offset_range(poll.decode_payloads(inside), "index", n // 4, (3 * n) // 4))


_HM_CENTS_SQL = f"""
SELECT round({_hm_sql('v')}, 6) AS val_harmonicmean
FROM (SELECT CAST(round(value * 100) AS BIGINT) AS v FROM events)"""


@query("stream_harmonic_mean", _HM_CENTS_SQL)
def stream_harmonic_mean(spark, sf_dir):
    """T6 + U2: global harmonic mean of the datapoint stream, complete mode."""
    stream = sev.with_event_time(poll.datapoint_file_stream(
        spark, fixtures.landed_payloads(spark, sf_dir), FILES_PER_BATCH), "timestamp", "2 minutes")
    agg = stream.agg(hm.harmonic_mean("value").alias("val_harmonicmean"))
    out = runner.run(agg, "harmonic_stream", "complete").table()
    return out.select(F.round("val_harmonicmean", 6).alias("val_harmonicmean"))


@query("stream_sql_view", _HM_CENTS_SQL)
def stream_sql_view(spark, sf_dir):
    """T7 + K3: SQL over a temp view of the stream, with the SQL functions."""
    hm.register_sql(spark)
    stream = sev.with_event_time(poll.datapoint_file_stream(
        spark, fixtures.landed_payloads(spark, sf_dir), FILES_PER_BATCH), "timestamp", "2 minutes")
    stream.createOrReplaceTempView("timeseries")
    agg = spark.sql("SELECT hm_finish(count(value), sum(hm_inv(value))) AS val_harmonicmean FROM timeseries")
    out = runner.run(agg, "sql_view_stream", "complete").table()
    return out.select(F.round("val_harmonicmean", 6).alias("val_harmonicmean"))


@query("stream_udaf_state", _HM_CENTS_SQL)
def stream_udaf_state(spark, sf_dir):
    """T6 + U2: the user-defined aggregator on the stream: partial buffers in
    each micro-batch, merged into keyed state; the newest result."""
    runner.use_rocksdb_state(spark)
    path = fixtures.landed_payloads(spark, sf_dir)
    points = poll.datapoint_file_stream(spark, path, files_per_batch(len(_landed(spark, path))))
    agg = twophase.aggregate_stream(points.withColumn("all", F.lit(1)), ["all"], "value",
                                    twophase.HARMONIC_MEAN, "val_harmonicmean")
    out = runner.run(agg, "udaf_state", "update", keys=["all"], state_partitions=1).table()
    return out.select(F.round("val_harmonicmean", 6).alias("val_harmonicmean"))


# ------------------------------------------------------------- text stream
@query("text_stream", LINES_SQL + """
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, make_timestamp(us) AS arrival, line FROM arrivals""")
def text_stream(spark, sf_dir):
    """Every text line as one arrival, streamed to Parquet."""
    out = runner.run(lines_stream(spark, sf_dir), "text_stream", "append").table()
    return out.select("doc_id", "line_no", F.col("arrival").cast("timestamp_ntz").alias("arrival"), "line")


def _panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3 s panes of the line stream, in chunks of numbered lines: the state
    holds every line once, and a hot pane is many values.  Lines land in the
    order of arrival, so bounded batches make none late."""
    lines = sev.with_event_time(lines_stream(spark, sf_dir), "arrival", "15 seconds")
    return timewindows.panes(lines, "arrival", "line", "3 seconds", number="number")


@query("stream_sliding", CONCAT_SQL)
def stream_sliding(spark, sf_dir):
    """T3 + T4 + A9: 15 s windows every 3 s over arrival time: panes are
    written in update mode and joined when read back."""
    runner.use_rocksdb_state(spark)
    pieces = runner.run(_panes(spark, sf_dir), "sliding", "update", keys=["pane", "chunk"]).table()
    return flat_concat(timewindows.join_panes(pieces, "15 seconds", "3 seconds"))


@query("stream_text_sink", CONCAT_SQL)
def stream_text_sink(spark, sf_dir):
    """K2 + S11: pane texts written as text files, one folder per batch,
    plus a Parquet copy of the same batch (persisted once, written twice).

    Each text line is ``start<TAB>end<TAB>chunk<TAB>n_lines<TAB>text``; a chunk
    updated in several batches is read back from its newest batch.
    """
    runner.use_rocksdb_state(spark)
    run_dir = runner.shared_dir(spark, "streams", f"text-sink-{uuid.uuid4().hex[:8]}")
    base, copy = os.path.join(run_dir, "text"), os.path.join(run_dir, "parquet")
    line = F.concat_ws("\t", F.date_format("pane.start", "yyyy-MM-dd HH:mm:ss"),
                       F.date_format("pane.end", "yyyy-MM-dd HH:mm:ss"),
                       F.col("chunk").cast("string"), F.col("n_lines").cast("string"), "piece")
    writer = sinks.fan_out(sinks.text_batches(base, line), sinks.parquet_batches(copy))
    runner.finish(_panes(spark, sf_dir).writeStream.outputMode("update")
                  .option("checkpointLocation", os.path.join(run_dir, "checkpoint"))
                  .foreachBatch(writer).trigger(availableNow=True).start())
    raw = spark.read.option("basePath", base).option("lineSep", "\n").text(base)
    parts = F.split("value", "\t", 5)
    rows = raw.select("batch", F.struct(F.to_timestamp(parts[0]).alias("start"),
                                        F.to_timestamp(parts[1]).alias("end")).alias("pane"),
                      parts[2].cast("long").alias("chunk"), parts[3].cast("long").alias("n_lines"), parts[4].alias("piece"))
    latest = runner.newest_rows(rows, ["pane", "chunk"], "batch")
    return flat_concat(timewindows.join_panes(latest, "15 seconds", "3 seconds"))
