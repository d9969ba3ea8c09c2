"""Run a streaming query to a durable table and read the result back.

A run writes below one *location*: ``out`` (the table) and ``checkpoint``.
The caller gives the location of a query that is to be resumed; a run with the
same location goes on exactly where the last one stopped.  Without one, a run
gets a fresh folder under the shared scratch folder.

* ``append``   -> Parquet file sink (exactly-once via the sink's log);
* ``complete`` -> ``foreachBatch`` writing the whole result to
  ``batch_id=<n>`` (overwrite by batch id = idempotent on retry); the result
  is the newest complete batch folder;
* ``update``   -> ``foreachBatch`` writing the changed rows to
  ``batch_id=<n>``; the result keeps, per key, the row of the newest batch.
  Every ``COMPACT_EVERY`` batches the newest rows are written to
  ``snapshot_id=<n>``, so reading back never goes through all batches.

What has been written is found by listing the folders (a folder counts once it
holds its ``_SUCCESS`` file), never from the memory of the process that wrote.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.session import is_folder, list_names, shared_dir, write_table

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COMPACT_EVERY = 20
#: Replaced rows whose keys are broadcast at most.
FEW_REPLACED = 100_000


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep large keyed state off the JVM heap (set before a query starts)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if not current or "HDFSBackedStateStoreProvider" in current:
        spark.conf.set(key, ROCKSDB)


def _written(spark: SparkSession, out: str, kind: str) -> list[int]:
    """Numbers of the complete folders ``<kind>=<n>``, ascending."""
    found = [int(n[len(kind) + 1:]) for n in list_names(spark, out) if n.startswith(f"{kind}=")]
    return sorted(n for n in found if "_SUCCESS" in list_names(spark, f"{out}/{kind}={n}"))


def newest_rows(rows: DataFrame, keys: list[str], batch: str, few: int = FEW_REPLACED) -> DataFrame:
    """Per key, the row with the highest ``batch``, without that column.

    Only keys and numbers are exchanged to find the rows that a later batch has
    replaced.  Where those are few, the rest is read as it lies; else, or if a
    batch has several rows of a key, the rows themselves are grouped."""
    others = [c for c in rows.columns if c not in (*keys, batch)]
    held = rows.groupBy(*keys, batch).agg(F.count("*").alias("_n")).groupBy(*keys).agg(
        F.max("_n").alias("_n"), F.max(batch).alias("_last"), F.collect_list(batch).alias("_all"))
    old = F.explode(F.when(F.col("_n") > 1, F.col("_all")).otherwise(
        F.filter("_all", lambda b: b < F.col("_last")))).alias("_old")
    replaced = write_table(held.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_n", old), "replaced")
    found = replaced.agg(F.count("*"), F.max("_n")).first()
    if found[0] > few or (found[1] or 0) > 1:
        latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), batch).alias("_r"))
        return latest.select(*keys, "_r.*")
    if found[0]:
        same = F.col(batch) == F.col("_old")
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        rows = rows.join(F.broadcast(replaced), same, "left_anti")
    return rows.select(*keys, *others)


def _newest(spark: SparkSession, out: str, keys: list[str], upto: int | None = None) -> DataFrame:
    """Per key, the row of the newest batch (up to ``upto``): the last
    snapshot and the batches after it."""
    def known(kind: str) -> list[int]:
        return [n for n in _written(spark, out, kind) if upto is None or n <= upto]

    base = max(known("snapshot_id"), default=-1)
    parts = [(n, f"{out}/batch_id={n}") for n in known("batch_id") if n > base]
    if base >= 0:
        parts.insert(0, (base, f"{out}/snapshot_id={base}"))
    if not parts:
        raise RuntimeError("the stream produced no batch")
    rows = spark.read.parquet(*[path for _, path in parts])
    cols = rows.columns
    # the number of a row's batch is the one in its folder's name
    number = F.regexp_extract(F.input_file_name(), r"/(?:batch|snapshot)_id=(\d+)/", 1).cast("long")
    return newest_rows(rows.withColumn("_batch", number), keys, "_batch").select(
        *keys, *[c for c in cols if c not in keys])


class StreamResult:
    """Where a run wrote its output, and how to read it back."""

    def __init__(self, spark: SparkSession, location: str, mode: str, keys: list[str] | None = None,
                 query: StreamingQuery | None = None):
        self.spark, self.location, self.mode, self.keys, self.query = spark, location, mode, keys, query
        self.out = f"{location}/out"

    def table(self) -> DataFrame:
        if self.mode == "append":
            return self.spark.read.parquet(self.out)
        if self.mode == "update":
            return _newest(self.spark, self.out, self.keys)
        batches = _written(self.spark, self.out, "batch_id")
        if not batches:
            raise RuntimeError("the stream produced no batch")
        return self.spark.read.parquet(f"{self.out}/batch_id={batches[-1]}")


def finish(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an available-now query.  With a limit, a query that runs
    longer is stopped and ``TimeoutError`` raised: there is no partial result."""
    ended = query.awaitTermination(timeout_s) if timeout_s is not None else (query.awaitTermination() or True)
    if not ended:
        query.stop()
        raise TimeoutError(f"stream {query.name} did not finish in {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def new_location(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, "streams", f"{name}-{uuid.uuid4().hex[:8]}")


def run(df: DataFrame, name: str, mode: str = "append", keys: list[str] | None = None,
        location: str | None = None, processing_time: str | None = None,
        timeout_s: float | None = None, state_partitions: int | None = None) -> StreamResult:
    """Start ``df`` (a streaming DataFrame) below ``location``.

    By default everything present is processed and the call waits for it
    (available-now); ``processing_time="3 seconds"`` starts a service and
    returns at once.  The number of state partitions is fixed by a query's
    first checkpoint; a new query gets ``state_partitions`` (default: the
    cluster's default parallelism, so state scales with the executors).
    """
    spark = df.sparkSession
    if mode not in ("append", "complete", "update"):
        raise ValueError(f"unknown output mode {mode!r}")
    if mode == "update" and not keys:
        raise ValueError("update mode needs the result's key columns")
    location = location or new_location(spark, name)
    result = StreamResult(spark, location, mode, keys)
    writer = (df.writeStream.queryName(f"{name}_{uuid.uuid4().hex[:6]}").outputMode(mode)
              .option("checkpointLocation", f"{location}/checkpoint"))
    if mode == "append":
        writer = writer.format("parquet").option("path", result.out)
    else:
        def sink(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{result.out}/batch_id={batch_id}")
            if mode == "update" and batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
                _newest(batch.sparkSession, result.out, keys, batch_id).write.mode("overwrite").parquet(
                    f"{result.out}/snapshot_id={batch_id}")

        writer = writer.foreachBatch(sink)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions or spark.sparkContext.defaultParallelism))
    try:
        result.query = writer.start()          # the query clones the session conf here
    finally:
        spark.conf.set(key, previous)
    if not processing_time:
        finish(result.query, timeout_s)
    return result


def file_stream(spark: SparkSession, directory: str, table_file: str | None, fmt: str = "parquet",
                schema=None, max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Stream the files of one table in ``directory`` (file source, replayable):
    a folder of part files, or a single file beside other tables'."""
    path = os.path.join(directory, table_file) if table_file else directory
    if schema is None:
        schema = spark.read.format(fmt).options(**options).load(path).schema
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if table_file and is_folder(spark, path):
        directory = path
    elif table_file:
        reader = reader.option("pathGlobFilter", table_file)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)
