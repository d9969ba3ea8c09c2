"""Late rows to a table of their own.

Spark drops a row whose window ended before the watermark, without a trace.
Here each micro-batch is divided before any aggregate: with the watermark that
Spark filters with (the largest event time before the *previous* batch, less the
allowed lateness: a batch's own watermark serves to close windows, that of the
batch before it to drop rows), rows of windows that are still open go to ``kept``, the
others to ``late``.  The clock is a table too, one row per batch, so a retried
batch is divided as it was before and a restarted query goes on: kept and late
rows together are exactly the input.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.streaming import runner


class Divided:
    """Where a run keeps its tables, and how to read them back."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location

    def _batches(self, kind: str) -> list[int]:
        return runner._written(self.spark, f"{self.location}/{kind}", "batch_id")

    def _table(self, kind: str) -> DataFrame:
        base = f"{self.location}/{kind}"
        found = self._batches(kind)
        if not found:
            raise RuntimeError("the stream produced no batch")
        return self.spark.read.parquet(*[f"{base}/batch_id={n}" for n in found])

    def kept(self) -> DataFrame:
        return self._table("kept")

    def late(self) -> DataFrame:
        return self._table("late")

    def clock(self, before: int) -> int | None:
        """The largest event time, in microseconds, of the batches below ``before``."""
        found = [n for n in self._batches("clock") if n < before]
        if not found:
            return None
        # every row holds the maximum so far, so the last one does
        return self.spark.read.parquet(f"{self.location}/clock/batch_id={found[-1]}").first()[0]


def divide(df: DataFrame, name: str, ts: str, duration: str, lateness: str, location: str | None = None,
           timeout_s: float | None = None) -> Divided:
    """Run the stream ``df`` (available now) into ``kept`` and ``late``; a row
    is late if its ``duration`` window ended at or before the watermark.  Rows
    without a time are late (no window would take them)."""
    spark = df.sparkSession
    location = location or runner.new_location(spark, name)
    tables = Divided(spark, location)
    time = F.col(ts).cast("timestamp")

    def sink(batch: DataFrame, batch_id: int) -> None:
        clock = tables.clock(batch_id - 1)
        ends = F.unix_micros(F.window(time, duration)["end"])
        allowed = F.unix_micros(F.timestamp_micros(F.lit(clock)) - F.expr(f"INTERVAL {lateness}"))
        # the watermark counts whole milliseconds
        late = F.lit(False) if clock is None else ends <= F.floor(allowed / 1000) * 1000
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            marked = batch.withColumn("_late", F.when(time.isNull(), True).otherwise(False))
            timed = batch.where(time.isNotNull()).withColumn("_late", late)
            rows = timed.unionByName(marked.where(time.isNull()))
            for kind, wanted in (("kept", ~F.col("_late")), ("late", F.col("_late"))):
                rows.where(wanted).drop("_late").write.mode("overwrite").parquet(f"{location}/{kind}/batch_id={batch_id}")
            upto = batch.agg(F.greatest(F.unix_micros(F.max(time)), F.lit(clock).cast("bigint")).alias("us"))
            upto.write.mode("overwrite").parquet(f"{location}/clock/batch_id={batch_id}")
        finally:
            batch.unpersist()

    query = (df.writeStream.queryName(name).option("checkpointLocation", f"{location}/checkpoint")
             .foreachBatch(sink).trigger(availableNow=True).start())
    runner.finish(query, timeout_s)
    return tables


