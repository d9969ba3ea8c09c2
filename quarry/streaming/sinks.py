"""foreachBatch sinks.

Every writer is idempotent by batch id: a retried batch overwrites the same
``batch=<n>`` folder on shared storage, so output is exactly-once even when
executors or the driver restart.  Folders, never executor-local paths.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

BatchWriter = Callable[[DataFrame, int], None]


def text_batches(base: str, line: Column) -> BatchWriter:
    """One text folder per batch; ``line`` renders a row as one string (K2)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(line.alias("value")).write.mode("overwrite").text(
            os.path.join(base, f"batch={batch_id}"))
    return write


def parquet_batches(base: str) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(base, f"batch={batch_id}"))
    return write


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """Write one batch to several sinks.  The batch is persisted
    (memory, spilling to disk) so it is computed once, not once per sink."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if len(writers) == 1:
            writers[0](batch, batch_id)
            return
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for w in writers:
                w(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def console(df: DataFrame, mode: str = "complete", processing_time: str | None = "3 seconds",
            rows: int = 20) -> StreamingQuery:
    """Print each result to the driver's console (K1; for interactive use)."""
    w = df.writeStream.format("console").outputMode(mode).option("numRows", rows).option("truncate", False)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
