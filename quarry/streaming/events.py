"""Event-time preparation for streams.

``withWatermark`` needs a TIMESTAMP column (a TIMESTAMP_NTZ column is
refused), so the time column is cast first (session zone UTC).  Rows are
filtered as late with the watermark of the *previous* batch; append mode
emits a window once the watermark passes its end, update mode emits every
changed window and drops state behind the watermark, and complete mode
drops nothing (its state grows with the number of windows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import timewindows


def with_event_time(df: DataFrame, ts: str, lateness: str | None) -> DataFrame:
    out = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return out.withWatermark(ts, lateness) if lateness else out


def windowed_stats(df: DataFrame, ts: str, value: str, duration: str,
                   lateness: str | None = "2 minutes", slide: str | None = None) -> DataFrame:
    """Five statistics per event-time window of a stream (watermark first)."""
    return timewindows.window_stats(with_event_time(df, ts, lateness), ts, value, duration, slide)
