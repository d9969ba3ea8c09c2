"""Event-time windows on batch or streaming DataFrames.

The same functions serve both: on a stream, put ``withWatermark`` on the
time column first (see ``quarry.streaming``).  Windows align to the epoch;
sliding windows expand each row into duration/slide windows (Expand), so a
row is aggregated once per window it falls in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.aggregates import ordered_concat, summary_stats


def time_window(ts: str, duration: str, slide: str | None = None) -> Column:
    return F.window(ts, duration, slide) if slide else F.window(ts, duration)


def flat_window(prefix: str = "window") -> list[Column]:
    return [F.col(f"{prefix}.start").alias("window_start"), F.col(f"{prefix}.end").alias("window_end")]


def window_stats(df: DataFrame, ts: str, value: str, duration: str,
                 slide: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """sum/max/min/avg/stddev_pop of ``value`` per time window."""
    grouped = df.groupBy(*(keys or []), time_window(ts, duration, slide).alias("window"))
    return grouped.agg(*summary_stats(value))


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(duration: str) -> int | None:
    parts = duration.strip().lower().split()
    if len(parts) != 2 or not parts[0].isdigit():
        return None
    unit = parts[1].rstrip("s")
    return int(parts[0]) * _UNIT_SECONDS[unit] if unit in _UNIT_SECONDS else None


#: Numbered lines that one chunk of a pane holds at most.
CHUNK_LINES = 2_000


def panes(df: DataFrame, ts: str, text: str, slide: str, order_cols: list[str] | None = None,
          number: str | None = None, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """(pane, piece, n_lines): the strings of each ``slide``-long pane, in the
    order of (ts, order_cols).  On a stream this is all the state there is:
    each line is held once, not once for every window it is in.

    With ``number``, a column of row numbers in that order, a pane is held as
    chunks (a further column ``chunk``): rows whose numbers have the same
    quotient by ``chunk_lines``.  A value of the state then holds at most that
    many lines however hot its pane is, the chunks of one pane are spread over
    tasks, and a line that arrives rewrites its own chunk only.
    """
    order = [ts, *[c for c in order_cols or [] if c != ts]]
    keys = [F.window(ts, slide).alias("pane")]
    if number:
        order = [number]
        keys.append(F.floor(F.col(number) / chunk_lines).cast("bigint").alias("chunk"))
    return df.groupBy(*keys).agg(ordered_concat(order, text).alias("piece"), F.count(F.lit(1)).alias("n_lines"))


#: Batch input is concatenated in so many pieces of a pane first, in as many tasks.
PIECES = 12


#: Windows that are formed in one task together, as a multiple of the slides that a pane reaches back.
BLOCK_REACHES = 10


def join_panes(pieces: DataFrame, duration: str, slide: str, out: str = "text") -> DataFrame:
    """Sliding windows from their panes (or pieces of panes): each goes to the
    duration/slide windows that start at its slide or before, and a window
    joins its pieces in order.

    Pieces are dealt by blocks of neighbouring windows and repeated for their
    windows only there: a piece moves once, or twice if it reaches back into
    the block before."""
    d, s = _seconds(duration), _seconds(slide)
    reach = d // s - 1
    width = max(1, reach * BLOCK_REACHES)
    place = ["_pane", *[c for c in ("chunk",) if c in pieces.columns]]
    # the number of a piece's slide is that of the last window it is in
    numbered = pieces.withColumn("_pane", F.col("pane.start")).select(
        *place, "piece", "n_lines", F.window("_pane", slide).start.alias("_slide")).withColumn(
        "_last", F.expr(f"unix_micros(_slide) div {s * 1_000_000}"))
    blocks = F.array_distinct(F.array(*[F.floor(n / F.lit(width)) for n in (F.col("_last") - reach, F.col("_last"))]))
    dealt = numbered.select(*place, "piece", "n_lines", "_last", F.explode(blocks).alias("_block")).repartition("_block")
    low = F.col("_block") * width
    own = F.sequence(F.greatest(F.col("_last") - reach, low), F.least(F.col("_last"), low + (width - 1)))
    starts = dealt.select("_block", *place, "piece", "n_lines", F.explode(own).alias("_no"))
    grouped = starts.groupBy("_block", "_no").agg(ordered_concat(place, "piece").alias(out),
                                                  F.sum("n_lines").alias("n_lines"))
    grouped = grouped.withColumn("_start", F.timestamp_micros(F.col("_no") * (s * 1_000_000)))
    window = F.struct(F.col("_start").alias("start"), (F.col("_start") + _interval(F.lit(d))).alias("end"))
    return grouped.select(window.alias("window"), out, "n_lines")


def _interval(seconds: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def window_concat(df: DataFrame, ts: str, text: str, duration: str, slide: str | None = None,
                  order_cols: list[str] | None = None, out: str = "text", number: str | None = None) -> DataFrame:
    """Concatenate every string of a window in arrival order (A9, T3): by
    ``ts``, then ``order_cols``, then the string itself; or by ``number``, a
    column of row numbers in the order of time (``ordering.numbered``), which
    also bounds the lines that a task sorts at once.

    The result of one window is one string, so its size is the window's
    input volume (duration x arrival rate).  Where the slide divides the
    duration, panes are concatenated first and joined (batch input; a stream
    writes its ``panes`` and they are joined when read back).
    """
    d, s = _seconds(duration), (_seconds(slide) if slide else None)
    if slide and not df.isStreaming and d and s and d % s == 0 and d > s:
        if number:
            return join_panes(panes(df, ts, text, slide, number=number), duration, slide, out)
        short = f"{s * 1000 // PIECES} milliseconds" if s * 1000 % PIECES == 0 else slide
        return join_panes(panes(df, ts, text, short, order_cols), duration, slide, out)
    grouped = df.groupBy(time_window(ts, duration, slide).alias("window"))
    order = [number] if number else [ts, *[c for c in order_cols or [] if c != ts]]
    return grouped.agg(ordered_concat(order, text).alias(out), F.count(F.lit(1)).alias("n_lines"))
