"""Skew-safe window analytics (W1-W5), one path for every size.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.
With few keys (5 categories) or one hot key (a third of all rows) that is one
straggler task holding a huge sorted buffer.  The operators here give the
same results as the plain window, but cut the rows into *fragments*: ranges of
the whole sort order (keys, then order columns, then a hash of the row where
rows may tie), so that a fragment holds a bounded number of rows whatever their
keys, types, nulls or bursts.

* The cuts are sampled tuples of the sort order, of the columns' own types
  and with Spark's own ordering (nulls first).  They are written once to the
  shared folder, so every branch of a plan, and every retry, uses the same.
* Running aggregates (RANGE unbounded preceding .. current row) become a
  distributed prefix sum: local sums per fragment + carried fragment totals.
* "Previous k rows" lists are computed inside each fragment; the first k rows
  of a fragment are completed from the tails (at most k values each) of the
  fragments before it.  Only a key that a cut divides has tails.

``rows_per_fragment`` is the bound.  By default it is a 64th of the rows,
between 1,000 and 2,000,000, so small inputs run the same plan as large ones.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.ordering import numbered
from quarry.session import write_table

MOST_ROWS, LEAST_ROWS, PIECES = 2_000_000, 1_000, 64
#: Inputs up to this many rows are cut exactly, larger ones by a sample.
EXACT_ROWS = 200_000
#: Sampled rows for each cut.
SAMPLES = 40


def default_rows_per_fragment(rows: int) -> int:
    return max(LEAST_ROWS, min(MOST_ROWS, math.ceil(rows / PIECES)))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` where null matches null (<=>), keeping left column
    names.  Whether a side is broadcast is left to adaptive execution, which
    has measured its bytes."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def _cuts(df: DataFrame, cols: list[str], rows_per_fragment: int | None) -> tuple[DataFrame | None, int]:
    """A one-row table ``cuts`` of sorted, different tuples of ``cols`` (null if
    no cut is needed), and how many there are."""
    rows = df.count()
    limit = rows_per_fragment or default_rows_per_fragment(rows)
    if rows <= limit:
        return None, 0
    keys = df.select(*cols)
    if rows <= EXACT_ROWS:
        step = limit
    else:
        # half the limit: a sampled range of twice its expected size is still within it
        pieces = math.ceil(2 * rows / limit)
        keys = keys.sample(fraction=min(1.0, SAMPLES * pieces / rows), seed=17)
        step = SAMPLES
    order = [F.col(c).asc_nulls_first() for c in cols]
    if rows <= EXACT_ROWS:
        ranked = keys.select(F.struct(*cols).alias("cut"), (F.row_number().over(Window.orderBy(*order)) - 1).alias("at"))
    else:
        ranked = _ranked(keys, cols, order)
    picked = ranked.where((F.col("at") > 0) & (F.col("at") % step == 0))
    cuts = F.array_sort(F.array_distinct(F.collect_list("cut")))
    table = write_table(picked.agg(cuts.alias("cuts")).select("cuts", F.size("cuts").alias("n")), "cuts")
    return table.select("cuts"), table.first().n


def _ranked(keys: DataFrame, cols: list[str], order: list[Column]) -> DataFrame:
    """(cut, at): tuples of ``cols`` with their rank, from a range exchange:
    the place in a sorted partition and the rows of the partitions before it."""
    return numbered(keys, order, "at").select(F.struct(*cols).alias("cut"), "at")


def with_fragments(df: DataFrame, keys: list[str], order: list[str],
                   rows_per_fragment: int | None = None, goes_on: str | None = None) -> DataFrame:
    """Add ``_frag``: the number of cuts at or below the row's (keys, order)
    tuple, found by binary search.  (keys, _frag, order) sorts exactly like
    (keys, order); rows that tie in all of it share a fragment.

    Every cut is the tuple of a row, so it is the first of its fragment, and no
    fragment after the first is empty.  ``goes_on`` names a column that tells whether the next
    fragment begins with the row's key: true for one key of a fragment at most."""
    cuts, n = _cuts(df, [*keys, *order], rows_per_fragment)
    if not n:
        return df.select("*", F.lit(0).alias("_frag"), *([F.lit(False).alias(goes_on)] if goes_on else []))
    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)])
    placed = df.select("*", cuts.scalar().alias("_cuts"), F.struct(*keys, *order).alias("_tuple"))
    found = F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((at + step <= n) & (F.get("_cuts", at + step - 1) <= F.col("_tuple")),
                                at + step).otherwise(at))
    if not goes_on:
        return placed.select(*df.columns, found.alias("_frag"))
    # a generator of one element: what uses the number does not search again
    placed = placed.select(*df.columns, F.explode(F.array(found)).alias("_frag"), "_cuts")
    following = F.get("_cuts", F.col("_frag"))
    # past the last cut there is no fragment, and a null key must not take that for its own
    same = reduce(and_, [following[k].eqNullSafe(F.col(k)) for k in keys], F.col("_frag") < n)
    return placed.select(*df.columns, "_frag", same.alias(goes_on))


# ----------------------------------------------------------- running average
def running_average(df: DataFrame, keys: list[str], order_col: str, value_col: str,
                    out: str = "running_avg", rows_per_fragment: int | None = None) -> DataFrame:
    """``avg(value) OVER (PARTITION BY keys ORDER BY order_col)``.

    Default frame = RANGE UNBOUNDED PRECEDING .. CURRENT ROW: rows with equal
    ``order_col`` share one value; nulls in ``value_col`` are skipped.  The
    input is read twice: for one row per (key, order value), and for the result.
    """
    grain = keys + [order_col]
    # a partial aggregate; written, because cuts, sums and totals read it
    pre = write_table(df.groupBy(*grain).agg(F.sum(value_col).alias("_s"), F.count(value_col).alias("_c")),
                      "running_totals")
    pre = with_fragments(pre, keys, [order_col], rows_per_fragment)
    local_w = (Window.partitionBy(*keys, "_frag").orderBy(F.col(order_col).asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = pre.select(*grain, "_frag", F.sum("_s").over(local_w).alias("_ls"),
                       F.sum("_c").over(local_w).alias("_lc"))
    totals = pre.groupBy(*keys, "_frag").agg(F.sum("_s").alias("_ts"), F.sum("_c").alias("_tc"))
    # one row per fragment of a key
    carry_w = (Window.partitionBy(*keys).orderBy("_frag")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = totals.select(*keys, "_frag",
                          F.coalesce(F.sum("_ts").over(carry_w), F.lit(0.0)).alias("_os"),
                          F.coalesce(F.sum("_tc").over(carry_w), F.lit(0)).alias("_oc"))
    cum = join_null_safe(local, carry, keys + ["_frag"], "inner")
    s = F.coalesce("_ls", F.lit(0.0)) + F.col("_os")
    n = F.col("_lc") + F.col("_oc")
    cum = cum.select(*grain, F.when(n > 0, s / n).alias(out))
    return join_null_safe(df, cum, grain)


# ------------------------------------------------------- previous-k row lists
def _previous(df: DataFrame, keys: list[str], order: list[str], collect: Column, k: int,
              rows_per_fragment: int | None) -> DataFrame:
    """``df`` and, as ``_near``, structs ``v`` of the ``k`` rows before each, oldest first."""
    cols = df.columns
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = df.select("*", collect.alias("_v"), F.xxhash64(*hashable).alias("_tie"))
    place, sort = [*keys, "_frag"], [*order, "_tie"]
    rows = with_fragments(rows, keys, sort, rows_per_fragment, "_goes_on")
    value = F.struct(F.col("_v").alias("v"))
    # Only the key that goes on in the next fragment has a tail: its last k rows.
    # Every task keeps k rows of each fragment before anything is exchanged.
    newest = Window.partitionBy(*place).orderBy(*[F.col(c).desc_nulls_last() for c in sort])
    last = (rows.where("_goes_on").select(*place, value.alias("_x"), F.row_number().over(newest).alias("_back"))
            .where(F.col("_back") <= k))
    oldest_first = F.array_sort(F.collect_list(F.struct("_back", "_x")), lambda a, b: b["_back"] - a["_back"])
    tails = last.groupBy(*place).agg(F.transform(oldest_first, lambda e: e["_x"]).alias("_tail"))
    # one row per fragment; its rows are counted up to k, which is all that is asked below
    tails = write_table(tails.select(*place, "_tail", F.size("_tail").alias("_cnt")), "tails")
    # which fragments hold the k rows before the one that follows this?
    before = Window.partitionBy(*keys).orderBy("_frag")
    sums = tails.select(*place, "_cnt", F.sum("_cnt").over(before).alias("_upto"))
    sums = sums.select("*", F.collect_list(F.struct("_frag", "_upto")).over(
        before.rowsBetween(1 - k, Window.currentRow)).alias("_prior"))
    wanted = sums.select((F.col("_frag") + 1).alias("_to"), *keys, F.explode(F.filter(
        "_prior", lambda p: p["_upto"] > F.col("_upto") - k)["_frag"]).alias("_frag"))
    heads = (join_null_safe(wanted, tails.select(*place, "_tail"), place, "inner")
             .groupBy("_to").agg(F.first(F.struct(*keys)).alias("_key"),
                                 F.array_sort(F.collect_list(F.struct("_frag", "_tail")),
                                              lambda a, b: a["_frag"] - b["_frag"]).alias("_t"))
             .select("_to", "_key", F.flatten(F.transform("_t", lambda t: t["_tail"])).alias("_head")))
    # one exchange, by fragment, serves the windows and the join
    w = Window.partitionBy(*place).orderBy(*[F.col(c).asc_nulls_first() for c in sort])
    staged = rows.drop("_goes_on").repartition("_frag").select(
        "*", F.row_number().over(w).alias("_pos"), F.collect_list(value).over(w.rowsBetween(-k, -1)).alias("_near"))
    joined = staged.join(heads, F.col("_frag") == F.col("_to"), "left")
    both = F.concat("_head", "_near")
    near = F.when((F.col("_pos") <= k) & F.col("_key").eqNullSafe(F.struct(*keys)),
                  F.slice(both, -F.least(F.size(both), F.lit(k)), F.lit(k))).otherwise(F.col("_near"))
    return joined.select(*cols, near.alias("_near"))


def previous_values(df: DataFrame, keys: list[str], order: list[str], collect: Column,
                    k: int, out: str = "lagged", rows_per_fragment: int | None = None) -> DataFrame:
    """``collect_list(collect) OVER (PARTITION BY keys ORDER BY order
    ROWS BETWEEN k PRECEDING AND 1 PRECEDING)`` (W2); first row -> [].

    Rows that tie in ``order`` are ordered by a hash of the row, so the result
    does not depend on the partitioning, and a hot tie is cut as well (rows
    alike in every column stay together).  Nulls of ``collect`` are skipped, as
    collect_list does; collect a struct to keep positions.
    """
    near = _previous(df, keys, order, collect, k, rows_per_fragment)
    return near.select(*df.columns, F.array_compact(F.transform("_near", lambda x: x["v"])).alias(out))


def lag_list(df: DataFrame, keys: list[str], order: list[str], value_col: str, k: int = 10,
             out: str = "laggedValues", rows_per_fragment: int | None = None) -> DataFrame:
    """Previous ``k`` values of ``value_col`` per series, oldest first."""
    return previous_values(df, keys, order, F.col(value_col), k, out, rows_per_fragment)


def sequence_windows(df: DataFrame, keys: list[str], order: list[str], value_col: str,
                     history: int = 50, out: str = "history", target: str = "target",
                     rows_per_fragment: int | None = None) -> DataFrame:
    """Supervised windows: the ``history`` previous values -> current value.

    Positions are counted, not values: nulls stay in the history.  Rows with
    fewer than ``history`` predecessors produce no window.
    """
    near = _previous(df, keys, order, F.col(value_col), history, rows_per_fragment)
    return (near.where(F.size("_near") == history)
            .select(*keys, *order,
                    F.transform("_near", lambda s: s["v"]).alias(out),
                    F.col(value_col).alias(target)))


def partition_aggregate(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Whole-partition window aggregates (``agg(...) OVER (PARTITION BY keys)``)
    as an aggregate joined back: partial aggregation before the shuffle, and
    a join that adaptive execution may broadcast or split (W3)."""
    return join_null_safe(df, df.groupBy(*keys).agg(*aggs), keys)
