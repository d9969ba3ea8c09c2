"""Sort and limit.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps
its own top k and only k rows per task reach the final merge, so a top-k
never sorts the whole input.  A full sort is a range exchange (sampled
bounds, balanced partitions) plus a local sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import write_table


def sort_desc(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Descending sort, nulls last (O1)."""
    return df.orderBy(*[F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in cols])


def sort_asc(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Ascending sort, nulls first (O2)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols])


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """First k rows of a sort (O3).  Give a total order (tie-break keys)
    when the result must be reproducible."""
    return df.orderBy(*order).limit(k)


def first_rows(df: DataFrame, n: int, order: list[Column] | None = None) -> DataFrame:
    """Plain limit (O4); unordered unless ``order`` is given."""
    return (df.orderBy(*order) if order else df).limit(n)


def numbered(df: DataFrame, order: list[Column], out: str = "number") -> DataFrame:
    """``df`` and, as ``out``, each row's place in a sort of the whole table,
    from 0, without a window over all rows in one task: a range exchange, the
    place in a sorted partition, and the rows of the partitions before it.
    The sorted rows are written once, so that what is counted is what is numbered."""
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = write_table(df.orderBy(*order).select("*", F.spark_partition_id().alias("_part"), local.alias("_local")),
                         "sorted")
    sizes = placed.groupBy(F.col("_part").alias("_of")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("_of", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    # one row per partition of the sort, so a broadcast is bounded by spark.sql.shuffle.partitions
    joined = placed.join(F.broadcast(firsts), F.col("_part") == F.col("_of"))
    return joined.select(*df.columns, (F.col("_first") + F.col("_local")).alias(out))
