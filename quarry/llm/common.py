"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import apply_session_conf, shared_dir, track


#: Rows and bytes that go to a Python worker at a time: texts can be long.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
           "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}

#: Characters of the distinct words that a task remembers, whatever their number.
REMEMBERED_CHARS = 16 << 20


def prepare(spark: SparkSession) -> None:
    """The session settings that the operators rely on."""
    apply_session_conf(spark)
    for key, value in BATCHES.items():
        spark.conf.set(key, value)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage with files that every executor (and a retry) can read."""
    path = f"{shared_dir(df.sparkSession, 'llm')}/{name}-{uuid.uuid4().hex[:10]}"
    df.write.parquet(path)
    track(path, df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores added until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every (start, length), concatenated."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    out = np.ones(total, np.int64)
    full = lengths > 0
    s, n = np.asarray(starts, np.int64)[full], lengths[full]
    if not len(s):
        return out
    out[0] = s[0]
    out[np.cumsum(n)[:-1]] = s[1:] - (s[:-1] + n[:-1] - 1)
    return np.cumsum(out)


def offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def bands_for(similarity: float, rows: int, recall: float) -> int:
    """Tables needed so that a pair whose single hash agrees with probability
    ``similarity`` shares one of them with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows)))


def with_block_pairs(rows: DataFrame, key: str, item: Column, limit: int) -> DataFrame:
    """Cut groups that are too large for one task.

    Of a group with n > ``limit`` rows each row gets a block (a hash of
    ``item``, modulo ceil(n/limit)) and is sent to every block pair it belongs
    to, so that any two rows of the group meet in exactly one pair (a, b), and
    no task holds more than two blocks.  Rows of a group of one are dropped
    (they meet nobody).  Adds ``_a``, ``_b`` (the pair) and ``_blk`` (the
    row's own block); group sizes are counted with a partial aggregate.
    """
    # written: between two plain exchanges, adaptive execution can split a hot key's join
    counts = store(rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
                   .withColumnRenamed(key, "_key"), "sizes")
    return (
        rows.join(counts, F.col(key) == F.col("_key"), "inner").drop("_key")
        .withColumn("_nb", F.ceil(F.col("_n") / F.lit(limit)).cast("int"))
        .withColumn("_blk", F.pmod(F.xxhash64(item, F.lit(7)), F.col("_nb")).cast("int"))
        .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
        .withColumn("_a", F.least("_blk", "_o")).withColumn("_b", F.greatest("_blk", "_o"))
        .drop("_n", "_nb", "_o"))
