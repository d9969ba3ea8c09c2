"""Near-duplicate vectors: random-hyperplane tables, exact cosines, components.

Equal vectors are collapsed first (a group of copies is one representative
with a count).  Every representative is hashed by the signs of its products
with ``bits`` random hyperplanes in each of several tables; the number of
tables follows from the recall wanted at the threshold, and ``bits`` grows with
the logarithm of the number of vectors, so buckets keep their size as data
grows.  What meets in a bucket first is a sketch of each vector, ``SKETCH`` more
sign bits: pairs of random vectors agree on half of them, pairs at the threshold on
many more, and only vectors with a partner that agrees on enough (``DEVIATIONS``
standard deviations below what the threshold expects, so that a link is lost to it
once in 30,000) are fetched.  They meet in one task, in blocks if the bucket is
large, and *all* their pairs are verified by a block of exact double-precision
cosines.  No pair list is ever written: a task emits, for each
vector, its number of links (a pair counts in the first table that it shares,
which both sides know from their codes) and the smallest member of its local
component.  Those star edges go to the distributed connected components.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components, and rows without an id, link with nothing and are their
own component; vectors of different lengths never link; repeated rows are
vectors of their own (they link at cosine 1); an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import bands_for, read, store, with_block_pairs
from quarry.llm.components import components
from quarry.llm.groups import complete_groups, matrix, smallest_linked

#: Rows of a bucket that one block holds.
BLOCK = 1024
#: Sign bits of a sketch, a multiple of 8, and how far below the expected agreement
#: of a pair at the threshold a pair is still verified.
SKETCH, DEVIATIONS = 256, 4.0


def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([dim, bits]).standard_normal((dim, tables * bits))


def codes(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Sign code of every row of ``x`` in every table."""
    signs = (x @ planes(x.shape[1], bits, tables) > 0).reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def usable(vec: str) -> "F.Column":
    """Not null, not empty, finite throughout and not all zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vec).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vec, lambda x: x != 0)


def sketches(reps: DataFrame) -> DataFrame:
    """(u, sketch): the signs of each vector's products with ``SKETCH`` hyperplanes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = batch.column("u").to_numpy()
            for dim, rows, x in matrix(batch.column("x")):
                packed = np.packbits(x @ planes(dim, SKETCH, 1) > 0, axis=1)
                yield pa.record_batch({"u": pa.array(u[rows]),
                                       "sketch": pa.array([p.tobytes() for p in packed], pa.binary())})

    return reps.select("u", "x").mapInArrow(run, "u long, sketch binary")


def least_agreement(threshold: float) -> int:
    """Bits on which the sketches of a pair to be verified agree, at least."""
    agree = 1 - math.acos(threshold) / math.pi
    return math.floor(SKETCH * agree - DEVIATIONS * math.sqrt(SKETCH * agree * (1 - agree)))


def promising(meets: DataFrame, threshold: float) -> DataFrame:
    """The bucket rows that have a partner there whose sketch agrees enough."""
    least = least_agreement(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, bounds in complete_groups(batches, ["bucket", "_a", "_b"]):
            keep = np.zeros(len(cols["u"]), bool)
            for a, b in zip(bounds[:-1], bounds[1:]):
                packed = np.frombuffer(b"".join(cols["sketch"][a:b]), np.uint8).reshape(b - a, -1)
                signs = np.unpackbits(packed, axis=1).astype(np.float32) * 2 - 1
                near = signs @ signs.T >= 2 * least - SKETCH
                np.fill_diagonal(near, False)
                if cols["_a"][a] != cols["_b"][a]:
                    block = cols["_blk"][a:b]
                    near &= block[:, None] != block
                keep[a:b] = near.any(axis=1)
            if keep.any():
                yield pa.record_batch({k: pa.array(cols[k][keep]) for k in ("bucket", "_a", "_b", "_blk", "u")})

    return meets.mapInArrow(run, "bucket long, _a int, _b int, _blk int, u long")


def bucket_rows(reps: DataFrame, bits: int, tables: int) -> DataFrame:
    """(bucket, u) for every representative and table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = batch.column("u").to_numpy()
            for dim, rows, x in matrix(batch.column("x")):
                code = codes(x, bits, tables)
                # table and code side by side, then the length: one long per bucket
                key = (np.arange(tables, dtype=np.int64) << bits) + code
                key = key * 65_537 + dim
                yield pa.record_batch({"bucket": pa.array(key.ravel()),
                                       "u": pa.array(np.repeat(u[rows], tables))})

    return reps.select("u", "x").mapInArrow(run, "bucket long, u long")


def verify(rows: DataFrame, bits: int, tables: int, threshold: float) -> DataFrame:
    """(u, links, low) from the buckets' blocks: links found here first,
    weighted by copies, and the smallest member linked through this bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, bounds in complete_groups(batches, ["bucket", "_a", "_b"]):
            out_u, out_links, out_low = [], [], []
            x = np.stack(list(cols["x"]), dtype=np.float64) if same_length(cols["x"]) else None
            for a, b in zip(bounds[:-1], bounds[1:]):
                part = x[a:b] if x is not None else np.stack(list(cols["x"][a:b])).astype(np.float64)
                part = part / np.linalg.norm(part, axis=1)[:, None]
                u, copies, block = cols["u"][a:b], cols["copies"][a:b], cols["_blk"][a:b]
                cosine = part @ part.T
                near = cosine >= threshold
                np.fill_diagonal(near, False)
                if cols["_a"][a] != cols["_b"][a]:
                    near &= block[:, None] != block
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                linked = np.unique(i)
                code = np.zeros((b - a, tables), np.int64)
                code[linked] = codes(part[linked], bits, tables)
                table = (cols["bucket"][a] // 65_537) >> bits
                first = np.ones(len(i), bool)
                for t in range(table):
                    first &= code[i, t] != code[j, t]
                out_u.append(u[linked])
                out_links.append(np.bincount(i[first], copies[j[first]], b - a)[linked])
                out_low.append(smallest_linked(near, u)[linked])
            if out_u:
                yield pa.record_batch({
                    "u": pa.array(np.concatenate(out_u)),
                    "links": pa.array(np.concatenate(out_links).astype(np.int64)),
                    "low": pa.array(np.concatenate(out_low))})

    return rows.mapInArrow(run, "u long, links long, low long")


def same_length(vectors: np.ndarray) -> bool:
    return len({len(v) for v in vectors}) == 1


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding",
                    threshold: float = 0.9, recall: float = 0.999) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vec).alias("x"))
    good = F.col("id").isNotNull() & usable("x")
    # equal vectors are known by 128 bits of hash; representatives are numbered as they are written
    rows = rows.select("id", "x", F.when(good, F.xxhash64("x")).alias("h"),
                       F.when(good, F.xxhash64(F.lit(1), "x")).alias("g"))
    reps = store(rows.where("h is not null").groupBy("h", "g")
                 .agg(F.min_by("x", "id").alias("x"), F.min("id").alias("low_id"),
                      F.count("*").alias("copies"))
                 .select(F.monotonically_increasing_id().alias("u"), "*"), "vectors")
    n = reps.count()
    bits = max(4, math.ceil(math.log2(max(n, 1) / 64 + 1)))
    agree = 1 - math.acos(threshold) / math.pi
    tables = bands_for(agree, bits, recall)
    place = ["bucket", "_a", "_b"]
    meets = (with_block_pairs(bucket_rows(reps, bits, tables), "bucket", F.col("u"), BLOCK)
             .join(sketches(reps), "u").repartition(*place).sortWithinPartitions(*place))
    meets = (store(promising(meets, threshold), "promising").join(reps.select("u", "x", "copies"), "u")
             .repartition(*place).sortWithinPartitions(*place))
    found = store(verify(meets, bits, tables, threshold), "links")
    links = found.groupBy("u").agg(F.sum("links").alias("links"))
    parts = components(found.select("u", "low"), "u", "low")
    # components by representative; named by the smallest id of any member
    named = (reps.join(parts, F.col("u") == F.col("node"), "left").drop("node")
             .withColumn("component", F.coalesce("component", "u"))
             .join(links, "u", "left"))
    smallest = named.groupBy(F.col("component").alias("c")).agg(F.min("low_id").alias("component_id"))
    named = (named.join(smallest, F.col("component") == F.col("c"))
             .select(F.col("h").alias("h2"), F.col("g").alias("g2"), "component_id",
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    same = (F.col("h") == F.col("h2")) & (F.col("g") == F.col("g2"))
    return rows.select("id", "h", "g").join(named, same, "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").cast("long").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(False)).alias("kept"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
