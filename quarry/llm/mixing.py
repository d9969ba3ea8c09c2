"""Mixing sources to target weights: balanced sampling by the cube method.

Every source gets a target (water-filled: shares by weight, none above
``most`` times its own size), so each of its documents is wanted target/size
times: a whole number of copies plus a fraction.  The fractions are inclusion
probabilities.  The flight moves them, a few documents at a time, along the
null space of two balancing constraints -- the number of documents and the
number of tokens -- until one of them is settled at 0 or 1.  Sources are
cut into blocks by a hash of the document, blocks fly in parallel, and the one
or two documents that each block leaves unsettled fly again in the next round,
until a source fits one block.  Only then is there a landing: of at most two
documents, settled by dropping the token constraint, then the other.

The size of a text is its number of ``[^\\x20\\x09-\\x0D]+`` matches.  Random
numbers are seeded by source, round and block, and blocks are sorted, so
reruns agree.

Defined results: a null text has size 0; a null source is a source of its
own, the last; repeated rows are documents of their own; a source of size 0
gets target 0; documents of size 0 are counted, but add no words; an empty
table gives an empty result.  The per-source table (one row per source) is
the only thing the driver sees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import read, store
from quarry.llm.groups import complete_groups

WORDS = r"[^\x20\x09-\x0D]+"
#: Documents that fly in one block.
BLOCK = 2000
#: Documents that move together.
POOL = 32
#: Nearer to 0 or 1 than this is settled.
EPS = 1e-9
#: Stands for a null id while documents fly.
NO_ID = -(1 << 63)


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Words wanted of each source: ``share`` of all sizes dealt by weight; a
    source stops at ``most`` times its size, its excess is dealt again."""
    out = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def balanced(u: np.ndarray, z: np.ndarray) -> np.ndarray:
    """``u`` without its parts along 1 and along the centred sizes ``z``."""
    u = u - u.mean()
    spread = z @ z
    return u - (u @ z) / spread * z if spread else u


def fly(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Settle probabilities, keeping their sum and their sum of p * size; at
    most two stay between 0 and 1, none if ``land``.

    Documents are taken from the longest to the shortest, ``POOL`` at a time.
    A step moves the longest as far as it goes while the others make up for
    it, and settles one at least; so those left for the landing are short."""
    p = np.where(p < EPS, 0.0, np.where(p > 1 - EPS, 1.0, p))
    queue = np.flatnonzero((p > 0) & (p < 1))
    queue = queue[np.argsort(-size[queue], kind="stable")]
    pool, at = queue[:POOL], POOL
    while len(pool) > (0 if land else 2):
        q, z = p[pool], size[pool].astype(np.float64)
        if len(pool) > 2:                       # null space of the rows 1 and size
            z -= z.mean()
            u = balanced(np.arange(len(pool)) == 0, z)
            if np.abs(u).max() < 1e-6:          # the longest cannot move: move the others
                u = balanced(rng.standard_normal(len(pool)), z)
        else:                                   # landing: documents only, then nothing
            u = np.array([1.0, -1.0])[:len(pool)]
        with np.errstate(divide="ignore", invalid="ignore"):
            forth = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf))
            back = np.where(u > 0, q / u, np.where(u < 0, (q - 1) / u, np.inf))
        i, j = int(forth.argmin()), int(back.argmin())
        if rng.random() * (forth[i] + back[j]) < back[j]:
            q = q + forth[i] * u
            q[i] = float(u[i] > 0)
        else:
            q = q - back[j] * u
            q[j] = float(u[j] < 0)
        q = np.where(q < EPS, 0.0, np.where(q > 1 - EPS, 1.0, q))
        p[pool] = q
        pool = pool[(q > 0) & (q < 1)]
        if at < len(queue):
            more = queue[at:at + POOL - len(pool)]
            at += len(more)
            pool = np.concatenate((pool, more))
    return p


def _flight(rows: DataFrame, blocks: dict[int, int], turn: int, seed: int) -> DataFrame:
    """One round: every block of every source flies; the sources that are one
    block land as well."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(k, v) for k, v in blocks.items()], "s int, nb int")
    placed = (rows.join(F.broadcast(table), F.col("source_no") == F.col("s")).drop("s")
              .withColumn("blk", F.pmod(F.xxhash64("id", "h", F.lit(turn)), F.col("nb")).cast("int")))
    order = ["source_no", "blk"]
    placed = (placed.repartition(*order)
              .sortWithinPartitions(*order, "id", "h", "size", "p"))
    names = [f.name for f in rows.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, bounds in complete_groups(batches, order):
            p = cols["p"].astype(np.float64).copy()
            for a, b in zip(bounds[:-1], bounds[1:]):
                rng = np.random.default_rng([seed, turn, int(cols["source_no"][a]), int(cols["blk"][a])])
                p[a:b] = fly(p[a:b], cols["size"][a:b], rng, bool(cols["nb"][a] == 1))
            yield pa.record_batch({k: pa.array(p if k == "p" else cols[k], from_pandas=True).cast(
                pa.int64() if k in ("id", "h", "size") else pa.int32() if k in ("source_no", "base")
                else pa.float64()) for k in names})

    return placed.mapInArrow(run, rows.schema)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        seed: int = 7) -> DataFrame:
    """(doc_id, h, size, source_size, target, copies) of every row: ``h``, a
    hash of the text, and how many copies of it the mix takes.  ``weights``
    repeat over the sources in code point order."""
    spark = docs.sparkSession
    rows = store(docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("h"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long").alias("size")), "sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("total"), F.count("*").alias("n")).collect()
    found.sort(key=lambda r: (r.source is None, (r.source or "").encode("utf-8", "surrogatepass")))
    want = targets([r.total for r in found], [weights[i % len(weights)] for i in range(len(found))],
                   share, most)
    plan = spark.createDataFrame(
        [(i, r.source, r.total, t, t / r.total if r.total else 0.0)
         for i, (r, t) in enumerate(zip(found, want))],
        "source_no int, s string, source_size long, target double, rate double")
    rows = (rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("s")))
            .withColumn("base", F.floor(F.col("rate") + F.lit(EPS)).cast("int"))
            .withColumn("p", F.greatest(F.lit(0.0), F.col("rate") - F.col("base")))
            .select("id", "h", "size", "source_no", "base", "p"))
    counts = {i: r.n for i, r in enumerate(found)}
    settled, turn = [], 0
    while counts:
        blocks = {i: -(-n // BLOCK) for i, n in counts.items()}
        rows = store(_flight(rows, blocks, turn, seed), f"flight{turn}")
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(rows.where(~open_))
        rows = rows.where(open_)
        counts = {r.source_no: r["count"] for r in rows.groupBy("source_no").count().collect()}
        turn += 1
    if not settled:
        settled = [rows]
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.join(F.broadcast(plan.select(F.col("source_no").alias("s"), "source_size", "target")),
                    F.col("source_no") == F.col("s")).select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "h", "size", "source_size", "target",
        (F.col("base") + F.col("p")).cast("int").alias("copies"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    taken = mix(docs, **how).groupBy(F.col("doc_id").alias("__mix_id"), F.col("h").alias("__mix_h")).agg(
        F.sum("copies").alias("__mix_copies"), F.count("*").alias("__mix_n"))
    # rows that repeat id and text share their copies: the first gets the rest
    keyed = docs.withColumn("__mix_key", F.xxhash64("text"))
    joined = keyed.join(taken, F.col("doc_id").eqNullSafe(F.col("__mix_id")) & (F.col("__mix_key") == F.col("__mix_h")))
    single = joined.where("__mix_n = 1")
    many = joined.where("__mix_n > 1").dropDuplicates(["__mix_id", "__mix_h"])
    return (single.unionByName(many).where("__mix_copies > 0")
            .withColumn("__mix_i", F.explode(F.sequence(F.lit(1), F.col("__mix_copies").cast("int"))))
            .select(*[f"`{c}`" for c in docs.columns]))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))
