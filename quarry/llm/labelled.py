"""A bounded, reproducible sample of labelled documents, and the hold-out rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
           per_label: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, label) of at most ``per_label`` documents of each label
    that are not held out: those whose ids hash lowest.  Only the chosen ids
    (2 x per_label rows at most) are broadcast, and only their texts shuffled;
    of an id that repeats with several texts one is taken."""
    known = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & (remainder("id", modulus) != held_out)))
    chosen = reduce(DataFrame.unionByName, [
        known.where(F.col("label") == v).orderBy(F.xxhash64("id", F.lit(11)), "id").limit(per_label)
        for v in (0, 1)])
    found = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("doc") == F.col("id"))
    return found.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("id", "text", "label")


def fitted(rows: DataFrame, fit) -> bytes:
    """The bytes that ``fit(list of (id, text, label))`` returns for a bounded
    sample, run by one task; rows come in the order of their ids."""
    import pyarrow as pa

    def run(batches):
        got = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        yield pa.record_batch({"model": pa.array([fit(got)], pa.binary())})

    one = rows.select("id", "text", "label").repartition(1).sortWithinPartitions("id", "text", "label")
    found = one.mapInArrow(run, "model binary").collect()
    return bytes(found[0].model) if found else fit([])
