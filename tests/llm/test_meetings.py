"""What is fetched for the rows that meet in a bucket."""
import random

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import prepared, words  # noqa: F401
from quarry.llm import near_embeddings, shingle_join


def test_a_repeated_row_is_fetched_once(spark, monkeypatch):
    text = words(random.Random(3), 60)
    rows = [(1, text)] * 500 + [(2, text + " end"), (3, "other " + text)] + [(None, "no " + text)] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    fetched, with_sets = [], shingle_join.with_sets

    def watch(asked, n):
        fetched.extend(r.id for r in asked.select("id").collect())
        return with_sets(asked, n)
    monkeypatch.setattr(shingle_join, "with_sets", watch)
    got = shingle_join.classes(df).collect()
    assert len(fetched) == len(set(fetched)) == 4
    assert len(got) == len(rows) and {r.class_id for r in got} == {1}
    assert all(r.n_links == len(rows) - 1 for r in got)


def test_vectors_without_a_likely_partner_are_not_fetched(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(64).tolist()) for i in range(120)]
    rows += [(500 + i, (np.array(rows[i][1]) + 0.3 * rng.standard_normal(64)).tolist()) for i in range(20)]
    reps = spark.createDataFrame(rows, "u long, x array<double>")
    one = near_embeddings.sketches(reps).select(
        F.lit(1).cast("long").alias("bucket"), F.lit(0).alias("_a"), F.lit(0).alias("_b"), F.lit(0).alias("_blk"),
        "u", "sketch").repartition(1)
    got = {r.u for r in near_embeddings.promising(one, 0.9).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    cosine = x @ x.T - np.eye(len(x))
    linked = {rows[i][0] for i in np.flatnonzero((cosine >= 0.9).any(axis=1))}
    assert len(linked) == 40 and got == linked


def test_blocks_of_a_bucket_are_compared_with_each_other_only(spark):
    v = [1.0, 2.0, 3.0]
    reps = spark.createDataFrame([(1, v), (2, v), (3, v)], "u long, x array<double>")
    for pair, kept in (((0, 1), {1, 2, 3}), ((2, 3), set())):
        block = F.when(F.col("u") == 3, F.lit(pair[1] if kept else 2)).otherwise(F.lit(pair[0]))
        rows = near_embeddings.sketches(reps).select(
            F.lit(1).cast("long").alias("bucket"), F.lit(pair[0]).alias("_a"), F.lit(pair[1]).alias("_b"),
            block.cast("int").alias("_blk"), "u", "sketch").repartition(1)
        assert {r.u for r in near_embeddings.promising(rows, 0.9).collect()} == kept


def test_least_agreement_is_below_what_a_linked_pair_has():
    assert 128 < near_embeddings.least_agreement(0.9) < near_embeddings.least_agreement(0.95) < 256
    assert near_embeddings.least_agreement(1.0) == 256
