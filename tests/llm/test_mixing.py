import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs, empty, prepared, texts  # noqa: F401
from quarry.llm import mixing


@pytest.mark.parametrize("sizes,weights,want", [
    ([100, 100, 100], [3, 1, 2], [200.0, 250 / 3, 500 / 3]),     # the first stops at twice its size
    ([10, 1000], [3, 1], [20.0, 1495.0]),
    ([0, 10], [3, 1], [0.0, 15.0]),
    ([], [], []),
])
def test_targets(sizes, weights, want):
    assert mixing.targets(sizes, weights, 1.5, 2.0) == pytest.approx(want)


@pytest.mark.parametrize("n,chance", [(60, 0.3), (3000, 0.77)])
def test_flight_keeps_both_totals(n, chance):
    rng = np.random.default_rng(n)
    size = np.maximum(1, rng.lognormal(5, 1.2, n)).astype(int)
    p = mixing.fly(np.full(n, chance), size, np.random.default_rng(1), land=False)
    assert ((p > 0) & (p < 1)).sum() <= 2
    assert p.sum() == pytest.approx(n * chance) and p @ size == pytest.approx(size.sum() * chance)
    p = mixing.fly(np.full(n, chance), size, np.random.default_rng(1), land=True)
    assert set(p.tolist()) <= {0.0, 1.0} and abs(p.sum() - n * chance) < 1
    assert abs(p @ size - size.sum() * chance) < max(60, 0.01 * size.sum())


def test_flight_hits_the_probabilities():
    size = np.r_[500, np.arange(39) + 1]
    mean = np.mean([mixing.fly(np.full(40, 0.3), size, np.random.default_rng(k), True) for k in range(800)], axis=0)
    assert abs(mean - 0.3).max() < 0.08


def test_equal_sizes_and_settled_ones():
    p = mixing.fly(np.r_[0.0, 1.0, np.full(10, 0.5)], np.full(12, 7), np.random.default_rng(0), True)
    assert p[0] == 0 and p[1] == 1 and p.sum() == 6


@pytest.mark.parametrize("block", [2000, 10])
def test_mix(spark, docs, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    clash = docs.withColumn("h", F.lit(1)).withColumn("size", F.lit("x")).withColumn("copies", F.lit(9))
    got = mixing.mix(clash).collect()
    rows = docs.collect()
    assert len(got) == len(rows)
    size = Counter()
    for r in rows:
        size[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter(
        (r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in rows)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, mixing.targets([size[s] for s in order], [3, 1, 2, 3][:len(order)], 1.5, 2.0)))
    source = {r.doc_id: r.source for r in rows}
    for r in got:
        assert r.copies in (0, 1, 2) and r.source_size == size[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
    again = mixing.mix(clash.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_documents_of_the_mix(docs, empty):
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] += r.copies
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == +copies
    assert mixing.mixed_documents(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_taken_words_come_near_the_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(k)), f"s{i % 4}") for i, k in enumerate(rng.lognormal(4, 1, 2000))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    by = (mixing.mix(df).withColumn("s", F.col("doc_id") % 4).groupBy("s")
          .agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")))
    for r in by.collect():
        assert abs(r.taken - r.target) < 0.002 * r.target
