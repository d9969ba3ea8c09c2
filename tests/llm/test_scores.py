import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF_ORACLE, SF_TENTH, docs, empty, prepared, texts  # noqa: F401
from quarry.llm import quality, toxicity
from quarry.llm.common import read

LABELS = "doc_id long, quality int, toxic int"


# --- the field

def chain_by_hand(s, trans):
    """Marginals and transition counts by going through all state sequences."""
    total, marginal, pairs = 0.0, np.zeros(len(s)), np.zeros((2, 2))
    for path in itertools.product((0, 1), repeat=len(s)):
        weight = np.exp(sum(x * y for x, y in zip(s, path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        total += weight
        marginal += weight * np.array(path)
        for a, b in zip(path, path[1:]):
            pairs[a, b] += weight
    return marginal / total, pairs / total


def test_forward_backward():
    rng = np.random.default_rng(0)
    trans = rng.standard_normal((2, 2))
    parts = [rng.standard_normal(k) for k in (5, 1, 0, 8)]
    bounds = np.r_[0, np.cumsum([len(p) for p in parts])]
    got, pairs = toxicity.forward_backward(np.concatenate(parts), bounds, trans)
    hand = [chain_by_hand(p, trans) for p in parts if len(p)]
    assert got == pytest.approx(np.concatenate([h[0] for h in hand]))
    assert pairs == pytest.approx(sum(h[1] for h in hand))


def test_spans_and_degenerate_texts():
    rng = random.Random(0)
    clean = ["good", "word", "here", "plain", "other", "thing"]
    rows = [(i, " ".join(rng.choices(clean, k=30) + (["idiotic!"] if i % 2 else [])), i % 2) for i in range(60)]
    model = toxicity.pickle.loads(toxicity.fit(rows))
    score, spans = toxicity.tagged(toxicity.Words(), ["good idiotic word", "good word", "", None], model)
    assert spans == [[{"start": 5, "end": 12}], [], [], []]
    assert score[0] > 0.8 and max(score[1:]) < 0.2 and score[2] == score[3]
    assert toxicity.pickle.loads(toxicity.fit([])) is None
    assert toxicity.tagged(toxicity.Words(), ["x"], None)[0].tolist() == [0.0]


def test_forgetting_words_changes_nothing(monkeypatch):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(50)) + (" idiotic" if i % 2 else ""), i % 2)
            for i in range(80)]
    texts = [t for _, t, _ in rows]
    model = toxicity.fit(rows)
    once = toxicity.tagged(toxicity.Words(), texts, toxicity.pickle.loads(model))
    monkeypatch.setattr(toxicity, "REMEMBERED", 10)
    assert toxicity.fit(rows) == model
    words = toxicity.Words()
    parts = [toxicity.tagged(words, texts[i:i + 7], toxicity.pickle.loads(model)) for i in range(0, 80, 7)]
    assert np.concatenate([s for s, _ in parts]) == pytest.approx(once[0])
    assert sum((x for _, x in parts), []) == once[1]


def test_offsets_when_lower_case_is_longer():
    text = "İİ idiotic x"
    hit = np.array([w.startswith("idi") for w in toxicity.WORD.findall(text.lower())])
    span, = toxicity.spans(text, hit)
    assert span["end"] - span["start"] == len("idiotic")


# --- the classifier

def test_features_by_hand():
    tokens = quality.Tokens()
    words, shapes, bounds = tokens.sequences(["Aa bb bb !!", "", "bb"])
    has = [h.tolist() for _, h in quality.features(words, shapes, bounds)]
    every, two, three = [True] * 5, [False, True, True, True, False], [False, False, True, True, False]
    assert has == [every, two, every, two, three]
    index = [f for f, _ in quality.features(words, shapes, bounds)]
    assert index[0][1] == index[0][2] == index[0][4]           # the word bb
    assert index[2][1] != index[2][2]                          # its shape, the second time a repetition


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    weights = rng.standard_normal(2 * quality.DIM + 1).astype(np.float32)
    texts = ["a b c", None, "X!! y", "", "z " * 50]
    whole = quality.scores(quality.Tokens(), texts, weights)
    single = [quality.scores(quality.Tokens(), [t], weights)[0] for t in texts]
    assert whole == pytest.approx(single)


# --- both as Spark jobs

@pytest.mark.parametrize("folder,run,label,modulus,held", [
    (SF_TENTH, lambda d, l: toxicity.detect(d, l).withColumnRenamed("toxic_score", "score"), "toxic", 4, 2),
    (SF_ORACLE, quality.score, "quality", 5, 0),
])
def test_held_out_accuracy(spark, folder, run, label, modulus, held):
    labels = read(spark, folder, "labels")
    docs = read(spark, folder, "documents")
    got = {r.doc_id: r.score for r in run(docs, labels).select("doc_id", "score").collect()}
    assert len(got) == docs.count() and all(0 <= s <= 1 for s in got.values())
    known = [(got[r.doc_id], r[label]) for r in labels.collect()
             if zlib.crc32(str(r.doc_id).encode()) % modulus == held]
    ones, zeros = np.array([s for s, x in known if x == 1]), np.array([s for s, x in known if x == 0])
    better = (ones[:, None] > zeros).mean() + 0.5 * (ones[:, None] == zeros).mean()
    assert better > 0.95
    assert (ones >= 0.3).mean() > 0.92 and (zeros < 0.3).mean() > 0.97


def test_labels_of_held_out_rows_do_not_count(spark):
    docs, labels = read(spark, SF_ORACLE, "documents"), read(spark, SF_ORACLE, "labels")
    flipped = labels.withColumn("quality", F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality"))
        .otherwise(F.col("quality")))
    a, b = (quality.score(docs, x).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("run", [quality.score, toxicity.detect])
def test_odd_rows(spark, docs, empty, run):
    clash = docs.withColumn("label", F.lit(1)).withColumn("id", F.lit("x")).withColumn("score", F.lit("s"))
    none = spark.createDataFrame([], LABELS)
    some = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(30)] + [(None, 1, 1), (3, None, None)], LABELS)
    for labels in (none, some):
        assert run(clash, labels).count() == docs.count()
        assert run(empty, labels).count() == 0


def test_detect_keeps_columns(docs, spark):
    out = toxicity.detect(docs, spark.createDataFrame([], LABELS))
    assert out.columns == [*docs.columns, "toxic_score", "toxic_spans", "toxic"]
