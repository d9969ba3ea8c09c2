import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs, empty, prepared, texts  # noqa: F401
from quarry.llm import substrings, suffixes
from quarry.llm.suffixes import Space, suffix_array


def naive(text):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while a + k < len(text) and b + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        lcp.append(k)
    return order, lcp


@pytest.mark.parametrize("memory", [3, 1 << 20])           # with and without files
@pytest.mark.parametrize("letters", [512, 2])              # names solved by induction, by doubling
def test_suffix_arrays(memory, letters, monkeypatch):
    monkeypatch.setattr(suffixes, "LETTERS", letters)
    rng = np.random.default_rng(0)
    for turn in range(150):
        n, letters = int(rng.integers(1, 100)), int(rng.integers(1, 5))
        text = rng.integers(1, letters + 1, n)
        if turn % 3 == 0:
            unit = rng.integers(1, 3, 20)
            text = np.concatenate([unit[:int(rng.integers(1, 20))] for _ in range(8)])
        text = np.append(text, 0)
        order, lcp = suffix_array(text, 1000, memory)
        assert (order.tolist(), lcp.tolist()) == naive(text.tolist())


def test_a_text_far_larger_than_memory():
    """What the sort holds follows from ``memory``, not from the text."""
    rng = np.random.default_rng(3)
    base = rng.integers(2, 60, 150_000)
    text = np.concatenate([base, rng.integers(2, 60, 250_000), base[500:100_000], [0]]).astype(np.uint16)
    spaces, peaks, found = [Space(1 << 22), Space(1 << 13)], [], []
    for space in spaces:
        tracemalloc.start()
        order, lcp = suffix_array(text, 400, space=space)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        found.append(lcp)
        assert (np.sort(order) == np.arange(len(text))).all()
        a, b = order[:-1], order[1:]
        assert (suffixes.common(text, a, b, 400) == lcp[1:]).all()
        first = np.minimum(np.maximum(a, b) + lcp[1:], len(text) - 1) - np.maximum(a, b)
        assert ((text[a + first] < text[b + first]) | (lcp[1:] == 400)).all()
    assert (found[0] == found[1]).all()
    assert spaces[0].on_disk == spaces[0].spilled == 0
    assert spaces[1].on_disk > 20 * len(text) and spaces[1].spilled > len(text)
    assert peaks[1] < 2 << 20 < 16 << 20 < peaks[0]


def test_sort_in_runs():
    rng = np.random.default_rng(5)
    for memory in (1, 7, 64, 5000):
        key = rng.integers(0, 50, 1000)
        got_key, got = Space(memory).sort(key, np.arange(1000))
        assert (got_key == np.sort(key)).all() and (key[got] == got_key).all() and len(set(got.tolist())) == 1000


def brute(rows, length):
    count = Counter(b[i:i + length] for _, b in rows for i in range(len(b) - length + 1))
    out = []
    for doc, b in rows:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((doc, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


def digest(df, **how):
    got = substrings.remove_repeats(df, **how).select("row.*", "kept", "spans").collect()
    return sorted(((r.doc_id, len((r.text or "").encode()), sum(s.end - s.start for s in r.spans),
                    len(r.spans), bytes(r.kept)) for r in got), key=str)


@pytest.mark.parametrize("how", [
    {"length": 400}, {"length": 60, "gram": 16}, {"length": 60, "gram": 16, "crowd": 1},
    {"length": 24, "gram": 8}, {"length": 60, "gram": 16, "shard": 1 << 40, "memory": 5000},
    {"length": 60, "gram": 16, "shard": 1},
])
def test_against_brute_force(docs, how):
    clash = docs.withColumn("doc", F.lit("x")).withColumn("body", F.lit(None))
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    assert digest(clash, **how) == brute(rows, how["length"])


def test_shuffled_when_documents_are_many(docs, monkeypatch):
    want = digest(docs, length=60, gram=16)
    monkeypatch.setattr(substrings, "FEW", 0)
    assert digest(docs, length=60, gram=16) == want


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "LONGEST", 500)
    rng = np.random.default_rng(1)
    a, b = (bytes(rng.integers(97, 123, 3000)).decode() for _ in "ab")
    df = spark.createDataFrame([(1, a), (2, b + a[400:1800] + b[:10]), (3, a[::-1])], "doc_id long, text string")
    rows = [(r.doc_id, r.text.encode()) for r in df.collect()]
    assert digest(df, length=100, gram=16) == brute(rows, 100)


def test_cut_documents_keeps_whole_characters(docs, empty):
    out = substrings.cut_documents(docs, length=60, gram=16)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("n_chars <> char_length(text)").count() == 0
    assert substrings.cut_documents(empty).count() == 0


def test_digest_of_kept_bytes():
    kept, spans = substrings._cut(b"0123456789", [(2, 4), (3, 5), (5, 6), (8, 9)])
    assert kept == b"01679" and spans == [{"start": 2, "end": 6}, {"start": 8, "end": 9}]


def test_query_leaves_passages_of_under_400_bytes(spark, tmp_path):
    """A passage of over 50 words that documents share is cut from 400 bytes on, however many words it has."""
    rng = np.random.default_rng(9)

    def words(n, size=5):
        return " ".join(bytes(rng.integers(97, 123, size, np.uint8)).decode() for _ in range(n))

    shared = [words(59), words(66) + " xyz", words(66) + " wxyz", words(90), words(40, 9)]
    assert [len(p) for p in shared] == [353, 399, 400, 539, 399]
    rows = [(10 * k + i, f"{words(70)} {i}{p}{i} {words(70)}") for k, p in enumerate(shared) for i in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = substrings.op10_suffix_dedup(spark, str(tmp_path)).collect()
    want = brute([(doc, text.encode()) for doc, text in rows], 400)
    assert sorted((tuple(r) for r in got), key=str) == [
        (*row, hashlib.sha256(kept).hexdigest()) for *row, kept in want]
    assert {r.doc_id: r.n_removed for r in got} == {
        10 * k + i: n for k, n in enumerate([0, 0, 400, 539, 0]) for i in range(3)}
