import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs, empty, prepared, texts  # noqa: F401
from quarry.llm import near_embeddings, shingle_join
from quarry.llm.components import components


def classes(n, pairs):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- connected components

@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)],                      # a chain
    [(0, i) for i in range(1, 80)],                       # a star
    [(5, 5), (1, 2), (2, 1), (1, 2), (7, 9), (9, 8), (None, 3)],
    [],
])
def test_components(spark, edges):
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    pairs = [(a, b) for a, b in edges if None not in (a, b) and a != b]
    want = classes(100, pairs)
    assert dict(got.collect()) == {x: want[x] for e in pairs for x in e}


# --- embeddings

def brute_vectors(rows, threshold=0.9):
    good = [i for i, (v_id, v) in enumerate(rows) if v_id is not None and v and None not in v
            and all(math.isfinite(x) for x in v) and any(v)]
    links, pairs = [0] * len(rows), []
    for x, i in enumerate(good):
        for j in good[x + 1:]:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    label = classes(len(rows), pairs)
    low = defaultdict(list)
    for i, c in enumerate(label):
        low[c].append(rows[i][0])
    return sorted(((rows[i][0], links[i], min(low[c]) if rows[i][0] is not None else None)
                   for i, c in enumerate(label)), key=str)


@pytest.fixture(scope="module")
def vector_rows():
    rng = np.random.default_rng(2)
    f = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, f(rng.standard_normal(16))) for i in range(150)]
    centre = rng.standard_normal(16)
    rows += [(200 + i, f(centre + 0.15 * rng.standard_normal(16))) for i in range(60)]
    rows += [(300 + i, f(centre)) for i in range(20)]                     # equal vectors
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [None] + [1.0] * 15),
             (404, [math.nan] + [1.0] * 15), (405, [math.inf] + [1.0] * 15), (None, f(centre)),
             (406, f(centre[:8])), (407, f(2 * centre)), (300, f(centre))]
    return rows


@pytest.mark.parametrize("block", [1024, 16])
def test_embeddings_against_brute_force(spark, vector_rows, monkeypatch, block):
    monkeypatch.setattr(near_embeddings, "BLOCK", block)
    df = spark.createDataFrame(vector_rows, "vec_id long, embedding array<float>")
    got = near_embeddings.near_duplicates(df.withColumn("u", F.lit("clash")), recall=0.9999).collect()
    want = brute_vectors(vector_rows)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_no_embeddings(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_embeddings.near_duplicates(df).count() == 0


# --- shingles

def brute_texts(rows, n=5, threshold=0.8):
    sets = []
    for _, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        k = min(n, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    links, pairs = [0] * len(rows), []
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    label = classes(len(rows), pairs)
    low = {c: min(rows[i][0] for i in range(len(rows)) if label[i] == c) for c in label}
    return sorted((rows[i][0], links[i], low[label[i]]) for i in range(len(rows)))


@pytest.mark.parametrize("block", [512, 8])
def test_texts_against_brute_force(spark, docs, monkeypatch, block):
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    rng = random.Random(3)
    base = [str(rng.random()) for _ in range(150)]
    near = []
    for i in range(60):                                    # a group of near copies
        w = list(base)
        w[rng.randrange(150)] = f"edit{i}"
        near.append((1000 + i, " ".join(w), None, None, None))
    df = docs.unionByName(spark.createDataFrame(near, docs.schema)).withColumn("bands", F.lit(1))
    rows = [(r.doc_id, r.text) for r in df.collect() if r.doc_id is not None]
    got = shingle_join.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in got) == brute_texts(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_an_id_with_two_texts(spark):
    rng = random.Random(9)
    a, b = (" ".join(str(rng.random()) for _ in range(50)) for _ in "ab")
    df = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b + " end"), (1, a)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_links, r.class_id) for r in shingle_join.near_duplicates(df).collect())
    assert got == [(1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 1, 1)]


def test_one_per_group(docs, empty):
    rows = shingle_join.one_per_group(docs).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and None in ids and {0, 1, 2, 3, 4, 5} <= set(ids)
    assert not {6, 7, 8} & set(ids)
    assert shingle_join.one_per_group(empty).count() == 0
