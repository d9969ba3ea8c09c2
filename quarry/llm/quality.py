"""Quality scores: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader (FTRL-proximal), scored as sparse dot products.

A text is cut into tokens (runs of word characters, runs of other marks).
N-grams are taken over two views of the token sequence -- the lower-cased
tokens (1- and 2-grams) and their shapes (1- to 3-grams; a shape tells case,
digits, marks and whether the token repeats the one before) -- and hashed into
``DIM`` features per view family; a feature's value is its share of the
text's tokens times ``SCALE``.  Scoring adds up the weights of all n-grams of
the whole text.

The model is fitted by one task on a bounded sample (``per_label`` documents
of each label); its size is fixed, and it is broadcast.

Defined results: null and empty texts have no features and get the intercept's
score; rows without an id are scored (held_out false); without labelled
rows every score is 0.5; repeated rows are scored each; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import REMEMBERED_CHARS, offsets, read
from quarry.llm.labelled import fitted, remainder, sample

TOKEN = re.compile(r"\w+|[^\w\s]+")
DIM = 1 << 18
SCALE = 8.0
#: Labelled documents of each label that the model is fitted on, at most.
PER_LABEL = 4000
#: Distinct tokens that a task remembers.
REMEMBERED = 1 << 18

_A = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - 18)


def shape(token: str) -> int:
    """0 lower case, 1 capitalised, 2 upper case, 3 digits, 4 mixed, 5 marks."""
    if not (token[0].isalnum() or token[0] == "_"):
        return 5
    if token.isdigit():
        return 3
    if token.islower():
        return 0
    if token.isupper():
        return 2 if len(token) > 1 else 1
    return 1 if token[0].isupper() and token[1:].islower() else 4


class Tokens(dict):
    """Token -> index into arrays of word hashes and shapes."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []
        self.shapes: list[int] = []
        self.held = 0

    def __missing__(self, token: str) -> int:
        self[token] = at = len(self.hashes)
        self.held += len(token)
        self.hashes.append(xxhash.xxh3_64_intdigest(token.lower().encode("utf-8", "surrogatepass")))
        self.shapes.append(shape(token))
        return at

    def sequences(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes and shapes of all tokens, and the texts' bounds."""
        if len(self) > REMEMBERED or self.held > REMEMBERED_CHARS:
            self.clear()
            self.hashes, self.shapes, self.held = [], [], 0
        parts = []
        for text in texts:
            tokens = TOKEN.findall(text or "")
            parts.append(np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens)))
        at = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        bounds = offsets(np.fromiter(map(len, parts), np.int64, len(parts)))
        return (np.array(self.hashes, np.uint64)[at], np.array(self.shapes, np.uint64)[at], bounds)


def features(words: np.ndarray, shapes: np.ndarray, bounds: np.ndarray
             ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram, the feature of every token's n-gram and which
    tokens have one (n-grams do not cross texts)."""
    first = np.zeros(len(words) + 1, bool)
    first[bounds[:-1]] = True
    first = first[:-1]
    every = np.ones(len(words), bool)
    before = np.roll(words, 1)
    repeats = (words == before) & ~first
    shapes = shapes * np.uint64(2) + repeats
    second = np.roll(first, 1) | first
    if len(first):
        second[0] = True

    def hashed(kind: int, *parts: np.ndarray) -> np.ndarray:
        h = np.full(len(words), kind, np.uint64)
        for p in parts:
            h = (h ^ p) * _A
            h ^= h >> np.uint64(32)
        return ((h * _A) >> _SHIFT).astype(np.int64)

    yield hashed(1, words), every
    yield hashed(2, before, words), ~first
    yield DIM + hashed(3, shapes), every
    yield DIM + hashed(4, np.roll(shapes, 1), shapes), ~first
    yield DIM + hashed(5, np.roll(shapes, 2), np.roll(shapes, 1), shapes), ~second


def ftrl(rows: list[tuple], alpha: float = 0.2, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5,
         passes: int = 3, seed: int = 5) -> np.ndarray:
    """Weights (float32, the last is the intercept) fitted to (id, text, label)."""
    z, n = np.zeros(2 * DIM + 1), np.zeros(2 * DIM + 1)
    tokens, examples = Tokens(), []
    for at in range(0, len(rows), 500):
        part = rows[at:at + 500]
        words, shapes, bounds = tokens.sequences([text for _, text, _ in part])
        found = [(f[has], np.flatnonzero(has)) for f, has in features(words, shapes, bounds)]
        for a, b, (_, _, label) in zip(bounds, bounds[1:], part):
            own = [f[slice(*np.searchsorted(at_token, (a, b)))] for f, at_token in found]
            index, count = np.unique(np.concatenate(own), return_counts=True)
            examples.append((np.append(index, 2 * DIM),
                             np.append(count * (SCALE / max(1, b - a)), 1.0), label))

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        w = (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for k in rng.permutation(len(examples)).tolist():
            i, x, label = examples[k]
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            square = n[i] + g * g
            z[i] += g - (np.sqrt(square) - np.sqrt(n[i])) / alpha * w
            n[i] = square
    return weights(np.arange(2 * DIM + 1)).astype(np.float32)


def scores(tokens: Tokens, texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    words, shapes, bounds = tokens.sequences(texts)
    total = np.zeros(len(words))
    for index, has in features(words, shapes, bounds):
        total += np.where(has, weights[index], 0)
    sums = np.r_[0.0, np.cumsum(total)]
    sums = sums[bounds[1:]] - sums[bounds[:-1]]
    size = np.maximum(np.diff(bounds), 1)
    return 1 / (1 + np.exp(-np.clip(weights[-1] + SCALE * sums / size, -35, 35)))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5,
          held_out: int = 0, threshold: float = 0.3, per_label: int = PER_LABEL,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    spark = docs.sparkSession
    known = sample(docs, labels, label, modulus, held_out, per_label, doc_id, text)
    model = spark.sparkContext.broadcast(fitted(known, lambda rows: ftrl(rows).tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, tokens = np.frombuffer(model.value, np.float32), Tokens()
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                yield pa.record_batch({"doc": part.column("doc"), "score": pa.array(
                    scores(tokens, part.column("text").to_pylist(), weights))})

    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc"]
    return rows.mapInArrow(run, f"doc {kind}, score double").select(
        F.col("doc").alias("doc_id"),
        F.coalesce(remainder("doc", modulus) == held_out, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op9_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
