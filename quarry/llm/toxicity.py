"""Toxicity: a linear-chain conditional random field over the words of a text.

Labelled tokens.  Labels mark documents, so tokens are labelled first: of the
labelled sample, a word (or its first four or five letters) that is in
significantly more toxic texts than clean ones marks the tokens of *toxic* texts it
stands in; all other tokens are clean.

Model.  Two states (clean, toxic), free transitions, and for every token the
hashed features word, first 4 and 5 letters, last 4 letters, previous and next
word.  Weights maximise the conditional likelihood of the labelled tokens
(Adagrad on forward-backward gradients) and are fitted by one task on a
bounded sample (``per_label`` documents of each label); the model's size is
fixed, and it is broadcast.

Scores.  Forward-backward marginals of every token of the whole text give the
offending spans (runs of tokens with a marginal of a half or more, as
code-point offsets), and are aggregated to the document's score: a logistic
function, fitted with the model, of the largest marginal and of the expected
number of toxic tokens.

Defined results: null and empty texts have no tokens, no spans, and the score
of a text without toxic tokens; rows without an id are scored (held_out
false); without labelled rows of both kinds every score is 0; repeated rows
are scored each; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import REMEMBERED_CHARS, offsets, read
from quarry.llm.labelled import fitted, remainder, sample

WORD = re.compile(r"\w+")
DIM = 1 << 18
#: Labelled documents of each label that the model is fitted on, at most.
PER_LABEL = 1500
#: Documents that go through forward-backward together (about so many tokens).
TOGETHER = 1 << 19
#: Distinct words that a task remembers.
REMEMBERED = 1 << 17


def _stems(word: str) -> tuple[str, ...]:
    return (word, "4" + word[:4], "5" + word[:5]) if len(word) > 5 else (
        (word, "4" + word[:4]) if len(word) > 4 else (word,))


class Words(dict):
    """Word -> index; own features and neighbour hashes by index."""

    def __init__(self):
        super().__init__()
        self.own: list[tuple[int, ...]] = []
        self.held = 0

    def __missing__(self, word: str) -> int:
        def h(kind: str, part: str) -> int:
            return xxhash.xxh3_64_intdigest((kind + part).encode("utf-8", "surrogatepass")) % DIM

        self[word] = at = len(self.own)
        self.held += len(word)
        self.own.append((h("w", word), h("4", word[:4]), h("5", word[:5]), h("e", word[-4:]),
                         h("p", word), h("n", word)))
        return at

    def forget(self, most: int) -> None:
        """Start anew once more than ``most`` words, or words of too many
        characters, are known: indices given before are void then."""
        if len(self) > most or self.held > REMEMBERED_CHARS:
            self.clear()
            self.own, self.held = [], 0

    def sequences(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word index of every token, bounds of the texts, and the features of
        all words known (columns 0-3 its own, 4 and 5 as a neighbour)."""
        parts = []
        for text in texts:
            found = WORD.findall((text or "").lower())
            parts.append(np.fromiter(map(self.__getitem__, found), np.int64, len(found)))
        bounds = offsets(np.fromiter(map(len, parts), np.int64, len(parts)))
        at = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return at, bounds, np.array(self.own, np.int64).reshape(-1, 6)


def emissions(at: np.ndarray, bounds: np.ndarray, table: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Log-odds of the toxic state of every token, before its neighbours' states."""
    s = w[table[:, :4]].sum(axis=1)[at] + w[DIM]
    if len(at):
        edge = np.zeros(len(at) + 1, bool)
        edge[bounds] = True
        inner = ~edge[1:-1]
        s[1:][inner] += w[table[:, 4]][at[:-1]][inner]
        s[:-1][inner] += w[table[:, 5]][at[1:]][inner]
    return np.clip(s, -30, 30)


def forward_backward(s: np.ndarray, bounds: np.ndarray, trans: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of the toxic state of every token, and the expected number of
    transitions (2 x 2) over all texts.  Texts advance together, longest first;
    messages are normalised at every step."""
    m = np.exp(trans - trans.max())
    odds = np.exp(s)
    length = np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    start = bounds[:-1][order]
    # texts that still have a token at each step
    active = np.searchsorted(-length[order], -np.arange(length.max(initial=0)), side="left")
    alpha = np.empty((2, len(s)))
    beta = np.empty((2, len(s)))
    p0 = p1 = None
    for t, k in enumerate(active):
        i = start[:k] + t
        if t == 0:
            a0, a1 = np.ones(k), odds[i]
        else:
            a0 = p0[:k] * m[0, 0] + p1[:k] * m[1, 0]
            a1 = (p0[:k] * m[0, 1] + p1[:k] * m[1, 1]) * odds[i]
        z = a0 + a1
        p0, p1 = a0 / z, a1 / z
        alpha[0, i], alpha[1, i] = p0, p1
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        i = start[:k] + t
        b0, b1 = np.ones(k), np.ones(k)
        following = active[t + 1] if t + 1 < len(active) else 0
        if following:
            j = i[:following] + 1
            n0, n1 = beta[0, j], beta[1, j] * odds[j]
            b0[:following] = m[0, 0] * n0 + m[0, 1] * n1
            b1[:following] = m[1, 0] * n0 + m[1, 1] * n1
        z = b0 + b1
        beta[0, i], beta[1, i] = b0 / z, b1 / z
    c0, c1 = alpha[0] * beta[0], alpha[1] * beta[1]
    pairs = np.zeros((2, 2))
    if len(s) > 1:
        edge = np.zeros(len(s) + 1, bool)
        edge[bounds] = True
        i = np.flatnonzero(~edge[1:-1])
        x = np.stack([alpha[a, i] * m[a, b] * beta[b, i + 1] * (odds[i + 1] if b else 1.0)
                      for a in (0, 1) for b in (0, 1)])
        pairs = (x / x.sum(axis=0)).sum(axis=1).reshape(2, 2)
    return c1 / (c0 + c1), pairs


def marking_stems(texts: list[str], labels: list[int], ratio: float = 4.0, deviations: float = 5.0
                  ) -> set[str]:
    """Stems that are in ``ratio`` times as many toxic texts as clean ones (in
    three at least, and in a hundredth of them), by a difference of more than
    ``deviations`` standard deviations."""
    toxic, clean = Counter(), Counter()
    for text, label in {(t, x) for t, x in zip(texts, labels)}:      # equal texts count once
        stems = {s for w in set(WORD.findall(text.lower())) for s in _stems(w)}
        (toxic if label else clean).update(stems)
    n_toxic, n_clean = max(1, sum(labels)), max(1, len(labels) - sum(labels))

    def marks(stem: str, k: int) -> bool:
        c = clean[stem]
        if k < max(3, 0.01 * n_toxic) or k / n_toxic <= ratio * (c + 0.5) / n_clean:
            return False
        p = (k + c) / (n_toxic + n_clean)
        return (k / n_toxic - c / n_clean) > deviations * np.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_clean))

    return {s for s, k in toxic.items() if marks(s, k)}


def fit(rows: list[tuple], steps: int = 50, rate: float = 0.3, decay: float = 1e-6, seed: int = 3
        ) -> bytes:
    """The pickled model (weights, transitions, score coefficients)."""
    texts, labels = [t or "" for _, t, _ in rows], [x for _, _, x in rows]
    if not 0 < sum(labels) < len(labels):
        return pickle.dumps(None)
    marks = marking_stems(texts, labels)
    words = Words()
    w, trans = np.zeros(DIM + 1), np.array([[1.0, -1.0], [0.0, 0.0]])
    w[DIM] = -3.0
    square, square_t = np.full(DIM + 1, 1e-8), np.full((2, 2), 1e-8)
    sizes = [len(t) for t in texts]
    order = sorted(range(len(texts)), key=lambda i: -sizes[i])
    n = max(min(20, len(order)), len(order) // 100)
    batches = [order[i::n] for i in range(n)]
    known = [words.sequences([texts[i] for i in b])[:2] for b in batches]
    table = np.array(words.own, np.int64).reshape(-1, 6)
    marked = np.fromiter((any(s in marks for s in _stems(x)) for x in words), bool, len(words))
    rng = np.random.default_rng(seed)
    for _ in range(-(-steps // n)):
        for k in rng.permutation(len(batches)).tolist():
            at, bounds = known[k]
            if not len(at):
                continue
            toxic = np.repeat(np.array([labels[i] == 1 for i in batches[k]]), np.diff(bounds))
            y = marked[at] & toxic
            p, pairs = forward_backward(emissions(at, bounds, table, w), bounds, trans)
            g = p - y
            own = np.bincount(at, g, len(table))
            edge = np.zeros(len(at) + 1, bool)
            edge[bounds] = True
            inner = ~edge[1:-1]
            after = np.bincount(at[:-1][inner], g[1:][inner], len(table))
            ahead = np.bincount(at[1:][inner], g[:-1][inner], len(table))
            grad = np.bincount(table.ravel(), np.column_stack([own] * 4 + [after, ahead]).ravel(), DIM + 1)
            grad[DIM] = g.sum()
            grad = grad / len(batches[k]) + decay * w
            i, j = y[:-1][inner].astype(int), y[1:][inner].astype(int)
            seen = np.bincount(2 * i + j, minlength=4).reshape(2, 2)
            grad_t = (pairs - seen) / len(batches[k])
            square += grad * grad
            square_t += grad_t * grad_t
            w -= rate * grad / np.sqrt(square)
            trans = np.clip(trans - rate * grad_t / np.sqrt(square_t), -8, 8)
    facts = np.concatenate([text_facts(*known[k], table, w, trans) for k in range(len(batches))])
    y = np.array([labels[i] for b in batches for i in b], float)
    x = np.column_stack([np.ones(len(facts)), facts])
    c = np.zeros(x.shape[1])
    for _ in range(30):                                   # Newton steps, lightly damped
        q = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        h = x.T @ (x * (q * (1 - q))[:, None]) + 0.05 * np.eye(x.shape[1])
        c -= np.linalg.solve(h, x.T @ (q - y) + 0.05 * c)
    return pickle.dumps((w.astype(np.float32), trans, c))


def text_facts(at: np.ndarray, bounds: np.ndarray, table: np.ndarray, w: np.ndarray,
               trans: np.ndarray) -> np.ndarray:
    return aggregate(forward_backward(emissions(at, bounds, table, w), bounds, trans)[0], bounds)


def aggregate(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: the largest marginal, and log(1 + the sum of those of 0.1 or more)."""
    out = np.zeros((len(bounds) - 1, 2))
    full = np.diff(bounds) > 0
    if full.any():
        at = bounds[:-1][full]
        out[full, 0] = np.maximum.reduceat(p, at)
        out[full, 1] = np.log1p(np.add.reduceat(np.where(p >= 0.1, p, 0), at))
    return out


def spans(text: str, toxic: np.ndarray) -> list[dict[str, int]]:
    """Runs of toxic tokens as code-point offsets (the end is exclusive).
    Lower-casing may lengthen a text, so tokens are counted, not characters."""
    out: list[dict[str, int]] = []
    found = list(WORD.finditer(text))
    if len(found) != len(toxic):                          # lower-casing changed the word borders
        found = list(WORD.finditer(text.lower()))
    last = -2
    for i in np.flatnonzero(toxic).tolist():
        if i == last + 1 and out:
            out[-1]["end"] = found[i].end()
        else:
            out.append({"start": found[i].start(), "end": found[i].end()})
        last = i
    return out


def tagged(words: Words, texts: list[str | None], model) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores and offending spans of texts."""
    if model is None:
        return np.zeros(len(texts)), [[] for _ in texts]
    w, trans, c = model
    words.forget(REMEMBERED)
    at, bounds, table = words.sequences(texts)
    p, _ = forward_backward(emissions(at, bounds, table, w), bounds, trans)
    score = 1 / (1 + np.exp(-np.clip(c[0] + aggregate(p, bounds) @ c[1:], -35, 35)))
    hit = p >= 0.5
    count = np.r_[0, np.cumsum(hit)]
    found = [spans(t, hit[a:b]) if count[b] > count[a] else []
             for t, a, b in zip(texts, bounds, bounds[1:])]
    return score, found


def detect(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4,
           held_out: int = 2, threshold: float = 0.3, per_label: int = PER_LABEL,
           doc_id: str = "doc_id", text: str = "text",
           names: tuple[str, str, str] = ("toxic_score", "toxic_spans", "toxic")) -> DataFrame:
    """``docs`` with its score, offending spans and whether score >= threshold,
    as ``names``; input columns of these names are replaced."""
    spark = docs.sparkSession
    known = sample(docs, labels, label, modulus, held_out, per_label, doc_id, text)
    model = spark.sparkContext.broadcast(fitted(known, fit))
    score_name, spans_name, toxic_name = names
    kept = docs.drop(*names)
    schema = kept.select("*", F.lit(0.0).alias(score_name), F.lit(None).cast(
        "array<struct<start:int,end:int>>").alias(spans_name)).schema
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted_model, words = pickle.loads(model.value), Words()
        for batch in batches:
            for part in _together(batch, text):
                score, found = tagged(words, part.column(text).to_pylist(), fitted_model)
                yield part.append_column(score_name, pa.array(score)).append_column(
                    spans_name, pa.array(found, kind))

    return kept.mapInArrow(run, schema).withColumn(toxic_name, F.col(score_name) >= threshold)


def _together(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Rows of about TOGETHER tokens (six bytes each) of text."""
    import pyarrow.compute as pc

    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)).astype(np.int64)
    block = np.cumsum(size) // (6 * TOGETHER)
    cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def op4_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return detect(docs, read(spark, sf_dir, "labels")).select(
        "doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.col("toxic_score").alias("score"), F.col("toxic").cast("int").alias("predicted"))
