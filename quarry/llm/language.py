"""Language identification by string kernels.

A text is lower-cased and every run of characters that are no letters becomes
one space; its *spectrum* is the set of its n-grams of one to ``ORDER``
characters.  The kernel of two texts is the number of n-grams present in both
(a blended-spectrum presence kernel), divided by the root of the product of
their own spectra's sizes.

Training takes a bounded sample of labelled rows.  ``landmarks`` of them, dealt
evenly to the languages, span the Nyström approximation: with K the kernel of
the sample against the landmarks and M that among the landmarks, one ridge
regression per language against all others solves
``(K'K + ridge * n * M) w = K'y``, y being 1 for rows of the language and 0
for the others.

Scoring marks the n-grams of a batch of whole texts in a presence matrix, one
column per n-gram that a landmark holds; its product with the landmarks' own
presence matrix gives the kernels, whose product with the weights gives
a value per text and language.  The highest wins (ties: the smallest language),
and its value, cut to 0 to 1, is the score.  N-grams that no landmark holds
match nothing; they are left out of a text's spectrum size as well.

Defined results: texts that are null or have no letter are ``und`` with score
0, also if nothing was learned; where nothing was learned every other text is
``und`` too; rows without an id are predicted (held_out false) and are learned
from no more than held-out ones; rows that repeat are predicted each; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import offsets, read, store
from quarry.llm.labelled import remainder

#: Longest n-grams of the spectrum; three characters fit one 64-bit key.
ORDER = 3
#: Labelled rows of a language that are learned from, and languages (the most frequent), at most.
PER_LANGUAGE, LANGUAGES = 300, 100
#: Landmarks of all languages together; rows with more n-grams are taken only
#: where a language has no others (then those with the fewest), which bounds the columns.
LANDMARKS, LANDMARK_GRAMS = 192, 4000
RIDGE = 1e-4
#: Characters that are looked up at a time; longer texts are taken in parts.
PART = 1 << 19
#: Presence matrix entries of a batch.
CELLS = 1 << 22

UNKNOWN = "und"
#: Beyond the last code point, of 21 bits as well.
_BETWEEN = np.array([0x1FFFFF], np.uint32)


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


_LETTERS: np.ndarray | None = None


def normalised(text: str | None) -> np.ndarray:
    """Code points of the text between spaces; empty if it has no letter."""
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = np.pad(np.where(letters()[chars], chars, np.uint32(32)), 1, constant_values=32)
    space = chars == 32
    keep = ~space
    keep[1:] |= ~space[:-1]                  # a space behind a letter
    keep[0] = True
    chars = chars[keep]
    return chars if len(chars) > 1 else chars[:0]


def keys(chars: np.ndarray) -> Iterator[np.ndarray]:
    """Per length the n-grams that begin at each character, 21 bits a character."""
    key = chars = chars.astype(np.int64)
    for n in range(1, ORDER + 1):
        yield key
        if len(key) < 2:
            return
        key = key[:-1] << 21 | chars[n:]


def spectrum(text: str | None) -> np.ndarray:
    """The distinct n-grams of a whole text, sorted."""
    chars = normalised(text)
    found = [np.zeros(0, np.int64)]
    for at in range(0, len(chars), PART):
        found.append(np.unique(np.concatenate([*keys(chars[at:at + PART + ORDER - 1])])))
    return np.unique(np.concatenate(found))


class Grams:
    """Hash table from an n-gram's key to its column, -1 for any other."""

    def __init__(self, known: np.ndarray):
        self.bits = max(12, int(4 * len(known)).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.column = np.full(1 << self.bits, -1, np.int32)
        for column, key in enumerate(known.tolist()):
            at = int(self._slot(np.array([key]))[0])
            while self.key[at] >= 0:
                at = (at + 1) % len(self.key)
            self.key[at], self.column[at] = key, column

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def columns(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = self.column[at]
        held = self.key[at]
        out[held != keys] = -1
        open_ = np.flatnonzero((held != keys) & (held >= 0))     # another key's place: look on
        at = at[open_]
        while len(open_):
            at = (at + 1) % len(self.key)
            want, held = keys[open_], self.key[at]
            out[open_[held == want]] = self.column[at[held == want]]
            going = (held != want) & (held >= 0)
            open_, at = open_[going], at[going]
        return out


class Model(NamedTuple):
    languages: list[str]
    grams: np.ndarray        # keys of the columns
    present: np.ndarray      # columns x landmarks, 0 or 1
    weights: np.ndarray      # landmarks x languages


def kernel(presence: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised kernels of rows of 0 and 1 with the landmarks (columns x landmarks)."""
    size = np.sqrt(np.outer(presence.sum(1), landmarks.sum(0)))
    return (presence @ landmarks) / np.maximum(size, 1)


def fit(rows: list[tuple[np.ndarray, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """A model of (spectrum, language) rows; their order decides which are landmarks."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return None
    own = {lang: [s for s, x in rows if x == lang] for lang in languages}
    each = [sorted(own[lang], key=lambda s: max(len(s), LANDMARK_GRAMS))[:max(1, landmarks // len(languages))]
            for lang in languages]
    chosen = [s for part in each for s in part]
    grams = np.unique(np.concatenate(chosen))

    def presence(spectra: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(spectra), len(grams)), np.float32)
        for k, s in enumerate(spectra):
            out[k, np.searchsorted(grams, np.intersect1d(s, grams, assume_unique=True))] = 1
        return out

    present = presence(chosen).T
    m = kernel(present.T, present).astype(np.float64)
    left, right = np.zeros_like(m), np.zeros((len(chosen), len(languages)))
    step = max(1, CELLS // len(grams))
    for k, lang in enumerate(languages):
        weight = 1 / len(own[lang])              # languages count alike, however many rows they have
        for at in range(0, len(own[lang]), step):
            part = kernel(presence(own[lang][at:at + step]), present).astype(np.float64)
            left += weight * (part.T @ part)
            right[:, k] += weight * part.sum(0)
    left += ridge * len(languages) * m + 1e-9 * np.eye(len(m))
    return Model(languages, grams, present.astype(np.uint8), np.linalg.solve(left, right).astype(np.float32))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.grams = model, Grams(model.grams)
        self.present = model.present.astype(np.float32)
        self.rows = max(1, CELLS // len(model.grams))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        langs, scores = [], []
        for at in range(0, len(texts), self.rows):
            part = [normalised(t) for t in texts[at:at + self.rows]]
            presence = np.zeros((len(part), len(self.model.grams)), np.float32)
            for row, column in self._found(part):
                presence[row, column] = 1
            values = kernel(presence, self.present) @ self.model.weights
            best = values.argmax(1)
            some = np.fromiter(map(len, part), np.int64, len(part)) > 0
            langs += [self.model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), some.tolist())]
            scores.append(np.where(some, np.clip(values[np.arange(len(part)), best], 0, 1), 0))
        return langs, np.concatenate(scores) if scores else np.zeros(0)

    def _found(self, texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and columns of the n-grams of texts, which are taken together
        (a mark between them that no key holds) in parts."""
        joined = np.concatenate([x for t in texts for x in (t, _BETWEEN)])
        ends = offsets(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        for at in range(0, len(joined), PART):
            chars = joined[at:at + PART + ORDER - 1]
            row = np.searchsorted(ends, np.arange(at, at + len(chars)), side="right") - 1
            for key in keys(chars):
                column = self.grams.columns(key)
                has = column >= 0
                yield row[:len(key)][has], column[has]


def sample(docs: DataFrame, modulus: int, held_out: int, per_language: int, languages: int,
           doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, spectrum, lang) of at most ``per_language`` rows of each of the
    ``languages`` most frequent languages, by the hash of id and text.

    Chosen are hashes of (id, text, lang), one for rows that repeat.  A language
    with n of them sends those to the ranking whose draw is below four times the
    share that is wanted, so that a ranking takes a few ``per_language`` of
    them, however large the table; the chosen (``per_language * languages`` at
    most) are broadcast.  Only spectra are collected, in place of texts.
    """
    rows = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
            .where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                   & (remainder("id", modulus) != held_out)))
    key = F.xxhash64("id", "text", "lang")
    narrow = store(rows.select("lang", key.alias("key")).distinct(), "labelled")
    common = (narrow.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
              .limit(languages).withColumnRenamed("lang", "_lang"))
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    order = Window.partitionBy("lang").orderBy(draw, "key")
    chosen = (narrow.join(F.broadcast(common), F.col("lang") == F.col("_lang"))
              .where(draw < F.lit(4.0 * per_language * (1 << 30)) / F.col("n"))
              .withColumn("at", F.row_number().over(order)).where(F.col("at") <= per_language)
              .select(F.col("key").alias("_key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spectra = [spectrum(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"key": batch.column("key"), "lang": batch.column("lang"),
                                   "spectrum": pa.array(spectra, pa.list_(pa.int64()))})

    found = rows.withColumn("key", key).join(F.broadcast(chosen), F.col("key") == F.col("_key")).select("key", "lang", "text")
    return (found.mapInArrow(run, "key long, lang string, spectrum array<long>")
            .groupBy("key", "lang").agg(F.first("spectrum").alias("spectrum")))


def fitted(rows: DataFrame, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """The model of a bounded sample (key, lang, spectrum), fitted by one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for b in batches:
            spectra = b.column("spectrum")
            ends = spectra.offsets.to_numpy()
            values = spectra.values.to_numpy()
            got += [(key, lang, values[s:e].copy()) for key, lang, s, e in zip(
                b.column("key").to_pylist(), b.column("lang").to_pylist(), ends, ends[1:]) if e > s]
        got.sort(key=lambda row: row[:2])
        model = fit([(s, lang) for _, lang, s in got], landmarks, ridge)
        yield pa.record_batch({"model": pa.array([pickle.dumps(model)], pa.binary())})

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(found[0].model)) if found else None


def predict(docs: DataFrame, model: Model | None, modulus: int = 3, held_out: int = 1,
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value else None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column("text").to_pylist()
                langs, scores = scorer.predict(texts) if scorer else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                yield pa.record_batch({"doc": part.column("doc"), "lang_pred": pa.array(langs, pa.string()),
                                       "score": pa.array(scores, pa.float64())})

    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc"]
    return rows.mapInArrow(run, f"doc {kind}, lang_pred string, score double").select(
        F.col("doc").alias("doc_id"),
        F.coalesce(remainder("doc", modulus) == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame, modulus: int = 3, held_out: int = 1, per_language: int = PER_LANGUAGE,
             languages: int = LANGUAGES, landmarks: int = LANDMARKS, ridge: float = RIDGE,
             doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    known = sample(docs, modulus, held_out, per_language, languages, doc_id, text, lang)
    return predict(docs, fitted(known, landmarks, ridge), modulus, held_out, doc_id, text)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
