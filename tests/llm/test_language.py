"""Language identification: kernels against plain sets, held-out accuracy, odd rows."""
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import DOCS, SF_ORACLE, SF_TENTH, docs, empty, prepared, texts  # noqa: F401
from quarry.llm import language


def plain_spectrum(text):
    words = re.sub(r"\s+", " ", " " + "".join(c if c.isalpha() else " " for c in (text or "").lower()) + " ")
    return {words[i:i + n] for n in (1, 2, 3) for i in range(len(words) - n + 1)} if words.strip() else set()


def test_spectra_and_kernels(texts, monkeypatch):
    texts = [*texts, "İstanbul ŞEHRİ", "漢字かな 123", "... 42 !!", "a", "\x00 b\n\nc", "é́"]
    monkeypatch.setattr(language, "PART", 64)                # n-grams over the borders of parts
    plain = [plain_spectrum(t) for t in texts]
    for t, s in zip(texts, plain):
        key = {sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)) for g in s}
        assert set(language.spectrum(t).tolist()) == key
    # kernels with some landmarks, through the table of n-grams and the presence matrix
    marks = [i for i, s in enumerate(plain) if s][:9]
    grams = np.unique(np.concatenate([language.spectrum(texts[i]) for i in marks]))
    present = np.array([np.isin(grams, language.spectrum(texts[i])) for i in marks]).T.astype(np.uint8)
    model = language.Model([str(i) for i in marks], grams, present, np.eye(len(marks), dtype=np.float32))
    langs, scores = language.Scorer(model).predict(texts)
    known = set().union(*(plain[i] for i in marks))
    for text, s, lang, score in zip(texts, plain, langs, scores):
        s_known = s & known
        kernels = [len(s_known & plain[i]) / max(1, math.sqrt(len(s_known) * len(plain[i]))) for i in marks]
        if not s:
            assert (lang, score) == ("und", 0)
        else:
            assert kernels[marks.index(int(lang))] == pytest.approx(max(kernels)) and score == pytest.approx(max(kernels))


def test_table_of_grams():
    rng = np.random.default_rng(1)
    known = np.unique(rng.integers(0, 1 << 62, 5000))
    table = language.Grams(known)
    asked = np.concatenate((known, rng.integers(0, 1 << 62, 5000), [0]))
    expected = {k: i for i, k in enumerate(known.tolist())}
    assert table.columns(asked).tolist() == [expected.get(k, -1) for k in asked.tolist()]


@pytest.mark.parametrize("sf_dir, least", [(SF_ORACLE, 0.98), (SF_TENTH, 0.99)])
def test_held_out_accuracy(spark, sf_dir, least):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = language.identify(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == table.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held_out) >= least * len(held_out)


def test_learns_from_no_held_out_row_and_no_other_column(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choices("abcdef" if i % 2 else "uvwxyz", k=4)) for _ in range(30)),
             "de" if i % 2 else "en", None, None) for i in range(200)]
    table = spark.createDataFrame(rows, DOCS)
    first = {(r.doc_id, r.lang_pred, r.score) for r in language.identify(table).collect()}
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    wrong = (table.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
             .withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(5)))
    assert {(r.doc_id, r.lang_pred, r.score) for r in language.identify(wrong).collect()} == first
    repeated = {(r.doc_id, r.lang_pred, r.score) for r in language.identify(table.union(table).union(table)).collect()}
    assert {r[:2] for r in repeated} == {r[:2] for r in first}


def test_odd_rows(spark, docs, empty):
    assert language.identify(empty).count() == 0
    nothing = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)} and len(nothing) == docs.count()
    clash = docs.selectExpr("doc_id AS doc", "text AS lang", "lang AS id", "1 AS key", "2 AS text", "3 AS _key")
    got = language.identify(clash, doc_id="doc", text="lang", lang="id").collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].lang_pred == by_id[1].lang_pred == by_id[2].lang_pred == "und" and by_id[3].lang_pred == "en"
    assert by_id[None].held_out is False and by_id[None].lang_pred == "en"


def test_large_landmarks_only_where_there_are_no_others(monkeypatch):
    monkeypatch.setattr(language, "LANDMARK_GRAMS", 40)
    rows = [(language.spectrum("abc " * 5 + x * k), lang) for lang, x in (("a", "xyzw"), ("b", "qrst")) for k in (1, 2, 3)]
    rows += [(language.spectrum("the quick brown fox jumps over the lazy dog and many more things"), "a")]
    model = language.fit(rows, landmarks=4)
    assert model.present.shape[1] == 4 and len(model.grams) < 60
