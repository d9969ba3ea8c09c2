"""Rows without an id take part in the classes of near copies."""
import random

from llm_fixtures import prepared, words  # noqa: F401
from quarry.llm import shingle_join


def table(spark):
    rng = random.Random(21)
    a, b, c = (words(rng, 60) for _ in "abc")
    rows = [(4, a), (None, a), (None, a + " end"),                # copies of a document with an id
            (None, b), (None, b), (None, b + " end"),             # copies among themselves
            (0, c), (6, c + " end"), (None, None), (None, ""), (None, "")]
    return a, b, c, rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_every_row_has_its_class(spark, monkeypatch):
    a, b, c, rows, df = table(spark)
    monkeypatch.setattr(shingle_join, "read", lambda *_: df)
    out = shingle_join.op7_ngram_jaccard_join(spark, "")
    assert out.columns == ["doc_id", "n_links", "class_id", "kept"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted([(4, 2, 4, True), (None, 2, 4, None), (None, 2, 4, None),
                          *[(None, 2, None, None)] * 3, (0, 1, 0, True), (6, 1, 0, False),
                          *[(None, 0, None, None)] * 3], key=str)


def test_one_row_of_each_class_stays(spark):
    a, b, c, rows, df = table(spark)
    got = [tuple(r) for r in shingle_join.one_per_group(df).collect()]
    of_b = [r for r in got if r[1] and r[1].startswith(b)]
    assert len(of_b) == 1 and of_b[0][0] is None
    assert sorted((r for r in got if r not in of_b), key=str) == sorted(
        [(4, a), (0, c), (None, None), (None, ""), (None, "")], key=str)
