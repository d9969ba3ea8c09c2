"""A clean document stays, whatever ids repeat."""
import random
from itertools import permutations

from llm_fixtures import empty, prepared, words  # noqa: F401
from quarry.llm import shingle_join


def test_classes_whose_smallest_ids_coincide(spark):
    rng = random.Random(12)
    for _ in range(2):                                   # whichever text hashes lower
        a, b = words(rng, 60), words(rng, 60)
        for x, y in permutations((a, b)):
            df = spark.createDataFrame([(1, x), (1, y), (3, y + " end"), (1, x)], "doc_id long, text string")
            got = sorted((r.doc_id, r.text) for r in shingle_join.one_per_group(df).collect())
            assert got == sorted([(1, x), (1, y)])


def test_texts_without_words_stay(spark):
    text = words(random.Random(13), 60)
    rows = [(1, text), (1, ""), (1, None), (1, " "), (2, ""), (2, text), (4, "..."), (4, "...")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in shingle_join.one_per_group(df).collect()]
    assert sorted(got, key=str) == sorted([r for r in rows if r != (2, text)], key=str)


def test_an_id_with_many_texts_gives_the_sample_one_row(spark):
    from quarry.llm import labelled

    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "other"), (2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 1)], "doc_id long, quality int")
    rows = labelled.sample(docs, labels, "quality", 5, 9, 10).collect()
    assert sorted((r.id, r.label) for r in rows) == [(1, 0), (2, 1)]
