"""Rows without an id are told apart by their texts."""
import hashlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import prepared  # noqa: F401
from test_substrings import brute, digest


@pytest.mark.parametrize("how", [{}, {"crowd": 1}])
@pytest.mark.parametrize("doc_id", [None, 5])
def test_texts_whose_32_bit_hashes_are_equal(spark, how, doc_id):
    a, b = (hashlib.sha512(str(i).encode()).hexdigest() for i in (70471, 358418))
    df = spark.createDataFrame([(doc_id, a), (doc_id, b), (7, "z" + a[:100] + "z"), (8, "y" + b[50:] + "y")],
                               "doc_id long, text string")
    assert df.limit(2).select(F.hash("text")).distinct().count() == 1
    rows = [(r.doc_id, r.text.encode()) for r in df.collect()]
    assert digest(df, length=60, gram=16, **how) == brute(rows, 60)
