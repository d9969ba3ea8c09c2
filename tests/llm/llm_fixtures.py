"""Fixtures of the tests in this folder."""
import random
import string

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
SF_TENTH = "/root/testdata/sf0.1"


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    from quarry.llm.common import prepare
    prepare(spark)


def words(rng, n, letters=string.ascii_lowercase):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Nulls, empty and very long texts, copies, near copies and odd characters."""
    rng = random.Random(4)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    passage = words(rng, 90)
    return [
        None, "", " ", "a", "one two three", base, base, " ".join(near), base.upper(),
        words(rng, 40) + " " + passage + " " + words(rng, 40),
        words(rng, 30) + "\n" + passage + "\n" + words(rng, 60),
        passage + " " + words(rng, 20) + " " + passage,
        words(rng, 20000), "Or " * 400, "é" * 300 + " ümlaut 漢字 🙂 " * 40,
        "the of and in\tto  \n\n it's we'll 123 ---  ", "x" * 5000,
        *[words(rng, rng.randint(1, 200)) for _ in range(25)],
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, 0) for i, t in enumerate(texts)]
    rows.append((5, texts[5], "en", "src2", 0))              # a repeated row
    rows.append((None, "no id " + words(random.Random(1), 30), None, None, None))
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
