import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from llm_fixtures import DOCS, SF_ORACLE, SF_SMALL, SF_TENTH, docs, empty, prepared, texts, words  # noqa: F401
import __spark_entry__ as E
import corpus_pipeline as P
from oracle_compare import compare, duck
from quarry.llm import bpe, mixing
from quarry.llm.common import read, store
from quarry.llm.queries import ORACLES, QUERIES


def test_registered():
    names = set(E.queries())
    assert set(QUERIES) <= names and "pipeline" in names and set(ORACLES) <= set(E.oracle_sql())
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{i}" for i in range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    assert compare(QUERIES[name](spark, SF_ORACLE), duck(SF_ORACLE), ORACLES[name]) == []


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage keeps."""
    docs = read(spark, SF_SMALL, "documents")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(store(stage(spark, out[-1], SF_SMALL), name))
    return out


def test_columns(kept):
    assert all(k.columns == kept[0].columns for k in kept[:5])


def test_toxic_documents_go_and_clean_ones_stay(spark):
    labels = {r.doc_id: r.toxic for r in read(spark, SF_TENTH, "labels").collect()}
    left = {r.doc_id for r in P.drop_toxic(spark, read(spark, SF_TENTH, "documents"), SF_TENTH).select("doc_id").collect()}
    clean, toxic = ([i for i, x in labels.items() if x == v] for v in (0, 1))
    assert sum(i in left for i in clean) >= 0.98 * len(clean)
    assert sum(i in left for i in toxic) <= 0.06 * len(toxic)


def test_one_text_of_each_kind(kept):
    texts = [r.text for r in kept[2].collect()]
    assert len(texts) == len(set(texts)) and kept[2].count() < kept[1].count()


def test_no_string_starts_twice(kept):
    count = Counter()
    before = [r.text.encode() for r in kept[2].collect()]
    for b in before:
        count.update(b[i:i + P.REPEAT] for i in range(len(b) - P.REPEAT + 1))
    again = {x for x, n in count.items() if n > 1}
    for r in kept[3].collect():
        b = r.text.encode()
        assert r.n_chars == len(r.text)
        assert not any(b[i:i + P.REPEAT] in again for i in range(len(b) - P.REPEAT + 1))


def test_shared_passages_of_over_fifty_words_go_and_clean_text_stays(spark):
    rng = random.Random(8)
    passages = [words(rng, n, "etaoin") for n in (51, 51, 55, 60)]
    rows = [(i, words(rng, 150) + " " + passages[i % 4] + " " + words(rng, 100)) for i in range(24)]
    rows += [(i, words(rng, 200)) for i in range(100, 140)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    left = {r.doc_id: r.text for r in P.cut_repeats(spark, docs, SF_SMALL).collect()}
    for i, text in rows:
        if i < 100:
            passage = passages[i % 4]
            assert len(passage.encode()) >= P.REPEAT
            assert passage not in left[i] and 0 <= len(text) - len(left[i]) - len(passage) <= 6   # neighbours may be alike by chance
        else:
            assert left[i] == text


def test_toxicity_stage_keeps_the_input_columns(spark):
    from pyspark.sql import functions as F

    docs = read(spark, SF_SMALL, "documents").limit(50).withColumn("toxic", F.lit("mine")).withColumn("Toxic_Score", F.col("doc_id"))
    out = P.drop_toxic(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    assert all(r.toxic == "mine" and r.Toxic_Score == r.doc_id for r in out.collect()) and out.count() > 30


def test_mix(kept):
    copies = Counter()
    for r in mixing.mix(kept[3]).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in kept[4].collect()) == +copies


def test_ids(kept):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        vocab = bpe.vocabulary(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks,
                                special_tokens={})
    texts = {r.doc_id: r.text for r in kept[4].collect()}
    rows = kept[5].collect()
    assert len(rows) == kept[4].count()
    for r in rows:
        assert r.ids == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run(spark, kept):
    cols = ["doc_id", "n_tokens", "decoded_sha256"]
    assert sorted(P.run(spark, SF_SMALL).select(cols).collect()) == sorted(kept[5].select(cols).collect())


def test_stages_on_no_documents(spark, empty):
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0
