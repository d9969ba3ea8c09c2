"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it has kept; every stage's result is written as Parquet and read again.  All
but the last return the columns of ``documents``.

1. toxicity: documents with a score of 0.3 or more go;
2. ngram_jaccard: of each group of near copies one document stays;
3. suffix_dedup: every string of ``REPEAT`` bytes that starts at two places
   goes, which covers passages of 50 words and more;
4. mixing: documents are repeated or dropped towards the sources' weights;
5. bpe: the token ids of each text, and a digest of what they decode to.

In every stage null texts count as empty, rows without an id and rows that
repeat an id are documents of their own (equal texts are near copies of each
other, so one stays), further columns are kept as they are, whatever their
names, and no documents give no documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, mixing, shingle_join, substrings, toxicity
from quarry.llm.common import free_names, prepare, read, store

#: Bytes of a repeated string that is cut out: 50 words of four letters and a space are longer.
REPEAT = 200
#: Bytes of the grams that its windows are dealt by.
REPEAT_GRAM = 64


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    names = tuple(free_names(docs, "toxic_score", "toxic_spans", "toxic"))
    scored = toxicity.detect(docs, read(spark, sf_dir, "labels"), names=names)
    return scored.where(~F.col(names[2])).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return shingle_join.one_per_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return substrings.cut_documents(docs, length=REPEAT, gram=REPEAT_GRAM)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    prepare(spark)
    coded = bpe.encode_and_decode(docs.select("doc_id", "source", "text"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                  public_tokenizers.PATTERN)
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("bpe", tokenise),
]

#: No SQL expresses the stages; tests/llm compares them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
