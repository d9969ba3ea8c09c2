import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from llm_fixtures import docs, empty, prepared, texts  # noqa: F401
from quarry.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocab():
    with open(RANKS, "rb") as f:
        return bpe.vocabulary(f.read())


@pytest.fixture(scope="module")
def library(vocab):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks,
                             special_tokens={})


def test_same_ids_as_the_library(docs, library):
    got = bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == docs.count()
    by_id = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got}
    for row in docs.collect():
        ids = library.encode_ordinary(row.text or "")
        assert (row.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((row.text or "").encode()).hexdigest()) in by_id


def test_every_character_and_white_space_run(vocab, library):
    texts = ["x" + chr(c) + " " + chr(c) + chr(c) + "1" for c in range(0, 0x3100) if not 0xD800 <= c < 0xE000]
    texts += ["a  b", " a", "a ", "\n\n a\t b", "a　 b", "a \x1c b", "  ", "aaaa" * 50, "'s'S 's"]
    got = bpe.Encoder(vocab, bpe.splitter(public_tokenizers.PATTERN)).encode(texts)
    assert got.to_pylist() == library.encode_ordinary_batch(texts)
    assert bpe.decode_lists(got, vocab).to_pylist() == [t.encode() for t in texts]


def test_forgetting_pieces_and_small_blocks_change_nothing(vocab, texts):
    split = bpe.splitter(public_tokenizers.PATTERN)
    texts = [t or "" for t in texts]
    whole = bpe.Encoder(vocab, split).encode(texts).to_pylist()
    forgetful = bpe.Encoder(vocab, split, remember=0)
    assert [forgetful.encode([t]).to_pylist()[0] for t in texts] == whole


def test_a_pair_of_lower_rank_than_the_merge(vocab):
    # every merge order must give what merging the lowest pair first gives
    for word in [b"the", b" the", b"aaaaaaa", b"abcabcabc", bytes(range(256))]:
        ids, counts = bpe.replay_merges([word], vocab)
        assert ids.tolist() == vocab.encode_word(word) and counts.tolist() == [len(ids)]


def test_general_interface_keeps_other_columns(docs, spark):
    clash = docs.withColumn("ids", F.lit("old")).withColumn("decoded", F.lit(1))
    out = bpe.decode(bpe.encode(clash, RANKS, public_tokenizers.PATTERN), RANKS)
    assert dict(out.dtypes)["ids"] == "array<int>" and out.count() == docs.count()
    assert out.where("decode(decoded, 'UTF-8') <> coalesce(text, '')").count() == 0


def test_empty_table(empty):
    assert bpe.digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_blocks_bound_the_memory_of_a_task():
    import tracemalloc

    import pyarrow as pa
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        vocab = bpe.vocabulary(f.read())
    texts = [" ".join(f"word{k * n % 1009} and more" for k in range(8000)) for n in range(1, 41)]
    batch = pa.record_batch({"text": pa.array(texts)})
    assert batch.nbytes > 5 << 20
    tracemalloc.start()
    try:
        coded = bpe.encoded_batches(iter([batch]), vocab, public_tokenizers.PATTERN, "text", "ids", bpe.BLOCK)
        done = []
        for part in bpe.decoded_batches(coded, vocab, "ids", "decoded"):
            assert part.column("text").nbytes < 2 * bpe.BLOCK
            done += part.column("decoded").to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [d.decode() for d in done] == texts
    assert peak < 100 << 20
