"""Byte-level BPE: encoding by corpus-level merge replay, and decoding.

Encoding.  Spark deals the documents to tasks; a task takes blocks of whole
documents (``block_bytes`` of text, at least one document), splits them with
the tokenizer's pattern and keeps every distinct word of the block once.  An
inverted index from merge rank (the rank of an adjacent token pair) to word
positions is built over those words.  Merges are then replayed in rank order:
all positions of the lowest rank are merged together, and only the pairs with
the touched neighbours enter the index anew.  The tokens of a word depend on
the word alone, so blocks need no exchange: encoding moves no data between
executors, memory is bounded by the block, and a lost task is just run again.

A merge may in principle create a pair with a *lower* rank than the one being
replayed; words in which that happens are encoded again by repeatedly merging
their lowest pair.  Results are those of the usual greedy algorithm.

Defined results: a null text counts as empty; an empty text has no ids and
decodes to no bytes; rows that repeat, or have no id, are encoded each; other columns pass through untouched, and a column that
has the output's name is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import REMEMBERED_CHARS, offsets, ragged, read

NONE = np.int32(2**31 - 1)

#: Bytes of text that are encoded, and of tokens that are decoded, at a time: the arrays
#: for a block take some 40 times as much, beside the heap of the executor.
BLOCK = 1 << 20
#: Pieces whose tokens a task remembers.
REMEMBERED = 200_000

# Fixed value: the Unicode property White_Space, which is what the
# tokenizer's pattern means by \s.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_VOCABULARIES: dict[bytes, "Vocabulary"] = {}


class Vocabulary:
    """Tokens by rank, and the rank that each adjacent pair merges to."""

    def __init__(self, rank_file: bytes):
        self.ranks = {base64.b64decode(tok): int(rank)
                      for tok, rank in (line.split() for line in rank_file.splitlines() if line)}
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        for tok, rank in self.ranks.items():
            self.tokens[rank] = tok
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.start = offsets(np.fromiter(map(len, self.tokens), np.int64, self.size))
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for tok, rank in self.ranks.items():
            for cut in range(1, len(tok)):
                left, right = self.ranks.get(tok[:cut]), self.ranks.get(tok[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int32)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def encode_word(self, word: bytes) -> list[int]:
        """Merge the lowest pair, leftmost first, until none is left."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, NONE), i)
                           for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NONE:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]


def vocabulary(rank_file: bytes) -> Vocabulary:
    key = hashlib.sha256(rank_file).digest()
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Vocabulary(rank_file)
    return _VOCABULARIES[key]


def splitter(pattern: str) -> "regex.Pattern":
    r"""The pattern with \s and \S spelled out as White_Space."""
    pattern = pattern.replace(r"[^\s", "[^" + WHITE).replace(r"\S", f"[^{WHITE}]")
    return regex.compile(pattern.replace(r"\s", f"[{WHITE}]"))


def replay_merges(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all words, concatenated, and the token count of each word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    start = offsets(sizes)
    n = int(start[-1])
    if not n:
        return np.zeros(0, np.int32), sizes
    tok = vocab.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    word_of = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    nxt = np.arange(1, n + 1, dtype=np.int32)
    prv = np.arange(-1, n - 1, dtype=np.int32)
    ends, firsts = start[1:][sizes > 0] - 1, start[:-1][sizes > 0]
    nxt[ends] = -1
    prv[firsts] = -1
    rank = np.full(n, NONE, np.int32)          # of the pair (i, nxt[i])
    has = np.flatnonzero(nxt >= 0)
    rank[has] = vocab.pair_rank(tok[has], tok[has + 1])
    alive = np.ones(n, bool)
    odd: set[int] = set()                      # words to encode one by one

    index: dict[int, list[np.ndarray]] = {}    # rank -> positions of its pairs
    heap: list[int] = []

    def enter(pos: np.ndarray) -> None:
        r = rank[pos]
        keep = r != NONE
        pos, r = pos[keep], r[keep]
        if not len(pos):
            return
        order = np.argsort(r, kind="stable")
        pos, r = pos[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        begins = [0, *cuts.tolist()]
        for a, b, key in zip(begins, [*begins[1:], len(pos)], r[begins].tolist()):
            if key in index:
                index[key].append(pos[a:b])
            else:
                index[key] = [pos[a:b]]
                heapq.heappush(heap, key)

    enter(has)
    while heap:
        r = heapq.heappop(heap)
        found = index.pop(r)
        pos = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        pos = pos[rank[pos] == r]
        if not len(pos):
            continue
        right = nxt[pos]
        chained = right[:-1] == pos[1:]
        if chained.any():                      # x x x: leftmost first, no overlap
            run = np.arange(len(pos))
            run[1:][chained] = 0
            run = np.maximum.accumulate(np.where(np.r_[True, ~chained], np.arange(len(pos)), 0))
            pos = pos[(np.arange(len(pos)) - run) % 2 == 0]
            right = nxt[pos]
        after = nxt[right]
        tok[pos] = r
        nxt[pos] = after
        alive[right] = False
        rank[right] = NONE
        inner = after >= 0
        prv[after[inner]] = pos[inner]
        rank[pos] = NONE
        a = pos[inner]
        b = prv[pos]
        touched = np.concatenate((a, b[b >= 0]))
        if len(touched) > 1:
            touched = np.unique(touched)
        if not len(touched):
            continue
        new = vocab.pair_rank(tok[touched], tok[nxt[touched]])
        rank[touched] = new
        low = new <= r
        if low.any():
            odd.update(word_of[touched[low]].tolist())
            rank[touched[low]] = NONE
        enter(touched)
    counts = np.bincount(word_of[alive], minlength=len(words)).astype(np.int64)
    out = tok[alive]
    if odd:
        bounds = offsets(counts)
        parts = [out[bounds[i]:bounds[i + 1]] if i not in odd
                 else np.array(vocab.encode_word(words[i]), np.int32) for i in range(len(words))]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        out = np.concatenate(parts)
    return out, counts


class Pieces(dict):
    """Indices of the texts between single spaces; -1 for one that is empty or
    begins or ends with white space, where a space may not be a word border."""

    def __init__(self, units: list[str], lead: str):
        super().__init__()
        self.units, self.lead = units, lead

    def __missing__(self, piece: str) -> int:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            at = -1
        else:
            at = len(self.units)
            self.units.append(self.lead + piece)
        self[piece] = at
        return at


def _expand(of: np.ndarray, start: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of every item of ``of``, concatenated, and their counts."""
    sizes = start[of + 1] - start[of]
    return values[ragged(start[of], sizes)], sizes


class Encoder:
    """Encodes blocks of texts; remembers the tokens of the pieces it has met,
    up to ``remember`` pieces (of REMEMBERED_CHARS characters at most), so that merges are replayed over new words only.

    A space between two other characters always begins a word, so texts are
    first cut there, and each distinct piece is split by the pattern once."""

    def __init__(self, vocab: Vocabulary, split: "regex.Pattern", remember: int = REMEMBERED):
        self.vocab, self.split, self.remember = vocab, split, remember
        self._forget()

    def _forget(self) -> None:
        self.units: list[str] = []
        self.held = 0
        self.first, self.later = Pieces(self.units, ""), Pieces(self.units, " ")
        self.tokens, self.start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of units and the tokens' counts."""
        seen: dict[str, int] = {}
        words = [[seen.setdefault(w, len(seen)) for w in x] for x in map(self.split.findall, units)]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.fromiter(chain.from_iterable(words), np.int64, int(sizes.sum()))
        tokens, counts = replay_merges([w.encode() for w in seen], self.vocab)
        values, lengths = _expand(flat, offsets(counts), tokens)
        return values, np.diff(offsets(lengths)[offsets(sizes)])

    def encode(self, texts: list[str]) -> pa.ListArray:
        if len(self.units) > self.remember or self.held > REMEMBERED_CHARS:
            self._forget()
        known = len(self.units)
        rows, whole = [], []
        for text in texts:
            head, *tail = text.split(" ")
            row = np.empty(len(tail) + 1, np.int64)
            row[0] = self.first[head]
            row[1:] = np.fromiter(map(self.later.__getitem__, tail), np.int64, len(tail))
            if row.min() < 0:                    # cut by the pattern as a whole
                row = np.array([-1 - len(whole)] if text else [], np.int64)
                if text:
                    whole.append(text)
            rows.append(row)
        self.held += sum(map(len, self.units[known:]))
        values, counts = self._learn(self.units[known:] + whole)
        news = len(self.units) - known
        own = int(counts[:news].sum())
        self.tokens = np.concatenate((self.tokens, values[:own]))
        self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(counts[:news])))
        for at in range(known, len(self.units)):
            self.units[at] = ""                  # its index is all that is needed now
        of = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        of = np.where(of < 0, len(self.units) - 1 - of, of)
        start = np.concatenate((self.start, self.start[-1] + np.cumsum(counts[news:])))
        ids, sizes = _expand(of, start, np.concatenate((self.tokens, values[own:])))
        ends = offsets(sizes)[offsets(np.fromiter(map(len, rows), np.int64, len(rows)))]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def decode_lists(lists: pa.ListArray, vocab: Vocabulary) -> pa.BinaryArray:
    """The bytes that each list of ids stands for."""
    ids = lists.flatten().to_numpy()
    values, sizes = _expand(ids, vocab.start, vocab.bytes)
    counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    ends = offsets(sizes)[offsets(counts)].astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(values)])


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut, at row borders, to about ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        block = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def _put(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    if name in batch.schema.names:
        batch = batch.drop_columns([name])
    return batch.append_column(name, values)


def encoded_batches(batches: Iterator[pa.RecordBatch], vocab: Vocabulary, pattern: str, text: str,
                    ids: str, block_bytes: int) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocab, splitter(pattern))
    for batch in blocks(batches, text, block_bytes):
        yield _put(batch, ids, encoder.encode([t or "" for t in batch.column(text).to_pylist()]))


def decoded_batches(batches: Iterator[pa.RecordBatch], vocab: Vocabulary, ids: str,
                    out: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _of_bytes(batch, vocab, ids):
            yield _put(part, out, decode_lists(part.column(ids), vocab))


def _of_bytes(batch: pa.RecordBatch, vocab: Vocabulary, ids: str) -> Iterator[pa.RecordBatch]:
    """The batch cut, at row borders, to about BLOCK bytes that its ids stand for."""
    lists = batch.column(ids)
    counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    flat = lists.flatten().to_numpy()
    sizes = offsets(vocab.start[flat + 1] - vocab.start[flat])[offsets(counts)]
    block = sizes[:-1] // BLOCK
    cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def _broadcast(spark: SparkSession, rank_path: str):
    """The rank file, read by the driver; its size is the vocabulary's,
    whatever the data."""
    with open(rank_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _schema(df: DataFrame, **new: str):
    for name, kind in new.items():
        df = df.select(*[f"`{c}`" for c in df.columns if c != name],
                       F.lit(None).cast(kind).alias(name))
    return df.schema


def encode(docs: DataFrame, rank_path: str, pattern: str, text: str = "text", ids: str = "ids",
           block_bytes: int = BLOCK) -> DataFrame:
    """``docs`` with the token ids (array<int>) of every whole text."""
    ranks = _broadcast(docs.sparkSession, rank_path)
    return docs.mapInArrow(
        lambda batches: encoded_batches(batches, vocabulary(ranks.value), pattern, text, ids, block_bytes),
        _schema(docs, **{ids: "array<int>"}))


def decode(encoded: DataFrame, rank_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes (binary) that the ids stand for; null ids
    count as none."""
    ranks = _broadcast(encoded.sparkSession, rank_path)
    return encoded.mapInArrow(
        lambda batches: decoded_batches(batches, vocabulary(ranks.value), ids, out),
        _schema(encoded, **{out: "binary"}))


def encode_and_decode(docs: DataFrame, rank_path: str, pattern: str, text: str = "text",
                      ids: str = "ids", out: str = "decoded", block_bytes: int = BLOCK) -> DataFrame:
    """Both in one pass, in one worker process per task."""
    ranks = _broadcast(docs.sparkSession, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(ranks.value)
        coded = encoded_batches(batches, vocab, pattern, text, ids, block_bytes)
        for batch in decoded_batches(coded, vocab, ids, out):
            yield batch.drop_columns([text])

    return docs.mapInArrow(run, _schema(docs.drop(text), **{ids: "array<int>", out: "binary"}))


def digests(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the bytes
    that they decode to."""
    coded = encode_and_decode(docs.select("doc_id", "text"), rank_path, pattern)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(read(spark, sf_dir, "documents"),
                   public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
