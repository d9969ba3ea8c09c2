"""Alignment of two tokenizers' tokens over the same bytes.

A text with a leading space is encoded by a byte-level BPE (A) and, by itself,
by a piece model that adds the space (B).  Token borders that both share cut the text into groups;
tokens whose byte ranges overlap are linked.

*Encoding.*  Both tokenizers always cut where a space follows a character that is no
white space (no piece of B goes on over such a space; checked when the model is
loaded), so a text is a sequence of *units* and each distinct unit is encoded once;
a task remembers units up to ``REMEMBER`` bytes.  A model that does not cut
there encodes whole texts.

*Lockstep merging.*  The tokens of a block of documents lie in two arrays of
byte ends.  One state vector holds an (A, B) pointer pair per *lane*, a run of
units of one document, so that a long document advances at many places at a
time.  Each step links the tokens that all lanes point to, then advances A where its token
ends first, B where its own does, and both, with a cut, where they end together; lanes
that have reached their end are compacted away.

*Corpus counts.*  A block's links are counted per (pair, document) in the task
and kept as compressed arrays; Spark adds the blocks' sums up by pair, finds
the highest count of each B id (as many rows as B's vocabulary at most, which
alone is broadcast), and sends each block the counts of its pairs: what is
shuffled is one row per block and distinct pair, not per link.

Defined results: texts that are null or empty, and those whose tokens' bytes
are not the text's, have no tokens (zeros, empty digest); rows that repeat or
have no id are aligned each; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.bpe import blocks
from quarry.llm.common import offsets, ragged, read, store

#: Bytes of units that a task remembers.
REMEMBER = 48 << 20
#: Bytes of text per block, at least one document.
BLOCK = 6 << 20
#: Bytes after which a document's next unit begins a new lane.
LANE = 1024

# not before a last single space, which B writes only behind something
_CUT = re.compile(r"(?<=\S)(?= [\s\S])")
_SPACE = "▁"


def byte_of_letter() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable
    Latin-1 characters stand for themselves, the other bytes follow 255 in order."""
    own = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Ragged(NamedTuple):
    """Values of items one after another; item i is values[start[i]:start[i + 1]]."""
    values: np.ndarray
    start: np.ndarray

    def take(self, of: np.ndarray) -> "Ragged":
        sizes = self.start[of + 1] - self.start[of]
        return Ragged(self.values[ragged(self.start[of], sizes)], offsets(sizes))

    def extended(self, lists: list[list[int]]) -> "Ragged":
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        new = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
        return Ragged(np.concatenate((self.values, new)),
                      np.concatenate((self.start, self.start[-1] + np.cumsum(sizes))))


_NONE = Ragged(np.zeros(0, np.int32), np.zeros(1, np.int64))


def _ends(lists: list[list[int]], lengths: np.ndarray) -> np.ndarray:
    """Byte ends of lists of tokens laid one after another."""
    items = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
    total = lengths[np.fromiter(chain.from_iterable(lists), np.int64, int(items[-1]))]
    return np.r_[0, np.cumsum(total)][items]


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and how groups are written."""

    def __init__(self, json: bytes, model: bytes):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(json.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = byte_of_letter()
        n_a, self.n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.bytes_a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
                        for t in map(self.a.id_to_token, range(n_a))]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.len_a = np.fromiter(map(len, self.bytes_a), np.int64, n_a)
        self.len_b = np.fromiter(map(len, self.bytes_b), np.int64, self.n_b)
        # cuts at spaces hold for both if no piece goes on over one
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        # an id and the mark behind it: inside a side, at its end
        self.written = np.array([f"{i}{end}" for i in range(n_a) for end in ",|"]
                                + [f"{i}{end}" for i in range(self.n_b) for end in ",;"], object)

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of both sides of every unit, and whether their bytes are the unit's."""
        a, b, same = [], [], np.ones(len(units), bool)
        for at in range(0, len(units), 2000):
            part = units[at:at + 2000]
            ids_a = [e.ids for e in self.a.encode_batch_fast(part, add_special_tokens=False)]
            ids_b = self.b.encode([u[1:] for u in part], num_threads=1)
            written = [u.encode() for u in part]
            ends = np.cumsum(np.fromiter(map(len, written), np.int64, len(part)))
            # equal as a whole and of equal lengths, else looked at one by one
            if not (self.joined(chain.from_iterable(ids_a), chain.from_iterable(ids_b)) == (b"".join(written),) * 2
                    and (_ends(ids_a, self.len_a) == ends).all() and (_ends(ids_b, self.len_b) == ends).all()):
                same[at:at + 2000] = [self.joined(x, y) == (w, w) for w, x, y in zip(written, ids_a, ids_b)]
            a += ids_a
            b += ids_b
        return a, b, same

    def joined(self, a: Iterable[int], b: Iterable[int]) -> tuple[bytes, bytes]:
        return b"".join(map(self.bytes_a.__getitem__, a)), b"".join(map(self.bytes_b.__getitem__, b))


_LOADED: dict[bytes, Tokenizers] = {}


def loaded(json: bytes, model: bytes) -> Tokenizers:
    key = hashlib.sha256(json + model).digest()
    if key not in _LOADED:
        _LOADED[key] = Tokenizers(json, model)
    return _LOADED[key]


class Units(dict):
    """Unit -> index of its tokens; new units are encoded by ``learn``."""

    def __init__(self, tok: Tokenizers):
        super().__init__()
        self.tok = tok
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.held = 0
        self.a, self.b, self.same = _NONE, _NONE, np.zeros(0, bool)

    def __missing__(self, unit: str) -> int:
        self[unit] = at = len(self)
        self.new.append(unit)
        self.held += len(unit) + 100
        return at

    def rows(self, texts: list[str]) -> list[np.ndarray]:
        """Indices of the units of every text, which all are encoded."""
        if self.held > REMEMBER:
            self._forget()
        out = []
        for text in texts:
            units = self._units(text) if text else []
            out.append(np.fromiter(map(self.__getitem__, units), np.int64, len(units)))
        a, b, same = self.tok.encode(self.new)
        self.a, self.b, self.same = self.a.extended(a), self.b.extended(b), np.concatenate((self.same, same))
        self.new = []
        return out

    def _units(self, text: str) -> list[str]:
        text = " " + text
        return _CUT.split(text) if self.tok.cuts else [text]


class Block(NamedTuple):
    """Aligned documents: tokens of both sides, cuts behind tokens, links."""
    a: np.ndarray            # ids
    b: np.ndarray
    a_of: np.ndarray         # bounds of the documents' tokens
    b_of: np.ndarray
    a_cut: np.ndarray        # whether a group ends behind the token
    b_cut: np.ndarray
    link_a: np.ndarray       # positions in a and b
    link_b: np.ndarray


def merge(a_end: np.ndarray, b_end: np.ndarray, i: np.ndarray, j: np.ndarray, stop: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lockstep merge of lanes that begin at tokens ``i`` and ``j`` and end
    before A's token ``stop``: cuts of both sides and the links' positions."""
    a_cut, b_cut = np.zeros(len(a_end), bool), np.zeros(len(b_end), bool)
    link_a, link_b = [i[:0]], [i[:0]]
    live = i < stop
    i, j, stop = i[live], j[live], stop[live]
    while len(i):
        link_a.append(i)
        link_b.append(j)
        end_a, end_b = a_end[i], b_end[j]
        both = end_a == end_b
        a_cut[i[both]] = True
        b_cut[j[both]] = True
        i, j = i + (end_a <= end_b), j + (end_b <= end_a)
        live = i < stop
        if not live.all():
            i, j, stop = i[live], j[live], stop[live]
    return a_cut, b_cut, np.concatenate(link_a), np.concatenate(link_b)


def align_block(texts: list[str | None], units: Units) -> Block:
    texts = [t or "" for t in texts]
    rows, tok = units.rows(texts), units.tok
    for k, row in enumerate(rows):
        if len(row) and not units.same[row].all():
            a, b = units.a.take(row).values.tolist(), units.b.take(row).values.tolist()
            if tok.joined(a, b) != ((" " + texts[k]).encode(),) * 2:
                rows[k] = row[:0]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    of = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    (a, a_start), (b, b_start) = units.a.take(of), units.b.take(of)
    a_end, b_end = np.cumsum(tok.len_a[a]), np.cumsum(tok.len_b[b])
    # a lane begins at a document's first unit and at units LANE bytes on that both sides begin with a token
    doc = np.repeat(np.arange(len(rows)), sizes)
    begin = np.r_[0, a_end][a_start[:-1]]
    aligned = begin == np.r_[0, b_end][b_start[:-1]]
    lane = begin // LANE
    starts = np.ones(len(of), bool)
    starts[1:] = (doc[1:] != doc[:-1]) | (lane[1:] != lane[:-1]) & aligned[1:]
    at = np.flatnonzero(starts)
    stop = a_start[np.append(at[1:], len(of))] if len(at) else at
    found = merge(a_end, b_end, a_start[:-1][at], b_start[:-1][at], stop)
    bounds = offsets(sizes)
    return Block(a, b, a_start[bounds], b_start[bounds], *found)


def group_digests(block: Block, tok: Tokenizers) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per document, '' without tokens."""
    first_a, first_b = np.cumsum(block.a_cut) - block.a_cut, np.cumsum(block.b_cut) - block.b_cut
    groups = int(block.a_cut.sum())
    in_a, in_b = np.bincount(first_a, minlength=groups), np.bincount(first_b, minlength=groups)
    out = np.empty(len(block.a) + len(block.b), np.int64)
    out[np.arange(len(block.a)) + offsets(in_b)[first_a]] = block.a.astype(np.int64) * 2 + block.a_cut
    out[np.arange(len(block.b)) + offsets(in_a)[first_b + 1]] = (
        2 * len(tok.len_a) + block.b.astype(np.int64) * 2 + block.b_cut)
    ends = (block.a_of + block.b_of).tolist()
    return [hashlib.sha256("".join(tok.written[out[s:e]].tolist())[:-1].encode()).hexdigest() if e > s else ""
            for s, e in zip(ends, ends[1:])]


def _packed(values: np.ndarray) -> bytes:
    """Compressed int32 values, bytes of equal weight together."""
    planes = np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel()


def counted_block(number: int, ids: pa.Array, block: Block, tok: Tokenizers) -> pa.RecordBatch:
    """One row: the block's distinct pairs with their links, which documents hold them, and digests."""
    n = len(ids)
    doc = np.repeat(np.arange(n), np.diff(block.a_of))[block.link_a]
    pair = block.a[block.link_a].astype(np.int64) * tok.n_b + block.b[block.link_b]
    key = pair * n + doc
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.diff(np.append(first, len(key)))
    pair, doc = np.divmod(key[first], max(n, 1))
    begin = np.flatnonzero(np.diff(pair, prepend=-1))
    in_docs = np.diff(np.append(begin, len(pair)))
    cuts = np.r_[0, np.cumsum(block.a_cut)]
    per_doc = {"n_a": np.diff(block.a_of), "n_b": np.diff(block.b_of),
               "n_groups": np.diff(cuts[block.a_of]),
               "n_links": np.diff(np.searchsorted(np.sort(block.link_a), block.a_of)),
               "groups_sha256": group_digests(block, tok)}
    row = {"block": pa.array([number], pa.int64()),
           "pairs": pa.array([pair[begin]], pa.list_(pa.int64())),
           "links": pa.array([np.add.reduceat(times, begin) if len(begin) else begin], pa.list_(pa.int64())),
           "in_docs": _packed(in_docs), "doc": _packed(doc), "times": _packed(times),
           "doc_id": pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids)}
    for name, values in per_doc.items():
        kind = pa.string() if name.endswith("256") else pa.int64()
        row[name] = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(values, kind))
    return pa.record_batch({k: pa.array([v], pa.binary()) if isinstance(v, bytes) else v for k, v in row.items()})


def finished_block(block: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with the corpus counts of its pairs (pos, total, best)."""
    row = block.drop_columns(["block", "in_docs", "doc", "times"]).combine_chunks()
    in_docs, doc, times = (_unpacked(block[c][0].as_py()) for c in ("in_docs", "doc", "times"))
    total, best = np.zeros(len(in_docs), np.int64), np.zeros(len(in_docs), bool)
    pos = counts["pos"].to_numpy()
    total[pos], best[pos] = counts["total"].to_numpy(), counts["best"].to_numpy()
    out = {name: row[name].chunk(0).flatten() for name in row.column_names}
    n = len(out["doc_id"])
    of = np.repeat(np.arange(len(in_docs)), in_docs)
    n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(n_best, doc, np.where(best[of], times, 0))
    np.add.at(count_sum, doc, total[of] * times)
    return pa.table(out | {"n_best": n_best, "count_sum": count_sum})


def _files(spark: SparkSession, json_path: str, model_path: str):
    """Both vocabulary files, read by the driver; their size is fixed."""
    with open(json_path, "rb") as j, open(model_path, "rb") as m:
        return spark.sparkContext.broadcast((j.read(), m.read()))


def _aligned(batches: Iterator[pa.RecordBatch], files, block_bytes: int
             ) -> Iterator[tuple[pa.RecordBatch, Block, Tokenizers]]:
    units = Units(loaded(*files.value))
    for batch in blocks(batches, "text", block_bytes):
        yield batch, align_block(batch.column("text").to_pylist(), units), units.tok


def align(docs: DataFrame, json_path: str, model_path: str, doc_id: str = "doc_id", text: str = "text",
          block_bytes: int = BLOCK) -> DataFrame:
    """Per document its tokens and their alignment: ``a_ids``, ``b_ids``; per
    group the number of tokens up to its end, ``a_cuts``, ``b_cuts``; per link
    the tokens' positions, ``a_links``, ``b_links``."""
    files = _files(docs.sparkSession, json_path, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block, _ in _aligned(batches, files, block_bytes):
            order = np.lexsort((block.link_b, block.link_a))
            link_a, link_b = block.link_a[order], block.link_b[order]
            at_links = np.searchsorted(link_a, block.a_of)
            out = {"doc_id": batch.column("doc")}
            for side, ids, of, cut, link in (("a", block.a, block.a_of, block.a_cut, link_a),
                                             ("b", block.b, block.b_of, block.b_cut, link_b)):
                ends = np.flatnonzero(cut) + 1
                at_cuts = np.searchsorted(ends, of, side="right")
                for name, bounds, values in (
                        ("ids", of, ids),
                        ("cuts", at_cuts, ends - np.repeat(of[:-1], np.diff(at_cuts))),
                        ("links", at_links, link - np.repeat(of[:-1], np.diff(at_links)))):
                    out[f"{side}_{name}"] = pa.ListArray.from_arrays(
                        pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
            yield pa.record_batch(out)

    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc"]
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(
        f"{s}_{c} array<int>" for s in "ab" for c in ("ids", "cuts", "links")))


def digests(docs: DataFrame, json_path: str, model_path: str, doc_id: str = "doc_id", text: str = "text",
            block_bytes: int = BLOCK) -> DataFrame:
    """Per document: sizes of its alignment, a digest of its groups, and how
    its links stand among the corpus's."""
    spark = docs.sparkSession
    files = _files(spark, json_path, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch, block, tok in _aligned(batches, files, block_bytes):
            yield counted_block(number, batch.column("doc"), block, tok)
            number += 1

    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc"]
    numbers = "n_a", "n_b", "n_groups", "n_links"
    made = store(rows.mapInArrow(run, (
        f"block long, pairs array<long>, links array<long>, in_docs binary, doc binary, times binary, "
        f"doc_id array<{kind}>, {', '.join(f'{c} array<long>' for c in numbers)}, "
        f"groups_sha256 array<string>")), "aligned")
    n_b = loaded(*files.value).n_b
    counts = store(made.select(F.explode(F.arrays_zip("pairs", "links")).alias("p"))
                   .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.links").alias("total")), "pairs")
    # one row per id of B at most
    highest = counts.groupBy((F.col("pair") % n_b).alias("_b")).agg(F.max("total").alias("_highest"))
    ranked = counts.join(F.broadcast(highest), F.col("pair") % n_b == F.col("_b")).select(
        F.col("pair").alias("_pair"), "total", (F.col("total") == F.col("_highest")).alias("best"))
    asked = made.select(F.col("block").alias("to"), F.posexplode("pairs").alias("pos", "pair"))
    answers = asked.join(ranked, F.col("pair") == F.col("_pair")).select("to", "pos", "total", "best")
    return (made.drop("pairs", "links").groupBy("block").cogroup(answers.groupBy("to"))
            .applyInArrow(finished_block, (
                f"doc_id {kind}, {', '.join(f'{c} long' for c in numbers)}, groups_sha256 string, "
                f"n_best long, count_sum long"))
            .select("doc_id", *numbers, "n_best", "count_sum", "groups_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                   public_tokenizers.path("piece_bpe_32k.model"))
