"""Exact substring dedup: every byte covered by a string of ``length`` bytes
that also starts somewhere else (in the same text or another) is removed.

1. *Cutting into shards by content.*  Each window of ``length`` bytes has an
   anchor: the position of the least hash among its ``GRAM``-byte grams (the
   leftmost of equals).  Equal windows have equal anchors, so windows are
   grouped by the gram at their anchor, and no group needs to look at another.
   Neighbouring windows with the same anchor travel as one piece.  One pass
   over the texts yields narrow rows (gram, hash of the piece, place).
2. *Pieces that are equal as a whole* (the inside of copies) are counted with
   partial aggregates: where there are two, all their windows repeat.  Grams that
   occur once drop out.
3. *Different pieces with the same gram* (the rims of passages, edited copies)
   are fetched, one of each kind, and dealt to shards by gram.  A task sorts all
   suffixes of its pieces by external induced sorting (``suffixes.py``); a
   window repeats if it has ``length`` bytes in common with its neighbour in the
   suffix array.
4. A gram shared by more than ``CROWD`` different pieces does not go to one
   task: its windows are counted one by one, by a 128-bit hash, with partial
   aggregates.
5. The repeated ranges meet their texts again and are cut out.

Documents are known by id and 128 bits of the text's SHA-256, which is all that
tells rows without an id apart.  Small sets of them are
broadcast (after they have been counted), larger ones are joined by shuffling.

Defined results: null texts count as empty; texts shorter than ``length`` lose
nothing; repeated rows count as different texts, so they are each other's
repetition; rows without an id are treated like others; other columns are
kept as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import ragged, read, store
from quarry.llm.suffixes import MEMORY, Space, suffix_array

#: Bytes of the grams that anchors are chosen from.
GRAM = 128
#: Different pieces with the same gram, beyond which windows are counted instead.
CROWD = 5000
#: Bytes of pieces that are sorted together.
SHARD = 2 << 20
#: Bytes of text that anchors are sought in at a time; positions take 24 bits.
CHUNK = 1 << 20
LONGEST = 1 << 21
#: Documents (their ids) or kinds of pieces (two hashes, 16 bytes) that are broadcast at most.
FEW = 200_000
#: Stands for a null id inside the joins.
NO_ID = -(1 << 63)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = np.uint64((1 << 24) - 1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        steps = np.full(max(n, 2 * CHUNK), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[base][:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from every position on."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * _powers(_INVERSE, n - gram + 1)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def window_minima(key: np.ndarray, width: int) -> np.ndarray:
    """Least of key[p : p + width] for every p."""
    n = len(key)
    rows = -(-n // width)
    table = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    table[:n] = key
    table = table.reshape(rows, width)
    upto = np.minimum.accumulate(table, axis=1).ravel()
    onward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[:n - width + 1], upto[width - 1:n])


def pieces(data: np.ndarray, start: np.ndarray, size: np.ndarray, length: int, gram: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same anchor: text number, first and last
    window (positions in ``data``), gram hash at the anchor."""
    windows = np.maximum(size - length + 1, 0)
    p = ragged(start, windows)
    if not len(p):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    h = gram_hashes(data, gram)
    key = (h & ~_MASK) | np.arange(len(h), dtype=np.uint64)
    anchor = (window_minima(key, length - gram + 1)[p] & _MASK).astype(np.int64)
    text = np.repeat(np.arange(len(start)), windows)
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(p)])) - 1
    return text[first], p[first], p[last], h[anchor[first]]


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in groups of about CHUNK bytes; longer texts in overlapping parts
    that hold every window once: numbers, offsets, bytes."""
    which, offset, parts, held = [], [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), LONGEST):
            part = text[at:at + LONGEST + length - 1]
            if held and held + len(part) > CHUNK:
                yield which, offset, parts
                which, offset, parts, held = [], [], [], 0
            which.append(k)
            offset.append(at)
            parts.append(part)
            held += len(part)
    if parts:
        yield which, offset, parts


def _hash8(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def anchored(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc, th, a, b, h, ph): every piece of every text, windows a..b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, th = batch.column("doc").to_numpy(), batch.column("th")
            texts = [t or b"" for t in batch.column("body").to_pylist()]
            for which, offset, parts in _segments(texts, length):
                joined = b"".join(parts)
                data = np.frombuffer(joined, np.uint8)
                size = np.fromiter(map(len, parts), np.int64, len(parts))
                start = np.cumsum(size) - size
                text, a, b, h = pieces(data, start, size, length, gram)
                if not len(text):
                    continue
                ph = np.fromiter((_hash8(joined[x:y]) for x, y in zip(a.tolist(), (b + length).tolist())),
                                 np.int64, len(a))
                row = np.array(which)[text]
                shift = np.array(offset)[text] - start[text]
                yield pa.record_batch({
                    "doc": pa.array(doc[row]), "th": th.take(pa.array(row)),
                    "a": pa.array((a + shift).astype(np.int32)), "b": pa.array((b + shift).astype(np.int32)),
                    "h": pa.array(h.view(np.int64)), "ph": pa.array(ph)})

    return rows.select("doc", "th", "body").mapInArrow(
        run, "doc long, th binary, a int, b int, h long, ph long")


def fetched(asked: DataFrame, length: int) -> DataFrame:
    """Rows (doc, th, body, at: list of pieces) -> one row per piece with its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                places = part.column("at")
                row = pc.list_parent_indices(places)
                flat = places.flatten()
                bodies = [memoryview(t) for t in part.column("body").to_pylist()]
                data = [bytes(bodies[r][a:b + length]) for r, a, b in zip(
                    row.to_pylist(), flat.field("a").to_pylist(), flat.field("b").to_pylist())]
                yield pa.record_batch({
                    "doc": part.column("doc").take(row), "th": part.column("th").take(row),
                    **{k: flat.field(k) for k in ("a", "h", "n", "crowded")},
                    "data": pa.array(data, pa.binary())})

    return asked.select("doc", "th", "body", "at").mapInArrow(
        run, "doc long, th binary, a int, h long, n long, crowded boolean, data binary")


class Shard:
    """Pieces that are sorted together: their bytes in a file of the task's own
    (in memory up to ``memory`` bytes), a few numbers for each."""

    def __init__(self, memory: int):
        self.memory = memory
        self.bytes = tempfile.SpooledTemporaryFile(memory)
        self.sizes: list[int] = []
        self.places: list[tuple] = []                    # doc, th, a, n

    def add(self, data: bytes, place: tuple) -> None:
        self.bytes.write(data)
        self.sizes.append(len(data))
        self.places.append(place)

    def repeated(self, length: int) -> Iterator[np.ndarray]:
        """Of each piece, the windows that start elsewhere too, by a suffix
        array over all pieces."""
        space, size = Space(self.memory), np.array(self.sizes, np.int64)
        ends = np.cumsum(size + 1)
        start, n = ends - size - 1, int(ends[-1]) + 1
        text = space.room(n, np.uint16)
        self.bytes.seek(0)
        low = 0
        while low < len(size):                           # pieces of about a block
            high = max(low + 1, int(np.searchsorted(ends, start[low] + space.block, "right")))
            part = np.ones(int(ends[high - 1] - start[low]), np.uint16)     # 1 ends a piece
            data = np.frombuffer(self.bytes.read(int(size[low:high].sum())), np.uint8)
            part[ragged(start[low:high] - start[low], size[low:high])] = data.astype(np.uint16) + 2
            text[start[low]:ends[high - 1]] = part
            low = high
        text[n - 1] = 0
        order, lcp = suffix_array(text, length, space=space)
        del text
        hit = space.room(n, bool)
        for a, b in space.blocks(n):
            hit[a:b] = False
        for a, b in space.blocks(n, 1):
            alike = lcp[a:b] >= length
            hit[order[a:b][alike]] = True
            hit[order[a - 1:b - 1][alike]] = True
        for s, k in zip(start.tolist(), size.tolist()):
            yield np.flatnonzero(hit[s:s + max(0, k - length + 1)])


def sorted_shards(shards: DataFrame, length: int, shard: int, memory: int) -> DataFrame:
    """(doc, th, lo, hi): ranges of repeated bytes in pieces that occur once.
    Grams are put together until they have ``shard`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(held: Shard) -> Iterator[pa.RecordBatch]:
            out = {"doc": [], "th": [], "lo": [], "hi": []}

            def batch() -> pa.RecordBatch:
                return pa.record_batch({"doc": pa.array(out["doc"], pa.int64()),
                                        "th": pa.array(out["th"], pa.binary()),
                                        **{k: pa.array(out[k], pa.int32()) for k in ("lo", "hi")}})

            for (doc, th, a, n), found in zip(held.places, held.repeated(length)):
                if len(found) and n == 1:
                    cut = np.flatnonzero(np.diff(found) > 1)
                    lo = found[np.concatenate(([0], cut + 1))] + a
                    hi = found[np.concatenate((cut, [len(found) - 1]))] + a + length
                    out["doc"] += [doc] * len(lo)
                    out["th"] += [th] * len(lo)
                    out["lo"] += lo.tolist()
                    out["hi"] += hi.tolist()
                    if len(out["lo"]) >= 100_000:
                        yield batch()
                        out = {k: [] for k in out}
            yield batch()

        held, size, gram = Shard(memory), 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("h", "data", "doc", "th", "a", "n"))):
                if row[0] != gram:
                    if size >= shard:
                        yield from solve(held)
                        held, size = Shard(memory), 0
                    gram = row[0]
                held.add(row[1], row[2:])
                size += len(row[1])
        if held.sizes:
            yield from solve(held)

    return shards.select("doc", "th", "a", "h", "n", "data").mapInArrow(
        run, "doc long, th binary, lo int, hi int")


def counted_windows(crowded: DataFrame, length: int) -> DataFrame:
    """(doc, th, lo, hi) for the windows of crowded grams that occur twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = row["data"]
                key = np.frombuffer(b"".join(
                    hashlib.blake2b(data[p:p + length], digest_size=16).digest()
                    for p in range(len(data) - length + 1)), np.int64).reshape(-1, 2)
                m = len(key)
                yield pa.record_batch({
                    "w1": pa.array(key[:, 0].copy()), "w2": pa.array(key[:, 1].copy()),
                    "doc": pa.array(np.full(m, row["doc"], np.int64)),
                    "th": pa.array([row["th"]] * m, pa.binary()),
                    "lo": pa.array(row["a"] + np.arange(m, dtype=np.int32)),
                    "n": pa.array(np.full(m, row["n"], np.int64))})

    windows = crowded.select("doc", "th", "a", "n", "data").mapInArrow(
        run, "w1 long, w2 long, doc long, th binary, lo int, n long")
    often = store(windows.groupBy("w1", "w2").agg(F.sum("n").alias("all")).where("all > 1")
                  .select(F.col("w1").alias("k1"), F.col("w2").alias("k2")), "windows")
    return (windows.where("n = 1").join(often, (F.col("w1") == F.col("k1")) & (F.col("w2") == F.col("k2")))
            .select("doc", "th", "lo", (F.col("lo") + length).alias("hi")))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with the names of the joins: doc, th and body."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    return docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.substring(F.unhex(F.sha2(body, 256)), 1, 16).alias("th"), body.alias("body"))


def _few(keys: DataFrame) -> DataFrame:
    """(d, t) of a table of documents, to be broadcast if they are few."""
    keys = store(keys.select(F.col("doc").alias("d"), F.col("th").alias("t")).distinct(), "documents")
    return F.broadcast(keys) if keys.count() <= FEW else keys


def _same(a: str = "doc", b: str = "th") -> Column:
    return (F.col(a) == F.col("d")) & (F.col(b) == F.col("t"))


def repeated_ranges(rows: DataFrame, length: int, gram: int = GRAM, crowd: int = CROWD,
                    shard: int = SHARD, memory: int = MEMORY) -> DataFrame:
    """(doc, th, lo, hi): byte ranges that are covered by repeated windows
    (they may overlap) of ``rows`` (doc, th, body)."""
    found = store(anchored(rows, length, gram), "anchors")
    # counts are written: between two plain exchanges, adaptive execution can split a hot gram's join
    often = store(found.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
                  .select(F.col("h").alias("g")), "often")
    found = store(found.join(often, F.col("h") == F.col("g")).drop("g"), "shared")
    kinds = found.groupBy("h", "ph").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "th", "a", "b")).alias("one"))
    kinds = store(kinds, "kinds")
    # broadcast before anything is shuffled, where they are few: a hot piece's rows stay in their tasks
    equal = store(kinds.where("n > 1").select(F.col("h").alias("h2"), F.col("ph").alias("p2")), "equal")
    equal = F.broadcast(equal) if equal.count() <= FEW else equal
    whole = (found.join(equal, (F.col("h") == F.col("h2")) & (F.col("ph") == F.col("p2")))
             .select("doc", "th", F.col("a").alias("lo"), (F.col("b") + length).alias("hi")))
    several = store(kinds.groupBy("h").agg(F.count("*").alias("k")).where("k > 1")
                    .select(F.col("h").alias("h3"), (F.col("k") > crowd).alias("crowded")), "several")
    asked = (kinds.join(several, F.col("h") == F.col("h3"))
             .select("one.*", "h", "n", "crowded").groupBy("doc", "th")
             .agg(F.collect_list(F.struct("a", "b", "h", "n", "crowded")).alias("at")))
    asked = store(asked, "asked")
    holders = rows.join(_few(asked), _same(), "left_semi").dropDuplicates(["doc", "th"])
    got = store(fetched(holders.join(asked, ["doc", "th"]), length), "pieces")
    shards = (got.where("not crowded").repartition("h").sortWithinPartitions("h"))
    found = whole.unionByName(sorted_shards(shards, length, shard, memory))
    if not several.where("crowded").isEmpty():
        found = found.unionByName(counted_windows(got.where("crowded"), length))
    return store(found, "ranges")


def _cut(body: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, list[dict[str, int]]]:
    spans: list[dict[str, int]] = []
    for lo, hi in sorted(ranges):
        if spans and lo <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], hi)
        else:
            spans.append({"start": lo, "end": hi})
    parts, at = [], 0
    for s in spans:
        parts.append(body[at:s["start"]])
        at = s["end"]
    return b"".join([*parts, body[at:]]), spans


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400,
                   gram: int = GRAM, crowd: int = CROWD, as_text: bool = False, shard: int = SHARD,
                   memory: int = MEMORY) -> DataFrame:
    """``docs`` as a struct ``row``, the bytes that are left of each text
    (``kept``; as text, without the rest of characters that a cut went through)
    and the removed byte ranges (``spans``).

    ``shard`` is how many bytes of pieces are sorted together, ``memory`` how
    many entries of each array a sort holds: a shard may be far larger, its
    arrays and queues are then in files of the task's own."""
    rows = _keyed(docs, doc_id, text)
    ranges = repeated_ranges(rows.select("doc", "th", "body"), length, gram, crowd, shard, memory)
    touched = _few(ranges)
    at = ranges.groupBy("doc", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("at"))
    span = "array<struct<start:int,end:int>>"
    clean = rows.join(touched, _same(), "left_anti").select(
        "row", F.col("body").cast("string" if as_text else "binary").alias("kept"), F.array().cast(span).alias("spans"))
    dirty = rows.join(touched, _same(), "left_semi").join(at, ["doc", "th"]).select("row", "body", "at")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [_cut(body, [(x["lo"], x["hi"]) for x in at]) for body, at in zip(
                batch.column("body").to_pylist(), batch.column("at").to_pylist())]
            kept = [k.decode("utf-8", "ignore") if as_text else k for k, _ in done]
            yield pa.record_batch({"row": batch.column("row"),
                                   "kept": pa.array(kept, pa.string() if as_text else pa.binary()),
                                   "spans": pa.array([s for _, s in done], kind)})

    return dirty.mapInArrow(run, clean.schema).unionByName(clean)


def cut_documents(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with what is left of each text, and n_chars to match."""
    out = remove_repeats(docs, as_text=True, **how)
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long").alias("n_bytes"),
        removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
