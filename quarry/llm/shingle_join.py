"""N-gram Jaccard join: MinHash banding, block-wise exact verification.

Words are the runs of word characters of the lower-cased text; a document's
set holds the 64-bit hashes of its distinct word n-grams (of all its words
together where it has fewer than n).

1. One pass over the texts gives each document a key of its whole set and
   ``bands`` hashes of ``rows`` minima each; the number of bands follows from
   the recall wanted at the threshold.  Documents with equal sets are one
   class from here on (a representative with a count).
2. Representatives are shuffled on band hashes.  Large buckets are cut into
   blocks.  A bucket row goes on only if it meets somebody there for the first
   time, which the band hashes of both sides tell.
3. The rows that go on fetch the full sets, meet once more, and all their
   pairs are verified on the sets by blocks.  No pair list is written: a
   task emits per document its number of links (a pair counts in the first
   band it shares) and the smallest document linked through the bucket, whose
   star edges go to the distributed connected components.

Defined results: null and empty texts (no words) link with nothing; rows
without an id are told apart by their texts, take part in the classes and come
after all others in the choice of a class's row (their class_id is the smallest
id of the class, null if it has none, and kept is null); repeated rows (equal
id) count as copies, one result row per row; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import REMEMBERED_CHARS, bands_for, offsets, read, store, with_block_pairs
from quarry.llm.components import components
from quarry.llm.groups import complete_groups, smallest_linked

WORD = re.compile(r"\w+")
#: Rows of a bucket that one block holds.
BLOCK = 512
#: Shingles hashed at a time (keeps the work in the processor's cache).
CHUNK = 1 << 15
#: Distinct words whose hashes a task remembers.
REMEMBERED = 1 << 18

#: Where a row meets others: a pair of blocks of a bucket of a band.
PLACE = ("bucket", "band", "_a", "_b", "_blk")
PLACE_TYPE = "bucket long, band int, _a int, _b int, _blk int"

#: Names a row: whether it has no id, the id (or 0), a hash of the text.
KNOWN = ("none", "doc", "th")

_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    held = 0

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED or self.held > REMEMBERED_CHARS:
            self.clear()
            self.held = 0
        self.held += len(word)
        self[word] = value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def shingles(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text."""
    words = WORD.findall((text or "").lower())
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    n = min(n, len(h))
    total = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        total = (total ^ h[i:i + len(total)]) * _MIX
        total ^= total >> np.uint64(29)
    return np.unique(total)


def signature(sets: list[np.ndarray], bands: int, rows: int, seed: int = 1) -> np.ndarray:
    """Band hashes (uint64, sets x bands) of non-empty sets."""
    rng = np.random.default_rng(seed)
    xor = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    mul = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(sets), bands), np.uint64)
    at = 0
    while at < len(sets):
        to, size = at, 0
        while to < len(sets) and (to == at or size + len(sets[to]) <= CHUNK):
            size += len(sets[to])
            to += 1
        x = np.concatenate(sets[at:to])
        start = offsets(np.fromiter(map(len, sets[at:to]), np.int64, to - at))[:-1]
        band = np.zeros((bands, to - at), np.uint64)
        for k in range(bands * rows):
            low = np.minimum.reduceat((x ^ xor[k]) * mul[k], start)
            b = k // rows
            band[b] = (band[b] ^ low) * _MIX
            band[b] ^= band[b] >> np.uint64(31)
        out[at:to] = band.T
        at = to
    return out


def set_key(grams: bytes) -> bytes:
    return hashlib.blake2b(grams, digest_size=16).digest()


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(none, doc, th, set_key, bands) of every document; null where it has no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t, n, hashes) for t in part.column("text").to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                keys: list[bytes | None] = [None] * len(sets)
                sig: list[np.ndarray | None] = [None] * len(sets)
                for i, s in zip(full, signature([sets[i] for i in full], bands, rows)):
                    sig[i] = s.view(np.int64)
                    keys[i] = set_key(sets[i].tobytes())
                yield pa.record_batch({**{k: part.column(k) for k in ("none", "doc", "th")},
                                       "set_key": pa.array(keys, pa.binary()),
                                       "bands": pa.array(sig, pa.list_(pa.int64()))})

    return docs.mapInArrow(run, "none boolean, doc long, th long, set_key binary, bands array<long>")


def needed(meets: DataFrame) -> DataFrame:
    """The bucket rows that meet another one for the first time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, bounds in complete_groups(batches, ["bucket", "_a", "_b"]):
            keep = np.zeros(len(cols["id"]), bool)
            for a, b in zip(bounds[:-1], bounds[1:]):
                if b - a < 2:
                    continue
                sig = np.stack(list(cols["bands"][a:b]))
                new = ~np.eye(b - a, dtype=bool)
                if cols["_a"][a] != cols["_b"][a]:
                    block = cols["_blk"][a:b]
                    new &= block[:, None] != block
                for t in range(cols["band"][a]):
                    new &= sig[:, t][:, None] != sig[:, t]
                keep[a:b] = new.any(axis=1)
            if keep.any():
                yield pa.record_batch({k: pa.array(cols[k][keep])
                                       for k in ("id", *PLACE)})

    return meets.mapInArrow(run, "id long, " + PLACE_TYPE)


def _by_places(batch: pa.RecordBatch, most: int = 1000) -> Iterator[pa.RecordBatch]:
    """Rows with about ``most`` places together."""
    block = np.cumsum(batch.column("at").value_lengths().to_numpy(zero_copy_only=False)) // most
    cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def with_sets(docs: DataFrame, n: int) -> DataFrame:
    """Rows (id, set_key, text, at: list of bucket places) -> one row per place
    with the whole set; texts that have another set (a repeated document id)
    are passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in _by_places(batch):
                sets = [shingles(t, n, hashes).tobytes() for t in part.column("text").to_pylist()]
                right = [set_key(s) == k for s, k in zip(sets, part.column("set_key").to_pylist())]
                part = part.append_column("grams", pa.array(sets, pa.binary())).filter(pa.array(right))
                places = part.column("at")
                row = pc.list_parent_indices(places)
                places = places.flatten()
                yield pa.record_batch({
                    **{k: part.column(k).take(row) for k in ("id", "bands", "copies", "grams")},
                    **{k: places.field(k) for k in PLACE}})

    return docs.mapInArrow(run, "id long, bands array<long>, copies long, grams binary, " + PLACE_TYPE)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted distinct sets."""
    if len(sets) == 2:
        both = np.concatenate(sets)
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        return np.array([[len(sets[0]), common], [common, len(sets[1])]])
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[gram]
    row, gram = row[keep], place[gram[keep]]
    order = np.argsort(gram, kind="stable")
    row, gram = row[order], gram[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = max(256, (1 << 21) // len(sets))
    total = int(shared.sum())
    for low in range(0, total, width):
        a, b = np.searchsorted(gram, [low, low + width])
        part = np.zeros((len(sets), min(width, total - low)), np.float32)
        part[row[a:b], gram[a:b] - low] = 1
        out += part @ part.T
    return out.astype(np.int64)


def verify(rows: DataFrame, threshold: float) -> DataFrame:
    """(id, links, low): links found here first, weighted by copies, and the
    smallest document linked through this bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, bounds in complete_groups(batches, ["bucket", "_a", "_b"]):
            out_id, out_links, out_low = [], [], []
            for a, b in zip(bounds[:-1], bounds[1:]):
                _, own = np.unique(cols["id"][a:b], return_index=True)   # a repeated row adds nothing
                if len(own) < 2:
                    continue
                own += a
                ids, copies = cols["id"][own], cols["copies"][own]
                sets = [np.frombuffer(g, np.uint64) for g in cols["grams"][own]]
                size = np.fromiter(map(len, sets), np.int64, len(sets))
                common = intersections(sets)
                near = common >= threshold * (size[:, None] + size - common)
                np.fill_diagonal(near, False)
                if cols["_a"][a] != cols["_b"][a]:
                    block = cols["_blk"][own]
                    near &= block[:, None] != block
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                sig = np.stack(list(cols["bands"][own]))
                first = np.ones(len(i), bool)
                for t in range(cols["band"][a]):
                    first &= sig[i, t] != sig[j, t]
                linked = np.unique(i)
                out_id.append(ids[linked])
                out_links.append(np.bincount(i[first], copies[j[first]], len(own))[linked])
                out_low.append(smallest_linked(near, ids)[linked])
            if out_id:
                yield pa.record_batch({
                    "id": pa.array(np.concatenate(out_id)),
                    "links": pa.array(np.concatenate(out_links).astype(np.int64)),
                    "low": pa.array(np.concatenate(out_low))})

    return rows.mapInArrow(run, "id long, links long, low long")


def _known(doc_id: str, text: str) -> list[Column]:
    """What a row is known by in the joins (KNOWN)."""
    own = F.col(doc_id).cast("long")
    return [own.isNull().alias("none"), F.coalesce(own, F.lit(0)).alias("doc"), F.xxhash64(text).alias("th")]


def _classes(docs: DataFrame, doc_id: str, text: str, n: int, threshold: float, rows: int,
             recall: float) -> tuple[DataFrame, DataFrame]:
    """(none, doc, th, set_key) of every row of ``docs`` (set_key is null where
    there are no words), and (set_key, none, doc, th, component, n_links) of
    every different set: the least row that has it, and its class."""
    bands = bands_for(threshold, rows, recall)
    texts = docs.select(*_known(doc_id, text), F.col(text).alias("text"))
    signed = store(signatures(texts, n, bands, rows), "signatures")
    reps = store(
        signed.where("set_key is not null").groupBy("set_key")
        .agg(F.min(F.struct(*KNOWN)).alias("one"), F.count("*").alias("copies"),
             F.first("bands").alias("bands"))
        .select("set_key", "one.*", "copies", "bands", F.xxhash64("set_key").alias("id")), "representatives")
    buckets = reps.select("id", F.posexplode("bands").alias("band", "value")) \
                  .select("id", "band", F.xxhash64("band", "value").alias("bucket"))
    meets = (with_block_pairs(buckets, "bucket", F.col("id"), BLOCK)
             .join(reps.select("id", "bands"), "id")
             .repartition("bucket", "_a", "_b").sortWithinPartitions("bucket", "_a", "_b"))
    places = store(needed(meets).groupBy("id").agg(F.collect_list(F.struct(*PLACE)).alias("at")),
                   "places")
    # any number of rows may have the id (or none) and the text that is asked for: every task
    # gives one of them before the exchange
    asked = places.join(reps, "id").join(texts.dropDuplicates([*KNOWN]), [*KNOWN])
    meets = (with_sets(asked.select("id", "set_key", "text", "at", "bands", "copies"), n)
             .repartition("bucket", "_a", "_b").sortWithinPartitions("bucket", "_a", "_b"))
    found = store(verify(meets, threshold), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.select("id", "low"), "id", "low")
    named = (reps.select("set_key", "id", *KNOWN, "copies")
             .join(parts, F.col("id") == F.col("node"), "left")
             .join(links, "id", "left"))
    return signed.select(*KNOWN, "set_key"), named.select(
        "set_key", *KNOWN, F.coalesce("component", "id").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5,
            threshold: float = 0.8, rows: int = 5, recall: float = 0.9995) -> DataFrame:
    """(doc_id, text_hash, n_links, class_id, kept) of every row of ``docs``: the
    number of other rows linked directly, the smallest id reachable by links,
    and whether that is its own (null without an id).  Where ids repeat, two
    classes can have the same class_id."""
    signed, named = _classes(docs, doc_id, text, n, threshold, rows, recall)
    own = F.when(~F.col("none"), F.col("doc"))
    lowest = named.groupBy(F.col("component").alias("c")).agg(F.min(own).alias("class_id"))
    named = (named.join(lowest, F.col("component") == F.col("c"))
             .select(F.col("set_key").alias("k"), "class_id", "n_links"))
    return signed.join(named, F.col("set_key") == F.col("k"), "left").select(
        own.alias("doc_id"), F.col("th").alias("text_hash"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("class_id", own).alias("class_id"),
        (F.coalesce("class_id", own) == own).alias("kept"))


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``classes`` that have an id."""
    return classes(docs, **how).where("doc_id is not null")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5,
                  threshold: float = 0.8, rows: int = 5, recall: float = 0.9995) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class, whatever ids
    repeat, the row with the smallest id (of rows that repeat that id, or where no
    row has one, that whose text hashes lowest); rows without words stay."""
    signed, named = _classes(docs, doc_id, text, n, threshold, rows, recall)
    one = named.groupBy("component").agg(F.min(F.struct(*KNOWN)).alias("one")).select("one.*")
    bare = signed.where("set_key is null").select(*KNOWN).distinct()
    kept = one.withColumn("bare", F.lit(False)).unionByName(bare.withColumn("bare", F.lit(True)))
    found = (docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), *_known(doc_id, text))
             .join(kept, [*KNOWN]))
    own = F.when(F.col("bare"), F.monotonically_increasing_id())         # nobody's copy
    return found.withColumn("own", own).dropDuplicates([*KNOWN, "own"]).select("row.*")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read(spark, sf_dir, "documents")).drop("text_hash")
