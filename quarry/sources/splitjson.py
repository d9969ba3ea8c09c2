"""Large JSON documents read by many tasks.

A multi-line JSON document is one task for Spark's reader, however long it
is.  Here the elements of one of its top-level arrays become rows, and a
document is read in as many blocks as the scan has splits:

1. The file is scanned as *text that ends at closing braces*, which Spark
   splits like lines, in any store.  A block is what one split holds, so it
   begins behind a brace that may stand inside a string.
2. Per block, two scans -- one that begins outside of a string, one inside --
   find how the block changes the bracket depth, whether it ends inside a
   string, and the last key opened at each depth.  Chained along a file (one
   short row per block), these give the true state at the start of every block.
3. The second pass, which knows that state, cuts out the array's elements.  A
   block owns those that begin in it; the rest of one that goes on in later blocks
   is emitted there as a fragment and joined to it.

Elements are written once as a table of JSON texts, which is splittable and is
parsed with a declared schema.  The array's key is compared as it is written.  Files must hold well-formed documents, one or
several behind each other; elements that are no objects or arrays are passed over.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import write_table

# whole strings, of which the last is kept, up to a bracket, a string that has no end yet, or the end
_TOKEN = re.compile(r'[^"{}\[\]]*+(?:"((?:[^"\\]++|\\.)*+)"[^"{}\[\]]*+)*+([{}\[\]"]|\Z)', re.S)
_STRING_END = re.compile(r'(?:[^"\\]++|\\.)*+"', re.S)
#: Characters scanned at a time.
_CHUNK = 1 << 20
#: Blocks whose states are broadcast at most (some 60 bytes each).
FEW_BLOCKS = 500_000


@contextmanager
def _split_size(spark: SparkSession, block_bytes: int | None):
    """Splits of ``block_bytes`` for the scans that run inside."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if block_bytes:
        spark.conf.set(key, str(block_bytes))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, piece): the text between closing braces, with its block."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("piece"))


class Scan:
    """Reads text piece by piece; ``depth`` counts open brackets relative to
    where it began.  ``opened`` is called with (position, depth before, key)
    at opening brackets, ``closed`` with (position behind, depth after) at
    closing ones; positions count the characters fed."""

    def __init__(self, inside: bool, depth: int = 0, opened=None, closed=None):
        self.inside, self.depth = inside, depth
        self.opened, self.closed = opened, closed
        self.keys: dict[int, str] = {}           # depth -> last key whose value opened there
        self._string = ""                        # last whole string: a key, if a bracket follows
        self._rest, self._at = "", 0             # unfinished string, position of its first character

    def feed(self, text: str) -> None:
        text = self._rest + text
        at = 0
        if self.inside:                          # began inside a string
            end = _STRING_END.match(text)
            if not end:
                self._keep(text, 0)
                return
            at, self.inside = end.end(), False
        unfinished = len(text)
        for token in _TOKEN.finditer(text, at):
            string, mark = token.groups()
            if string is not None:
                self._string = string
            if mark == "{" or mark == "[":
                self.keys[self.depth] = self._string
                if self.opened:
                    self.opened(self._at + token.start(2), self.depth, self._string)
                self._string = ""
                self.depth += 1
            elif mark == "}" or mark == "]":
                self.depth -= 1
                if self.closed:
                    self.closed(self._at + token.end(), self.depth)
            else:                                # an open string or the end
                unfinished = token.start(2)
                break
        self._keep(text, unfinished)

    def _keep(self, text: str, at: int) -> None:
        self._rest, self._at = text[at:], self._at + at

    @property
    def ends_inside(self) -> bool:
        return self.inside or bool(self._rest)


def _runs(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[str]]]:
    """(values of ``columns``, pieces) of rows that follow each other in one
    block, about _CHUNK bytes of them at most."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, start, piece = (batch.column(c) for c in ("file", "start", "piece"))
        new = np.ones(n, bool)
        new[1:] = np.asarray(pc.not_equal(file.slice(1), file.slice(0, n - 1)))
        new[1:] |= np.diff(start.to_numpy()) != 0
        part = np.cumsum(np.asarray(pc.binary_length(piece)), dtype=np.int64) // _CHUNK
        new[1:] |= part[1:] != part[:-1]
        cuts = np.flatnonzero(new).tolist()
        for lo, hi in zip(cuts, [*cuts[1:], n]):
            yield tuple(batch.column(c)[lo].as_py() for c in columns), piece.slice(lo, hi - lo).to_pylist()


def _blocks(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, Iterator[str]]]:
    """((file, start, more columns), its text in chunks) of every block; rows of
    a block follow each other.  Each block has to be read to its end."""
    runs = _runs(batches, ("file", "start", *columns))
    run = next(runs, None)
    while run is not None:
        block = run[0]

        def chunks() -> Iterator[str]:
            nonlocal run
            held, size = [], 0
            while run is not None and run[0] == block:
                held += run[1]
                size += sum(map(len, run[1])) + len(run[1])
                if size > _CHUNK:
                    yield "}".join([*held, ""])
                    held, size = [], 0
                run = next(runs, None)
            if held:
                yield "}".join([*held, ""])

        yield block, chunks()


_SUMMARY = ", ".join(f"{side}_inside boolean, {side}_delta int, {side}_keys map<int,string>" for side in ("out", "in"))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, start), chunks in _blocks(batches):
        scans = {"out": Scan(False), "in": Scan(True)}
        for text in chunks:
            for scan in scans.values():
                scan.feed(text)
        row = {"file": pa.array([file]), "start": pa.array([start], pa.int64())}
        for side, scan in scans.items():
            row[f"{side}_inside"] = pa.array([scan.ends_inside])
            row[f"{side}_delta"] = pa.array([scan.depth], pa.int32())
            row[f"{side}_keys"] = pa.array([list(scan.keys.items())], pa.map_(pa.int32(), pa.string()))
        yield pa.record_batch(row)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States at the start of the blocks, which come in the order of each file."""
    file, inside, depth, key = None, False, 0, ""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["file"] != file:
                file, inside, depth, key = row["file"], False, 0, ""
            out.append((file, row["start"], inside, depth, key))
            side = "in" if inside else "out"
            key = dict(row[f"{side}_keys"]).get(1 - depth, key)
            inside, depth = row[f"{side}_inside"], depth + row[f"{side}_delta"]
        cols = list(zip(*out)) or [()] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(
            cols, (pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.string()))],
            names=["at_file", "at_start", "inside", "depth", "key"])


def _elements(array: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start, inside, depth, key), chunks in _blocks(batches, "inside", "depth", "key"):
            current = key
            text, base = "", 0                   # what is not yet emitted, and the position of its start
            began = 0 if depth > 2 and current == array else None
            marks: list[tuple[int, int]] = []

            def opened(at: int, before: int, name: str) -> None:
                nonlocal current, began
                if before == 1:
                    current = name
                elif before == 2 and current == array:
                    began = at

            def closed(at: int, after: int) -> None:
                nonlocal began
                if after == 2 and began is not None:
                    marks.append((began, at))
                    began = None

            scan = Scan(inside, depth, opened, closed)
            goes_on = began is not None          # the first element began in an earlier block
            out: list[tuple[str, str]] = []
            for chunk in chunks:
                text += chunk
                scan.feed(chunk)
                for lo, hi in marks:
                    out.append(("last" if goes_on else "whole", text[lo - base:hi - base]))
                    goes_on = False
                marks.clear()
                keep = began if began is not None else base + len(text)
                text, base = text[keep - base:], keep
                if out:
                    yield _rows(file, start, out)
                    out = []
            if began is not None:
                yield _rows(file, start, [("middle" if goes_on else "first", text)])

    def _rows(file: str, start: int, out: list[tuple[str, str]]) -> pa.RecordBatch:
        kind, element = zip(*out)
        return pa.record_batch({"file": pa.array([file] * len(out)), "start": pa.array([start] * len(out), pa.int64()),
                                "kind": pa.array(kind), "element": pa.array(element)})

    return run


def array_elements(spark: SparkSession, path: str, array: str, block_bytes: int | None = None,
                   few_blocks: int = FEW_BLOCKS) -> DataFrame:
    """(file, element): the JSON text of every element of the top-level array
    ``array`` of the documents in ``path``, read in blocks of ``block_bytes``
    (default: the session's split size).  The elements are written once."""
    if "}" in array:
        raise ValueError("blocks end at closing braces, so the array's key cannot hold one")
    with _split_size(spark, block_bytes):
        pieces = _pieces(spark, path)
        summary = write_table(pieces.mapInArrow(_summaries, f"file string, start long, {_SUMMARY}"), "blocks")
        states = write_table(summary.repartition("file").sortWithinPartitions("file", "start").mapInArrow(
            _chained, "at_file string, at_start long, inside boolean, depth int, key string"), "states")
        same = (F.col("file") == F.col("at_file")) & (F.col("start") == F.col("at_start"))
        if states.count() <= few_blocks:         # rows keep their order beside a broadcast
            known = pieces.join(F.broadcast(states), same)
        else:
            known = (pieces.withColumn("pos", F.monotonically_increasing_id()).join(states, same)
                     .repartition("file", "start").sortWithinPartitions("file", "start", "pos"))
        found = write_table(known.select("file", "start", "inside", "depth", "key", "piece").mapInArrow(
            _elements(array), "file string, start long, kind string, element string"), "elements")
    whole = found.where("kind = 'whole'").select("file", "element")
    # one or two fragments a block; the one that begins an element numbers it
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == "first")
    parts = found.where("kind <> 'whole'").withColumn("n", F.count_if(F.col("kind") == "first").over(order))
    joined = (parts.groupBy("file", "n").agg(F.sort_array(F.collect_list(F.struct("start", "element"))).alias("parts"))
              .select("file", F.array_join(F.transform("parts", lambda p: p["element"]), "").alias("element")))
    return whole.unionByName(joined)


def read_array(spark: SparkSession, path: str, array: str, schema, block_bytes: int | None = None,
               few_blocks: int = FEW_BLOCKS, **options) -> DataFrame:
    """The elements of ``array`` parsed with ``schema`` (StructType or DDL), as
    the column ``array``."""
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    rows = array_elements(spark, path, array, block_bytes, few_blocks)
    return rows.select(F.from_json("element", ddl, {k: str(v) for k, v in options.items()}).alias(array))
