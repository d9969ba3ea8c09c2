"""User-defined aggregates in two phases.

An ``Aggregator`` is four functions over a small buffer: ``zero``, ``reduce``
(values of one key into a buffer), ``merge`` and ``finish``.

* ``aggregate``: every task reduces its rows to one partial buffer per key
  (Arrow batches, at most ``MOST_KEYS`` keys at a time), partials are dealt by
  key and merged one after the other as they come.  No call ever holds a group:
  a hot key arrives as one partial per task.
* ``aggregate_stream``: the same partials inside each micro-batch, merged into
  keyed state (RocksDB) by a stateful processor; update mode.

Keys may be null and of any type; null values are skipped, as SQL does.  A
table without rows gives no row (one row with ``finish(zero)`` without keys).
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Keys that a task holds buffers of; beyond, it emits what it has.
MOST_KEYS = 100_000

Buffer = tuple


@dataclasses.dataclass(frozen=True)
class Aggregator:
    zero: Buffer
    reduce: Callable[[Buffer, np.ndarray], Buffer]
    merge: Callable[[Buffer, Buffer], Buffer]
    finish: Callable[[Buffer], Any]
    buffer: str                       # DDL of the buffer's fields
    result: str                       # DDL type of the result


def _reduced(keys: list[str], value: str, agg: Aggregator, out: T.StructType):
    names = [f.name for f in out]

    def emit(held: dict) -> pa.RecordBatch:
        frame = pd.DataFrame([(*key, *buf) for key, buf in held.values()], columns=names, dtype=object)
        return pa.RecordBatch.from_pylist(frame.to_dict("records"), schema=_arrow(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[tuple, Buffer]] = {}
        for batch in batches:
            values = batch.column(value)
            rows = [tuple(r) for r in zip(*(batch.column(k).to_pylist() for k in keys))] if keys else [()] * len(values)
            number: dict[str, int] = {}
            at = np.fromiter((number.setdefault(repr(r), len(number)) for r in rows), np.int64, len(rows))
            order = np.argsort(at, kind="stable")
            bounds = np.searchsorted(at[order], np.arange(len(number) + 1))
            some = np.asarray(values.is_valid())
            numbers = values.to_numpy(zero_copy_only=False)
            for (key, k) in number.items():
                own = order[bounds[k]:bounds[k + 1]]
                kept = numbers[own[some[own]]]
                before = held.get(key) or (rows[own[0]], agg.zero)
                held[key] = before[0], agg.reduce(before[1], kept) if len(kept) else before[1]
            if len(held) > MOST_KEYS:
                yield emit(held)
                held = {}
        if held:
            yield emit(held)

    return run


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def partials(df: DataFrame, keys: list[str], value: str, agg: Aggregator) -> DataFrame:
    """(keys, buffer): one row per key and task, or micro-batch and task."""
    rows = df.select(*keys, F.col(value).alias("_value"))
    out = T.StructType([f for f in rows.schema if f.name in keys] + T.StructType.fromDDL(agg.buffer).fields)
    return rows.mapInArrow(_reduced(keys, "_value", agg, out), out)


def aggregate(df: DataFrame, keys: list[str], value: str, agg: Aggregator, name: str) -> DataFrame:
    """One row per key: (keys, ``name``)."""
    parts = partials(df, keys, value, agg)
    fields = T.StructType.fromDDL(agg.buffer).fieldNames()
    out = T.StructType([f for f in parts.schema if f.name in keys] + T.StructType.fromDDL(f"`{name}` {agg.result}").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, buf = None, None
        seen = False
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                own = tuple(row[k] for k in keys)
                if seen and repr(own) == repr(key):
                    buf = agg.merge(buf, tuple(row[f] for f in fields))
                    continue
                if seen:
                    done.append((*key, agg.finish(buf)))
                key, buf, seen = own, tuple(row[f] for f in fields), True
            if done:
                yield _batch(done)
        if seen or not keys:
            yield _batch([(*(key or ()), agg.finish(buf if seen else agg.zero))])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(out.names, r)) for r in rows], schema=_arrow(out))

    merged = parts.repartition(*keys).sortWithinPartitions(*keys) if keys else parts.coalesce(1)
    return merged.mapInArrow(run, out)


class _Merging(StatefulProcessor):
    """Keeps one buffer per key and gives its result whenever it changes."""

    def __init__(self, keys: list[str], agg: Aggregator, name: str):
        self.keys, self.agg, self.name = keys, agg, name
        self.fields = T.StructType.fromDDL(agg.buffer).fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("buffer", self.agg.buffer)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        buf = tuple(self.state.get()) if self.state.exists() else self.agg.zero
        for part in rows:
            for row in part[self.fields].itertuples(index=False, name=None):
                buf = self.agg.merge(buf, tuple(x.item() if hasattr(x, "item") else x for x in row))
        self.state.update(buf)
        yield pd.DataFrame({**{k: [v] for k, v in zip(self.keys, key)}, self.name: [self.agg.finish(buf)]})

    def close(self) -> None:
        pass


def aggregate_stream(df: DataFrame, keys: list[str], value: str, agg: Aggregator, name: str) -> DataFrame:
    """The streaming form: (keys, ``name``) of every key that a batch changed."""
    parts = partials(df, keys, value, agg)
    out = T.StructType([f for f in parts.schema if f.name in keys] + T.StructType.fromDDL(f"`{name}` {agg.result}").fields)
    return parts.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Merging(keys, agg, name), outputStructType=out, outputMode="Update", timeMode="None")


def _harmonic_finish(buf: Buffer) -> float:
    n, s = buf
    return float("nan") if n == 0 else float("inf") if s == 0 else n / s


def _harmonic_reduce(buf: Buffer, values: np.ndarray) -> Buffer:
    with np.errstate(divide="ignore"):
        v = values.astype(np.float64)
        # a zero of either sign counts as plus infinity
        return buf[0] + len(v), buf[1] + float(np.sum(np.where(v == 0, np.inf, 1.0 / v)))


#: The harmonic mean, with the rules of ``functions.harmonic``.
HARMONIC_MEAN = Aggregator(
    zero=(0, 0.0), reduce=_harmonic_reduce, merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
    finish=_harmonic_finish, buffer="n BIGINT, s DOUBLE", result="DOUBLE")
