"""Arrow batches as complete groups of sorted rows, for block-wise kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    out = {}
    for name, column in zip(batch.schema.names, batch.columns):
        if pa.types.is_list(column.type):
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            ends = ends - ends[0]
            values = np.empty(len(column), object)
            values[:] = [flat[a:b] for a, b in zip(ends, ends[1:])]
            out[name] = values
        elif pa.types.is_binary(column.type) or pa.types.is_string(column.type):
            values = np.empty(len(column), object)
            values[:] = column.to_pylist()
            out[name] = values
        else:
            out[name] = column.to_numpy(zero_copy_only=False)
    return out


def complete_groups(batches: Iterator[pa.RecordBatch], keys: list[str]
                    ) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Columns of whole groups (rows of equal ``keys`` stand together) with the
    groups' bounds; at most one batch and one group are held."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = _columns(batch)
        if held is not None:
            cols = {k: np.concatenate((held[k], cols[k])) for k in cols}
        n = len(cols[keys[0]])
        change = np.zeros(n, bool)
        change[0] = True
        for k in keys:
            change[1:] |= cols[k][1:] != cols[k][:-1]
        starts = np.flatnonzero(change)
        last = starts[-1]
        held = {k: v[last:] for k, v in cols.items()}
        if last:
            yield {k: v[:last] for k, v in cols.items()}, starts
    if held is not None:
        yield held, np.array([0, len(held[keys[0]])])


def matrix(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) for each length of list in the column."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        at = (ends[rows] - dim)[:, None] + np.arange(dim)
        yield dim, rows, flat[at]


def smallest_linked(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable over the links of a symmetric boolean matrix."""
    label = ids.copy()
    biggest = np.iinfo(label.dtype).max
    while True:
        new = np.minimum(label, np.where(near, label, biggest).min(axis=1, initial=biggest))
        if (new == label).all():
            return label
        label = new
