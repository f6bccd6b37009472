"""Ragged numpy arrays: one flat value array and the length of every row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Offset of every row in the flat array."""
    out = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=out[1:])
    return out


def positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Flat indices ``starts[r], starts[r] + 1, ...`` of every row r, row after row."""
    shift = starts - starts_of(lengths) if len(lengths) else starts
    return np.repeat(shift, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


def utf8_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, row starts and row lengths of a string column; a null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat, offsets[:-1], np.diff(offsets)


def chunks(lengths: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``size`` values; a longer row is a range of its own."""
    ends, first = np.cumsum(lengths), 0
    while first < len(lengths):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield first, last
        first = last
