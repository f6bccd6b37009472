"""Small groups inside a map: rows arrive sorted by key, whole groups leave."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups and the start of each, plus the end; the first ``keys`` columns are the group.

    A group that goes on in the next batch waits for it, so memory holds one batch and one group.
    """
    waiting: list[pa.Table] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.ones(len(batch), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        first, here = tuple(c[0] for c in columns), pa.Table.from_batches([batch])
        if waiting and first != last:
            yield _closed(waiting)
            waiting = []
        cut = int(np.flatnonzero(new)[-1])
        last = tuple(c[-1] for c in columns)
        if cut == 0:
            waiting.append(here)
            continue
        begins = np.flatnonzero(new)
        if waiting:
            after = int(begins[1])
            yield _closed([*waiting, here.slice(0, after)])
            begins = begins[1:]
        if begins[0] < cut:
            yield here.slice(int(begins[0]), cut - int(begins[0])), begins - begins[0]
        waiting = [here.slice(cut)]
    if waiting:
        yield _closed(waiting)


def _closed(parts: list[pa.Table]) -> tuple[pa.Table, np.ndarray]:
    whole = pa.concat_tables(parts)
    return whole, np.array([0, len(whole)])
