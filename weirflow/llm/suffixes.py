"""Suffix arrays by induced sorting, bucket by bucket in numpy, and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The leftmost S of every run of S
starts a substring; these are sorted by inducing, named, and the string of names is sorted recursively. From the order of
the leftmost-S suffixes all others are induced in two linear scans. A scan takes a bucket (a first symbol)
at a time: what is already in it is pushed on as one array. That pays while buckets are few: a string of more than
``SYMBOLS`` different names is sorted by doubling ranks, which ends the recursion.
"""

from __future__ import annotations

import numpy as np

from weirflow.llm.ragged import positions

SYMBOLS = 512
_ZERO = np.zeros(1, np.int64)


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one to its right; the last is smaller than nothing, by convention S."""
    rise = np.diff(t.astype(np.int32))
    at = np.where(rise != 0, np.arange(len(rise)), len(rise))
    after = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(np.append(rise, 1)[after] > 0, True)


def _place(order: np.ndarray, symbols: np.ndarray, pointer: np.ndarray, step: int, out: np.ndarray) -> None:
    """Puts suffixes, in order, at the pointers of their symbols and moves the pointers."""
    by = np.argsort(symbols, kind="stable")
    symbols = symbols[by]
    begin = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    begin = np.concatenate([_ZERO, begin])
    size = np.concatenate([begin[1:], [len(symbols)]]) - begin
    first = symbols[begin]
    shift = pointer[first] - step * begin
    out[np.repeat(shift, size) + step * np.arange(len(symbols))] = order[by]
    pointer[first] += step * size


def _induce(t: np.ndarray, smaller: np.ndarray, counts: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """All suffixes from those that start at ``leftmost``, in their order."""
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.full(len(t), -1, np.int64)
    used = np.flatnonzero(counts)
    # Leftmost-S suffixes, grouped by symbol in their order.
    by = np.argsort(t[leftmost], kind="stable")
    grouped = leftmost[by]
    of = np.searchsorted(t[grouped], np.arange(len(counts) + 1))
    head = starts.copy()

    def push(batch: np.ndarray, wanted: bool, pointer: np.ndarray, step: int) -> None:
        before = batch[batch > 0] - 1
        before = before[smaller[before] == wanted]
        if len(before):
            _place(before, t[before], pointer, step, out)

    for c in used.tolist():
        done = starts[c]
        while done < head[c]:
            batch = out[done : head[c]]
            done = int(head[c])
            push(batch, False, head, 1)
        if of[c] < of[c + 1]:
            push(grouped[of[c] : of[c + 1]], False, head, 1)
    tail = ends - 1
    for c in used[::-1].tolist():
        done = ends[c] - 1
        while done > tail[c]:
            batch = out[int(tail[c]) + 1 : done + 1][::-1]
            done = int(tail[c])
            push(batch, True, tail, -1)
        if head[c] > starts[c]:
            push(out[starts[c] : head[c]][::-1], True, tail, -1)
    # The end mark is the only suffix nothing induces.
    out[0] = len(t) - 1
    return out


def _by_doubling(rank: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of many symbols: ranks of twice as many symbols in every round."""
    size, width = len(rank), 1
    while True:
        after = np.zeros(size, np.int64)
        after[: size - width] = rank[width:] + 1
        key = rank * (size + 1) + after
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(size, np.int64)
        rank[order] = np.append(0, np.cumsum(key[1:] != key[:-1]))
        if rank[order[-1]] == size - 1:
            return order
        width *= 2


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Order of all suffixes of ``t``, whose last symbol is 0 and stands nowhere else."""
    smaller = _types(t)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    counts = np.bincount(t, minlength=symbols)
    if len(leftmost) <= 1:
        return _induce(t, smaller, counts, leftmost)
    is_left = np.zeros(len(t), bool)
    is_left[leftmost] = True
    roughly = _induce(t, smaller, counts, leftmost)
    in_order = roughly[is_left[roughly]]
    # Names: equal substrings, from one leftmost S to the next, get equal numbers.
    after = np.append(leftmost[1:], len(t) - 1)
    size = after - leftmost + 1
    where = np.empty(len(t), np.int64)
    where[leftmost] = np.arange(len(leftmost))
    k = where[in_order]
    differ = np.ones(len(k), bool)
    same_size = size[k[1:]] == size[k[:-1]]
    near = np.flatnonzero(same_size)
    if len(near):
        n = size[k[near]]
        unequal = t[positions(leftmost[k[near]], n)] != t[positions(leftmost[k[near + 1]], n)]
        begin = np.cumsum(n) - n
        differ[near + 1] = np.logical_or.reduceat(unequal, begin)
    names = np.cumsum(differ) - 1
    if names[-1] + 1 < len(k):
        name = np.empty(len(k), np.int64)
        name[k] = names
        if names[-1] < SYMBOLS:
            order = suffix_array(np.append(name + 1, 0).astype(np.uint16), int(names[-1]) + 2)[1:]
        else:
            order = _by_doubling(name)
        in_order = leftmost[order]
    return _induce(t, smaller, counts, in_order)


def repeated_prefix(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """In text order: whether a suffix shares ``length`` symbols with the one before it in suffix order.

    The permuted common prefix, cut at ``length``: compared eight bytes at a time with the suffix's neighbour.
    ``text`` are bytes; suffixes shorter than ``length`` share nothing.
    """
    before = np.full(len(text), -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.append(text, np.zeros(length + 8, np.uint8))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    packed = np.ascontiguousarray(words).view(np.uint64).ravel()
    left = np.flatnonzero(before >= 0)
    left = left[np.maximum(left, before[left]) + length <= len(text)]
    for offset in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        left = left[packed[left + offset] == packed[before[left] + offset]]
    out = np.zeros(len(text), bool)
    out[left] = True
    return out
