"""Finding windows of a sequence that also start elsewhere in the corpus, without moving the sequences.

A window is ``length`` consecutive items (bytes or words) of one text. Every window has a minimizer, the smallest hash
among the ``gram``-item pieces inside it; equal windows have equal minimizers. Consecutive windows with the same
minimizer form a run. So all a run has to be compared with are runs of the same minimizer.

1. Only hashes travel at first: per run the minimizer, a hash of its whole content, its text and its place, packed in
   arrays per bucket of minimizers. A run whose content also stands earlier is settled: all its windows repeat. Equal
   runs within one map block meet there already, so that a run which a third of all texts contain
   reaches its bucket once per block.
2. Runs that share a minimizer but not the content send their content, by bucket (``shard``).
3. What the shards find comes back as window ranges per text and source.

A minimizer that many different runs share (the windows at the edges of a passage reach into each text's own context) would
make one bucket large. Such minimizers are counted beforehand; their runs are dealt by content instead, and what is left of them
by the 128-bit hash of every window. Equal windows still meet, once per map block.

Texts are known by ``(lead, key)``: the id (a null id counts as the largest) and ``xxhash64`` of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm import ragged
from weirflow.llm.ragged import positions, starts_of
from weirflow.session import scratch_path

NO_ID = 2**63 - 1
CHUNK_ITEMS = 1 << 20
#: Bytes of text behind one bucket, on average.
BUCKET_BYTES = 8 << 20
#: Contents are dealt to so many times more buckets than hashes: they take more memory.
FINER = 4
#: Different runs of one minimizer from which on it is crowded, and in one map block for it to count there.
CROWD, CROWD_IN_BLOCK = 8192, 4
#: Windows of one run at most; a longer one (periodic text) is cut.
RUN_LIMIT = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)

#: Turns UTF-8 bytes and text lengths into hashed items and items per text.
Items = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Kind(NamedTuple):
    items: Items
    length: int
    gram: int
    #: Whether a window also repeats one that starts earlier in its own text.
    within: bool

    @property
    def reach(self) -> int:
        """Pieces inside a window."""
        return self.length - self.gram + 1


class Runs(NamedTuple):
    text: np.ndarray
    place: np.ndarray
    windows: np.ndarray
    minimizer: np.ndarray
    content: np.ndarray
    #: Index of the first item in the chunk.
    at: np.ndarray
    #: Whether the minimizer stands in the run more than once, so that a window may repeat another of the same run.
    doubled: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(31))


def sliding_hash(items: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive items, by doubling."""
    out, done = None, 0
    part, size, base = items, 1, _BASE
    n = len(items) - width + 1
    while size <= width:
        if width & size:
            piece = part[done : done + n]
            out = piece if out is None else out * base + piece
            done += size
        if size * 2 <= width:
            part = part[:-size] * base + part[size:]
        size, base = size * 2, np.uint64(int(base) ** 2 % 2**64)
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def find_runs(items: np.ndarray, counts: np.ndarray, kind: Kind) -> Runs:
    """Runs of all windows of all texts of a chunk."""
    none = np.zeros(0, np.int64)
    if len(items) < kind.length:
        return Runs(none, none, none, none.astype(np.uint64), none.astype(np.uint64), none, none.astype(bool))
    grams = mixed(sliding_hash(items, kind.gram))
    minimizer = sliding_min(grams, kind.reach)
    starts = starts_of(counts)
    n = np.maximum(counts - kind.length + 1, 0)
    whole = np.zeros(len(minimizer) + 1, bool)  # windows inside one text
    edge = np.zeros(len(minimizer) + 1, np.int32)
    some = n > 0
    np.add.at(edge, starts[some], 1)
    np.add.at(edge, starts[some] + n[some], -1)
    whole = np.cumsum(edge)[:-1] > 0
    new = whole.copy()
    new[1:] &= (minimizer[1:] != minimizer[:-1]) | ~whole[:-1]
    new[starts[some]] = True
    at = np.flatnonzero(new)
    stop = np.append(at[1:], len(minimizer))
    text = np.searchsorted(np.cumsum(counts), at, side="right")
    windows = np.minimum(stop, starts[text] + n[text]) - at
    if (windows > RUN_LIMIT).any():
        pieces = -(-windows // RUN_LIMIT)
        k = positions(np.zeros(len(at), np.int64), pieces)
        text, left = np.repeat(text, pieces), np.repeat(windows, pieces) - k * RUN_LIMIT
        at, windows = np.repeat(at, pieces) + k * RUN_LIMIT, np.minimum(left, RUN_LIMIT)
    sums = np.append(np.uint64(0), np.cumsum(items * _powers(len(items))[0]))
    end = at + windows + kind.length - 1
    content = mixed((sums[end] - sums[at]) * _powers(len(items))[1][at] + windows.astype(np.uint64))
    doubled = np.zeros(len(at), bool)
    if kind.within and len(at):
        width = windows + kind.reach - 1
        equal = grams[positions(at, width)] == np.repeat(minimizer[at], width)
        doubled = np.add.reduceat(equal, starts_of(width), dtype=np.int64) > 1
    return Runs(text, at - starts[text], windows, minimizer[at], content, at, doubled)


_POWER_CACHE: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    if not _POWER_CACHE or len(_POWER_CACHE[0][0]) < n:
        base = int(_BASE) | 1
        both = []
        for b in (base, pow(base, -1, 2**64)):
            powers = np.full(max(n, 1), np.uint64(b))
            powers[0] = 1
            both.append(np.multiply.accumulate(powers))
        _POWER_CACHE[:] = [tuple(both)]
    return _POWER_CACHE[0][0][:n], _POWER_CACHE[0][1][:n]


def each_chunk(batches: Iterator[pa.RecordBatch], kind: Kind) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, raw bytes, items and items per text of a few MB of texts; the texts are the column ``text``."""
    for batch in batches:
        flat, starts, lengths = ragged.utf8_column(batch, "text")
        for a, b in ragged.chunks(lengths, CHUNK_ITEMS):
            raw = flat[starts[a] : starts[b - 1] + lengths[b - 1]]
            items, counts = kind.items(raw, lengths[a:b])
            yield batch.slice(a, b - a), raw, items, counts


def _column(batch: pa.RecordBatch, k: int) -> np.ndarray:
    return batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)


def _blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One binary per slice."""
    raw, size = values.tobytes(), values.itemsize
    return pa.array([raw[a * size : b * size] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())


def _crowds(kind: Kind, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Minimizers of ``least`` or more different runs of a block, and how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, items, counts in each_chunk(batches, kind):
            r = find_runs(items, counts, kind)
            order = np.lexsort((r.content, r.minimizer))
            m, c = r.minimizer[order], r.content[order]
            other = np.append(True, (m[1:] != m[:-1]) | (c[1:] != c[:-1])) if len(m) else np.zeros(0, bool)
            minimizers, n = np.unique(m[other], return_counts=True)
            many = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(minimizers[many].view(np.int64)), pa.array(n[many].astype(np.int64))], ["minimizer", "n"])

    return run


def crowded(texts: DataFrame, kind: Kind) -> np.ndarray:
    """Minimizers that too many different runs share for one bucket, sorted."""
    counted = texts.mapInArrow(_crowds(kind, CROWD_IN_BLOCK), "minimizer long, n long")
    rows = counted.groupBy("minimizer").agg(F.sum("n").alias("n")).filter(F.col("n") >= CROWD).select("minimizer").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


_PACKED = (
    "bucket int, settled boolean, minimizers binary, contents binary, leads binary, keys binary, places binary, windows binary, "
    "s_leads binary, s_keys binary, s_places binary"
)
_SELF = np.uint32(1 << 31)  # mark of a run that may repeat itself


def _pack(kind: Kind, buckets: int, crowds: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (lead, key, text) to packed runs per bucket; those of crowded minimizers to as many more buckets by content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, items, counts in each_chunk(batches, kind):
            r = find_runs(items, counts, kind)
            if not len(r.text):
                continue
            lead, key = _column(rows, 0)[r.text], _column(rows, 1)[r.text]
            place = r.place.astype(np.uint32)
            if kind.within:
                place = np.where(r.doubled, place | _SELF, place)
            # Equal runs of the block: those after the first of the smallest id are settled here.
            order = np.lexsort((r.place, key, lead, r.content, r.minimizer))
            settled, source = _later(order, r.minimizer, r.content, lead, key, r.place, kind.within)
            home = (r.minimizer % np.uint64(buckets)).astype(np.int64)
            by_content = buckets + (r.content % np.uint64(buckets)).astype(np.int64)
            home = np.where(np.isin(r.minimizer, crowds), by_content, home)
            # Settled runs go anywhere; where they come from decides, not what they hold.
            bucket = np.where(settled, np.arange(len(home)) * 64 // max(1, len(home)) % buckets, home)
            order = np.lexsort((r.place, key, lead, bucket, settled))
            group = bucket[order] + settled[order] * 2 * buckets
            cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[order][cuts[:-1]].astype(np.int32)), pa.array(settled[order][cuts[:-1]]),
                    _blobs((r.minimizer // np.uint64(buckets))[order].astype(np.uint32), cuts), _blobs(r.content[order], cuts),
                    _blobs(lead[order], cuts), _blobs(key[order], cuts), _blobs(place[order], cuts),
                    *_extra(kind.within, r, lead, key, source, settled, order, cuts),
                ],
                names=["bucket", "settled", "minimizers", "contents", "leads", "keys", "places", "windows", "s_leads", "s_keys", "s_places"],
            )

    return run


def _extra(
    wanted: bool, r: Runs, lead: np.ndarray, key: np.ndarray, source: np.ndarray, settled: np.ndarray, order: np.ndarray, cuts: np.ndarray
) -> list[pa.Array]:
    """Numbers of windows, and sources of settled runs, where sources are asked for; else nulls."""
    if not wanted:
        return [pa.nulls(len(cuts) - 1, pa.binary())] * 4
    own = settled[order]
    few = np.append(0, np.cumsum(own))[cuts]
    at = source[order][own]
    return [
        _blobs(r.windows[order].astype(np.uint16), cuts), _blobs(lead[at], few), _blobs(key[at], few),
        _blobs(r.place[at].astype(np.uint32), few),
    ]


def _later(
    order: np.ndarray, minimizer: np.ndarray, content: np.ndarray, lead: np.ndarray, key: np.ndarray, place: np.ndarray, within: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Runs whose content stands in a text with a smaller id, or earlier in their own text; and the run where it does.

    ``order`` sorts by minimizer, content, id, text and place. A repeated row is its own text, not an earlier one.
    """
    m, c, i, k, p = minimizer[order], content[order], lead[order], key[order], place[order]
    new = np.ones(len(order), bool)
    new[1:] = (m[1:] != m[:-1]) | (c[1:] != c[:-1])
    rank = np.arange(len(order))
    first = np.maximum.accumulate(np.where(new, rank, 0))
    later = i > i[first]
    if within:
        own_new = new.copy()
        own_new[1:] |= (i[1:] != i[:-1]) | (k[1:] != k[:-1])
        own = np.maximum.accumulate(np.where(own_new, rank, 0))
        first = np.where(later, first, own)
        later |= p > p[own]
    out, source = np.zeros(len(order), bool), np.zeros(len(order), np.int64)
    out[order], source[order] = later, order[first]
    return out, source


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() or b"" for x in table.column(name)), kind)


_REPLIES = "lead long, key long, settled binary, open binary"
#: Windows begin to end of a text repeat those of the source from s_begin on.
PIECES = "lead long, key long, begin long, end long, s_lead long, s_key long, s_begin long"


def _judge(within: bool, buckets: int) -> Callable[[pa.Table], pa.Table]:
    """One bucket: which runs are settled, and which must send their content: of crowded minimizers, all others."""

    def run(table: pa.Table) -> pa.Table:
        by_content = table.column("bucket")[0].as_py() >= buckets
        known = table.filter(table.column("settled"))
        table = table.filter(pa.compute.invert(table.column("settled")))
        minimizer, content = _joined(table, "minimizers", np.uint32), _joined(table, "contents", np.uint64)
        lead, key = _joined(table, "leads", np.int64), _joined(table, "keys", np.int64)
        place = _joined(table, "places", np.uint32)
        order = np.lexsort((place & ~_SELF, key, lead, content, minimizer))
        later, source = _later(order, minimizer, content, lead, key, place & ~_SELF, within)
        # Of the runs left, those of one minimizer are open if they differ in content, and in text unless repeats
        # within a text count.
        m, c, i = minimizer[order], content[order], lead[order]
        new = np.append(True, m[1:] != m[:-1]) if len(m) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        several = np.append(False, (c[1:] != c[:-1]) & ~new[1:]) if len(m) else np.zeros(0, bool)
        is_open = np.bincount(group[several], minlength=len(begin)) > 0
        if not within and len(m):
            is_open &= np.minimum.reduceat(i, begin) < np.maximum.reduceat(i, begin)
        opened = np.zeros(len(order), bool)
        opened[order] = is_open[group] if len(m) else False
        if within:
            opened |= (place & _SELF) > 0
        opened |= by_content
        opened &= ~later
        status = np.where(later, 1, np.where(opened, 2, 0))
        if within:
            return _open_and_pieces(table, known, lead, key, place & ~_SELF, source, status)
        lead = np.concatenate([lead, _joined(known, "leads", np.int64)])
        key = np.concatenate([key, _joined(known, "keys", np.int64)])
        place = np.concatenate([place, _joined(known, "places", np.uint32)]) & ~_SELF
        status = np.concatenate([status, np.ones(len(lead) - len(status), np.int64)])
        keep = status > 0
        return _replies(lead[keep], key[keep], place[keep], status[keep])

    return run


def _open_and_pieces(
    table: pa.Table, known: pa.Table, lead: np.ndarray, key: np.ndarray, place: np.ndarray, source: np.ndarray, status: np.ndarray
) -> pa.Table:
    """Rows of settled runs with their sources, and of open runs (no source)."""
    windows = np.concatenate([_joined(table, "windows", np.uint16), _joined(known, "windows", np.uint16)]).astype(np.int64)
    at = source[status == 1]
    s_lead, s_key, s_place = (np.zeros(len(status), np.int64) for _ in range(3))
    s_lead[status == 1], s_key[status == 1], s_place[status == 1] = lead[at], key[at], place[at]
    begin = np.concatenate([place, _joined(known, "places", np.uint32) & ~_SELF]).astype(np.int64)
    status = np.concatenate([status, np.ones(len(windows) - len(status), np.int64)])
    columns = {
        "lead": np.concatenate([lead, _joined(known, "leads", np.int64)]),
        "key": np.concatenate([key, _joined(known, "keys", np.int64)]),
        "begin": begin, "end": begin + windows,
        "s_lead": np.concatenate([s_lead, _joined(known, "s_leads", np.int64)]),
        "s_key": np.concatenate([s_key, _joined(known, "s_keys", np.int64)]),
        "s_begin": np.concatenate([s_place, _joined(known, "s_places", np.uint32).astype(np.int64)]),
    }
    columns["s_begin"] = np.where(status == 1, columns["s_begin"], -1)
    return pa.table({name: values[status > 0] for name, values in columns.items()})


def _replies(lead: np.ndarray, key: np.ndarray, place: np.ndarray, status: np.ndarray) -> pa.Table:
    order = np.lexsort((place, key, lead))
    lead, key, place, status = lead[order], key[order], place[order], status[order]
    new = np.append(True, (lead[1:] != lead[:-1]) | (key[1:] != key[:-1])) if len(lead) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    columns = []
    for wanted in (1, 2):
        of = place[status == wanted]
        cuts = np.append(0, np.cumsum(status == wanted))[np.append(begin, len(lead))]
        columns.append(_blobs(of, cuts))
    return pa.table([pa.array(lead[begin]), pa.array(key[begin]), *columns], names=["lead", "key", "settled", "open"])


def places(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint32).astype(np.int64)


def chosen(rows: pa.RecordBatch, column: int, r: Runs) -> np.ndarray:
    """Runs of a chunk whose place is listed in a column of binaries per text."""
    listed = [np.sort(places(x or [])) for x in rows.column(column).to_pylist()]
    counts = np.array([len(x) for x in listed])
    wide = np.int64(1) << np.int64(32)
    wanted = np.repeat(np.arange(len(listed)), counts) * wide + np.concatenate([*listed, np.zeros(0, np.int64)])
    return np.isin(r.text * wide + r.place, wanted, assume_unique=True)


_SENT = "bucket int, leads binary, keys binary, places binary, windows binary, data binary, known binary"


def earlier_windows(
    one: np.ndarray, two: np.ndarray, lead: np.ndarray, key: np.ndarray, place: np.ndarray, within: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Whether each window, known by two hashes, repeats an earlier one; and the index of its source.

    The source is the earliest occurrence in the text with the smallest id, or, where that has the same id as the window's own
    text, the earliest in its own text.
    """
    order = np.lexsort((place, key, lead, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    rank = np.arange(len(order))
    first = np.maximum.accumulate(np.where(new, rank, 0))
    own_new = new.copy()
    own_new[1:] |= (lead[order][1:] != lead[order][:-1]) | (key[order][1:] != key[order][:-1])
    own = np.maximum.accumulate(np.where(own_new, rank, 0))
    from_other = lead[order] > lead[order][first]
    source = np.empty(len(order), np.int64)
    source[order] = order[np.where(from_other, first, own)]
    repeated = np.empty(len(order), bool)
    repeated[order] = from_other | (place[order] > place[order][own]) if within else from_other
    return repeated, source


_PIECE = ("lead", "key", "begin", "end", "s_lead", "s_key", "s_begin")


def _found(lead: np.ndarray, key: np.ndarray, place: np.ndarray, repeated: np.ndarray, source: np.ndarray, within: bool) -> np.ndarray:
    """Repeated windows that follow each other, in the source too where it counts, as rows of ``_PIECE``."""
    at = np.flatnonzero(repeated)
    at = at[np.lexsort((place[at], key[at], lead[at]))]
    s = source[at]
    goes_on = (lead[at[1:]] == lead[at[:-1]]) & (key[at[1:]] == key[at[:-1]]) & (place[at[1:]] == place[at[:-1]] + 1)
    if within:
        goes_on &= (lead[s[1:]] == lead[s[:-1]]) & (key[s[1:]] == key[s[:-1]]) & (place[s[1:]] == place[s[:-1]] + 1)
    begin, end = np.ones(len(at), bool), np.ones(len(at), bool)
    begin[1:], end[:-1] = ~goes_on, ~goes_on
    b, e, f = at[begin], at[end], s[begin]
    return np.stack([lead[b], key[b], place[b], place[e] + 1, lead[f], key[f], place[f]], 1)


def _deal_windows(kind: Kind, r: Runs, which: np.ndarray, items: np.ndarray, lead: np.ndarray, key: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Windows of some runs of a block: what repeats here, and the others packed by window hash in buckets after the usual ones."""
    size = r.windows[which]
    at, place = positions(r.at[which], size), positions(r.place[which], size)
    one, two = (sliding_hash(x, kind.length)[at] for x in (items, mixed(items)))
    lead, key = np.repeat(lead, size), np.repeat(key, size)
    repeated, source = earlier_windows(one, two, lead, key, place, kind.within)
    known = _found(lead, key, place, repeated, source, kind.within)
    left = np.flatnonzero(~repeated)
    bucket = buckets + (mixed(one[left]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    left, bucket = left[order], bucket[order]
    cuts = np.append(np.flatnonzero(np.append(True, np.diff(bucket) != 0)), len(left))
    firsts = bucket[cuts[:-1]]
    # What is known here rides along in one of the block's rows.
    rows = len(firsts)
    carrier = int(one[left[0]] % np.uint64(rows))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(firsts.astype(np.int32)), _blobs(lead[left], cuts), _blobs(key[left], cuts), _blobs(place[left].astype(np.uint32), cuts),
            pa.nulls(rows, pa.binary()), _blobs(np.stack([one[left], two[left]], 1).ravel(), cuts * 2),
            pa.array([known.tobytes() if k == carrier else None for k in range(rows)], pa.binary()),
        ],
        names=["bucket", "leads", "keys", "places", "windows", "data", "known"],
    )


def _work(work: Callable[[pa.Table], pa.Table], within: bool) -> Callable[[pa.Table], pa.Table]:
    """One bucket: contents by ``work``, dealt windows by their hashes."""

    def run(table: pa.Table) -> pa.Table:
        if not table.column("windows").null_count:
            return work(table)
        hashed = _joined(table, "data", np.uint64).reshape(-1, 2)
        lead, key = _joined(table, "leads", np.int64), _joined(table, "keys", np.int64)
        place = _joined(table, "places", np.uint32).astype(np.int64)
        repeated, source = earlier_windows(hashed[:, 0], hashed[:, 1], lead, key, place, within)
        found = _found(lead, key, place, repeated, source, within)
        found = np.concatenate([found, _joined(table, "known", np.int64).reshape(-1, len(_PIECE))])
        if within:
            return pa.table({name: found[:, k] for k, name in enumerate(_PIECE)})
        return ranges_per_text(*(found[:, k] for k in range(4)))

    return run


def _send(kind: Kind, buckets: int, crowds: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (lead, key, text, open places) to the contents of the open runs, packed per bucket.

    Content is bytes where items are bytes, else the items' hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, items, counts in each_chunk(batches, kind):
            r = find_runs(items, counts, kind)
            picked = chosen(rows, 3, r)
            dealt = picked & np.isin(r.minimizer, crowds)
            if dealt.any():
                which = np.flatnonzero(dealt)
                yield _deal_windows(kind, r, which, items, *(_column(rows, k)[r.text[which]] for k in (0, 1)), buckets)
            picked &= ~dealt
            if not picked.any():
                continue
            bucket = (r.minimizer[picked] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            which = np.flatnonzero(picked)[order]
            values = raw if len(raw) == len(items) else items
            size = r.windows[which] + kind.length - 1
            data = values[positions(r.at[which], size)]
            cuts = np.append(np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)), len(which))
            lead, key = _column(rows, 0)[r.text[which]], _column(rows, 1)[r.text[which]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[order][cuts[:-1]].astype(np.int32)), _blobs(lead, cuts), _blobs(key, cuts),
                    _blobs(r.place[which].astype(np.uint32), cuts), _blobs(r.windows[which].astype(np.uint16), cuts),
                    _blobs(data, np.append(0, np.cumsum(size))[cuts]), pa.nulls(len(cuts) - 1, pa.binary()),
                ],
                names=["bucket", "leads", "keys", "places", "windows", "data", "known"],
            )

    return run


class Shard(NamedTuple):
    """Runs of one bucket: text, place and number of windows of each, and their contents one after the other."""

    lead: np.ndarray
    key: np.ndarray
    place: np.ndarray
    windows: np.ndarray
    data: np.ndarray


def shard_of(table: pa.Table, item: type) -> Shard:
    return Shard(
        _joined(table, "leads", np.int64), _joined(table, "keys", np.int64), _joined(table, "places", np.uint32).astype(np.int64),
        _joined(table, "windows", np.uint16).astype(np.int64), _joined(table, "data", item),
    )


def ranges_per_text(lead: np.ndarray, key: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Table:
    """Window ranges, packed per text."""
    order = np.lexsort((begin, key, lead))
    lead, key, begin, end = lead[order], key[order], begin[order], end[order]
    new = np.append(True, (lead[1:] != lead[:-1]) | (key[1:] != key[:-1])) if len(lead) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    cuts = np.append(first, len(lead))
    return pa.table(
        [pa.array(lead[first]), pa.array(key[first]), _blobs(begin.astype(np.uint32), cuts), _blobs(end.astype(np.uint32), cuts)],
        names=["lead", "key", "begins", "ends"],
    )


RANGES = "lead long, key long, begins binary, ends binary"


class Found(NamedTuple):
    #: lead, key, text: every row of the input.
    texts: DataFrame
    #: What the buckets of hashes settle: lead, key, settled (places of runs), or pieces where repeats within a text count.
    settled: DataFrame
    #: What ``work`` finds.
    shards: DataFrame


def addressed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``lead, key, text`` of every row."""
    text: Column = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    lead = F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("lead")
    return docs.select(lead, text).select("lead", F.xxhash64("text").alias("key"), "text")


def _packed_places(rows: pa.Table) -> pa.Table:
    return _replies(*(rows.column(c).to_numpy() for c in ("lead", "key")), rows.column("begin").to_numpy().astype(np.uint32),
                    np.full(len(rows), 2))


def _open_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _packed_places(pa.Table.from_batches([batch])).to_batches()


def find_repeats(docs: DataFrame, kind: Kind, work: Callable[[pa.Table], pa.Table], result: str) -> Found:
    """Runs all steps; ``work`` turns the packed contents of one bucket into rows of the schema ``result``."""
    spark = docs.sparkSession
    texts = addressed(docs)
    total = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // BUCKET_BYTES))
    crowds = crowded(texts, kind)
    packed = texts.mapInArrow(_pack(kind, buckets, crowds), _PACKED)
    path, shard_path = scratch_path(spark, "replies"), scratch_path(spark, "shards")
    packed.groupBy("bucket").applyInArrow(_judge(kind.within, buckets), PIECES if kind.within else _REPLIES).write.parquet(path)
    replies = spark.read.parquet(path)
    if kind.within:
        settled = replies.filter("s_begin >= 0")
        opened = replies.filter("s_begin < 0").select("lead", "key", "begin").mapInArrow(_open_map, _REPLIES)
    else:
        settled, opened = replies.filter(F.length("settled") > 0).select("lead", "key", "settled"), replies.filter(F.length("open") > 0)
    asked = opened.groupBy("lead", "key").agg(F.collect_list("open").alias("open"))
    sent = texts.join(asked, ["lead", "key"]).select("lead", "key", "text", "open").mapInArrow(_send(kind, buckets * FINER, crowds), _SENT)
    sent.groupBy("bucket").applyInArrow(_work(work, kind.within), result).write.parquet(shard_path)
    return Found(texts, settled, spark.read.parquet(shard_path))
