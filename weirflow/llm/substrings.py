"""Suffix-array dedup: bytes covered by a long string that also starts in an earlier document go.

Only runs of windows that may repeat reach a shard (see ``repeats``). A shard joins its runs with a mark between them, builds
their suffix array by induced sorting (``suffixes``), and finds equal strings as neighbours with a permuted common
prefix of ``LENGTH`` bytes or more. A string counts for a document if it also starts in one with a smaller id.
Matches never cross documents, and are judged on the input, not on what is left.

Null and empty texts: 0 bytes, nothing removed. A null ``doc_id`` counts as the largest id and stays null in the result.
Repeated rows have equal ids, so none is earlier than the other; one result row each. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import repeats
from weirflow.llm.pretokens import byte_mixers
from weirflow.llm.ragged import positions, starts_of
from weirflow.llm.repeats import Kind, Shard
from weirflow.llm.suffixes import repeated_prefix, suffix_array
from weirflow.llm.tables import table

LENGTH = 50
GRAM = 20


def byte_items(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return byte_mixers()[0][raw], lengths


KIND = Kind(byte_items, LENGTH, GRAM, within=False)


def repeated_windows(shard: Shard) -> np.ndarray:
    """For every window of the shard, run after run: whether its string starts in a text with a smaller id."""
    size = shard.windows + LENGTH - 1
    # Marks between runs are 1, bytes 2 to 257, the end mark 0.
    t = np.ones(int((size + 1).sum()) + 1, np.uint16)
    t[-1] = 0
    begin = starts_of(size + 1)
    t[positions(begin, size)] = shard.data.astype(np.uint16) + 2
    order = suffix_array(t, 258)
    # A string with a mark in it is no window, so only windows are compared with each other.
    window = positions(begin, shard.windows)
    plain = np.zeros(len(t), np.uint8)
    plain[positions(begin, size)] = shard.data
    is_window = np.zeros(len(t), bool)
    is_window[window] = True
    in_order = order[is_window[order]]
    same = repeated_prefix(plain, in_order, LENGTH)[in_order]
    group = np.flatnonzero(~same)
    lead = np.zeros(len(t), np.int64)
    lead[window] = np.repeat(shard.lead, shard.windows)
    leads = lead[in_order]
    first = np.minimum.reduceat(leads, group)
    repeated = np.zeros(len(t), bool)
    repeated[in_order] = leads > np.repeat(first, np.diff(np.append(group, len(in_order))))
    return repeated[window]


def work(rows: pa.Table) -> pa.Table:
    """One bucket: ranges of repeated windows per text."""
    shard = repeats.shard_of(rows, np.uint8)
    if not len(shard.lead):
        return repeats.ranges_per_text(*(np.zeros(0, np.int64) for _ in range(4)))
    repeated = repeated_windows(shard)
    return ranges(shard, repeated)


def ranges(shard: Shard, repeated: np.ndarray) -> pa.Table:
    run = np.repeat(np.arange(len(shard.lead)), shard.windows)
    place = positions(shard.place, shard.windows)
    before = np.append(False, repeated[:-1] & (run[1:] == run[:-1]))
    after = np.append(repeated[1:] & (run[1:] == run[:-1]), False)
    begin, end = np.flatnonzero(repeated & ~before), np.flatnonzero(repeated & ~after)
    return repeats.ranges_per_text(shard.lead[run[begin]], shard.key[run[begin]], place[begin], place[end] + 1)


def _covered(n: int, begins: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Items covered by the windows that start in the ranges."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, begins, 1)
    np.add.at(edge, ends + length - 1, -1)
    return np.cumsum(edge)[:n] > 0


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lead, key, text, settled, begins, ends) to the digest of every text."""
    for rows, raw, items, counts in repeats.each_chunk(batches, KIND):
        r = repeats.find_runs(items, counts, KIND)
        settled = repeats.chosen(rows, 3, r)
        text, place, windows = r.text[settled], r.place[settled], r.windows[settled]
        cuts = np.searchsorted(text, np.arange(len(rows) + 1))
        starts = starts_of(counts)
        out = [], [], []
        for k, (more, last) in enumerate(zip(rows.column(4).to_pylist(), rows.column(5).to_pylist(), strict=True)):
            own = slice(cuts[k], cuts[k + 1])
            begins = np.concatenate([place[own], repeats.places(more or [])])
            ends = np.concatenate([place[own] + windows[own], repeats.places(last or [])])
            body = raw[starts[k] : starts[k] + counts[k]]
            gone = _covered(len(body), begins, ends, LENGTH)
            out[0].append(int(gone.sum()))
            out[1].append(int((np.diff(np.append(0, gone.astype(np.int8))) > 0).sum()))
            out[2].append(hashlib.sha256(body[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(counts), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
            names=["lead", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def substring_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs`` (``doc_id, text``)."""
    found = repeats.find_repeats(docs, KIND, work, repeats.RANGES)
    settled = found.settled.groupBy("lead", "key").agg(F.collect_list("settled").alias("settled"))
    ranged = found.shards.groupBy("lead", "key").agg(F.collect_list("begins").alias("begins"), F.collect_list("ends").alias("ends"))
    known = settled.join(ranged, ["lead", "key"], "full")
    whole = found.texts.join(known, ["lead", "key"], "left").select("lead", "key", "text", "settled", "begins", "ends")
    done = whole.mapInArrow(_finish, "lead long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return done.select(F.nullif("lead", F.lit(repeats.NO_ID)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digests(table(spark, sf_dir, "documents"))
