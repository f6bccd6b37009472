"""SimHash near-duplicates: byte-position inverted index with count filtering.

Fingerprints are counted in a map over the texts. Equal fingerprints collapse before anything else, so a group of
exact copies is one row. Two fingerprints that differ in at most four bits differ in at most four of
their eight bytes, so they share at least four positional bytes. The index lists fingerprints by
three positional bytes at a time; its 20 triples are chosen so that any four shared positions contain at least one
of them. Pairs met in a list have their shared positional bytes tallied, those
with four or more are verified bit by bit.

A list longer than ``BLOCK`` is dealt out over pairs of blocks, each its own group. From a
block pair only the links of a spanning forest leave, never all pairs, so a large group of near copies makes as many
rows as it has members. Links go through ``components``.

Null and empty texts have fingerprint zero and link like any other. A null ``doc_id`` is never a component id
unless all ids of the component are null. Repeated rows: one result row each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weirflow.llm import ragged
from weirflow.llm.components import components
from weirflow.llm.ragged import positions, starts_of
from weirflow.llm.tables import table
from weirflow.session import scratch_path

SHINGLE = 4
SEED = 42
MAX_BITS = 4
MIN_SHARED_BYTES = 8 - MAX_BITS
#: Fingerprints of one list that are compared in one group.
BLOCK = 2048
_LANES = np.uint64(0x0101010101010101)
#: Rows whose bits one byte lane can count.
_LANE_ROWS = 255


def shingle_hashes(text: bytes) -> list[int]:
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII white-space bytes
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return [xxhash.xxh64_intdigest(line, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = (ends[: len(words) - SHINGLE + 1] - np.fromiter(map(len, words[: len(words) - SHINGLE + 1]), np.int64) - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(begins, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)]


def fingerprints(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of every row of ragged hashes: a bit is 1 if set in over half of the row's hashes."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts > 0)
    if not len(full):
        return out
    n = counts[full]
    pieces = -(-n // _LANE_ROWS)
    place = positions(np.zeros(len(n), np.int64), pieces)
    piece_starts = np.repeat(starts_of(n), pieces) + place * _LANE_ROWS
    for bit in range(8):
        lanes = (hashes >> np.uint64(bit)) & _LANES
        sums = np.add.reduceat(lanes, piece_starts).view(np.uint8).reshape(-1, 8)
        totals = np.add.reduceat(sums.astype(np.int64), starts_of(pieces), axis=0)
        majority = (2 * totals > n[:, None]).astype(np.uint8)
        out[full] |= np.ascontiguousarray(majority).view(np.uint64).ravel() << np.uint64(bit)
    return out


def _fingerprint_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, starts, lengths = ragged.utf8_column(batch, "text")
        for a, b in ragged.chunks(lengths, 1 << 20):
            each = [shingle_hashes(flat[s : s + n].tobytes()) for s, n in zip(starts[a:b], lengths[a:b], strict=True)]
            counts = np.fromiter(map(len, each), np.int64, len(each))
            values = np.fromiter((h for hs in each for h in hs), np.uint64, int(counts.sum()))
            found = fingerprints(values, counts)
            others = [(batch.column(k), name) for k, name in enumerate(batch.schema.names) if name != "text"]
            columns = [*(c.slice(a, b - a) for c, _ in others), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*(name for _, name in others), "fp"])


def with_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fp`` per row."""
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(_fingerprint_map, "doc_id long, fp long")


def triples() -> list[tuple[int, int, int]]:
    """20 of the 56 triples of byte positions; every four positions contain one of them.

    Positions stand in three groups in a circle: three of one group, or two of one and one of the next.
    """
    groups = ((0, 1, 2), (3, 4, 5), (6, 7))
    out = [t for g in groups for t in combinations(g, 3)]
    for here, after in zip(groups, groups[1:] + groups[:1], strict=True):
        out += [(*two, one) for two in combinations(here, 2) for one in after]
    return out


def _mask(byte_positions: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in byte_positions)
    return value - (1 << 64) if value >> 63 else value


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Count filter on shared positional bytes, then the exact test on bits."""
    differing = a ^ b
    shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    good = shared >= MIN_SHARED_BYTES
    good[good] = np.bitwise_count(differing[good]) <= MAX_BITS
    return good


def _forest(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever is connected among the members, at most one less than there are."""
    left, right = [], []
    waiting = members
    while len(waiting):
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and len(waiting):
            node = reached.pop()
            near = _near(waiting, np.full(len(waiting), node))
            if near.any():
                found = waiting[near]
                left.append(np.full(len(found), node))
                right.append(found)
                reached.extend(found)
                waiting = waiting[~near]
    if not left:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def _group_links(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups that lie one after the other."""
    starts, small = starts_of(sizes), sizes <= 32
    n = sizes[small]
    # All pairs (i, j > i) of small groups: every member with those after it.
    at = positions(starts[small], n)
    after = np.repeat(starts[small] + n, n) - at - 1
    one = np.repeat(at, after)
    other = positions(at + 1, after)
    good = _near(values[one], values[other])
    left, right = [values[one[good]]], [values[other[good]]]
    for begin, size in zip(starts[~small], sizes[~small], strict=True):
        a, b = _forest(values[begin : begin + size])
        left.append(a)
        right.append(b)
    return np.concatenate(left), np.concatenate(right)


def _link_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; the last group of a batch waits for the next batch."""
    groups, values = np.zeros((4, 0), np.int64), np.zeros(0, np.uint64)

    def links(group: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        new = np.append(True, (group[:, 1:] != group[:, :-1]).any(axis=0)) if len(value) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        a, b = _group_links(value, np.diff(np.append(begin, len(value))))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(5)]
        groups = np.concatenate([groups, np.stack(columns[:4])], axis=1)
        values = np.concatenate([values, columns[4].view(np.uint64)])
        if not len(values):
            continue
        same = (groups == groups[:, -1:]).all(axis=0)
        cut = len(values) - int(same[::-1].argmin() if not same.all() else len(values))
        yield links(groups[:, :cut], values[:cut])
        groups, values = groups[:, cut:], values[cut:]
    yield links(groups, values)


def fingerprint_links(fingerprints_: DataFrame) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) of at most four differing bits.

    All connections are kept: within a list of up to 32 every link is returned, within longer ones a spanning forest.
    """
    keys = F.array(*(
        F.struct(F.lit(t).alias("triple"), F.col("fp").bitwiseAND(F.lit(_mask(bytes_))).alias("key"))
        for t, bytes_ in enumerate(triples())
    ))
    postings = fingerprints_.select("fp", F.inline(keys))
    sizes = postings.groupBy("triple", "key").count().filter("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    own: Column = F.pmod(F.xxhash64("fp", F.lit(7)), blocks).cast("int")
    dealt = postings.join(sizes, ["triple", "key"]).select(
        "triple", "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    )
    grouped = dealt.select(
        "triple", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp"
    )
    group = ["triple", "key", "low", "high"]
    in_order = grouped.repartition(*group).sortWithinPartitions(*group)
    return in_order.mapInArrow(_link_map, "a long, b long").distinct()


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` per row."""
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    with_fingerprints(docs, id_column, text_column).write.parquet(path)  # texts are read and hashed once
    every = spark.read.parquet(path)
    return every.join(_component_of(every), "fp")


def _component_of(every: DataFrame) -> DataFrame:
    """``fp, component_id`` for the rows ``doc_id, fp``."""
    distinct = every.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(fingerprint_links(distinct.select("fp")))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.min("fp").alias("component"))
    return rooted.join(smallest, "root").select("fp", "component_id", "component")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, one of each component: that of the smallest ``doc_id``, equal ones by their text."""
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    # The document travels as one struct, so no column name can clash.
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"), "text")
    kind = whole.schema["document"].dataType.simpleString()
    whole.select(F.col("document.doc_id").alias("id"), "document", "text").mapInArrow(
        _fingerprint_map, f"id long, document {kind}, fp long"
    ).write.parquet(path)
    every = spark.read.parquet(path)
    parts = _component_of(every.select(F.col("id").alias("doc_id"), "fp"))
    first = W.partitionBy("component").orderBy(F.col("id").asc_nulls_last(), F.xxhash64("document.text"), "document.text")
    ranked = every.join(parts, "fp").withColumn("place", F.row_number().over(first))
    return ranked.filter("place = 1").select("document.*")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
