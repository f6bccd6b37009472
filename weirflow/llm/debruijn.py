"""Substring dedup over words: a de Bruijn graph of token k-mers, compacted.

Words are the nodes' alphabet; a window of ``WINDOW`` words is an edge from its first to its last ``WINDOW - 1`` words. Edges
that may repeat meet in shards by their minimizer (see ``repeats``). A shard finds for every occurrence of an edge
its source, the earliest occurrence of all. Inside a run, edges that follow each other in the text and in the source form a
piece: a path without a branch, known by its text, its source and their coordinates. A whole run that stands earlier is a
piece, too. Pieces whose last node is the next one's first, again in text and source, are joined across shards until the
path ends or branches to another source. What is left are long repeated spans with source coordinates: a span begins
and ends where those of the source do, which is what verifies it.

A window repeats if its words also start in a text with a smaller id, or earlier in the same text. Words covered by
repeated windows go; windows are judged on the input, not on what is left.

Null and empty texts have no words. A null ``doc_id`` counts as the largest id and stays null in the result. Repeated
rows have equal ids, so none is earlier than the other; one result row each. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weirflow.llm import repeats
from weirflow.llm.pretokens import place_hashes
from weirflow.llm.ragged import positions, starts_of
from weirflow.llm.repeats import Kind, Shard
from weirflow.llm.tables import table

WINDOW = 20
GRAM = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of every word; a text's border ends a word."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~_SPACE[raw]
    border = np.zeros(len(raw) + 1, bool)
    border[starts_of(lengths)[lengths > 0]] = True
    border[-1] = True
    begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
    return begin, end - begin


def word_items(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin, size = word_bounds(raw, lengths)
    text = np.searchsorted(np.cumsum(lengths), begin, side="right")
    return place_hashes(raw, begin, size), np.bincount(text, minlength=len(lengths))


KIND = Kind(word_items, WINDOW, GRAM, within=True)


def edge_hashes(shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window, run after run, both from the 64-bit hashes of its words."""
    begin = starts_of(shard.windows + WINDOW - 1)
    at = positions(begin, shard.windows)
    first = repeats.sliding_hash(shard.data, WINDOW)[at]
    second = repeats.sliding_hash(repeats.mixed(shard.data), WINDOW)[at]
    return first, second


def sources(shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    """For every window: the index of its source, and whether it repeats one that starts earlier.

    The source is the earliest occurrence in the text with the smallest id, or, where that has the same id as the window's own
    text, the earliest in its own text.
    """
    one, two = edge_hashes(shard)
    run = np.repeat(np.arange(len(shard.lead)), shard.windows)
    lead, key, place = shard.lead[run], shard.key[run], positions(shard.place, shard.windows)
    repeated, source = repeats.earlier_windows(one, two, lead, key, place, within=True)
    return source, repeated


def work(rows: pa.Table) -> pa.Table:
    """One bucket: pieces of repeated paths, with the coordinates of their sources."""
    shard = repeats.shard_of(rows, np.uint64)
    source, repeated = sources(shard)
    run = np.repeat(np.arange(len(shard.lead)), shard.windows)
    place = positions(shard.place, shard.windows)
    # The path goes on where the next window of the run has the next source.
    goes_on = repeated[1:] & repeated[:-1] & (run[1:] == run[:-1])
    goes_on &= (place[source[1:]] == place[source[:-1]] + 1) & (shard.lead[run[source[1:]]] == shard.lead[run[source[:-1]]])
    goes_on &= shard.key[run[source[1:]]] == shard.key[run[source[:-1]]]
    begin = np.flatnonzero(repeated & ~np.append(False, goes_on))
    end = np.flatnonzero(repeated & ~np.append(goes_on, False))
    of, at = run[begin], source[begin]
    return pa.table({
        "lead": shard.lead[of], "key": shard.key[of], "begin": place[begin], "end": place[end] + 1,
        "s_lead": shard.lead[run[at]], "s_key": shard.key[run[at]], "s_begin": place[at],
    })


def compacted(pieces: DataFrame) -> DataFrame:
    """Pieces whose nodes meet, joined to whole paths: each goes on in the text and in the source at once.

    A join finds the pieces without a predecessor, where paths begin; every other piece belongs to the last
    beginning before it on the same diagonal of text and source.
    """
    line = ["lead", "key", "s_lead", "s_key", "diagonal"]
    lined = pieces.withColumn("diagonal", F.col("begin") - F.col("s_begin")).distinct()
    before = lined.select(*line, F.col("end").alias("begin")).distinct().withColumn("follows", F.lit(1))
    marked = lined.join(before, [*line, "begin"], "left")
    path = F.sum(F.when(F.col("follows").isNull(), 1).otherwise(0)).over(W.partitionBy(*line).orderBy("begin"))
    paths = marked.withColumn("path", path).groupBy(*line, "path").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("s_begin").alias("s_begin")
    )
    return paths.select("lead", "key", "begin", "end", "s_lead", "s_key", "s_begin")


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All texts (``lead, key, text``), and the compacted paths: windows ``begin`` to ``end`` of a text and their source."""
    found = repeats.find_repeats(docs, KIND, work, repeats.PIECES)
    return found.texts, compacted(found.settled.unionByName(found.shards))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lead, key, text, spans) to the digest of every text."""
    for batch in batches:
        leads, texts, spans = batch.column(0), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        out = [], [], []
        for text, own in zip(texts, spans, strict=True):
            words = text.encode().split()  # bytes: exactly the six ASCII white-space bytes
            edge = np.zeros(len(words) + 1, np.int32)
            for span in own or []:
                edge[span["begin"]] += 1
                edge[span["end"] + WINDOW - 1] -= 1
            gone = (np.cumsum(edge)[:-1] > 0).tolist()
            out[0].append(len(words))
            out[1].append(sum(gone))
            out[2].append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone, strict=True) if not g)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [leads, pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
            names=["lead", "n_words", "n_removed", "kept_sha256"],
        )


def word_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per row of ``docs`` (``doc_id, text``)."""
    texts, paths = repeated_spans(docs)
    per_text = paths.groupBy("lead", "key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    whole = texts.join(per_text, ["lead", "key"], "left").select("lead", "key", "text", "spans")
    done = whole.mapInArrow(_finish, "lead long, n_words long, n_removed long, kept_sha256 string")
    return done.select(F.nullif("lead", F.lit(repeats.NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op10_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_digests(table(spark, sf_dir, "documents"))
