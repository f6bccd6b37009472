"""Quality classifier: a byte-level convolutional network in numpy.

A text is covered by overlapping chunks of bytes. Every chunk goes through an embedding and learned
filters, the largest response of each filter is kept (max-pooling), and the maxima and the means
over all chunks of the text are combined into one probability.

The network is fitted on the driver on a bounded sample: at most ``SAMPLE_TEXTS`` labelled texts, taken in the
order of a hash of their ids, and at most ``SAMPLE_CHUNKS`` evenly spaced chunks of each. Texts whose
crc32(doc_id) mod 4 is 2 are held out and never learned from. Only bytes of texts enter a score.
Scoring is a map over all texts, whole, without a shuffle; memory is bounded by a batch of chunks.

Null and empty texts are one chunk of padding and get a score. Null ``doc_id``: scored, held_out is false.
Repeated rows: one result row each. Labels that are null are not used; among repeated labels the smallest
counts. Without any usable label every score is 0.5. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import ragged
from weirflow.llm.ragged import positions, starts_of
from weirflow.llm.tables import table

CHUNK, OVERLAP = 256, 64
STEP = CHUNK - OVERLAP
DIMENSIONS, WIDTH, STRIDE, FILTERS = 8, 6, 2, 24
PLACES = (CHUNK - WIDTH) // STRIDE + 1
PADDING = 256
SAMPLE_TEXTS, SAMPLE_CHUNKS = 4000, 12
EPOCHS, BATCH_TEXTS, RATE = 8, 32, 0.01
GROUP_CHUNKS = 1024
PREDICT_FROM = 0.7


class Network(NamedTuple):
    embedding: np.ndarray
    filters: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def held_out(id_column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def chunk_starts(lengths: np.ndarray) -> np.ndarray:
    """How many chunks cover each text."""
    return np.maximum(1, -(-(lengths - OVERLAP) // STEP))


def codes_of(flat: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bytes of every chunk, padded behind the end of its text."""
    at = begins[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    if not len(flat):
        return np.full(at.shape, PADDING, np.int64)
    return np.where(inside, flat[np.where(inside, at, 0)], PADDING)


def _windows(net: Network, codes: np.ndarray) -> np.ndarray:
    """What each filter sees at each of its places: (chunks, places, width x dimensions)."""
    embedded = net.embedding[codes].reshape(len(codes), CHUNK * DIMENSIONS)
    seen = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * DIMENSIONS, axis=1)
    return seen[:, :: STRIDE * DIMENSIONS]


def responses(net: Network, codes: np.ndarray) -> np.ndarray:
    """Largest response of every filter in every chunk."""
    return np.maximum((_windows(net, codes) @ net.filters).max(axis=1) + net.offsets, 0)


def _combined(pooled: np.ndarray, counts: np.ndarray) -> np.ndarray:
    begin = starts_of(counts)
    means = np.add.reduceat(pooled, begin) / counts[:, None]
    return np.concatenate([np.maximum.reduceat(pooled, begin), means], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scores(net: Network, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probability of good quality of every text, from all its chunks."""
    if not len(lengths):
        return np.zeros(0)
    counts = chunk_starts(lengths)
    begins = np.repeat(starts, counts) + positions(np.zeros(len(counts), np.int64), counts) * STEP
    ends = np.repeat(starts + lengths, counts)
    pooled = np.concatenate([
        responses(net, codes_of(flat, begins[k : k + GROUP_CHUNKS], ends[k : k + GROUP_CHUNKS]))
        for k in range(0, len(begins), GROUP_CHUNKS)
    ])
    return _sigmoid((_combined(pooled, counts) @ net.weights + net.bias).astype(np.float64))


def _first(seed: int) -> Network:
    random = np.random.default_rng(seed)
    size = WIDTH * DIMENSIONS
    return Network(
        random.normal(0, 0.5, (257, DIMENSIONS)).astype(np.float32),
        random.normal(0, (2 / size) ** 0.5, (size, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), random.normal(0, 0.1, 2 * FILTERS).astype(np.float32), np.zeros(1, np.float32),
    )


def _gradients(net: Network, codes: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Network:
    """Of the mean log loss over the texts of a batch."""
    windows = _windows(net, codes)
    raw = windows @ net.filters
    place = raw.argmax(axis=1)
    pooled = np.maximum(np.take_along_axis(raw, place[:, None], 1)[:, 0] + net.offsets, 0)
    mixed = _combined(pooled, counts)
    wrong = ((_sigmoid(mixed @ net.weights + net.bias) - labels) / len(labels)).astype(np.float32)
    to_mixed = wrong[:, None] * net.weights
    text = np.repeat(np.arange(len(counts)), counts)
    to_pooled = (to_mixed[:, FILTERS:] / counts[:, None])[text]
    is_top = pooled == mixed[:, :FILTERS][text]
    # A tie of maxima goes to all chunks that have it, in equal parts.
    ties = np.add.reduceat(is_top.astype(np.float32), starts_of(counts))
    to_pooled = (to_pooled + is_top * (to_mixed[:, :FILTERS] / ties)[text]) * (pooled > 0)
    chunk = np.arange(len(codes))[:, None]
    seen = windows[chunk, place]
    at = codes[chunk[:, :, None], place[:, :, None] * STRIDE + np.arange(WIDTH)]
    to_seen = (to_pooled[:, :, None] * net.filters.T).reshape(-1, DIMENSIONS).astype(np.float32)
    embedding = np.stack([np.bincount(at.ravel(), to_seen[:, d], 257) for d in range(DIMENSIONS)], axis=1)
    return Network(
        embedding, np.einsum("cf,cfk->kf", to_pooled, seen), to_pooled.sum(axis=0), wrong @ mixed, wrong.sum(keepdims=True)
    )


def fit(texts: list[list[np.ndarray]], labels: np.ndarray, seed: int = 7) -> Network:
    """Trains on texts given as lists of chunk codes."""
    net, random = _first(seed), np.random.default_rng(seed)
    if not len(texts):
        return net._replace(weights=net.weights * 0)
    means, squares = (Network(*(np.zeros_like(p) for p in net)) for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(texts))
        rate = RATE * (1 - epoch / EPOCHS) + RATE / 20
        for k in range(0, len(order), BATCH_TEXTS):
            own = order[k : k + BATCH_TEXTS]
            counts = np.array([len(texts[i]) for i in own])
            slope = _gradients(net, np.concatenate([np.stack(texts[i]) for i in own]), counts, labels[own])
            step += 1
            means = Network(*(0.9 * m + 0.1 * g for m, g in zip(means, slope, strict=True)))
            squares = Network(*(0.999 * s + 0.001 * g * g for s, g in zip(squares, slope, strict=True)))
            net = Network(*(
                (p - rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
                for p, m, s in zip(net, means, squares, strict=True)
            ))
    return net


def _sampled_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Evenly spaced chunks of every labelled text, as bytes."""
    for batch in batches:
        flat, starts, lengths = ragged.utf8_column(batch, "text")
        out = []
        for begin, n, total in zip(starts, lengths, chunk_starts(lengths), strict=True):
            which = np.unique(np.linspace(0, total - 1, min(total, SAMPLE_CHUNKS)).astype(np.int64)) * STEP
            out.append([flat[begin + w : begin + min(w + CHUNK, n)].tobytes() for w in which])
        chunks = pa.array(out, pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), chunks], ["doc_id", "label", "chunks"])


def _as_codes(chunk: bytes) -> np.ndarray:
    codes = np.full(CHUNK, PADDING, np.int64)
    codes[: len(chunk)] = np.frombuffer(chunk, np.uint8)
    return codes


def train(docs: DataFrame, labels: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> Network:
    """Fits on at most ``sample_texts`` labelled texts that are not held out."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out())
    one = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_texts)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The sample is bounded by its parameter, so it is the side to send.
    labelled = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    rows = labelled.mapInArrow(_sampled_chunks, "doc_id long, label int, chunks array<binary>").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return fit([[_as_codes(c) for c in r["chunks"]] for r in rows], np.array([r["label"] for r in rows], np.float32))


def _scorer(net: Network) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, starts, lengths = ragged.utf8_column(batch, "text")
            # One text at a time where it alone fills a group: the memory of a batch stays bounded by its longest text.
            found = [scores(net, flat, starts[a:b], lengths[a:b]) for a, b in ragged.chunks(lengths, GROUP_CHUNKS * STEP)]
            column = pa.array(np.concatenate(found) if found else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "score"])

    return run


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of ``docs``, all columns, with ``score``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_scorer(net), f"{fields}, score double")


def predicted() -> Column:
    return (F.col("score") >= PREDICT_FROM).cast("int")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = train(docs, table(spark, sf_dir, "labels"))
    found = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), net)
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted().alias("predicted"))
