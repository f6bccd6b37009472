"""Words, phrases and the global word order of the licence scan (see ``notices``)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm import ragged
from weirflow.llm.bytepair import hash_table, look_up
from weirflow.llm.pretokens import hashes
from weirflow.llm.ragged import starts_of

CHUNK_BYTES = 4 << 20
THRESHOLD = 0.8

#: Phrases of the contract and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_IS_WORD = np.array([b >= 0x80 or chr(b).isdigit() or chr(b).islower() for b in range(256)])


def _keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes as non-negative keys of a lookup table."""
    return (hashes(data, starts, lengths) >> np.uint64(1)).view(np.int64)


class Words:
    """Words of a chunk of texts: place of each and its text."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        self.data = np.frombuffer(data.tobytes().translate(_FOLD), np.uint8)
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = _IS_WORD[self.data]
        ends = np.cumsum(lengths)
        # A text border ends a word: no byte lies between two texts.
        border = np.zeros(len(data) + 1, bool)
        border[starts_of(lengths)[lengths > 0]] = True
        begins = inside[1:-1] & (~inside[:-2] | border[:-1])
        stops = inside[1:-1] & (~inside[2:] | border[1:])
        self.starts = np.flatnonzero(begins)
        self.lengths = np.flatnonzero(stops) + 1 - self.starts
        self.text = np.searchsorted(ends, self.starts, side="right")
        self.hashes = _keys(self.data, self.starts, self.lengths)
        self.per_text = np.bincount(self.text, minlength=len(lengths))
        #: Number of a word within its text.
        self.number = np.arange(len(self.starts)) - starts_of(self.per_text)[self.text]


def _word_hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    lengths = np.array([len(r) for r in raw], np.int64)
    return _keys(np.frombuffer(b"".join(raw), np.uint8), starts_of(lengths), lengths)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in batches:
        flat, starts, lengths = ragged.utf8_column(batch, "text")
        for a, b in ragged.chunks(lengths, CHUNK_BYTES):
            yield batch.slice(a, b - a), Words(flat[starts[a] : starts[b - 1] + lengths[b - 1]], lengths[a:b])


def _word_counter(vocabulary: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, total = hash_table(_word_hashes(vocabulary)), np.zeros(len(vocabulary), np.int64)
        for _, words in _chunks(batches):
            known = look_up(lookup, words.hashes)
            total += np.bincount(known[known >= 0], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary), pa.array(total)], ["word", "n"])

    return run


def word_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of a fixed vocabulary stands in the corpus; as many numbers as it has words."""
    counted = docs.select(F.lit(None).alias("doc_id"), "text").mapInArrow(_word_counter(vocabulary), "word string, n long")
    return {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def needed(wording: str, threshold: float) -> int:
    """Distinct words of the wording a block must have."""
    size = len(set(wording.split()))
    return max(1, int(np.ceil(threshold * size - 1e-9)))
