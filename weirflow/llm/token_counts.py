"""Token counts: rank-synchronous merging of all distinct pre-tokens of a chunk of texts.

A map over the texts without any shuffle. Each Arrow batch is cut into chunks of
a few MB; the pre-tokens of a chunk are found by array operations, equal ones are merged
once, and the counts are summed per text. Memory is bounded by the chunk, or by
the longest single text.

Null text: 0 bytes, 0 tokens. Empty text: the same. Null ``doc_id``: the row stays, its id null.
Repeated rows: one result row each. Columns besides the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import bytepair, ragged
from weirflow.llm.pretokens import Known, distinct
from weirflow.llm.tables import table

CHUNK_BYTES = 4 << 20
TOKEN_LIMIT = 512


def count_chunk(v: bytepair.Vocabulary, known: Known, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Tokens of every text."""
    parts = bytepair.segments(v, data, lengths)
    words = parts.words
    total = np.bincount(parts.special_text, minlength=len(lengths)).astype(np.int64)
    if len(words.starts):
        found, example, of = distinct(words)

        def counted(fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            which = example[fresh]
            _, n = bytepair.merge_all(v, words.data, words.starts[which], words.lengths[which])
            return n.astype(np.int32), np.ones(len(n), np.int64)

        at, _ = known.resolve(words, found, example, counted)
        total += np.bincount(words.text, weights=known.values[at][of], minlength=len(lengths)).astype(np.int64)
    return total


def _counter(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = bytepair.load(path), Known()
        for batch in batches:
            flat, starts, lengths = ragged.utf8_column(batch, "text")
            counts = [
                count_chunk(vocabulary, known, flat[starts[a] : starts[b - 1] + lengths[b - 1]], lengths[a:b])
                for a, b in ragged.chunks(lengths, CHUNK_BYTES)
            ]
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return run


def token_counts(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", limit: int = TOKEN_LIMIT
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row; ``vocabulary`` is a byte-level BPE file on every executor."""
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    counted = narrow.mapInArrow(_counter(vocabulary), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
