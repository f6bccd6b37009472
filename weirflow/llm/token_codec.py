"""BPE encoding and decoding: speculate, verify, and merge exactly only what fails.

Speculate: every distinct pre-token is covered by greedy longest matches in the vocabulary,
all pre-tokens walking a trie side by side. Verify: a sequence is the exact encoding if
every token encodes to itself and every adjacent pair is compatible, that is, no merge
across the boundary comes before those that use up its two sides. Both are tested by array
operations over all adjacent pairs. Pre-tokens with a failing pair are merged exactly.
Decoding gathers the bytes of the ids; invalid UTF-8 becomes the replacement character.

Null and empty texts have no ids. Null ``doc_id``: the row stays, its id null.
Repeated rows: one result row each. Columns besides the id and the text are not read.
Memory is bounded by a chunk of texts, or by the longest single text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import bytepair, ragged
from weirflow.llm.pretokens import Known, distinct
from weirflow.llm.ragged import positions, starts_of
from weirflow.llm.tables import table

CHUNK_BYTES = 4 << 20
_NO_PARENT = 2**31 - 1


class Trie(NamedTuple):
    """``edges`` finds an edge by (node, byte); ``token`` is the id that ends in a node, or -1."""

    edges: tuple[np.ndarray, np.ndarray]
    child: np.ndarray
    token: np.ndarray


@lru_cache(maxsize=2)
def trie(path: str) -> Trie:
    """Trie of the tokens that encode to themselves; others can never be proposed."""
    v = bytepair.load(path)
    usable = np.flatnonzero((v.made_at >= 0) | np.isin(np.arange(len(v.made_at)), v.byte_ids))
    starts, lengths = v.pool_starts[usable], v.pool_lengths[usable]
    _, count = bytepair.merge_all(v, v.pool, starts, lengths)
    usable, starts, lengths = usable[count == 1], starts[count == 1], lengths[count == 1]
    nodes: dict[int, int] = {}
    ends = [-1]
    pool = v.pool.tobytes()
    for token, begin, n in zip(usable.tolist(), starts.tolist(), lengths.tolist(), strict=True):
        node = 0
        for byte in pool[begin : begin + n]:
            key = node << 8 | byte
            node = nodes.get(key, 0)
            if not node:
                node = nodes[key] = len(ends)
                ends.append(-1)
        ends[node] = token
    edges = np.fromiter(nodes.keys(), np.int64, len(nodes))
    child = np.fromiter(nodes.values(), np.int64, len(nodes))
    return Trie(bytepair.hash_table(edges), child, np.array(ends, np.int32))


def propose(t: Trie, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greedy longest matches of every pre-token: flat ids and how many each has."""
    cursor, end, rows = starts.astype(np.int64), (starts + lengths).astype(np.int64), np.arange(len(starts))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(rows):
        node, token, after = np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int32), cursor.copy()
        walking, depth = np.arange(len(rows)), 0
        while len(walking):
            here = cursor[walking] + depth
            inside = here < end[walking]
            walking, here = walking[inside], here[inside]
            key = node[walking] << 8 | data[here]
            at = bytepair.look_up(t.edges, key)
            goes = at >= 0
            walking, at, here = walking[goes], at[goes], here[goes]
            node[walking] = t.child[at]
            ends = t.token[node[walking]]
            hit = ends >= 0
            token[walking[hit]], after[walking[hit]] = ends[hit], here[hit] + 1
            depth += 1
        found.append((rows, token))
        more = after < end
        rows, cursor, end = rows[more], after[more], end[more]
    count = np.zeros(len(starts), np.int64)
    for which, _ in found:
        count[which] += 1
    out, begin = np.empty(int(count.sum()), np.int32), starts_of(count)
    for k, (which, token) in enumerate(found):
        out[begin[which] + k] = token
    return out, count


def compatible(v: bytepair.Vocabulary, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``a`` followed by ``b`` keeps its boundary when their bytes are merged together.

    Time runs over merge ranks. The right edge of ``a`` and the left edge of ``b`` are taken apart
    again, the later merge first. Each pair of edge symbols that stood side by side must not have a merge
    before both are used up; at equal rank the place further left goes first.
    """
    good = np.ones(len(a), bool)
    rows = np.arange(len(a))
    x, y = a.astype(np.int64), b.astype(np.int64)
    x_until, y_until = np.full(len(a), _NO_PARENT, np.int64), np.full(len(a), _NO_PARENT, np.int64)
    while len(rows):
        at = bytepair.pair_index(v, x, y)
        rank = np.where(at >= 0, v.ranks[at], _NO_PARENT)
        bad = (at >= 0) & (rank < x_until) & (rank <= y_until)
        good[rows[bad]] = False
        x_made, y_made = v.made_at[x].astype(np.int64), v.made_at[y].astype(np.int64)
        go = ~bad & ((x_made >= 0) | (y_made >= 0))
        rows, x, y, x_until, y_until = rows[go], x[go], y[go], x_until[go], y_until[go]
        x_made, y_made = x_made[go], y_made[go]
        undo_x = x_made > y_made
        x_until, y_until = np.where(undo_x, x_made, x_until), np.where(undo_x, y_until, y_made)
        x, y = np.where(undo_x, v.right[x], x), np.where(undo_x, y, v.left[y])
    return good


def encode_words(
    v: bytepair.Vocabulary, t: Trie, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Exact ids of every pre-token, flat, their numbers, and how many pre-tokens failed the check."""
    ids, count = propose(t, data, starts, lengths)
    begin = starts_of(count)
    word = np.repeat(np.arange(len(starts)), count)
    inner = np.flatnonzero(word[1:] == word[:-1]) if len(ids) else np.zeros(0, np.int64)
    pairs, of = np.unique(ids[inner].astype(np.int64) << 32 | ids[inner + 1], return_inverse=True)
    fits = compatible(v, pairs >> 32, pairs & 0xFFFFFFFF)[of] if len(pairs) else np.zeros(0, bool)
    failing = np.zeros(len(starts), bool)
    failing[word[inner[~fits]]] = True
    failing[word[ids < 0]] = True
    wrong = np.flatnonzero(failing)
    if not len(wrong):
        return ids, count, 0
    exact, n = bytepair.merge_all(v, data, starts[wrong], lengths[wrong])
    right = np.flatnonzero(~failing)
    total = count.copy()
    total[wrong] = n
    out, place = np.empty(int(total.sum()), np.int32), starts_of(total)
    out[positions(place[right], count[right])] = ids[positions(begin[right], count[right])]
    out[positions(place[wrong], n)] = exact
    return out, total, len(wrong)


def encode_chunk(
    v: bytepair.Vocabulary, t: Trie, known: Known, data: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text, flat, and how many each has."""
    parts = bytepair.segments(v, data, lengths)
    words, per_text = parts.words, np.bincount(parts.special_text, minlength=len(lengths)).astype(np.int64)
    if not len(words.starts):
        return parts.special_id, per_text
    found, example, of = distinct(words)

    def encoded(fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        which = example[fresh]
        return encode_words(v, t, words.data, words.starts[which], words.lengths[which])[:2]

    begin, n = known.resolve(words, found, example, encoded)
    begin, n = begin[of], n[of]
    out = known.values[positions(begin, n)]
    per_text += np.bincount(words.text, weights=n, minlength=len(lengths)).astype(np.int64)
    if len(parts.special_id):
        before = np.append(starts_of(n), n.sum())[parts.special_before]
        out = np.insert(out, before, parts.special_id)
    return out, per_text


def decode_bytes(v: bytepair.Vocabulary, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every id sequence, flat, and how many each has."""
    n = v.pool_lengths[ids]
    flat = v.pool[positions(v.pool_starts[ids], n)]
    ends = np.append(0, np.cumsum(n))
    last = np.cumsum(count)
    return flat, ends[last] - ends[last - count]


@lru_cache(maxsize=2)
def _decimals(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``"123,"`` of every id: flat bytes, starts, lengths."""
    texts = [b"%d," % i for i in range(size)]
    lengths = np.array([len(x) for x in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), starts_of(lengths), lengths


def _sha256(content: bytes | memoryview) -> str:
    return hashlib.sha256(content).hexdigest()


def _as_utf8(content: bytes) -> bytes:
    return content.decode("utf-8", "replace").encode("utf-8")


def digests(v: bytepair.Vocabulary, ids: np.ndarray, count: np.ndarray) -> tuple[list[str], list[str]]:
    """SHA-256 of the comma-joined ids and of the decoded text of every sequence."""
    pool, starts, lengths = _decimals(len(v.pool_lengths))
    n = lengths[ids]
    listed = pool[positions(starts[ids], n)].tobytes()
    list_ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(count))].tolist()
    flat, sizes = decode_bytes(v, ids, count)
    decoded, text_ends = flat.tobytes(), np.append(0, np.cumsum(sizes)).tolist()
    view = memoryview(listed)
    of_ids = [_sha256(view[a : max(a, b - 1)]) for a, b in zip(list_ends, list_ends[1:], strict=False)]
    of_text = [_sha256(_as_utf8(decoded[a:b])) for a, b in zip(text_ends, text_ends[1:], strict=False)]
    return of_ids, of_text


def _each_chunk(path: str, batches: Iterator[pa.RecordBatch]):
    v, t, known = bytepair.load(path), trie(path), Known()
    for batch in batches:
        flat, starts, lengths = ragged.utf8_column(batch, "text")
        for a, b in ragged.chunks(lengths, CHUNK_BYTES):
            ids, count = encode_chunk(v, t, known, flat[starts[a] : starts[b - 1] + lengths[b - 1]], lengths[a:b])
            yield batch.slice(a, b - a), v, ids, count


def _encoder(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ids of every text, and whether they decode to the text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, v, ids, count in _each_chunk(path, batches):
            offsets = pa.array(np.append(0, np.cumsum(count)), pa.int32())
            flat, sizes = decode_bytes(v, ids, count)
            raw, starts, lengths = ragged.utf8_column(rows, "text")
            same_size = sizes == lengths
            source = raw[int(starts[0]) : int(starts[-1] + lengths[-1])]
            ends = np.append(0, np.cumsum(sizes))
            if same_size.all():
                wrong = np.append(0, np.cumsum(flat != source))
                exact = wrong[ends[1:]] == wrong[ends[:-1]]
            else:
                exact = np.array([
                    bytes(flat[ends[k] : ends[k + 1]]) == bytes(raw[s : s + n])
                    for k, (s, n) in enumerate(zip(starts, lengths, strict=True))
                ])
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(exact)],
                names=[*rows.schema.names, "ids", "round_trip"],
            )

    return run


def _digester(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, v, ids, count in _each_chunk(path, batches):
            of_ids, of_text = digests(v, ids, count)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(count), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names
            )

    return run


def _decoder(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = bytepair.load(path)
        for batch in batches:
            column = batch.column(1)
            count = np.array([0 if x is None else len(x) for x in column.to_pylist()], np.int64)
            flat, sizes = decode_bytes(v, column.flatten().to_numpy(zero_copy_only=False), count)
            raw, ends = flat.tobytes(), np.append(0, np.cumsum(sizes)).tolist()
            texts = [_as_utf8(raw[a:b]).decode() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def _narrow(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))


def encode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text, ids, round_trip``: the exact token ids of every text, and whether they decode to it."""
    return _narrow(docs, id_column, text_column).mapInArrow(
        _encoder(vocabulary), "doc_id long, text string, ids array<int>, round_trip boolean"
    )


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(vocabulary), "doc_id long, text string")


def encode_digests(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every text encoded and decoded again, without moving the ids."""
    return _narrow(docs, id_column, text_column).mapInArrow(
        _digester(vocabulary), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op6_token_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
