"""Benchmark decontamination: rare word pairs seed, Smith-Waterman alignment decides.

Words are lower-cased runs of letters and digits. An alignment of a test item of m words with a passage gets +1 for
equal words and -1 for an unequal, an additional or a missing word; ``similarity`` is (best / m + 1) / 2, so with
replaced words it is the share of words kept. From ``SIMILARITY`` (0.8) on, the text leaks the item.

Seeds are the item's pairs of neighbouring words. An alignment that reaches the threshold leaves all but ``broken(m)``
of the item's pairs untouched. So of the pairs in the order of their frequency in the corpus only the rarest
``broken(m) + WANTED`` are looked for, and a passage must hold ``WANTED`` of them (fewer for short items): no passage
that reaches the threshold is missed, however common its words are.

Two maps over the texts: one counts the pairs, one finds the rare ones. What goes into the maps is a bit table of fixed
size (``SLOTS``); whether a hit is real is decided by a join with the seeds. Only texts with candidates meet the
items' words. Alignments are computed for many candidates at once.

Null and empty texts and items match nothing, nor do items of a single word. Rows with a null ``doc_id`` or ``item_id``
are compared like others. Repeated rows: one result row per text and item. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weirflow.llm import ragged
from weirflow.llm.licences import Words
from weirflow.llm.ragged import starts_of
from weirflow.llm.tables import table
from weirflow.session import scratch_path

SIMILARITY = 0.8
WANTED = 3
SLOTS = 1 << 22
CHUNK_BYTES = 4 << 20
CELLS = 1 << 20
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def broken(m: np.ndarray) -> np.ndarray:
    """How many pairs of an item of ``m`` words an alignment at the threshold can leave without a trace at most.

    An additional word costs least: one point of ``2 (1 - SIMILARITY) m``, and breaks one pair.
    """
    return np.floor(2 * (1 - SIMILARITY) * m + 1e-9).astype(np.int64)


def _pairs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every pair of neighbouring words of one text, and the index of its first word."""
    first = np.flatnonzero(words.text[1:] == words.text[:-1])
    hashes = words.hashes.view(np.uint64)
    mixed = hashes[first] * _PAIR ^ (hashes[first + 1] + (hashes[first] >> np.uint64(31)))
    return ((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(1)).view(np.int64), first


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in batches:
        flat, starts, lengths = ragged.utf8_column(batch, "text")
        for a, b in ragged.chunks(lengths, CHUNK_BYTES):
            yield batch.slice(a, b - a), Words(flat[starts[a] : starts[b - 1] + lengths[b - 1]], lengths[a:b])


def _item_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, words in _chunks(batches):
        pair, first = _pairs(words)
        pairs_per = np.bincount(words.text[first], minlength=len(rows))
        as_list = lambda n, v: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(v))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), as_list(words.per_text, words.hashes), as_list(pairs_per, pair)], ["item_id", "words", "pairs"]
        )


def _slots(pairs: np.ndarray) -> np.ndarray:
    return pairs % SLOTS


def _bits(pairs: np.ndarray) -> np.ndarray:
    table_ = np.zeros(SLOTS, bool)
    table_[_slots(pairs)] = True
    return np.packbits(table_)


def _pair_counter(packed: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = np.unpackbits(packed).view(bool), np.zeros(SLOTS, np.int64)
        for _, words in _chunks(batches):
            slots = _slots(_pairs(words)[0])
            np.add.at(total, slots[wanted[slots]], 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "n"])

    return run


def _pair_finder(packed: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Hits (pair, place) of texts that may hold enough of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(packed).view(bool)
        for rows, words in _chunks(batches):
            pair, first = _pairs(words)
            hit = wanted[_slots(pair)]
            pair, first = pair[hit], first[hit]
            text = words.text[first]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(text)), rows.column(1).take(pa.array(text)), pa.array(pair), pa.array(words.number[first])],
                ["doc_id", "text_key", "pair", "place"],
            )

    return run


def align(passages: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of every passage with its item: its points and the place behind its last word.

    Row by row of the items, all candidates side by side. Gaps within a row follow from a running maximum.
    """
    n, m = max(map(len, passages)), np.array([len(x) for x in items])
    text = np.full((len(passages), n), -1, np.int64)
    wanted = np.full((len(items), int(m.max())), -2, np.int64)
    for k, (p, i) in enumerate(zip(passages, items, strict=True)):
        text[k, : len(p)] = p
        wanted[k, : len(i)] = i
    step = np.arange(n + 1, dtype=np.int32)
    row = np.zeros((len(passages), n + 1), np.int32)
    best, end = np.zeros(len(passages), np.int32), np.zeros(len(passages), np.int64)
    for k in range(wanted.shape[1]):
        new = np.zeros_like(row)
        new[:, 1:] = np.maximum(row[:, :-1] + np.where(text == wanted[:, k : k + 1], 1, -1), row[:, 1:] - 1)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + step, axis=1) - step
        here = row.argmax(axis=1)
        top = np.take_along_axis(row, here[:, None], 1)[:, 0]
        better = top > best
        best, end = np.where(better, top, best), np.where(better, here, end)
    return best, end


def _windows(places: list[int], m: int, n: int) -> list[tuple[int, int]]:
    """Parts of a text of ``n`` words in which an alignment over one of the places can lie."""
    reach = int(m + broken(np.array([m]))[0] + 1)
    out: list[list[int]] = []
    for place in sorted(places):
        a, b = max(0, place - reach), min(n, place + reach + 1)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _aligner(similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, text, candidates: item_id, words, places; text_key) to rows per leaked item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in _chunks(batches):
            begin = starts_of(words.per_text)
            jobs: list[tuple[int, int | None, int, np.ndarray, np.ndarray]] = []
            for text, candidates in enumerate(rows.column(2).to_pylist()):
                own = words.hashes[begin[text] : begin[text] + words.per_text[text]]
                for c in candidates:
                    item = np.array(c["words"], np.int64)
                    jobs += [(text, c["item_id"], a, own[a:b], item) for a, b in _windows(c["places"], len(item), len(own))]
            jobs.sort(key=lambda j: len(j[3]))
            out: list[tuple] = []
            while jobs:
                k, widest = 0, 0
                while k < len(jobs) and (not k or (k + 1) * (len(jobs[k][3]) + 1) <= CELLS):
                    widest, k = len(jobs[k][3]), k + 1
                batch, jobs = jobs[:k], jobs[k:]
                points, ends = align([j[3] for j in batch], [j[4] for j in batch])
                for (text, item_id, a, _, item), p, e in zip(batch, points.tolist(), ends.tolist(), strict=True):
                    if (value := (p / len(item) + 1) / 2) >= similarity - 1e-9:
                        out.append((text, item_id, value, a + e))
                del widest
            ids, keys = rows.column(0).to_pylist(), rows.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[o[0]] for o in out], pa.int64()), pa.array([keys[o[0]] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                    pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.int64()),
                ],
                ["doc_id", "text_key", "item_id", "similarity", "end_word"],
            )

    return run


def rare_seeds(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, words, pair, needed``: the rarest pairs of every item and how many of them a passage must hold.

    ``items`` has ``item_id, words, pairs``.
    """
    pairs = items.select("item_id", "words", F.explode(F.array_distinct("pairs")).alias("pair"))
    slot = F.pmod("pair", F.lit(SLOTS)).alias("slot")
    packed = slot_bits(pairs.select("pair"))
    counted = texts.mapInArrow(_pair_counter(packed), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    ranked = pairs.withColumn("slot", slot).join(counted, "slot", "left")
    order = W.partitionBy("item_id", "words").orderBy(F.coalesce("n", F.lit(0)), "pair")
    lost = F.floor(F.size("words") * (2 * (1 - SIMILARITY)) + 1e-9)
    # Pairs that occur twice in an item can be lost with one edit each, too: distinct ones count.
    spare = F.size(F.array_distinct("pairs")) - lost
    needed = F.greatest(F.lit(1), F.least(F.lit(WANTED), spare)).cast("int")
    sized = items.select("item_id", "words", needed.alias("needed"), (lost + needed).alias("keep")).distinct()
    return (
        ranked.withColumn("rank", F.row_number().over(order))
        .join(sized.withColumnRenamed("item_id", "i").withColumnRenamed("words", "w"),
              F.col("item_id").eqNullSafe(F.col("i")) & (F.col("words") == F.col("w")))
        .filter("rank <= keep").select("item_id", "words", "pair", "needed")
    )


def slot_bits(pairs: DataFrame) -> np.ndarray:
    """Bit table of the pairs; at most ``SLOTS`` / 8 bytes however many pairs there are."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(SLOTS // 8, np.uint8)
        for batch in batches:
            bits |= _bits(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], ["bits"])

    out = np.zeros(SLOTS // 8, np.uint8)
    for row in pairs.coalesce(8).mapInArrow(pack, "bits binary").toLocalIterator():
        out |= np.frombuffer(row["bits"], np.uint8)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Every text and item whose best alignment reaches the threshold: ``doc_id, text_key, item_id, similarity, end_word``.

    ``text_key`` is ``xxhash64(text)``, which tells texts of one id apart.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("text_key", F.xxhash64("text")).select("doc_id", "text_key", "text")
    path = scratch_path(spark, "seeds")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        _item_map, "item_id long, words array<long>, pairs array<long>"
    ).filter(F.size("words") > 1)
    rare_seeds(texts.select("text"), items).write.parquet(path)
    seeds = spark.read.parquet(path)
    packed = slot_bits(seeds.select("pair"))
    hits = texts.mapInArrow(_pair_finder(packed), "doc_id long, text_key long, pair long, place long")
    # A pair that stands often in one text counts once for the filter; its places are kept apart for the windows.
    candidates = (
        hits.join(seeds, "pair").groupBy("doc_id", "text_key", "item_id", "words", "needed")
        .agg(F.count_distinct("pair").alias("n"), F.collect_set("place").alias("places")).filter("n >= needed")
    )
    per_text = candidates.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("item_id", "words", "places")).alias("candidates")
    )
    once = texts.withColumnRenamed("doc_id", "d").withColumnRenamed("text_key", "t")
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_key"))
    found = once.join(per_text, same).select("doc_id", "text", "candidates", "text_key").mapInArrow(
        _aligner(similarity), "doc_id long, text_key long, item_id long, similarity double, end_word long"
    )
    best = F.max(F.struct("similarity", -F.col("end_word"))).alias("best")
    return found.groupBy("doc_id", "text_key", "item_id").agg(best).select(
        "doc_id", "text_key", "item_id", "best.similarity", (-F.col("best.col2")).alias("end_word")
    )


def op1_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")
