"""N-gram Jaccard join: documents whose sets of word shingles overlap by 85 % of their union, as connected components.

Equal sets collapse to one before anything else. Shingles stand in one global order, rare ones first: their frequencies are
counted in counters, some per document up to ``MOST_BUCKETS``, of which every task gets one byte each. (Any order gives right
results; a good one gives short lists.) Two sets that link share the first elements of that order among few of their own first ones, and this is
asked in two ways, by size:

* Small sets enumerate their subsets of two: linked sets share one of those over their first ``missing + 2`` elements.
* Large sets scan inverted lists: linked sets share one of their first ``missing + 1`` elements. Small sets near the boundary are
  in the lists too, as far as a large one can link with them.

``missing`` is how many elements a linked set may lack. The boundary is where the cost is least: subsets written by the small
against list entries written and met by the large, summed per size over the table.

Members of a list are compared by size and by a parity sketch, whose differing bits are a lower bound of the differing elements, so
neither test loses a link. A large list is dealt out over pairs of blocks. In each round a set proposes its nearest
few of other components; what is proposed is verified on the shingles themselves, read from the texts, and components grow. The
few become more, among those sets that had more to propose, until none has, so a large group of near copies costs about as
many verifications as it has members, and no link between components is lost.

Defined results: a null text is empty; an empty set links with nothing, its component is its own id. A null ``doc_id`` is never a component id unless
all ids of the component are null. Repeated rows have a result row each. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weirflow.llm.components import components
from weirflow.llm.groups import whole_groups
from weirflow.llm.ragged import positions
from weirflow.llm.tables import table
from weirflow.session import scratch_path

SHINGLE = 4
#: Link when ``100 * intersection >= PERCENT * union``.
PERCENT = 85
#: Counters of shingles: so many per document, in powers of two within these bounds.
BUCKETS_PER_DOCUMENT, FEWEST_BUCKETS, MOST_BUCKETS = 64, 1 << 16, 1 << 24
SLICES = 1024
#: Bits of the filter for documents whose text is asked for; 4 MB.
FILTER_BITS = 1 << 25
#: Members of one list that are compared in one group.
BLOCK = 2048
SKETCH_BITS = 256
#: Nearest sets a set proposes in the first round, and how much that grows from round to round.
PROPOSALS, GROWTH = 4, 64
#: Lists up to this length are compared side by side.
SHORT = 32
_SEED = 0x5E7
_SETS = "doc_id long, n long, sig binary, prefix array<long>, sketch binary, light double, heavy double"


# --- sets ----------------------------------------------------------------------------------------


def shingles(text: str | None) -> set[bytes]:
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and exactly the six ASCII white-space bytes
    if not words:
        return set()
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return {line}
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.append(0, ends[:-SHINGLE]).tolist()
    return {line[a:b] for a, b in zip(begins, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)}


def hashes(members: set[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(s, _SEED) for s in members), np.uint64, len(members))


def needed(n: int) -> int:
    """Elements that a set of ``n`` shares at least with any set it links with."""
    return -(-PERCENT * n // 100)


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    return (values % np.uint64(buckets)).astype(np.int64)


def _count_map(buckets: int, slices: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of all shingles of a task, in slices."""
    counts = np.zeros(buckets, np.uint32)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            np.add.at(counts, _bucket(hashes(shingles(text)), buckets), np.uint32(1))
    parts = counts.reshape(slices, -1)
    used = np.flatnonzero(parts.any(axis=1))
    # Counts of a task are small; a slice of larger ones is four times as long.
    packed = [zlib.compress((p.astype(np.uint8) if p.max() < 256 else p).tobytes(), 1) for p in parts[used]]
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(packed, pa.binary())], ["slice", "counts"])


def _level_map(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the counters of each slice, rows sorted by slice, and keeps their logarithm."""
    here, total = None, None

    def closed() -> pa.RecordBatch:
        level = np.minimum(np.rint(8 * np.log2(1.0 + total)), 255).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([here], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["slice", "levels"])

    for batch in batches:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = zlib.decompress(packed)
            counts = np.frombuffer(raw, np.uint8 if len(raw) == size else np.uint32).astype(np.float64)
            if part == here:
                total += counts
                continue
            if here is not None:
                yield closed()
            here, total = part, counts
    if here is not None:
        yield closed()


def frequency_levels(docs: DataFrame) -> np.ndarray:
    """One byte per counter, ``MOST_BUCKETS`` bytes at most."""
    wanted = min(max(BUCKETS_PER_DOCUMENT * docs.count(), FEWEST_BUCKETS), MOST_BUCKETS)
    buckets = 1 << (wanted - 1).bit_length()
    counted = docs.select("text").mapInArrow(partial(_count_map, buckets, SLICES), "slice int, counts binary")
    summed = counted.repartition("slice").sortWithinPartitions("slice").mapInArrow(
        partial(_level_map, buckets // SLICES), "slice int, levels binary"
    )
    out = np.zeros((SLICES, buckets // SLICES), np.uint8)
    for row in summed.collect():  # SLICES rows at most
        out[row["slice"]] = np.frombuffer(row["levels"], np.uint8)
    return out.ravel()


def signature(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(np.sort(values).tobytes(), _SEED)


def _set_map(levels: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, signature, first elements and sketch of every set, and what it costs as a small and as a large one."""
    table_ = np.frombuffer(levels.value, np.uint8)
    frequency = 2.0 ** (np.arange(256) / 8) - 1
    usual = float(frequency[table_].mean())  # what a counter holds of other shingles
    for batch in batches:
        sizes, sigs, prefixes, sketches, lights, heavies = [], [], [], [], [], []
        for text in batch.column(1).to_pylist():
            members = shingles(text)
            values, n = hashes(members), len(members)
            rank = table_[_bucket(values, len(table_))]
            first = n - needed(n) + 2 if n > 1 else 0
            order = np.lexsort((values, rank))[:first]
            bits = np.bincount((values >> np.uint64(56)).astype(np.int64), minlength=SKETCH_BITS) & 1
            sizes.append(n)
            sigs.append(signature(values))
            prefixes.append(values[order].view(np.int64))
            sketches.append(np.packbits(bits.astype(np.uint8)).tobytes())
            lights.append(first * (first - 1) / 2)
            met = np.maximum(frequency[rank[order[: first - 1]]] - usual, 0) if first else np.zeros(0)
            heavies.append(float(max(first - 1, 0) + met.sum()))
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum([len(p) for p in prefixes], dtype=np.int64)).astype(np.int32)),
            pa.array(np.concatenate([np.zeros(0, np.int64), *prefixes])),
        )
        columns = [
            batch.column(0), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), lists, pa.array(sketches, pa.binary()),
            pa.array(lights, pa.float64()), pa.array(heavies, pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "sig", "prefix", "sketch", "light", "heavy"])


def boundary(sets: DataFrame) -> int:
    """Largest size that counts as small: that of least cost, among size classes 5 % wide."""
    size_class = F.floor(F.log("n") / np.log(1.05)).cast("int")
    rows = sets.filter("n > 1").groupBy(size_class.alias("class")).agg(
        F.max("n").alias("n"), F.sum("light").alias("light"), F.sum("heavy").alias("heavy")
    ).collect()  # some hundred classes
    rows.sort(key=lambda r: r["n"])
    # A size leaves the lists only if the boundary is beyond all that may link with it.
    choices = [1, *(r["n"] for r in rows), *(100 * r["n"] // PERCENT for r in rows)]

    def cost(b: int) -> float:
        small = sum(r["light"] for r in rows if r["n"] <= b)
        return small + sum(r["heavy"] for r in rows if in_lists(r["n"], b))

    return min(sorted(choices), key=cost)


def in_lists(n: int, b: int) -> bool:
    """Whether a set is in the inverted lists: it is large, or a large one may link with it."""
    return 100 * n >= PERCENT * (b + 1)


# --- candidates ----------------------------------------------------------------------------------


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = (a ^ (a >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + b * np.uint64(0x94D049BB133111EB)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)


def keys_of(prefix: np.ndarray, n: int, b: int) -> np.ndarray:
    """Keys of a set: its subsets of two if it is small, its list elements if a large set may meet it there."""
    found = [np.zeros(0, np.uint64)]
    if n <= b and n > 1:
        pairs = np.array(list(combinations(range(len(prefix)), 2)))
        found.append(_mixed(prefix[pairs[:, 0]], prefix[pairs[:, 1]]))
    if n > 1 and in_lists(n, b):
        found.append(prefix[:-1])
    return np.concatenate(found)


def _key_map(b: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        lists = batch.column(2)
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        each = [keys_of(flat[s:e], int(n), b) for s, e, n in zip(offsets[:-1], offsets[1:], sizes, strict=True)]
        counts = np.array([len(k) for k in each], np.int64)
        keys = np.concatenate([np.zeros(0, np.uint64), *each]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(ids, counts))], ["key", "set_id"])


def _shared_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key; those of keys that stand alone are left out."""
    kept_key = kept_set = np.zeros(0, np.int64)
    before = None

    def shared(key: np.ndarray, sets: np.ndarray, after: int | None) -> pa.RecordBatch:
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[1:] == key[:-1]
        same[0] = len(key) > 0 and before is not None and key[0] == before
        same[-1] = len(key) > 0 and after is not None and key[-1] == after
        good = same[1:] | same[:-1]
        return pa.RecordBatch.from_arrays([pa.array(key[good]), pa.array(sets[good])], ["key", "set_id"])

    for batch in batches:
        if not len(batch):
            continue
        key, sets = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if len(kept_key):
            yield shared(kept_key, kept_set, int(key[0]))
            before = int(kept_key[-1])
        kept_key, kept_set = key, sets
    if len(kept_key):
        yield shared(kept_key, kept_set, None)


class _Members:
    """Members of lists, as arrays."""

    def __init__(self, rows: pa.Table):
        self.ids, self.roots, self.n = (rows.column(c).to_numpy() for c in ("set_id", "root", "n"))
        sketch = b"".join(rows.column("sketch").to_pylist())
        self.sketch = np.frombuffer(sketch, np.uint64).reshape(-1, SKETCH_BITS // 64)

    def may_link(self, one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs of members pass size and sketch and are not connected yet, and their differing bits."""
        bits = np.bitwise_count(self.sketch[one] ^ self.sketch[other]).sum(axis=-1, dtype=np.int64)
        a, b = self.n[one], self.n[other]
        # |A ^ B| <= (100 - PERCENT) / (100 + PERCENT) * (|A| + |B|)
        good = (100 + PERCENT) * bits <= (100 - PERCENT) * (a + b)
        good &= 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)
        return good & (self.roots[one] != self.roots[other]), bits


def _nearest(members: _Members, start: int, size: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every member of one long list the ``limit`` nearest others, in slabs of rows."""
    every = np.arange(start, start + size)
    for a in range(0, size, 256):
        rows = every[a : a + 256]
        good, bits = members.may_link(rows[:, None], every[None, :])
        far = np.where(good, bits, SKETCH_BITS + 1)
        if limit < size:
            columns = np.argpartition(far, limit - 1, axis=1)[:, :limit]
        else:
            columns = np.broadcast_to(np.arange(size), far.shape)
        near = np.take_along_axis(far, columns, axis=1)
        r, c = np.nonzero(near <= SKETCH_BITS)
        yield rows[r], every[columns[r, c]], near[r, c]


def _propose_map(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by list; per member its nearest others, at least ``limit`` of them where there are."""

    def packed(m: _Members, one: np.ndarray, other: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        columns = [m.ids[one], m.ids[other], bits.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["member", "other", "bits"])

    for rows, bounds in whole_groups(batches, 3):
        m, starts, sizes = _Members(rows), bounds[:-1], np.diff(bounds)
        short = sizes <= SHORT
        n = sizes[short]
        at = positions(starts[short], n)
        after = np.repeat(starts[short] + n, n) - at - 1
        one, other = np.repeat(at, after), positions(at + 1, after)
        good, bits = m.may_link(one, other)
        one, other, bits = one[good], other[good], bits[good]
        yield packed(m, np.concatenate([one, other]), np.concatenate([other, one]), np.concatenate([bits, bits]))
        for start, size in zip(starts[~short].tolist(), sizes[~short].tolist(), strict=True):
            for found in _nearest(m, start, size, limit):
                yield packed(m, *found)


def _verify_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``a, b`` that link, by their shingles."""
    last, members = None, None
    for batch in batches:
        ids, texts_a, texts_b = (batch.column(c).to_pylist() for c in ("a", "text_a", "text_b"))
        good = np.zeros(len(ids), bool)
        for k, (a, text_a, text_b) in enumerate(zip(ids, texts_a, texts_b, strict=True)):
            if a != last:
                last, members = a, shingles(text_a)
            others = shingles(text_b)
            both = len(members & others)
            good[k] = 100 * both >= PERCENT * (len(members) + len(others) - both)
        chosen = pa.array(good)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(chosen) for c in ("a", "b")], ["a", "b"])


def _text_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the texts of an id, those that have the set looked for."""
    for batch in batches:
        wanted, texts = batch.column("sig").to_pylist(), batch.column("text").to_pylist()
        good = [signature(hashes(shingles(t))) == s for s, t in zip(wanted, texts, strict=True)]
        chosen = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(chosen) for c in ("set_id", "text")], ["set_id", "text"])


# --- join ----------------------------------------------------------------------------------------


def _stored(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _proposed(members: DataFrame, limit: int) -> DataFrame:
    """``member, other, place``: the nearest sets of other components, nearest first, of each set."""
    counted = members.groupBy("key").agg(F.count("*").alias("length")).filter(F.col("length") > BLOCK)
    long_lists = _stored(counted, "long")
    blocks = F.ceil(F.coalesce("length", F.lit(1)) / BLOCK).cast("int")
    dealt = members.join(long_lists, "key", "left").select(
        *members.columns, F.pmod(F.xxhash64("set_id", F.lit(7)), blocks).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("mate"),
    )
    low, high = F.least("own", "mate").alias("low"), F.greatest("own", "mate").alias("high")
    group = ["key", "low", "high"]
    rows = dealt.select("key", low, high, "set_id", "root", "n", "sketch")
    in_order = rows.repartition(*group).sortWithinPartitions(*group)
    found = in_order.mapInArrow(partial(_propose_map, limit + 1), "member long, other long, bits int").distinct()
    nearest = W.partitionBy("member").orderBy("bits", "other")
    return found.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= limit + 1)


def _still_open(lists: DataFrame, roots: DataFrame, last: DataFrame) -> DataFrame:
    """The entries of sets with more to propose, with the components found so far.

    Of two sets that were not compared yet, either had more to propose; so it is enough that these meet.
    """
    more = last.select(F.col("member").alias("set_id")).distinct()
    of = roots.select(F.col("node").alias("set_id"), F.col("root").alias("_root"))
    return lists.join(more, "set_id").join(of, "set_id", "left").select(
        "key", "set_id", "n", "sketch", F.coalesce("_root", "set_id").alias("root")
    )


def _wanted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is among ``ids`` (column ``first``), and a few others, by a bitmap of fixed size.

    It spares the shuffle of texts that no one asks for.
    """
    number = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)) + 1
    asked = ids.select(F.col("first").alias("id")).select(number.alias("number"))
    bitmap = asked.groupBy(F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )
    told = docs.withColumn("id", F.col("doc_id")).withColumn("number", number).withColumn("bucket", F.bitmap_bucket_number("number"))
    place = F.bitmap_bit_position("number").cast("int")
    octet = F.conv(F.hex(F.substr("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = octet.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0
    return told.join(F.broadcast(bitmap), "bucket").filter(hit).select(*docs.columns)  # FILTER_BITS bits


def _texts_of(chosen: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """``set_id, text`` of the chosen sets, from the documents."""
    known = _stored(chosen.join(sets.select("set_id", "sig", "first"), "set_id"), "chosen")
    wanted = _wanted(docs, known)
    # The same way at every size, also where the ids would fit into every task.
    texts = wanted.join(known.hint("merge"), wanted["doc_id"].eqNullSafe(known["first"])).select("set_id", "sig", "text").mapInArrow(_text_map, "set_id long, text string")
    return _stored(texts.groupBy("set_id").agg(F.first("text").alias("text")), "texts")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` that link. Only the texts of their sets are sent."""
    with_b = pairs.join(texts.select(F.col("set_id").alias("b"), F.col("text").alias("text_b")), "b")
    of_a = texts.join(_stored(pairs.select(F.col("a").alias("set_id")).distinct(), "firsts"), "set_id")
    both = with_b.join(of_a.select(F.col("set_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify_map, "a long, b long").distinct()


def set_links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, root`` of the components of the different ``sets`` (``set_id, sig, n, prefix, sketch, first``)."""
    b = boundary(sets)
    postings = sets.select("set_id", "n", "prefix").mapInArrow(partial(_key_map, b), "key long, set_id long")
    shared = postings.repartition("key").sortWithinPartitions("key", "set_id").mapInArrow(_shared_map, "key long, set_id long")
    lists = _stored(shared.join(sets.select("set_id", "n", "sketch"), "set_id"), "lists")
    members = lists.withColumn("root", F.col("set_id"))
    texts = links = tried = None
    limit = PROPOSALS
    while True:
        proposed = _stored(_proposed(members, limit), "proposals")
        if texts is None:
            # A set that nothing may link with proposes nothing now and is never proposed later.
            texts = _texts_of(proposed.select(F.col("member").alias("set_id")).distinct(), sets, docs)
        pair = [F.least("member", "other").alias("a"), F.greatest("member", "other").alias("b")]
        pairs = proposed.filter(F.col("place") <= limit).select(*pair).distinct()
        fresh = _stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = fresh if tried is None else tried.union(fresh)
        good = _stored(_verified(fresh, texts), "verified")
        links = good if links is None else links.union(good)
        last = proposed.filter(F.col("place") > limit)
        roots = components(links)
        if last.isEmpty():
            return roots
        members = _stored(_still_open(lists, roots, last), "members")
        limit *= GROWTH


def linked(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    levels = spark.sparkContext.broadcast(frequency_levels(rows).tobytes())  # MOST_BUCKETS bytes at most
    every = _stored(rows.mapInArrow(partial(_set_map, levels), _SETS), "sets")
    different = every.filter("n > 0").groupBy("sig").agg(
        F.min("doc_id").alias("first"), *(F.first(c).alias(c) for c in ("n", "prefix", "sketch", "light", "heavy"))
    )
    sets = _stored(different.withColumn("set_id", F.monotonically_increasing_id()), "different")
    roots = set_links(rows, sets)
    rooted = sets.join(roots, sets["set_id"] == roots["node"], "left").select(
        "sig", "first", F.coalesce("root", "set_id").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    parts = rooted.join(smallest, "root").select("sig", "component_id")
    return every.join(parts, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"))


#: The same by counting the common shingles of every two documents that have one.
SQL = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingled AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i : i + {SHINGLE - 1}], ' ')) END) AS s FROM worded),
sized AS (SELECT doc_id, len(s) AS n, s FROM shingled),
different AS (SELECT min(doc_id) AS id, n, list_sort(s) AS s FROM sized WHERE n > 0 GROUP BY n, list_sort(s)),
held AS (SELECT id, n, unnest(s) AS shingle FROM different),
linked AS (SELECT a.id AS a, b.id AS b FROM held a JOIN held b ON a.shingle = b.shingle AND a.id <> b.id
    AND 100 * b.n >= {PERCENT} * a.n AND 100 * a.n >= {PERCENT} * b.n
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reached AS (SELECT id AS node, id AS seen FROM different UNION SELECT r.node, l.b FROM reached r JOIN linked l ON l.a = r.seen),
roots AS (SELECT node, min(seen) AS component_id FROM reached GROUP BY node)
SELECT z.doc_id, z.n AS n_shingles, coalesce(r.component_id, z.doc_id) AS component_id
FROM sized z LEFT JOIN different d ON d.n = z.n AND d.s = list_sort(z.s) LEFT JOIN roots r ON r.node = d.id
"""
