"""Merkle manifest of a table: one hash tree per language, one tree over their roots, and a proof for every row.

Rows are hashed where they are read; only digests travel. Leaves get their place in the tree from the range-sorted
blocks of ``ordering.sequence``, so no language is one task. The trees rise in passes: ``PASS_LEVELS`` levels of a
block of ``2 ** PASS_LEVELS`` neighbours are hashed side by side.

Proofs come by pointer jumping. Every node holds the segment of siblings on its way to an ancestor, at first its own
sibling and its parent. A self-join doubles the distance: the segment of the ancestor is appended, and the ancestor's
ancestor takes its place, until all leaves hold the whole way to the root. In the round of distance d only
nodes of a height divisible by d are still asked for, so the tables shrink as the segments grow. An ancestor that many
nodes ask for is repeated under salts, the low bits of the place, so no key has more than ``SHARED`` rows.

Defined results: a null field is ``-``. Equal ids of a language are ordered by their leaf, a null id comes first; repeated
rows are leaves of their own. A null language is a language. A null id is never tampered with. An empty table gives an empty result.
Columns other than the five of ``documents`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm.groups import whole_groups
from weirflow.llm.tables import table
from weirflow.operators.ordering import POSITION, sequence
from weirflow.session import scratch_path

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PASS_LEVELS = 10
#: Rows that may ask one copy of an ancestor for its segment.
SHARED = 4096
TAMPER_EVERY = 7
#: One byte for the side of the sibling (L, R, or - for none), then its digest.
ENTRY_BYTES = 33
_NODES = "tree long, height int, idx long, n long, digest binary, entry binary"


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: every field with its length, so that no two rows print alike."""
    printed = []
    for name in FIELDS:
        text = fields[name].cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        printed.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*printed), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, leaf, tampered``; the last is null where the row is left as it is."""
    own = {name: F.col(name) for name in FIELDS}
    more = own | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + F.lit(1).cast("decimal(20,0)")}
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    return docs.select("doc_id", "lang", leaf(own).alias("leaf"), F.when(chosen, leaf(more)).alias("tampered"))


# --- trees ---------------------------------------------------------------------------------------


def _top(n: int) -> int:
    """Height of the root of a tree of ``n`` leaves."""
    return (n - 1).bit_length()


def _raise_map(base: int, levels: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of neighbours at height ``base``: each node with its sibling, and the node each block ends in."""
    names = ["tree", "height", "idx", "n", "digest", "entry"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    for rows, bounds in whole_groups(batches, 2):
        tree, idx, n = (rows.column(c).to_numpy() for c in ("tree", "idx", "n"))
        digest = rows.column("digest").to_pylist()
        out: list[list] = [[] for _ in names]

        def put(*row) -> None:
            for column, value in zip(out, row, strict=True):
                column.append(value)

        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            t, first, total = int(tree[a]), int(idx[a]), int(n[a])
            level, height, top = [d.hex() for d in digest[a:b]], base, _top(total)
            while height < min(base + levels, top):
                above = []
                for i in range(0, len(level), 2):
                    pair = level[i : i + 2]
                    if len(pair) == 2:
                        put(t, height, first + i, total, None, b"R" + bytes.fromhex(pair[1]))
                        put(t, height, first + i + 1, total, None, b"L" + bytes.fromhex(pair[0]))
                    else:
                        put(t, height, first + i, total, None, b"-" + bytes(ENTRY_BYTES - 1))
                    above.append(_hash("".join(pair)))
                level, first, height = above, first >> 1, height + 1
            put(t, height, first, total, bytes.fromhex(level[0]), None)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, types, strict=True)], names)


def trees(placed: DataFrame, largest: int) -> DataFrame:
    """Nodes of all trees over the leaves ``tree, idx, n, digest``; the root alone keeps its ``digest`` and has no ``entry``."""
    spark = placed.sparkSession
    path, base, waiting, written = scratch_path(spark, "nodes"), 0, placed, []
    while True:
        block = F.shiftright("idx", PASS_LEVELS).alias("block")
        rows = waiting.select("tree", block, "idx", "n", "digest").repartition("tree", "block")
        risen = rows.sortWithinPartitions("tree", "block", "idx").mapInArrow(partial(_raise_map, base, PASS_LEVELS), _NODES)
        written.append(f"{path}/base={base}")
        risen.write.parquet(written[-1])
        base += PASS_LEVELS
        if base >= _top(largest):
            break
        ended = spark.read.parquet(written[-1]).filter("digest is not null")
        waiting = ended.filter((F.col("height") == base) & (F.col("n") > 1 << base))
    out = None
    for k, pass_path in enumerate(written, 1):
        # A node that went on rising has its sibling in the next pass.
        reached = 1 << (k * PASS_LEVELS)
        nodes = spark.read.parquet(pass_path).filter(F.col("entry").isNotNull() | (F.col("n") <= reached))
        out = nodes if out is None else out.union(nodes)
    return out


# --- pointer jumping -----------------------------------------------------------------------------


def _jump(lower: DataFrame, upper: DataFrame, distance: int, largest: int) -> DataFrame:
    """Appends to every segment of ``lower`` that of the ancestor ``distance`` levels above it, where there is one."""
    salts = max(1, min(1 << distance, largest) // SHARED)
    spread = upper.select(
        F.col("tree").alias("_tree"), F.col("height").alias("_height"), F.col("idx").alias("_idx"),
        F.col("segment").alias("_more"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
    )
    ancestor = F.shiftright("idx", distance)
    same = (
        (F.col("tree") == F.col("_tree")) & (F.col("height") + distance == F.col("_height"))
        & (ancestor == F.col("_idx")) & (F.col("idx") % salts == F.col("_salt"))
    )
    longer = F.concat("segment", F.coalesce("_more", F.unhex(F.lit("")))).alias("segment")
    return lower.join(spread, same, "left").select("tree", "height", "idx", longer)


def ways(nodes: DataFrame, largest: int) -> DataFrame:
    """``tree, idx, segment``: the siblings of every leaf up to the root of its tree."""
    spark = nodes.sparkSession
    own = nodes.filter("entry is not null").select("tree", "height", "idx", F.col("entry").alias("segment"))
    from_leaf, inner, distance = own.filter("height = 0"), own.filter("height > 0"), 1
    while distance < _top(largest):
        upper = inner.filter(F.col("height") % (2 * distance) == distance)
        lower = inner.filter(F.col("height") % (2 * distance) == 0)
        from_leaf = _jump(from_leaf, upper, distance, largest)
        distance *= 2
        if distance < _top(largest):
            path = scratch_path(spark, "segments")
            _jump(lower, upper, distance // 2, largest).write.parquet(path)
            inner = spark.read.parquet(path)
    return from_leaf.select("tree", "idx", "segment")


def _rooted(placed: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """The whole ways of the leaves, and ``tree, digest`` of the roots."""
    nodes = trees(placed, largest)
    return ways(nodes, largest), nodes.filter("entry is null").select("tree", "digest")


# --- manifest ------------------------------------------------------------------------------------


def _siblings(segment: bytes | None) -> list[tuple[str, str]]:
    way = segment or b""
    return [(chr(way[i]), way[i + 1 : i + ENTRY_BYTES].hex()) for i in range(0, len(way), ENTRY_BYTES)]


def fold(start: str, segment: bytes | None) -> str:
    """The root that a leaf and its siblings lead to."""
    digest = start
    for side, sibling in _siblings(segment):
        digest = _hash({"L": sibling + digest, "R": digest + sibling, "-": digest}[side])
    return digest


def _prove_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    for batch in batches:
        leaf_, tampered, segment, root = (batch.column(c).to_pylist() for c in ("leaf", "tampered", "segment", "root"))
        proofs = [_hash("".join(s for side, s in _siblings(w) if side != "-")) for w in segment]
        folded = [fold(t or own, w) for own, t, w in zip(leaf_, tampered, segment, strict=True)]
        good = np.array([f == r for f, r in zip(folded, root, strict=True)], bool)
        found = [pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array(good)]
        kept = [batch.column(c) for c in names[:4]]
        yield pa.RecordBatch.from_arrays([*kept, *found], names)


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    path = scratch_path(spark, "leaves")
    sequence(leaves(docs), ["lang", "doc_id", "leaf"]).write.parquet(path)
    placed = spark.read.parquet(path)
    counted = placed.groupBy("lang").agg(F.min(POSITION).alias("first"), F.count("*").alias("n"))
    path = scratch_path(spark, "languages")
    sequence(counted, ["lang"]).withColumnRenamed(POSITION, "tree").write.parquet(path)
    languages = spark.read.parquet(path)
    largest, count = languages.agg(F.max("n"), F.count("*")).first()
    if not count:
        return spark.createDataFrame([], out)

    tree_of = languages.select(F.col("lang").alias("_lang"), "first", "n", "tree")
    numbered = placed.join(tree_of, F.col("lang").eqNullSafe(F.col("_lang"))).withColumn("idx", F.col(POSITION) - F.col("first"))
    of_rows, subroots = _rooted(numbered.select("tree", "idx", "n", F.unhex("leaf").alias("digest")), largest)
    path = scratch_path(spark, "subroots")
    subroots.write.parquet(path)
    subroots = spark.read.parquet(path)
    as_leaves = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(count).cast("long").alias("n"), "digest")
    of_subroots, root = _rooted(as_leaves, count)
    hexed = F.lower(F.hex("digest"))
    above = subroots.select("tree", hexed.alias("subroot")).join(
        of_subroots.select(F.col("idx").alias("tree"), F.col("segment").alias("above")), "tree", "left"
    )
    top = root.select(hexed.alias("root")).first()["root"]
    path = scratch_path(spark, "above")
    above.write.parquet(path)
    nothing = F.unhex(F.lit(""))
    whole = (
        numbered.select("tree", "idx", "doc_id", "leaf", "tampered").join(of_rows, ["tree", "idx"], "left")
        .join(spark.read.parquet(path), "tree")
        .select("doc_id", "leaf", "tampered", "subroot", F.lit(top).alias("root"), F.concat(F.coalesce("segment", nothing), F.coalesce("above", nothing)).alias("segment"))
    )
    return whole.mapInArrow(_prove_map, out)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


# --- the same in SQL -----------------------------------------------------------------------------


def _sql_leaf(n_chars: str) -> str:
    printed = [n_chars if name == "n_chars" else name for name in FIELDS]
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in printed]
    return "sha256(" + " || ".join(parts) + ")"


#: Checksum of the decimal id, bit by bit (reflected polynomial).
_SQL_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
    "lambda ch: [1000 + ascii(ch), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]))), "
    "lambda c, step: CASE WHEN step >= 1000 THEN xor(c, step - 1000) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"
)


def _sql_tree(name: str, source: str) -> str:
    """Nodes ``tree, h, i, d`` of the trees over the leaves ``tree, i, n, d``."""
    return (
        f"{name} AS (SELECT tree, 0 AS h, i, n, d FROM {source} UNION ALL "
        "SELECT tree, h + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) "
        f"FROM {name} WHERE n > 1 GROUP BY tree, h + 1, i // 2, (n + 1) // 2)"
    )


def _sql_ways(name: str, nodes: str, source: str) -> str:
    """``tree, i, way`` of every leaf: the list of siblings, each with its side in front."""
    sibling = f"LEFT JOIN {nodes} s ON s.tree = l.tree AND s.h = p.h AND s.i = xor(p.i, 1)"
    side = "CASE WHEN s.d IS NULL THEN '-' WHEN p.i % 2 = 0 THEN 'R' || s.d ELSE 'L' || s.d END"
    return (
        f"{name} AS (SELECT l.tree, l.i, list({side} ORDER BY p.h) FILTER (WHERE p.n > 1) AS way FROM {source} l "
        f"JOIN {nodes} p ON p.tree = l.tree AND p.i = l.i >> p.h {sibling} GROUP BY 1, 2)"
    )


SQL = (
    f"WITH RECURSIVE hashed AS (SELECT doc_id, lang, {_sql_leaf('n_chars')} AS leaf, "
    f"CASE WHEN {_SQL_CRC} % {TAMPER_EVERY} = 0 THEN {_sql_leaf('n_chars + 1')} END AS tampered FROM documents), "
    "rows_ AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, "
    "row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n, leaf AS d FROM hashed), "
    + _sql_tree("low", "rows_") + ", "
    + "tops AS (SELECT 0 AS tree, tree AS i, (SELECT count(DISTINCT tree) FROM rows_) AS n, d FROM low WHERE n = 1), "
    + _sql_tree("high", "tops") + ", " + _sql_ways("low_ways", "low", "rows_") + ", " + _sql_ways("high_ways", "high", "tops") + ", "
    + "whole AS (SELECT r.*, t.d AS subroot, (SELECT d FROM high WHERE n = 1) AS root, "
    "list_concat(coalesce(w.way, []), coalesce(v.way, [])) AS way FROM rows_ r JOIN tops t ON t.i = r.tree "
    "JOIN low_ways w ON w.tree = r.tree AND w.i = r.i JOIN high_ways v ON v.i = r.tree), "
    "folded AS (SELECT *, list_reduce(list_prepend(coalesce(tampered, leaf), way), lambda a, s: sha256(CASE s[1] "
    "WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root FROM whole) "
    "SELECT doc_id, leaf, subroot, root, sha256(coalesce(list_aggregate(list_transform(list_filter(way, lambda s: s <> '-'), "
    "lambda s: s[2:]), 'string_agg', ''), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded"
)
