"""Conversation structure repair: faults of every conversation and the cheapest edits that make its roles alternate.

The edits come from the block tables of ``block_tables``. Here Spark brings the rows into order. Marks of rows (keys, a digest of the
text, flags) are counted per equal row, range-sorted and numbered, so a conversation of any length lies in many tasks;
the first of equal texts is the one of the smallest number, which one join on that number marks. Then a row is one byte. Bytes
leave in segments, one per conversation and chunk of ``CHUNK_BITS`` bits of the number; one task joins the segments of a conversation, as
long in bytes as the audit it returns. Texts are shuffled once, for the digest of the result, which reads them in
order without keeping them.

Defined results: a null role or text reads as one space; null turns come first; equal turns stand by role, then by the digest
of their text; equal rows are one row repeated, all but the first are duplicates. A null ``conv_id`` is a conversation. Columns other than
the four are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import block_tables as B
from weirflow.llm.ragged import starts_of
from weirflow.llm.tables import table
from weirflow.operators.ordering import POSITION, sequence
from weirflow.session import scratch_path

CHUNK_BITS = 16
#: Conversations up to this length are looked up among those already repaired.
SHORT = 64
# The six white-space characters.
WHITE_SPACE = " \t\n\x0b\x0c\r"
DAMAGE_EVERY = 20
#: What the digest of an empty result is.
NOTHING = sha256(b"").hexdigest()
_COUNTS = "blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def damage(turns: DataFrame) -> DataFrame:
    """A fixed share of rows dropped, emptied, stripped of sentence ends, repeated or given to the user."""
    read = {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")}
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % DAMAGE_EVERY
    text = F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(read["text"], ".!?", "")).otherwise(read["text"])
    role = F.when(fate == 4, F.lit("user")).otherwise(read["role"])
    copies = F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate"), copies.alias("copies"))
    return kept.filter("fate <> 0").select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def _read(turns: DataFrame) -> DataFrame:
    """The four columns, nulls of role and text read as a space, and the digest of the text."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def gaps(turns: DataFrame) -> DataFrame:
    """``conv_id, gaps``: turns missing between the first and the last."""
    wide = F.max("turn").cast("decimal(21,0)") - F.min("turn") + 1 - F.count("turn")
    by_turn = turns.groupBy("conv_id", "turn").agg(F.count("*"))
    return by_turn.groupBy("conv_id").agg(F.coalesce(wide, F.lit(0)).cast("long").alias("gaps"))


def _codes(turns: DataFrame) -> DataFrame:
    """``conv_id, position, n, code``: every different row in its place, how often it stands there, and its code."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE_SPACE))
    marks = turns.select(
        "conv_id", "turn", "role", "digest", (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ended")
    )
    different = marks.groupBy("conv_id", "turn", "role", "digest").agg(
        F.first("blank").alias("blank"), F.first("ended").alias("ended"), F.count("*").alias("n")
    )
    placed = sequence(different, ["conv_id", "turn", "role", "digest"])
    first = placed.filter("not blank").groupBy("conv_id", "role", "digest").agg(F.min(POSITION).alias(POSITION))
    marked = placed.join(first.select(POSITION, F.lit(True).alias("fresh")), POSITION, "left")
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", B.SYSTEM).when(initial == "u", B.USER).when(initial == "a", B.ASSISTANT).otherwise(B.OTHER)
    kind = (
        F.when(F.col("blank"), B.BLANK).when(F.col("fresh").isNull(), B.DUPLICATE)
        .when(F.col("ended"), B.WHOLE).otherwise(B.CUT)
    )
    return marked.select("conv_id", POSITION, "n", (role + 4 * kind).cast("int").alias("code"))


def _segment_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order become runs of bytes, one per conversation without a gap in the numbers."""
    for batch in batches:
        if not len(batch):
            continue
        conv = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
        position, n, code = (batch.column(k).to_numpy() for k in (1, 2, 3))
        further = np.where(code // 4 == B.BLANK, code, code % 4 + 4 * B.DUPLICATE)
        codes = np.repeat(further, n).astype(np.uint8)
        starts = starts_of(n)
        codes[starts] = code
        new = np.ones(len(batch), bool)
        new[1:] = (conv[1:] != conv[:-1]) | (position[1:] != position[:-1] + 1)
        first = np.flatnonzero(new)
        cuts = np.append(starts[first], len(codes)).tolist()
        runs = [codes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        columns = [batch.column(0).take(pa.array(first)), pa.array(position[first]), pa.array(runs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", POSITION, "codes"])


def _repair_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by conversation and place; one row per conversation leaves."""
    names = ["conv_id", *B.Repair._fields]
    conv, parts, kind = None, [], None

    def closed() -> tuple:
        codes = b"".join(parts)
        return (conv, *(B.repair_short if len(codes) <= SHORT else B.repair)(codes))

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * 5, pa.string()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for batch in batches:
        kind, rows = batch.schema.field(0).type, []
        for c, codes in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if parts and c != conv:
                rows.append(closed())
                parts = []
            conv = c
            parts.append(codes)
        yield packed(rows)
    if parts:
        yield packed([closed()])


class _Lines:
    """Digest of a repaired conversation, row by row along its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, B.NOTHING
        self.digest, self.empty = sha256(), True

    def _line(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._line(B.next_role(self.state), "")
            self.state = B.after_new(self.state)
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._line(role, text)
            self.state = B.after_kept(self.state, "sua".find(role[:1]))
        elif edit == "R":
            self._line(B.next_role(self.state), text)
            self.state = B.after_new(self.state)

    def end(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


def _digest_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation the row with its audit comes first, then its turns in order; the first leaves with the digest."""
    head, lines, found = None, None, None
    for batch in batches:
        out, digests = [], []
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        audits = np.flatnonzero(np.array(columns[1]) == 0).tolist() if len(batch) else []
        marks = set(audits)
        for k, (role, text) in enumerate(zip(columns[3], columns[5], strict=True)):
            if k in marks:
                if lines is not None:
                    out.append(head)
                    digests.append(lines.end())
                head, lines = batch.slice(k, 1), _Lines(text)
            else:
                lines.row(role, text)
        found = batch.schema
        if out:
            yield _results(out, digests)
    if lines is not None:
        yield _results([head], [lines.end()])


def _results(heads: list[pa.RecordBatch], digests: list[str]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(heads).combine_chunks()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    columns = [*(rows[c] for c in names), rows["text"].cast(pa.string()), pa.array(digests)]
    whole = pa.Table.from_arrays(columns, [*names, "audit", "repaired_sha256"]).combine_chunks()
    return whole.to_batches()[0]


def repairs(turns: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = _read(turns)
    chunk = F.shiftright(POSITION, CHUNK_BITS)
    ordered = _codes(rows).repartition(chunk).sortWithinPartitions(POSITION)
    segments = ordered.mapInArrow(_segment_map, f"conv_id {kind}, {POSITION} long, codes binary")
    gathered = segments.repartition("conv_id").sortWithinPartitions("conv_id", POSITION)
    solved = gathered.mapInArrow(_repair_map, f"conv_id {kind}, {_COUNTS}")
    missing = gaps(rows.select(F.col("conv_id").alias("conv"), "turn").withColumnRenamed("conv", "conv_id"))
    missing = missing.withColumnRenamed("conv_id", "_conv")
    heads = solved.join(missing, F.col("conv_id").eqNullSafe(F.col("_conv")))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    absent: dict[str, Column] = {c: F.lit(None).cast("long") for c in counts}
    turn_kind = rows.schema["turn"].dataType
    # Audits and turns travel together: sorted, the audit stands before the turns of its conversation.
    first = heads.select(
        "conv_id", F.lit(0).alias("part"), F.lit(None).cast(turn_kind).alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"), *counts,
    )
    then = rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", "digest", "text", *(absent[c].alias(c) for c in counts))
    together = first.union(then).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "digest")
    return together.mapInArrow(
        _digest_map, f"conv_id {kind}, gaps long, {_COUNTS}, repaired_sha256 string"
    )


def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, also one of which the damage leaves nothing."""
    conversations = table(spark, sf_dir, "conversations")
    path = scratch_path(spark, "repairs")
    repairs(damage(conversations)).write.parquet(path)
    found = spark.read.parquet(path)
    every = conversations.select(F.col("conv_id").alias("_conv")).distinct()
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_conv").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(NOTHING)).alias("repaired_sha256"),
    )
