"""Row positions and neighbouring rows in one global order, without a single-task window.

The plant is one time series, so ``Window.orderBy(time)`` alone would put the whole
table into one task. Instead every row is sent once, to the block of the order it belongs to (``ordered_blocks``), and
sorted there. A position is the block's start plus the row's place in it. Windows work inside the
blocks; what looks back over a block's start is mended from the last rows of the blocks before it, the
only rows that travel again (``in_blocks``). Walks between a floor and a ceiling are composed per block and then
over the blocks (``clamped_walks``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec

from weirflow.operators.timeseries import number
from weirflow.session import scratch_path

POSITION = "position"
BLOCK, ROW, SIZE = "_block", "_row", "_size"
#: Rows one task of a neighbour window sorts at most (plus the reach).
CHUNK_ROWS = 1 << 18
#: Keys looked at per block to find where blocks begin.
KEYS_PER_BLOCK = 64
#: monotonically_increasing_id: partition number above this bit, row number below.
_ROW_BITS = 33
_HASH_RANGE = 1 << 30


# --- ordered blocks ------------------------------------------------------------------------------


def _reached(bounds: Column, key: Column, most: int) -> Column:
    """How many of the ascending ``bounds`` are not above ``key``, by halving."""
    steps = F.lit([1 << k for k in range(most.bit_length() - 1, -1, -1)])

    def halve(at: Column, step: Column) -> Column:
        beyond = (at + step <= F.size(bounds)) & (F.get(bounds, at + step - 1) <= key)
        return F.when(beyond, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), halve)


def _bounds(keys: DataFrame, order: list[str], blocks: int) -> Column:
    """Where the blocks begin, as a scalar subquery: quantiles of a bounded sample of keys, chosen by their hash."""
    wanted = blocks * KEYS_PER_BLOCK
    n = keys.agg(F.count("*")).scalar()
    chosen = F.pmod(F.xxhash64(*order), F.lit(_HASH_RANGE)) <= F.lit(float(_HASH_RANGE)) * wanted / n
    sample = keys.filter(chosen).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("keys"))
    place = F.transform(F.sequence(F.lit(1), F.lit(blocks)), lambda k: F.floor(k * F.size("keys") / (blocks + 1)).cast("int"))
    return sample.select(F.array_distinct(F.transform(place, lambda k: F.get("keys", k)))).scalar()


def ordered_blocks(df: DataFrame, order: list[str], blocks: int | None = None) -> DataFrame:
    """Adds ``_block``, the 0-based ``_row`` in it, its ``_size`` and the 0-based ``position`` in the order.

    Rows are shuffled once. Before that, two passes over the order columns alone find where blocks begin and how
    many rows they hold. ``df`` has to give the same rows each time; ``order`` should end in a unique key, so that any run of
    equal times can be divided.
    """
    blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(*order)
    bounds = _bounds(keys, order, blocks)

    def dealt(rows: DataFrame) -> DataFrame:
        block = _reached(F.col("_bounds"), F.struct(*order), blocks)
        return rows.withColumn("_bounds", bounds).withColumn(BLOCK, block).drop("_bounds")

    counted = dealt(keys).groupBy(BLOCK).agg(F.count("*").alias("_n"))
    every = df.sparkSession.range(blocks + 2).select(F.col("id").cast("int").alias(BLOCK))  # a block and its end
    before = W.orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)  # one row per block
    summed = every.join(counted, BLOCK, "left").select(BLOCK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    starts = summed.agg(F.transform(F.array_sort(F.collect_list(F.struct(BLOCK, "_start"))), lambda s: s["_start"])).scalar()
    within = W.partitionBy(BLOCK).orderBy(*order)
    start = F.get("_starts", F.col(BLOCK))
    return (
        dealt(df).repartitionById(blocks + 1, F.col(BLOCK))
        .withColumn(ROW, F.row_number().over(within) - 1)
        .withColumn("_starts", starts)
        .withColumn(SIZE, F.get("_starts", F.col(BLOCK) + 1) - start)
        .withColumn(POSITION, start + F.col(ROW))
        .drop("_starts")
    )


def in_blocks(
    df: DataFrame, order: list[str], reach: int, columns: Callable[[WindowSpec], list[Column]],
    blocks: int | None = None, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``df`` with window columns that look back at most ``reach`` rows.

    Most rows find all they look back at in their own block and stay there. The first ``reach`` rows of a block are
    computed again beside the last ``reach`` of the blocks before; blocks shorter than that send all they have.
    """
    placed = ordered_blocks(df, order, blocks)
    local = placed.select("*", *columns(W.partitionBy(BLOCK).orderBy(*order)))
    added = [c for c in local.columns if c not in placed.columns]
    edges = placed.filter((F.col(ROW) < reach) | (F.col(ROW) >= F.col(SIZE) - reach))
    mended = over_neighbours(edges, reach, columns, chunk_rows).filter(F.col(ROW) < reach)
    names = [*df.columns, *added]
    return local.filter(F.col(ROW) >= reach).select(*names).union(mended.select(*names))


# --- clamped walks -------------------------------------------------------------------------------


class Walk(NamedTuple):
    """A value that moves by ``step`` with every row and is kept between ``low`` and ``high``; whole numbers.

    Where ``begin`` is not null, the walk starts again from there with that row's step. A null step is no step.
    """

    step: Column
    begin: Column
    low: Column
    high: Column


#: A bound that no walk reaches, small enough to be added to.
FAR = 1 << 60
_PARTS = ("add", "low", "high")


def _then(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One step after another, again a step: rows are (add, low, high) for ``x -> min(high, max(low, x + add))``."""
    add, low, high = first
    return np.stack([
        add + second[0],
        np.minimum(second[2], np.maximum(second[1], low + second[0])),
        np.minimum(second[2], np.maximum(second[1], high + second[0])),
    ])


def _composed(steps: np.ndarray) -> np.ndarray:
    """Every step after all before it, in a logarithmic number of passes."""
    out, distance = steps, 1
    while distance < out.shape[1]:
        out = np.concatenate([out[:, :distance], _then(out[:, :-distance], out[:, distance:])], axis=1)
        distance *= 2
    return out


def _walk_map(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block; replaces each walk's four columns by the composition of its steps since the block began."""
    block, carried = None, {}
    for batch in batches:
        if not len(batch):
            continue
        blocks = batch.column(BLOCK).to_numpy()
        cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(batch)]
        out = {name: np.empty((3, len(batch)), np.int64) for name in names}
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if blocks[a] != block:
                block, carried = blocks[a], {}
            for name in names:
                step, low, high = (batch.column(f"{name}_{part}").slice(a, b - a).fill_null(0).to_numpy() for part in _PARTS)
                begin = batch.column(f"{name}_begin").slice(a, b - a)
                starts = begin.is_valid().to_numpy(zero_copy_only=False)
                first = np.minimum(high, np.maximum(low, begin.fill_null(0).to_numpy() + step))
                steps = np.stack([np.where(starts, 0, step), np.where(starts, first, low), np.where(starts, first, high)])
                if name in carried:
                    steps[:, :1] = _then(carried[name], steps[:, :1])
                done = _composed(steps)
                carried[name] = done[:, -1:].copy()
                out[name][:, a:b] = done
        kept = [c for c in batch.schema.names if c not in {f"{n}_{p}" for n in names for p in (*_PARTS, "begin")}]
        columns = [batch.column(c) for c in kept] + [pa.array(row) for name in names for row in out[name]]
        yield pa.RecordBatch.from_arrays(columns, [*kept, *(f"{name}_{part}" for name in names for part in _PARTS)])


def _enter_map(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order with their whole composition; the value of each walk as it enters them."""
    now = dict.fromkeys(names, 0)
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            rows.append({BLOCK: row[BLOCK], **{f"{n}_in": now[n] for n in names}})
            for n in names:
                add, low, high = (row[f"{n}_{part}"] for part in _PARTS)
                now[n] = min(high, max(low, now[n] + add))
        kinds = [(BLOCK, pa.int32()), *((f"{n}_in", pa.int64()) for n in names)]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))


def clamped_walks(placed: DataFrame, walks: dict[str, Walk]) -> DataFrame:
    """``placed`` (from ``ordered_blocks``) with a whole-number column per walk; its blocks stay where they are.

    The steps compose: two of them are again a sum between a floor and a ceiling. So every block composes its own steps, its
    last row says what the block as a whole does, and the value that enters a block follows from the blocks before.
    The first row of all has to begin a walk. The result is read from the shared folder.
    """
    if not walks:
        return placed
    spark, names = placed.sparkSession, list(walks)
    parts = [
        c.cast("long").alias(f"{name}_{part}")
        for name, w in walks.items() for part, c in (("add", w.step), ("low", w.low), ("high", w.high), ("begin", w.begin))
    ]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    kinds = kept + "".join(f", `{name}_{part}` long" for name in names for part in _PARTS)
    path = scratch_path(spark, "walks")
    in_order = placed.select("*", *parts).sortWithinPartitions(BLOCK, POSITION)
    in_order.mapInArrow(partial(_walk_map, names), kinds).write.parquet(path)
    stored = spark.read.parquet(path)
    composed = [f"{name}_{part}" for name in names for part in _PARTS]
    last = stored.filter(F.col(ROW) == F.col(SIZE) - 1).select(BLOCK, *composed)  # one row per block
    entering = last.repartition(1).sortWithinPartitions(BLOCK).mapInArrow(
        partial(_enter_map, names), f"{BLOCK} int" + "".join(f", `{name}_in` long" for name in names)
    )
    values = [
        F.least(f"{n}_high", F.greatest(F.col(f"{n}_low"), F.col(f"{n}_in") + F.col(f"{n}_add"))).alias(n) for n in names
    ]
    return stored.join(entering, BLOCK).select(*placed.columns, *values)


# --- positions over written blocks ---------------------------------------------------------------


def sequence(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds the 0-based ``position`` in the total order given by ``order``.

    The sorted blocks are written to the shared folder first: positions come from
    two passes that have to see the same blocks, also after an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "sequence")
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    stored = spark.read.parquet(path)
    block = F.shiftright("_row", _ROW_BITS)
    sizes = stored.select(block.alias("_block")).groupBy("_block").agg(F.count("*").alias("_n"))
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row per range partition; how it is joined is decided by its size.
    offset = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        stored.withColumn("_block", block)
        .join(starts, "_block")
        .withColumn(POSITION, F.col("_start") + offset)
        .drop("_row", "_block", "_start")
    )


def over_neighbours(
    sequenced: DataFrame,
    reach: int,
    columns: Callable[[WindowSpec], list[Column]],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Window columns that look back at most ``reach`` rows.

    Rows are cut into chunks of equal size by position; a row is also sent, as context only, to every
    following chunk that looks back at it: the next one, or more where the reach is longer than a chunk.
    """
    chunk = F.floor(F.col(POSITION) / chunk_rows)
    homes = F.sequence(chunk, F.floor((F.col(POSITION) + reach) / chunk_rows))
    window = W.partitionBy("_chunk").orderBy(POSITION)
    return (
        sequenced.select("*", F.explode(homes).alias("_chunk"))
        .select("*", *columns(window))
        .filter(chunk == F.col("_chunk"))
        .drop("_chunk")
    )


def feature_diff(df: DataFrame, columns: list[str], order: list[str], blocks: int | None = None) -> DataFrame:
    """Change of every reading since the previous record; NaN counts as missing."""

    def changes(w: WindowSpec) -> list[Column]:
        now = {c: number(c) for c in columns}
        return [(v - F.lag(v, 1).over(w)).alias(f"{c}_diff") for c, v in now.items()]

    return in_blocks(df.select(*order, *columns), order, 1, changes, blocks).drop(*columns)


def feature_rolling_mean(
    df: DataFrame, columns: list[str], order: list[str], rows: int, blocks: int | None = None
) -> DataFrame:
    """Mean of every reading over the record and its ``rows - 1`` predecessors; NaN counts as missing."""

    def means(w: WindowSpec) -> list[Column]:
        frame = w.rowsBetween(-(rows - 1), 0)
        return [F.avg(number(c)).over(frame).alias(f"{c}_mean") for c in columns]

    return in_blocks(df.select(*order, *columns), order, rows - 1, means, blocks).drop(*columns)
