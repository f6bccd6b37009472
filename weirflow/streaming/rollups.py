"""Mergeable window aggregates: sums, counts and extremes per base window, merged into any multiple when read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.timeseries import SERIES, number
from weirflow.schema import POINT_FIELDS

#: Width of the windows that are kept.
BASE = "1 hour"
START = "window_start"


def partials(flagged: DataFrame, time: str, fields: list[str] = POINT_FIELDS, base: str = BASE) -> DataFrame:
    """One row per base window and alert type with ``sum``, ``n`` and ``max`` of every field, as structs."""
    present = [f for f in fields if f in flagged.columns]
    parts = [
        (F.sum(number(f)).alias(f"{f}_sum"), F.count(number(f)).alias(f"{f}_n"), F.max(number(f)).alias(f"{f}_max"))
        for f in present
    ]
    windows = flagged.groupBy(F.window(time, base).alias("w"), SERIES).agg(*(c for three in parts for c in three))
    kept = [F.struct(F.col(f"{f}_sum").alias("sum"), F.col(f"{f}_n").alias("n"), F.col(f"{f}_max").alias("max")).alias(f) for f in present]
    return windows.select(F.col("w.start").alias(START), SERIES, *kept)


def _merged(rollup: DataFrame, fields: list[str], every: str, value: dict[str, Column]) -> DataFrame:
    window = F.window(START, every)
    wide = rollup.groupBy(window.alias("w"), SERIES).agg(*(value[f].alias(f) for f in fields))
    long = wide.select(F.col("w.end").alias("_time"), SERIES, *fields).unpivot(["_time", SERIES], fields, "field", "value")
    return long.filter("value is not null")


def window_mean(rollup: DataFrame, fields: list[str], every: str) -> DataFrame:
    """Means per window of a whole multiple of the base; a late batch is one more partial of its window."""
    return _merged(rollup, fields, every, {f: F.sum(f"{f}.sum") / F.nullif(F.sum(f"{f}.n"), F.lit(0)) for f in fields})


def window_max(rollup: DataFrame, fields: list[str], every: str) -> DataFrame:
    return _merged(rollup, fields, every, {f: F.max(f"{f}.max") for f in fields})
