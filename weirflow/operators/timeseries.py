"""Time-series queries.

Records are kept wide: a field is a column, so asking for one field reads one
column, and a series is (field, alert_type). Aggregates run on the wide table and
only their small result is turned long; nothing multiplies the rows by the number
of fields before a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weirflow.functions.parsing import any_of
from weirflow.functions.points import line_protocol
from weirflow.functions.rules import status_text
from weirflow.schema import MEASUREMENT, POINT_FIELDS, TANKS, VIOLATION_LIMITS

TIME = "ts"
SERIES = "alert_type"


def _values(df: DataFrame, fields: list[str]) -> list[Column]:
    """Fields as doubles; a field the table lacks has no values at all."""
    return [
        (number(f) if f in df.columns else F.lit(None).cast("double")).alias(f)
        for f in fields
    ]


def number(field: str) -> Column:
    """The field as a double; NaN counts as missing."""
    return F.nanvl(F.col(field).cast("double"), F.lit(None).cast("double"))


def points(df: DataFrame, fields: list[str] = POINT_FIELDS, keys: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Long form: one row per record and present field."""
    wide = df.select(
        *keys,
        F.lit(MEASUREMENT).alias("measurement"),
        SERIES,
        F.col("timestamp").alias("event_time"),
        F.col(TIME).alias("_time"),
        *_values(df, fields),
    )
    ids = [*keys, "measurement", SERIES, "event_time", "_time"]
    return wide.unpivot(ids, fields, "field", "value").filter("value is not null")


def lines(df: DataFrame, keys: tuple[str, ...] = ("event_id",)) -> DataFrame:
    return df.select(*keys, line_protocol(df.columns, F.col(TIME)))


def keep(long: DataFrame, columns: list[str]) -> DataFrame:
    return long.select(*columns)


# --- ranges --------------------------------------------------------------------------------------


def between(df: DataFrame, start: Column, stop: Column, time: str = TIME) -> DataFrame:
    """Start included, stop excluded."""
    return df.filter((F.col(time) >= start) & (F.col(time) < stop))


def newest(df: DataFrame, time: str = TIME) -> Column:
    """Latest time of the table as a scalar subquery, evaluated once inside the query."""
    return df.select(F.max(time)).scalar()


def recent(df: DataFrame, length: str, anchor: Column | None = None, time: str = TIME) -> DataFrame:
    """The last ``length`` before the anchor (now by default), anchor included."""
    anchor = F.current_timestamp() if anchor is None else anchor
    return df.filter(
        (F.col(time) >= anchor - F.expr(f"INTERVAL {length}")) & (F.col(time) <= anchor)
    )


# --- per-series aggregates -----------------------------------------------------------------------


def _grouped(
    df: DataFrame, by: list[Column | str], names: list[str], fields: list[str], fn: Callable[[Column], Column],
    value: str,
) -> DataFrame:
    """One wide aggregate (partial, then final), turned long afterwards."""
    plain = [c for c in fields if c in df.columns]
    wide = df.groupBy(*by).agg(*(fn(number(f)).alias(f) for f in plain))
    return wide.unpivot(names, plain, "field", value).filter(F.col(value).isNotNull())


def series_count(df: DataFrame, fields: list[str] = POINT_FIELDS) -> DataFrame:
    return _grouped(df, [SERIES], [SERIES], fields, F.count, "n").filter("n > 0")


def field_sum(df: DataFrame, fields: list[str]) -> DataFrame:
    """Sum per field over all tags."""
    return _grouped(df, [], [], fields, F.sum, "value")


def aggregate_window(
    df: DataFrame, fields: list[str], every: str, fn: Callable[[Column], Column], stop: Column | None = None
) -> DataFrame:
    """Epoch-aligned tumbling windows per series, stamped with their end (or the range's, if earlier)."""
    window = F.window(TIME, every)
    wide = df.groupBy(window.alias("w"), SERIES).agg(
        *(fn(number(f)).alias(f) for f in fields)
    )
    end = F.col("w.end") if stop is None else F.least(F.col("w.end"), stop)
    return (
        wide.select(end.alias("_time"), SERIES, *fields)
        .unpivot(["_time", SERIES], fields, "field", "value")
        .filter("value is not null")
    )


def tank_violations(df: DataFrame, every: str) -> DataFrame:
    """Window means outside their tank's limits, all tanks from one aggregate."""
    means = aggregate_window(df, TANKS, every, F.avg)
    outside = None
    for tank, (low, high) in VIOLATION_LIMITS.items():
        beyond = F.col("value") < low
        if high is not None:
            beyond = beyond | (F.col("value") > high)
        test = (F.col("field") == tank) & beyond
        outside = test if outside is None else outside | test
    return means.filter(outside).select(
        "_time", SERIES, F.col("field").alias("tank"), F.lit("violation").alias("field"), "value"
    )


def last(
    df: DataFrame, fields: list[str] = POINT_FIELDS, key: str = "event_id", time: str = TIME, keep_key: bool = False
) -> DataFrame:
    """Latest value of every series, with its time; among equal times the highest key.

    First the latest time per series, then the values of the few records at those
    times: two hash aggregates over plain numbers, never a sort of the table. The
    times go to the records, as the records of a frequent tag would go to one task.
    """

    def time_of(f: str) -> str:
        return f"{f}__time"

    fields = [f for f in fields if f in df.columns]
    times = df.groupBy(SERIES).agg(
        *(F.max(F.when(number(f).isNotNull(), F.col(time))).alias(time_of(f)) for f in fields)
    )
    # One row per alert type of the rules; what Spark expects of an aggregate grows with its input.
    candidates = df.join(F.broadcast(times), SERIES).filter(
        any_of(F.col(time) == F.col(time_of(f)) for f in fields)
    )

    pairs = F.array(
        *(
            F.struct(
                F.lit(f).alias("field"), F.col(time_of(f)).alias("_time"), number(f).alias("value")
            )
            for f in fields
        )
    )
    at_latest = candidates.select(SERIES, F.col(time).alias("_at"), F.col(key).alias("key"), F.inline(pairs)).filter(
        (F.col("_time") == F.col("_at")) & F.col("value").isNotNull()
    )
    found = at_latest.groupBy(SERIES, "field").agg(
        F.max("_time").alias("_time"), F.max("key").alias("key"), F.max_by("value", "key").alias("value")
    )
    return found if keep_key else found.drop("key")


def pivot_latest(df: DataFrame, fields: list[str], key: str = "event_id") -> DataFrame:
    """Latest values side by side, one row per (time, alert type); the field list is fixed."""
    return last(df, fields, key).groupBy("_time", SERIES).pivot("field", fields).agg(F.first("value"))


def first_n(df: DataFrame, fields: list[str], n: int, key: str = "event_id") -> DataFrame:
    """First ``n`` points of every series, whatever ``n`` and however large a series is.

    The wide rows are sorted once per tag, dealt over salts so that a frequent tag is not one task. A row
    stays if it is among the first ``n`` present values of some field in its part; only what stays, at most
    ``n`` rows per series and salt, is turned long and ranked.
    """
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = W.partitionBy(SERIES, "_salt").orderBy(TIME, key)
    present = [f for f in fields if f in df.columns]
    needed = list(dict.fromkeys([key, SERIES, "timestamp", TIME, *present]))
    early = F.lit(False)
    for f in present:
        seen = F.count(number(f)).over(part.rowsBetween(W.unboundedPreceding, W.currentRow))
        early = early | (number(f).isNotNull() & (seen <= n))
    salted = df.select(*needed, F.pmod(F.xxhash64(key), F.lit(salts)).alias("_salt"))
    kept = salted.withColumn("_early", early).filter("_early").drop("_salt", "_early")
    order = W.partitionBy("field", SERIES).orderBy("_time", key)
    ranked = points(kept, fields, (key,)).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= n)


def status_now(df: DataFrame, flag: str, key: str = "event_id") -> DataFrame:
    """The newest flag of every series and its display text."""
    newest_flags = last(df, [flag], key).withColumn("value", F.col("value").cast("int"))
    return newest_flags.select(SERIES, "_time", "value", status_text(F.col("value")).alias("status"))


# --- health probes -------------------------------------------------------------------------------


def freshness(df: DataFrame, length: str, anchor: Column | None = None) -> DataFrame:
    return recent(df, length, anchor).agg(F.count("*").alias("n")).select("n", (F.col("n") > 0).alias("ok"))


def field_presence(df: DataFrame, expected: list[str]) -> DataFrame:
    """Present values per expected field; a field without any still shows, with zero."""
    kinds = dict(df.dtypes)

    def value(f: str) -> Column:
        if f not in kinds:
            return F.lit(None)
        return number(f) if kinds[f] in ("float", "double") else F.col(f)  # NaN counts as missing

    counts = [F.count(value(f)).alias(f) for f in expected]
    long = df.agg(*counts).unpivot([], expected, "field", "n")
    return long.select("field", "n", (F.col("n") > 0).alias("present"))


#: Windows that one row of the calendar stands for before they are dealt out.
_CALENDAR_ROWS = 1 << 12


def calendar(first: Column, last: Column, every: str, span: DataFrame) -> DataFrame:
    """``start`` of every window from the first to the last, made in pieces by all tasks.

    ``span`` has one row, to which the bounds belong.
    """
    step = F.unix_micros(F.expr(f"TIMESTAMP '1970-01-01 00:00:00 UTC' + INTERVAL {every}"))
    begin, end = (F.unix_micros(c.cast("timestamp")) for c in (first, last))
    sized = span.select(begin.alias("_begin"), ((end - begin) / step).cast("long").alias("_last"), step.alias("_step"))
    pieces = sized.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"_last div {_CALENDAR_ROWS}"))).alias("_piece"))
    dealt = pieces.repartition("_piece").withColumn("_from", F.col("_piece") * _CALENDAR_ROWS)
    upto = F.least(F.col("_from") + _CALENDAR_ROWS - 1, F.col("_last"))
    number = F.explode(F.sequence("_from", upto)).alias("_number")
    return dealt.select("_begin", "_step", number).select(
        F.timestamp_micros(F.col("_begin") + F.col("_number") * F.col("_step")).alias("start")
    )


def throughput(df: DataFrame, field: str, every: str, minimum: int) -> DataFrame:
    """Records per window and whether they reach the required number; silent windows count as zero.

    The windows run from the first to the last of the table, which may lie centuries apart.
    """
    counted = df.groupBy(F.window(TIME, every).alias("w")).agg(F.count(number(field)).alias("n"))
    seen = counted.select(F.col("w.start").alias("start"), "n")
    kind = dict(seen.dtypes)["start"]
    span = seen.agg(F.min("start").alias("first"), F.max("start").alias("last")).filter("first IS NOT NULL")
    windows = calendar(F.col("first"), F.col("last"), every, span).select(F.col("start").cast(kind).alias("start"))
    n, step = F.coalesce("n", F.lit(0)).alias("n"), F.expr(f"INTERVAL {every}")
    return windows.join(seen, "start", "left").select((F.col("start") + step).alias("_time"), n).select(
        "_time", "n", (F.col("n") >= minimum).alias("ok")
    )
