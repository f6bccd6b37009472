"""Telemetry derived from the ``events`` table: one wide record per event.

Integer arithmetic on the event and user numbers spreads every reading over its
normal band and, at fixed strides, over the conditions the plant rules look for
(missing, out of range, ghost flow, pressure collapse). See FIXTURES.md §4.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.parsing import RAW_TIME_FORMAT
from weirflow.schema import (
    ACTUATORS, FLOWS, LABEL, PRESSURES, RAW_RECORD, RAW_TIME, RECORD, STATUSES, TANKS,
    UNKNOWN_LABEL,
)

# Middle of each tank's usual band.
TANK_MIDDLE = [4.0, 2.5, 3.0, 3.0, 2.5, 3.0, 2.5]
GHOST_FLOW_ACTUATOR = "PU3"

KEYS = ["event_id", "ts"]


# The readings are SQL text: one call per column to build, where a tree of Column
# operators would cost the driver a round trip per operator.


def _level(k: int) -> str:
    wobble = f"(event_id * {2 * k + 3} + user_id * {k + 5})"
    return f"""cast(case when event_id % 97 = {k} then null
        when (event_id + {3 * k}) % 11 = 0 then {wobble} % 700 / 100.0D
        else {TANK_MIDDLE[k - 1]}D + {wobble} % 50 / 100.0D end as float)"""


def _status(j: int) -> str:
    return f"""cast(case when event_id % 101 = {j} then null
        else (event_id * {2 * j + 1} + user_id * {j}) % 7 % 2 end as int)"""


def _flow(j: int, actuator: str) -> str:
    ghost = "when event_id % 53 = 3 then 65.0D" if actuator == GHOST_FLOW_ACTUATOR else ""
    return f"""cast(case when event_id % 103 = {j} then null when event_id % 211 = {j} then 600.0D {ghost}
        else cast(coalesce(S_{actuator}, 0) * (30 + (event_id * 3 + {17 * j}) % 70) as double) end as float)"""


def _pressure(x: int) -> str:
    return f"""cast(case when event_id % 223 = {x} then 150.0D when event_id % 59 = 7 then {x / 10}D
        else 20.0D + (event_id * {x + 2} + user_id) % 600 / 10.0D end as float)"""


LABEL_TEXT = f"""cast(case when event_type = 'error' then 1
    when event_type = 'signup' and event_id % 4 = 0 then {UNKNOWN_LABEL} else 0 end as int)"""


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, ts`` followed by the 45 record columns."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = events.selectExpr(
        *KEYS,
        "user_id",
        "date_format(ts, \"yyyy-MM-dd'T'HH:00:00'Z'\") as timestamp",
        *(f"{_level(k)} as {c}" for k, c in enumerate(TANKS, 1)),
        *(f"{_status(j)} as {c}" for j, c in enumerate(STATUSES, 1)),
        *(f"{_pressure(x)} as {c}" for x, c in enumerate(PRESSURES, 1)),
        f"{LABEL_TEXT} as {LABEL}",
    )
    flows = {f: f"{_flow(j, a)} as {f}" for j, (f, a) in enumerate(zip(FLOWS, ACTUATORS), 1)}
    return base.selectExpr(*KEYS, "user_id", *(flows.get(c, c) for c in RECORD))


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as a delimited file would hold them: text, padded times, some junk."""
    wide = telemetry(spark, sf_dir)

    def text(column: str) -> Column:
        value = F.col(column)
        if column == RAW_TIME:
            stamp = F.date_format("ts", RAW_TIME_FORMAT.replace("d/M", "dd/MM").replace("H", "HH"))
            return F.concat(F.lit(" "), stamp, F.lit(" "))
        if column in STATUSES:
            number = STATUSES.index(column) + 1
            return F.concat(value.cast("string"), F.lit(".0")) if number % 2 == 0 else value.cast("string")
        if column == LABEL:
            return value.cast("string")
        printed = value.cast("double").cast("decimal(10,2)").cast("string")
        return F.when(F.col("event_id") % 131 == 5, F.lit("n/a")).otherwise(printed) if column == "L_T6" else printed

    return wide.select(*KEYS, *(text(c).alias(c) for c in RAW_RECORD))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as broker messages (``key``, ``value``), a few of them damaged in transit."""
    wide = telemetry(spark, sf_dir)
    good = F.to_json(F.struct(*RECORD))
    cut = F.concat(F.lit('{"timestamp":"'), F.col("timestamp"))
    quoted = F.regexp_replace(good, r'"L_T1":([0-9.]+)', r'"L_T1":"$1"')
    fractional = F.regexp_replace(good, r'"S_PU1":([01])', r'"S_PU1":$1.5')
    value = (
        F.when(F.col("event_id") % 137 == 0, cut)
        .when(F.col("event_id") % 139 == 0, quoted)
        .when(F.col("event_id") % 149 == 0, fractional)
        .otherwise(good)
    )
    return wide.select(*KEYS, F.col("event_id").cast("string").alias("key"), value.alias("value"))
