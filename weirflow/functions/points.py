"""Time-series point text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.schema import FLOAT_FIELDS, MEASUREMENT, POINT_FIELDS


def _escaped_tag(value: Column) -> Column:
    return F.regexp_replace(value, r"([,= ])", r"\\$1")


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), F.regexp_replace(value, r'(["\\])', r"\\$1"), F.lit('"'))


def _field(column: str) -> Column:
    """``name=value``, NULL where the point must not carry the field."""
    value = F.col(column)
    if column in FLOAT_FIELDS:
        wide = value.cast("double")
        whole = (wide == F.floor(wide)) & (F.abs(wide) < 1e7)
        text = F.when(whole, wide.cast("long").cast("string")).otherwise(wide.cast("string"))
        finite = ~F.isnan(wide) & (F.abs(wide) != float("inf"))
        return F.when(finite, F.concat(F.lit(f"{column}="), text))
    return F.concat(F.lit(f"{column}="), value.cast("int").cast("string"), F.lit("i"))


def line_protocol(present: list[str], moment: Column, measurement: str = MEASUREMENT) -> Column:
    """``measurement,alert_type=… fields… nanoseconds`` with the fields in name order."""
    fields = {c: _field(c) for c in POINT_FIELDS if c in present}
    fields["event_time"] = F.concat(F.lit("event_time="), _quoted(F.col("timestamp")))
    body = F.concat_ws(",", *(fields[name] for name in sorted(fields)))
    nanos = (F.unix_micros(moment.cast("timestamp")) * 1000).cast("string")
    return F.concat(
        F.lit(f"{measurement},alert_type="), _escaped_tag(F.col("alert_type")),
        F.lit(" "), body, F.lit(" "), nanos,
    ).alias("line")
