"""Message payloads: rounding, validation, JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.functions.parsing import all_of, is_present
from weirflow.schema import LABEL, RANGES, RECORD, SENSORS, STATUSES

DECIMALS = 4


def payload_column(column: str) -> Column:
    value = F.col(column)
    if column in SENSORS:
        return F.round(value.cast("double"), DECIMALS).alias(column)
    if column in STATUSES or column == LABEL:
        return value.cast("int").alias(column)
    return value


def payload_columns() -> list[Column]:
    return [payload_column(c) for c in RECORD]


def payload_json() -> Column:
    """One message; expects payload columns that passed validation."""
    return F.to_json(F.struct(*RECORD)).alias("value")


def number_text(value: Column) -> Column:
    """Decimal text without an exponent for every value the payload rounding can produce."""
    size = F.abs(value)
    plain = F.regexp_replace(value.cast("decimal(38,4)").cast("string"), r"(\.\d+?)0+$", "$1")
    exponent_free = (size == 0) | ((size >= 1e-3) & (size < 1e7)) | (size >= 1e16)
    return F.when(exponent_free, value.cast("string")).otherwise(plain)


def _problem(column: str, kind: str, message: Column) -> Column:
    return F.struct(F.lit(column).alias("field"), F.lit(kind).alias("kind"), message.alias("message"))


def _sensor_problem(column: str) -> Column:
    low, high = RANGES[column]
    value = F.col(column)
    out_of_range = F.concat(
        F.lit(f"{column}="), number_text(value), F.lit(f" out of range [{low}, {high}]")
    )
    return F.when(
        ~is_present(column), _problem(column, "null", F.lit(f"{column} is null/NaN"))
    ).when(~value.between(low, high), _problem(column, "range", out_of_range))


def _status_problem(column: str) -> Column:
    value = F.col(column)
    invalid = F.concat(F.lit(f"{column}="), value.cast("string"), F.lit(" invalid (expected 0 or 1)"))
    return F.when(value.isNull(), _problem(column, "null", F.lit(f"{column} is null"))).when(
        ~value.isin(0, 1), _problem(column, "status", invalid)
    )


def _time_missing() -> Column:
    stamp = F.col("timestamp")
    return stamp.isNull() | (stamp == "")


def problems() -> Column:
    """Array of (field, kind, message): timestamp first, then sensors, then statuses."""
    stamp = F.when(
        _time_missing(), _problem("timestamp", "missing", F.lit("timestamp missing or invalid"))
    )
    checks = [stamp, *(_sensor_problem(c) for c in SENSORS), *(_status_problem(c) for c in STATUSES)]
    return F.array_compact(F.array(*checks)).alias("problems")


def is_valid() -> Column:
    """The same verdict as an empty problem list, without building any text.

    Columns of one range are judged by their smallest and their largest value, so there are four tests
    and not one per column. An absent reading counts as beyond both ends; NaN is the largest number.
    """
    groups: dict[tuple[float, float], list[Column]] = {}
    for c in SENSORS:
        groups.setdefault(tuple(RANGES[c]), []).append(F.col(c).cast("double"))
    groups[0, 1] = [F.col(c).cast("double") for c in STATUSES]

    def within(bounds: tuple[float, float], columns: list[Column]) -> Column:
        smallest = F.least(*(F.coalesce(c, F.lit(float("-inf"))) for c in columns))
        largest = F.greatest(*(F.coalesce(c, F.lit(float("inf"))) for c in columns))
        return (smallest >= bounds[0]) & (largest <= bounds[1])

    return all_of([~_time_missing(), *(within(bounds, columns) for bounds, columns in groups.items())])


def problem_tests() -> dict[tuple[str, str], Column]:
    """Whether a payload has a problem, by (field, kind): what ``problems`` lists, as plain conditions."""
    tests = {("timestamp", "missing"): _time_missing(), ("*", "skipped"): ~is_valid()}
    for c in SENSORS:
        tests[c, "null"] = ~is_present(c)
        tests[c, "range"] = is_present(c) & ~F.col(c).between(*RANGES[c])
    for c in STATUSES:
        tests[c, "null"] = F.col(c).isNull()
        tests[c, "status"] = ~F.col(c).isin(0, 1)
    return tests
