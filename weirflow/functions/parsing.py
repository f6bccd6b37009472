"""Text to typed columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.schema import LABEL, SENSORS, STATUSES

# Input and output time formats.
RAW_TIME_FORMAT = "d/M/yy H"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
#: Two-digit years from this one on belong to the twentieth century.
PIVOT_YEAR = 2069


def raw_time(text: Column) -> Column:
    """``dd/mm/yy HH`` with optional blanks to a timestamp; unreadable text gives NULL."""
    parsed = F.try_to_timestamp(F.trim(text), F.lit(RAW_TIME_FORMAT))
    century = F.make_interval(years=F.lit(100))
    return F.when(F.year(parsed) >= PIVOT_YEAR, parsed - century).otherwise(parsed)


def iso_time(moment: Column) -> Column:
    return F.date_format(moment, ISO_FORMAT)


def parse_datetime(text: Column) -> Column:
    return iso_time(raw_time(text))


def sensor(text: Column) -> Column:
    """Numeric text to float32 by way of double, as a numeric reader would; junk gives NULL."""
    return text.try_cast("double").cast("float")


def whole_number(text: Column) -> Column:
    """Accepts ``1`` as well as ``1.0``; anything that is no whole number gives NULL."""
    value = text.try_cast("double")
    return F.when(value == F.floor(value), value.try_cast("int"))


def typed(column: str) -> Column:
    source = F.col(column)
    if column in SENSORS:
        return sensor(source).alias(column)
    if column in STATUSES or column == LABEL:
        return whole_number(source).alias(column)
    return source


def is_present(column: str) -> Column:
    """Neither NULL nor NaN."""
    value = F.col(column)
    return value.isNotNull() & ~F.isnan(value) if column in SENSORS else value.isNotNull()


def any_of(conditions: Iterable[Column]) -> Column:
    """True where some condition holds, else false (a NULL condition does not hold).

    Written as one CASE rather than a chain of ORs: Spark's code generator splits the
    branches of a CASE over several methods, while a long chain grows into a single
    method too large for the JVM to compile.
    """
    chain = F
    for condition in conditions:
        chain = chain.when(condition, True)
    return chain.otherwise(False)


def all_of(conditions: Iterable[Column]) -> Column:
    """True where every condition holds; conditions must not be NULL."""
    return ~any_of(~c for c in conditions)


def all_present(columns: list[str]) -> Column:
    return all_of(is_present(c) for c in columns)


def filled(column: str, default: float = 0.0) -> Column:
    value = F.col(column).cast("double")
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(default)).alias(column)
