"""Latest value of every series as a table that batches merge into.

A row is the newest value of one series with its time and source key. Of two rows of a series the one of the later (time, key)
stays, in whatever order and however often they come, so late and repeated batches change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.operators.timeseries import SERIES, last
from weirflow.schema import POINT_FIELDS


def values_of(flagged: DataFrame, time: str, key: str, fields: list[str] = POINT_FIELDS) -> DataFrame:
    """``alert_type, field, _time, key, value`` of a batch; records without a time have no place in it."""
    return last(flagged.filter(F.col(time).isNotNull()), fields, key, time, keep_key=True)


def merged(values: DataFrame) -> DataFrame:
    """One row per series."""
    newest = F.max(F.struct("_time", "key", "value")).alias("newest")
    return values.groupBy(SERIES, "field").agg(newest).select(SERIES, "field", "newest.*")
