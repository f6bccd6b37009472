"""Live probe: a row whenever a series stays silent longer than allowed."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from weirflow.operators.timeseries import SERIES
from weirflow.streaming.pipeline import EVENT_TIME
from weirflow.streaming.windows import start_append

_RESULT = f"{SERIES} string, last_seen timestamp, silent_at timestamp"


class _Watch(StatefulProcessor):
    """State of one series: the times seen whose silence is not decided yet, in milliseconds, at most one watermark delay and one limit long.

    A time is decided once the watermark has passed it by the limit, because then whatever follows it within the limit has come.
    """

    def __init__(self, limit_ms: int):
        self.limit = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", "times array<long>")

    def _times(self) -> list[int]:
        return list(self.pending.get()[0]) if self.pending.exists() else []

    def _keep(self, times: list[int]) -> None:
        """One timer per series, for the first time that is open."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if times:
            self.pending.update((times,))
            self.handle.registerTimer(times[0] + self.limit)
        else:
            self.pending.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = set(self._times())
        for frame in rows:
            seen.update(int(t) for t in frame["seen_ms"])
        self._keep(sorted(seen))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, times = timerValues.getCurrentWatermarkInMs(), self._times()
        decided = [t for t in times if t + self.limit <= now]
        silent = [
            t for t, after in zip(decided, [*times[1:], None]) if after is None or after - t > self.limit
        ]
        self._keep(times[len(decided) :])
        if silent:
            stamp = [datetime.fromtimestamp(t / 1000, timezone.utc) for t in silent]
            late = [datetime.fromtimestamp((t + self.limit) / 1000, timezone.utc) for t in silent]
            yield pd.DataFrame({SERIES: key[0], "last_seen": stamp, "silent_at": late})

    def close(self) -> None:
        pass


def silences(flagged: DataFrame, minutes: int, delay: str) -> DataFrame:
    """``alert_type, last_seen, silent_at`` of every series that nothing was heard of for ``minutes`` after a record.

    A row leaves once the watermark, ``delay`` behind the newest event time of all series, has passed ``silent_at``.
    """
    seen = flagged.filter(F.col(EVENT_TIME).isNotNull()).withWatermark(EVENT_TIME, delay)
    return (
        seen.select(SERIES, EVENT_TIME, F.unix_millis(EVENT_TIME).alias("seen_ms"))
        .groupBy(SERIES)
        .transformWithStateInPandas(_Watch(minutes * 60_000), _RESULT, "Append", "EventTime")
    )


def start(flagged: DataFrame, minutes: int, delay: str, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Appends silences to a table."""
    return start_append(silences(flagged, minutes, delay), path, checkpoint, once)


def silences_of(table: DataFrame, minutes: int, until: Column | None = None, time: str = EVENT_TIME) -> DataFrame:
    """The same over stored records, up to ``until`` (the newest record by default)."""
    newest = table.select(F.max(time)).scalar() if until is None else until
    limit = F.expr(f"INTERVAL {minutes} MINUTES")
    times = table.filter(F.col(time).isNotNull()).select(SERIES, F.col(time).alias("last_seen")).distinct()
    following = F.lead("last_seen").over(W.partitionBy(SERIES).orderBy("last_seen"))
    silent = times.withColumn("_next", following).withColumn("silent_at", F.col("last_seen") + limit)
    late = F.col("_next").isNull() | (F.col("_next") > F.col("silent_at"))
    return silent.filter(late & (F.col("silent_at") <= newest)).drop("_next")
