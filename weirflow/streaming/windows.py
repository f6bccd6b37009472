"""Windowed means on the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirflow.streaming.pipeline import EVENT_TIME


def windowed_mean(flagged: DataFrame, field: str, every: str, delay: str) -> DataFrame:
    """Event-time tumbling mean per series; a window is final once the watermark passes its end."""
    return (
        flagged.withWatermark(EVENT_TIME, delay)
        .groupBy(F.window(EVENT_TIME, every).alias("w"), "alert_type")
        .agg(F.avg(F.col(field).cast("double")).alias("value"), F.count(field).alias("n"))
        .select(F.col("w.end").alias("_time"), "alert_type", "value", "n")
    )


def start_append(result: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Appends closed windows; the file sink's log makes a restart exactly-once."""
    writer = (
        result.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
