"""Executor-side writers; every one of them can be repeated without leaving duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.operators.payloads import export_view, to_messages, to_payload
from weirflow.operators.timeseries import TIME, lines


#: Folder of a stored table with what each of its files holds; hidden from readers of the table itself.
INDEX = "_index"


def write_store(flagged: DataFrame, path: str, time: str = TIME, key: str = "event_id") -> None:
    """Telemetry table: one folder per event date, rows in order of time, and an index of its files.

    The unique key ends the range key, so a busy date or a single busy time is spread over several tasks and files.
    Sorted files have narrow times per row group; a Bloom filter tells row groups without an alert type. The index, written last,
    says which times and alert types each file holds.
    """
    order = ["date", time, key]
    (
        flagged.withColumn("date", F.to_date(time))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#alert_type", "true")
        .option("parquet.bloom.filter.expected.ndv#alert_type", "64")
        .partitionBy("date")
        .parquet(path)
    )
    files = flagged.sparkSession.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), time, "alert_type")
    files.groupBy("file").agg(
        F.min(time).alias("oldest"), F.max(time).alias("newest"), F.collect_set("alert_type").alias("alerts"), F.count("*").alias("n")
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/{INDEX}")


def write_messages(df: DataFrame, path: str) -> None:
    to_messages(to_payload(df, []), []).write.mode("overwrite").text(path)


def write_messages_to_topic(df: DataFrame, broker: str, topic: str) -> None:
    """Same messages to a broker; needs the Kafka connector on the class path."""
    (
        to_messages(to_payload(df, []), [])
        .write.format("kafka")
        .option("kafka.bootstrap.servers", broker)
        .option("topic", topic)
        .save()
    )


def write_points(flagged: DataFrame, path: str, time: str = TIME) -> None:
    lines(flagged, ()).write.mode("overwrite").text(path)


def write_delimited(df: DataFrame, path: str) -> None:
    export_view(df, []).write.mode("overwrite").option("header", True).csv(path)


def write_raw_delimited(raw: DataFrame, path: str) -> None:
    """Text columns exactly as they are, blanks included."""
    (
        raw.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
