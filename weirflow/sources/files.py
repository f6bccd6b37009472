"""Delimited files and the stored telemetry table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.operators.timeseries import TIME
from weirflow.schema import MEASUREMENT
from weirflow.sinks.tables import INDEX


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """Text columns named by the header, with blanks around the names removed.

    Only the header is read ahead; types come later, from the record schema.
    """
    table = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return table.toDF(*(c.strip() for c in table.columns))


def files_holding(
    spark: SparkSession, path: str, start: Column | None = None, stop: Column | None = None, alerts: list[str] | None = None
) -> list[str]:
    """Files of a stored table with rows of the range and alert types, by its index; no other file is opened."""
    index = spark.read.parquet(f"{path}/{INDEX}")
    if start is not None:
        index = index.filter(F.col("newest") >= start)
    if stop is not None:
        index = index.filter(F.col("oldest") < stop)
    if alerts is not None:
        index = index.filter(F.arrays_overlap("alerts", F.lit(alerts)))
    return [r["file"] for r in index.select("file").collect()]


def scan(
    spark: SparkSession, path: str, measurement: str, start: Column | None = None, stop: Column | None = None,
    alerts: list[str] | None = None, time: str = TIME,
) -> DataFrame:
    """``from > range > filter(measurement)`` over a stored table, start included, stop excluded.

    The index picks the files; inside them the bounds on time and alert type are pushed to the scan, which skips row groups.
    """
    files = files_holding(spark, path, start, stop, alerts) if measurement == MEASUREMENT else []
    if not files:
        return spark.read.parquet(path).filter(F.lit(False))
    found = spark.read.option("basePath", path).parquet(*files)
    if start is not None:
        found = found.filter(F.col(time) >= start)
    if stop is not None:
        found = found.filter(F.col(time) < stop)
    return found if alerts is None else found.filter(F.col("alert_type").isin(alerts))
