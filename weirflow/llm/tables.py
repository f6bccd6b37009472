"""Input columns of the operators and small column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The whole text; a null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).alias(column)


def lower_ascii(column: str = "text") -> Column:
    """A-Z lower-cased, everything else unchanged."""
    return F.translate(F.coalesce(F.col(column), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
