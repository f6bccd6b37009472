"""Small constant tables used as join sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def constant_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal table; how it is joined is decided by its size."""
    return spark.createDataFrame(rows, schema)
