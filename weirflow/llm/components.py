"""Connected components of links, by alternating large and small stars.

Every round is two shuffles over the links left and is written to the shared folder, which
cuts the lineage. Stars only grow towards smaller nodes; the number of rounds grows with the logarithm
of the longest path. Nothing but one number per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.session import scratch_path


def _stored(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "links")
    df.write.parquet(path)
    return spark.read.parquet(path)


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lows = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(lows, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them. Links are (larger, smaller)."""
    lows = links.groupBy("a").agg(F.min("b").alias("low"))
    kept = links.join(lows, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return kept.union(lows.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``) but the roots; a root is its smallest node."""
    directed = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, before = _stored(directed), None
    while True:
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before or state["n"] == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        current = _stored(_small_star(_large_star(current)))
