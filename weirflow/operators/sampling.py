"""Exact stratified split without ordering a whole class in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weirflow.schema import LABEL

# A multiplicative hash on whole numbers, the same in any SQL engine.
MODULUS = 2_147_483_647
MULTIPLIER = 1_103_515_245
BUCKETS = 65_536
CLASSES = (0, 1)


def scatter(key: str, seed: int) -> Column:
    return ((F.col(key) % MODULUS) * MULTIPLIER + 12_345 * seed) % MODULUS


def class_quota(counts: DataFrame, label: str, held_out_quarters: int) -> DataFrame:
    """Training rows per class: proportional, whole, summing to the exact total.

    The held-out part is rounded up over all rows; left-over rows go to the classes
    with the largest remainders. Wide decimals keep the products exact.
    """
    exact = "decimal(19,0)"
    everything = W.partitionBy(F.lit(1))
    total = F.sum("n").over(everything)
    n_train = total - F.ceil(total * held_out_quarters / 4)
    shares = counts.select(label, F.col("n"), total.alias("total"), n_train.cast("long").alias("n_train"))
    product = F.col("n_train").cast(exact) * F.col("n").cast(exact)
    shares = shares.select(
        label, "n", "n_train", "total", (product % F.col("total").cast(exact)).alias("rest"), product.alias("product")
    )
    floor = ((F.col("product") - F.col("rest")) / F.col("total").cast(exact)).cast("long")
    shares = shares.select(label, "n", "n_train", "rest", floor.alias("floor"))
    missing = F.col("n_train") - F.sum("floor").over(everything)
    by_rest = F.row_number().over(everything.orderBy(F.desc("rest"), F.col(label)))
    return shares.select(
        label, (F.col("floor") + F.when(by_rest <= missing, 1).otherwise(0)).alias("quota")
    )


def stratified_split(
    df: DataFrame, key: str, seed: int = 42, label: str = LABEL, held_out_quarters: int = 1,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Adds ``split`` (train / validation) with exact class shares.

    Rows are ranked by a hash inside their class. A histogram of hash buckets shows
    in which bucket the quota falls; only the rows of that one bucket per class are
    ever sorted, every other row is decided where it is.
    """
    width = -(-MODULUS // buckets)
    hashed = df.filter(F.col(label).isin(*CLASSES)).withColumn("_hash", scatter(key, seed))
    bucket = F.floor(F.col("_hash") / width)
    histogram = (
        hashed.select(label, bucket.alias("_bucket")).groupBy(label, "_bucket").agg(F.count("*").alias("n"))
    )
    quota = class_quota(histogram.groupBy(label).agg(F.sum("n").alias("n")), label, held_out_quarters)
    running = W.partitionBy(label).orderBy("_bucket")
    cumulated = histogram.select(label, "_bucket", "n", F.sum("n").over(running).alias("_upto"))
    # The first bucket whose running count reaches the quota: two rows, one per class.
    cut = (
        cumulated.join(F.broadcast(quota), label)
        .filter((F.col("_upto") >= F.col("quota")) & (F.col("_upto") - F.col("n") < F.col("quota")))
        .select(label, F.col("_bucket").alias("_cut"), (F.col("quota") - (F.col("_upto") - F.col("n"))).alias("_room"))
    )
    # A class without any training row has no cut: its rows are all held out.
    marked = hashed.withColumn("_bucket", bucket).join(F.broadcast(cut), label, "left")
    inside = F.col("_bucket") == F.col("_cut")
    settled = marked.filter(~F.coalesce(inside, F.lit(False))).withColumn(
        "split", F.when(F.col("_bucket") < F.col("_cut"), "train").otherwise("validation")
    )
    rank = F.row_number().over(W.partitionBy(label).orderBy("_hash", key))
    contested = (
        marked.filter(inside)
        .withColumn("_rank", rank)
        .withColumn("split", F.when(F.col("_rank") <= F.col("_room"), "train").otherwise("validation"))
        .drop("_rank")
    )
    return settled.unionByName(contested).drop("_hash", "_bucket", "_cut", "_room")
