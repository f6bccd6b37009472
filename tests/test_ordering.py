import random

import numpy as np
import pandas as pd
import pytest

from weirflow.operators import ordering as O
from weirflow.operators.metrics import class_weights, classification_report, label_share
from weirflow.operators.sampling import stratified_split


@pytest.fixture(scope="module")
def series():
    """Shuffled rows, two thirds of them at one single time."""
    rng = random.Random(7)
    rows = [(i, 5 if i % 3 else rng.randrange(10), rng.choice([None, rng.random()])) for i in range(500)]
    rng.shuffle(rows)
    return rows


def pandas_order(series):
    return pd.DataFrame(series, columns=["id", "t", "x"]).sort_values(["t", "id"]).reset_index(drop=True)


def test_positions_are_dense_and_in_order(spark, series):
    df = spark.createDataFrame(series, "id long, t long, x double").repartition(6)
    got = O.sequence(df, ["t", "id"]).toPandas().sort_values(O.POSITION)
    assert list(got[O.POSITION]) == list(range(500))
    assert list(got["id"]) == list(pandas_order(series)["id"])


def test_hot_time_is_split_over_blocks(spark, series, monkeypatch, tmp_path):
    monkeypatch.setattr(O, "scratch_path", lambda *_: str(tmp_path / "blocks"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        O.sequence(spark.createDataFrame(series, "id long, t long, x double"), ["t", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = spark.read.parquet(str(tmp_path / "blocks")).filter("t = 5")
    assert stored.selectExpr("shiftright(_row, 33)").distinct().count() > 3


@pytest.mark.parametrize("blocks", [1, 2, 7, 40])
def test_blocks_hold_the_order(spark, series, blocks):
    df = spark.createDataFrame(series, "id long, t long, x double").repartition(5)
    got = O.ordered_blocks(df, ["t", "id"], blocks).toPandas().sort_values(O.POSITION)
    assert list(got[O.POSITION]) == list(range(500))
    assert list(got["id"]) == list(pandas_order(series)["id"])
    sizes = got.groupby(O.BLOCK).size()
    assert (got[O.SIZE] == got[O.BLOCK].map(sizes)).all() and got[O.BLOCK].is_monotonic_increasing
    if blocks > 2:  # two thirds of the rows have one time
        assert sizes.max() < 500 / blocks * 3 and got[got["t"] == 5][O.BLOCK].nunique() > blocks / 2


def test_blocks_of_nulls_few_rows_and_none(spark):
    rows = [(1, None, 1.0), (2, None, 2.0), (3, 4, None)]
    got = O.ordered_blocks(spark.createDataFrame(rows, "id long, t long, x double"), ["t", "id"], 16).collect()
    assert sorted((r[O.POSITION], r["id"]) for r in got) == [(0, 1), (1, 2), (2, 3)]
    empty = spark.createDataFrame([], "id long, t long, x double")
    assert O.ordered_blocks(empty, ["t", "id"], 4).collect() == []
    assert O.feature_diff(empty, ["x"], ["t", "id"]).collect() == []


@pytest.mark.parametrize("blocks,rows", [(1, 5), (6, 5), (60, 30), (200, 30)])
def test_diff_and_rolling_mean_across_blocks(spark, series, blocks, rows):
    """Also with blocks far shorter than the look-back."""
    df = spark.createDataFrame(series, "id long, t long, x double")
    want = pandas_order(series)
    want["d"] = want["x"].diff()
    want["m"] = want["x"].rolling(rows, min_periods=1).mean()
    diff = O.feature_diff(df, ["x"], ["t", "id"], blocks).toPandas().sort_values(["t", "id"])
    mean = O.feature_rolling_mean(df, ["x"], ["t", "id"], rows, blocks).toPandas().sort_values(["t", "id"])
    np.testing.assert_allclose(diff["x_diff"].to_numpy(), want["d"].to_numpy(), atol=1e-12)
    np.testing.assert_allclose(mean["x_mean"].to_numpy(), want["m"].to_numpy(), atol=1e-12)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, 2.0), (2, float("nan")), (3, 4.0), (4, 6.0)], "id long, x double")
    diff = {r["id"]: r["x_diff"] for r in O.feature_diff(df, ["x"], ["id"]).collect()}
    mean = {r["id"]: r["x_mean"] for r in O.feature_rolling_mean(df, ["x"], ["id"], 3).collect()}
    assert diff == {1: None, 2: None, 3: None, 4: 2.0} and mean == {1: 2.0, 2: 2.0, 3: 3.0, 4: 5.0}


def test_whole_rows_are_shuffled_once(spark, series, tmp_path):
    """Beside the one exchange of all rows, only rows at the edges of blocks travel."""
    spark.createDataFrame(series, "id long, t long, x double").repartition(4).write.parquet(str(tmp_path / "t"))
    df = O.feature_rolling_mean(spark.read.parquet(str(tmp_path / "t")), ["x"], ["t", "id"], 5)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan")[0]
    assert final.count("+- Exchange shufflepartitionidpassthrough") == 1 and "- ReusedExchange" in final


def walked(rows, begin, low, high, length):
    out = []
    for k, (_, step) in enumerate(rows):
        x = begin if k % length == 0 else out[-1]
        out.append(min(high, max(low, x + step)))
    return out


@pytest.mark.parametrize("blocks,length", [(1, 60), (9, 500), (9, 7), (40, 33)])
def test_walks_across_blocks(spark, blocks, length):
    """Steps of either sign, runs longer and shorter than a block, against one step after the other."""
    rng = random.Random(length)
    rows = [(k, rng.randint(-9, 10)) for k in range(500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        placed = O.ordered_blocks(spark.createDataFrame(rows, "id long, step long").repartition(3), ["id"], blocks)
        begin = O.F.when(O.F.col(O.POSITION) % length == 0, O.F.lit(3))
        walks = {
            "near": O.Walk(O.F.col("step"), begin, O.F.lit(-20), O.F.lit(15)),
            "free": O.Walk(-O.F.col("step"), begin, O.F.lit(-O.FAR), O.F.lit(O.FAR)),
        }
        got = O.clamped_walks(placed, walks).orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r["near"] for r in got] == walked(rows, 3, -20, 15, length)
    assert [r["free"] for r in got] == walked([(k, -s) for k, s in rows], 3, -O.FAR, O.FAR, length)


def test_steps_compose(spark):
    rng = np.random.default_rng(2)
    steps = np.stack([rng.integers(-9, 10, 200), rng.integers(-30, 0, 200), rng.integers(1, 30, 200)])
    done = O._composed(steps)
    for x in (-50, 0, 7, 50):
        now = x
        for k in range(200):
            now = min(steps[2, k], max(steps[1, k], now + steps[0, k]))
            assert now == min(done[2, k], max(done[1, k], x + done[0, k]))


@pytest.mark.parametrize("buckets", [1, 16, 65_536])
def test_split_has_exact_class_sizes(spark, buckets):
    """The published split: 8,603 / 2,868 of 11,471 rows with 128 held-out attacks."""
    rows = spark.range(11_471).selectExpr("id", "cast(id < 510 as int) as ATT_FLAG")
    split = stratified_split(rows, "id", buckets=buckets).groupBy("split", "ATT_FLAG").count().collect()
    sizes = {(r["split"], r["ATT_FLAG"]): r["count"] for r in split}
    assert sizes == {
        ("train", 0): 8221, ("train", 1): 382, ("validation", 0): 2740, ("validation", 1): 128,
    }


def test_split_does_not_depend_on_buckets_or_partitions(spark):
    rows = spark.range(2_000).selectExpr("id", "cast(id % 7 = 0 as int) as ATT_FLAG")
    one = stratified_split(rows, "id", buckets=1).toPandas().sort_values("id")
    other = stratified_split(rows.repartition(5), "id", buckets=997).toPandas().sort_values("id")
    assert list(one["split"]) == list(other["split"])


def test_report_of_the_published_confusion_matrix(spark):
    rows = [(0, 0)] * 2740 + [(1, 0)] * 34 + [(1, 1)] * 94
    df = spark.createDataFrame(rows, "ATT_FLAG int, p int")
    got = {r["class"]: r for r in classification_report(df, "ATT_FLAG", "p", decimals=2).collect()}
    assert tuple(got["Attack"])[1:] == (1.0, 0.73, 0.85, 128)
    assert tuple(got["Normal"])[1:] == (0.99, 1.0, 0.99, 2740)
    assert got["accuracy"]["f1"] == 0.99 and tuple(got["macro avg"])[1:4] == (0.99, 0.87, 0.92)


def test_report_with_nothing_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "ATT_FLAG int, p int")
    got = {r["class"]: r for r in classification_report(df, "ATT_FLAG", "p").collect()}
    assert tuple(got["Attack"])[1:] == (0.0, 0.0, 0.0, 1)


def test_weights_and_shares(spark):
    df = spark.range(2_710).selectExpr("cast(id < 510 as int) as ATT_FLAG")
    weights = {r["ATT_FLAG"]: r["weight"] for r in class_weights(df).collect()}
    assert weights[1] == pytest.approx(2710 / (2 * 510)) and weights[0] == pytest.approx(2710 / (2 * 2200))
    share = label_share(df).first()
    assert (share["normal_percent"], share["attack_percent"]) == (81.2, 18.8)
