"""Forest training, evaluation, storage and scoring with Spark ML, and scoring with other Python models."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from pathlib import Path
from tempfile import mkdtemp
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, SparkFiles, StorageLevel
from pyspark.cloudpickle import dumps
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.parsing import filled
from weirflow.operators.metrics import class_weights, classification_report, confusion_matrix
from weirflow.operators.sampling import stratified_split
from weirflow.schema import FEATURES, LABEL
from weirflow.session import scratch_path

ALERT = "ml_alert"
_INPUT = {f: f"x_{f}" for f in FEATURES}
_HASH_RANGE = 1 << 30


def filled_features(df: DataFrame) -> DataFrame:
    """The model's inputs next to the record: fixed order, absent readings as 0."""
    return df.select("*", *(filled(f).alias(x) for f, x in _INPUT.items()))


def feature_table(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *(filled(f) for f in FEATURES))


def weighted(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight per row; the weight table has one row per class (two)."""
    weights = class_weights(df, label).select(label, "weight")
    return df.join(F.broadcast(weights), label)


def forest(trees: int, depth: int, seed: int) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(_INPUT.values()), outputCol="features"),
        RandomForestClassifier(
            labelCol=LABEL, featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth,
            seed=seed, featureSubsetStrategy="sqrt", probabilityCol="probability", predictionCol="prediction",
        ),
    ])


def stored_features(df: DataFrame, keys: list[str]) -> DataFrame:
    """The filled features written once to the shared folder and read back.

    A fit reads its input many times; the table cuts the lineage, is columnar, and is
    still there when an executor with cached blocks is lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "features")
    feature_table(df, keys).write.parquet(path)
    return spark.read.parquet(path)


def train(df: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42) -> PipelineModel:
    """Fits on labelled records."""
    return fit(stored_features(df, [LABEL]), trees, depth, seed)


def fit(stored: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42) -> PipelineModel:
    """Fits on features that are written already; they are also cached, spilling to disk.

    The copy leaves out the training summary: it holds the session, which cannot be sent to tasks once rows were observed.
    """
    rows = weighted(filled_features(stored).select(LABEL, *_INPUT.values()))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return forest(trees, depth, seed).fit(rows).copy()
    finally:
        rows.unpersist()


def predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``ml_alert``; runs inside the JVM on batches and streams alike."""
    scored = model.transform(filled_features(df))
    return scored.select(*df.columns, F.col("prediction").cast("int").alias(ALERT))


def score(df: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Prediction, or the constant 0 when there is no model."""
    return df.withColumn(ALERT, F.lit(0)) if model is None else predict(df, model)


def evaluate(
    df: DataFrame, key: str, trees: int = 100, depth: int = 10, seed: int = 42, fit_rows: int | None = None
) -> dict[str, DataFrame]:
    """Hold-out report, confusion matrix and importances of a model fitted on three quarters."""
    return evaluate_stored(stored_features(df, [key, LABEL]), key, trees, depth, seed, fit_rows)


def at_most(rows: DataFrame, key: str, bound: int | None) -> DataFrame:
    """About ``bound`` rows, chosen by the hash of their key, or all where there are fewer."""
    if bound is None:
        return rows
    share = F.lit(float(_HASH_RANGE)) * bound / rows.agg(F.count("*")).scalar()
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(_HASH_RANGE)) < share)


def evaluate_stored(
    stored: DataFrame, key: str, trees: int = 100, depth: int = 10, seed: int = 42, fit_rows: int | None = None
) -> dict[str, DataFrame]:
    """``fit_rows`` bounds the rows the model is fitted on; all held-out rows are judged."""
    split = stratified_split(stored, key, seed)
    model = fit(at_most(split.filter("split = 'train'"), key, fit_rows), trees, depth, seed)
    judged = predict(split.filter("split = 'validation'"), model)
    return {
        "predictions": judged,
        "report": classification_report(judged, LABEL, ALERT),
        "confusion": confusion_matrix(judged, LABEL, ALERT),
        "importances": importances(stored.sparkSession, model),
    }


def train_job(
    df: DataFrame, key: str, path: str, trees: int = 100, depth: int = 10, seed: int = 42
) -> dict[str, DataFrame]:
    """The whole training: split, fit, report on the held-out part, fit again on all rows, publish. Features are written once."""
    stored = stored_features(df, [key, LABEL])
    results = evaluate_stored(stored, key, trees, depth, seed)
    publish(stored.sparkSession, fit(stored, trees, depth, seed), path)
    return results


def rule_versus_model(df: DataFrame) -> DataFrame:
    """Records by the rules' verdict and the model's, of rows that carry both."""
    return df.groupBy("alert_type", ALERT).agg(F.count("*").alias("n"))


def importances(spark: SparkSession, model: PipelineModel, k: int = 10) -> DataFrame:
    """The ``k`` most telling features of the fitted forest."""
    weights = model.stages[-1].featureImportances
    rows = [(f, float(weights[i])) for i, f in enumerate(FEATURES)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    ).limit(k)


# --- versions of a model -------------------------------------------------------------------------


def publish(spark: SparkSession, model: PipelineModel, path: str) -> int:
    """Stores the model and its feature list under a new version; the pointer to it is written last.

    Nothing that a reader may be using is overwritten, and a version without a pointer is no version.
    """
    version = (newest_version(spark, path) or 0) + 1
    folder = f"{path}/versions/{version}-{uuid.uuid4().hex}"  # of two writers at once, one pointer wins
    model.write().save(f"{folder}/model")
    names = spark.createDataFrame(list(enumerate(FEATURES)), "position int, feature string")
    names.coalesce(1).write.json(f"{folder}/features")
    pointer = spark.createDataFrame([(folder,)], "folder string").coalesce(1)
    pointer.write.mode("errorifexists").parquet(f"{path}/published/version={version}")
    return version


def _pointers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("folder string, version int").parquet(f"{path}/published")


def newest_version(spark: SparkSession, path: str) -> int | None:
    try:
        return _pointers(spark, path).agg(F.max("version")).first()[0]
    except AnalysisException:  # nothing published
        return None


@lru_cache(maxsize=4)
def _loaded(folder: str) -> PipelineModel:
    """A version never changes, so it is loaded once."""
    return PipelineModel.load(f"{folder}/model")


def load(spark: SparkSession, path: str, version: int) -> PipelineModel:
    """A published version; one for other features than this library's is refused."""
    folder = _pointers(spark, path).filter(F.col("version") == version).first()["folder"]
    features = [r["feature"] for r in spark.read.json(f"{folder}/features").orderBy("position").collect()]
    if features != FEATURES:
        raise ValueError(f"model {folder} expects other features: {features}")
    return _loaded(folder)


def newest_model(spark: SparkSession, path: str | None) -> PipelineModel | None:
    """The newest published model; None without one, so that scoring falls back to 0 at plan time."""
    version = newest_version(spark, path) if path else None
    return None if version is None else load(spark, path, version)


# --- other Python models -------------------------------------------------------------------------


class Model(Protocol):
    """Anything that predicts a whole matrix at once, one row per record, features in order."""

    def predict(self, features: np.ndarray) -> np.ndarray: ...


#: A larger model is not broadcast but fetched as a file by every executor that scores.
BROADCAST_BYTES = 64 << 20


@lru_cache(maxsize=2)
def _from_file(name: str) -> Model:
    from pickle import loads

    return loads(Path(SparkFiles.get(name)).read_bytes())


def _shared_model(spark: SparkSession, model: Model, limit: int) -> Callable[[], Model]:
    """How a task gets the model: as a broadcast of checked size, or from a file of its executor."""
    packed = dumps(model)
    if len(packed) <= limit:
        return partial(_broadcast_value, spark.sparkContext.broadcast(model))
    # The driver's own copy; Spark serves it to every executor once.
    file = Path(mkdtemp(prefix="run-model-")) / f"model-{uuid.uuid4().hex}"
    file.write_bytes(packed)
    spark.sparkContext.addFile(str(file))
    return partial(_from_file, file.name)


def _broadcast_value(shared: Broadcast) -> Model:
    return shared.value


def _score_map(get: Callable[[], Model], count: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last ``count`` columns are the features; they give way to the prediction."""
    model = get()
    for batch in batches:
        kept, features = batch.columns[:-count], batch.columns[-count:]
        matrix = np.column_stack([c.to_numpy(zero_copy_only=False) for c in features])
        found = np.asarray(model.predict(matrix)).astype(np.int32) if len(batch) else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays([*kept, pa.array(found)], [*batch.schema.names[:-count], ALERT])


def score_with(df: DataFrame, model: Model, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Adds ``ml_alert`` by a Python model, batches of records at a time; absent features read as 0."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != ALERT)
    rows = df.drop(ALERT).select("*", *(filled(f).alias(x) for f, x in _INPUT.items()))
    get = _shared_model(df.sparkSession, model, limit)
    return rows.mapInArrow(partial(_score_map, get, len(_INPUT)), f"{kinds}, {ALERT} int")


class LinearModel:
    """1 where the weighted sum of the features exceeds the threshold."""

    def __init__(self, weights: list[float], threshold: float):
        self.weights, self.threshold = np.array(weights), threshold

    def predict(self, features: np.ndarray) -> np.ndarray:
        return (features @ self.weights > self.threshold).astype(np.int32)
