import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from weirflow.operators import learning as L
from weirflow.operators import scenarios as S
from weirflow.plans import catalog
from weirflow.schema import FEATURES, LABEL
from weirflow.session import scratch_path
from weirflow.sources import streams
from weirflow.streaming import pipeline


@pytest.fixture(scope="module")
def mix(spark, sf_dir):
    path = scratch_path(spark, "mix")
    S.training_mix(catalog.quiet_base(spark, sf_dir), catalog.ORDER).selectExpr(
        "*", "cast(substring(key, 5) as long) as number"
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def evaluated(mix):
    return L.evaluate(mix, "number", trees=20, depth=8)


def test_hold_out_quality(evaluated):
    report = {r["class"]: r for r in evaluated["report"].collect()}
    assert report["Attack"]["support"] in (127, 128)
    assert report["Attack"]["recall"] > 0.6 and report["accuracy"]["f1"] > 0.75
    m = evaluated["confusion"].first()
    assert m["tn"] + m["fp"] + m["fn"] + m["tp"] == evaluated["predictions"].count()


def test_importances_are_sorted(evaluated):
    rows = evaluated["importances"].collect()
    values = [r["importance"] for r in rows]
    assert len(rows) == 10 and values == sorted(values, reverse=True)
    assert {r["feature"] for r in rows} <= set(FEATURES)


def streamed_alerts(spark, root):
    rows = pipeline.read_layer(spark, root, "silver").groupBy("ml_alert").count().collect()
    return {r["ml_alert"]: r["count"] for r in rows}


def test_published_model_scores_batch_and_stream_alike(spark, sf_dir, mix):
    path = scratch_path(spark, "model")
    assert L.newest_model(spark, path) is None and L.newest_model(spark, None) is None
    assert L.publish(spark, L.train(mix, trees=5, depth=4), path) == 1
    model = L.newest_model(spark, path)
    messages = catalog.message_files(spark, sf_dir)
    root = scratch_path(spark, "tables")
    source = streams.read_text_messages(spark, messages)
    pipeline.start(source, root, scratch_path(spark, "checkpoint"), model, once=True).awaitTermination(240)
    batch = pipeline.replay(streams.replay_text_messages(spark, messages), model)
    counts = {r["ml_alert"]: r["count"] for r in batch.groupBy("ml_alert").count().collect()}
    assert streamed_alerts(spark, root) == counts and set(counts) == {0, 1}


def test_a_new_version_takes_effect_without_a_restart(spark, sf_dir, mix):
    """Each batch asks for the newest model; half a model is never seen."""
    path, root = scratch_path(spark, "model"), scratch_path(spark, "tables")
    write = pipeline.table_writer(root, "run-a", lambda session: L.newest_model(session, path))
    batch = streams.replay_text_messages(spark, catalog.message_files(spark, sf_dir))
    write(batch, 0)
    assert set(streamed_alerts(spark, root)) == {0}
    model = L.train(mix, trees=5, depth=4)
    # A version as far as its data, without its pointer.
    model.write().save(f"{path}/versions/1-lost/model")
    assert L.newest_version(spark, path) is None and L.newest_model(spark, path) is None
    assert L.publish(spark, model, path) == 1
    write(batch, 1)
    assert set(streamed_alerts(spark, root)) == {0, 1}
    always = L.train(mix.withColumn(LABEL, (mix["number"] % 50 != 0).cast("int")), trees=2, depth=2)
    assert L.publish(spark, always, path) == 2
    assert L.load(spark, path, 1).stages[-1].getNumTrees == 5 and L.newest_model(spark, path).stages[-1].getNumTrees == 2


def test_a_model_of_other_features_is_refused(spark, mix, monkeypatch):
    path = scratch_path(spark, "model")
    L.publish(spark, L.train(mix, trees=1, depth=1), path)
    monkeypatch.setattr(L, "FEATURES", FEATURES[::-1])
    with pytest.raises(ValueError, match="other features"):
        L.newest_model(spark, path)


@pytest.mark.parametrize("limit", [L.BROADCAST_BYTES, 0])
def test_python_models_score_in_batches(spark, sf_dir, limit):
    """The same result from a broadcast and from a file per executor; NaN and null read as 0."""
    table = catalog.telemetry(spark, sf_dir)
    model = L.LinearModel(catalog.LINEAR_WEIGHTS, catalog.LINEAR_THRESHOLD)
    got = {r["event_id"]: r["ml_alert"] for r in L.score_with(table, model, limit).select("event_id", "ml_alert").collect()}
    plain = L.feature_table(table, ["event_id"]).toPandas().set_index("event_id")[FEATURES]
    want = (plain.to_numpy() @ model.weights > model.threshold).astype(int)
    assert got == dict(zip(plain.index, want)) and set(got.values()) == {0, 1}
    odd = spark.createDataFrame([(1, float("nan")), (2, None)], "event_id long, L_T1 float")
    wide = odd.selectExpr("*", *(f"cast(0 as float) as {f}" for f in FEATURES[1:]), "5 as ml_alert")
    assert {r["ml_alert"] for r in L.score_with(wide, L.LinearModel([1.0] + [0.0] * 30, -1.0), limit).collect()} == {1}


def test_rows_for_a_fit_are_bounded(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "event_id")
    assert L.at_most(rows, "event_id", None).count() == L.at_most(rows, "event_id", 30_000).count() == 20_000
    assert 800 < L.at_most(rows, "event_id", 1_000).count() < 1_200


def test_query_results_hold_predictions_and_weights(spark, sf_dir):
    judged = catalog.queries()["ml_predict"](spark, sf_dir).toPandas()
    assert set(judged["ml_alert"]) == {0, 1} and judged["number"].is_unique
    attack = judged[judged["ATT_FLAG"] == 1]
    # Half of this small mix are attacks.
    assert (attack["ml_alert"] == 1).mean() > 0.55 and (judged["ml_alert"] == judged["ATT_FLAG"]).mean() > 0.7
    both = catalog.queries()["rule_vs_model"](spark, sf_dir).toPandas()
    assert both["n"].sum() == len(judged) and set(both["ml_alert"]) == {0, 1}
    top = catalog.queries()["ml_feature_importances"](spark, sf_dir).collect()
    weights = [r["importance"] for r in top]
    assert len(top) == 10 and weights == sorted(weights, reverse=True) and 0 < sum(weights) <= 1.000001
    assert {r["feature"] for r in top} & {"L_T1", "L_T3", "L_T7", "F_PU10", "F_PU1", "F_PU2"}


def test_scoring_stays_in_the_jvm(mix):
    plan = L.predict(mix, L.train(mix, trees=2, depth=2))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_without_model_the_flag_is_zero(mix):
    assert {r["ml_alert"] for r in L.score(mix.select(LABEL)).distinct().collect()} == {0}


def test_the_training_job_reports_saves_and_scores(spark, mix):
    path = scratch_path(spark, "model")
    results = L.train_job(mix, "number", path, trees=5, depth=4)
    assert results["report"].count() > 0
    scored = L.predict(mix.withColumn("alert_type", mix["scenario"]), L.load(spark, path, 1))
    table = L.rule_versus_model(scored).collect()
    assert sum(r["n"] for r in table) == mix.count() and {r["ml_alert"] for r in table} <= {0, 1}


def test_a_model_fitted_after_rows_were_observed_scores(spark):
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = spark.range(40).selectExpr(*(f"cast(id % 2 as float) as {f}" for f in FEATURES), f"cast(id % 2 as int) as {LABEL}")
    model = L.train(rows, trees=2, depth=2)
    assert not model.stages[-1].hasSummary
    assert rows.count() == L.predict(rows, model).filter(f"{L.ALERT} = {LABEL}").count()
