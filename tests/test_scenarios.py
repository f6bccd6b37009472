import pytest
from pyspark.sql import functions as F

from weirflow.operators import scenarios as S
from weirflow.plans import catalog
from weirflow.schema import NORMAL, PRESSURES


@pytest.fixture(scope="module")
def mix(spark, sf_dir):
    return S.training_mix(catalog.quiet_base(spark, sf_dir), catalog.ORDER).toPandas()


def test_rounds_have_the_published_composition():
    assert S.ATTACK_RUN == 510 and S.NORMAL_RUN == 2200
    assert [s.length for s in S.SCENARIOS] == [60, 60, 70, 60, 70, 60, 60, 70]


def test_base_rows_stay_and_keys_are_sequential(mix):
    normal = mix[mix["scenario"] == NORMAL]
    assert len(mix) == len(normal) + 510 and mix["key"].is_unique
    assert set(mix["key"]) == {f"SYN/{i:04d}" for i in range(len(mix))}
    assert (normal["ATT_FLAG"] == 0).all() and mix["ATT_FLAG"].sum() == 510


def test_drifts_only_move_one_way_and_stop_at_the_limit(mix):
    rising = mix[mix["scenario"] == "A1_PU1_STUCK_ON"].sort_values("key")["L_T1"]
    assert len(rising) == 60 and rising.is_monotonic_increasing and rising.max() == pytest.approx(6.5)
    falling = mix[mix["scenario"] == "A4_V2_VALVE_ATTACK"].sort_values("key")["L_T2"]
    assert falling.is_monotonic_decreasing and falling.min() >= 0.1 - 1e-6 and falling.iloc[0] < 4.5


def test_forced_columns(mix):
    ghost = mix[mix["scenario"] == "A6_FLOW_INJECTION"]
    assert (ghost["S_PU3"] == 0).all() and (ghost["F_PU3"] >= 50).all()
    spoof = mix[mix["scenario"] == "A3_SENSOR_SPOOF_T4"]
    assert spoof["L_T4"].between(2.0, 3.0).all() and (spoof["S_PU6"] == 1).all() and (spoof["F_PU6"] >= 45).all()
    collapse = mix[mix["scenario"] == "A7_PRESSURE_COLLAPSE"]
    assert (collapse[PRESSURES] <= 3.0).all().all() and (collapse[PRESSURES] >= 0).all().all()


def test_rules_catch_what_they_can(spark, sf_dir):
    got = {r["scenario"]: r["share"] for r in catalog.queries()["scenario_rule_coverage"](spark, sf_dir).collect()}
    for name in ("A1_PU1_STUCK_ON", "A2_PU4_PU5_STUCK_OFF", "A5_T5_CASCADE"):
        assert got[name] == 1.0
    for name in ("A6_FLOW_INJECTION", "A7_PRESSURE_COLLAPSE"):
        assert got[name] == 0.0


def test_runs_restart_the_drift(spark, sf_dir):
    df = S.level_drift(catalog.quiet_base(spark, sf_dir), S.SCENARIOS[0], "L_T1", catalog.ORDER)
    starts = df.groupBy("run").agg(F.min("level").alias("first")).collect()
    assert len(starts) > 5 and all(6.4 < r["first"] < 6.46 for r in starts)


def test_a_round_must_hold_every_scenario(spark, sf_dir):
    with pytest.raises(ValueError):
        S.training_mix(catalog.quiet_base(spark, sf_dir), catalog.ORDER, normal_run=100)


def test_counts_follow_from_the_number_of_records(spark, sf_dir, mix):
    counts = {r["scenario"]: r["n"] for r in S.scenario_counts(catalog.quiet_base(spark, sf_dir)).collect()}
    assert counts == mix["scenario"].value_counts().to_dict()
    for n in (0, 1, 59, 60, 61, 509, 510, 2199, 2200, 2261, 5000):
        got = {r["scenario"]: r["n"] for r in S.scenario_counts(spark.range(n)).collect()}
        want = {NORMAL: n} if n else {}
        for k in range(n):
            for start, stop, s in S._spans():
                if start <= k % 2200 < stop:
                    want[s.name] = want.get(s.name, 0) + 1
        assert got == want


def test_runs_that_cross_blocks(spark, sf_dir, mix):
    """Any number of blocks gives the same mix."""
    more = S.training_mix(catalog.quiet_base(spark, sf_dir), catalog.ORDER, blocks=37).toPandas()
    a, b = (m.sort_values("key").reset_index(drop=True) for m in (mix, more))
    assert a.equals(b[a.columns])


def test_the_wandering_level_turns_at_both_ends(spark, sf_dir):
    level = S.level_drift(catalog.quiet_base(spark, sf_dir), S.WANDERING, "L_T1", catalog.ORDER, blocks=11)
    got = level.orderBy(*catalog.ORDER).toPandas()["level"].astype(float)
    assert got.min() == pytest.approx(4.6) and got.max() == pytest.approx(5.4)
    assert (got.diff() > 1e-6).any() and (got.diff() < -1e-6).any()


def test_units_of_drifts():
    assert S.drift_units(S.Drift(6.4, 0.03, 0.01, high=6.5)) == (64000, 100, 401, None, 65000)
    assert S.drift_units(S.Drift(2.8, -0.04, 0.01, low=0.2)) == (28000, -600, 401, 2000, None)
    assert S.drift_units(S.Drift(6.3, 0.02, 0.01, high=6.5)).least == 0
    assert S.drift_units(S.WANDERING.forced["L_T1"]) == (50000, -800, 2001, 46000, 54000)
