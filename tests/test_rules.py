import math

import pytest

from tests.rows import frame, record
from weirflow.operators import classify as C
from weirflow.schema import NORMAL, RULES


def flags(spark, *records):
    return C.flag(frame(spark, *records)).collect()


def expected(r, on):
    """Label of a rule on its own row, given that earlier rules of the same tank may win."""
    return r.stuck_on if on else r.stuck_off


def test_quiet_row_is_normal(spark):
    (row,) = flags(spark, record())
    assert row["alert_type"] == NORMAL and row["ml_alert"] == 0
    assert {row[r.display] for r in RULES} == {0}


@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.actuator)
def test_each_rule_fires_and_colours_its_actuator(spark, rule):
    earlier = {r.status: None for r in RULES if r.priority < rule.priority}
    on = record(**earlier, **{rule.status: 1, rule.level: rule.high + 0.5})
    off = record(**earlier, **{rule.status: 0, rule.level: rule.low - 0.25})
    got = flags(spark, on, off)
    assert [g["alert_type"] for g in got] == [expected(rule, True), expected(rule, False)]
    assert [g[rule.display] for g in got] == [2, 2]


@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.actuator)
def test_thresholds_themselves(spark, rule):
    """Levels are float32: only 6.3, 5.3 and 4.8 lie above their own double threshold."""
    earlier = {r.status: None for r in RULES if r.actuator != rule.actuator}
    high = record(**earlier, **{rule.status: 1, rule.level: rule.high})
    low = record(**earlier, **{rule.status: 0, rule.level: rule.low})
    got = flags(spark, high, low)
    assert (got[0]["alert_type"] == rule.stuck_on) == (rule.high in (6.3, 5.3, 4.8))
    assert got[1]["alert_type"] == NORMAL


def test_first_rule_wins_but_display_is_independent(spark):
    (row,) = flags(spark, record(S_PU1=1, S_PU2=1, L_T1=6.4, S_PU4=1, L_T3=5.4))
    assert row["alert_type"] == "PU1_STUCK_ON"
    assert (row["disp_PU1"], row["disp_PU2"], row["disp_PU4"], row["disp_V2"]) == (2, 2, 2, 0)


def test_hidden_rule_surfaces_when_the_earlier_actuator_runs(spark):
    hidden, shown = flags(spark, record(L_T1=0.9), record(L_T1=0.9, S_PU1=1))
    assert hidden["alert_type"] == "PU1_STUCK_OFF"
    assert shown["alert_type"] == "PU2_STUCK_OFF"


def test_unknown_status_falls_through(spark):
    (row,) = flags(spark, record(S_PU1=None, L_T1=3.5))
    assert row["alert_type"] == NORMAL and row["disp_PU1"] is None


def test_records_without_a_level_are_removed(spark):
    got = flags(spark, record(L_T6=None), record(L_T2=math.nan), record())
    assert len(got) == 1


def test_unruled_pumps_never_alert(spark):
    (row,) = flags(spark, record(S_PU3=1, S_PU9=1, L_T6=0.0))
    assert row["alert_type"] == NORMAL


def test_all_violations_are_listed(spark):
    df = frame(spark, record(S_PU1=1, S_PU2=1, L_T1=6.4))
    got = {(r["actuator"], r["kind"]) for r in C.rule_violations(df, ["timestamp"]).collect()}
    assert got == {("PU1", "STUCK_ON"), ("PU2", "STUCK_ON")}


def test_bands_start_at_their_step(spark):
    df = frame(spark, record(L_T1=0.99), record(L_T1=1.0), record(L_T1=4.0), record(L_T1=6.4))
    got = [r["band"] for r in C.tank_bands(df, ["timestamp"]).filter("tank = 'L_T1'").orderBy("level").collect()]
    assert got == ["red_low", "dark_blue", "light_blue", "red_high"]


def test_gold_keeps_rule_and_model_alerts(spark):
    from pyspark.sql import functions as F

    df = C.flag(frame(spark, record(), record(L_T1=3.5), record(ATT_FLAG=1)))
    df = df.withColumn("ml_alert", F.col("ATT_FLAG"))
    assert sorted(r["alert_type"] for r in C.gold(df).collect()) == [NORMAL, "PU1_STUCK_OFF"]
