import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from tests.rows import frame, record
from weirflow.operators import classify as C
from weirflow.operators import timeseries as TS
from weirflow.schema import INT_FIELDS, POINT_FIELDS, SENSORS

BASE = dt.datetime(2024, 1, 1)


def flagged(spark, *rows):
    """(seconds, changes) pairs to classified records with keys and times."""
    df = frame(spark, *(record(**changes) for _, changes in rows)).coalesce(1)
    times = [BASE + dt.timedelta(seconds=s) for s, _ in rows]
    keyed = spark.createDataFrame(
        [(i, t, i * 10) for i, t in enumerate(times)], "event_id long, ts timestamp_ntz, user_id long"
    ).coalesce(1)
    left = df.withColumn("_i", F.monotonically_increasing_id())
    return C.flag(left.join(keyed, left["_i"] == keyed["event_id"]).drop("_i"))


def test_points_skip_missing_fields(spark):
    got = TS.points(flagged(spark, (0, {"L_T6": 3.5, "S_PU2": None}))).collect()
    fields = {r["field"]: r["value"] for r in got}
    assert "S_PU2" not in fields and "disp_PU2" not in fields and fields["L_T6"] == 3.5
    assert len(fields) == len(POINT_FIELDS) - 2
    assert {r["measurement"] for r in got} == {"water_telemetry"}


def test_a_column_the_table_lacks_is_like_null(spark):
    df = flagged(spark, (0, {})).drop("P_J14", "ml_alert")
    assert TS.points(df).filter("field in ('P_J14', 'ml_alert')").count() == 0


def test_line_text(spark):
    (row,) = TS.lines(flagged(spark, (1, {"L_T1": 3.5, "L_T2": 3.25, "S_PU2": None, "ATT_FLAG": 1}))).collect()
    head, body, stamp = row["line"].split(" ")
    assert head == "water_telemetry,alert_type=PU1_STUCK_OFF"
    fields = dict(f.split("=") for f in body.split(","))
    assert fields["L_T1"] == "3.5" and fields["F_PU1"] == "0" and fields["ATT_FLAG"] == "1i"
    assert fields["disp_PU1"] == "2i" and fields["event_time"] == '"2016-09-14T03:00:00Z"'
    assert "S_PU2" not in fields and list(fields) == sorted(fields)
    assert len(fields) == len(SENSORS) + len(INT_FIELDS) + 1 - 2
    assert stamp == str(int((BASE + dt.timedelta(seconds=1)).replace(tzinfo=dt.timezone.utc).timestamp()) * 10**9)


def test_range_ends(spark):
    df = flagged(spark, (0, {}), (10, {}), (20, {}))
    lit = lambda s: F.lit(BASE + dt.timedelta(seconds=s)).cast("timestamp_ntz")
    assert [r["event_id"] for r in TS.between(df, lit(0), lit(20)).orderBy("ts").collect()] == [0, 1]
    assert TS.recent(df, "10 SECOND", TS.newest(df)).count() == 2
    assert TS.recent(df.withColumn("ts", F.current_timestamp()), "1 MINUTE").count() == 3


def test_last_breaks_ties_and_skips_nulls(spark):
    df = flagged(spark, (0, {"F_V2": 1.0}), (5, {"F_V2": 2.0}), (5, {"F_V2": 3.0}), (9, {"F_V2": None}))
    (got,) = TS.last(df, ["F_V2"]).collect()
    assert got["value"] == 3.0 and got["_time"] == BASE + dt.timedelta(seconds=5)


def test_pivot_puts_latest_values_side_by_side(spark):
    df = flagged(spark, (0, {"F_V2": 1.0}), (5, {"F_V2": None, "L_T6": 4.0}))
    got = {r["_time"].second: r for r in TS.pivot_latest(df, ["F_V2", "L_T6"]).collect()}
    assert got[0]["F_V2"] == 1.0 and got[0]["L_T6"] is None and got[5]["L_T6"] == 4.0


def test_windows_are_stamped_with_their_end(spark):
    df = flagged(spark, (0, {"L_T6": 1.0}), (9, {"L_T6": 3.0}), (10, {"L_T6": 5.0}), (25, {"L_T6": None}))
    df = df.unionByName(flagged(spark, (40, {"L_T6": 7.0})))
    stop = F.lit(BASE + dt.timedelta(seconds=45)).cast("timestamp_ntz")
    got = TS.aggregate_window(df, ["L_T6"], "10 seconds", F.avg, stop).orderBy("_time").collect()
    assert [(r["_time"].second, r["value"]) for r in got] == [(10, 2.0), (20, 5.0), (45, 7.0)]


def test_first_n_multiplies_only_what_stays(spark):
    df = flagged(spark, *((i, {}) for i in range(6)))
    first = TS.first_n(df, ["L_T1", "L_T6"], 2)
    assert first.count() == 4
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan[plan.rindex("Window "):]


def test_status_and_probes(spark):
    df = flagged(spark, (0, {"ATT_FLAG": 0}), (70, {"ATT_FLAG": 1}))
    assert TS.status_now(df, "ATT_FLAG").filter("alert_type = 'NORMAL'").first()["status"] == "ATTACK DETECTED"
    assert tuple(TS.freshness(df, "60 SECOND", TS.newest(df)).first()) == (1, True)
    presence = {r["field"]: r["present"] for r in TS.field_presence(df, ["L_T1", "disp_PU3"]).collect()}
    assert presence == {"L_T1": True, "disp_PU3": False}
    assert [r["ok"] for r in TS.throughput(df, "L_T1", "1 minute", 2).collect()] == [False, False]


def test_series_keep_the_tag_unless_grouped_by_field(spark):
    df = flagged(spark, (0, {}), (1, {"L_T1": 3.5}), (2, {}))
    counts = {r["alert_type"]: r["n"] for r in TS.series_count(df, ["L_T2"]).collect()}
    assert counts == {"NORMAL": 2, "PU1_STUCK_OFF": 1}
    assert [r["value"] for r in TS.field_sum(df, ["L_T2"]).collect()] == [9.0]


def test_aggregates_do_not_multiply_rows_before_the_shuffle(spark, sf_dir):
    """No Expand and no Python below the exchange of the windowed mean."""
    from weirflow.plans import catalog

    plan = catalog.queries()["agg_window_mean"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "Expand" not in below and "Python" not in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_tank_violation_limits(spark):
    df = flagged(spark, (0, {"L_T6": 4.4, "L_T2": 5.6}), (20, {"L_T6": 4.6, "L_T2": 5.5}))
    got = TS.tank_violations(df, "10 seconds").toPandas()
    assert set(zip(got["tank"], got["_time"].map(lambda t: pd.Timestamp(t).second))) == {("L_T6", 10), ("L_T2", 10)}
    assert set(got["field"]) == {"violation"}


def test_silent_windows_count_as_zero(spark):
    df = flagged(spark, (0, {}), (300, {}))
    got = [(r["n"], r["ok"]) for r in TS.throughput(df, "L_T1", "1 minute", 1).orderBy("_time").collect()]
    assert got == [(1, True), (0, False), (0, False), (0, False), (0, False), (1, True)]


def test_nan_counts_as_missing(spark):
    df = flagged(spark, (0, {"F_V2": 1.0}), (1, {"F_V2": float("nan")}))
    assert [r["value"] for r in TS.aggregate_window(df, ["F_V2"], "1 hour", F.avg).collect()] == [1.0]
    assert TS.series_count(df, ["F_V2"]).first()["n"] == 1
    assert TS.field_sum(df, ["F_V2"]).first()["value"] == 1.0
    assert TS.last(df, ["F_V2"]).first()["value"] == 1.0
    assert TS.points(df, ["F_V2"]).count() == 1
    assert TS.first_n(df, ["F_V2"], 5).count() == 1


def test_first_n_beyond_the_window_limit_of_the_optimizer(spark):
    df = spark.range(5_000).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as ts", "'t' as timestamp",
        "'NORMAL' as alert_type", "cast(id as double) as L_T1",
    )
    got = TS.first_n(df, ["L_T1"], 1_001)
    assert got.agg(F.count("*"), F.max("value")).first() == (1_001, 1_000.0)


def test_a_calendar_of_centuries(spark):
    """Two records far apart at one second: four billion windows are planned in pieces, and the first ones are right."""
    df = spark.sql("select timestamp_ntz'1900-01-01 00:00:30' as ts, cast(1 as float) as L_T1 union all "
                   "select timestamp_ntz'2024-01-01 00:00:05', cast(2 as float)")
    span = df.selectExpr("date_trunc('day', min(ts)) as first", "date_trunc('day', max(ts)) as last")
    days = TS.calendar(F.col("first"), F.col("last"), "1 day", span)
    assert days.count() == 45_291 and days.distinct().count() == 45_291
    got = TS.throughput(df, "L_T1", "7 days", 1).orderBy("_time").collect()
    assert len(got) == 6_471 and sum(r["n"] for r in got) == 2 and got[0]["ok"] and got[-1]["ok"] and not got[1]["ok"]
    # Windows of seconds: the pieces exist without the windows in them.
    sized = TS.calendar(F.col("first"), F.col("last"), "1 second", span)
    assert sized.limit(3).count() == 3


def test_nan_is_not_present(spark):
    df = spark.sql("select cast('NaN' as float) as L_T1, 1 as ATT_FLAG")
    assert [(r["field"], r["n"]) for r in TS.field_presence(df, ["L_T1", "ATT_FLAG", "none"]).collect()] == [
        ("L_T1", 0), ("ATT_FLAG", 1), ("none", 0)
    ]


def test_latest_values_do_not_send_a_tag_to_one_task(spark):
    """Whatever size Spark expects of the latest times, the records stay where they are."""
    df = flagged(spark, (0, {}), (5, {"L_T6": 3.5}), (5, {"L_T6": 3.25}), (9, {"L_T1": 3.5})).localCheckpoint()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found in (TS.last(df), TS.pivot_latest(df, ["L_T6", "L_T1"])):
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        got = {(r["alert_type"], r["value"]) for r in TS.last(df, ["L_T6"]).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == {("NORMAL", 3.25), ("PU1_STUCK_OFF", 3.0)}
