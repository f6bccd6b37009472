import json
import math

from pyspark.sql import functions as F

from tests.rows import frame, record
from weirflow.operators import payloads as P
from weirflow.schema import RECORD


def messages_of(spark, *records):
    df = P.with_problems(P.to_payload(frame(spark, *records), []))
    return [r["m"] for r in df.select(F.col("problems.message").alias("m")).collect()]


def test_valid_record_has_no_problem(spark):
    assert messages_of(spark, record()) == [[]]


def test_messages_and_their_order(spark):
    (got,) = messages_of(
        spark, record(timestamp="", L_T1=-0.5, F_PU1=600.0, P_J280=None, P_J14=math.nan, S_PU1=None, S_V2=3)
    )
    assert got == [
        "timestamp missing or invalid",
        "L_T1=-0.5 out of range [0.0, 10.0]",
        "F_PU1=600.0 out of range [0.0, 500.0]",
        "P_J280 is null/NaN",
        "P_J14 is null/NaN",
        "S_PU1 is null",
        "S_V2=3 invalid (expected 0 or 1)",
    ]


def test_range_ends_are_valid(spark):
    assert messages_of(spark, record(L_T1=0.0, L_T2=10.0, F_V2=500.0, P_J280=-5.0, P_J14=100.0)) == [[]]


def test_numbers_are_printed_without_exponent(spark):
    (got,) = messages_of(spark, record(F_PU1=2.5e7, L_T1=-0.0002))
    assert got == ["L_T1=-0.0002 out of range [0.0, 10.0]", "F_PU1=25000000.0 out of range [0.0, 500.0]"]


def test_filter_and_quarantine_partition_the_rows(spark):
    rows = [record(), record(L_T1=11.0), record(S_PU1=None), record(P_J14=math.nan), record(timestamp=None)]
    payload = P.to_payload(frame(spark, *rows), [])
    assert P.valid(payload).count() == 1
    assert P.quarantine(payload).count() == 4
    summary = {(r["field"], r["kind"]): r["n"] for r in P.summary(payload).collect()}
    assert summary[("*", "skipped")] == 4 and summary[("L_T1", "range")] == 1


def test_json_has_all_keys_rounded(spark):
    payload = P.to_payload(frame(spark, record(L_T1=4.37, F_PU1=98.99812)), [])
    (row,) = P.to_messages(payload, []).collect()
    message = json.loads(row["value"])
    assert list(message) == RECORD
    assert message["L_T1"] == 4.37 and message["F_PU1"] == 98.9981 and isinstance(message["S_PU1"], int)
    assert "NaN" not in row["value"]


def test_parsing_of_damaged_text(spark):
    good = {"timestamp": "2016-09-14T03:00:00Z", "L_T1": 4.5, "S_PU1": 1}
    texts = [
        json.dumps(good), json.dumps({**good, "extra": 1}), json.dumps({**good, "L_T1": "4.5"}),
        json.dumps({**good, "S_PU1": 1.5}), json.dumps({**good, "S_PU1": 2**40}), "not json",
        '{"L_T1": NaN}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key int, value string")
    got = {r["key"]: r for r in P.parse(df, ["key"], keep_corrupt=True).collect()}
    assert got[0]["L_T1"] == 4.5 and got[0][P.CORRUPT] is None
    assert got[1]["L_T1"] == 4.5 and got[1][P.CORRUPT] is None
    assert got[2]["L_T1"] is None and got[2]["S_PU1"] == 1 and got[2][P.CORRUPT]
    assert got[3]["S_PU1"] is None and got[4]["S_PU1"] is None
    assert got[5]["timestamp"] is None and got[5][P.CORRUPT] == "not json"
    assert math.isnan(got[6]["L_T1"])


def test_binary_message_values(spark):
    df = spark.createDataFrame([(bytearray(b'{"L_T1": 2.5}'),)], "value binary")
    assert P.parse(df, []).first()["L_T1"] == 2.5


def test_export_keeps_readings_of_any_size(spark):
    df = frame(spark, record(F_V2=1e25), record(F_V2=float("nan")), record(F_V2=None))
    got = [r["F_V2"] for r in P.export_view(df, []).collect()]
    assert abs(float(got[0]) / 1e25 - 1) < 1e-6 and got[0].endswith(".000000") and got[1:] == [None, None]


def test_summary_counts_what_the_problem_list_shows(spark):
    df = P.to_payload(frame(spark, record(L_T1=None, S_PU1=3), record(L_T1=float("nan")), record(F_V2=900.0), record()), [])
    listed = P.with_problems(df).selectExpr("inline(problems)").groupBy("field", "kind").count().collect()
    got = {(r["field"], r["kind"]): r["n"] for r in P.summary(df).collect()}
    assert got.pop(("*", "skipped")) == 3
    assert got == {(r["field"], r["kind"]): r["count"] for r in listed}
