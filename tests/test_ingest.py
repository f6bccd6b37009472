import math

from pyspark.sql import functions as F

from tests.rows import QUIET, frame, record
from weirflow.functions.parsing import filled, parse_datetime
from weirflow.operators import ingest as I
from weirflow.schema import RAW_RECORD, RECORD, SENSORS, STATUSES
from weirflow.sinks import tables
from weirflow.sources import files


def raw_frame(spark, *changes):
    base = {"DATETIME": " 14/09/16 03 ", **{c: str(v) for c, v in QUIET.items() if c != "timestamp"}}
    rows = [{**base, **c} for c in changes]
    schema = ", ".join(f"{c} string" for c in RAW_RECORD)
    return spark.createDataFrame([tuple(r[c] for c in RAW_RECORD) for r in rows], schema)


def test_time_text(spark):
    texts = ["14/09/16 03", " 06/01/14 00 ", "1/2/16 5", "31/12/99 23", "31/02/16 03", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_datetime(F.col("t")).alias("t"))
    assert [r["t"] for r in df.collect()] == [
        "2016-09-14T03:00:00Z", "2014-01-06T00:00:00Z", "2016-02-01T05:00:00Z", "1999-12-31T23:00:00Z",
        None, None, None,
    ]


def test_coercion(spark):
    df = raw_frame(spark, {"L_T1": "n/a", "S_PU1": "1.0", "S_PU2": "2", "S_PU3": "x", "ATT_FLAG": "-999"})
    row = I.normalise(df).first()
    assert row["L_T1"] is None and row["S_PU1"] == 1 and row["S_PU2"] == 2 and row["S_PU3"] is None
    assert row["ATT_FLAG"] == -999
    types = dict(I.normalise(df).dtypes)
    assert {types[c] for c in SENSORS} == {"float"} and {types[c] for c in STATUSES} == {"int"}


def test_missing_label_survives_both_modes(spark):
    df = frame(spark, record(ATT_FLAG=None), record(ATT_FLAG=-999), record(ATT_FLAG=1))
    assert I.clean(df).count() == 2
    assert I.clean(df, unknown=False).count() == 3
    assert I.labelled_only(df).count() == 1


def test_nan_counts_as_missing(spark):
    df = frame(spark, record(P_J14=math.nan), record(S_V2=None), record())
    assert I.drop_nulls(df).count() == 1
    assert I.clean(df, nulls=False).count() == 3
    report = I.cleaning_report(df).first()
    assert (report["rows_in"], report["dropped_null"], report["rows_out"]) == (3, 2, 1)


def test_two_files_with_padded_headers_and_other_column_order(spark, tmp_path):
    early = raw_frame(spark, {"DATETIME": " 14/09/16 03 "}, {"DATETIME": "13/09/16 03", "L_T6": None})
    late = raw_frame(spark, {"DATETIME": "15/09/16 03", "ATT_FLAG": "1"}, {"ATT_FLAG": "-999"})
    late = late.select(*(F.col(c).alias(" " + c) for c in reversed(RAW_RECORD)))
    paths = [str(tmp_path / n) for n in ("early", "late")]
    for df, path in zip((early, late), paths):
        tables.write_raw_delimited(df, path)
    loaded = I.load([files.read_delimited(spark, p) for p in paths])
    assert loaded.columns == RECORD
    assert [r["timestamp"] for r in loaded.collect()] == ["2016-09-14T03:00:00Z", "2016-09-15T03:00:00Z"]


def test_a_missing_column_becomes_null(spark):
    df = frame(spark, record())
    both = I.union_sources([df, df.drop("P_J14")])
    assert sorted(r["P_J14"] is None for r in both.collect()) == [False, True]


def test_features_are_filled(spark):
    df = frame(spark, record(L_T1=math.nan, S_PU1=None)).select(filled("L_T1"), filled("S_PU1"), filled("L_T2"))
    assert tuple(df.first()) == (0.0, 0.0, 3.0)


def test_the_store_is_read_by_file_and_field(spark, tmp_path, sf_dir):
    from weirflow.plans import catalog

    path = str(tmp_path / "store")
    flagged = catalog.flagged(spark, sf_dir)
    tables.write_store(flagged, path)
    start, stop = catalog.moment("2024-01-10 00:00:00"), catalog.moment("2024-01-12 00:00:00")
    every = len(spark.read.parquet(path).inputFiles())
    part = files.scan(spark, path, "water_telemetry", start, stop)
    assert 0 < len(part.inputFiles()) <= 4 < 25 < every
    level = part.select("L_T1")
    assert level.count() == flagged.filter((F.col("ts") >= start) & (F.col("ts") < stop)).count()
    scanned = level._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,L_T1:float>" in scanned and "PushedFilters: [IsNotNull(ts)" in scanned
    assert files.scan(spark, path, "other").count() == 0
    assert files.scan(spark, path, "water_telemetry", catalog.moment("2030-01-01 00:00:00")).count() == 0


def test_the_index_knows_the_alert_types_of_a_file(spark, tmp_path):
    rows = [(k, f"2024-01-{1 + k // 50:02d} 00:{k % 50:02d}:00", "RARE" if k == 120 else "NORMAL") for k in range(200)]
    df = spark.createDataFrame(rows, "event_id long, ts string, alert_type string").selectExpr(
        "event_id", "cast(ts as timestamp_ntz) as ts", "alert_type", "cast(event_id as float) as L_T1", "'x' as timestamp"
    )
    path = str(tmp_path / "store")
    tables.write_store(df, path)
    rare = files.scan(spark, path, "water_telemetry", alerts=["RARE"])
    assert [r["event_id"] for r in rare.collect()] == [120] and len(rare.inputFiles()) == 1
    index = spark.read.parquet(f"{path}/{tables.INDEX}").collect()
    assert sum(r["n"] for r in index) == 200 and spark.read.parquet(path).count() == 200


def test_one_busy_time_is_divided(spark, tmp_path):
    df = spark.range(4000).selectExpr("id as event_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "'NORMAL' as alert_type")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_store(df, str(tmp_path / "store"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["n"] for r in spark.read.parquet(str(tmp_path / "store" / tables.INDEX)).collect()]
    assert len(sizes) > 4 and max(sizes) < 1500
