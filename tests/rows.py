"""Hand-made wide records."""

from weirflow.schema import FLOWS, PRESSURES, RECORD_SCHEMA, STATUSES

QUIET = {
    "timestamp": "2016-09-14T03:00:00Z",
    "L_T1": 5.0, "L_T2": 3.0, "L_T3": 3.2, "L_T4": 3.0, "L_T5": 2.5, "L_T6": 3.0, "L_T7": 3.5,
    **{f: 0.0 for f in FLOWS},
    **{s: 0 for s in STATUSES},
    **{p: 30.0 for p in PRESSURES},
    "ATT_FLAG": 0,
}


def record(**changes):
    return {**QUIET, **changes}


def frame(spark, *records):
    return spark.createDataFrame([tuple(r[f.name] for f in RECORD_SCHEMA) for r in records], RECORD_SCHEMA)
