"""Validated messages and the quarantine of the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions import payload as P
from weirflow.functions.parsing import any_of
from weirflow.schema import LABEL, RECORD, RECORD_SCHEMA, SENSORS, STATUSES, TANKS


def to_payload(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *P.payload_columns())


def with_problems(payload: DataFrame) -> DataFrame:
    return payload.select("*", P.problems())


def valid(payload: DataFrame) -> DataFrame:
    return payload.filter(P.is_valid())


def quarantine(payload: DataFrame) -> DataFrame:
    """Rejected payloads with their messages, for a reject table next to the good ones."""
    return with_problems(payload.filter(~P.is_valid())).withColumn(
        "problems", F.col("problems.message")
    )


def to_messages(payload: DataFrame, keys: list[str]) -> DataFrame:
    return valid(payload).select(*keys, P.payload_json())


def summary(payload: DataFrame) -> DataFrame:
    """Problems by field and kind; the row ``* / skipped`` counts the rejected payloads.

    One aggregate of plain counts over the wide rows; no message is built, no row multiplied.
    """
    tests = P.problem_tests()
    counts = payload.agg(*(F.count_if(test).alias(f"n{k}") for k, test in enumerate(tests.values())))
    rows = F.array(*(
        F.struct(F.lit(field).alias("field"), F.lit(kind).alias("kind"), F.col(f"n{k}").alias("n"))
        for k, (field, kind) in enumerate(tests)
    ))
    return counts.select(F.inline(rows)).filter("n > 0")


CORRUPT = "_corrupt_record"


def parse(messages: DataFrame, keys: list[str], keep_corrupt: bool = False) -> DataFrame:
    """JSON text to typed columns.

    A field of the wrong type turns NULL, text that is no record turns into NULLs
    throughout; with ``keep_corrupt`` the text of both kinds stays at hand for a
    reject table.
    """
    fields = RECORD_SCHEMA.fields + ([T.StructField(CORRUPT, T.StringType())] if keep_corrupt else [])
    record = F.from_json(
        F.col("value").cast("string"), T.StructType(fields), {"columnNameOfCorruptRecord": CORRUPT}
    )
    return messages.select(*keys, record.alias("data")).select(*keys, "data.*")


def payload_checks(payload: DataFrame) -> DataFrame:
    """Rows that break each promise of a valid payload."""
    not_rounded = any_of((F.round(F.col(c), P.DECIMALS) != F.col(c) for c in SENSORS))
    absent = any_of((F.col(c).isNull() for c in RECORD))
    checks = {
        "key_missing": F.count_if(absent),
        "timestamp_not_iso": F.count_if(~(F.col("timestamp").contains("T") & F.col("timestamp").endswith("Z"))),
        "sensor_not_rounded": F.count_if(not_rounded),
        "status_not_binary": F.count_if(any_of((~F.col(c).isin(0, 1) for c in STATUSES))),
        "level_negative": F.count_if(any_of((F.col(c) < 0 for c in TANKS))),
        "not_a_number": F.count_if(any_of((F.isnan(c) for c in SENSORS))),
        "rows": F.count("*"),
        "attacks": F.count_if(F.col(LABEL) == 1),
    }
    return payload.agg(*(n.alias(k) for k, n in checks.items())).unpivot([], list(checks), "check", "n")


def export_view(df: DataFrame, keys: list[str], decimals: int = 6) -> DataFrame:
    """Readings as fixed-decimal text of any size, ready for a delimited export; NaN gives an empty cell."""

    def fixed(column: str) -> Column:
        value = F.col(column).cast("double")
        return F.when(value.isNotNull() & ~F.isnan(value), F.format_string(f"%.{decimals}f", value)).alias(column)

    text = [fixed(c) for c in SENSORS]
    rest = [F.col(c).cast("string").alias(c) for c in [*STATUSES, LABEL]]
    return df.select(*keys, "timestamp", *text, *rest)


def sample(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """The first ``size`` records in time order (a top-n, not a sort of everything)."""
    return df.orderBy(*order).limit(size)
