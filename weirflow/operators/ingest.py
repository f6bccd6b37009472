"""Raw text records to the normalised table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.functions.parsing import all_present, any_of, is_present, parse_datetime, typed
from weirflow.schema import LABEL, RAW_TIME, RECORD, SENSORS, STATUSES, UNKNOWN_LABEL

READINGS = SENSORS + STATUSES


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """Concatenation by column name; a column one source lacks becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def normalise(raw: DataFrame) -> DataFrame:
    """Typed columns with ``timestamp`` in front; columns outside the record ride along."""
    extra = [c for c in raw.columns if c != RAW_TIME and c not in RECORD]
    stamp = parse_datetime(F.col(RAW_TIME)).alias("timestamp")
    return raw.select(stamp, *(typed(c) for c in RECORD[1:]), *extra)


def drop_unknown(df: DataFrame) -> DataFrame:
    """Removes the unknown label only; a missing label stays."""
    return df.filter(~F.col(LABEL).eqNullSafe(UNKNOWN_LABEL))


def drop_nulls(df: DataFrame) -> DataFrame:
    """Records with every reading; NaN counts as absent."""
    return df.na.drop("any", subset=READINGS)


def labelled_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col(LABEL).isin(0, 1))


def attack_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(LABEL) == 1)


def clean(df: DataFrame, unknown: bool = True, nulls: bool = True) -> DataFrame:
    df = drop_unknown(df) if unknown else df
    return drop_nulls(df) if nulls else df


def load(sources: list[DataFrame], unknown: bool = True, nulls: bool = True, ordered: bool = True) -> DataFrame:
    """Union, normalise, clean. Ask for order only where the output is the last step."""
    table = clean(normalise(union_sources(sources)), unknown, nulls)
    # The text is cut to the hour; further columns let one busy hour be sorted by many tasks.
    return table.orderBy("timestamp", *READINGS) if ordered else table


def cleaning_report(df: DataFrame) -> DataFrame:
    """Rows in, dropped per step and out, in one pass instead of a count around each step."""
    unknown = F.col(LABEL).eqNullSafe(UNKNOWN_LABEL)
    complete = all_present(READINGS)
    return df.agg(
        F.count("*").alias("rows_in"),
        F.count_if(unknown).alias("dropped_unknown"),
        F.count_if(~unknown & ~complete).alias("dropped_null"),
        F.count_if(~unknown & complete).alias("rows_out"),
    )


def load_checks(loaded: DataFrame) -> DataFrame:
    """Rows that break each promise of the loaded table, and its number of attacks."""
    iso = r"^\d{4}-\d{2}-\d{2}T\d{2}:00:00Z$"
    label = F.col(LABEL)
    checks = {
        "label_not_binary": F.count_if(~label.isin(0, 1)),
        "label_missing": F.count_if(label.isNull()),
        "timestamp_not_iso": F.count_if(~F.coalesce(F.col("timestamp").rlike(iso), F.lit(False))),
        "reading_missing": F.count_if(~all_present(READINGS)),
        "status_not_binary": F.count_if(any_of(~F.col(s).isin(0, 1) for s in STATUSES)),
        "level_missing": F.count_if(~is_present("L_T1")),
        "rows": F.count("*"),
        "attacks": F.count_if(label == 1),
    }
    return loaded.agg(*(n.alias(k) for k, n in checks.items())).unpivot(
        [], list(checks), "check", "n"
    )
