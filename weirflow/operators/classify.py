"""Cleaning and rule evaluation on wide records; every transform here is narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions import rules as R
from weirflow.schema import HEAD_PAIRS, RULES, TANKS
from weirflow.operators.dimensions import constant_table


def tank_not_null(df: DataFrame) -> DataFrame:
    """Records that carry all tank levels."""
    return df.na.drop("any", subset=TANKS)


def classify(df: DataFrame) -> DataFrame:
    """Adds the winning alert and the display code of every ruled actuator."""
    return df.select("*", R.alert_type(), *R.display_codes())


def flag(df: DataFrame, model=None) -> DataFrame:
    """Clean, classify and score: the whole per-record chain, for batch and stream alike."""
    from weirflow.operators.learning import score

    return score(classify(tank_not_null(df)), model)


def gold(flagged: DataFrame) -> DataFrame:
    return flagged.filter(R.is_anomaly())


def rule_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every violated rule of every record, not only the winner.

    A record is multiplied only by the rules it violates.
    """

    def found(rule) -> Column:
        status, level = F.col(rule.status), F.col(rule.level).cast("double")
        too_high = (status == 1) & (level > rule.high)
        too_low = (status == 0) & (level < rule.low)
        return F.when(too_high | too_low, F.struct(
            F.lit(rule.priority).alias("priority"), F.lit(rule.actuator).alias("actuator"), F.lit(rule.level).alias("tank"),
            F.when(too_high, F.lit("STUCK_ON")).otherwise(F.lit("STUCK_OFF")).alias("kind"),
            status.alias("status"), level.alias("level"),
            F.when(too_high, F.lit(rule.high)).otherwise(F.lit(rule.low)).alias("threshold"),
        ))

    return df.select(*keys, F.inline(F.array_compact(F.array(*(found(r) for r in RULES)))))


def rule_catalog(df: DataFrame) -> DataFrame:
    """The rules with the number of records each one matched and won, from a single pass.

    All forty counters are plain conditional counts, so the scan ends in one
    partial row per task.
    """
    winner = R.alert_type()
    predicates = R.cases()
    totals = df.withColumn("winner", winner).agg(
        *(F.count_if(p).alias(f"matched_{label}") for label, p in predicates),
        *(F.count_if(F.col("winner") == label).alias(f"won_{label}") for label, _ in predicates),
    )
    rows = [
        F.struct(
            F.lit(r.priority).alias("priority"),
            F.lit(label).alias("rule"),
            F.lit(r.actuator).alias("actuator"),
            F.lit(r.level).alias("tank"),
            F.lit(status).alias("status"),
            F.lit(threshold).alias("threshold"),
            F.col(f"matched_{label}").alias("matched"),
            F.col(f"won_{label}").alias("won"),
        )
        for r in RULES
        for label, status, threshold in ((r.stuck_on, 1, r.high), (r.stuck_off, 0, r.low))
    ]
    return totals.select(F.inline(F.array(*rows)))


def tank_bands(df: DataFrame, keys: list[str]) -> DataFrame:
    bounds = constant_table(df.sparkSession, R.band_rows(), "tank string, safe_low double, safe_high double, high double")
    levels = df.unpivot(keys, TANKS, "tank", "level").filter("level is not null")
    band = R.tank_band(F.col("level"), F.col("safe_low"), F.col("safe_high"), F.col("high"))
    return levels.join(bounds, "tank").select(*keys, "tank", "level", band.alias("band"))


def alert_counts(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("alert_type").agg(F.count("*").alias("n"))


def rule_versus(flagged: DataFrame, column: str, values: dict[int, str]) -> DataFrame:
    """Cross table of alerts against a label or a prediction; the values are known beforehand."""
    return flagged.groupBy("alert_type").agg(
        *(F.count_if(F.col(column) == value).alias(name) for value, name in values.items())
    )


def head_gain(df: DataFrame, keys: list[str]) -> DataFrame:
    """Pressure gained (or lost) across each asset that has a sensor on both sides."""
    gains = [
        (F.col(down).cast("double") - F.col(up).cast("double")).alias(f"{asset}_gain")
        for asset, (up, down) in HEAD_PAIRS.items()
    ]
    return df.select(*keys, *gains)
