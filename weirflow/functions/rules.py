"""Control-rule expressions, generated from the rule table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.schema import (
    ALERT_CODE, BANDS, NORMAL, PRESSURE_HIGH_LIMIT, PRESSURE_HIGH_SENSOR, RULES, Rule,
)


def runs_above_high(rule: Rule) -> Column:
    return (F.col(rule.status) == 1) & (F.col(rule.level) > F.lit(rule.high))


def rests_below_low(rule: Rule) -> Column:
    return (F.col(rule.status) == 0) & (F.col(rule.level) < F.lit(rule.low))


def cases(rules: list[Rule] = RULES) -> list[tuple[str, Column]]:
    """(label, predicate) in priority order."""
    return [
        case
        for rule in sorted(rules)
        for case in ((rule.stuck_on, runs_above_high(rule)), (rule.stuck_off, rests_below_low(rule)))
    ]


def alert_type(rules: list[Rule] = RULES) -> Column:
    """First matching rule; an unknown status or level never fires.

    Levels are float32 and are widened for the comparison, so a reading stored
    as 6.3 lies just above the threshold 6.3.
    """
    (label, predicate), *rest = cases(rules)
    chain = reduce(lambda acc, c: acc.when(c[1], F.lit(c[0])), rest, F.when(predicate, F.lit(label)))
    return chain.otherwise(F.lit(NORMAL)).alias("alert_type")


def display_codes(rules: list[Rule] = RULES) -> list[Column]:
    """0 off, 1 on, 2 alert; independent of which rule won."""
    return [
        F.when(runs_above_high(r) | rests_below_low(r), F.lit(ALERT_CODE))
        .otherwise(F.col(r.status).cast("int"))
        .alias(r.display)
        for r in rules
    ]


def tank_band(level: Column, safe_low: Column, safe_high: Column, high: Column) -> Column:
    """Step colour of a level: each step starts at its own value."""
    return (
        F.when(level >= high, F.lit("red_high"))
        .when(level >= safe_high, F.lit("light_blue"))
        .when(level >= safe_low, F.lit("dark_blue"))
        .otherwise(F.lit("red_low"))
    )


def band_rows() -> list[tuple]:
    return [(tank, safe_low, safe_high, high) for tank, (_, safe_low, safe_high, high) in BANDS.items()]


def pressure_high() -> Column:
    fires = F.col(PRESSURE_HIGH_SENSOR) > F.lit(PRESSURE_HIGH_LIMIT)
    return F.when(fires, F.lit("PRESSURE_HIGH")).otherwise(F.lit(NORMAL)).alias("pressure_alert")


def is_anomaly() -> Column:
    return (F.col("alert_type") != NORMAL) | (F.col("ml_alert") == 1)


def status_text(flag: Column) -> Column:
    return F.when(flag == 1, F.lit("ATTACK DETECTED")).when(flag == 0, F.lit("NORMAL"))
