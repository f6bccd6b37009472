"""Attack scenarios laid over real records, to give a detector something to learn from.

A scenario forces some columns and leaves the rest of the record as measured. Its
noise is whole-number arithmetic on the record's own numbers, so a run is
reproducible anywhere. Drifting levels move a little with every record of a run.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.rules import alert_type
from weirflow.operators.ingest import READINGS
from weirflow.operators.ordering import FAR, POSITION, Walk, clamped_walks, ordered_blocks
from weirflow.schema import LABEL, NORMAL, STATUSES


class Noise(NamedTuple):
    """Around ``mean`` by at most two ``spread``, kept above ``low`` and below ``high``."""

    mean: float
    spread: float
    low: float | None = None
    high: float | None = None


class Drift(NamedTuple):
    """From ``start`` by ``step``, two ``spread`` more or less, per record; kept between ``low`` and ``high``.

    ``one_way``: no step is taken against the direction of ``step``.
    """

    start: float
    step: float
    spread: float
    low: float | None = None
    high: float | None = None
    one_way: bool = True


class Scenario(NamedTuple):
    name: str
    length: int
    forced: dict[str, float | Noise | Drift]

    @property
    def drifts(self) -> bool:
        return any(isinstance(v, Drift) for v in self.forced.values())


# --- Fixed values: the eight scenarios -----------------------------------------------------------
_PUMP_FLOW_1 = Noise(98, 3, 80)
_PUMP_FLOW_2 = Noise(99, 3, 80)
_COLLAPSED = {
    "P_J280": (0.2, 0.1), "P_J269": (1.5, 0.3), "P_J300": (0.8, 0.2), "P_J256": (2.0, 0.5),
    "P_J289": (0.9, 0.2), "P_J415": (1.8, 0.4), "P_J302": (0.5, 0.1), "P_J306": (1.5, 0.3),
    "P_J307": (0.4, 0.1), "P_J317": (1.2, 0.3), "P_J14": (0.6, 0.2), "P_J422": (0.7, 0.2),
}


def _off(*actuators: str) -> dict[str, float]:
    return {f"{kind}_{a}": 0.0 for a in actuators for kind in "SF"}


SCENARIOS = [
    Scenario("A1_PU1_STUCK_ON", 60, {
        "L_T1": Drift(6.4, 0.03, 0.01, high=6.5), "S_PU1": 1, "S_PU2": 1,
        "F_PU1": _PUMP_FLOW_1, "F_PU2": _PUMP_FLOW_2,
    }),
    Scenario("A2_PU4_PU5_STUCK_OFF", 60, {
        "L_T3": Drift(2.8, -0.04, 0.01, low=0.2), **_off("PU4", "PU5"),
    }),
    Scenario("A3_SENSOR_SPOOF_T4", 70, {
        "L_T4": Noise(2.5, 0.1, 2.0, 3.0), "S_PU6": 1, "S_PU7": 1,
        "F_PU6": Noise(52, 3, 45), "F_PU7": Noise(51, 3, 44),
        "P_J280": Noise(0.5, 0.2, 0), "P_J269": Noise(8.0, 1.0, 0),
        "P_J256": Noise(20.0, 2.0, 0), "P_J289": Noise(6.0, 1.0, 0),
    }),
    Scenario("A4_V2_VALVE_ATTACK", 60, {
        "L_T2": Drift(4.5, -0.06, 0.01, low=0.1), **_off("V2"),
        "P_J280": Noise(5.5, 0.5, 0), "P_J269": Noise(40.0, 2.0, 0),
    }),
    Scenario("A5_T5_CASCADE", 70, {
        "L_T5": Drift(1.4, -0.03, 0.01, low=0.1), "L_T7": Drift(2.4, -0.02, 0.01, low=0.1),
        **_off("PU8", "PU10", "PU11"),
    }),
    Scenario("A6_FLOW_INJECTION", 60, {
        "S_PU3": 0, "F_PU3": Noise(65, 5, 50), "P_J280": Noise(4.0, 0.4, 0),
    }),
    Scenario("A7_PRESSURE_COLLAPSE", 60, {
        p: Noise(mean, spread, 0) for p, (mean, spread) in _COLLAPSED.items()
    }),
    Scenario("A8_MULTI_TANK", 70, {
        "L_T1": Drift(6.3, 0.02, 0.01, high=6.5), "S_PU1": 1, "S_PU2": 1,
        "F_PU1": _PUMP_FLOW_1, "F_PU2": _PUMP_FLOW_2,
        "L_T3": Drift(1.2, -0.02, 0.01, low=0.1), "L_T7": Drift(1.1, -0.02, 0.01, low=0.1),
        **_off("PU4", "PU5", "PU10", "PU11"),
    }),
]
#: A level that wanders both ways between a floor and a ceiling, in runs longer than any scenario.
WANDERING = Scenario("WANDERING_LEVEL", 500, {"L_T1": Drift(5.0, 0.02, 0.05, 4.6, 5.4, one_way=False)})
#: Normal records that go with one round of all scenarios.
NORMAL_RUN = 2200
ATTACK_RUN = sum(s.length for s in SCENARIOS)
DRIFT_UNIT = 10_000
KEY_FORMAT = "SYN/%04d"


def mixed(column: str, span: int) -> Column:
    """A whole number in [0, span), different per record and column."""
    salt = READINGS.index(column)
    return (F.col("event_id") * (7 + 2 * salt) + F.col("user_id") * (3 + salt) + 31 * salt) % span


def _noise(column: str, n: Noise) -> Column:
    value = F.lit(float(n.mean)) + F.lit(float(n.spread)) * ((mixed(column, 2001) - 1000) / F.lit(500.0))
    if n.low is not None:
        value = F.greatest(value, F.lit(float(n.low)))
    if n.high is not None:
        value = F.least(value, F.lit(float(n.high)))
    return F.round(value, 6).cast("float")


class Units(NamedTuple):
    """A drift in whole drift units: a step is ``least`` and up to ``span - 1`` more."""

    start: int
    least: int
    span: int
    low: int | None
    high: int | None


def drift_units(d: Drift) -> Units:
    """Steps differ by whole units; of a one-way drift none goes the other way."""

    def units(x: float | None) -> int | None:
        return None if x is None else round(x * DRIFT_UNIT)

    step, spread = units(d.step), units(d.spread)
    # The distance is added away from the start in either direction, so that a falling drift mirrors a rising one.
    size, span = abs(step) - 2 * spread, 4 * spread + 1
    least = max(size, 0) if d.one_way else size
    return Units(units(d.start), least if d.step >= 0 else -(least + span - 1), span, units(d.low), units(d.high))


def _step(column: str, d: Drift) -> Column:
    units = drift_units(d)
    moved = mixed(column, units.span)
    return moved + units.least if d.step >= 0 else F.lit(units.least + units.span - 1) - moved


def _walk(column: str, drifts: list[tuple[Column, Drift]], first: Column) -> Walk:
    """The walk of a column whose rows follow one drift or another; ``first`` marks where a run begins."""

    def chosen(part) -> Column:
        chain = F
        for applies, d in drifts:
            chain = chain.when(applies, part(d))
        return chain

    return Walk(
        step=chosen(lambda d: _step(column, d)),
        begin=F.when(first, chosen(lambda d: F.lit(drift_units(d).start))),
        low=F.coalesce(chosen(lambda d: F.lit(drift_units(d).low)), F.lit(-FAR)),
        high=F.coalesce(chosen(lambda d: F.lit(drift_units(d).high)), F.lit(FAR)),
    )


def _walked(column: str) -> str:
    return f"walk_{column}"


def _forced(column: str, value: float | Noise | Drift) -> Column:
    """The forced value; that of a drift stands in the column of its walk already."""
    if isinstance(value, Drift):
        return (F.col(_walked(column)) / F.lit(float(DRIFT_UNIT))).cast("float")
    if isinstance(value, Noise):
        return _noise(column, value)
    return F.lit(value).cast("int" if column in STATUSES else "float")


def overlay(df: DataFrame, scenario: Scenario) -> DataFrame:
    """Forces the scenario's columns."""
    new = {c: _forced(c, v) for c, v in scenario.forced.items()}
    new[LABEL] = F.lit(1).cast("int")
    return df.select(*(new[c].alias(c) if c in new else F.col(c) for c in df.columns))


def _in_runs(base: DataFrame, scenario: Scenario, columns: list[str], order: list[str], blocks: int | None) -> DataFrame:
    """Consecutive runs of the scenario's length with the walks of the given columns."""
    placed = ordered_blocks(base, order, blocks)
    first = F.col(POSITION) % scenario.length == 0
    walks = {_walked(c): _walk(c, [(F.lit(True), scenario.forced[c])], first) for c in columns}
    return clamped_walks(placed, walks).withColumn("run", F.floor(F.col(POSITION) / scenario.length))


def overlay_all(base: DataFrame, scenario: Scenario, order: list[str], blocks: int | None = None) -> DataFrame:
    """The scenario over a whole table, in consecutive runs of its own length.

    Only a drifting scenario needs positions; the others stay a narrow projection.
    """
    drifting = [c for c, v in scenario.forced.items() if isinstance(v, Drift)]
    if not drifting:
        return overlay(base, scenario)
    return overlay(_in_runs(base, scenario, drifting, order, blocks), scenario).select(*base.columns)


def level_drift(
    base: DataFrame, scenario: Scenario, column: str, order: list[str], blocks: int | None = None
) -> DataFrame:
    """The drifting level of one column alone, with its run number."""
    walked = _in_runs(base.select(*order, "user_id", column), scenario, [column], order, blocks)
    return walked.select(*order, "run", _forced(column, scenario.forced[column]).alias("level"))


def training_mix(
    base: DataFrame, order: list[str], normal_run: int = NORMAL_RUN, blocks: int | None = None
) -> DataFrame:
    """All base records as they are, plus attack runs laid over part of them.

    Every ``normal_run`` consecutive records lend their first ones to one run of each
    scenario, which keeps the share of attacks the same at any size. Keys number the
    normal records first, then the attacks. Rows are shuffled once, for their positions.
    """
    if normal_run < ATTACK_RUN:
        raise ValueError("a round must hold one run of every scenario")
    step, round_ = F.col(POSITION) % normal_run, F.floor(F.col(POSITION) / normal_run)
    placed = ordered_blocks(base, order, blocks)
    walked = clamped_walks(placed, _scenario_walks(step, normal_run))
    n_normal = walked.agg(F.count("*")).scalar()
    normal = walked.withColumn("scenario", F.lit(NORMAL)).withColumn("number", F.col(POSITION))
    lent = (
        walked.filter(step < ATTACK_RUN)
        .withColumn("scenario", _scenario_of(step))
        .withColumn("number", n_normal + round_ * ATTACK_RUN + step)
    )
    mix = normal.unionByName(_overlay_by_name(lent))
    key = F.format_string(KEY_FORMAT, F.col("number")).alias("key")
    return mix.select(key, *base.columns, "scenario")


def _spans() -> list[tuple[int, int, Scenario]]:
    """First step, last step plus one, and scenario of every run of a round."""
    out, start = [], 0
    for s in SCENARIOS:
        out.append((start, start + s.length, s))
        start += s.length
    return out


def _scenario_of(step: Column) -> Column:
    chain = F
    for _, stop, s in _spans():
        chain = chain.when(step < stop, F.lit(s.name))
    return chain


def _scenario_walks(step: Column, normal_run: int) -> dict[str, Walk]:
    """One walk per column that drifts in any scenario; between runs nothing moves."""
    first = step == ATTACK_RUN % normal_run
    for start, _, _ in _spans():
        first = first | (step == start)
    drifts: dict[str, list[tuple[Column, Drift]]] = {}
    for start, stop, s in _spans():
        for c, v in s.forced.items():
            if isinstance(v, Drift):
                drifts.setdefault(c, []).append(((step >= start) & (step < stop), v))
    walks = {}
    for c, found in drifts.items():
        walk = _walk(c, found, first)
        # Where no scenario holds the column, its walk rests at 0 and the first row of all begins one.
        walks[_walked(c)] = walk._replace(begin=F.when(first, F.coalesce(walk.begin, F.lit(0))))
    return walks


def _overlay_by_name(df: DataFrame) -> DataFrame:
    """All scenarios in one pass; the record's ``scenario`` chooses what is forced."""

    def column(c: str) -> Column:
        chain = F
        for s in SCENARIOS:
            if c in s.forced:
                chain = chain.when(F.col("scenario") == s.name, _forced(c, s.forced[c]))
        return F.col(c) if chain is F else chain.otherwise(F.col(c)).alias(c)

    return df.select(*(F.lit(1).cast("int").alias(c) if c == LABEL else column(c) for c in df.columns))


def scenario_counts(base: DataFrame, normal_run: int = NORMAL_RUN) -> DataFrame:
    """Rows per scenario of the training mix; they follow from the number of base records alone."""
    n = F.col("n")
    lent = [
        F.struct(
            F.lit(s.name).alias("scenario"),
            (F.floor(n / normal_run) * s.length + F.least(F.greatest(n % normal_run - start, F.lit(0)), F.lit(s.length))).alias("n"),
        )
        for start, _, s in _spans()
    ]
    counted = base.agg(F.count("*").alias("n"))
    return counted.select(F.inline(F.array(F.struct(F.lit(NORMAL).alias("scenario"), n), *lent))).filter("n > 0")


def rule_coverage(mix: DataFrame, base_alert: str = "base_alert") -> DataFrame:
    """Share of overlaid records the rules catch, among those that were quiet before."""
    judged = mix.filter((F.col("scenario") != NORMAL) & (F.col(base_alert) == NORMAL))
    caught = F.count_if(F.col("alert_type") != NORMAL)
    return (
        judged.withColumn("alert_type", alert_type())
        .groupBy("scenario")
        .agg(F.count("*").alias("n"), caught.alias("caught"))
        .select("scenario", "n", "caught", F.round(F.col("caught") / F.col("n"), 6).alias("share"))
    )
