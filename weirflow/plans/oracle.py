"""SQL twins of the registered queries, for an independent engine on the same tables.

The statements restate the semantics in SQL; they share only the constants with the
Spark side. Queries without an entry (model training) have no SQL meaning.
"""

from __future__ import annotations

from weirflow.operators import sampling
from weirflow.operators import scenarios as S
from weirflow.operators.ingest import READINGS
from weirflow.plans import catalog as Q
from weirflow.schema import (
    ACTUATORS, BANDS, DISPLAYS, FEATURES, FLOAT_FIELDS, FLOWS, HEAD_PAIRS, INT_FIELDS, LABEL, MEASUREMENT,
    POINT_FIELDS, PRESSURES, RANGES, RAW_RECORD, RECORD, RULES, SENSORS, STATUSES, TANKS, VIOLATION_LIMITS,
)
from weirflow.sources.events import TANK_MIDDLE


def d(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


def cols(names, prefix: str = "") -> str:
    return ", ".join(prefix + n for n in names)


# --- shared relations ----------------------------------------------------------------------------


def _telemetry() -> str:
    out = []
    for k, c in enumerate(TANKS, 1):
        mix = f"(event_id * {2 * k + 3} + user_id * {k + 5})"
        out.append(
            f"CAST(CASE WHEN event_id % 97 = {k} THEN NULL WHEN (event_id + {3 * k}) % 11 = 0 "
            f"THEN ({mix} % 700) / {d(100)} ELSE {d(TANK_MIDDLE[k - 1])} + ({mix} % 50) / {d(100)} END AS FLOAT) AS {c}"
        )
    for j, c in enumerate(STATUSES, 1):
        out.append(
            f"CAST(CASE WHEN event_id % 101 = {j} THEN NULL "
            f"ELSE (event_id * {2 * j + 1} + user_id * {j}) % 7 % 2 END AS INTEGER) AS {c}"
        )
    for x, c in enumerate(PRESSURES, 1):
        out.append(
            f"CAST(CASE WHEN event_id % 223 = {x} THEN {d(150)} WHEN event_id % 59 = 7 THEN {d(x / 10)} "
            f"ELSE {d(20)} + ((event_id * {x + 2} + user_id) % 600) / {d(10)} END AS FLOAT) AS {c}"
        )
    out.append(
        f"CAST(CASE WHEN event_type = 'error' THEN 1 WHEN event_type = 'signup' AND event_id % 4 = 0 THEN -999 "
        f"ELSE 0 END AS INTEGER) AS {LABEL}"
    )
    flows = []
    for j, (c, a) in enumerate(zip(FLOWS, ACTUATORS), 1):
        ghost = f"WHEN event_id % 53 = 3 THEN {d(65)} " if a == "PU3" else ""
        flows.append(
            f"CAST(CASE WHEN event_id % 103 = {j} THEN NULL WHEN event_id % 211 = {j} THEN {d(600)} {ghost}"
            f"ELSE CAST(coalesce(S_{a}, 0) * (30 + (3 * event_id + {17 * j}) % 70) AS DOUBLE) END AS FLOAT) AS {c}"
        )
    return (
        "tel0 AS (SELECT event_id, ts, user_id, strftime(ts, '%Y-%m-%dT%H:00:00Z') AS \"timestamp\", "
        + ", ".join(out) + " FROM events), tel AS (SELECT *, " + ", ".join(flows) + " FROM tel0)"
    )


def _on(r) -> str:
    return f"{r.status} = 1 AND CAST({r.level} AS DOUBLE) > {d(r.high)}"


def _off(r) -> str:
    return f"{r.status} = 0 AND CAST({r.level} AS DOUBLE) < {d(r.low)}"


def _alert() -> str:
    whens = " ".join(f"WHEN {_on(r)} THEN '{r.stuck_on}' WHEN {_off(r)} THEN '{r.stuck_off}'" for r in RULES)
    return f"CASE {whens} ELSE 'NORMAL' END"


def _present(names) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in names)


def _flag(source: str, name: str) -> str:
    shown = ", ".join(
        f"CASE WHEN ({_on(r)}) OR ({_off(r)}) THEN 2 ELSE {r.status} END AS {r.display}" for r in RULES
    )
    return (
        f"{name} AS (SELECT *, {_alert()} AS alert_type, {shown}, CAST(0 AS INTEGER) AS ml_alert "
        f"FROM {source} WHERE {_present(TANKS)})"
    )


def _raw() -> str:
    def text(c: str) -> str:
        if c == "DATETIME":
            return "' ' || strftime(ts, '%d/%m/%y %H') || ' ' AS DATETIME"
        if c in STATUSES:
            dot = " || '.0'" if (STATUSES.index(c) + 1) % 2 == 0 else ""
            return f"CAST({c} AS VARCHAR){dot} AS {c}"
        if c == LABEL:
            return f"CAST({c} AS VARCHAR) AS {c}"
        printed = f"CAST(CAST(CAST({c} AS DOUBLE) AS DECIMAL(10, 2)) AS VARCHAR)"
        if c == "L_T6":
            printed = f"CASE WHEN event_id % 131 = 5 THEN 'n/a' ELSE {printed} END"
        return f"{printed} AS {c}"

    return "raw AS (SELECT event_id, ts, " + ", ".join(text(c) for c in RAW_RECORD) + " FROM tel)"


PARSED_TIME = "strftime(try_strptime(trim(DATETIME), '%d/%m/%y %H'), '%Y-%m-%dT%H:%M:%SZ')"


def _normal() -> str:
    def typed(c: str) -> str:
        if c in SENSORS:
            return f"CAST(TRY_CAST({c} AS DOUBLE) AS FLOAT) AS {c}"
        return f"TRY_CAST(TRY_CAST({c} AS DOUBLE) AS INTEGER) AS {c}"

    return (
        f"norm AS (SELECT event_id, {PARSED_TIME} AS \"timestamp\", "
        + ", ".join(typed(c) for c in RECORD[1:]) + " FROM raw)"
    )


def _payload(source: str = "tel", keys: str = "event_id") -> str:
    def one(c: str) -> str:
        return f"round(CAST({c} AS DOUBLE), 4) AS {c}" if c in SENSORS else c

    return f"pay AS (SELECT {keys}, \"timestamp\", " + ", ".join(one(c) for c in RECORD[1:]) + f" FROM {source})"


def _ok_reading(c: str) -> str:
    if c in SENSORS:
        low, high = RANGES[c]
        return f"({c} IS NOT NULL AND {c} BETWEEN {d(low)} AND {d(high)})"
    return f"({c} IS NOT NULL AND {c} IN (0, 1))"


VALID = " AND ".join(["\"timestamp\" <> ''"] + [_ok_reading(c) for c in READINGS])
KNOWN = f"{LABEL} IS DISTINCT FROM -999"
COMPLETE = _present(READINGS)
RECORD_LIST = '"timestamp", ' + cols(RECORD[1:])
CLEAN = f"clean AS (SELECT * FROM tel WHERE {KNOWN} AND {COMPLETE})"
TRAINING = f"training AS (SELECT * FROM clean WHERE {LABEL} IN (0, 1))"


def _parsed() -> str:
    """What survives of each damaged message."""
    cut = "event_id % 137 = 0"
    quoted = f"NOT ({cut}) AND event_id % 139 = 0 AND L_T1 IS NOT NULL"
    fractional = f"NOT ({cut}) AND event_id % 139 <> 0 AND event_id % 149 = 0 AND S_PU1 IS NOT NULL"

    def one(c: str) -> str:
        name = '"timestamp"' if c == "timestamp" else c
        lost = cut
        if c == "L_T1":
            lost = f"{cut} OR ({quoted})"
        if c == "S_PU1":
            lost = f"{cut} OR ({fractional})"
        return f"CASE WHEN {lost} THEN NULL ELSE {name} END AS {name}"

    return (
        "parsed AS (SELECT event_id, CAST(event_id AS VARCHAR) AS key, " + ", ".join(one(c) for c in RECORD)
        + f", (({cut}) OR ({quoted}) OR ({fractional})) AS corrupt FROM tel)"
    )


def with_(*relations: str) -> str:
    return "WITH RECURSIVE " + ", ".join((_telemetry(), *relations)) + " "


FLAGGED = _flag("tel", "fl")


def long_(source: str, fields, keys: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{f}' AS field, CAST({f} AS DOUBLE) AS value FROM {source} WHERE {f} IS NOT NULL"
        for f in fields
    )


POINT_KEYS = f"event_id, '{MEASUREMENT}' AS measurement, alert_type, \"timestamp\" AS event_time, ts AS _time"
WINDOW_END = "time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour'"


def points(fields, source: str = "fl") -> str:
    return long_(source, fields, POINT_KEYS)


# --- scenario relations --------------------------------------------------------------------------


def _mixed(c: str, span: int) -> str:
    salt = READINGS.index(c)
    return f"((event_id * {7 + 2 * salt} + user_id * {3 + salt} + {31 * salt}) % {span})"


def _forced(c: str, v, run: str) -> str:
    if isinstance(v, S.Drift):
        # Steps of one sign: clamping the running sum equals clamping every step.
        least, span = max(round(abs(v.step) * 10000) - 2 * round(v.spread * 10000), 0), 4 * round(v.spread * 10000) + 1
        moved = (
            f"sum({_mixed(c, span)} + {least}) OVER (PARTITION BY {run} ORDER BY position "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        )
        start = round(v.start * 10000)
        units = f"least({round(v.high * 10000)}, {start} + {moved})" if v.step > 0 else f"greatest({round(v.low * 10000)}, {start} - {moved})"
        return f"CAST(CAST({units} AS DOUBLE) / {d(10000)} AS FLOAT)"
    if isinstance(v, S.Noise):
        value = f"{d(v.mean)} + {d(v.spread)} * (({_mixed(c, 2001)} - 1000) / {d(500)})"
        value = value if v.low is None else f"greatest({value}, {d(v.low)})"
        value = value if v.high is None else f"least({value}, {d(v.high)})"
        return f"CAST(round({value}, 6) AS FLOAT)"
    return f"CAST({v} AS {'INTEGER' if c in STATUSES else 'FLOAT'})"


def _wandering() -> str:
    """Step by step, all runs side by side."""
    s = S.WANDERING
    v = s.forced["L_T1"]
    spread = round(v.spread * 10000)
    step = f"({_mixed('L_T1', 4 * spread + 1)} + {round(v.step * 10000) - 2 * spread})"

    def kept(x: str) -> str:
        return f"least({round(v.high * 10000)}, greatest({round(v.low * 10000)}, {x}))"

    return (
        f"steps AS (SELECT event_id, position // {s.length} AS run, position % {s.length} AS k, {step} AS step FROM placed), "
        f"walk AS (SELECT event_id, run, k, {kept(f'{round(v.start * 10000)} + step')} AS level FROM steps WHERE k = 0 UNION ALL "
        f"SELECT s.event_id, s.run, s.k, {kept('w.level + s.step')} FROM walk w JOIN steps s ON s.run = w.run AND s.k = w.k + 1)"
    )


def _overlaid(s: S.Scenario, run: str) -> str:
    parts = [f"{_forced(c, s.forced[c], run)} AS {c}" if c in s.forced else c for c in READINGS]
    return ", ".join(parts) + f", CAST(1 AS INTEGER) AS {LABEL}"


PLACED = (
    f"placed AS (SELECT *, {_alert()} AS base_alert, row_number() OVER (ORDER BY ts, event_id) - 1 AS position "
    f"FROM tel WHERE {COMPLETE} AND {LABEL} = 0)"
)


def _mix() -> str:
    readings = cols(READINGS)
    rounds = (
        f"rounds AS (SELECT *, position // {S.NORMAL_RUN} AS round, position % {S.NORMAL_RUN} AS step, "
        "(SELECT count(*) FROM placed) AS n_normal FROM placed)"
    )
    parts = [
        f"SELECT printf('SYN/%04d', position) AS key, event_id, 'NORMAL' AS scenario, base_alert, {readings}, {LABEL} FROM rounds"
    ]
    start = 0
    for s in S.SCENARIOS:
        parts.append(
            f"SELECT printf('SYN/%04d', n_normal + round * {S.ATTACK_RUN} + step) AS key, event_id, "
            f"'{s.name}' AS scenario, base_alert, {_overlaid(s, 'round')} FROM rounds "
            f"WHERE step >= {start} AND step < {start + s.length}"
        )
        start += s.length
    return rounds + ", mix AS (" + " UNION ALL ".join(parts) + ")"


# --- statements ----------------------------------------------------------------------------------


def _problem_texts() -> list[str]:
    items = ["CASE WHEN \"timestamp\" IS NULL OR \"timestamp\" = '' THEN 'timestamp missing or invalid' END"]
    for c in SENSORS:
        low, high = RANGES[c]
        items.append(
            f"CASE WHEN {c} IS NULL THEN '{c} is null/NaN' WHEN NOT ({c} BETWEEN {d(low)} AND {d(high)}) "
            f"THEN '{c}=' || CAST({c} AS VARCHAR) || ' out of range [{low}, {high}]' END"
        )
    for c in STATUSES:
        items.append(
            f"CASE WHEN {c} IS NULL THEN '{c} is null' WHEN {c} NOT IN (0, 1) "
            f"THEN '{c}=' || CAST({c} AS VARCHAR) || ' invalid (expected 0 or 1)' END"
        )
    return items


def _summary() -> str:
    parts = [
        "SELECT 'timestamp' AS field, 'missing' AS kind, count(*) AS n FROM pay WHERE \"timestamp\" IS NULL OR \"timestamp\" = ''"
    ]
    for c in SENSORS:
        low, high = RANGES[c]
        parts.append(f"SELECT '{c}', 'null', count(*) FROM pay WHERE {c} IS NULL")
        parts.append(f"SELECT '{c}', 'range', count(*) FROM pay WHERE NOT ({c} BETWEEN {d(low)} AND {d(high)})")
    for c in STATUSES:
        parts.append(f"SELECT '{c}', 'null', count(*) FROM pay WHERE {c} IS NULL")
        parts.append(f"SELECT '{c}', 'status', count(*) FROM pay WHERE {c} NOT IN (0, 1)")
    parts.append(f"SELECT '*', 'skipped', count(*) FROM pay WHERE NOT coalesce({VALID}, false)")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n > 0"


def _catalog() -> str:
    parts = []
    for r in RULES:
        for label, status, limit, test in ((r.stuck_on, 1, r.high, _on(r)), (r.stuck_off, 0, r.low, _off(r))):
            parts.append(
                f"SELECT CAST({r.priority} AS INTEGER) AS priority, '{label}' AS rule, '{r.actuator}' AS actuator, "
                f"'{r.level}' AS tank, CAST({status} AS INTEGER) AS status, {d(limit)} AS threshold, "
                f"count(*) FILTER (WHERE {test}) AS matched, "
                f"count(*) FILTER (WHERE alert_type = '{label}') AS won FROM fl"
            )
    return " UNION ALL ".join(parts)


def _violations() -> str:
    parts = []
    for r in RULES:
        for kind, limit, test in (("STUCK_ON", r.high, _on(r)), ("STUCK_OFF", r.low, _off(r))):
            parts.append(
                f"SELECT event_id, CAST({r.priority} AS INTEGER) AS priority, '{r.actuator}' AS actuator, "
                f"'{r.level}' AS tank, '{kind}' AS kind, {r.status} AS status, "
                f"CAST({r.level} AS DOUBLE) AS level, {d(limit)} AS threshold FROM fl WHERE {test}"
            )
    return " UNION ALL ".join(parts)


def _bands() -> str:
    parts = []
    for tank, (_, safe_low, safe_high, high) in BANDS.items():
        level = f"CAST({tank} AS DOUBLE)"
        parts.append(
            f"SELECT event_id, '{tank}' AS tank, {tank} AS level, CASE WHEN {level} >= {d(high)} THEN 'red_high' "
            f"WHEN {level} >= {d(safe_high)} THEN 'light_blue' WHEN {level} >= {d(safe_low)} THEN 'dark_blue' "
            f"ELSE 'red_low' END AS band FROM tel WHERE {tank} IS NOT NULL"
        )
    return " UNION ALL ".join(parts)


def _line() -> str:
    texts = {
        c: f"'{c}=' || regexp_replace(CAST(CAST({c} AS DOUBLE) AS VARCHAR), '\\.0$', '')" for c in FLOAT_FIELDS
    }
    texts.update({c: f"'{c}=' || CAST({c} AS VARCHAR) || 'i'" for c in INT_FIELDS})
    texts["event_time"] = "'event_time=\"' || \"timestamp\" || '\"'"
    body = ", ".join(texts[c] for c in sorted(texts))
    return (
        f"SELECT event_id, '{MEASUREMENT},alert_type=' || alert_type || ' ' || concat_ws(',', {body}) || ' ' || "
        "CAST(epoch_us(ts) * 1000 AS VARCHAR) AS line FROM fl"
    )


def _last(fields) -> str:
    return " UNION ALL ".join(
        f"SELECT alert_type, '{f}' AS field, max(ts) AS _time, "
        f"arg_max(CAST({f} AS DOUBLE), (ts, event_id)) AS value FROM fl WHERE {f} IS NOT NULL GROUP BY alert_type"
        for f in fields
    )


def _pivot() -> str:
    picks = ", ".join(f"any_value(value) FILTER (WHERE field = '{f}') AS {f}" for f in Q.CANVAS_FIELDS)
    return f", latest AS ({_last(Q.CANVAS_FIELDS)}) SELECT _time, alert_type, {picks} FROM latest GROUP BY _time, alert_type"


RECENT = "recent AS (SELECT * FROM fl WHERE ts >= (SELECT max(ts) FROM fl) - INTERVAL '1 day')"
RANGE = f" AND ts >= TIMESTAMP '{Q.RANGE_START}' AND ts < TIMESTAMP '{Q.RANGE_STOP_UNEVEN}'"


def _hourly(range_: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {WINDOW_END} AS _time, alert_type, '{f}' AS field, avg(CAST({f} AS DOUBLE)) AS value "
        f"FROM fl WHERE {f} IS NOT NULL{range_} GROUP BY 1, 2"
        for f in TANKS
    )


def _violation_windows() -> str:
    tests = []
    for tank, (low, high) in VIOLATION_LIMITS.items():
        beyond = f"value < {d(low)}" + (f" OR value > {d(high)}" if high is not None else "")
        tests.append(f"(field = '{tank}' AND ({beyond}))")
    return (
        f", means AS ({_hourly()}) SELECT _time, alert_type, field AS tank, 'violation' AS field, "
        f"round(value, 6) AS value FROM means WHERE " + " OR ".join(tests)
    )


def _filled(c: str) -> str:
    return f"coalesce(CAST({c} AS DOUBLE), {d(0)})"


def _split() -> str:
    hashed = f"((event_id % {sampling.MODULUS}) * {sampling.MULTIPLIER} + {12345 * 42}) % {sampling.MODULUS}"
    return (
        f", counts AS (SELECT {LABEL}, count(*) AS n FROM training GROUP BY 1), "
        "total AS (SELECT CAST(sum(n) AS BIGINT) AS t FROM counts), "
        "quota0 AS (SELECT c.*, t, t - CAST(ceil(t / 4.0) AS BIGINT) AS n_train FROM counts c, total), "
        "quota1 AS (SELECT *, (n_train * n) // t AS base, (n_train * n) % t AS rest FROM quota0), "
        f"quota AS (SELECT {LABEL}, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, {LABEL}) "
        "<= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS q FROM quota1), "
        f"ranked AS (SELECT event_id, {LABEL}, row_number() OVER (PARTITION BY {LABEL} ORDER BY {hashed}, event_id) AS r FROM training) "
        f"SELECT event_id, {LABEL}, CASE WHEN r <= q THEN 'train' ELSE 'validation' END AS split "
        f"FROM ranked JOIN quota USING ({LABEL})"
    )


JUDGED = f"judged AS (SELECT {LABEL} AS y, CASE WHEN alert_type <> 'NORMAL' THEN 1 ELSE 0 END AS p FROM fl WHERE {LABEL} IN (0, 1))"
CONFUSION = (
    "cm AS (SELECT count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp, "
    "count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp FROM judged)"
)


def _report() -> str:
    def ratio(a: str, b: str) -> str:
        return f"CASE WHEN {b} = 0 THEN {d(0)} ELSE CAST({a} AS DOUBLE) / ({b}) END"

    rates = (
        ", rates AS (SELECT tn + fp AS n0, fn + tp AS n1, "
        f"{ratio('tn', '(tn + fn)')} AS p0, {ratio('tn', '(tn + fp)')} AS r0, {ratio('2 * tn', '(2 * tn + fn + fp)')} AS f0, "
        f"{ratio('tp', '(tp + fp)')} AS p1, {ratio('tp', '(tp + fn)')} AS r1, {ratio('2 * tp', '(2 * tp + fp + fn)')} AS f1, "
        f"{ratio('tn + tp', '(tn + fp + fn + tp)')} AS acc FROM cm)"
    )

    def weighted(x: str) -> str:
        return f"round(({x}0 * n0 + {x}1 * n1) / (n0 + n1), 6)"

    return (
        rates
        + " SELECT 'Normal' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, n0 AS support FROM rates"
        " UNION ALL SELECT 'Attack', round(p1, 6), round(r1, 6), round(f1, 6), n1 FROM rates"
        " UNION ALL SELECT 'accuracy', NULL, NULL, round(acc, 6), n0 + n1 FROM rates"
        " UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n0 + n1 FROM rates"
        f" UNION ALL SELECT 'weighted avg', {weighted('p')}, {weighted('r')}, {weighted('f')}, n0 + n1 FROM rates"
    )


def _signals() -> str:
    parts = [
        f"SELECT '{f}' AS feature, round(abs(avg({_filled(f)}) FILTER (WHERE {LABEL} = 1) - "
        f"avg({_filled(f)}) FILTER (WHERE {LABEL} = 0)) / stddev_pop({_filled(f)}) FILTER (WHERE {LABEL} IN (0, 1)), 6) AS shift FROM tel"
        for f in FEATURES
    ]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + f") ORDER BY shift DESC, feature LIMIT {Q.TOP_K}"


def _presence() -> str:
    recent = ", recent AS (SELECT * FROM fl WHERE ts >= (SELECT max(ts) FROM fl) - INTERVAL '5 minute')"
    known = {*POINT_FIELDS, "alert_type"}
    parts = [
        f"SELECT '{f}' AS field, count({f if f in known else 'NULL'}) AS n, count({f if f in known else 'NULL'}) > 0 AS present FROM recent"
        for f in Q.EXPECTED_FIELDS
    ]
    return recent + " " + " UNION ALL ".join(parts)


def _load_checks() -> str:
    iso = "^\\d{4}-\\d{2}-\\d{2}T\\d{2}:00:00Z$"
    bad_status = " OR ".join(f"{s} NOT IN (0, 1)" for s in STATUSES)
    checks = {
        "label_not_binary": f"{LABEL} NOT IN (0, 1)",
        "label_missing": f"{LABEL} IS NULL",
        "timestamp_not_iso": f"NOT coalesce(regexp_matches(\"timestamp\", '{iso}'), false)",
        "reading_missing": f"NOT ({COMPLETE})",
        "status_not_binary": bad_status,
        "level_missing": "L_T1 IS NULL",
        "rows": "true",
        "attacks": f"{LABEL} = 1",
    }
    return f", loaded AS (SELECT * FROM norm WHERE {KNOWN} AND {COMPLETE}) " + _counted(checks, "loaded")


def _payload_checks() -> str:
    checks = {
        "key_missing": " OR ".join(f"{c} IS NULL" for c in ['"timestamp"', *RECORD[1:]]),
        "timestamp_not_iso": "NOT (\"timestamp\" LIKE '%T%' AND \"timestamp\" LIKE '%Z')",
        "sensor_not_rounded": " OR ".join(f"round({c}, 4) <> {c}" for c in SENSORS),
        "status_not_binary": " OR ".join(f"{s} NOT IN (0, 1)" for s in STATUSES),
        "level_negative": " OR ".join(f"{c} < 0" for c in TANKS),
        "not_a_number": " OR ".join(f"isnan({c})" for c in SENSORS),
        "rows": "true",
        "attacks": f"{LABEL} = 1",
    }
    return f", ok AS (SELECT * FROM pay WHERE {VALID}) " + _counted(checks, "ok")


def _counted(checks: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {test}) AS n FROM {source}" for name, test in checks.items()
    )


def _scenario(number: int) -> str:
    s = S.SCENARIOS[number - 1]
    return (
        with_(PLACED, f"runs AS (SELECT *, position // {s.length} AS run FROM placed)")
        + f"SELECT event_id, {_overlaid(s, 'run')} FROM runs"
    )


def _json(names) -> str:
    body = ", ".join(f"{'\"timestamp\"' if c == 'timestamp' else c} := {'\"timestamp\"' if c == 'timestamp' else c}" for c in names)
    return f"CAST(to_json(struct_pack({body})) AS VARCHAR)"


def _linear() -> str:
    weighted = " + ".join(f"{_filled(f)} * {d(w)}" for f, w in zip(FEATURES, Q.LINEAR_WEIGHTS) if w)
    return f"CASE WHEN {weighted} > {d(Q.LINEAR_THRESHOLD)} THEN 1 ELSE 0 END"


def _rolled(fn: str, width: str, value: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT time_bucket(INTERVAL '{width}', et) + INTERVAL '{width}' AS _time, alert_type, '{f}' AS field, "
        f"{fn}(CAST({f} AS DOUBLE)) AS value FROM st WHERE {f} IS NOT NULL GROUP BY 1, 2" for f in TANKS
    )
    return f"SELECT _time, alert_type, field, {value} FROM ({parts})"


def _silent(source: str, time: str, delay: str) -> str:
    limit = f"INTERVAL '{Q.SILENT_MINUTES} minute'"
    return (
        f"times AS (SELECT DISTINCT alert_type, {time} AS t FROM {source}), "
        "pairs AS (SELECT *, lead(t) OVER (PARTITION BY alert_type ORDER BY t) AS following FROM times), "
        f"silent AS (SELECT alert_type, t AS last_seen, t + {limit} AS silent_at FROM pairs "
        f"WHERE (following IS NULL OR following > t + {limit}) AND t + {limit} <= (SELECT max(t) FROM times) - {delay})"
    )


SILENT = "SELECT * FROM silent"


def statements() -> dict[str, str]:
    raw, normal, pay, parsed = _raw(), _normal(), _payload(), _parsed()
    mix = _mix()
    stream = (parsed, _flag("parsed", "fl"))
    timed = "st AS (SELECT *, strptime(\"timestamp\", '%Y-%m-%dT%H:%M:%SZ') AS et FROM fl)"
    verdict = "CASE WHEN alert_type <> 'NORMAL' THEN 1 ELSE 0 END"
    diffs = ", ".join(
        f"CAST({c} AS DOUBLE) - lag(CAST({c} AS DOUBLE)) OVER (ORDER BY ts, event_id) AS {c}_diff" for c in SENSORS
    )
    means = ", ".join(f"round(avg(CAST({c} AS DOUBLE)) OVER w, 6) AS {c}_mean" for c in SENSORS)
    sql = {
        # ingest
        "load_raw": with_(raw) + f"SELECT {cols(RAW_RECORD)} FROM raw",
        "load_water_data": with_(raw, normal) + f"SELECT {RECORD_LIST} FROM norm WHERE {KNOWN} AND {COMPLETE}",
        "sample_json": with_(_payload(keys="event_id, ts"))
        + f"SELECT event_id, {_json(RECORD)} AS value FROM (SELECT * FROM pay ORDER BY ts, event_id LIMIT {Q.SAMPLE_ROWS})",
        "parse_datetime": with_(raw) + f"SELECT event_id, DATETIME, {PARSED_TIME} AS \"timestamp\" FROM raw",
        "coerce_types": with_(raw, normal) + f"SELECT event_id, {RECORD_LIST} FROM norm",
        "union_sources": with_() + f"SELECT event_id, {RECORD_LIST} FROM tel",
        "drop_unknown": with_() + f"SELECT event_id, {RECORD_LIST} FROM tel WHERE {KNOWN}",
        "drop_nulls": with_() + f"SELECT event_id, {RECORD_LIST} FROM tel WHERE {COMPLETE}",
        "labelled_only": with_() + f"SELECT event_id, {LABEL} FROM tel WHERE {LABEL} IN (0, 1)",
        "attack_rows": with_() + f"SELECT event_id, {RECORD_LIST} FROM tel WHERE {LABEL} = 1",
        "cleaning_report": with_()
        + f"SELECT count(*) AS rows_in, count(*) FILTER (WHERE NOT ({KNOWN})) AS dropped_unknown, "
        f"count(*) FILTER (WHERE {KNOWN} AND NOT ({COMPLETE})) AS dropped_null, "
        f"count(*) FILTER (WHERE {KNOWN} AND {COMPLETE}) AS rows_out FROM tel",
        # payloads
        "row_to_payload": with_(CLEAN, _payload("clean")) + f"SELECT event_id, {RECORD_LIST} FROM pay",
        "payload_json": with_(CLEAN, _payload("clean"))
        + f"SELECT event_id, {_json(RECORD)} AS value FROM pay WHERE {VALID}",
        "parse_json": with_(parsed) + f"SELECT key, {RECORD_LIST}, corrupt FROM parsed",
        "validate_payload": with_(pay)
        + "SELECT event_id, "
        + " + ".join(f"CAST(({t}) IS NOT NULL AS INTEGER)" for t in _problem_texts())
        + f" AS n_problems, concat_ws('; ', {', '.join(_problem_texts())}) AS problems FROM pay",
        "quarantine_payloads": with_(pay)
        + f"SELECT event_id, concat_ws('; ', {', '.join(_problem_texts())}) AS problems FROM pay WHERE NOT coalesce({VALID}, false)",
        "valid_payloads": with_(pay) + f"SELECT event_id, {RECORD_LIST} FROM pay WHERE {VALID}",
        "validation_summary": with_(pay) + _summary(),
        "csv_export_view": with_()
        + "SELECT event_id, \"timestamp\", "
        + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN printf('%.6f', CAST({c} AS DOUBLE)) END AS {c}" for c in SENSORS)
        + ", " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in [*STATUSES, LABEL]) + " FROM tel",
        # rules
        "tank_not_null": with_() + f"SELECT event_id, {cols(TANKS)} FROM tel WHERE {_present(TANKS)}",
        "alert_type": with_(FLAGGED) + "SELECT event_id, alert_type FROM fl",
        "disp_status": with_(FLAGGED) + f"SELECT event_id, alert_type, {cols(DISPLAYS)} FROM fl",
        "rule_catalog": with_(FLAGGED) + _catalog(),
        "rule_violations_long": with_(FLAGGED) + _violations(),
        "tank_band": with_() + _bands(),
        "alert_counts": with_(FLAGGED) + "SELECT alert_type, count(*) AS n FROM fl GROUP BY 1",
        "gold_alerts": with_(FLAGGED)
        + f"SELECT event_id, \"timestamp\", alert_type, ml_alert, {LABEL} FROM fl WHERE alert_type <> 'NORMAL' OR ml_alert = 1",
        "rule_vs_label": with_(FLAGGED)
        + f"SELECT alert_type, count(*) FILTER (WHERE {LABEL} = 0) AS normal, count(*) FILTER (WHERE {LABEL} = 1) AS attack, "
        f"count(*) FILTER (WHERE {LABEL} = -999) AS unknown FROM fl GROUP BY 1",
        "pressure_high": with_()
        + f"SELECT event_id, P_J415, CASE WHEN CAST(P_J415 AS DOUBLE) > {d(60)} THEN 'PRESSURE_HIGH' ELSE 'NORMAL' END AS pressure_alert FROM tel",
        "asset_head_gain": with_()
        + "SELECT event_id, "
        + ", ".join(f"CAST({b} AS DOUBLE) - CAST({a} AS DOUBLE) AS {asset}_gain" for asset, (a, b) in HEAD_PAIRS.items())
        + " FROM tel",
        # time series
        "telemetry_long": with_(FLAGGED) + points(POINT_FIELDS),
        "line_protocol": with_(FLAGGED) + _line(),
        "scan_measurement": with_(FLAGGED) + points(["L_T1"]),
        "range_abs": with_(FLAGGED)
        + points(["L_T1"]) + f" AND ts >= TIMESTAMP '{Q.RANGE_START}' AND ts < TIMESTAMP '{Q.RANGE_STOP}'",
        "range_alerts": with_(FLAGGED)
        + points(["L_T1"]) + f" AND ts >= TIMESTAMP '{Q.RANGE_START}' AND ts < TIMESTAMP '{Q.RANGE_STOP}' "
        f"AND alert_type IN ({', '.join(repr(r.stuck_off) for r in RULES[:2])})",
        "range_relative": with_(FLAGGED)
        + points(["L_T1"]) + " AND ts >= (SELECT max(ts) FROM fl) - INTERVAL '1 day'",
        "field_in": with_(FLAGGED) + points(Q.PUMP_FIELDS),
        "flux_keep": with_(FLAGGED) + long_("fl", TANKS, "alert_type, ts AS _time"),
        "flux_last": with_(FLAGGED) + _last(POINT_FIELDS),
        "series_limit": with_(FLAGGED, f"pts AS ({points([*TANKS, LABEL])})")
        + "SELECT *, CAST(row_number() OVER (PARTITION BY field, alert_type ORDER BY _time, event_id) AS INTEGER) AS rank "
        f"FROM pts QUALIFY rank <= {Q.SERIES_ROWS}",
        "flux_last_recent": with_(FLAGGED, RECENT) + _last(POINT_FIELDS).replace(" FROM fl ", " FROM recent "),
        "flux_pivot_recent": with_(FLAGGED, RECENT).rstrip() + _pivot().replace(" FROM fl ", " FROM recent "),
        "agg_window_range": with_(FLAGGED, f"means AS ({_hourly(RANGE)})")
        + f"SELECT least(_time, TIMESTAMP '{Q.RANGE_STOP_UNEVEN}') AS _time, alert_type, field, round(value, 6) AS value FROM means",
        "flux_pivot_latest": with_(FLAGGED).rstrip() + _pivot(),
        "series_count": with_(FLAGGED, f"pts AS ({points(POINT_FIELDS)})")
        + "SELECT alert_type, field, count(value) AS n FROM pts GROUP BY 1, 2",
        "field_sum": with_(FLAGGED, f"pts AS ({points(Q.PUMP_FIELDS)})")
        + "SELECT field, sum(value) AS value FROM pts GROUP BY 1",
        "agg_window_mean": with_(FLAGGED, f"means AS ({_hourly()})")
        + "SELECT _time, alert_type, field, round(value, 6) AS value FROM means",
        "agg_window_max": with_(FLAGGED)
        + "SELECT time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS _time, alert_type, 'ml_alert' AS field, "
        f"CAST(max({verdict}) AS DOUBLE) AS value FROM fl GROUP BY 1, 2",
        "tank_violations": with_(FLAGGED).rstrip() + _violation_windows(),
        "ml_status_latest": with_(FLAGGED)
        + f"SELECT alert_type, _time, value, CASE value WHEN 1 THEN 'ATTACK DETECTED' WHEN 0 THEN 'NORMAL' END AS status FROM "
        f"(SELECT alert_type, max(ts) AS _time, CAST(arg_max({verdict}, (ts, event_id)) AS INTEGER) AS value FROM fl "
        "WHERE ts >= (SELECT max(ts) FROM fl) - INTERVAL '2 minute' GROUP BY 1)",
        # features and metrics
        "score_default": with_() + "SELECT event_id, CAST(0 AS INTEGER) AS ml_alert FROM tel",
        "feature_fill": with_() + "SELECT event_id, " + ", ".join(f"{_filled(f)} AS {f}" for f in FEATURES) + " FROM tel",
        "feature_diff": with_() + f"SELECT event_id, {diffs} FROM tel",
        "feature_rolling_mean": with_()
        + f"SELECT event_id, {means} FROM tel WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN {Q.ROLLING_ROWS - 1} PRECEDING AND CURRENT ROW)",
        "label_distribution": with_() + f"SELECT {LABEL}, count(*) AS n FROM tel GROUP BY 1",
        "label_share": with_()
        + f"SELECT *, round({d(100)} * normal / total, 1) AS normal_percent, round({d(100)} * attack / total, 1) AS attack_percent "
        f"FROM (SELECT count(*) AS total, count(*) FILTER (WHERE {LABEL} = 0) AS normal, "
        f"count(*) FILTER (WHERE {LABEL} = 1) AS attack FROM tel WHERE {LABEL} IN (0, 1))",
        "class_weights": with_(CLEAN, TRAINING)
        + f"SELECT {LABEL}, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 6) AS weight "
        f"FROM (SELECT {LABEL}, count(*) AS n FROM training GROUP BY 1)",
        "stratified_split": with_(CLEAN, TRAINING).rstrip() + _split(),
        "confusion_matrix": with_(FLAGGED, JUDGED, CONFUSION) + "SELECT * FROM cm",
        "classification_report": with_(FLAGGED, JUDGED, CONFUSION).rstrip() + _report(),
        "topk_signal": with_() + _signals(),
        # health
        "dq_recent": with_(FLAGGED)
        + "SELECT count(*) AS n, count(*) > 0 AS ok FROM fl WHERE ts >= (SELECT max(ts) FROM fl) - INTERVAL '60 second'",
        "dq_field_present": with_(FLAGGED).rstrip() + _presence(),
        "dq_throughput": with_(FLAGGED)
        + "SELECT w + INTERVAL '1 minute' AS _time, count(L_T1) AS n, count(L_T1) >= "
        f"{Q.MIN_PER_MINUTE} AS ok FROM (SELECT unnest(generate_series(date_trunc('minute', min(ts)), date_trunc('minute', max(ts)), "
        "INTERVAL '1 minute')) AS w FROM fl) LEFT JOIN fl ON date_trunc('minute', ts) = w GROUP BY w",
        "dq_load_checks": with_(raw, normal).rstrip() + _load_checks(),
        "dq_payload_checks": with_(pay).rstrip() + _payload_checks(),
        # scenarios
        "level_drift": with_(PLACED, "runs AS (SELECT *, position // 60 AS run FROM placed)")
        + f"SELECT event_id, run, {_forced('L_T1', S.SCENARIOS[0].forced['L_T1'], 'run')} AS level FROM runs",
        "wandering_level": with_(PLACED, _wandering())
        + f"SELECT event_id, run, CAST(CAST(level AS DOUBLE) / {d(10000)} AS FLOAT) AS level FROM walk",
        **{f"scn_a{n}": _scenario(n) for n in range(1, len(S.SCENARIOS) + 1)},
        "scenario_union": with_(PLACED, mix) + f"SELECT key, event_id, scenario, {cols(READINGS)}, {LABEL} FROM mix",
        "scenario_counts": with_(PLACED, mix) + "SELECT scenario, count(*) AS n FROM mix GROUP BY 1",
        "scenario_rule_coverage": with_(PLACED, mix)
        + f"SELECT scenario, count(*) AS n, count(*) FILTER (WHERE a <> 'NORMAL') AS caught, "
        "round(CAST(count(*) FILTER (WHERE a <> 'NORMAL') AS DOUBLE) / count(*), 6) AS share "
        f"FROM (SELECT scenario, {_alert()} AS a FROM mix WHERE scenario <> 'NORMAL' AND base_alert = 'NORMAL') GROUP BY 1",
        # learning: what is held out, and the form of the answer; predictions have no SQL meaning
        "ml_held_out": f"SELECT event_id, {LABEL}, true AS scored FROM ("
        + with_(CLEAN, TRAINING).rstrip() + _split() + ") WHERE split = 'validation'",
        "ml_importance_ranks": f"SELECT CAST(unnest(range(1, {Q.TOP_K + 1})) AS INTEGER) AS rank, true AS in_range, true AS ordered "
        "WHERE EXISTS (SELECT 1 FROM events)",
        "ml_linear_scores": with_() + f"SELECT event_id, {_linear()} AS ml_alert FROM tel",
        "rule_vs_linear": with_(FLAGGED) + f"SELECT alert_type, {_linear()} AS ml_alert, count(*) AS n FROM fl GROUP BY 1, 2",
        # streams
        "stream_alert_counts": with_(*stream) + "SELECT alert_type, count(*) AS n FROM fl GROUP BY 1",
        "stream_replay_counts": with_(*stream) + "SELECT alert_type, count(*) AS n FROM fl GROUP BY 1",
        "stream_distinct_counts": with_(*stream) + "SELECT alert_type, count(*) AS n FROM fl GROUP BY 1",
        "stream_last_values": with_(*stream, timed)
        + " UNION ALL ".join(
            f"SELECT alert_type, '{f}' AS field, max(et) AS _time, arg_max(CAST({f} AS DOUBLE), (et, key || ':')) AS value "
            f"FROM st WHERE {f} IS NOT NULL GROUP BY alert_type" for f in POINT_FIELDS
        ),
        "rollup_window_mean": with_(*stream, timed) + _rolled("avg", "1 hour", "round(value, 6) AS value"),
        "rollup_window_max": with_(*stream, timed) + _rolled("max", "1 day", "value"),
        "stream_silences": with_(*stream, timed, _silent("st", "et", "INTERVAL '30 minute'")) + SILENT,
        "silent_series": with_(FLAGGED, _silent("fl", "ts", "INTERVAL '0 minute'")) + SILENT,
        "stream_window_mean": with_(*stream, timed)
        + "SELECT time_bucket(INTERVAL '1 day', et) + INTERVAL '1 day' AS _time, alert_type, "
        "round(avg(CAST(L_T1 AS DOUBLE)), 6) AS value, count(L_T1) AS n FROM st GROUP BY 1, 2 "
        "HAVING _time <= (SELECT max(et) FROM st) - INTERVAL '1 hour'",
    }
    return sql
