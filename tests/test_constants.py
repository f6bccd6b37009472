"""Values that must be what they are, written out once more: the SQL twins share them with the code."""

from weirflow.operators.scenarios import SCENARIOS
from weirflow.schema import BANDS, MEASUREMENT, RANGES, RULES, VIOLATION_LIMITS


def test_control_rules():
    assert [tuple(r) for r in RULES] == [
        (1, "PU1", "L_T1", 4.0, 6.3), (2, "PU2", "L_T1", 1.0, 4.5), (3, "V2", "L_T2", 0.5, 5.5), (4, "PU4", "L_T3", 3.0, 5.3),
        (5, "PU5", "L_T3", 1.0, 3.5), (6, "PU6", "L_T4", 2.0, 3.5), (7, "PU7", "L_T4", 3.0, 4.5), (8, "PU8", "L_T5", 1.5, 4.0),
        (9, "PU10", "L_T7", 2.5, 4.8), (10, "PU11", "L_T7", 1.0, 3.0),
    ]


def test_bands_and_limits():
    assert BANDS == {
        "L_T1": (0.0, 1.0, 4.0, 6.3), "L_T2": (0.0, 0.5, 2.5, 5.5), "L_T3": (0.0, 1.0, 3.0, 5.3), "L_T4": (0.0, 2.0, 3.0, 4.5),
        "L_T5": (0.0, 1.5, 2.5, 4.0), "L_T6": (0.0, 0.5, 3.0, 5.2), "L_T7": (0.0, 1.0, 2.5, 4.8),
    }
    assert VIOLATION_LIMITS == {
        "L_T1": (1.0, 6.3), "L_T2": (0.5, 5.5), "L_T3": (1.0, 5.3), "L_T4": (2.0, 4.5), "L_T5": (1.5, 4.0), "L_T6": (4.5, None),
        "L_T7": (1.0, 4.8),
    }


def test_ranges():
    wanted = {"L": (0.0, 10.0), "F": (0.0, 500.0), "P": (-5.0, 100.0)}
    assert len(RANGES) == 31 and all(tuple(r) == wanted[c[0]] for c, r in RANGES.items())
    assert MEASUREMENT == "water_telemetry"


def test_scenarios():
    assert [(s.name, s.length, sorted(s.forced)[:1]) for s in SCENARIOS] == [
        ("A1_PU1_STUCK_ON", 60, ["F_PU1"]), ("A2_PU4_PU5_STUCK_OFF", 60, ["F_PU4"]), ("A3_SENSOR_SPOOF_T4", 70, ["F_PU6"]),
        ("A4_V2_VALVE_ATTACK", 60, ["F_V2"]), ("A5_T5_CASCADE", 70, ["F_PU10"]), ("A6_FLOW_INJECTION", 60, ["F_PU3"]),
        ("A7_PRESSURE_COLLAPSE", 60, ["P_J14"]), ("A8_MULTI_TANK", 70, ["F_PU1"]),
    ]
    assert tuple(SCENARIOS[0].forced["L_T1"]) == (6.4, 0.03, 0.01, None, 6.5, True)
    assert tuple(SCENARIOS[1].forced["L_T3"]) == (2.8, -0.04, 0.01, 0.2, None, True)
    assert tuple(SCENARIOS[3].forced["L_T2"]) == (4.5, -0.06, 0.01, 0.1, None, True)
    assert tuple(SCENARIOS[6].forced["P_J415"])[:2] == (1.8, 0.4)
