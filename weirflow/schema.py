"""Column lists, record schemas and the constant dimensions of the plant."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# --- Fixed values: sensor names, in record order -------------------------------------------------
ACTUATORS = [f"PU{i}" for i in range(1, 12)] + ["V2"]
TANKS = [f"L_T{i}" for i in range(1, 8)]
FLOWS = [f"F_{a}" for a in ACTUATORS]
STATUSES = [f"S_{a}" for a in ACTUATORS]
PRESSURES = [
    "P_J280", "P_J269", "P_J300", "P_J256", "P_J289", "P_J415",
    "P_J302", "P_J306", "P_J307", "P_J317", "P_J14", "P_J422",
]
LABEL = "ATT_FLAG"
UNKNOWN_LABEL = -999
RAW_TIME = "DATETIME"

SENSORS = TANKS + FLOWS + PRESSURES
FEATURES = TANKS + FLOWS + STATUSES
_FLOW_STATUS = [c for pair in zip(FLOWS, STATUSES) for c in pair]
RECORD = ["timestamp", *TANKS, *_FLOW_STATUS, *PRESSURES, LABEL]
RAW_RECORD = [RAW_TIME, *RECORD[1:]]

# --- Fixed values: control rules -----------------------------------------------------------------
# An actuator must be closed above `high` and open below `low`; first rule in this order wins.


class Rule(NamedTuple):
    priority: int
    actuator: str
    level: str
    low: float
    high: float

    @property
    def status(self) -> str:
        return f"S_{self.actuator}"

    @property
    def display(self) -> str:
        return f"disp_{self.actuator}"

    @property
    def stuck_on(self) -> str:
        return f"{self.actuator}_STUCK_ON"

    @property
    def stuck_off(self) -> str:
        return f"{self.actuator}_STUCK_OFF"


RULES = [
    Rule(1, "PU1", "L_T1", 4.0, 6.3),
    Rule(2, "PU2", "L_T1", 1.0, 4.5),
    Rule(3, "V2", "L_T2", 0.5, 5.5),
    Rule(4, "PU4", "L_T3", 3.0, 5.3),
    Rule(5, "PU5", "L_T3", 1.0, 3.5),
    Rule(6, "PU6", "L_T4", 2.0, 3.5),
    Rule(7, "PU7", "L_T4", 3.0, 4.5),
    Rule(8, "PU8", "L_T5", 1.5, 4.0),
    Rule(9, "PU10", "L_T7", 2.5, 4.8),
    Rule(10, "PU11", "L_T7", 1.0, 3.0),
]
NORMAL = "NORMAL"
ALERT_CODE = 2
DISPLAYS = [r.display for r in RULES]

# --- Fixed values: display bands per tank (low, safe low, safe high, high) -----------------------
BANDS = {
    "L_T1": (0.0, 1.0, 4.0, 6.3),
    "L_T2": (0.0, 0.5, 2.5, 5.5),
    "L_T3": (0.0, 1.0, 3.0, 5.3),
    "L_T4": (0.0, 2.0, 3.0, 4.5),
    "L_T5": (0.0, 1.5, 2.5, 4.0),
    "L_T6": (0.0, 0.5, 3.0, 5.2),
    "L_T7": (0.0, 1.0, 2.5, 4.8),
}

# --- Fixed values: out-of-band limits used by the tank charts (T6 has no upper one) --------------
VIOLATION_LIMITS = {
    "L_T1": (1.0, 6.3),
    "L_T2": (0.5, 5.5),
    "L_T3": (1.0, 5.3),
    "L_T4": (2.0, 4.5),
    "L_T5": (1.5, 4.0),
    "L_T6": (4.5, None),
    "L_T7": (1.0, 4.8),
}

# --- Fixed values: physically valid ranges, both ends included -----------------------------------
LEVEL_RANGE = (0.0, 10.0)
FLOW_RANGE = (0.0, 500.0)
PRESSURE_RANGE = (-5.0, 100.0)
RANGES = {
    **{c: LEVEL_RANGE for c in TANKS},
    **{c: FLOW_RANGE for c in FLOWS},
    **{c: PRESSURE_RANGE for c in PRESSURES},
}

# --- Fixed values: pressure sensors on both sides of an asset (upstream, downstream) -------------
HEAD_PAIRS = {
    "PU2": ("P_J280", "P_J269"),
    "PU5": ("P_J300", "P_J256"),
    "PU6": ("P_J289", "P_J415"),
    "PU9": ("P_J302", "P_J306"),
    "PU10": ("P_J307", "P_J317"),
    "V2": ("P_J14", "P_J422"),
}

# --- Fixed values: names seen by downstream consumers --------------------------------------------
MEASUREMENT = "water_telemetry"
PRESSURE_HIGH_SENSOR, PRESSURE_HIGH_LIMIT = "P_J415", 60.0

FLOAT_FIELDS = SENSORS
INT_FIELDS = [*STATUSES, LABEL, *DISPLAYS, "ml_alert"]
POINT_FIELDS = FLOAT_FIELDS + INT_FIELDS


def spark_type(column: str) -> T.DataType:
    if column in SENSORS:
        return T.FloatType()
    if column in STATUSES or column == LABEL:
        return T.IntegerType()
    return T.StringType()


#: Typed wide record carried by the JSON messages.
RECORD_SCHEMA = T.StructType([T.StructField(c, spark_type(c)) for c in RECORD])
