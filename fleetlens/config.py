"""Names, thresholds and constants. Everything here is a parameter of some operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Keys:
    """Column names that identify a reading."""

    entity: str = "turbine_id"
    time: str = "timestamp"
    site: str = "farm_id"

    @property
    def reading(self) -> list[str]:
        return [self.entity, self.time]


# The raw reading schema, in its published column order.
_STRINGS = {
    "event_id", "turbine_id", "farm_id", "turbine_model",
    "operating_state", "alarm_code", "alarm_severity", "failure_type",
}
_FLAGS = {
    "availability_flag", "grid_connected_flag", "maintenance_mode_flag", "alarm_flag", "failure_flag",
}
RAW_COLUMNS = [
    "event_id", "turbine_id", "farm_id", "timestamp", "turbine_model", "turbine_age_years", "wind_speed",
    "wind_direction", "ambient_temperature", "humidity", "atmospheric_pressure", "air_density", "precipitation",
    "rotor_speed_rpm", "generator_speed_rpm", "blade_pitch_angle", "yaw_angle", "yaw_error", "gearbox_temperature",
    "generator_temperature", "bearing_temperature", "main_bearing_temperature", "nacelle_temperature",
    "brake_temperature", "hydraulic_pressure", "hydraulic_oil_temperature", "gearbox_oil_temperature",
    "gearbox_oil_pressure", "vibration_x", "vibration_y", "vibration_z", "vibration_rms", "vibration_peak",
    "vibration_kurtosis", "active_power_kw", "reactive_power_kvar", "apparent_power_kva", "voltage_v", "current_a",
    "power_factor", "grid_frequency_hz", "generator_load_pct", "electrical_efficiency", "operating_state",
    "availability_flag", "grid_connected_flag", "maintenance_mode_flag", "alarm_flag", "alarm_code", "alarm_severity",
    "failure_flag", "failure_type", "operating_hours", "health_status",
]

#: Day of a reading, by which the raw table is partitioned.
EVENT_DATE = "event_date"

INGESTION_SCHEMA = T.StructType(
    [
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("ingestion_date", T.DateType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("source_file", T.StringType()),
    ]
)


def raw_schema(keys: Keys = Keys(), time_type: T.DataType = T.TimestampType()) -> T.StructType:
    """The fixed raw schema. Flags are 0/1 integers so they can be summed and compared."""

    def field(name: str) -> T.StructField:
        if name == "timestamp":
            return T.StructField(keys.time, time_type)
        if name in _STRINGS:
            return T.StructField(name, T.StringType())
        if name in _FLAGS:
            return T.StructField(name, T.IntegerType())
        return T.StructField(name, T.DoubleType())

    return T.StructType([field(c) for c in RAW_COLUMNS])


@dataclass(frozen=True)
class RangeRule:
    """`low <= column <= high`; a missing value passes. `gates` rules decide validity."""

    flag: str
    column: str
    low: float
    high: float
    penalty: int = 0
    gates: bool = True


@dataclass(frozen=True)
class OutlierRule:
    """True when any column exceeds its limit; a missing value does not."""

    flag: str
    limits: tuple[tuple[str, float], ...]
    penalty: int


@dataclass(frozen=True)
class QualityRules:
    """The row-level quality model. Thresholds are fixed values of the turbine preset."""

    ranges: tuple[RangeRule, ...] = (
        RangeRule("is_wind_speed_valid", "wind_speed", 0.0, 50.0, 20),
        RangeRule("is_temperature_valid", "gearbox_temperature", -50.0, 150.0, 20),
        RangeRule("is_power_valid", "power_output", 0.0, 3.0, 15),
        RangeRule("is_vibration_valid", "vibration_x", 0.0, 2.0, gates=False),
    )
    outliers: tuple[OutlierRule, ...] = (
        OutlierRule("is_temp_outlier", (("gearbox_temperature", 120.0), ("generator_temperature", 110.0)), 15),
        OutlierRule(
            "is_vibration_outlier", (("vibration_x", 1.5), ("vibration_y", 1.5), ("vibration_z", 1.2)), 10
        ),
    )
    critical: tuple[str, ...] = (
        "wind_speed", "power_output", "gearbox_temperature", "generator_temperature", "rotor_speed",
    )
    missing_penalty: int = 4
    pass_mark: int = 60


# Daily figures, as (name, aggregate, expression over a valid reading).
DAILY_MEASURES: tuple[tuple[str, str, str], ...] = (
    ("average_wind_speed", "avg", "wind_speed"),
    ("max_wind_speed", "max", "wind_speed"),
    ("average_power", "avg", "power_output"),
    ("total_energy", "sum", "power_output"),
    ("average_temperature", "avg", "gearbox_temperature"),
    ("max_gearbox_temperature", "max", "gearbox_temperature"),
    ("average_vibration", "avg", "sqrt(vibration_x * vibration_x + vibration_y * vibration_y + vibration_z * vibration_z)"),
    ("failure_count", "sum", "failure_flag"),
    ("maintenance_count", "sum", "maintenance_flag"),
    ("record_count", "count", "1"),
)

# Points lost by symptoms and per unit of vibration, in the order in which they are taken off.
HEALTH_LOSSES: tuple[tuple[str, float], ...] = (
    ("gearbox_temperature > 100", 15.0),
    ("generator_temperature > 90", 10.0),
    ("bearing_temperature > 80", 10.0),
    ("vibration_x", 20.0),
    ("vibration_y", 20.0),
    ("vibration_z", 15.0),
    ("wind_speed > 10 and power_output < 1.0", 10.0),
)
#: Those of them that are measurements; the others are conditions.
HEALTH_MEASURED = ("vibration_x", "vibration_y", "vibration_z")

# Alarms by falling priority; {rms} stands for the vibration magnitude.
ALARMS: tuple[tuple[str, str], ...] = (
    ("gearbox_temperature > 100", "ALM-GEARBOX-TEMP"),
    ("generator_temperature > 95", "ALM-GENERATOR-TEMP"),
    ("{rms} > 1.0", "ALM-HIGH-VIBRATION"),
    ("hydraulic_pressure < 120", "ALM-HYDRAULIC-PRESSURE"),
)
# Severity by the first bound that the health is under.
SEVERITIES: tuple[tuple[float, str], ...] = ((0.3, "CRITICAL"), (0.5, "WARNING"), (0.7, "INFO"))

# The state a machine should report; the first condition that holds decides.
STATES: tuple[tuple[str, str], ...] = (
    ("wind_speed < 3", "STOPPED"),
    ("health_status < 0.3", "FAULT"),
    ("wind_speed > 25", "EMERGENCY_STOP"),
    ("wind_speed < 4", "STARTING"),
    ("true", "RUNNING"),
)
# The flags it should set.
STATUS_FLAGS: dict[str, str] = {
    "availability_flag": "health_status >= 0.3",
    "grid_connected_flag": "operating_state = 'RUNNING'",
    "maintenance_mode_flag": "health_status >= 0.3 and health_status < 1",
    "alarm_flag": "health_status < 0.7",
    "failure_flag": "health_status < 0.3",
}
# Electrical quantities that follow from active power and voltage, and the density of air.
ELECTRICAL: dict[str, str] = {
    "reactive_kvar": "active_power_kw * 0.08D",
    "apparent_kva": "sqrt(pow(active_power_kw, 2) + pow(active_power_kw * 0.08D, 2))",
    "power_factor_calc": "case when active_power_kw <> 0 then active_power_kw / sqrt(pow(active_power_kw, 2) + pow(active_power_kw * 0.08D, 2)) "
    "when active_power_kw = 0 then 1D end",
    "load_pct": "active_power_kw / 2500D * 100D",
    "current_calc": "case when voltage_v > 0 then active_power_kw * 1000D / (voltage_v * (sqrt(3D) * 0.99D)) else 0D end",
}
AIR_DENSITY = "1.225D * (atmospheric_pressure / 1013D) * (288D / (ambient_temperature + 273D))"

# Working names of raw columns, as SQL.
ALIASES: dict[str, str] = {
    "rotor_speed": "rotor_speed_rpm",
    "generator_speed": "generator_speed_rpm",
    "active_power": "active_power_kw",
    "reactive_power": "reactive_power_kvar",
    "voltage": "voltage_v",
    "current": "current_a",
    "pressure": "atmospheric_pressure",
    "power_output": "active_power_kw / 1000.0D",
    "oil_temperature": "(hydraulic_oil_temperature + gearbox_oil_temperature) / 2.0D",
    "maintenance_flag": "cast(coalesce(operating_state, '') = 'MAINTENANCE' as int)",
}

# What a missing sensor value becomes once the quality flags are set.
SILVER_DEFAULTS: dict[str, float] = {
    "wind_speed": 0.0,
    "power_output": 0.0,
    "gearbox_temperature": 50.0,
    "generator_temperature": 45.0,
    "bearing_temperature": 40.0,
    "vibration_x": 0.3,
    "vibration_y": 0.3,
    "vibration_z": 0.2,
    "rotor_speed": 0.0,
    "generator_speed": 0.0,
}

# Measurements that reach the training table.
TRAINING_COLUMNS = [
    "wind_speed", "wind_direction", "ambient_temperature", "rotor_speed", "generator_speed", "gearbox_temperature",
    "generator_temperature", "bearing_temperature", "nacelle_temperature", "oil_temperature", "hydraulic_pressure",
    "vibration_x", "vibration_y", "vibration_z", "power_output", "active_power", "blade_pitch_angle",
    "operating_hours", "quality_score",
]


def label_name(horizon_hours: int = 24) -> str:
    return f"failure_within_next_{horizon_hours}_hours"


@dataclass(frozen=True)
class TableLayout:
    """Resolves stage tables to names; a catalog prefix is optional."""

    catalog: str | None = None
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    ml: str = "ml"
    monitoring: str = "monitoring"

    def name(self, schema: str, table: str) -> str:
        return ".".join(p for p in (self.catalog, schema, table) if p)

    @property
    def schemas(self) -> list[str]:
        return [self.name(s, "").rstrip(".") for s in (self.bronze, self.silver, self.gold, self.ml, self.monitoring)]

    @property
    def readings_raw(self) -> str:
        return self.name(self.bronze, "turbine_sensor_raw")

    @property
    def readings_clean(self) -> str:
        return self.name(self.silver, "turbine_sensor_clean")

    @property
    def daily_kpi(self) -> str:
        return self.name(self.gold, "turbine_daily_kpi")

    @property
    def health(self) -> str:
        return self.name(self.gold, "turbine_health")

    @property
    def training(self) -> str:
        return self.name(self.gold, "turbine_failure_training")

    @property
    def features(self) -> str:
        return self.name(self.ml, "turbine_failure_features")

    @property
    def model_comparison(self) -> str:
        return self.name(self.ml, "model_comparison")

    @property
    def champions(self) -> str:
        return self.name(self.ml, "champion_history")

    @property
    def predictions(self) -> str:
        return self.name(self.gold, "turbine_failure_predictions")

    def monitor(self, check: str) -> str:
        return self.name(self.monitoring, check)


@dataclass(frozen=True)
class FolderLayout(TableLayout):
    """The same tables as parquet folders under `root`, for sessions without a catalog."""

    root: str = ""

    def name(self, schema: str, table: str) -> str:
        return f"{self.root}/{schema}/{table}"
