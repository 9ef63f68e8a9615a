"""Common table expressions of the checking SQL, and rounding shared by both sides.

The SQL is written for DuckDB. Numbers with an exponent are DOUBLE literals there; `+ 0e0`
turns a negative zero left by rounding into zero. Sensor values are short decimals, so means
of a few of them often end in an exact 5 at the digit that is rounded; the nudge takes such
ties off the edge, where the last bit of a sum would decide.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.config import SILVER_DEFAULTS, TRAINING_COLUMNS, label_name
from fleetlens.catalog.readings import MAPPING

DIGITS = 6
NUDGE = 1e-9
LABEL = label_name()
FLAGS = {c for c in MAPPING if c.endswith("_flag")}


def _mapped(name: str, expression: str) -> str:
    value = expression.format(S="varchar")
    return f"cast({value} as integer) as {name}" if name in FLAGS else f"{value} as {name}"


READINGS = "readings as (select " + ", ".join(_mapped(n, e) for n, e in MAPPING.items()) + " from events)"

ALIASED = """aliased as (select *, rotor_speed_rpm as rotor_speed, generator_speed_rpm as generator_speed,
 active_power_kw as active_power, reactive_power_kvar as reactive_power, voltage_v as voltage, current_a as current,
 atmospheric_pressure as pressure, active_power_kw / 1000e0 as power_output,
 (hydraulic_oil_temperature + gearbox_oil_temperature) / 2e0 as oil_temperature,
 case when operating_state = 'MAINTENANCE' then 1 else 0 end as maintenance_flag from readings)"""

FLAGGED = """ruled as (select *,
 wind_speed is null or (wind_speed >= 0 and wind_speed <= 50) as is_wind_speed_valid,
 gearbox_temperature is null or (gearbox_temperature >= -50 and gearbox_temperature <= 150) as is_temperature_valid,
 power_output is null or (power_output >= 0 and power_output <= 3) as is_power_valid,
 vibration_x is null or (vibration_x >= 0 and vibration_x <= 2) as is_vibration_valid,
 coalesce(gearbox_temperature > 120, false) or coalesce(generator_temperature > 110, false) as is_temp_outlier,
 coalesce(vibration_x > 1.5e0, false) or coalesce(vibration_y > 1.5e0, false) or coalesce(vibration_z > 1.2e0, false)
   as is_vibration_outlier,
 (case when wind_speed is null then 1 else 0 end) + (case when power_output is null then 1 else 0 end)
 + (case when gearbox_temperature is null then 1 else 0 end) + (case when generator_temperature is null then 1 else 0 end)
 + (case when rotor_speed is null then 1 else 0 end) as missing_count from aliased),
scored_rows as (select *, missing_count > 0 as has_missing,
 (not is_wind_speed_valid) or (not is_temperature_valid) or (not is_power_valid) or is_temp_outlier
   or is_vibration_outlier as is_sensor_anomaly,
 greatest(0, 100 - (case when is_wind_speed_valid then 0 else 20 end) - (case when is_temperature_valid then 0 else 20 end)
  - (case when is_power_valid then 0 else 15 end) - (case when is_temp_outlier then 15 else 0 end)
  - (case when is_vibration_outlier then 10 else 0 end) - 4 * missing_count) as quality_score from ruled),
flagged as (select *, is_wind_speed_valid and is_temperature_valid and is_power_valid and quality_score >= 60
 as is_valid_record from scored_rows)"""

SILVER = (
    "silver as (select * replace ("
    + ", ".join(f"coalesce({c}, {v!r}e0) as {c}" for c, v in SILVER_DEFAULTS.items())
    + ") from flagged)"
)

LABELLED = f"""labelled as (select s.*, case when exists (select 1 from silver f where f.failure_flag = 1
  and f.turbine_id = s.turbine_id and epoch(date_trunc('second', f.reading_ts)) between
  epoch(date_trunc('second', s.reading_ts)) and epoch(date_trunc('second', s.reading_ts)) + 86400)
  then 1 else 0 end as {LABEL} from silver s)"""

TRAINING = (
    f"training as (select turbine_id, farm_id, reading_ts, {', '.join(TRAINING_COLUMNS)}, {LABEL} "
    "from labelled where failure_flag = 0)"
)

SCORED = f"""scored as (select event_id, turbine_id, farm_id, reading_ts, {LABEL} as label,
 cast((cast(event_id as bigint) * 61) % 1001 as double) / 1000e0 as failure_probability,
 case when (cast(event_id as bigint) * 61) % 1001 >= 500 then 1 else 0 end as prediction
 from labelled where failure_flag = 0)"""

# Four scorers over the same readings stand in for trained models.
MODEL_SCORES = f"""vibes as (select *, sqrt(vibration_x * vibration_x + vibration_y * vibration_y + vibration_z * vibration_z) as vib
 from labelled where failure_flag = 0),
model_scores as (
 select 'hashed' as model_name, farm_id, {LABEL} as label, cast((cast(event_id as bigint) * 61) % 1001 as double) / 1000e0 as score, 0.5e0 as cut from vibes
 union all select 'temperature', farm_id, {LABEL}, gearbox_temperature / 160e0, 0.5e0 from vibes
 union all select 'vibration', farm_id, {LABEL}, least(vib / 3e0, 1e0), 0.2e0 from vibes
 union all select 'health', farm_id, {LABEL}, 1e0 - health_status, 0.1e0 from vibes),
model_rows as (select model_name, farm_id, label, score, case when score >= cut then 1 else 0 end as prediction from model_scores)"""

_CHAIN = {
    "readings": READINGS, "aliased": ALIASED, "flagged": FLAGGED, "silver": SILVER,
    "labelled": LABELLED, "training": TRAINING, "scored": SCORED, "models": MODEL_SCORES,
}


def over(stage: str, body: str, *more: str) -> str:
    """SQL on top of everything up to `stage`; `more` holds further table expressions."""
    names = list(_CHAIN)
    parts = [_CHAIN[n] for n in names[: names.index(stage) + 1]]
    return "with recursive " + ",\n".join([*parts, *more]) + "\n" + body


def rounded_sql(body: str, columns: Iterable[str]) -> str:
    listed = ", ".join(f"round({c} + {NUDGE!r}, {DIGITS}) + 0e0 as {c}" for c in columns)
    return f"select * replace ({listed}) from ({body})"


def rounded(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: _round(F.col(c) + NUDGE) for c in columns})


def _round(value: Column) -> Column:
    """`value` to `DIGITS` places, halves away from zero, as the SQL engine finds it: the nearest whole number over a power of ten.

    Spark's `round` makes a decimal of every double, over a third of the last stage of the feature table. It is left the numbers
    whose digits a whole number does not hold.
    """
    power = float(10**DIGITS)
    scaled = value * power
    whole = F.when(scaled >= 0, F.floor(scaled + 0.5)).otherwise(F.ceil(scaled - 0.5))
    return F.when(F.abs(scaled) < float(1 << 50), whole / power).otherwise(F.round(value, DIGITS))
