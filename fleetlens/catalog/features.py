"""Time-series features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.catalog import query
from fleetlens.catalog.data import CHUNK, FRAME_CHUNK, WHOLE_ROWS, stored_training, training
from fleetlens.catalog.sql import over, rounded, rounded_sql
from fleetlens.operators import features
from fleetlens.catalog.readings import KEYS, readings

_ID = ["turbine_id", "reading_ts"]
_MEANS = [r.name for r in features.ROLLING if r.stat == "avg"]
_STDS = [r.name for r in features.ROLLING if r.stat == "stddev"]
_LAGS = [lag.name for lag in features.LAGS]
_DELTAS = list(features.DELTAS)
_DOMAIN = ["mechanical_stress_index", "thermal_stress_index", "generator_load_factor", "speed_ratio", "turbine_efficiency"]

_BASE = """base as (select *, sqrt(vibration_x * vibration_x + vibration_y * vibration_y + vibration_z * vibration_z)
 as mechanical_stress_index from training)"""


def _rolled(short: str, long: str, order: str) -> str:
    return f"""rolled as (select *, avg(gearbox_temperature) over s as gearbox_temp_avg_1h, avg(gearbox_temperature) over l as gearbox_temp_avg_6h,
 stddev_samp(gearbox_temperature) over s as gearbox_temp_std_1h, avg(generator_temperature) over s as generator_temp_avg_1h,
 avg(generator_temperature) over l as generator_temp_avg_6h, avg(bearing_temperature) over s as bearing_temp_avg_1h,
 avg(mechanical_stress_index) over s as vibration_avg_1h, avg(mechanical_stress_index) over l as vibration_avg_6h,
 stddev_samp(mechanical_stress_index) over s as vibration_std_1h, avg(power_output) over s as power_avg_1h,
 avg(power_output) over l as power_avg_6h, stddev_samp(power_output) over s as power_std_1h,
 avg(wind_speed) over s as wind_speed_avg_1h, avg(wind_speed) over l as wind_speed_avg_6h
 from (select *, cast(epoch(date_trunc('second', reading_ts)) as bigint) as sec from base)
 window s as (partition by turbine_id order by {order} {short}), l as (partition by turbine_id order by {order} {long}))"""


_ROWS = _rolled("rows between 6 preceding and current row", "rows between 36 preceding and current row", "reading_ts")
_TIME = _rolled("range between 86400 preceding and current row", "range between 604800 preceding and current row", "sec")

_LAGGED = """lagged as (select *, lag(gearbox_temperature, 1) over w as gearbox_temp_lag_1, lag(gearbox_temperature, 6) over w as gearbox_temp_lag_6,
 lag(gearbox_temperature, 12) over w as gearbox_temp_lag_12, lag(vibration_x, 1) over w as vibration_x_lag_1,
 lag(vibration_x, 6) over w as vibration_x_lag_6, lag(power_output, 1) over w as power_lag_1, lag(power_output, 6) over w as power_lag_6
 from rolled window w as (partition by turbine_id order by reading_ts))"""

_DELTA_SQL = (
    "gearbox_temperature - gearbox_temp_lag_1 as gearbox_temp_delta, vibration_x - vibration_x_lag_1 as vibration_delta, "
    "power_output - power_lag_1 as power_delta"
)
_DOMAIN_SQL = (
    "(gearbox_temperature - ambient_temperature) / 100e0 as thermal_stress_index, power_output / 2.5e0 as generator_load_factor, "
    "case when rotor_speed > 0 then generator_speed / rotor_speed else 0e0 end as speed_ratio, "
    "case when wind_speed > 3 then power_output / (wind_speed * wind_speed * wind_speed + 0.1e0) else 0e0 end as turbine_efficiency"
)
_ANOMALY_SQL = "abs(gearbox_temperature - gearbox_temp_avg_6h) / (gearbox_temp_std_1h + 1) as temp_anomaly_score"


def _sql(columns: list[str], source: str, *tables: str, extra: str = "") -> str:
    listed = ", ".join(_ID + [c for c in columns if not extra or f" as {c}" not in extra])
    return over("training", rounded_sql(f"select {listed}{', ' + extra if extra else ''} from {source}", columns), *tables)


@query("rolling_means", _sql(_MEANS, "rolled", _BASE, _ROWS))
def rolling_means(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.rolling_features(stored_training(spark, folder), KEYS, "avg", chunk_seconds=FRAME_CHUNK, whole_rows=WHOLE_ROWS).select(*_ID, *_MEANS), _MEANS)


@query("rolling_stds", _sql(_STDS, "rolled", _BASE, _ROWS))
def rolling_stds(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.rolling_features(stored_training(spark, folder), KEYS, "stddev", chunk_seconds=FRAME_CHUNK, whole_rows=WHOLE_ROWS).select(*_ID, *_STDS), _STDS)


# Days instead of hours: the feed has about two readings per machine and day.
@query("rolling_time", _sql(_MEANS + _STDS, "rolled", _BASE, _TIME))
def rolling_time(spark: SparkSession, folder: str) -> DataFrame:
    rolled = features.time_rolling(stored_training(spark, folder), KEYS, short_seconds=86400, long_seconds=604800, pane_seconds=43200)
    return rounded(rolled.select(*_ID, *_MEANS, *_STDS), _MEANS + _STDS)


@query("lag_features", _sql(_LAGS, "lagged", _BASE, _ROWS, _LAGGED))
def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.lag_features(stored_training(spark, folder), KEYS, chunk_seconds=FRAME_CHUNK, whole_rows=WHOLE_ROWS).select(*_ID, *_LAGS), _LAGS)


@query("delta_features", _sql(_DELTAS, "lagged", _BASE, _ROWS, _LAGGED, extra=_DELTA_SQL))
def delta_features(spark: SparkSession, folder: str) -> DataFrame:
    lagged = features.lag_features(stored_training(spark, folder), KEYS, chunk_seconds=FRAME_CHUNK, whole_rows=WHOLE_ROWS)
    return rounded(features.delta_features(lagged).select(*_ID, *_DELTAS), _DELTAS)


@query("domain_features", _sql(_DOMAIN, "base", _BASE, extra=_DOMAIN_SQL))
def domain_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.domain_features(training(spark, folder)).select(*_ID, *_DOMAIN), _DOMAIN)


@query("temp_anomaly", _sql(["temp_anomaly_score"], "rolled", _BASE, _ROWS, extra=_ANOMALY_SQL))
def temp_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    built = features.build_features(stored_training(spark, folder), KEYS, FRAME_CHUNK, WHOLE_ROWS)
    return rounded(built.select(*_ID, "temp_anomaly_score"), ["temp_anomaly_score"])


_FILLED = ", ".join(f"coalesce({c}, 0e0) as {c}" for c in _LAGS + _DELTAS)
_BUILT = f"built as (select * exclude (sec), {_DELTA_SQL}, {_DOMAIN_SQL}, {_ANOMALY_SQL} from lagged)"
ENGINEERED = _MEANS + _STDS + _LAGS + _DELTAS + _DOMAIN + ["temp_anomaly_score"]
FEATURES = (_BASE, _ROWS, _LAGGED, _BUILT, f"features as ({rounded_sql(f'select * replace ({_FILLED}) from built', ENGINEERED)})")


@query("feature_table", over("training", "select * from features", *FEATURES))
def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.build_features(stored_training(spark, folder), KEYS, FRAME_CHUNK, WHOLE_ROWS), ENGINEERED)


@query(
    "operating_hours",
    over(
        "readings",
        rounded_sql(
            "select event_id, turbine_id, reading_ts, sum(case when rotor_speed_rpm > 0 then 1 else 0 end) over "
            "(partition by turbine_id order by reading_ts) * 10e0 / 60e0 as operating_hours from readings",
            ["operating_hours"],
        ),
    ),
)
def operating_hours(spark: SparkSession, folder: str) -> DataFrame:
    hours = features.cumulative_hours(readings(spark, folder), KEYS, chunk_seconds=CHUNK)
    return rounded(hours.select("event_id", "turbine_id", "reading_ts", "operating_hours"), ["operating_hours"])
