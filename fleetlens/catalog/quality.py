"""Row-level quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetlens.catalog import query
from fleetlens.catalog.data import silver
from fleetlens.catalog.sql import over, rounded, rounded_sql
from fleetlens.config import SILVER_DEFAULTS, raw_schema
from fleetlens.functions.quality import add_quality
from fleetlens.functions.shaping import add_aliases, nan_to_null
from fleetlens.operators import kpi
from fleetlens.catalog.readings import KEYS, readings


def _flagged(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return add_quality(add_aliases(nan_to_null(readings(spark, folder)))).select("event_id", *columns)


def _register(name: str, *columns: str) -> None:
    sql = over("flagged", f"select event_id, {', '.join(columns)} from flagged")
    query(name, sql)(lambda spark, folder: _flagged(spark, folder, *columns))


_register("quality_range_flags", "is_wind_speed_valid", "is_temperature_valid", "is_power_valid", "is_vibration_valid")
_register("quality_outliers", "is_temp_outlier", "is_vibration_outlier")
_register("quality_missing", "missing_count", "has_missing")
_register("quality_anomaly", "is_sensor_anomaly")
_register("quality_score", "quality_score")


@query("valid_records", over("flagged", "select event_id, turbine_id, reading_ts, quality_score from flagged where is_valid_record"))
def valid_records(spark: SparkSession, folder: str) -> DataFrame:
    return _flagged(spark, folder, "turbine_id", "reading_ts", "quality_score", "is_valid_record").where(
        "is_valid_record"
    ).drop("is_valid_record")


@query("silver_fill", over("silver", f"select event_id, {', '.join(SILVER_DEFAULTS)} from silver"))
def silver_fill(spark: SparkSession, folder: str) -> DataFrame:
    return silver(spark, folder).select("event_id", *SILVER_DEFAULTS)


@query(
    "silver_summary",
    over(
        "silver",
        rounded_sql(
            "select count(*) as total_records, cast(sum(cast(is_valid_record as int)) as bigint) as valid_records, "
            "avg(quality_score) as avg_quality_score, cast(sum(cast(is_sensor_anomaly as int)) as bigint) as anomaly_count, "
            "cast(sum(cast(has_missing as int)) as bigint) as records_with_missing from silver",
            ["avg_quality_score"],
        ),
    ),
)
def silver_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(kpi.silver_summary(silver(spark, folder)), ["avg_quality_score"])


_MISSING = ("wind_speed", "gearbox_temperature", "vibration_x", "vibration_y", "active_power_kw")
_CHECKS = (
    "(select count(*) - count(distinct (turbine_id, reading_ts)) from flagged) as duplicate, "
    + ", ".join(f"(select count(*) from flagged where {c} is null) as missing_{c}" for c in _MISSING)
    + ", (select count(*) from flagged where wind_speed = -999) as sentinel_wind_speed"
    + ", (select count(*) from flagged where humidity < 0 or humidity > 100) as out_of_range_humidity"
    + ", (select count(*) from flagged where is_temp_outlier) as is_temp_outlier"
    + ", (select count(*) from flagged where is_vibration_outlier) as is_vibration_outlier"
)


@query(
    "quality_profile",
    over(
        "flagged",
        rounded_sql(
            'select total_records, "check", affected, affected / cast(total_records as double) as rate from '
            f"(unpivot (select (select count(*) from flagged) as total_records, {_CHECKS}) on columns(* exclude (total_records)) "
            'into name "check" value affected)',
            ["rate"],
        ),
    ),
)
def quality_profile(spark: SparkSession, folder: str) -> DataFrame:
    checked = add_quality(add_aliases(nan_to_null(readings(spark, folder))))
    return rounded(kpi.quality_profile(checked, KEYS), ["rate"])


_PROFILED = tuple(raw_schema(KEYS, T.TimestampNTZType()).names)


@query(
    "null_profile",
    over(
        "readings",
        "select * from counted union all select 'TOTAL', cast(sum(null_count) as bigint) from counted",
        "counted as ("
        + " union all ".join(
            f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count from readings" for c in _PROFILED
        )
        + ")",
    ),
)
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.null_profile(readings(spark, folder), _PROFILED)
