"""KPIs, health, labels and episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.catalog import query
from fleetlens.catalog.data import CHUNK, LABEL, silver, training
from fleetlens.catalog.sql import over, rounded, rounded_sql
from fleetlens.functions import domain
from fleetlens.operators import episodes, kpi, labels
from fleetlens.catalog.readings import KEYS, readings

_KPI_DOUBLES = (
    "average_wind_speed", "max_wind_speed", "average_power", "total_energy", "average_temperature",
    "max_gearbox_temperature", "average_vibration", "availability", "capacity_factor",
)


@query(
    "daily_kpi",
    over(
        "silver",
        rounded_sql(
            "select *, case when failure_count = 0 then 1e0 else 0.8e0 end as availability, total_energy / 60e0 as capacity_factor "
            "from (select turbine_id, farm_id, cast(reading_ts as date) as date, avg(wind_speed) as average_wind_speed, "
            "max(wind_speed) as max_wind_speed, avg(power_output) as average_power, sum(power_output) as total_energy, "
            "avg(gearbox_temperature) as average_temperature, max(gearbox_temperature) as max_gearbox_temperature, "
            "avg(sqrt(power(vibration_x, 2) + power(vibration_y, 2) + power(vibration_z, 2))) as average_vibration, "
            "cast(sum(failure_flag) as bigint) as failure_count, cast(sum(maintenance_flag) as bigint) as maintenance_count, "
            "count(*) as record_count from silver where is_valid_record group by 1, 2, 3)",
            _KPI_DOUBLES,
        ),
    ),
)
def daily_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(kpi.daily_kpi(silver(spark, folder), KEYS), _KPI_DOUBLES)


_HEALTH = """health as (select *, case when health_score >= 80 then 'HEALTHY' when health_score >= 60 then 'WARNING'
 else 'CRITICAL' end as status from (select *, greatest(0e0, 100e0 - (case when gearbox_temperature > 100 then 15 else 0 end)
 - (case when generator_temperature > 90 then 10 else 0 end) - (case when bearing_temperature > 80 then 10 else 0 end)
 - vibration_x * 20 - vibration_y * 20 - vibration_z * 15
 - (case when wind_speed > 10 and power_output < 1 then 10 else 0 end)) as health_score from silver where is_valid_record))"""


@query(
    "turbine_health",
    over(
        "silver",
        rounded_sql(
            "select event_id, turbine_id, reading_ts, health_score, status as health_status from health", ["health_score"]
        ),
        _HEALTH,
    ),
)
def turbine_health(spark: SparkSession, folder: str) -> DataFrame:
    scored = kpi.machine_health(silver(spark, folder))
    return rounded(scored.select("event_id", "turbine_id", "reading_ts", "health_score", "health_status"), ["health_score"])


@query(
    "health_distribution",
    over("silver", "select status as health_status, count(*) as count from health group by status", _HEALTH),
)
def health_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.distribution(kpi.machine_health(silver(spark, folder)), "health_status")


@query(
    "dataset_profile",
    over(
        "readings",
        "select count(*) as total_records, count(distinct turbine_id) as unique_turbines, count(distinct farm_id) as unique_farms, "
        "min(reading_ts) as start_date, max(reading_ts) as end_date, cast(sum(failure_flag) as bigint) as failure_records, "
        "round(avg(active_power_kw), 2) as avg_power_kw from readings",
    ),
)
def dataset_profile(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.dataset_profile(readings(spark, folder), KEYS)


_NEXT = """ahead as (select s.event_id, s.turbine_id, s.reading_ts, s.failure_flag,
 cast(epoch(date_trunc('second', s.reading_ts)) as bigint) as sec,
 (select min(cast(epoch(date_trunc('second', f.reading_ts)) as bigint)) from silver f where f.failure_flag = 1
  and f.turbine_id = s.turbine_id and date_trunc('second', f.reading_ts) >= date_trunc('second', s.reading_ts)) as nxt
 from silver s)"""
_BY_LEAD = over(
    "silver",
    f"select event_id, turbine_id, reading_ts, case when nxt <= sec + 86400 then 1 else 0 end as {LABEL} "
    "from ahead where failure_flag = 0",
    _NEXT,
)


@query("failure_labels", _BY_LEAD)
def failure_labels(spark: SparkSession, folder: str) -> DataFrame:
    marked = labels.label_by_next_event(silver(spark, folder), KEYS, chunk_seconds=CHUNK)
    return marked.where("failure_flag = 0").select("event_id", "turbine_id", "reading_ts", LABEL)


@query("failure_labels_join", over("labelled", f"select event_id, turbine_id, reading_ts, {LABEL} from labelled where failure_flag = 0"))
def failure_labels_join(spark: SparkSession, folder: str) -> DataFrame:
    marked = labels.label_within_horizon(silver(spark, folder), KEYS)
    return marked.where("failure_flag = 0").select("event_id", "turbine_id", "reading_ts", LABEL)


@query(
    "time_to_failure",
    over(
        "silver",
        rounded_sql(
            "select event_id, turbine_id, reading_ts, case when nxt <= sec + 86400 then nxt end as failure_time, "
            "case when nxt <= sec + 86400 then (nxt - sec) / 3600e0 end as lead_hours from ahead where failure_flag = 0",
            ["lead_hours"],
        ),
        _NEXT,
    ),
)
def time_to_failure(spark: SparkSession, folder: str) -> DataFrame:
    marked = labels.label_by_next_event(silver(spark, folder), KEYS, chunk_seconds=CHUNK).where("failure_flag = 0")
    return rounded(marked.select("event_id", "turbine_id", "reading_ts", "failure_time", "lead_hours"), ["lead_hours"])


@query("training_dataset", over("training", "select * from training"))
def training_dataset(spark: SparkSession, folder: str) -> DataFrame:
    return training(spark, folder)


@query(
    "target_distribution",
    over(
        "training",
        f"select {LABEL} as target, count(*) as count, round(count(*) * 100e0 / sum(count(*)) over (), 2) as percentage "
        f"from training group by {LABEL}",
    ),
)
def target_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.distribution(training(spark, folder), LABEL, "target", percentage=True)


def _episodes_sql(minutes: int) -> str:
    return f"""seq as (select *, lag(failure_flag, 1, 0) over w as before from readings
  window w as (partition by turbine_id order by reading_ts)),
islands as (select *, sum(case when failure_flag = 1 and before = 0 then 1 else 0 end) over (partition by turbine_id
  order by reading_ts) as episode from seq),
failures as (select turbine_id, farm_id, cast(episode as bigint) as episode,
  min(reading_ts) filter (where failure_flag = 1) as failure_timestamp,
  max(reading_ts) filter (where failure_flag = 1) as last_failing_timestamp,
  min(reading_ts) filter (where failure_flag = 0 and before = 1) as resumed_timestamp,
  count(*) filter (where failure_flag = 1) as readings,
  arg_min(failure_type, reading_ts) filter (where failure_flag = 1) as failure_type,
  printf('F-%s-%05d', turbine_id, cast(episode as bigint)) as failure_id,
  count(*) filter (where failure_flag = 1) * {minutes} / 60e0 as downtime_hours
  from islands where failure_flag = 1 or before = 1 group by turbine_id, farm_id, episode),
jobs as (select printf('M-%s-%05d', turbine_id, episode) as maintenance_id, turbine_id, farm_id,
  resumed_timestamp as maintenance_timestamp, 'CORRECTIVE' as maintenance_type, failure_type as component,
  downtime_hours, false as planned_flag from failures where resumed_timestamp is not null)"""


@query("failure_episodes", over("readings", rounded_sql("select * from failures", ["downtime_hours"]), _episodes_sql(10)))
def failure_episodes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(episodes.failure_episodes(readings(spark, folder), KEYS, chunk_seconds=CHUNK), ["downtime_hours"])


@query("maintenance_episodes", over("readings", rounded_sql("select * from jobs", ["downtime_hours"]), _episodes_sql(10)))
def maintenance_episodes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        episodes.maintenance_episodes(episodes.failure_episodes(readings(spark, folder), KEYS, chunk_seconds=CHUNK), KEYS), ["downtime_hours"]
    )


# The feed has about two readings per machine and day, so one reading stands for a day here.
_DAY = 1440


@query(
    "maintenance_interval_join",
    over(
        "readings",
        "select r.event_id, r.turbine_id, r.reading_ts, case when exists (select 1 from jobs j where j.turbine_id = r.turbine_id "
        "and r.reading_ts between j.maintenance_timestamp and j.maintenance_timestamp + to_hours(cast(j.downtime_hours as bigint))) "
        "then 1 else 0 end as in_maintenance from readings r",
        _episodes_sql(_DAY),
    ),
)
def maintenance_interval_join(spark: SparkSession, folder: str) -> DataFrame:
    feed = readings(spark, folder)
    jobs = episodes.maintenance_episodes(episodes.failure_episodes(feed, KEYS, interval_minutes=_DAY, chunk_seconds=CHUNK), KEYS)
    seconds = (F.col("downtime_hours") * 3600).cast("decimal(18,6)")
    spans = jobs.select(
        "turbine_id",
        F.col("maintenance_timestamp").alias("start"),
        (F.col("maintenance_timestamp") + F.make_dt_interval(secs=seconds)).alias("end"),
    )
    return episodes.label_intervals(feed, spans, KEYS, chunk_seconds=CHUNK).select("event_id", "turbine_id", "reading_ts", "in_maintenance")


# --- row formulas -----------------------------------------------------------------------


@query(
    "power_curve_residual",
    over(
        "silver",
        rounded_sql(
            "select event_id, power_output, expected_power, power_output - expected_power as residual from (select event_id, power_output, "
            "case when wind_speed < 3 or wind_speed > 25 then 0e0 when wind_speed < 12 then 2.5e0 * power((wind_speed - 3) / 9e0, 3) "
            "else 2.5e0 end as expected_power from silver)",
            ["power_output", "expected_power", "residual"],
        ),
    ),
)
def power_curve_residual(spark: SparkSession, folder: str) -> DataFrame:
    curve = silver(spark, folder).withColumn("expected_power", domain.expected_power())
    return rounded(
        curve.select("event_id", "power_output", "expected_power", (F.col("power_output") - F.col("expected_power")).alias("residual")),
        ["power_output", "expected_power", "residual"],
    )


@query(
    "air_density",
    over(
        "readings",
        rounded_sql(
            "select event_id, 1.225e0 * (atmospheric_pressure / 1013e0) * (288e0 / (ambient_temperature + 273e0)) as density from readings",
            ["density"],
        ),
    ),
)
def air_density(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(readings(spark, folder).select("event_id", domain.air_density().alias("density")), ["density"])


_ELECTRICAL = ("reactive_kvar", "apparent_kva", "power_factor_calc", "load_pct", "current_calc")


@query(
    "electrical_derived",
    over(
        "readings",
        rounded_sql(
            "select event_id, reactive_kvar, apparent_kva, case when apparent_kva > 0 then p / apparent_kva when apparent_kva = 0 then 1e0 end "
            "as power_factor_calc, p / 2500e0 * 100e0 as load_pct, case when voltage_v > 0 then p * 1000e0 / (voltage_v * (sqrt(3e0) * 0.99e0)) "
            "else 0e0 end as current_calc from (select event_id, voltage_v, active_power_kw as p, active_power_kw * 0.08e0 as reactive_kvar, "
            "sqrt(active_power_kw * active_power_kw + power(active_power_kw * 0.08e0, 2)) as apparent_kva from readings)",
            _ELECTRICAL,
        ),
    ),
)
def electrical_derived(spark: SparkSession, folder: str) -> DataFrame:
    derived = readings(spark, folder).select("event_id", *[c.alias(n) for n, c in domain.derived().items()])
    return rounded(derived, _ELECTRICAL)


_STATE = (
    "case when wind_speed < 3 then 'STOPPED' when health_status < 0.3e0 then 'FAULT' when wind_speed > 25 then 'EMERGENCY_STOP' "
    "when wind_speed < 4 then 'STARTING' else 'RUNNING' end"
)


@query("classify_state", over("readings", f"select event_id, {_STATE} as operating_state from readings"))
def classify_state(spark: SparkSession, folder: str) -> DataFrame:
    return readings(spark, folder).select("event_id", domain.operating_state().alias("operating_state"))


@query(
    "status_flags",
    over(
        "readings",
        "select event_id, cast(health_status >= 0.3e0 as int) as availability_flag, cast(state = 'RUNNING' as int) as grid_connected_flag, "
        "cast(health_status >= 0.3e0 and health_status < 1 as int) as maintenance_mode_flag, cast(health_status < 0.7e0 as int) as alarm_flag, "
        f"cast(health_status < 0.3e0 as int) as failure_flag from (select event_id, health_status, {_STATE} as state from readings)",
    ),
)
def status_flags(spark: SparkSession, folder: str) -> DataFrame:
    stated = readings(spark, folder).withColumn("operating_state", domain.operating_state())
    return stated.select("event_id", *[c.alias(n) for n, c in domain.status_flags().items()])


@query(
    "status_disagreements",
    over(
        "readings",
        f"select turbine_id, count(*) as readings, count(*) filter (where operating_state is distinct from {_STATE}) as operating_state_differs, "
        "count(*) filter (where availability_flag is distinct from cast(health_status >= 0.3e0 as int)) as availability_flag_differs, "
        "count(*) filter (where grid_connected_flag is distinct from cast(operating_state = 'RUNNING' as int)) as grid_connected_flag_differs, "
        "count(*) filter (where maintenance_mode_flag is distinct from cast(health_status >= 0.3e0 and health_status < 1 as int)) as maintenance_mode_flag_differs, "
        "count(*) filter (where alarm_flag is distinct from cast(health_status < 0.7e0 as int)) as alarm_flag_differs, "
        "count(*) filter (where failure_flag is distinct from cast(health_status < 0.3e0 as int)) as failure_flag_differs "
        "from readings group by turbine_id",
    ),
)
def status_disagreements(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.disagreements(readings(spark, folder), KEYS)


@query(
    "classify_alarms",
    over(
        "readings",
        "select event_id, case when gearbox_temperature > 100 then 'ALM-GEARBOX-TEMP' when generator_temperature > 95 then 'ALM-GENERATOR-TEMP' "
        "when sqrt(power(vibration_x, 2) + power(vibration_y, 2) + power(vibration_z, 2)) > 1 then 'ALM-HIGH-VIBRATION' "
        "when hydraulic_pressure < 120 then 'ALM-HYDRAULIC-PRESSURE' end as alarm_code, case when health_status < 0.3e0 then 'CRITICAL' "
        "when health_status < 0.5e0 then 'WARNING' when health_status < 0.7e0 then 'INFO' end as alarm_severity from readings",
    ),
)
def classify_alarms(spark: SparkSession, folder: str) -> DataFrame:
    return readings(spark, folder).select(
        "event_id", domain.alarm_code().alias("alarm_code"), domain.alarm_severity().alias("alarm_severity")
    )
