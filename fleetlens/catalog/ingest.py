"""Sources, schema and ingestion."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.catalog import query
from fleetlens.catalog.data import AS_OF, silver
from fleetlens.catalog.sql import FLAGS, over
from fleetlens.config import raw_schema
from fleetlens.functions.shaping import add_aliases, conform, stamp_ingestion
from fleetlens.operators.dedup import dedup_latest
from fleetlens.operators.ingest import merge_new_only, upsert_new_only
from fleetlens.session import shared_folder
from fleetlens.catalog.readings import KEYS, MAPPING, raw_readings, readings
from fleetlens.sources.tables import changes_since, read_table

_ID = "event_id, turbine_id, reading_ts"
_CUT_1, _CUT_2 = "2024-01-20", "2024-01-10"


@query("scan_readings", "select * from events")
def scan_readings(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, f"{folder}/events.parquet")


@query("conform_schema", over("readings", "select * from readings"))
def conform_schema(spark: SparkSession, folder: str) -> DataFrame:
    return conform(raw_readings(spark, folder), raw_schema(KEYS, T.TimestampNTZType()))


@query(
    "alias_layer",
    over(
        "aliased",
        f"select {_ID}, rotor_speed, generator_speed, active_power, reactive_power, voltage, current, pressure, "
        "power_output, oil_temperature, maintenance_flag from aliased",
    ),
)
def alias_layer(spark: SparkSession, folder: str) -> DataFrame:
    return add_aliases(readings(spark, folder)).select(
        "event_id", "turbine_id", "reading_ts", "rotor_speed", "generator_speed", "active_power", "reactive_power",
        "voltage", "current", "pressure", "power_output", "oil_temperature", "maintenance_flag",
    )


@query(
    "bronze_stamp",
    over(
        "readings",
        f"select {_ID}, date '2024-02-01' as ingestion_date, 'batch-1' as batch_id, 'events' as source_file from readings",
    ),
)
def bronze_stamp(spark: SparkSession, folder: str) -> DataFrame:
    return stamp_ingestion(readings(spark, folder), "batch-1", "events", AS_OF).select(
        "event_id", "turbine_id", "reading_ts", "ingestion_date", "batch_id", "source_file"
    )


def _twice(spark: SparkSession, folder: str) -> DataFrame:
    """Every reading and a second copy of it that carries an impossible wind speed."""
    feed = readings(spark, folder)
    return feed.unionByName(feed.withColumn("wind_speed", F.lit(-999.0)))


# The feed has one reading per machine and time, so the survivors are the feed itself.
@query("dedup_readings", over("readings", "select * from readings"))
def dedup_readings(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_latest(_twice(spark, folder), KEYS.reading)


def _batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of the feed that overlap in time."""
    feed = readings(spark, folder)

    def delivered(part: DataFrame, name: str) -> DataFrame:
        return dedup_latest(stamp_ingestion(part, name, "events", AS_OF), KEYS.reading)

    first = feed.where(F.col("reading_ts") < F.lit(_CUT_1).cast("timestamp_ntz"))
    second = feed.where(F.col("reading_ts") >= F.lit(_CUT_2).cast("timestamp_ntz"))
    return delivered(first, "batch-1"), delivered(second, "batch-2")


_SHOWN = ("event_id", "turbine_id", "reading_ts", "wind_speed", "ingestion_date", "batch_id")
_MERGED = f"""merged as (select {_ID}, wind_speed, date '2024-02-01' as ingestion_date,
 case when reading_ts < timestamp '{_CUT_1}' then 'batch-1' else 'batch-2' end as batch_id from readings)"""


@query("bronze_incremental", over("readings", "select * from merged", _MERGED))
def bronze_incremental(spark: SparkSession, folder: str) -> DataFrame:
    first, second = _batches(spark, folder)
    return merge_new_only(first, second, KEYS.reading).select(*_SHOWN)


@query("bronze_rerun_noop", over("readings", "select batch_id, count(*) as rows from merged group by batch_id", _MERGED))
def bronze_rerun_noop(spark: SparkSession, folder: str) -> DataFrame:
    first, second = _batches(spark, folder)
    once = merge_new_only(first, second, KEYS.reading)
    again = merge_new_only(once, second, KEYS.reading)
    return again.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))


_LOST = 40  # every so many readings arrive once more without their machine


@query(
    "bronze_upsert",
    over(
        "readings",
        "select * from merged union all select event_id, cast(null as varchar), reading_ts, wind_speed, ingestion_date, 'batch-2' from merged "
        f"where cast(event_id as bigint) % {_LOST} = 0 and reading_ts >= timestamp '{_CUT_2}'",
        _MERGED,
    ),
)
def bronze_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Three deliveries into a stored table, the last one a repetition; some readings name no machine."""
    path = f"{shared_folder(spark)}/bronze-{uuid.uuid4().hex}"
    feed = readings(spark, folder)
    first = feed.where(F.col("reading_ts") < F.lit(_CUT_1).cast("timestamp_ntz"))
    second = feed.where(F.col("reading_ts") >= F.lit(_CUT_2).cast("timestamp_ntz"))
    lost = second.where(F.col("event_id").cast("long") % _LOST == 0).withColumn("turbine_id", F.lit(None).cast("string"))
    for part, name in ((first, "batch-1"), (second.unionByName(lost), "batch-2"), (second.unionByName(lost), "batch-3")):
        upsert_new_only(path, stamp_ingestion(part, name, "events", AS_OF), KEYS.reading, KEYS.time)
    return read_table(spark, path).select(*_SHOWN)


@query("bronze_changes", over("readings", "select * from merged where batch_id = 'batch-2'", _MERGED))
def bronze_changes(spark: SparkSession, folder: str) -> DataFrame:
    first, second = _batches(spark, folder)
    return changes_since(merge_new_only(first, second, KEYS.reading), "batch-2").select(*_SHOWN)


@query("silver_table", over("silver", "select * from silver"))
def silver_table(spark: SparkSession, folder: str) -> DataFrame:
    return silver(spark, folder)


assert FLAGS <= set(MAPPING)
