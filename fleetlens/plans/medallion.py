"""Feed to Bronze to Silver to Gold to features. Only tables pass from one stage to the next."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetlens.config import EVENT_DATE, INGESTION_SCHEMA, Keys, QualityRules, TableLayout, raw_schema
from fleetlens.functions.shaping import conform, stamp_ingestion
from fleetlens.functions.silver import silver
from fleetlens.operators import features, kpi, labels
from fleetlens.operators.ingest import upsert_new_only
from fleetlens.sources.tables import create_partitioned_table, ensure_schema, read_table, write_overwrite


def prepare(
    spark: SparkSession, layout: TableLayout = TableLayout(), keys: Keys = Keys(), time_type: T.DataType = T.TimestampType()
) -> None:
    """Schemas and the Bronze table; safe to repeat."""
    for schema in layout.schemas:
        ensure_schema(spark, schema)
    columns = T.StructType(raw_schema(keys, time_type).fields + INGESTION_SCHEMA.fields + [T.StructField(EVENT_DATE, T.DateType())])
    create_partitioned_table(
        spark, layout.readings_raw, columns, [EVENT_DATE], "Raw sensor readings with ingestion metadata"
    )


def ingest(
    feed: DataFrame,
    source: str,
    layout: TableLayout = TableLayout(),
    keys: Keys = Keys(),
    batch_id: str | None = None,
    as_of: datetime | None = None,
) -> str:
    """Adds the readings of `feed` that Bronze lacks, and returns the batch id."""
    spark = feed.sparkSession
    time_type = read_table(spark, layout.readings_raw).schema[keys.time].dataType
    batch = batch_id or str(uuid.uuid4())
    stamped = stamp_ingestion(conform(feed, raw_schema(keys, time_type)), batch, source, as_of)
    upsert_new_only(layout.readings_raw, stamped, keys.reading, time=keys.time)
    return batch


def build_silver(
    spark: SparkSession, layout: TableLayout = TableLayout(), rules: QualityRules = QualityRules(), keys: Keys = Keys()
) -> DataFrame:
    """Silver, its files in order of machine and time, so that later readers skip row groups."""
    write_overwrite(silver(read_table(spark, layout.readings_raw), rules), layout.readings_clean, cluster_by=[keys.entity, keys.time])
    return read_table(spark, layout.readings_clean)


def build_gold(spark: SparkSession, layout: TableLayout = TableLayout(), keys: Keys = Keys(), horizon_hours: int = 24) -> None:
    """Daily KPIs, health per reading, and the training table."""
    clean = read_table(spark, layout.readings_clean)
    write_overwrite(kpi.daily_kpi(clean, keys), layout.daily_kpi)
    write_overwrite(kpi.machine_health(clean), layout.health, cluster_by=[keys.entity, keys.time])
    write_overwrite(labels.training_set(clean, keys, horizon_hours), layout.training, cluster_by=[keys.entity, keys.time])


def build_feature_table(spark: SparkSession, layout: TableLayout = TableLayout(), keys: Keys = Keys()) -> DataFrame:
    write_overwrite(features.build_features(read_table(spark, layout.training), keys), layout.features, cluster_by=[keys.time])
    return read_table(spark, layout.features)


def summaries(spark: SparkSession, layout: TableLayout = TableLayout(), label: str = "failure_within_next_24_hours") -> dict[str, DataFrame]:
    """The reports on stored tables, each a small aggregate."""
    return {
        "silver": kpi.silver_summary(read_table(spark, layout.readings_clean)),
        "health": kpi.distribution(read_table(spark, layout.health), "health_status"),
        "target": kpi.distribution(read_table(spark, layout.training), label, "target", percentage=True),
    }
