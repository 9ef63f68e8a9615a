"""The stages end to end over tables, the streaming sink, and what the plans look like."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.config import TableLayout, label_name, raw_schema
from fleetlens.catalog import all_queries
from fleetlens.functions.shaping import feature_columns
from fleetlens.operators import labels, train
from fleetlens.operators.features import build_features
from fleetlens.plans import learning, medallion, monitoring
from fleetlens.catalog.readings import KEYS, raw_readings, readings
from fleetlens.sources.tables import changes_since, create_partitioned_table, read_table, table_exists
from fleetlens.streaming.ingest import ingest_stream

FOLDER = "/root/testdata/sf0.001"
LAYOUT = TableLayout(bronze="t_bronze", silver="t_silver", gold="t_gold", ml="t_ml", monitoring="t_monitoring")
SMALL = tuple(replace(c, trees=3, depth=3, iterations=20) for c in train.CANDIDATES[:2])


@pytest.fixture(scope="module")
def bronze(spark):
    """Two overlapping deliveries, the second one twice."""
    medallion.prepare(spark, LAYOUT, KEYS, T.TimestampNTZType())
    medallion.prepare(spark, LAYOUT, KEYS, T.TimestampNTZType())
    feed = raw_readings(spark, FOLDER)
    early = feed.where("reading_ts < timestamp_ntz'2024-01-20'")
    late = feed.where("reading_ts >= timestamp_ntz'2024-01-10'")
    batches = [medallion.ingest(early.unionByName(early), "events", LAYOUT, KEYS)]
    batches += [medallion.ingest(late, "events", LAYOUT, KEYS) for _ in range(2)]
    return read_table(spark, LAYOUT.readings_raw), batches


@pytest.fixture(scope="module")
def features(spark, bronze):
    assert medallion.build_silver(spark, LAYOUT, keys=KEYS).count() == 1000
    medallion.build_gold(spark, LAYOUT, KEYS)
    return medallion.build_feature_table(spark, LAYOUT, KEYS)


def test_ingestion_is_incremental(bronze):
    table, (first, second, again) = bronze
    assert table.count() == 1000
    assert changes_since(table, first).count() + changes_since(table, second).count() == 1000
    assert changes_since(table, again).count() == 0
    assert table.rdd.getNumPartitions() > 0 and "ingestion_date" in table.columns


def test_gold_tables(spark, features):
    assert len(features.columns) == 53
    clean = read_table(spark, LAYOUT.readings_clean)
    assert clean.where("failure_flag = 0").count() == features.count()
    reports = medallion.summaries(spark, LAYOUT)
    assert reports["silver"].first()["total_records"] == 1000
    assert reports["target"].agg(F.round(F.sum("percentage"))).first()[0] == 100
    assert dict(read_table(spark, LAYOUT.health).dtypes)["health_status"] == "string"
    kpi = read_table(spark, LAYOUT.daily_kpi)
    assert kpi.agg(F.sum("record_count")).first()[0] == clean.where("is_valid_record").count()


def test_learning_and_monitoring(spark, features, tmp_path):
    root = str(tmp_path / "models")
    nobody = learning.train_and_compare(spark, root, LAYOUT, KEYS, SMALL[:1], min_recall=1.1)
    assert nobody.where("is_champion").count() == 0 and learning.champion(spark, LAYOUT) is None
    assert learning.score_batch(spark, features, root, LAYOUT, KEYS) is None
    status = {r["check"]: r["status"] for r in monitoring.monitor(spark, LAYOUT, KEYS).collect()}
    assert status == {"data": "done", "concept": "done", "prediction": "skipped", "model": "skipped"}

    for version in (1, 2):
        compared = learning.train_and_compare(spark, root, LAYOUT, KEYS, SMALL, min_recall=0.0)
        assert compared.count() == 2 and compared.where("is_champion").count() == 1
        name, run, found = learning.champion(spark, LAYOUT)
        assert found == version
    assert learning.evaluate_champion(spark, LAYOUT).first()["accuracy"] > 0
    scores = learning.score_batch(spark, features, root, LAYOUT, KEYS)
    assert scores.count() == features.count() and scores.first()["model_run_id"] == run
    assert scores.where("failure_probability not between 0 and 1").count() == 0
    status = {r["check"]: r["status"] for r in monitoring.monitor(spark, LAYOUT, KEYS).collect()}
    assert set(status.values()) == {"done"}
    assert read_table(spark, LAYOUT.monitor("drift_summary")).count() == 2
    assert monitoring.latest(spark, LAYOUT, "drift_summary").first()["overall_drift_status"] in ("OK", "CRITICAL")


def test_monitoring_without_any_table(spark):
    empty = TableLayout(gold="nowhere", ml="nowhere", monitoring="t_empty")
    assert {r["status"] for r in monitoring.monitor(spark, empty, KEYS).collect()} == {"skipped"}
    assert not table_exists(spark, empty.monitor("drift_summary"))


def test_stream_ingests_each_reading_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "bronze")
    schema = raw_schema(KEYS, T.TimestampNTZType())
    feed = readings(spark, FOLDER)
    feed.where("reading_ts < timestamp_ntz'2024-01-20'").write.parquet(source)
    options = dict(keys=KEYS.reading, checkpoint=str(tmp_path / "state"), time="reading_ts")
    ingest_stream(spark, source, schema, target, **options).awaitTermination(120)
    feed.where("reading_ts >= timestamp_ntz'2024-01-10'").write.mode("append").parquet(source)
    ingest_stream(spark, source, schema, target, **options).awaitTermination(120)
    stored = spark.read.parquet(target)
    assert stored.count() == stored.select(*KEYS.reading).distinct().count() == 1000


def test_partitioned_table_is_created_once(spark):
    schema = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("d", T.DateType())])
    for _ in range(2):
        create_partitioned_table(spark, "once", schema, ["d"], "a reader's note")
    assert spark.catalog.listColumns("once")[1].isPartition


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_shuffle_their_rows_once(spark, features):
    """One exchange takes whole rows and the narrow copies that frames reach back to; no other has all columns."""
    plan = executed(build_features(read_table(spark, LAYOUT.training), KEYS))
    assert plan.count("Union") == 1 and "SinglePartition" not in plan and "hashpartitioning(turbine_id" not in plan
    wide = [line for line in plan.splitlines() if "Scan parquet" in line and "hydraulic_pressure" in line]
    assert len(wide) == 1


def test_drift_queries_watch_every_numeric_feature(spark, features):
    from fleetlens.catalog.drift import FEATURES

    ids = [KEYS.entity, KEYS.site, KEYS.time, label_name()]
    assert set(FEATURES) == set(feature_columns(features, ids))
    assert len(FEATURES) == len(set(FEATURES)) == 49


def test_kpi_reads_few_columns_and_filters_in_the_scan(spark, features):
    from fleetlens.operators.kpi import daily_kpi

    plan = executed(daily_kpi(read_table(spark, LAYOUT.readings_clean), KEYS))
    assert "EqualTo(is_valid_record,true)" in plan
    assert "humidity" not in plan.split("ReadSchema")[1]
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_labels_join_without_a_range_condition(spark, features):
    plan = executed(labels.label_within_horizon(read_table(spark, LAYOUT.readings_clean), KEYS))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert label_name() == "failure_within_next_24_hours"


def test_no_query_plans_a_cross_join_or_python_udf(spark):
    for name in ("drift_summary", "champion_history", "feature_table", "temporal_split", "maintenance_interval_join"):
        plan = executed(all_queries()[name](spark, FOLDER))
        for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEvalPython"):
            assert banned not in plan, (name, banned)
