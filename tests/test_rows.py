"""Row-level rules, schema handling, ingestion and labels on hand-made corners."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.catalog.sql import DIGITS, NUDGE, rounded
from fleetlens.config import RAW_COLUMNS, Keys, raw_schema
from fleetlens.functions import domain
from fleetlens.config import ALIASES
from fleetlens.functions.shaping import add_aliases, conform, feature_columns, nan_to_null
from fleetlens.functions.silver import silver
from fleetlens.operators import dedup, ingest, kpi, labels
from fleetlens.operators.ingest import new_rows

T0 = datetime(2025, 1, 1)


def reading(**changes):
    row = {}
    for f in raw_schema().fields:
        row[f.name] = {T.StringType: "x", T.IntegerType: 0, T.DoubleType: 1.0}.get(type(f.dataType), T0)
    return {**row, "turbine_id": "T001", **changes}


def frame(spark, *changes):
    return spark.createDataFrame([reading(**c) for c in changes], raw_schema())


def test_raw_columns_and_aliases_fit_together():
    assert len(RAW_COLUMNS) == len(set(RAW_COLUMNS)) == 54
    assert not set(ALIASES) & set(RAW_COLUMNS)
    assert not {"ingestion_timestamp", "ingestion_date", "batch_id", "source_file"} & set(RAW_COLUMNS)


def test_aliases(spark):
    out = add_aliases(frame(spark, {"operating_state": "MAINTENANCE"}, {"operating_state": None})).collect()
    assert out[0]["power_output"] == pytest.approx(0.001) and out[0]["maintenance_flag"] == 1
    assert out[0]["oil_temperature"] == 1.0 and out[1]["maintenance_flag"] == 0
    assert all(a in out[0].asDict() for a in ALIASES)


def test_conform_is_strict_and_casts_flags(spark):
    df = frame(spark, {}).withColumn("failure_flag", F.lit(True))
    assert conform(df, raw_schema()).first()["failure_flag"] == 1
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("humidity"), raw_schema())
    with pytest.raises(ValueError, match="unexpected"):
        conform(df.withColumn("extra", F.lit(1)), raw_schema())


def test_nan_counts_as_missing_not_as_outlier(spark):
    row = silver(frame(spark, {"wind_speed": float("nan"), "gearbox_temperature": float("nan")})).first()
    assert row["is_wind_speed_valid"] and row["is_temperature_valid"] and not row["is_temp_outlier"]
    assert row["missing_count"] == 2 and row["wind_speed"] == 0.0 and row["gearbox_temperature"] == 50.0
    assert nan_to_null(frame(spark, {"humidity": float("nan")})).first()["humidity"] is None


def test_score_below_the_mark_with_all_ranges_in_order(spark):
    gaps = {"wind_speed": None, "active_power_kw": None, "gearbox_temperature": None, "rotor_speed_rpm": None}
    low = silver(frame(spark, {**gaps, "generator_temperature": 111.0, "vibration_y": 1.6})).first()
    assert low["quality_score"] == 59 and not low["is_valid_record"]
    edge = silver(frame(spark, {**gaps, "generator_temperature": 111.0})).first()
    assert edge["quality_score"] == 69 and edge["is_valid_record"]


def test_vibration_range_has_no_say(spark):
    row = silver(frame(spark, {"vibration_x": -1.0})).first()
    assert not row["is_vibration_valid"] and row["is_valid_record"] and not row["is_sensor_anomaly"]


def test_risk_bins_close_on_the_right(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.31,), (0.7,), (1.0,), (1.1,), (None,)], "p double")
    assert [r[0] for r in df.select(domain.risk_level("p")).collect()] == [None, "LOW", "MEDIUM", "MEDIUM", "HIGH", None, None]
    assert df.select(domain.risk_level("p", include_lowest=True)).first()[0] == "LOW"


def test_null_health_is_critical(spark):
    df = add_aliases(frame(spark, {"vibration_x": None})).withColumn("health_score", domain.health_score())
    row = df.withColumn("health_status", domain.health_status()).first()
    assert row["health_score"] == 0 and row["health_status"] == "CRITICAL"


def test_health_points_come_off_one_after_the_other(spark):
    # as one sum, the points lost here leave 59.99999999999999
    shaken = {"vibration_x": 0.03, "vibration_y": 1.76, "vibration_z": 0.28, "active_power_kw": 2000.0}
    df = add_aliases(frame(spark, shaken, {**shaken, "wind_speed": 11.0, "active_power_kw": 500.0}))
    rows = df.withColumn("health_score", domain.health_score()).withColumn("health_status", domain.health_status()).orderBy("active_power_kw").collect()
    assert [(r["health_score"], r["health_status"]) for r in rows] == [(50.0, "CRITICAL"), (60.0, "WARNING")]


def test_electrical_guards(spark):
    out = frame(spark, {"voltage_v": 0.0, "active_power_kw": 0.0}).select(*[c.alias(n) for n, c in domain.derived().items()]).first()
    assert out["current_calc"] == 0.0 and out["power_factor_calc"] == 1.0
    assert frame(spark, {"atmospheric_pressure": 1013.0, "ambient_temperature": 15.0}).select(domain.air_density()).first()[0] == pytest.approx(1.225)


def test_dedup_keeps_the_best_copy_and_limits_before_the_shuffle(spark):
    rows = [
        ("A", 1, 5.0, 1.0), ("A", 1, None, 1.0), ("A", 1, -999.0, 1.0), ("A", 1, float("nan"), 1.0),
        (None, 1, 2.0, None), (None, 1, 1.0, 1.0), ("B", 2, -999.0, 1.0), ("B", 2, None, 1.0), ("C", 3, -999.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "k string, t int, wind_speed double, v double")
    out = dedup.dedup_latest(df, ["k", "t"])
    assert {tuple(r) for r in out.collect()} == {("A", 1, 5.0, 1.0), (None, 1, 1.0, 1.0), ("B", 2, None, 1.0), ("C", 3, -999.0, 1.0)}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_dedup_prefers_the_newest_delivery_and_settles_ties_alike(spark):
    rows = [("A", T0, 1.0), ("A", T0 + timedelta(hours=1), None), ("A", None, 3.0), ("B", T0, 1.0), ("B", T0, 2.0)]
    schema = "k string, ingestion_timestamp timestamp, v double"
    found = [
        {(r["k"], r["v"]) for r in dedup.dedup_latest(spark.createDataFrame(order, schema).repartition(n), ["k"]).collect()}
        for order, n in ((rows, 1), (rows[::-1], 3))
    ]
    assert found[0] == found[1] and ("A", None) in found[0] and len(found[0]) == 2


def test_insert_only_merge(spark):
    schema = "k string, t int, v int"
    target = spark.createDataFrame([("A", 1, 0), (None, 1, 0)], schema)
    batch = spark.createDataFrame([("A", 1, 9), ("A", 2, 9), (None, 1, 9)], schema)
    assert {tuple(r) for r in new_rows(target, batch, ["k", "t"]).collect()} == {("A", 2, 9), (None, 1, 9)}


def test_upsert_into_a_path_is_idempotent(spark, tmp_path):
    path = f"{tmp_path}/bronze"
    schema = "turbine_id string, reading_ts timestamp_ntz, v int, ingestion_date date"
    day = T0.date()
    first = spark.createDataFrame([("A", T0 + timedelta(hours=h), h, day) for h in range(5)], schema)
    for _ in range(2):
        ingest.upsert_new_only(path, first.unionByName(first), ["turbine_id", "reading_ts"], "reading_ts")
    assert spark.read.parquet(path).count() == 5


def test_upsert_reads_the_days_of_the_batch_and_repeats_nothing(spark, tmp_path):
    path = f"{tmp_path}/bronze"
    schema = "turbine_id string, reading_ts timestamp_ntz, v int"
    rows = [("A", T0 + timedelta(days=d), d) for d in range(20)] + [(None, T0, 1), ("B", None, 2), (None, None, 3)]
    df = spark.createDataFrame(rows, schema)
    ingest.upsert_new_only(path, df.where("v < 10"), ["turbine_id", "reading_ts"], "reading_ts")
    for _ in range(2):
        ingest.upsert_new_only(path, df, ["turbine_id", "reading_ts"], "reading_ts")
    stored = spark.read.parquet(path)
    assert stored.count() == len(rows) and stored.select("event_date").distinct().count() == 21
    part = ingest.within_batch_dates(stored, df.where("v = 4").withColumn("event_date", F.to_date("reading_ts")))
    assert {r.v for r in part.collect()} == {4}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "PartitionFilters: [event_date" in plan
    undated = ingest.within_batch_dates(stored, df.where("v = 2").withColumn("event_date", F.to_date("reading_ts")))
    assert {r.turbine_id for r in undated.collect()} == {"A", "B", None}


def test_rows_without_a_key_meet_by_a_number_and_are_compared_as_a_whole(spark):
    schema = "k string, t int, " + ", ".join(f"c{i} double" for i in range(40))

    def row(t, *first):
        return (None, t, *first, *[0.5] * (40 - len(first)))

    nan = float("nan")
    target = spark.createDataFrame([row(1, 1.0, None), row(2, nan, 0.0), row(3, 3.0, 3.0)], schema)
    batch = spark.createDataFrame([row(1, 1.0, None), row(2, nan, -0.0), row(3, 3.0, 4.0), row(3, 3.0, None), row(1, 1.0, None)], schema)
    added = ingest.replayed(target, batch, ["k", "t"])
    assert sorted((r.t, r.c1 or 0) for r in added.collect()) == [(3, 0), (3, 4.0)] and added.columns == batch.columns
    plan = added._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct" not in plan and plan.count("xxhash64") == 2


def test_horizon_is_closed_and_exact(spark):
    keys = Keys(time="ts")
    rows = [("A", T0, 0), ("A", T0 + timedelta(seconds=1), 0), ("A", T0 + timedelta(hours=24, seconds=1), 1), ("B", T0, 0)]
    df = spark.createDataFrame([(*r, "F") for r in rows], "turbine_id string, ts timestamp, failure_flag int, farm_id string")
    for form in (labels.label_within_horizon, labels.label_by_next_event):
        out = {(r[0], r[1]): r[2] for r in form(df, keys).select("turbine_id", "ts", labels.label_name()).collect()}
        assert out[("A", rows[0][1])] == 0 and out[("A", rows[1][1])] == 1 and out[("B", T0)] == 0


def test_null_profile_and_feature_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b")], "x int, y double, z string")
    assert dict(map(tuple, kpi.null_profile(df).collect())) == {"x": 1, "y": 2, "z": 0, "TOTAL": 3}
    assert feature_columns(df, ["y"]) == ["x"] and feature_columns(df, ["y"], numeric_only=False) == ["x", "z"]


def test_an_upsert_writes_files_by_days_plus_tasks_not_by_their_product(spark, tmp_path):
    from pathlib import Path

    days, tasks = 40, int(spark.conf.get("spark.sql.shuffle.partitions"))
    feed = spark.range(days * 200).selectExpr("concat('T', id % 50) turbine_id", "timestamp_seconds(1704067200 + id * 432) timestamp", "id / 2.0D wind_speed")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as where there are many rows
    try:
        ingest.upsert_new_only(f"{tmp_path}/t", feed, ["turbine_id", "timestamp"], "timestamp")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert spark.read.parquet(f"{tmp_path}/t").count() == days * 200
    assert len(list(Path(f"{tmp_path}/t").rglob("*.parquet"))) <= days + tasks


def test_rounding_of_a_wide_table_makes_no_decimals(spark):
    """The same numbers as Spark's `round`, which the plan leaves to those beyond 2^50 units of the last place."""
    values = [0.0, -0.0, 1.5e-7, -1.5e-7, -1e-9, 0.1234564, 0.1234566, -0.1234566, 2.5, 1234567.8901236, -98765.4321987, 1e9, -1e9, 3e9, 1e15, -1e300, 1e300]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    told = [repr(r[0]) for r in rounded(df, ["x"]).collect()]
    assert told == [repr(r[0]) for r in df.select(F.round(F.col("x") + NUDGE, DIGITS)).collect()]
    many = spark.range(20_000).selectExpr("(rand(7) - 0.5D) * pow(10D, id % 9) as x")
    pairs = many.withColumn("y", F.round(F.col("x") + NUDGE, DIGITS)).withColumn("z", F.col("x"))
    assert rounded(pairs, ["z"]).where("y <> z").count() == 0
    plan = rounded(pairs.limit(1), ["x"])._jdf.queryExecution().optimizedPlan().toString()
    assert "ceil(" in plan.lower() and plan.lower().count("else round(") == 1
