"""Chunked computations must equal the plain window, whatever the skew."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens.config import Keys
from fleetlens.operators import episodes, evaluate, features, labels
from fleetlens.operators.ordering import (
    CHUNK, GROUP, PART, before_key, drop_halo, epoch_micros, halo_rows, keys_at_ranks, range_chunks, running, time_chunks,
)

KEYS = Keys(time="reading_ts")


@pytest.fixture(scope="module")
def skewed(spark):
    """One machine holds half of all rows, a null machine a sixth; times are uneven."""
    df = spark.range(3000).selectExpr(
        "case when id % 6 < 3 then 'HOT' when id % 6 = 3 then null else concat('M', id % 7) end as turbine_id",
        "concat('F', id % 2) as farm_id",
        "timestamp_seconds(1700000000 + cast(pow(id, 1.3) as bigint) * 20 + id) as reading_ts",
        "cast(id % 37 as double) as gearbox_temperature", "cast(id % 11 as double) as generator_temperature",
        "cast(id % 13 as double) as bearing_temperature", "cast(id % 5 as double) as vibration_x",
        "cast(id % 3 as double) as vibration_y", "cast(id % 2 as double) as vibration_z",
        "cast(id % 17 as double) / 10 as power_output", "cast(id % 23 as double) as wind_speed",
        "cast(id % 4 as double) as rotor_speed_rpm",
        "case when id % 97 < 4 then 1 else 0 end as failure_flag", "concat('T', id % 3) as failure_type", "id",
    ).repartition(5)
    return df.persist()


WHOLE = 10**9  # one chunk
WIDTHS = [3_000, 20_000, 200_000]


def rows(df, *columns):
    return sorted(map(tuple, df.select("id", *columns).collect()))


def chunks(df, seconds, order="reading_ts"):
    return time_chunks(df, ["turbine_id"], order, seconds)


def test_chunks_are_consecutive_and_a_function_of_the_row(skewed):
    hot = chunks(skewed, 20_000).where("turbine_id = 'HOT'")
    ranges = hot.groupBy(CHUNK).agg(F.min("reading_ts"), F.max("reading_ts")).orderBy(CHUNK).collect()
    assert len(ranges) > 20 and all(a[2] < b[1] for a, b in zip(ranges, ranges[1:]))
    part = chunks(skewed.where("id % 3 = 0"), 20_000)
    assert part.select("id", CHUNK).join(hot.select("id", F.col(CHUNK).alias("c")), "id").where(f"{CHUNK} <> c").count() == 0


def test_task_size_does_not_grow_with_the_table(skewed):
    """Ten times the rows, over ten times the time: as many rows in the largest chunk."""
    longer = skewed.withColumn("again", F.explode(F.sequence(F.lit(0), F.lit(9))))
    longer = longer.withColumn("reading_ts", F.expr("reading_ts + make_dt_interval(again * 10)"))
    largest = [chunks(df, 20_000).groupBy(*PART).count().agg(F.max("count")).first()[0] for df in (skewed, longer)]
    assert longer.count() == 30_000 and largest[1] <= 1.5 * largest[0]


@pytest.mark.parametrize("seconds", WIDTHS)
@pytest.mark.parametrize("descending", [False, True])
def test_running_equals_window(skewed, seconds, descending):
    order = F.desc("reading_ts") if descending else F.asc("reading_ts")
    w = Window.partitionBy("turbine_id").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    everyone = Window.partitionBy("turbine_id")
    marked = skewed.withColumn("e", F.when(F.col("failure_flag") == 1, F.col("id")))
    plain = marked.withColumns({"s": F.sum("failure_flag").over(w), "m": F.min("e").over(w), "t": F.sum("id").over(everyone)})
    ours = running(
        chunks(marked, seconds), "reading_ts", {"s": ("sum", "failure_flag"), "m": ("min", "e")}, descending=descending, whole={"t": ("sum", "id")}
    )
    assert rows(ours, "s", "m", "t") == rows(plain, "s", "m", "t")


def test_running_over_range_partitions_equals_window(skewed):
    w = Window.partitionBy("farm_id").orderBy("wind_speed")
    counts = skewed.groupBy("farm_id", "wind_speed").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    merges = "spark.sql.adaptive.coalescePartitions.enabled"
    skewed.sparkSession.conf.set(merges, "false")
    try:
        ranged = range_chunks(counts, ["farm_id"], "wind_speed")
    finally:
        skewed.sparkSession.conf.set(merges, "true")
    assert ranged.select(CHUNK).distinct().count() > 1
    ours = running(ranged, "wind_speed", {"upto": ("sum", "n")}, whole={"all": ("sum", "n")})
    plain = counts.withColumns({"upto": F.sum("n").over(w), "all": F.sum("n").over(Window.partitionBy("farm_id"))})
    assert rows(ours, "upto", "all") == rows(plain, "upto", "all")


@pytest.mark.parametrize("seconds", WIDTHS)
@pytest.mark.parametrize("reach", [1, 36, 400])
def test_row_frames_equal_window(skewed, seconds, reach):
    w = Window.partitionBy("turbine_id").orderBy("reading_ts")
    columns = lambda s: {"t": F.sum("id").over(s.rowsBetween(-reach, 0)), "l": F.lag("id", reach).over(s)}
    chunked = Window.partitionBy(*PART).orderBy("reading_ts")
    ours = drop_halo(halo_rows(chunks(skewed, seconds), "reading_ts", reach, ["id"]).withColumns(columns(chunked)))
    assert rows(ours, "t", "l") == rows(skewed.withColumns(columns(w)), "t", "l")
    assert ours.columns == skewed.columns + ["t", "l"]


def test_row_frames_with_gaps_and_rows_without_a_time(spark):
    """Chunks of one row, long gaps, and readings whose time is unknown, which come first."""
    df = spark.createDataFrame([(i, "A", i * i * 1000) for i in range(60)] + [(60, "A", None), (61, None, 5), (62, None, None)], "id long, turbine_id string, at long")
    w = Window.partitionBy("turbine_id").orderBy("at")
    columns = lambda s: {"t": F.sum("id").over(s.rowsBetween(-7, 0)), "l": F.lag("id", 3).over(s)}
    ours = drop_halo(halo_rows(chunks(df, 500, "at"), "at", 7, ["id"]).withColumns(columns(Window.partitionBy(*PART).orderBy("at"))))
    assert rows(ours, "t", "l") == rows(df.withColumns(columns(w)), "t", "l")


@pytest.mark.parametrize("pane", [9000, 700])
def test_time_frames_longer_than_a_task(skewed, pane):
    """Frames of 9,000 and 31,000 seconds from panes down to 700: the plain range window, to the ninth digit."""
    rolled = tuple(r for r in features.ROLLING)
    ours = features.time_rolling(skewed, KEYS, rolled, 9000, 31_000, pane)
    timed = features.with_vibration(skewed).withColumn("sec", F.unix_timestamp("reading_ts"))
    w = Window.partitionBy("turbine_id").orderBy("sec")
    span = {"short": 9000, "long": 31_000}
    plain = timed.withColumns({r.name: getattr(F, r.stat)(r.source).over(w.rangeBetween(-span[r.span], 0)) for r in rolled})
    names = [r.name for r in rolled]
    assert rows(ours.withColumns({c: F.round(c, 9) for c in names}), *names) == rows(plain.withColumns({c: F.round(c, 9) for c in names}), *names)
    assert ours.columns == timed.drop("sec").columns + names


def test_time_frames_of_odd_tables(spark):
    """Missing values, several readings of one second, a large offset, no time, and one reading alone."""
    values = [(i, "A", 10 * (i // 3), None if i % 4 == 0 else 1e6 + i % 5) for i in range(90)] + [(90, "B", 7, 1.0), (91, None, 7, 2.0), (92, "A", None, 3.0), (93, "A", None, 5.0)]
    df = spark.createDataFrame(values, "id long, turbine_id string, s long, x double").withColumn("reading_ts", F.timestamp_seconds("s"))
    rolled = (features.Rolling("m", "avg", "x", "short"), features.Rolling("d", "stddev", "x", "short"), features.Rolling("l", "stddev", "x", "long"))
    w = Window.partitionBy("turbine_id").orderBy("s")
    plain = df.withColumns({"m": F.avg("x").over(w.rangeBetween(-25, 0)), "d": F.stddev("x").over(w.rangeBetween(-25, 0)), "l": F.stddev("x").over(w.rangeBetween(-110, 0))})
    for pane in (25, 3):
        ours = features.time_rolling(df.withColumns({c: F.lit(0.0) for c in ("vibration_x", "vibration_y", "vibration_z")}), KEYS, rolled, 25, 110, pane)
        assert rows(ours.withColumns({c: F.round(c, 6) for c in "mdl"}), *"mdl") == rows(plain.withColumns({c: F.round(c, 6) for c in "mdl"}), *"mdl")
    with pytest.raises(ValueError):
        features.time_rolling(df.withColumns({c: F.lit(0.0) for c in ("vibration_x", "vibration_y", "vibration_z")}), KEYS, rolled, 25, 110, 30)


def test_operators_do_not_depend_on_chunks(skewed):
    base = features.with_vibration(skewed)
    both = [features.windowed(base, KEYS, chunk_seconds=s) for s in (WHOLE, 20_000)]
    names = [c for c in both[0].columns if c.endswith(("_1h", "_6h", "_1", "_6", "_12"))]
    plain, chunked = (rows(b.withColumns({c: F.round(c, 9) for c in names}), *names) for b in both)
    assert plain == chunked
    hours = [features.cumulative_hours(skewed, KEYS, chunk_seconds=s) for s in (WHOLE, 20_000)]
    assert rows(hours[0], "operating_hours") == rows(hours[1], "operating_hours")
    runs = [sorted(map(tuple, episodes.failure_episodes(skewed, KEYS, chunk_seconds=s).fillna("-").collect())) for s in (WHOLE, 20_000, 3_000)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) > 50


def test_an_episode_over_three_chunks(spark):
    flags = [0, 1, 1, 0, 0, 1, 1, 1, 1, 1, 1, 1, 0, 1]
    df = spark.createDataFrame(
        [("M", "F", i * 600, f, f"T{i}") for i, f in enumerate(flags)], "turbine_id string, farm_id string, s long, failure_flag int, failure_type string"
    ).withColumn("reading_ts", F.timestamp_seconds("s"))
    found = episodes.failure_episodes(df, KEYS, chunk_seconds=1800).orderBy("episode").select(
        "episode", F.unix_timestamp("failure_timestamp"), F.unix_timestamp("last_failing_timestamp"), F.unix_timestamp("resumed_timestamp"),
        "readings", "failure_type",
    )
    assert [tuple(r) for r in found.collect()] == [(1, 600, 1200, 1800, 2, "T1"), (2, 3000, 6600, 7200, 7, "T5"), (3, 7800, 7800, None, 1, "T13")]


def test_episodes_of_readings_at_one_instant_do_not_depend_on_their_order(spark):
    feed = [("M", "F1", 0, 1, "B"), ("M", "F0", 0, 1, "A"), ("M", "F1", 600, 0, None), ("M", "F0", 600, 1, "C"), ("M", "F0", 1200, 1, "D"), ("M", "F1", 1800, 0, None)]
    for seconds in (600, WHOLE):
        for part in (feed, feed[::-1]):
            df = spark.createDataFrame(part, "turbine_id string, farm_id string, s long, failure_flag int, failure_type string").coalesce(1)
            found = episodes.failure_episodes(df.withColumn("reading_ts", F.timestamp_seconds("s")), KEYS, chunk_seconds=seconds).orderBy("episode").select(
                "farm_id", F.unix_timestamp("failure_timestamp"), F.unix_timestamp("last_failing_timestamp"), F.unix_timestamp("resumed_timestamp"),
                "readings", "failure_type",
            )
            assert [tuple(r) for r in found.collect()] == [("F0", 0, 600, 600, 3, "A"), ("F0", 1200, 1200, 1800, 1, "D")]


def test_label_forms_agree(skewed):
    name = labels.label_name(1)
    joined = labels.label_within_horizon(skewed, KEYS, 1)
    windowed, chunked = (labels.label_by_next_event(skewed, KEYS, 1, chunk_seconds=s) for s in (WHOLE, 3_000))
    assert rows(joined, name) == rows(windowed, name) == rows(chunked, name)
    assert rows(windowed, "failure_time") == rows(chunked, "failure_time")


def test_interval_sweep_equals_range_join(spark, skewed):
    spans = episodes.failure_episodes(skewed, KEYS).select(
        "turbine_id", F.col("failure_timestamp").alias("start"), F.expr("resumed_timestamp + interval 3 hours").alias("end")
    ).persist()
    s = spans.toDF("m", "start", "end")
    during = (F.col("reading_ts") >= F.col("start")) & (F.col("end").isNull() | (F.col("reading_ts") <= F.col("end")))
    brute = skewed.join(s, (F.col("turbine_id") == F.col("m")) & during, "left_semi")
    inside = {r[0] for r in brute.select("id").collect()}
    for seconds in (WHOLE, 20_000):
        ours = episodes.label_intervals(skewed, spans, KEYS, chunk_seconds=seconds)
        assert {r[0] for r in ours.where("in_maintenance = 1").select("id").collect()} == inside
        assert ours.count() == 3000 and set(ours.columns) == {*skewed.columns, "in_maintenance"}


@pytest.mark.parametrize("order", [["wind_speed", "turbine_id", "reading_ts"], ["reading_ts", "id"], ["turbine_id", "id"], ["id"]])
def test_rank_keys_match_a_sort(skewed, order):
    """Heavy ties, nulls, text, doubles, times; every rank leaves exactly as many rows before it."""
    ranked = [tuple(r) for r in skewed.orderBy(*[F.asc_nulls_first(c) for c in order]).select(*order).collect()]
    ranks = [0, 1, 500, 1499, 2100, 2999, 3000]
    codes, keys = keys_at_ranks(skewed, order, lambda n: ranks)
    assert keys[-1] is None
    before = [before_key(codes, k) for k in keys[:-1]]
    assert [skewed.where(b).count() for b in before] == [ranked.index(ranked[r]) for r in ranks[:-1]]
    same = skewed.select(*order).distinct().count() == 3000
    assert not same or [ranked.index(ranked[r]) for r in ranks[:-1]] == ranks[:-1]


def test_rank_keys_of_extreme_numbers(spark):
    values = [-(2**63), 2**63 - 1, 0, 5, 5, -1, None]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    codes, keys = keys_at_ranks(df, ["v"], lambda n: range(n))
    assert [k[0] for k in keys] == [None, -(2**63), -1, 0, 5, 5, 2**63 - 1]
    texts = ["", "a", "a\0", "ab", "abcdefg", "abcdefgh", "abcdefh", None, "é"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    codes, keys = keys_at_ranks(df, ["v"], lambda n: range(n))
    assert [df.where(before_key(codes, k)).count() for k in keys] == list(range(9))


def test_time_order_when_clocks_change(spark):
    """One reading a minute while Central Europe sets its clocks back, and forward."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        for start in (1698530400, 1711836000):  # the nights of 2023-10-29 and 2024-03-31
            instants = spark.range(3000).select("id", F.timestamp_seconds(F.lit(start) + F.col("id") * 60).alias("reading_ts"), F.lit("M").alias("turbine_id"))
            for df in (instants, instants.withColumn("reading_ts", F.expr(f"timestamp_ntz'2023-10-28 22:00:00' + make_dt_interval(0, 0, id)"))):
                for rank in (1500, 1540):
                    codes, keys = keys_at_ranks(df, ["reading_ts", "turbine_id"], lambda n: [rank])
                    assert df.where(before_key(codes, keys[0])).count() == rank
                assert df.select(epoch_micros(df, "reading_ts")).distinct().count() == 3000
                split = evaluate.temporal_split(df, KEYS)
                assert dict(split.groupBy("split").count().collect()) == {"train": 2100, "validation": 450, "test": 450}
                assert split.where("split = 'train'").agg(F.max("id")).first()[0] == 2099
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_split_counts_are_exact(skewed):
    split = evaluate.temporal_split(skewed, KEYS, order=["reading_ts", "id"])
    assert dict(split.groupBy("split").count().collect()) == {"train": 2100, "validation": 450, "test": 450}
    whole = evaluate.temporal_split(skewed, KEYS, train=1.0, validation=0.0)
    assert dict(whole.groupBy("split").count().collect()) == {"train": 3000}
    sides = evaluate.temporal_split(skewed.withColumn("reading_ts", F.date_trunc("day", "reading_ts")), KEYS, on_time_boundary=True)
    assert sides.groupBy("reading_ts").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert evaluate.temporal_split(skewed.limit(0), KEYS).count() == 0


def test_split_needs_no_shuffle_of_the_rows(skewed):
    plan = evaluate.temporal_split(skewed, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_no_row_moves_by_its_group_alone(skewed):
    """Also without broadcasts, rows are dealt by (group, chunk); only chunk summaries meet by group."""
    session = skewed.sparkSession
    before = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = features.windowed(features.with_vibration(skewed), KEYS, chunk_seconds=20_000)._jdf.queryExecution().executedPlan().toString()
    finally:
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    import re

    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert dealt and all("turbine_id" not in d for d in dealt)
    assert sum(CHUNK not in d for d in dealt) == 1 and GROUP in dealt[0]
