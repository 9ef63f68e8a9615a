"""From flagged readings to events, and from events back to readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.config import Keys
from fleetlens.operators.ordering import CHUNK, CHUNK_SECONDS, GROUP, PART, drop_chunk, running, time_chunks
from fleetlens.session import cut_lineage


def failure_episodes(
    df: DataFrame,
    keys: Keys = Keys(),
    event_flag: str = "failure_flag",
    event_type: str = "failure_type",
    interval_minutes: float = 10.0,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """One row per run of consecutive failing readings of a machine.

    Runs are found per chunk and joined where one goes on: a chunk's summary is the flag it ends
    with and the number of runs that start in it. Scanned over a machine's chunks, summaries tell each
    chunk whether a run is open when it begins and how many came before; a run's parts then meet in
    a grouping. Only failing readings and the one that ends a run leave their chunk. Of several readings at one
    instant, those that fail come first; what names a run is the smallest site and type of its first instant.
    """
    narrow = df.select(keys.entity, keys.site, keys.time, F.coalesce(event_flag, F.lit(0)).alias("__on"), F.col(event_type).alias("__type"))
    narrow = narrow.withColumn("__calm", F.col("__on") != 1)
    chunked = time_chunks(narrow, [keys.entity], keys.time, chunk_seconds)
    order = [keys.time, "__calm"]
    inside = F.lag("__on").over(Window.partitionBy(*PART).orderBy(*order))
    last = F.max_by("__on", F.struct(*order))
    open_before = F.lag("__last").over(Window.partitionBy(GROUP).orderBy(CHUNK))
    carried = chunked.groupBy(*PART).agg(last.alias("__last")).select(*PART, open_before.alias("__open"))
    edges = (
        chunked.withColumn("__inside", inside).where((F.col("__on") == 1) | (F.col("__inside") == 1) | F.col("__inside").isNull())
        .join(carried, list(PART)).withColumn("__before", F.coalesce("__inside", "__open", F.lit(0)))
        .where((F.col("__on") == 1) | (F.col("__before") == 1))
        .withColumn("__starts", ((F.col("__on") == 1) & (F.col("__before") == 0)).cast("long"))
    )
    failing = F.col("__on") == 1

    def first(column: str) -> Column:
        return F.min_by(F.col(column), F.when(failing & F.col(keys.time).isNotNull(), F.struct(keys.time, column)))

    runs = (
        running(edges, keys.time, {"episode": ("sum", "__starts")}, order_by=order)
        .groupBy(keys.entity, "episode")
        .agg(
            first(keys.site).alias(keys.site),
            F.min(F.when(failing, F.col(keys.time))).alias("failure_timestamp"),
            F.max(F.when(failing, F.col(keys.time))).alias("last_failing_timestamp"),
            F.min(F.when(~failing, F.col(keys.time))).alias("resumed_timestamp"),
            F.count_if(failing).alias("readings"),
            first("__type").alias("failure_type"),
        )
    )
    return runs.withColumns(
        {
            "failure_id": F.format_string("F-%s-%05d", F.col(keys.entity), F.col("episode")),
            "downtime_hours": F.col("readings") * interval_minutes / 60.0,
        }
    )


def maintenance_episodes(failures: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """A corrective job for every failure that has ended, starting when it did."""
    ended = failures.where(F.col("resumed_timestamp").isNotNull())
    return ended.select(
        F.format_string("M-%s-%05d", F.col(keys.entity), F.col("episode")).alias("maintenance_id"),
        keys.entity,
        keys.site,
        F.col("resumed_timestamp").alias("maintenance_timestamp"),
        F.lit("CORRECTIVE").alias("maintenance_type"),
        F.col("failure_type").alias("component"),
        "downtime_hours",
        F.lit(False).alias("planned_flag"),
    )


def label_intervals(
    df: DataFrame,
    intervals: DataFrame,
    keys: Keys = Keys(),
    start: str = "start",
    end: str = "end",
    out: str = "in_maintenance",
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """1 for readings inside any closed interval of their machine; an interval without end stays open.

    A sweep over time: starts count +1, ends -1 after their instant, and a reading is inside
    while the running count is positive. Cost is linear in readings plus intervals, whatever
    their overlap, and nothing is broadcast.
    """
    machine, time = keys.entity, keys.time
    bounded = intervals.where(F.col(start) <= F.coalesce(F.col(end), F.col(start)))
    mark = F.explode(
        F.array(
            F.struct(F.col(start).alias("at"), F.lit(0).alias("turn"), F.lit(1).alias("step")),
            F.struct(F.col(end).alias("at"), F.lit(2).alias("turn"), F.lit(-1).alias("step")),
        )
    )
    marks = bounded.select(machine, mark.alias("m")).where(F.col("m.at").isNotNull()).select(
        machine, F.col("m.at").alias(time), F.col("m.turn").alias("__turn"), F.col("m.step").alias("__step")
    )
    readings = df.withColumns({"__turn": F.lit(1), "__step": F.lit(0)})
    marks = cut_lineage(marks)  # few rows at the end of a long plan, read twice
    events = time_chunks(readings.unionByName(marks, allowMissingColumns=True), [machine], time, chunk_seconds)
    swept = running(events, time, {"__open": ("sum", "__step")}, order_by=[time, "__turn"])
    inside = F.coalesce((F.col("__open") > 0) & F.col(machine).isNotNull(), F.lit(False)).cast("int")
    return drop_chunk(swept.where(F.col("__turn") == 1).withColumn(out, inside)).drop("__turn", "__step", "__open")
