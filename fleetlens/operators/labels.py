"""Supervised labels: will this machine fail within the horizon?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.config import TRAINING_COLUMNS, Keys, label_name
from fleetlens.operators.dedup import drop_duplicates
from fleetlens.operators.ordering import CHUNK_SECONDS, drop_chunk, epoch_seconds, running, time_chunks

_SEC = "__sec"


def label_within_horizon(
    df: DataFrame, keys: Keys = Keys(), horizon_hours: int = 24, event_flag: str = "failure_flag", label: str | None = None
) -> DataFrame:
    """1 where the machine has an event within [t, t + horizon], in whole seconds.

    Events are reduced to their first and last time per machine and horizon-wide slot. A
    horizon starting in one slot ends in the next, so a reading needs exactly two of those
    values: the last event of its own slot and the first of the following one. The join is a
    plain equi-join of at most one match per reading: no range condition, no fan-out, and a
    crowded machine is spread over its slots.
    """
    width = horizon_hours * 3600
    sec = epoch_seconds(df, keys.time)
    slot = F.floor(sec / F.lit(width)).cast("long")
    events = (
        df.where((F.col(event_flag) == 1) & F.col(keys.entity).isNotNull() & F.col(keys.time).isNotNull())
        .groupBy(F.col(keys.entity).alias("__machine"), slot.alias("__at"))
        .agg(F.min(sec).alias("__first"), F.max(sec).alias("__last"))
    )
    reach = F.explode(
        F.array(
            F.struct(F.col("__at").alias("slot"), F.col("__last").alias("own"), F.lit(None).cast("long").alias("next")),
            F.struct((F.col("__at") - 1).alias("slot"), F.lit(None).cast("long").alias("own"), F.col("__first").alias("next")),
        )
    )
    nearest = (
        events.select("__machine", reach.alias("__r"))
        .groupBy("__machine", F.col("__r.slot").alias("__at"))
        .agg(F.max("__r.own").alias("__own"), F.min("__r.next").alias("__next"))
    )
    hit = (F.col("__own") >= sec) | (F.col("__next") <= sec + width)
    return (
        df.withColumn("__slot", slot)
        .join(nearest, (F.col(keys.entity) == F.col("__machine")) & (F.col("__slot") == F.col("__at")), "left")
        .withColumn(label or label_name(horizon_hours), F.coalesce(hit, F.lit(False)).cast("int"))
        .drop("__slot", "__machine", "__at", "__own", "__next")
    )


def next_event(
    df: DataFrame,
    keys: Keys = Keys(),
    event_flag: str = "failure_flag",
    out: str = "next_failure_sec",
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Epoch second of the machine's next event at or after each reading, or null.

    A minimum over the rows that follow: one growing frame over the descending order.
    """
    timed = df.withColumns(
        {
            _SEC: epoch_seconds(df, keys.time),
            "__event": F.when(F.col(event_flag) == 1, epoch_seconds(df, keys.time)),
        }
    )
    chunked = time_chunks(timed, [keys.entity], _SEC, chunk_seconds)
    return drop_chunk(running(chunked, _SEC, {out: ("min", "__event")}, descending=True)).drop(_SEC, "__event")


def label_by_next_event(
    df: DataFrame,
    keys: Keys = Keys(),
    horizon_hours: int = 24,
    event_flag: str = "failure_flag",
    label: str | None = None,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """The same label by window, with the lead time to the event where it lies in the horizon."""
    width = horizon_hours * 3600
    sec = epoch_seconds(df, keys.time)
    ahead = next_event(df, keys, event_flag, "__ahead", chunk_seconds)
    inside = F.col(keys.entity).isNotNull() & (F.col("__ahead") <= sec + width)
    return ahead.withColumns(
        {
            label or label_name(horizon_hours): F.coalesce(inside, F.lit(False)).cast("int"),
            "failure_time": F.when(inside, F.col("__ahead")),
            "lead_hours": F.when(inside, (F.col("__ahead") - sec) / 3600.0),
        }
    ).drop("__ahead")


def select_training(df: DataFrame, keys: Keys = Keys(), horizon_hours: int = 24, label: str | None = None) -> DataFrame:
    """The training projection: identifiers, measurements, target."""
    return df.select(keys.entity, keys.site, keys.time, *TRAINING_COLUMNS, label or label_name(horizon_hours))


def training_set(
    df: DataFrame, keys: Keys = Keys(), horizon_hours: int = 24, event_flag: str = "failure_flag", unique: bool = True
) -> DataFrame:
    """Labelled readings of machines that are not failing already.

    Ingestion leaves one row per reading; `unique=False` removes copies that came another way.
    """
    labelled = label_within_horizon(df, keys, horizon_hours, event_flag)
    if not unique:
        labelled = drop_duplicates(labelled, keys.reading)
    return select_training(labelled.where(F.col(event_flag) == 0), keys, horizon_hours)
