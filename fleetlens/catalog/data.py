"""Stages shared by several queries, all derived from the whole given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import label_name
from fleetlens.functions.domain import vibration_magnitude
from fleetlens.functions.silver import silver as to_silver
from fleetlens.operators import evaluate, labels
from fleetlens.session import cut_lineage
from fleetlens.catalog.readings import KEYS, readings

AS_OF = datetime(2024, 2, 1)
#: Width of a chunk of time: the feed covers 30 days, so each machine has 20 chunks.
CHUNK = 36 * 3600
#: The same for frames over 36 earlier rows, which is 18 days here: every row is copied into all chunks that see it.
FRAME_CHUNK = 72 * 3600
#: Machines of at most so many rows are not cut for such frames: most have some tens, and six copies of a row each would be made.
WHOLE_ROWS = 20_000
LABEL = label_name()


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return to_silver(readings(spark, folder))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_within_horizon(silver(spark, folder), KEYS)


def training(spark: SparkSession, folder: str) -> DataFrame:
    return labels.training_set(silver(spark, folder), KEYS)


def stored_training(spark: SparkSession, folder: str) -> DataFrame:
    """The training table as later stages meet it: stored."""
    return cut_lineage(training(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled readings with a score that does not depend on a fitted model."""
    step = (F.col("event_id").cast("long") * 61) % 1001
    return labelled(spark, folder).where("failure_flag = 0").select(
        "event_id", "turbine_id", "farm_id", "reading_ts", F.col(LABEL).alias("label"),
        (step.cast("double") / 1000.0).alias("failure_probability"), (step >= 500).cast("int").alias("prediction"),
    )


def model_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(model, farm, label, score, prediction) of four scorers over the same readings."""
    step = (F.col("event_id").cast("long") * 61) % 1001
    scorers = {
        "hashed": (step.cast("double") / 1000.0, 0.5),
        "temperature": (F.col("gearbox_temperature") / 160.0, 0.5),
        "vibration": (F.least(vibration_magnitude() / 3.0, F.lit(1.0)), 0.2),
        "health": (F.lit(1.0) - F.col("health_status"), 0.1),
    }
    entries = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("model_name"), s.alias("score"), (s >= cut).cast("int").alias("prediction"))
                for name, (s, cut) in scorers.items()
            ]
        )
    )
    return (
        labelled(spark, folder).where("failure_flag = 0")
        .select("farm_id", F.col(LABEL).alias("label"), entries.alias("m"))
        .select("farm_id", "label", "m.*")
    )


def halves(df: DataFrame, fraction: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """Earlier part (70%, if not stated) and later part by time and machine."""
    return evaluate.baseline_and_current(df, KEYS, fraction)
