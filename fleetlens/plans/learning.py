"""Feature table to fitted candidates, champion and predictions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import Keys, TableLayout, label_name
from fleetlens.functions.shaping import feature_columns
from fleetlens.operators import evaluate, train
from fleetlens.sources.tables import append_history, read_table, table_exists, write_overwrite

REGISTERED = "failure_model"


def _evaluations(layout: TableLayout) -> str:
    return layout.name(layout.ml, "evaluation_scores")


def train_and_compare(
    spark: SparkSession,
    model_root: str,
    layout: TableLayout = TableLayout(),
    keys: Keys = Keys(),
    candidates: Sequence[train.Candidate] = train.CANDIDATES,
    horizon_hours: int = 24,
    min_recall: float = 0.80,
    as_of: datetime | None = None,
    split: DataFrame | None = None,
) -> DataFrame:
    """Fits every candidate on the past, compares them on what follows, promotes the champion.

    Models are saved under `model_root`/run id. The scores of the validation and test parts are
    stored, so that later stages need nothing from this process. `split` is the stored feature table as
    `temporal_split` marks it, where a caller has it already.
    """
    label = label_name(horizon_hours)
    ids = [keys.entity, keys.site, keys.time]
    split = evaluate.temporal_split(read_table(spark, layout.features), keys) if split is None else split
    names = feature_columns(split, [*ids, label, "split"])
    fit_on = split.where("split = 'train'")
    runs = {}
    models = train.train_models(fit_on, names, label, candidates)
    for position, candidate in enumerate(candidates):
        run_id, fitted = str(uuid.uuid4()), models[candidate.name]
        fitted.write().overwrite().save(f"{model_root}/{run_id}")
        scored = train.score(split.where("split <> 'train'"), fitted, [*ids, label, "split"], names, run_id=run_id, as_of=as_of)
        scored = scored.withColumn("model_name", F.lit(candidate.name))
        if position == 0:
            write_overwrite(scored, _evaluations(layout))
        else:
            append_history(scored, _evaluations(layout))
        runs[candidate.name] = run_id
    held_out = read_table(spark, _evaluations(layout))
    measured = evaluate.model_metrics(
        held_out.where("split = 'validation'"), label, "prediction", "failure_probability", ["model_name", "model_run_id"]
    )
    selected = evaluate.select_champion(evaluate.compare_models(measured), min_recall)
    write_overwrite(
        selected.withColumnRenamed("model_run_id", "run_id").withColumn("training_timestamp", evaluate.now(as_of)),
        layout.model_comparison,
    )
    _promote(spark, layout, as_of)
    return read_table(spark, layout.model_comparison)


def _promote(spark: SparkSession, layout: TableLayout, as_of: datetime | None) -> None:
    comparison = read_table(spark, layout.model_comparison)
    if comparison.where("is_champion").isEmpty():
        return
    known = table_exists(spark, layout.champions)
    version = evaluate.next_version(read_table(spark, layout.champions), REGISTERED) if known else 1
    row = evaluate.promotions(comparison, REGISTERED, evaluate.now(as_of), version)
    with_run = row.join(comparison.where("is_champion").select(F.col("model_name").alias("algorithm"), "run_id"), "algorithm")
    append_history(with_run, layout.champions)


def champion(spark: SparkSession, layout: TableLayout = TableLayout()) -> tuple[str, str, int] | None:
    """(algorithm, run id, version) of the newest promotion of the last comparison, if it has a champion."""
    if not table_exists(spark, layout.model_comparison) or not table_exists(spark, layout.champions):
        return None
    if read_table(spark, layout.model_comparison).where("is_champion").isEmpty():
        return None
    row = read_table(spark, layout.champions).orderBy(F.desc("version")).first()
    return row["algorithm"], row["run_id"], row["version"]


def evaluate_champion(spark: SparkSession, layout: TableLayout = TableLayout(), horizon_hours: int = 24) -> DataFrame | None:
    """The six metrics of the champion on the test part."""
    best = champion(spark, layout)
    if best is None:
        return None
    tested = read_table(spark, _evaluations(layout)).where((F.col("split") == "test") & (F.col("model_run_id") == best[1]))
    return evaluate.model_metrics(tested, label_name(horizon_hours), "prediction", "failure_probability")


def score_batch(
    spark: SparkSession,
    rows: DataFrame,
    model_root: str,
    layout: TableLayout = TableLayout(),
    keys: Keys = Keys(),
    horizon_hours: int = 24,
    as_of: datetime | None = None,
) -> DataFrame | None:
    """Writes predictions of the champion for `rows`; without a champion nothing is scored."""
    best = champion(spark, layout)
    if best is None:
        return None
    _, run_id, version = best
    ids = [keys.entity, keys.site, keys.time]
    names = feature_columns(rows, [*ids, label_name(horizon_hours), "split"])
    model = PipelineModel.load(f"{model_root}/{run_id}")
    write_overwrite(train.score(rows, model, ids, names, str(version), run_id, as_of), layout.predictions)
    return read_table(spark, layout.predictions)


def champion_scores(
    spark: SparkSession,
    rows: DataFrame,
    model_root: str,
    layout: TableLayout = TableLayout(),
    keys: Keys = Keys(),
    horizon_hours: int = 24,
    as_of: datetime | None = None,
) -> DataFrame:
    """`rows` with the champion's scores and the outcome of the selection.

    Without a champion every row is there, unscored, and says so.
    """
    scored = score_batch(spark, rows, model_root, layout, keys, horizon_hours, as_of)
    if scored is not None:
        return scored.withColumn("selection_status", F.lit("CHAMPION SELECTED"))
    ids = rows.select(keys.entity, keys.site, keys.time)
    empty = {"failure_probability": "double", "prediction": "int", "risk_level": "string", "model_version": "string",
             "model_run_id": "string", "prediction_timestamp": "timestamp"}
    return ids.withColumns({c: F.lit(None).cast(kind) for c, kind in empty.items()}).withColumn("selection_status", F.lit("NO QUALIFIED CHAMPION"))


def held_out_scores(spark: SparkSession, layout: TableLayout, run_id: str, split: str) -> DataFrame:
    return read_table(spark, _evaluations(layout)).where((F.col("model_run_id") == run_id) & (F.col("split") == split))
