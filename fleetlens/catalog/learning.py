"""Fitted models. Their numbers depend on the optimiser, so these queries carry no SQL."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.catalog import query
from fleetlens.catalog.data import AS_OF, FRAME_CHUNK, LABEL, WHOLE_ROWS, stored_training
from fleetlens.config import FolderLayout
from fleetlens.functions.shaping import feature_columns
from fleetlens.operators import evaluate, features, train
from fleetlens.plans import learning
from fleetlens.session import cut_lineage, shared_folder
from fleetlens.catalog.readings import KEYS
from fleetlens.sources.tables import read_table, write_overwrite

IDS = ("turbine_id", "farm_id", "reading_ts")

CANDIDATES = {c.name: c for c in train.CANDIDATES}


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """Features with their split. A fit reads its input many times, so it is stored."""
    table = cut_lineage(features.build_features(stored_training(spark, folder), KEYS, FRAME_CHUNK, WHOLE_ROWS))
    split = evaluate.temporal_split(table, KEYS)
    return split, feature_columns(split, [*IDS, LABEL, "split"])


def _fit(split: DataFrame, names: list[str], model: str) -> PipelineModel:
    return train.train_model(split.where("split = 'train'"), names, LABEL, CANDIDATES[model])


def _fits(split: DataFrame, names: list[str], models: Collection[str]) -> dict[str, PipelineModel]:
    """Several models, fitted at the same time."""
    def fit(group: list[train.Candidate]) -> list[PipelineModel]:
        if len(group) == 1:
            return [_fit(split, names, group[0].name)]
        return train.train_alike(split.where("split = 'train'"), names, LABEL, group)

    groups = train.alike([CANDIDATES.get(model, train.Candidate(model, model)) for model in models])
    fitted = train.at_once(split.sparkSession, fit, groups)
    by_name = {c.name: model for group, own in zip(groups, fitted) for c, model in zip(group, own)}
    return {model: by_name[model] for model in models}


def _scores(split: DataFrame, names: list[str], models: dict[str, PipelineModel], part: str) -> DataFrame:
    rows = split.where(F.col("split") == part)
    frames = [
        train.score(rows, fitted, [*IDS, LABEL], names, run_id=name, as_of=AS_OF).withColumn("model_name", F.lit(name))
        for name, fitted in models.items()
    ]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


def _measured(split: DataFrame, names: list[str], models: dict[str, PipelineModel], part: str) -> DataFrame:
    scored = _scores(split, names, models, part)
    return evaluate.compare_models(evaluate.model_metrics(scored, LABEL, "prediction", "failure_probability"))


def _register(name: str, *models: str) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        split, names = _split(spark, folder)
        return _measured(split, names, _fits(split, names, models), "validation")

    query(name)(run)


_register("train_logistic", "logistic_regression")
_register("train_forest", "random_forest")
_register("train_gbt", "boosted_scaled", "boosted_balanced")


@query("feature_importance")
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    split, names = _split(spark, folder)
    return train.feature_importance(split, _fit(split, names, "random_forest"), names)


@query("batch_scores")
def batch_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The test part scored by the logistic model."""
    split, names = _split(spark, folder)
    fitted = _fit(split, names, "logistic_regression")
    return train.score(split.where("split = 'test'"), fitted, IDS, names, run_id="logistic_regression", as_of=AS_OF)


def _champion_scores(spark: SparkSession, folder: str, gate: float) -> DataFrame:
    """From stored features to the stored comparison of all candidates, promoted model and scores of the test part."""
    root = f"{shared_folder(spark)}/learning-{uuid.uuid4().hex}"
    layout = FolderLayout(root=root)
    write_overwrite(features.build_features(stored_training(spark, folder), KEYS, FRAME_CHUNK, WHOLE_ROWS), layout.features)
    split = evaluate.temporal_split(read_table(spark, layout.features), KEYS)
    learning.train_and_compare(spark, f"{root}/models", layout, KEYS, train.CANDIDATES, min_recall=gate, as_of=AS_OF, split=split)
    test = split.where("split = 'test'").drop("split")
    scores = learning.champion_scores(spark, test, f"{root}/models", layout, KEYS, as_of=AS_OF)
    return scores.drop("model_run_id")  # a new one in every run


@query("champion_scores")
def champion_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores by the model that a low gate promotes."""
    return _champion_scores(spark, folder, 0.1)


@query("champion_scores_none")
def champion_scores_none(spark: SparkSession, folder: str) -> DataFrame:
    """A gate that no model reaches: rows stay unscored."""
    return _champion_scores(spark, folder, 1.01)


@query("ml_pipeline")
def ml_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Four candidates on validation data, the champion again on test data."""
    split, names = _split(spark, folder)
    models = _fits(split, names, CANDIDATES)
    selection = cut_lineage(evaluate.select_champion(_measured(split, names, models, "validation")))
    winner = selection.where("is_champion").select("model_name").first()
    validation = selection.withColumn("evaluated_on", F.lit("validation"))
    if winner is None:
        return validation
    tested = _measured(split, names, {winner[0]: models[winner[0]]}, "test").withColumns(
        {"is_champion": F.lit(True), "evaluated_on": F.lit("test")}
    )
    return validation.unionByName(tested, allowMissingColumns=True)
