"""Failure classifiers on Spark ML, and batch scoring with them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from fleetlens.functions.domain import risk_level
from fleetlens.operators.boosting import SecondOrderBoosting, Settings
from fleetlens.operators.evaluate import now, scaling, weight_column
from fleetlens.operators.forest import Forest, ForestSettings

WEIGHT = "__weight"


@dataclass(frozen=True)
class Candidate:
    """One kind of classifier with its settings; `weights` is balanced or scale_pos."""

    name: str
    kind: str
    weights: str = "balanced"
    trees: int = 100
    depth: int = 6
    iterations: int = 1000
    inverse_regularisation: float = 1.0
    step: float = 0.1
    min_instances: int = 5


CANDIDATES = (
    Candidate("logistic_regression", "logistic"),
    Candidate("random_forest", "forest", trees=100, depth=10),
    Candidate("boosted_scaled", "boosted", weights="scale_pos", trees=100, depth=6),
    Candidate("boosted_balanced", "boosted", weights="balanced", trees=100, depth=6),
)


def _estimator(c: Candidate, columns: Sequence[str], label: str, total_weight: float, seed: int):
    common = {"featuresCol": "features", "labelCol": label, "weightCol": f"{WEIGHT}0"}
    if c.kind == "logistic":
        # L2 strength of 1 / (C * sum of weights) matches a penalty of C on the summed loss
        return LogisticRegression(
            maxIter=c.iterations, regParam=1.0 / (c.inverse_regularisation * total_weight), standardization=False, **common
        )
    if c.kind == "forest":
        return Forest(columns, label, f"{WEIGHT}0", ForestSettings(c.trees, c.depth, min_instances=c.min_instances, seed=seed))
    return SecondOrderBoosting(columns, label, f"{WEIGHT}0", Settings(rounds=c.trees, depth=c.depth, rate=c.step))


def scaler(train: DataFrame, features: Sequence[str], suffix: str = "__scaled") -> SQLTransformer:
    """A fitted stage: missing values become the mean, then (x - mean) / population deviation.

    What was learned on `train` are literals of its statement, so it is saved with the model and
    does to a row exactly what `evaluate.standardise` does to a column.
    """
    learned = scaling(train, features)
    columns = [f"(coalesce(`{c}`, {mean!r}D) - {mean!r}D) / {deviation!r}D as `{c}{suffix}`" for c, (mean, deviation) in learned.items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def alike(candidates: Sequence[Candidate]) -> list[list[Candidate]]:
    """The candidates in groups that are fitted together: boosted ones that differ in their weights alone."""
    groups: dict[object, list[Candidate]] = {}
    for c in candidates:
        groups.setdefault(replace(c, name="", weights="") if c.kind == "boosted" else c.name, []).append(c)
    return list(groups.values())


def at_once(spark: SparkSession, fit: Callable, groups: Sequence) -> list:
    """`fit` of each group, at the same time: a fit is a long row of short jobs, which leave most of a cluster idle."""
    inherited = inheritable_thread_target(spark)(fit)
    with ThreadPoolExecutor(max(1, len(groups))) as pool:
        return list(pool.map(inherited, groups))


def train_alike(train: DataFrame, features: Sequence[str], label: str, group: Sequence[Candidate], seed: int = 42) -> list[PipelineModel]:
    """Impute, scale, assemble, fit, for one candidate or several `alike`. Everything is learned on `train` alone."""
    numbers = [F.nanvl(F.col(c).cast(T.DoubleType()), F.lit(None).cast("double")).alias(c) for c in features]
    cast = train.select(*numbers, F.col(label).cast("double").alias(label))
    weights = {f"{WEIGHT}{k}": weight_column(cast, label, c.weights) for k, c in enumerate(group)}
    weighted = cast.where(F.col(label).isNotNull()).withColumns(weights)
    total = weighted.agg(F.sum(f"{WEIGHT}0")).first()[0] if group[0].kind == "logistic" else 1.0
    scaled = [f"{c}__scaled" for c in features]
    stages = [scaler(weighted, features), VectorAssembler(inputCols=scaled, outputCol="features")]
    estimator = _estimator(group[0], scaled, label, float(total), seed)
    if len(group) == 1:
        return [Pipeline(stages=[*stages, estimator]).fit(weighted)]
    return [PipelineModel([*stages, fitted]) for fitted in estimator.side_by_side(PipelineModel(stages).transform(weighted), list(weights))]


def train_model(train: DataFrame, features: Sequence[str], label: str, candidate: Candidate, seed: int = 42) -> PipelineModel:
    """One candidate, fitted."""
    return train_alike(train, features, label, [candidate], seed)[0]


def train_models(train: DataFrame, features: Sequence[str], label: str, candidates: Sequence[Candidate], seed: int = 42) -> dict[str, PipelineModel]:
    """Every candidate, fitted; by name."""
    groups = alike(candidates)
    fitted = at_once(train.sparkSession, lambda group: train_alike(train, features, label, group, seed), groups)
    return {c.name: model for group, models in zip(groups, fitted) for c, model in zip(group, models)}


def score(
    df: DataFrame,
    model: PipelineModel,
    ids: Sequence[str],
    features: Sequence[str],
    version: str = "1",
    run_id: str = "",
    as_of: datetime | None = None,
) -> DataFrame:
    """Probability, class and risk level per row, with the identity of the model."""
    ready = df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in features})
    return model.transform(ready).select(
        *ids,
        vector_to_array("probability")[1].alias("failure_probability"),
        F.col("prediction").cast("int").alias("prediction"),
    ).withColumns(
        {
            "risk_level": risk_level("failure_probability"),
            "model_version": F.lit(version),
            "model_run_id": F.lit(run_id),
            "prediction_timestamp": now(as_of),
        }
    )


def top_risk(predictions: DataFrame, ties: Sequence[str], n: int = 10) -> DataFrame:
    """The report's readings with the highest failure probability."""
    return predictions.orderBy(F.desc("failure_probability"), *ties).limit(n)


def feature_importance(df: DataFrame, model: PipelineModel, features: Sequence[str], n: int = 10) -> DataFrame:
    """The model's most important features. The vector has one entry per column."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(w)) for c, w in zip(features, weights)]
    schema = "feature string, importance double"
    return df.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("importance"), "feature").limit(n)
