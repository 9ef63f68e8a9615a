"""Splits, weights, metrics, champion selection, risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.catalog import query
from fleetlens.catalog.data import AS_OF, LABEL, model_rows, scored, training
from fleetlens.catalog.sql import over, rounded, rounded_sql
from fleetlens.config import TRAINING_COLUMNS
from fleetlens.functions.domain import risk_level
from fleetlens.operators import evaluate, kpi, train
from fleetlens.operators.ordering import epoch_micros
from fleetlens.catalog.readings import KEYS

_SPLIT = """split_rows as (select *, case when position < floor(n * 0.7e0) then 'train' when position < floor(n * 0.85e0)
 then 'validation' else 'test' end as split from (select *, row_number() over (order by reading_ts, turbine_id) - 1 as position,
 count(*) over () as n from training))"""


@query("temporal_split", over("training", "select turbine_id, reading_ts, split from split_rows", _SPLIT))
def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.temporal_split(training(spark, folder), KEYS).select("turbine_id", "reading_ts", "split")


@query(
    "split_distribution",
    over(
        "training",
        f"select split, count(*) as rows, count(*) filter (where {LABEL} = 1) as positives, min(reading_ts) as first_time, "
        f"max(reading_ts) as last_time, round(count(*) filter (where {LABEL} = 1) * 100e0 / count(*), 2) as positive_pct "
        "from split_rows group by split",
        _SPLIT,
    ),
)
def split_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.split_distribution(evaluate.temporal_split(training(spark, folder), KEYS), LABEL, KEYS)


@query(
    "class_weights",
    over(
        "training",
        rounded_sql(
            f'select {LABEL} as "class", count(*) as rows, sum(count(*)) over () / cast(2 * count(*) as double) as balanced_weight, '
            f"(select count(*) filter (where {LABEL} = 0) / cast(count(*) filter (where {LABEL} = 1) as double) from training) as scale_pos_weight "
            f"from training group by {LABEL}",
            ["balanced_weight", "scale_pos_weight"],
        ),
    ),
)
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.class_weights(training(spark, folder), LABEL), ["balanced_weight", "scale_pos_weight"])


# The same instants with a time zone, moved so that clocks are set back among them (2023-10-29 in Europe).
_ZONED_DAYS = 80


@query(
    "temporal_split_zoned",
    over(
        "training",
        f"select turbine_id, epoch_us(reading_ts) - {_ZONED_DAYS * 86_400_000_000} as micros, split from split_rows",
        _SPLIT,
    ),
)
def temporal_split_zoned(spark: SparkSession, folder: str) -> DataFrame:
    rows = training(spark, folder)
    moved = epoch_micros(rows, KEYS.time) - _ZONED_DAYS * 86_400_000_000
    zoned = rows.select("turbine_id", F.timestamp_micros(moved).alias(KEYS.time))
    return evaluate.temporal_split(zoned, KEYS).select("turbine_id", F.unix_micros(KEYS.time).alias("micros"), "split")


_Z = [f"{c}_z" for c in TRAINING_COLUMNS]


@query(
    "standardise",
    over(
        "training",
        rounded_sql(
            "select turbine_id, reading_ts, "
            + ", ".join(
                f"({c} - (select avg({c}) from split_rows where split = 'train')) / "
                f"coalesce((select nullif(stddev_pop({c}), 0) from split_rows where split = 'train'), 1e0) as {c}_z"
                for c in TRAINING_COLUMNS
            )
            + " from split_rows",
            _Z,
        ),
        _SPLIT,
    ),
)
def standardise(spark: SparkSession, folder: str) -> DataFrame:
    split = evaluate.temporal_split(training(spark, folder), KEYS)
    scaled = evaluate.standardise(split, TRAINING_COLUMNS, split.where("split = 'train'"))
    return rounded(scaled.select("turbine_id", "reading_ts", *_Z), _Z)


# --- metrics ----------------------------------------------------------------------------

_CONFUSION = """confusion as (select *, coalesce((tp + tn) / nullif(cast(tp + fp + fn + tn as double), 0), 0) as accuracy,
 coalesce(tp / nullif(cast(tp + fp as double), 0), 0) as precision, coalesce(tp / nullif(cast(tp + fn as double), 0), 0) as recall,
 coalesce(2 * tp / nullif(cast(2 * tp + fp + fn as double), 0), 0) as f1 from (select {by}
 count(*) filter (where label = 1 and prediction = 1) as tp, count(*) filter (where label = 0 and prediction = 1) as fp,
 count(*) filter (where label = 1 and prediction = 0) as fn, count(*) filter (where label = 0 and prediction = 0) as tn
 from {source}{group}))"""
_SCORES = ("accuracy", "precision", "recall", "f1")


def _confusion(source: str, by: str = "") -> str:
    return _CONFUSION.format(source=source, by=f"{by}," if by else "", group=f" group by {by}" if by else "")


def _ranking(source: str, by: str, score: str) -> str:
    """Brute force: pairwise wins for the AUC, precision at every distinct score for AP."""
    same = " and ".join(f"a.{c} = b.{c}" for c in by.split(", "))
    return f"""by_score as (select {by}, {score} as s, count(*) filter (where label = 1) as t, count(*) filter (where label = 0) as f
  from {source} group by {by}, {score}),
sized as (select {by}, sum(t) as p, sum(f) as q from by_score group by {by}),
auc as (select {', '.join('a.' + c for c in by.split(', '))}, sum(a.t * (case when a.s > b.s then 1e0 when a.s = b.s then 0.5e0 else 0e0 end) * b.f) as wins
  from by_score a join by_score b on {same} group by all),
steps as (select {by}, t, sum(t) over w as ct, sum(f) over w as cf from by_score window w as (partition by {by} order by s desc)),
ap as (select {by}, sum(t * ct / cast(ct + cf as double)) as gain from steps group by {by}),
ranking as (select {by}, wins / (p * q) as roc_auc, gain / p as pr_auc from sized join auc using ({by}) join ap using ({by}))"""


@query("confusion_metrics", over("scored", rounded_sql("select * from confusion", _SCORES), _confusion("scored")))
def confusion_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.binary_metrics(scored(spark, folder), "label", "prediction"), _SCORES)


_PER_MODEL = _ranking("model_rows", "model_name", "score")


@query("roc_auc", over("models", rounded_sql("select model_name, roc_auc from ranking", ["roc_auc"]), _PER_MODEL))
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    ranked = evaluate.ranking_metrics(model_rows(spark, folder), "label", "score", ["model_name"])
    return rounded(ranked.select("model_name", "roc_auc"), ["roc_auc"])


@query("average_precision", over("models", rounded_sql("select model_name, pr_auc from ranking", ["pr_auc"]), _PER_MODEL))
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    ranked = evaluate.ranking_metrics(model_rows(spark, folder), "label", "score", ["model_name"])
    return rounded(ranked.select("model_name", "pr_auc"), ["pr_auc"])


# --- champion ---------------------------------------------------------------------------


def _selected(by: str, gate: str) -> str:
    extra = [c for c in by.split(", ") if c != "model_name"]
    part = f"partition by {', '.join(extra)}" if extra else ""
    rounds = ", ".join(f"round({m}, 4) as {m}" for m in evaluate.METRICS)
    return f"""compared as (select {by}, tp, fp, fn, tn, {rounds} from confusion join ranking using ({by})),
selected as (select *, recall >= {gate} and row_number() over ({part} order by recall >= {gate} desc, pr_auc desc, f1 desc, model_name) = 1
  as is_champion, max(recall) over ({part}) as best_recall,
  case when bool_or(recall >= {gate}) over ({part}) then 'CHAMPION SELECTED' else 'NO QUALIFIED CHAMPION' end as selection_status
  from compared)"""


def _selection_sql(by: str, gate: str, body: str) -> str:
    return over("models", body, _confusion("model_rows", by), _ranking("model_rows", by, "score"), _selected(by, gate))


def _selection(spark: SparkSession, folder: str, gate: float, by: tuple[str, ...] = ()) -> DataFrame:
    measured = evaluate.model_metrics(model_rows(spark, folder), "label", "prediction", "score", [*by, "model_name"])
    return evaluate.select_champion(evaluate.compare_models(measured), gate, by)


@query("champion_selection", _selection_sql("model_name", "0.8e0", "select * from selected"))
def champion_selection(spark: SparkSession, folder: str) -> DataFrame:
    return _selection(spark, folder, 0.80)


# A gate no scorer reaches: everyone stays unpromoted and the best recall is reported.
@query("champion_none", _selection_sql("model_name", "1.01e0", "select * from selected"))
def champion_none(spark: SparkSession, folder: str) -> DataFrame:
    return _selection(spark, folder, 1.01)


@query(
    "champion_history",
    _selection_sql(
        "farm_id, model_name",
        "0.8e0",
        "select 'failure_model' as registered_model, cast(row_number() over (order by farm_id) as int) as version, farm_id, "
        "model_name as algorithm, recall, pr_auc, 'champion' as status, "
        "case when row_number() over (order by farm_id) = count(*) over () then 'Champion' end as alias from selected where is_champion",
    ),
)
def champion_history(spark: SparkSession, folder: str) -> DataFrame:
    """One selection round per farm; each promotion is a version and the last one holds the alias."""
    rounds = _selection(spark, folder, 0.80, ("farm_id",))
    history = evaluate.promotions(rounds, "failure_model", evaluate.now(AS_OF), order=["farm_id"])
    return evaluate.with_alias(history).drop("promoted_at")


# --- risk -------------------------------------------------------------------------------

_RISK = (
    "case when failure_probability > 0 and failure_probability <= 0.3e0 then 'LOW' when failure_probability > 0.3e0 and "
    "failure_probability <= 0.7e0 then 'MEDIUM' when failure_probability > 0.7e0 and failure_probability <= 1 then 'HIGH' end"
)


@query("risk_levels", over("scored", f"select event_id, failure_probability, {_RISK} as risk_level from scored"))
def risk_levels(spark: SparkSession, folder: str) -> DataFrame:
    return scored(spark, folder).select("event_id", "failure_probability", risk_level("failure_probability").alias("risk_level"))


@query("risk_distribution", over("scored", f"select {_RISK} as risk_level, count(*) as count from scored group by 1"))
def risk_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.distribution(scored(spark, folder).withColumn("risk_level", risk_level("failure_probability")), "risk_level")


@query(
    "top_risk",
    over(
        "scored",
        "select turbine_id, reading_ts, failure_probability from scored order by failure_probability desc, turbine_id, reading_ts limit 10",
    ),
)
def top_risk(spark: SparkSession, folder: str) -> DataFrame:
    return train.top_risk(scored(spark, folder).select("turbine_id", "reading_ts", "failure_probability"), KEYS.reading)
