"""Time-ordered splits, class weights, classification metrics and champion selection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.config import Keys
from fleetlens.operators.ordering import before_key, keys_at_ranks, range_chunks, running


# --- splits -----------------------------------------------------------------------------


def before_cuts(df: DataFrame, order: Sequence[str], fractions: Sequence[float], first_only: bool = False) -> list[Column]:
    """For each fraction, whether a row lies before the one at which a table ordered by `order` passes it.

    A cut is floor(n * fraction) in floating point; every row lies before a cut at the very end. Times
    are compared as numbers of microseconds, so no time zone has a say. `first_only` compares
    the first column alone.
    """
    codes, cuts = keys_at_ranks(df, order, lambda n: [int(n * f) for f in fractions])
    width = 1 if first_only else len(codes)
    return [F.lit(True) if c is None else before_key(codes[:width], c[:width]) for c in cuts]


def temporal_split(
    df: DataFrame,
    keys: Keys = Keys(),
    train: float = 0.70,
    validation: float = 0.15,
    order: Sequence[str] | None = None,
    on_time_boundary: bool = False,
    out: str = "split",
) -> DataFrame:
    """Past to train, then validation, then test: a comparison of each row with two cut keys.

    Finding the cuts reads only the order columns; marking the rows moves none of them.
    `order` must identify a row for the split to be exact; rows equal to a cut key stay
    together. `on_time_boundary` keeps all readings of one instant on the same side.
    """
    columns = list(order or [keys.time, keys.entity])
    first, second = before_cuts(df, columns, [train, train + validation], on_time_boundary)
    return df.withColumn(out, F.when(first, "train").when(second, "validation").otherwise("test"))


def baseline_and_current(
    df: DataFrame, keys: Keys = Keys(), fraction: float = 0.7, overlap: bool = False, order: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Earlier and later part of a table. With `overlap` the baseline is the whole table."""
    early = before_cuts(df, list(order or [keys.time, keys.entity]), [fraction])[0]
    return (df if overlap else df.where(early)), df.where(~early)


def split_distribution(df: DataFrame, label: str, keys: Keys = Keys(), split: str = "split") -> DataFrame:
    counts = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.min(keys.time).alias("first_time"),
        F.max(keys.time).alias("last_time"),
    )
    return counts.withColumn("positive_pct", F.round(F.col("positives") * 100.0 / F.col("rows"), 2))


# --- weights and scaling ----------------------------------------------------------------


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: rows, the balanced weight n / (classes * rows), and negatives over positives."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy()
    positives = F.sum(F.when(F.col("class") == 1, F.col("rows"))).over(whole)
    return counts.withColumns(
        {
            "balanced_weight": F.sum("rows").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("rows")),
            "scale_pos_weight": (F.sum("rows").over(whole) - positives) / positives,
        }
    )


def weight_column(df: DataFrame, label: str, scheme: str = "balanced") -> Column:
    """Row weights for a fit. Two class counts reach the driver."""
    weights = {int(r["class"]): r for r in class_weights(df, label).collect()}
    if scheme == "balanced":
        by_class = {c: float(r["balanced_weight"]) for c, r in weights.items()}
    else:
        positive = weights.get(1)
        by_class = {0: 1.0, 1: float(positive["scale_pos_weight"]) if positive else 1.0}
    return F.when(F.col(label) == 1, by_class.get(1, 1.0)).otherwise(by_class.get(0, 1.0))


def column_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each column, one row for each by its position.

    Columns are rows here, combined in each task before they move: two functions over any number of columns, where two for
    each column made a method too long to be compiled.
    """
    values = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("__k", "__v"))
    return values.groupBy("__k").agg(F.avg("__v").alias("mean"), F.stddev_pop("__v").alias("std"))


def scaling(fit: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) of each column; a constant column has deviation 1, an empty one mean 0."""
    stats = {columns[r["__k"]]: r for r in column_moments(fit, columns).collect()}
    return {c: (float(stats[c]["mean"] or 0.0), float(stats[c]["std"] or 1.0)) if c in stats else (0.0, 1.0) for c in columns}


def standardise(df: DataFrame, columns: Sequence[str], fit: DataFrame | None = None, suffix: str = "_z") -> DataFrame:
    """(x - mean) / population deviation, learned on `fit`; a constant column is only centred."""
    learned = scaling(df if fit is None else fit, columns)
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in learned.items()})


# --- metrics ----------------------------------------------------------------------------


def binary_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and the metrics on them, per group. Undefined ratios are 0."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def ranking_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC with tied scores averaged, and average precision over distinct scores. NaN is no score.

    Rows collapse to counts per distinct score, which are range partitioned by (model, score)
    and stored; prefix sums in score order do the rest. A model's totals come with what is
    carried from partition to partition, so no model is a key that rows meet by.
    Average precision is the step-wise sum, not the trapezoid under the PR curve.
    """
    complete = df.select(*by, F.col(score).cast("double").alias(score), label)
    complete = complete.where(F.col(score).isNotNull() & ~F.isnan(score) & F.col(label).isNotNull())
    counts = complete.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("__t"), F.count_if(F.col(label) != 1).alias("__f")
    )
    sums = {"__ct": ("sum", "__t"), "__cf": ("sum", "__f")}
    upto = running(range_chunks(counts, by, score), score, sums, whole={"__p": ("sum", "__t"), "__q": ("sum", "__f")})
    # what lies strictly below each score, so that one pass serves both metrics
    t, f = F.col("__t"), F.col("__f")
    joined = upto.select(*by, "__t", "__f", (F.col("__ct") - t).alias("__bt"), (F.col("__cf") - f).alias("__bf"), "__p", "__q")
    p, q = F.col("__p"), F.col("__q")
    at_or_above_t, at_or_above_f = p - F.col("__bt"), q - F.col("__bf")
    gain = F.when(t > 0, t / p * at_or_above_t / (at_or_above_t + at_or_above_f)).otherwise(0.0)
    wins = F.when((p > 0) & (q > 0), t / p * ((F.col("__bf") + f / 2.0) / q))
    return joined.groupBy(*by).agg(
        F.sum(wins).alias("roc_auc"), F.when(F.max("__p") > 0, F.sum(gain)).alias("pr_auc"),
        F.max("__p").alias("positives"), F.max("__q").alias("negatives"),
    )


def model_metrics(df: DataFrame, label: str, prediction: str, score: str, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """The six metrics of each model, from rows of (model, label, prediction, score)."""
    confusion = binary_metrics(df, label, prediction, by)
    ranking = ranking_metrics(df, label, score, by).drop("positives", "negatives")
    return confusion.join(ranking, list(by), "left")


# --- champion ---------------------------------------------------------------------------

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


def compare_models(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """Metrics as published: rounded before anything is decided on them."""
    return metrics.withColumns({m: F.round(m, digits) for m in METRICS})


def select_champion(comparison: DataFrame, min_recall: float = 0.80, by: Sequence[str] = ()) -> DataFrame:
    """Marks the best qualified model: recall gate first, then PR-AUC, F1, name.

    Where no model clears the gate nobody is champion, and every row says so.
    """
    qualified = F.col("recall") >= min_recall
    everyone = Window.partitionBy(*by)
    ranking = everyone.orderBy(
        F.desc("__ok"), F.desc_nulls_last("pr_auc"), F.desc_nulls_last("f1"), F.asc("model_name")
    )
    marked = comparison.withColumn("__ok", F.coalesce(qualified, F.lit(False)))
    return marked.withColumns(
        {
            "is_champion": F.col("__ok") & (F.row_number().over(ranking) == 1),
            "best_recall": F.max("recall").over(everyone),
            "selection_status": F.when(F.max("__ok").over(everyone), "CHAMPION SELECTED").otherwise("NO QUALIFIED CHAMPION"),
        }
    ).drop("__ok")


def promotions(comparison: DataFrame, model: str, promoted_at: Column, first_version: int = 1, order: Sequence[str] = ("model_name",)) -> DataFrame:
    """Version rows for the champions in a comparison, numbered on from `first_version`.

    One row per selection round reaches the window, never data.
    """
    position = F.row_number().over(Window.orderBy(*order))
    return comparison.where("is_champion").select(
        F.lit(model).alias("registered_model"),
        (position + (first_version - 1)).cast("int").alias("version"),
        *[c for c in order if c != "model_name"],
        F.col("model_name").alias("algorithm"),
        "recall",
        "pr_auc",
        promoted_at.alias("promoted_at"),
        F.lit("champion").alias("status"),
    )


def next_version(history: DataFrame, model: str) -> int:
    latest = history.where(F.col("registered_model") == model).agg(F.max("version")).first()[0]
    return (latest or 0) + 1


def with_alias(history: DataFrame, alias: str = "Champion") -> DataFrame:
    """The alias belongs to the newest version of each registered model."""
    newest = F.max("version").over(Window.partitionBy("registered_model"))
    return history.withColumn("alias", F.when(F.col("version") == newest, alias))


def now(as_of: datetime | None = None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
