"""The four drift checks over stored tables, with history and a summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import Keys, TableLayout, label_name
from fleetlens.functions.shaping import feature_columns
from fleetlens.operators import drift, evaluate
from fleetlens.plans.learning import champion, held_out_scores
from fleetlens.sources.tables import append_history, ensure_schema, read_table, table_exists, write_overwrite

STATUS = "check string, status string, reason string"
MIN_PREDICTIONS = 100


def monitor(
    spark: SparkSession,
    layout: TableLayout = TableLayout(),
    keys: Keys = Keys(),
    horizon_hours: int = 24,
    current_fraction: float = 0.1,
    overlap: bool = False,
    model_sides: tuple[str, str] = ("validation", "test"),
    as_of: datetime | None = None,
) -> DataFrame:
    """Runs every check whose input exists, stores the results and returns the status of each.

    A check with no input is skipped and says why; the summary counts it as no drift.
    `overlap` leaves the recent readings in the baseline as well.
    """
    ensure_schema(spark, layout.name(layout.monitoring, "").rstrip("."))
    label = label_name(horizon_hours)
    done: dict[str, DataFrame] = {}
    skipped: dict[str, str] = {}

    if table_exists(spark, layout.features) and not read_table(spark, layout.features).isEmpty():
        table = read_table(spark, layout.features)
        sides = evaluate.baseline_and_current(table, keys, 1.0 - current_fraction, overlap)
        names = feature_columns(table, [keys.entity, keys.site, keys.time, label])
        write_overwrite(drift.data_drift(*sides, names, as_of=as_of), layout.monitor("data_drift_monitoring"))
        done["data"] = read_table(spark, layout.monitor("data_drift_monitoring"))
        done["concept"] = _append(drift.concept_drift(*sides, label, as_of=as_of), layout.monitor("concept_drift_monitoring"))
    else:
        skipped["data"] = skipped["concept"] = "no feature table"

    if not table_exists(spark, layout.predictions):
        skipped["prediction"] = "no predictions"
    else:
        predictions = read_table(spark, layout.predictions)
        if "failure_probability" not in predictions.columns or predictions.count() <= MIN_PREDICTIONS:
            skipped["prediction"] = "too few predictions"
        else:
            sides = evaluate.baseline_and_current(predictions, keys, 0.7)
            checked = drift.prediction_drift(*sides, "failure_probability", as_of=as_of)
            done["prediction"] = _append(checked, layout.monitor("prediction_drift_monitoring"))

    best = champion(spark, layout)
    if best is None:
        skipped["model"] = "no champion"
    else:
        before, after = (held_out_scores(spark, layout, best[1], s) for s in model_sides)
        done["model"] = _append(
            drift.model_drift(before, after, label, "prediction", as_of=as_of), layout.monitor("model_drift_monitoring")
        )

    if done:
        summary = drift.drift_summary(done.get("data"), done.get("concept"), done.get("prediction"), done.get("model"), as_of=as_of)
        append_history(summary, layout.monitor("drift_summary"))
    rows = [(c, "done", "") for c in done] + [(c, "skipped", why) for c, why in skipped.items()]
    return spark.createDataFrame(rows, STATUS).orderBy("check")


def _append(result: DataFrame, name: str) -> DataFrame:
    """Appends a one-row result; the summary then reads that row instead of computing it again."""
    row = result.sparkSession.createDataFrame(result.collect(), result.schema)
    append_history(row, name)
    return row


def latest(spark: SparkSession, layout: TableLayout, check: str) -> DataFrame:
    """The newest stored record of a check."""
    history = read_table(spark, layout.monitor(check))
    stamp = "timestamp" if "timestamp" in history.columns else "check_timestamp"
    return history.orderBy(F.desc(stamp)).limit(1)
