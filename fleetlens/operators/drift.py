"""Drift statistics over DataFrames: PSI, KS, chi-square, and the four monitoring checks.

Samples are compared in long form, (feature, value, rows in baseline, rows in current), with
one row per distinct value. All features go through one job, and every statistic is a prefix
sum or a conditional sum over that form. No group is ever held by a single task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.tests_of_fit import chi2_pvalue, ks_pvalue
from fleetlens.operators.evaluate import binary_metrics, now
from fleetlens.operators.ordering import drop_chunk, range_chunks, running
from fleetlens.session import cut_lineage

BINS = 10
EMPTY_SHARE = 0.0001
COUNTED_ROWS = 1 << 17  # rows of a task whose values are sorted together


# --- long form --------------------------------------------------------------------------


def two_samples(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, nb, nc): rows per distinct value in the baseline and in the current sample, without nulls or NaN.

    A task sorts one column after the other and sends on arrays of distinct values, dealt by a hash of the value; the arrays
    of a piece are counted together. So no row is made of a value before it is distinct, and a piece gets a value
    once from each `COUNTED_ROWS` rows at most. Features travel as small integers.
    """
    sides = [
        df.select(*[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(columns)], F.lit(flag).alias("cur"))
        for df, flag in ((baseline, False), (current, True))
    ]
    count, pieces = len(columns), min(max(64, int(baseline.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 1 << 16)

    def dealt(held: Sequence[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        later = np.concatenate([b.column("cur").to_numpy(zero_copy_only=False) for b in held]).astype(bool)
        for j in range(count):
            all_values = np.concatenate([b.column(f"x{j}").to_numpy(zero_copy_only=False).astype(np.float64) for b in held]) + 0.0
            known, out = ~np.isnan(all_values), []
            for flag, side in ((False, ~later), (True, later)):
                values, rows = np.unique(all_values[side & known], return_counts=True)
                piece = (((values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(pieces)).astype(np.uint16)
                order = np.argsort(piece, kind="stable")
                values, rows, ends = values[order], rows[order].astype(np.int64), np.cumsum(np.bincount(piece.astype(np.int64), minlength=pieces))
                for k in np.flatnonzero(np.diff(ends, prepend=0)):
                    part = slice(ends[k - 1] if k else 0, ends[k])
                    out.append((j * pieces + int(k), flag, values[part].tobytes(), rows[part].tobytes()))
            if out:
                kinds = (pa.int64(), pa.bool_(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=["piece", "cur", "vals", "n"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= COUNTED_ROWS:
                yield from dealt(held)
                held = []
        if held:
            yield from dealt(held)

    def counted(key: tuple, group: pa.Table) -> pa.Table:
        values, rows = (np.concatenate([np.frombuffer(x, kind) for x in group.column(c).to_pylist()]) for c, kind in (("vals", np.float64), ("n", np.int64)))
        later = np.repeat(group.column("cur").to_numpy(), [len(x) // 8 for x in group.column("n").to_pylist()])
        value, at = np.unique(values, return_inverse=True)
        nb, nc = (np.bincount(at, np.where(side, rows, 0), len(value)).astype(np.int64) for side in (~later, later))
        feature = np.full(len(value), key[0].as_py() // pieces, np.int32)
        return pa.table({"feature": feature, "value": value, "nb": nb, "nc": nc})

    arrays = sides[0].unionByName(sides[1]).mapInArrow(deal, "piece long, cur boolean, vals binary, n binary")
    return arrays.groupBy("piece").applyInArrow(counted, "feature int, value double, nb long, nc long")


# --- KS and PSI -------------------------------------------------------------------------


def _percentiles(ordered: DataFrame, bins: int) -> DataFrame:
    """Per feature the baseline's bins + 1 equally spaced percentiles, as an ascending array.

    Percentile k interpolates linearly between the values around rank (n - 1) * k / bins. The
    running counts say which rows hold those ranks, so a handful of rows per feature remain.
    """

    def position(k: str) -> str:
        return f"((n_base - 1) * (cast({k} as double) / {bins}D))"

    def low(k: str) -> str:
        return f"floor({position(k)})"

    def high(k: str) -> str:
        return f"least({low(k)} + 1, n_base - 1)"

    def holds(rank: str) -> str:
        return f"(cb - nb <= {rank} and {rank} < cb)"

    wanted = " or ".join(holds(rank(str(k))) for k in range(bins + 1) for rank in (low, high))
    return (
        ordered.where(wanted).withColumn("k", F.expr(f"explode(sequence(0, {bins}))"))
        .groupBy("feature", "k").agg(
            F.expr(f"max(case when {holds(low('k'))} then value end)").alias("__a"),
            F.expr(f"max(case when {holds(high('k'))} then value end)").alias("__b"),
            F.expr(f"max({position('k')} - {low('k')})").alias("__t"),
        )
        .withColumn("__edge", F.expr("if(__t >= 0.5D, __b - (__b - __a) * (1D - __t), __a + (__b - __a) * __t)"))
        .groupBy("feature")
        .agg(F.sort_array(F.collect_list(F.struct("k", "__edge"))).getField("__edge").alias("__edges"))
    )


def _psi(ordered: DataFrame, edges: DataFrame, bins: int) -> DataFrame:
    """Bins are left-closed, the last closed on both ends; values outside count in the size only.

    A bin empty on both sides adds nothing, so only occupied bins need a row. The edges, one row per
    compared column, are broadcast: their number is that of columns, not of rows.
    """
    passed = " + ".join(f"cast(value >= __edges[{i}] as int)" for i in range(bins + 1))
    index = F.expr(f"if(value = __edges[{bins}], {bins - 1}, {passed} - 1)")
    occupied = (
        ordered.join(F.broadcast(edges), "feature").where(f"value between __edges[0] and __edges[{bins}]")
        .groupBy("feature", index.alias("__bin"))
        .agg(F.sum("nb").alias("__e"), F.sum("nc").alias("__a"), F.max("n_base").alias("n_base"), F.max("n_cur").alias("n_cur"))
    )

    def share(name: str, size: str) -> Column:
        return F.when(F.col(name) == 0, EMPTY_SHARE).otherwise(F.col(name) / F.col(size))

    expected, actual = share("__e", "n_base"), share("__a", "n_cur")
    return occupied.groupBy("feature").agg(F.sum((actual - expected) * F.log(actual / expected)).alias("psi_value"))


def ordered_counts(samples: DataFrame) -> DataFrame:
    """Adds to the rows per distinct (feature, value) in both samples (nb, nc) those up to the value (cb, cc).

    Counts are range partitioned by (feature, value) and stored; each row also knows its feature's
    sizes and sums, which come with what is carried between partitions. So no feature is a key that
    rows meet by, however few features there are. Features empty on a side are left out.
    """
    counts = samples.withColumns({"__vb": F.col("value") * F.col("nb"), "__vc": F.col("value") * F.col("nc")})
    whole = {"n_base": "nb", "n_cur": "nc", "__sb": "__vb", "__sc": "__vc"}
    ordered = running(
        range_chunks(counts, ["feature"], "value"), "value", {"cb": ("sum", "nb"), "cc": ("sum", "nc")},
        whole={o: ("sum", c) for o, c in whole.items()},
    )
    return drop_chunk(ordered).drop("__vb", "__vc").where((F.col("n_base") > 0) & (F.col("n_cur") > 0))


def distances(ordered: DataFrame) -> DataFrame:
    """Size, mean and sample deviation of both sides, and the KS distance, per feature.

    Deviations are taken from the mean known beforehand, so nothing cancels out.
    """
    means = {"mean_base": F.col("__sb") / F.col("n_base"), "mean_cur": F.col("__sc") / F.col("n_cur")}
    gap = F.abs(F.col("cb") / F.col("n_base") - F.col("cc") / F.col("n_cur"))

    def squares(n: str, mean: str) -> Column:
        return F.sum(F.col(n) * (F.col("value") - F.col(mean)) * (F.col("value") - F.col(mean)))

    def deviation(total: str, n: str) -> Column:
        return F.when(F.col(n) > 1, F.sqrt(F.col(total) / (F.col(n) - 1)))

    known = ["n_base", "n_cur", "mean_base", "mean_cur"]
    found = ordered.withColumns(means).groupBy("feature").agg(
        *[F.max(c).alias(c) for c in known], squares("nb", "mean_base").alias("__qb"), squares("nc", "mean_cur").alias("__qc"),
        F.max(gap).alias("ks_statistic"),
    )
    return found.select(
        "feature", *known, deviation("__qb", "n_base").alias("std_base"), deviation("__qc", "n_cur").alias("std_cur"), "ks_statistic",
    )


def with_pvalues(found: DataFrame) -> DataFrame:
    return found.withColumn("ks_pvalue", ks_pvalue(F.col("ks_statistic"), F.col("n_base"), F.col("n_cur")))


def compare_samples(samples: DataFrame, bins: int = BINS) -> DataFrame:
    """KS distance, its p-value, PSI and moments for every feature present on both sides.

    PSI compares the shares in the baseline's percentile bins; an empty share becomes 1e-4.
    """
    ordered = cut_lineage(ordered_counts(samples))  # read three times: distances, percentiles, bins
    return with_pvalues(distances(ordered).join(_psi(ordered, _percentiles(ordered, bins), bins), "feature"))


def psi(baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """PSI per feature; 0 for a feature that is empty on either side."""
    measured = compare_samples(two_samples(baseline, current, columns), bins).select("feature", "psi_value")
    return _all_features(baseline, columns).join(measured, "feature", "left").select(
        _name(columns).alias("feature"), F.coalesce("psi_value", F.lit(0.0)).alias("psi_value")
    )


def ks_of_samples(samples: DataFrame) -> DataFrame:
    """Two-sample KS distance and p-value for each value of `feature` in (feature, value, __cur) rows.

    There may be many features, and a p-value is a row of few bytes but much work: they go to as many tasks as a shuffle has.
    """
    tasks = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = samples.groupBy("feature", "value").agg(F.count_if(~F.col("__cur")).alias("nb"), F.count_if("__cur").alias("nc"))
    found = distances(ordered_counts(counts)).select("feature", "n_base", "n_cur", "ks_statistic")
    return with_pvalues(found.repartition(tasks, F.xxhash64("feature")))  # by the feature itself it would stay where the grouping left it


def ks_two_sample(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sample KS distance per feature, with its p-value."""
    tested = with_pvalues(distances(ordered_counts(two_samples(baseline, current, columns))))
    return tested.select(_name(columns).alias("feature"), "n_base", "n_cur", "ks_statistic", "ks_pvalue")


def _name(columns: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in columns]), F.col("feature"))


def _all_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("feature"))


# --- checks -----------------------------------------------------------------------------


def data_drift(
    baseline: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    threshold_psi: float = 0.2,
    threshold_ks: float = 0.05,
    as_of: datetime | None = None,
) -> DataFrame:
    """One row per feature. Columns absent from a side, or empty on one, are left out."""
    shared = [c for c in columns if c in baseline.columns and c in current.columns]
    far, rare = F.col("psi_value") > threshold_psi, F.col("ks_pvalue") < threshold_ks
    return compare_samples(two_samples(baseline, current, shared)).select(
        _name(shared).alias("feature"),
        "ks_statistic",
        "ks_pvalue",
        "psi_value",
        (rare | far).alias("drift_detected"),
        F.when(far, "CRITICAL").when(rare, "WARNING").otherwise("OK").alias("drift_severity"),
        F.col("mean_base").alias("train_mean"),
        F.col("mean_cur").alias("prod_mean"),
        F.col("std_base").alias("train_std"),
        F.col("std_cur").alias("prod_std"),
        now(as_of).alias("check_timestamp"),
    )


def data_drift_summary(drift: DataFrame) -> DataFrame:
    return drift.agg(
        F.count(F.lit(1)).alias("features_monitored"),
        F.count_if("drift_detected").alias("features_drifted"),
        F.count_if(F.col("drift_severity") == "CRITICAL").alias("features_critical"),
    )


def top_drifted(drift: DataFrame, n: int = 10) -> DataFrame:
    """The report's most drifted features."""
    return drift.where("drift_detected").orderBy(F.desc("psi_value"), "feature").limit(n)


def align_classes(baseline: DataFrame, current: DataFrame, target: str) -> DataFrame:
    """Rows per class on both sides, matched by class label; an unseen class counts 0."""
    tagged = baseline.select(F.col(target).alias("class"), F.lit(False).alias("__cur")).unionByName(
        current.select(F.col(target).alias("class"), F.lit(True).alias("__cur"))
    )
    return tagged.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.count_if(~F.col("__cur")).alias("n_base"), F.count_if("__cur").alias("n_cur")
    )


def chi_square(table: DataFrame) -> DataFrame:
    """Test of independence on a table of (class, n_base, n_cur).

    Yates' correction applies to two classes. The result is null unless both sides have at
    least two classes and the same ones.
    """
    whole = Window.partitionBy()  # one row per class
    sized = table.withColumns(
        {
            "__b": F.sum("n_base").over(whole), "__c": F.sum("n_cur").over(whole), "__k": F.count(F.lit(1)).over(whole),
            "__row": F.col("n_base") + F.col("n_cur"),
        }
    )

    def cell(observed: str, column_total: str) -> Column:
        expected = F.col("__row") * F.col(column_total) / (F.col("__b") + F.col("__c"))
        distance = F.abs(F.col(observed) - expected)
        corrected = F.when(F.col("__k") == 2, distance - F.least(F.lit(0.5), distance)).otherwise(distance)
        return F.when(expected > 0, corrected * corrected / expected)

    k, one_sided = F.max("__k"), F.count_if((F.col("n_base") == 0) | (F.col("n_cur") == 0))
    valid = (k > 1) & (one_sided == 0)
    return sized.agg(
        F.when(valid, F.sum(cell("n_base", "__b") + cell("n_cur", "__c"))).alias("chi2_statistic"),
        F.when(valid, k - 1).alias("dof"),
    ).withColumn("chi2_pvalue", chi2_pvalue(F.col("chi2_statistic"), F.col("dof")))


def concept_drift(
    baseline: DataFrame, current: DataFrame, target: str, threshold: float = 0.05, as_of: datetime | None = None
) -> DataFrame:
    """Shift of the positive rate, with the chi-square test of the class distribution."""
    table = align_classes(baseline, current, target)
    positive = F.col("class") == 1

    def rate(side: str) -> Column:
        total = F.sum(side)
        return F.when(total > 0, F.sum(F.when(positive, F.col(side)).otherwise(0)) / total).otherwise(0.0)

    rates = table.agg(rate("n_base").alias("train_positive_rate"), rate("n_cur").alias("prod_positive_rate"))
    tested = chi_square(table).drop("dof")
    shift = F.abs(F.col("train_positive_rate") - F.col("prod_positive_rate"))
    return one_row(rates, tested).withColumns(
        {"target_shift": shift, "concept_drift_detected": shift > threshold, "check_timestamp": now(as_of)}
    )


def prediction_drift(
    baseline: DataFrame, current: DataFrame, score: str, threshold: float = 0.1, as_of: datetime | None = None
) -> DataFrame:
    """Shift of the score distribution: means, KS and PSI in one row."""
    compared = compare_samples(two_samples(baseline, current, [score]))
    shift = F.abs(F.col("mean_base") - F.col("mean_cur"))
    psi_value = F.col("psi_value")
    return compared.select(
        F.col("mean_base").alias("baseline_mean_score"),
        F.col("mean_cur").alias("current_mean_score"),
        F.col("std_base").alias("baseline_std_score"),
        F.col("std_cur").alias("current_std_score"),
        shift.alias("mean_score_shift"),
        "ks_statistic",
        "ks_pvalue",
        "psi_value",
        ((F.col("ks_pvalue") < 0.05) | (psi_value > threshold) | (shift > threshold)).alias("prediction_drift_detected"),
        F.when(psi_value > 0.2, "CRITICAL").when(psi_value > 0.1, "WARNING").otherwise("OK").alias("drift_severity"),
        now(as_of).alias("check_timestamp"),
    )


def model_drift(
    baseline: DataFrame,
    current: DataFrame,
    label: str,
    prediction: str,
    threshold: float = 0.05,
    as_of: datetime | None = None,
) -> DataFrame:
    """Loss of precision, recall and F1 from the baseline to the current predictions."""
    metrics = ("precision", "recall", "f1")
    both = baseline.select(label, prediction, F.lit("baseline").alias("__side")).unionByName(
        current.select(label, prediction, F.lit("current").alias("__side"))
    )
    measured = binary_metrics(both, label, prediction, ["__side"])
    wide = measured.agg(
        *[
            F.coalesce(F.max(F.when(F.col("__side") == side, F.col(m))), F.lit(0.0)).alias(f"{side}_{m}")
            for side in ("baseline", "current")
            for m in metrics
        ]
    )
    losses = wide.withColumns({f"{m}_degradation": F.col(f"baseline_{m}") - F.col(f"current_{m}") for m in metrics})
    recall = F.col("recall_degradation")
    return losses.withColumns(
        {
            "model_drift_detected": reduce(or_, [F.col(f"{m}_degradation") > threshold for m in metrics]),
            "drift_severity": F.when(recall > 0.1, "CRITICAL").when(recall > 0.05, "WARNING").otherwise("OK"),
            "check_timestamp": now(as_of),
        }
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Puts one-row frames side by side: their union, then the only non-null of each column."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def drift_summary(
    data: DataFrame | None = None,
    concept: DataFrame | None = None,
    prediction: DataFrame | None = None,
    model: DataFrame | None = None,
    as_of: datetime | None = None,
    many_features: int = 5,
    many_critical: int = 3,
) -> DataFrame:
    """Overall status and the retraining advice. A check that did not run counts as no drift.

    Prediction drift is reported and triggers neither.
    """
    parts = []
    if data is not None:
        counted = data_drift_summary(data)
        parts.append(
            counted.select(
                F.col("features_drifted").alias("data_drift_features_affected"),
                F.col("features_critical").alias("data_drift_critical"),
            )
        )
    for check, frame in (("concept", concept), ("prediction", prediction), ("model", model)):
        if frame is not None:
            name = f"{check}_drift_detected"
            severity = [F.col("drift_severity").alias("__model_severity")] if check == "model" else []
            parts.append(frame.select(name, *severity))
    if not parts:
        raise ValueError("no drift check to summarise")
    blank = {
        "data_drift_features_affected": F.lit(None).cast("long"), "data_drift_critical": F.lit(None).cast("long"),
        "concept_drift_detected": F.lit(None).cast("boolean"), "prediction_drift_detected": F.lit(None).cast("boolean"),
        "model_drift_detected": F.lit(None).cast("boolean"), "__model_severity": F.lit(None).cast("string"),
    }
    merged = one_row(*parts)
    full = merged.withColumns({c: v for c, v in blank.items() if c not in merged.columns})
    filled = full.fillna({"data_drift_features_affected": 0, "data_drift_critical": 0, "__model_severity": "OK"}).fillna(
        False, subset=["concept_drift_detected", "prediction_drift_detected", "model_drift_detected"]
    )
    concept_hit, model_hit = F.col("concept_drift_detected"), F.col("model_drift_detected")
    critical = (
        (F.col("data_drift_features_affected") > many_features) | concept_hit | (F.col("__model_severity") == "CRITICAL")
    )
    return filled.select(
        now(as_of).alias("timestamp"),
        "data_drift_features_affected",
        "data_drift_critical",
        "concept_drift_detected",
        "prediction_drift_detected",
        "model_drift_detected",
        F.when(critical, "CRITICAL").otherwise("OK").alias("overall_drift_status"),
        ((F.col("data_drift_critical") > many_critical) | concept_hit | model_hit).alias("retraining_recommended"),
    )
