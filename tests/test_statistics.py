"""Metrics and drift statistics against brute force in numpy and the math module."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.functions.tests_of_fit import chi2_pvalue, ks_pvalue, ks_pvalue_asymptotic
from fleetlens.operators import drift, evaluate

RNG = np.random.default_rng(5)


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def psi_by_hand(base, cur, bins=10):
    edges = np.percentile(base, np.linspace(0, 100, bins + 1))
    shares = [np.histogram(s, edges)[0] / len(s) for s in (base, cur)]
    e, a = (np.where(s == 0, 1e-4, s) for s in shares)
    return float(np.sum((a - e) * np.log(a / e)))


def ks_by_hand(base, cur):
    points = np.concatenate([base, cur])
    cdf = [np.searchsorted(np.sort(s), points, side="right") / len(s) for s in (base, cur)]
    return float(np.max(np.abs(cdf[0] - cdf[1])))


SAMPLES = {
    "smooth": (RNG.normal(0, 1, 331), RNG.normal(0.3, 1.2, 257)),
    "ties": (RNG.integers(0, 4, 200), RNG.integers(1, 6, 150)),
    "constant": (np.full(50, 3.0), np.full(40, 3.0)),
    "apart": (np.full(50, 3.0), np.full(40, 4.0)),
    "one row": (np.array([1.0]), np.array([2.0])),
}


def test_psi_and_ks_match_numpy(spark):
    names = list(SAMPLES)
    sides = []
    for side in (0, 1):
        longest = max(len(SAMPLES[n][side]) for n in names)
        wide = [[float(SAMPLES[n][side][i]) if i < len(SAMPLES[n][side]) else None for n in names] for i in range(longest)]
        sides.append(spark.createDataFrame(wide, ", ".join(f"`{n}` double" for n in names)))
    out = {r["feature"]: r for r in drift.data_drift(*sides, names).collect()}
    assert set(out) == set(names)
    for n, (base, cur) in SAMPLES.items():
        assert out[n]["psi_value"] == pytest.approx(psi_by_hand(base, cur), abs=1e-12), n
        assert out[n]["ks_statistic"] == pytest.approx(ks_by_hand(base, cur), abs=1e-12), n
        assert out[n]["train_mean"] == pytest.approx(np.mean(base)), n


def test_identical_and_empty_samples(spark):
    df = column(spark, RNG.normal(size=80))
    same = drift.data_drift(df, df, ["x", "absent"]).collect()
    assert len(same) == 1 and same[0]["psi_value"] == 0 and same[0]["ks_statistic"] == 0 and same[0]["drift_severity"] == "OK"
    empty = column(spark, [None, float("nan")])
    assert drift.data_drift(df, empty, ["x"]).count() == 0
    assert drift.psi(df, empty, ["x"]).first()["psi_value"] == 0.0


def test_tail_probabilities(spark):
    row = spark.range(1)
    for x in (0.001, 0.5, 3.84, 10.8, 80.0):
        p = row.select(chi2_pvalue(F.lit(x), F.lit(1))).first()[0]
        assert p == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-9, abs=1e-300)
        two = row.select(chi2_pvalue(F.lit(x), F.lit(2))).first()[0]
        assert two == pytest.approx(math.exp(-x / 2), rel=1e-9)
        four = row.select(chi2_pvalue(F.lit(x), F.lit(4))).first()[0]
        assert four == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-9)
    d = row.select(ks_pvalue(F.lit(0.0), F.lit(10), F.lit(10)), ks_pvalue(F.lit(1.0), F.lit(1000), F.lit(1000))).first()
    assert d[0] == 1.0 and 0 <= d[1] < 1e-12
    # 1.3581 is the 5% point of the Kolmogorov distribution
    assert row.select(ks_pvalue(F.lit(1.3581 / math.sqrt(500)), F.lit(1000), F.lit(1000))).first()[0] == pytest.approx(0.05, abs=1e-4)


def ks_orders(d, n, m):
    """The share of all orders of n and m rows that come as far apart as d, every order counted."""
    import itertools

    hits = total = 0
    for ones in itertools.combinations(range(n + m), n):
        i = j = far = 0
        for k in range(n + m):
            i, j = (i + 1, j) if k in ones else (i, j + 1)
            far = max(far, abs(i * m - j * n))
        total += 1
        hits += far >= round(d * n * m)
    return hits / total


def test_exact_ks_pvalue(spark):
    cases = [(n, m, k / (n * m)) for n, m in ((1, 1), (1, 4), (3, 3), (5, 4), (6, 7), (2, 9)) for k in range(0, n * m + 1, max(1, n * m // 5))]
    df = spark.createDataFrame([(n, m, d) for n, m, d in cases], "n long, m long, d double")
    found = {(r.n, r.m, r.d): r.p for r in df.select("*", ks_pvalue(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()}
    for n, m, d in cases:
        assert found[(n, m, d)] == pytest.approx(ks_orders(d, n, m), abs=1e-12), (n, m, d)
    # far apart: 2 / C(60, 30), no digits lost; large samples: the limit, which the exact value approaches
    far, near, limit = spark.range(1).select(
        ks_pvalue(F.lit(1.0), F.lit(30), F.lit(30)), ks_pvalue(F.lit(0.1), F.lit(500), F.lit(500)),
        ks_pvalue_asymptotic(F.lit(0.1), F.lit(500), F.lit(500)),
    ).first()
    assert far == pytest.approx(2 / math.comb(60, 30), rel=1e-9) and near == pytest.approx(limit, rel=0.15)
    over = spark.range(1).select(ks_pvalue(F.lit(0.1), F.lit(501), F.lit(500)), ks_pvalue_asymptotic(F.lit(0.1), F.lit(501), F.lit(500))).first()
    assert over[0] == over[1]


def test_no_score_row_moves_by_its_feature_or_model_alone(spark):
    import re

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(500).selectExpr("cast(id % 3 as string) model_name", "cast(id % 2 as int) y", "id / 7.0D s")
        ranked = evaluate.ranking_metrics(rows, "y", "s", ["model_name"])._jdf.queryExecution().executedPlan().toString()
        samples = drift.two_samples(rows, rows, ["s", "y"])
        compared = drift.compare_samples(samples)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for plan, key in ((ranked, "model_name"), (compared, "feature")):
        # an exchange by the key alone carries partial aggregates, one row per task and key
        for part in plan.split("Exchange hashpartitioning(")[1:]:
            keys, below = part.split(", ", 1)
            if re.match(rf"{key}#\d+$", keys):
                assert "partial_" in below.split("\n")[1] or "Aggregate" in below.split("\n")[1], part[:300]


def test_chi_square_by_hand(spark):
    def labels(zeros, ones, twos=0):
        return spark.createDataFrame([(0,)] * zeros + [(1,)] * ones + [(2,)] * twos, "y int")

    def run(a, b):
        return drift.chi_square(drift.align_classes(a, b, "y")).first()

    out = run(labels(90, 10), labels(40, 20))
    expected = sum((abs(o - e) - 0.5) ** 2 / e for o, e in ((90, 81.25), (10, 18.75), (40, 48.75), (20, 11.25)))
    assert out["chi2_statistic"] == pytest.approx(expected) and out["dof"] == 1
    three = run(labels(10, 20, 30), labels(30, 20, 10))
    assert three["chi2_statistic"] == pytest.approx(20.0) and three["dof"] == 2
    one_class = run(labels(5, 0), labels(5, 0))
    assert one_class["chi2_statistic"] is None and one_class["chi2_pvalue"] is None
    # a majority that flips is compared class by class, not rank by rank
    flipped = drift.concept_drift(labels(90, 10), labels(10, 90), "y").first()
    assert flipped["concept_drift_detected"] and flipped["chi2_pvalue"] < 1e-6
    gone = drift.concept_drift(labels(5, 5), labels(5, 0), "y").first()
    assert gone["target_shift"] == 0.5 and gone["chi2_statistic"] is None


def test_ranking_metrics_match_brute_force(spark):
    score = RNG.integers(0, 40, 300) / 40
    y = (RNG.random(300) < 0.2 + 0.4 * score).astype(int)
    df = spark.createDataFrame([("m", int(a), float(s)) for a, s in zip(y, score)], "model_name string, y int, s double")
    for by in ((), ("model_name",)):
        out = evaluate.ranking_metrics(df, "y", "s", by).first()
        pos, neg = score[y == 1], score[y == 0]
        auc = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
        steps = [(np.sum(pos == s) / len(pos)) * np.sum(pos >= s) / np.sum(score >= s) for s in np.unique(score)]
        assert out["roc_auc"] == pytest.approx(auc) and out["pr_auc"] == pytest.approx(sum(steps))
    mirrored = evaluate.ranking_metrics(df.withColumn("s", -F.col("s")), "y", "s").first()
    assert mirrored["roc_auc"] == pytest.approx(1 - auc)


def test_metrics_with_one_class(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 1, 0.9)], "y int, p int, s double")
    out = evaluate.binary_metrics(df, "y", "p").first()
    assert (out["precision"], out["recall"], out["f1"], out["accuracy"]) == (0, 0, 0, 0.5)
    assert evaluate.ranking_metrics(df, "y", "s").first()["roc_auc"] is None


def _models(spark, *rows):
    schema = "model_name string, accuracy double, precision double, recall double, f1 double, roc_auc double, pr_auc double"
    return spark.createDataFrame(rows, schema)


def test_champion_rules(spark):
    metrics = _models(
        spark, ("best_but_blind", 0.9, 0.9, 0.5, 0.6, 0.9, 0.99), ("b", 0.9, 0.5, 0.79996, 0.7, 0.9, 0.8), ("a", 0.9, 0.5, 0.9, 0.6, 0.9, 0.8)
    )
    out = {r["model_name"]: r for r in evaluate.select_champion(evaluate.compare_models(metrics), 0.8).collect()}
    assert [n for n, r in out.items() if r["is_champion"]] == ["b"]  # rounded recall passes, F1 breaks the tie
    none = evaluate.select_champion(evaluate.compare_models(metrics), 0.95)
    assert none.where("is_champion").count() == 0
    assert none.first()["selection_status"] == "NO QUALIFIED CHAMPION" and none.first()["best_recall"] == 0.9


def test_standardise_constant_column(spark):
    out = evaluate.standardise(spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double"), ["a", "b"]).orderBy("a").collect()
    assert [r["a_z"] for r in out] == [-1.0, 1.0] and [r["b_z"] for r in out] == [0.0, 0.0]


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "y int")
    balanced = df.select(evaluate.weight_column(df, "y").alias("w"), "y").distinct().collect()
    assert {r["y"]: r["w"] for r in balanced} == {0: pytest.approx(10 / 18), 1: 5.0}
    assert df.where("y = 1").select(evaluate.weight_column(df, "y", "scale_pos")).first()[0] == 9.0


def test_summary_rules(spark):
    def data(critical, warning):
        rows = [("f", True, "CRITICAL")] * critical + [("f", True, "WARNING")] * warning + [("f", False, "OK")]
        return spark.createDataFrame(rows, "feature string, drift_detected boolean, drift_severity string")

    def model(detected, severity):
        return spark.createDataFrame([(detected, severity)], "model_drift_detected boolean, drift_severity string")

    def run(**checks):
        r = drift.drift_summary(**checks).first()
        return r["overall_drift_status"], r["retraining_recommended"]

    assert run(data=data(0, 5)) == ("OK", False)
    assert run(data=data(0, 6)) == ("CRITICAL", False)
    assert run(data=data(4, 0)) == ("OK", True)
    assert run(model=model(True, "WARNING")) == ("OK", True)
    assert run(model=model(True, "CRITICAL")) == ("CRITICAL", True)
    only = spark.createDataFrame([(True,)], "prediction_drift_detected boolean")
    assert run(prediction=only) == ("OK", False)


def test_p_values_of_many_features_are_spread_over_tasks(spark):
    samples = spark.range(4000).selectExpr("concat('M', id % 40) feature", "cast(id * 7 % 31 as double) value", "id % 3 = 0 `__cur`")
    tested = drift.ks_of_samples(samples).withColumn("task", F.spark_partition_id()).collect()
    assert len(tested) == 40 and len({r["task"] for r in tested}) > 1


def test_counts_of_two_samples(spark, monkeypatch):
    """Nulls and NaN are left out, both zeros are one value, and a value is one row however its rows are dealt."""
    monkeypatch.setattr(drift, "COUNTED_ROWS", 50)
    values = [None, float("nan"), 0.0, -0.0, -3.5, float("inf"), 7.25]
    base = spark.createDataFrame([(values[i % 7], i % 90) for i in range(700)], "a double, b int").repartition(3)
    cur = spark.createDataFrame([(float(i % 4), None) for i in range(40)], "a double, b int").repartition(2)
    found = sorted(tuple(r) for r in drift.two_samples(base, cur, ["a", "b"]).collect())
    a = {-3.5: (100, 0), 0.0: (200, 10), 1.0: (0, 10), 2.0: (0, 10), 3.0: (0, 10), 7.25: (100, 0), float("inf"): (100, 0)}
    b = {float(v): (sum(i % 90 == v for i in range(700)), 0) for v in range(90)}
    assert found == sorted([(0, v, *n) for v, n in a.items()] + [(1, v, *n) for v, n in b.items()])
    plan = drift.two_samples(base, cur, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # no row for every value of every column
    assert drift.two_samples(base.limit(0), cur.limit(0), ["a", "b"]).count() == 0


def test_machines_in_one_chunk_need_no_copies(spark):
    from pyspark.sql import Window

    from fleetlens.config import Keys
    from fleetlens.operators import features

    keys = Keys(time="ts")
    df = spark.range(600).selectExpr(
        "id", "case when id < 400 then 'HOT' when id < 450 then null else concat('M', id % 9) end turbine_id", "timestamp_seconds(id * 600) ts", "cast(id % 31 as double) x",
    )
    rolled, lags = (features.Rolling("m", "avg", "x", "long"),), (features.Lag("l", "x", 12),)
    w = Window.partitionBy("turbine_id").orderBy("ts")
    plain = df.withColumns({"m": F.avg("x").over(w.rowsBetween(-36, 0)), "l": F.lag("x", 12).over(w)}).orderBy("id").select("id", "m", "l").collect()
    for whole in (0, 10, 49, 100, 1000):
        ours = features.windowed(df, keys, rolled, lags, chunk_seconds=9000, whole_rows=whole)
        assert ours.orderBy("id").select("id", "m", "l").collect() == plain, whole
        assert ("Union" in ours._jdf.queryExecution().executedPlan().toString()) == (whole < 1000)
