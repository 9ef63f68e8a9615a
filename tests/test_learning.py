"""Boosting against a plain version, the scaling inside a pipeline, and scores by the champion."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from fleetlens.config import FolderLayout, Keys
from fleetlens.operators import boosting, evaluate, forest, train
from fleetlens.plans import learning


def table(n, seed=3):
    r = np.random.default_rng(seed)
    x = np.round(r.normal(size=(n, 4)), 2)
    x[:, 3] = r.integers(0, 3, n)
    y = (x[:, 0] * x[:, 1] + 0.5 * x[:, 2] + 0.3 * r.normal(size=n) > 0.2).astype(float)
    x[r.random(n) < 0.1, 2] = np.nan
    return x, y, np.where(y == 1, 1.5, 0.75)


def frame(spark, x, y, w):
    rows = [(*[None if np.isnan(v) else float(v) for v in a], int(b), float(c)) for a, b, c in zip(x, y, w)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y int, w double").repartition(5)


def plain_boosting(codes, y, w, s):
    """Every cut of every feature of every node tried, one tree after the other."""
    margin, size = np.zeros(len(y)), codes.max() + 1

    def grow(rows, depth):
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-12, None)
        for j in range(codes.shape[1]) if depth < s.depth else ():
            for cut in range(size):
                left = rows[codes[rows, j] <= cut]
                gl, hl = grad[left].sum(), hess[left].sum()
                if hl >= s.min_hessian and h - hl >= s.min_hessian:
                    gain = 0.5 * (gl**2 / (hl + s.l2) + (g - gl) ** 2 / (h - hl + s.l2) - g**2 / (h + s.l2))
                    if gain > best[0] + 1e-9:
                        best = (gain, (j, cut))
        if best[1] is None:
            margin[rows] += -s.rate * g / (h + s.l2)
            return
        j, cut = best[1]
        grow(rows[codes[rows, j] <= cut], depth + 1)
        grow(rows[codes[rows, j] > cut], depth + 1)

    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = w * (p - y), w * p * (1 - p)
        grow(np.arange(len(y)), 0)
    return 1 / (1 + np.exp(-margin))


def test_boosting_equals_a_plain_version(spark):
    x, y, w = table(1000)
    s = boosting.Settings(rounds=6, depth=4, bins=16, store_every=2)
    df = frame(spark, x, y, w)
    model = boosting.SecondOrderBoosting(["a", "b", "c", "d"], "y", "w", s).fit(df)
    import json

    edges = json.loads(model.getOrDefault(model.state))["edges"]
    expected = plain_boosting(boosting.bin_of(x, edges), y, w, s)
    order = {(None if np.isnan(c) else c, a, b, d): p for (a, b, c, d), p in zip(x, expected)}
    for r in model.transform(df).collect():
        assert r["probability"][1] == pytest.approx(order[(r["c"], r["a"], r["b"], r["d"])], abs=1e-9)


def test_boosting_learns_and_is_saved_with_its_pipeline(spark, tmp_path):
    x, y, w = table(1500)
    df = frame(spark, x, y, w)
    candidate = train.Candidate("boosted", "boosted", trees=15, depth=3)
    model = train.train_model(df, ["a", "b", "c", "d"], "y", candidate)
    model.write().overwrite().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    scores = [train.score(df, m, ["a", "b", "y"], ["a", "b", "c", "d"]) for m in (model, again)]
    assert sorted(r["failure_probability"] for r in scores[0].collect()) == sorted(r["failure_probability"] for r in scores[1].collect())
    assert evaluate.ranking_metrics(scores[0], "y", "failure_probability").first()["roc_auc"] > 0.8


def test_boosting_of_one_class_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, None, 0, 1.0)] * 20, "a double, b double, y int, w double")
    edges, trees = boosting.fit_trees(df, ["a", "b"], "y", "w", boosting.Settings(rounds=2, depth=3))
    assert edges == [[1.0], []] and all((t.feature == -1).all() for t in trees) and trees[0].value[0] < 0


def test_scaling_in_the_pipeline_equals_the_column_form(spark):
    x, y, w = table(200)
    df = frame(spark, x, y, w).withColumn("e", F.lit(2.0))
    names = ["a", "b", "c", "d", "e"]
    staged = train.scaler(df, names).transform(df)
    columns = evaluate.standardise(staged, names)
    for r in columns.collect():
        for c in names:
            assert r[f"{c}__scaled"] == (0.0 if r[c] is None else r[f"{c}_z"])
    assert staged.agg(F.stddev_pop("a__scaled")).first()[0] == pytest.approx(1.0) and staged.agg(F.max("e__scaled")).first()[0] == 0


def test_scores_by_the_champion_or_nobody(spark, tmp_path):
    keys = Keys(time="ts")
    r = np.random.default_rng(1)
    rows = [(f"M{i % 7}", f"F{i % 2}", i, float(v := r.normal()), float(r.normal()), int(v + 0.2 * r.normal() > 0.5)) for i in range(600)]
    df = spark.createDataFrame(rows, "turbine_id string, farm_id string, s long, a double, b double, failure_within_next_24_hours int")
    df = df.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    candidates = (train.Candidate("forest", "forest", trees=5, depth=4), train.Candidate("boosted", "boosted", trees=5, depth=3))
    for gate, status, candidates in ((0.5, "CHAMPION SELECTED", candidates), (1.1, "NO QUALIFIED CHAMPION", candidates[:1])):
        layout = FolderLayout(root=f"{tmp_path}/{gate}")
        df.write.parquet(layout.features)
        compared = learning.train_and_compare(spark, f"{tmp_path}/{gate}/models", layout, keys, candidates, min_recall=gate)
        assert compared.count() == len(candidates)
        scores = learning.champion_scores(spark, df, f"{tmp_path}/{gate}/models", layout, keys)
        assert {x[0] for x in scores.select("selection_status").distinct().collect()} == {status} and scores.count() == 600
        unscored = scores.where("failure_probability is null").count()
        assert unscored == (0 if gate < 1 else 600)
        if gate < 1:
            assert {x[0] for x in scores.select("model_run_id").distinct().collect()} == {learning.champion(spark, layout)[1]}
            joined = scores.join(df, ["turbine_id", "ts"]).withColumnRenamed("failure_within_next_24_hours", "y")
            assert evaluate.ranking_metrics(joined, "y", "failure_probability").first()["roc_auc"] > 0.85


def test_the_last_level_of_a_tree_needs_no_job(spark, monkeypatch):
    x, y, w = table(800)
    sizes, plain = [], boosting._summed
    monkeypatch.setattr(boosting, "_summed", lambda partial, parts, size: sizes.append(size) or plain(partial, parts, size))
    _, trees = boosting.fit_trees(frame(spark, x, y, w), ["a", "b", "c", "d"], "y", "w", boosting.Settings(rounds=2, depth=3, bins=16))
    assert sizes == [16 * nodes * 4 * 17 for nodes in (1, 2, 4)] * 2
    leaves = [(t, i) for t in trees for i in range(15) if t.feature[i] < 0 and (i == 0 or t.feature[(i - 1) // 2] >= 0)]
    assert any(i >= 7 for _, i in leaves) and all(t.value[i] != 0 for t, i in leaves)


def test_models_of_a_comparison_are_fitted_at_the_same_time(spark, monkeypatch):
    from threading import Barrier

    from fleetlens.catalog import learning as queries

    both = Barrier(2, timeout=20)  # breaks unless two fits are under way together
    monkeypatch.setattr(queries, "_fit", lambda split, names, model: (both.wait(), f"fitted {model}")[1])
    assert queries._fits(spark.range(1), [], ["x", "y"]) == {"x": "fitted x", "y": "fitted y"}


def test_scaling_of_many_columns_is_two_functions(spark):
    x, y, w = table(300)
    df = frame(spark, x, y, w).withColumns({"e": F.lit(2.0), "n": F.lit(None).cast("double"), "i": F.col("d").cast("int")})
    df = df.withColumn("c", F.nanvl("c", F.lit(None).cast("double")))
    names = ["a", "b", "c", "d", "e", "n", "i"]
    found = evaluate.scaling(df, names)
    for c in names[:5] + ["i"]:
        own = [r[0] for r in df.select(c).collect() if r[0] is not None]
        assert found[c] == pytest.approx((np.mean(own), np.std(own) or 1.0))
    assert found["n"] == (0.0, 1.0) and evaluate.scaling(df.limit(0), names) == {c: (0.0, 1.0) for c in names}
    plan = evaluate.column_moments(df, names)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("avg(") == 1 and plan.count("stddev_pop(") == 1


def test_a_split_that_is_there_is_not_looked_for_again(spark, tmp_path, monkeypatch):
    keys, layout = Keys(time="ts"), FolderLayout(root=str(tmp_path / "t"))
    r = np.random.default_rng(2)
    rows = [(f"M{i % 5}", f"F{i % 2}", i, float(v := r.normal()), int(v + 0.2 * r.normal() > 0.5)) for i in range(300)]
    df = spark.createDataFrame(rows, "turbine_id string, farm_id string, s long, a double, failure_within_next_24_hours int")
    df.withColumn("ts", F.timestamp_seconds("s")).drop("s").write.parquet(layout.features)
    split = evaluate.temporal_split(spark.read.parquet(layout.features), keys)
    searched = []
    monkeypatch.setattr(evaluate, "temporal_split", lambda *a, **b: searched.append(a) or split)
    for given in (split, None):
        compared = learning.train_and_compare(spark, f"{tmp_path}/models", layout, keys, train.CANDIDATES[:1], min_recall=0.1, split=given)
        assert compared.count() == 1 and len(searched) == (given is None)


def plain_tree(codes, y, times, seed, tree, s):
    """One tree by trying every cut of the drawn features of every node: {row: share of class 1}."""
    weights, shares = (0.75, 1.5), np.zeros(len(y))

    def gini(rows):
        c = [weights[k] * times[rows[y[rows] == k]].sum() for k in (0, 1)]
        return sum(c), (1 - sum(v * v for v in c) / sum(c) ** 2) if sum(c) else 0.0, (c[1] / sum(c)) if sum(c) else 0.0

    def grow(rows, node, level):
        total, impurity, shares[rows] = gini(rows)
        best = (1e-12, None)
        looked = forest.features_drawn(codes.shape[0], seed, tree, level)[node - 2**level + 1] if level < s.depth else ()
        for j in looked:
            for cut in range(s.bins + 1):
                left, right = rows[codes[j, rows] <= cut], rows[codes[j, rows] > cut]
                if min(times[left].sum(), times[right].sum()) >= s.min_instances:
                    gain = impurity - sum(w * g for w, g, _ in (gini(left), gini(right))) / total
                    if gain > best[0] + 1e-12:
                        best = (gain, (left, right))
        if best[1] is not None:
            for side, child in zip(best[1], (2 * node + 1, 2 * node + 2)):
                grow(side, child, level + 1)

    grow(np.arange(len(y)), 0, 0)
    return shares


def test_forest_equals_a_plain_version(spark, monkeypatch):
    x, y, w = table(700)
    s = forest.ForestSettings(trees=4, depth=4, bins=16, seed=7)
    df = frame(spark, x, y, w)
    kept = []
    plain = forest.binned_blocks
    monkeypatch.setattr(forest, "binned_blocks", lambda *a: kept.append(plain(*a)) or kept[-1])
    edges, trees, importances = forest.fit_forest(df, ["a", "b", "c", "d"], "y", "w", s)
    blocks = [(np.frombuffer(r["codes"], np.uint8).reshape(4, -1), np.frombuffer(r["y"])) for r in kept[0][1].collect()]
    codes = np.concatenate([c for c, _ in blocks], axis=1)
    labels = np.concatenate([v for _, v in blocks])
    for t, tree in enumerate(trees):
        times = np.concatenate([forest.times_drawn(c.shape[1], 7, t, zlib.crc32(c.tobytes())) for c, _ in blocks]).astype(int)
        assert tree.value[tree.nodes(codes)] == pytest.approx(plain_tree(codes, labels, times, 7, t, s), abs=1e-9)
    assert sum(importances) == pytest.approx(1) and min(importances) >= 0
    monkeypatch.setattr(forest, "FAN_IN", 2)  # sums in several steps
    assert all((a.value == b.value).all() for a, b in zip(trees, forest.fit_forest(df, ["a", "b", "c", "d"], "y", "w", s)[1]))


def test_forest_draws_rows_and_features():
    times = forest.times_drawn(200_000, 1, 2, 3)
    assert abs(times.mean() - 1) < 0.01 and abs(times.var() - 1) < 0.02 and (times == forest.times_drawn(200_000, 1, 2, 3)).all()
    assert abs(np.mean(times == 0) - np.exp(-1)) < 0.005 and (times != forest.times_drawn(200_000, 1, 3, 3)).any()
    drawn = forest.features_drawn(54, 1, 2, 9)
    assert drawn.shape == (512, 8) and all(len(set(r)) == 8 for r in drawn) and abs(np.bincount(drawn.ravel()) - 512 * 8 / 54).max() < 50


def test_a_level_of_a_forest_is_one_job_of_bounded_counts(spark, tmp_path):
    """However many trees: their number of jobs is that of levels."""
    x, y, w = table(600)
    df = frame(spark, x, y, w)
    jobs = []
    for trees in (2, 12):
        spark.sparkContext.setJobGroup(f"forest{trees}", "")
        candidate = train.Candidate("forest", "forest", trees=trees, depth=3)
        model = train.train_model(df, ["a", "b", "c", "d"], "y", candidate)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"forest{trees}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]
    assert isinstance(model.stages[-1], forest.ForestOfTrees) and len(model.stages[-1].featureImportances) == 4
    model.write().overwrite().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    scores = [train.score(df, m, ["a", "b", "y"], ["a", "b", "c", "d"]) for m in (model, again)]
    assert sorted(r["failure_probability"] for r in scores[0].collect()) == sorted(r["failure_probability"] for r in scores[1].collect())
    assert evaluate.ranking_metrics(scores[0], "y", "failure_probability").first()["roc_auc"] > 0.8


def test_forest_of_one_class_and_of_unequal_weights(spark):
    df = spark.createDataFrame([(1.0, None, 1, 2.0)] * 20, "a double, b double, y int, w double")
    _, trees, importances = forest.fit_forest(df, ["a", "b"], "y", "w", forest.ForestSettings(trees=2, depth=3))
    assert all((t.feature == -1).all() and t.value[0] == 1 for t in trees) and importances == [0.0, 0.0]
    with pytest.raises(ValueError):
        forest.fit_forest(df.withColumn("w", F.rand(1)), ["a", "b"], "y", "w")


@pytest.mark.parametrize("bins", [16, 200])
def test_rows_of_a_forest_are_counted_row_after_row(bins):
    r = np.random.default_rng(bins)
    codes, one = r.integers(0, bins + 1, (5, 700)).astype(np.uint8), r.random(700) < 0.3
    tree = boosting.Tree.blank(3)
    tree.feature[:7], tree.cut[:7] = [2, 0, -1, 4, 1, -1, -1], [bins // 2, bins // 3, 0, bins - 1, bins // 4, 0, 0]
    pairs, row = forest.pairs_of(codes, one), np.flatnonzero(r.random(700) < 0.7)
    low = codes[:, codes.max(axis=0) <= bins // 2]  # a group without the high bins meets cuts among them
    for own, at in ((codes, forest.places(tree, 3, pairs, row * 5)), (low, forest.places(tree, 3, forest.pairs_of(low, one[: low.shape[1]]), np.arange(low.shape[1]) * 5))):
        leaf = tree.nodes(own[:, row] if own is codes else own)
        assert (at[leaf >= 7] == leaf[leaf >= 7]).all() and set(at[leaf == 2]) <= {11}  # node 2 is a leaf: on to the left
    at = forest.places(tree, 3, pairs, row * 5)
    slots = np.array([0, 1, 2, 3, -1, -1, -1, -1])
    slot, looked, times = slots[at - 7], np.array([[3, 0], [1, 4], [2, 0], [0, 3]]), r.integers(1, 5, len(row)).astype(np.uint8)
    row, slot, times = row[slot >= 0], slot[slot >= 0], times[slot >= 0]
    kept, plain = np.zeros(4 * 2 * (bins + 1) * 2), np.zeros((4, 2, bins + 1, 2))
    for half in (slice(0, 100), slice(100, None)):
        forest.add_rows(kept, pairs, row[half] * 5, slot[half], looked, times[half], bins + 1)
    for i, k, n in zip(row, slot, times):
        for j, feature in enumerate(looked[k]):
            plain[k, j, codes[feature, i], int(one[i])] += n
    assert (kept == plain.ravel()).all() and kept.sum() == 2 * times.sum()


def test_feature_importance_of_settings_with_many_bins(spark):
    x, y, w = table(900)
    edges, trees, importances = forest.fit_forest(frame(spark, x, y, w), ["a", "b", "c", "d"], "y", "w", forest.ForestSettings(trees=3, depth=4, bins=200))
    assert max(len(e) for e in edges) > 128 and abs(sum(importances) - 1) < 1e-9 and any(t.cut.max() > 127 for t in trees)


def test_champion_scores_compare_every_candidate(spark, tmp_path, monkeypatch):
    from dataclasses import replace

    from fleetlens.catalog import learning as queries

    r = np.random.default_rng(4)
    rows = [(i, int(r.integers(0, 40)), int(r.integers(0, 30 * 86_400)), ("click", "view", "error", "purchase")[i % 4], float(r.random() * 200)) for i in range(2000)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, s long, event_type string, value double")
    events.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s").write.parquet(f"{tmp_path}/events.parquet")
    light = tuple(replace(c, trees=2, depth=2, iterations=5) for c in train.CANDIDATES)
    monkeypatch.setattr(train, "CANDIDATES", light)
    compared, plain = [], learning.train_and_compare
    monkeypatch.setattr(learning, "train_and_compare", lambda *a, **b: compared.append(plain(*a, **b)) or compared[-1])
    scores = queries._champion_scores(spark, str(tmp_path), 0.0)
    told = compared[0].collect()
    assert sorted(t["model_name"] for t in told) == sorted(c.name for c in light) and sum(t["is_champion"] for t in told) == 1
    assert scores.count() > 0 and scores.where("failure_probability is null").count() == 0


def test_models_that_differ_in_weights_are_grown_side_by_side(spark, monkeypatch):
    x, y, w = table(900)
    df = frame(spark, x, y, w).withColumn("v", F.lit(2.0) + F.col("y"))
    s = boosting.Settings(rounds=5, depth=4, bins=16, store_every=2)
    both = boosting.fit_side_by_side(df, ["a", "b", "c", "d"], "y", ["w", "v"], s)
    for weight, trees in zip("wv", both[1]):
        edges, alone = boosting.fit_trees(df.repartition(3), ["a", "b", "c", "d"], "y", weight, s)
        assert edges == both[0]
        for one, other in zip(trees, alone):  # sums are exact, however rows are dealt
            assert (one.feature == other.feature).all() and (one.cut == other.cut).all() and (one.value == other.value).all()
    names = [c.name for group in train.alike(train.CANDIDATES) if len(group) > 1 for c in group]
    assert names == ["boosted_scaled", "boosted_balanced"]
    fits, plain = [], boosting.fit_side_by_side
    monkeypatch.setattr(boosting, "fit_side_by_side", lambda *a: fits.append(a[3]) or plain(*a))
    candidates = [train.Candidate(n, "boosted", weights=n, trees=2, depth=2) for n in ("scale_pos", "balanced")]
    models = train.train_models(df, ["a", "b", "c", "d"], "y", [*candidates, train.Candidate("logistic", "logistic", iterations=5)])
    assert len(fits) == 1 and list(models) == ["scale_pos", "balanced", "logistic"]
    alone = train.train_model(df, ["a", "b", "c", "d"], "y", candidates[1])
    assert models["balanced"].stages[-1].getOrDefault("state") == alone.stages[-1].getOrDefault("state") != models["scale_pos"].stages[-1].getOrDefault("state")


def test_boosting_adds_up_the_lighter_of_two_siblings(spark, monkeypatch):
    x, y, w = table(800)
    sizes, plain = [], boosting._summed
    monkeypatch.setattr(boosting, "_summed", lambda partial, parts, size: sizes.append(partial.first()[1].nbytes) or plain(partial, parts, size))
    s = boosting.Settings(rounds=2, depth=3, bins=16)
    edges, trees = boosting.fit_trees(frame(spark, x, y, w), ["a", "b", "c", "d"], "y", "w", s)
    assert sizes[0] == 16 * 4 * 17 and max(sizes) <= 2 * 16 * 4 * 17  # of four nodes two are added up
    codes, p = boosting.bin_of(x, edges).T, None
    margin = np.zeros(len(y))
    for tree in trees:
        p = 1 / (1 + np.exp(-margin))
        node, g, h = tree.nodes(codes), w * (p - y), w * p * (1 - p)
        for n in set(node):
            assert tree.value[n] == pytest.approx(-0.1 * g[node == n].sum() / (h[node == n].sum() + 1.0), abs=1e-9)
        margin += tree.value[node]
