"""A random forest for binary labels, on rows counted over partitions.

Rows are stored in blocks of bin numbers, as the boosting has them, and a level of all trees is one job. A task takes
its blocks through the trees and counts the rows of each class per (node, feature, bin); a node looks at the square root of the
features, drawn for it alone. Counts of a tree meet in one task, in a tree of bounded fan-in, which finds the
best cut of each of its nodes; the driver sees a row for each node. A task holds counts whose size depends on
the settings and not on the rows: at most 2^(depth - 1) nodes of every tree.

A cut lowers the weighted Gini impurity most and leaves at least `min_instances` rows on either side; ties go to the
feature drawn first, then the lower cut. Each tree sees a row as often as a Poisson number of mean 1 says, drawn from the seed, the
tree and the stored block, so a repeated task draws the same. Counts are whole numbers, so their order does not matter.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import exp, factorial, isqrt

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.boosting import FAN_IN, BoostedTrees, Tree, _arrays, binned_blocks

GROUP_ROWS = 1 << 15  # rows that go through a tree together
_CHANCES = np.cumsum([exp(-1) / factorial(k) for k in range(9)])
_DRAWS = np.searchsorted(_CHANCES, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
_COUNTS = "tree int, part long, counts binary"
_SPLITS = "tree int, node int, feature int, cut int, gain double, l0 long, l1 long, r0 long, r1 long"


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 100
    depth: int = 10
    bins: int = 32
    min_instances: int = 5
    seed: int = 42


def times_drawn(rows: int, seed: int, tree: int, block: int) -> np.ndarray:
    """How often a tree sees each row of a block: Poisson numbers of mean 1, to 16 bits."""
    return _DRAWS[np.random.default_rng([seed, tree, block]).integers(0, 1 << 16, rows, dtype=np.uint16)]


def features_drawn(features: int, seed: int, tree: int, level: int) -> np.ndarray:
    """The features each node of a level looks at, as many as the square root of all, rounded up."""
    wanted = isqrt(max(features - 1, 0)) + 1
    return np.argsort(np.random.default_rng([seed, tree, level, 1]).random((2**level, features)), axis=1)[:, :wanted]


def pairs_of(codes: np.ndarray, one: np.ndarray) -> np.ndarray:
    """2 * bin + class of each value, row after row: what a tree asks about a row lies together."""
    pairs = np.ascontiguousarray(codes.T, np.uint8 if codes.max(initial=0) < 128 else np.uint16)
    return (2 * pairs + one[:, None].astype(pairs.dtype)).ravel()


def places(tree: Tree, level: int, pairs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The node on `level` that each row comes to; `first` is where its pairs begin. A row of a leaf goes on to the left, to nodes that are never cut."""
    inner, most = tree.feature >= 0, np.iinfo(pairs.dtype).max
    feature, cut = np.where(inner, tree.feature, 0).astype(np.int64), np.where(inner, np.minimum(2 * tree.cut + 1, most), most).astype(pairs.dtype)
    at = np.zeros(len(first), np.int64)
    for _ in range(level):
        right = pairs.take(first + feature.take(at)) > cut.take(at)
        at += at
        at += 1
        at += right
    return at


def add_rows(kept: np.ndarray, pairs: np.ndarray, first: np.ndarray, slot: np.ndarray, looked: np.ndarray, times: np.ndarray, width: int) -> None:
    """Adds rows to the counts (slot, feature drawn, bin, class); `looked` has the features of each slot."""
    drawn = looked.shape[1]
    cells = looked.take(slot, axis=0)
    cells += first[:, None]
    cells = pairs.take(cells) + np.arange(drawn) * (2 * width)
    cells += (slot * (drawn * 2 * width))[:, None]
    kept += np.bincount(cells.ravel(), np.repeat(times.astype(np.float64), drawn), len(kept))


def _add(batches: Sequence[bytes]) -> np.ndarray:
    total = np.frombuffer(batches[0], dtype=np.int64).copy()
    for more in batches[1:]:
        total += np.frombuffer(more, dtype=np.int64)
    return total


def best_cuts(counts: np.ndarray, weights: Sequence[float], min_instances: int) -> list[tuple]:
    """(feature among those drawn or -1, cut, gain, rows of class 0 and 1 on the left, the same on the right) of each node of counts (node, feature, bin, class)."""
    left = np.cumsum(counts, axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left

    def gini(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weighed = part * np.asarray(weights)
        total = weighed.sum(axis=-1)
        return total, 1.0 - (weighed**2).sum(axis=-1) / np.where(total > 0, total * total, 1.0)

    (of_all, before), (of_left, a), (of_right, b) = gini(whole), gini(left), gini(right)
    gain = before - (of_left * a + of_right * b) / np.where(of_all > 0, of_all, 1.0)
    allowed = (left.sum(axis=-1) >= max(min_instances, 1)) & (right.sum(axis=-1) >= max(min_instances, 1))
    gain = np.where(allowed, gain, -np.inf)
    out = []
    for k, node in enumerate(gain):
        j, cut = divmod(int(np.argmax(node)), node.shape[1])
        found = node[j, cut] > 1e-12
        sides = [*left[k, j, cut], *right[k, j, cut]] if found else [*whole[k, 0, 0], 0, 0]
        out.append((j if found else -1, cut, float(node[j, cut]) if found else 0.0, *[int(x) for x in sides]))
    return out


def _class_weights(rows: DataFrame, label: str, weight: str) -> tuple[float, float]:
    told = rows.where(F.col(label).isNotNull()).groupBy((F.col(label) == 1).alias("one")).agg(F.min(weight).alias("low"), F.max(weight).alias("high")).collect()
    if any(r["low"] != r["high"] for r in told):
        raise ValueError("rows of a class have one weight")
    by_class = {r["one"]: float(r["low"]) for r in told}
    return by_class.get(False, 1.0), by_class.get(True, 1.0)


def fit_forest(
    rows: DataFrame, features: Sequence[str], label: str, weight: str, settings: ForestSettings = ForestSettings(),
) -> tuple[list[list[float]], list[Tree], list[float]]:
    """(bin edges of each feature, trees, importance of each feature). A tree's value is the weighted share of class 1."""
    count, width, s = len(features), 1 + settings.bins, settings
    weights = _class_weights(rows, label, weight)
    edges, blocks = binned_blocks(rows, features, label, [weight], s.bins)
    trees = [Tree.blank(s.depth) for _ in range(s.trees)]
    gains = np.zeros((s.trees, count))
    opened = [[0] for _ in trees]  # nodes of the level that may be cut

    def share(zeros: int, ones: int) -> float:
        total = zeros * weights[0] + ones * weights[1]
        return ones * weights[1] / total if total else 0.0

    for level in range(max(s.depth, 1)):
        first, drawn = 2**level - 1, len(features_drawn(count, s.seed, 0, 0)[0])
        slots = [np.full(2**level, -1, np.int64) for _ in trees]
        for slot, nodes in zip(slots, opened):
            slot[np.array(nodes, np.int64) - first] = np.arange(len(nodes))
        sizes = [len(nodes) for nodes in opened]

        def count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept = [np.zeros(n * drawn * width * 2) if n else None for n in sizes]  # whole numbers, exact in doubles
            looked = [features_drawn(count, s.seed, t, level)[np.array(nodes, np.int64) - first] if nodes else None for t, nodes in enumerate(opened)]

            def take(group: list[tuple[np.ndarray, np.ndarray]]) -> None:
                pairs = pairs_of(np.concatenate([c for c, _ in group], axis=1), np.concatenate([y for _, y in group]) == 1)
                marks = [(c.shape[1], zlib.crc32(c.tobytes())) for c, _ in group]
                for t, tree in enumerate(trees):
                    if not sizes[t]:
                        continue
                    times = np.concatenate([times_drawn(k, s.seed, t, mark) for k, mark in marks])
                    row = np.flatnonzero(times)
                    slot = slots[t].take(places(tree, level, pairs, row * count) - first)
                    inside = slot >= 0
                    if not inside.all():
                        row, slot = row[inside], slot[inside]
                    add_rows(kept[t], pairs, row * count, slot, looked[t], times[row], width)

            group, held = [], 0
            for batch in batches:
                for codes, y, _, _ in _arrays(batch, count):
                    group.append((codes, y))
                    held += len(y)
                    if held >= GROUP_ROWS:
                        take(group)
                        group, held = [], 0
            if group:
                take(group)
            for t, counts in enumerate(kept):
                if counts is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([counts.astype(np.int64).tobytes()], pa.binary())], names=["tree", "counts"])

        def merge(key: tuple, group: pa.Table) -> pa.Table:
            total = _add(group.column("counts").to_pylist())
            return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

        def cut(key: tuple, group: pa.Table) -> pa.Table:
            t = key[0].as_py()
            counts = _add(group.column("counts").to_pylist()).reshape(-1, drawn, width, 2)
            looked = features_drawn(count, s.seed, t, level)
            found = [
                (t, node, int(looked[node - 2**level + 1, j]) if j >= 0 else -1, *rest)
                for node, (j, *rest) in zip(opened[t], best_cuts(counts, weights, s.min_instances))
            ]
            names, kinds = ("tree", "node", "feature", "cut", "gain", "l0", "l1", "r0", "r1"), [pa.int32()] * 4 + [pa.float64()] + [pa.int64()] * 4
            return pa.table({name: pa.array(column, kind) for name, column, kind in zip(names, zip(*found), kinds)})

        partial = blocks.mapInArrow(count_up, "tree int, counts binary").withColumn("part", F.spark_partition_id().cast("long"))
        parts = blocks.rdd.getNumPartitions()
        while parts > FAN_IN:
            parts = -(-parts // FAN_IN)
            partial = partial.withColumn("part", F.col("part") % parts).groupBy("tree", "part").applyInArrow(merge, _COUNTS)
        splits = partial.groupBy("tree").applyInArrow(cut, _SPLITS).toArrow().to_pylist()
        opened = [[] for _ in trees]
        for r in sorted(splits, key=lambda r: (r["tree"], r["node"])):
            tree, node = trees[r["tree"]], r["node"]
            sides = (r["l0"], r["l1"]), (r["r0"], r["r1"])
            if node == 0:
                tree.value[0] = share(r["l0"] + r["r0"], r["l1"] + r["r1"])
            if r["feature"] < 0 or not s.depth:
                continue
            tree.feature[node], tree.cut[node] = r["feature"], r["cut"]
            gains[r["tree"], r["feature"]] += r["gain"] * sum(zeros * weights[0] + ones * weights[1] for zeros, ones in sides)
            for child, (zeros, ones) in zip((2 * node + 1, 2 * node + 2), sides):
                tree.value[child] = share(zeros, ones)
                if level + 1 < s.depth and zeros and ones and zeros + ones >= 2 * s.min_instances:
                    opened[r["tree"]].append(child)
        if not any(opened):
            break
    own = gains.sum(axis=1, keepdims=True)
    told = (gains / np.where(own > 0, own, 1.0)).sum(axis=0)
    return edges, trees, [float(x) for x in told / (told.sum() or 1.0)]


class ForestOfTrees(BoostedTrees):
    """The fitted stage: the probability is the mean share of the trees."""

    @staticmethod
    def chances(codes: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
        return sum((tree.value[tree.nodes(codes)] for tree in trees), np.zeros(codes.shape[1])) / max(len(trees), 1)

    @staticmethod
    def positive(chance: Column) -> Column:
        return chance > 0.5

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(json.loads(self.getOrDefault(self.state))["importances"])


class Forest(Estimator):
    """The estimator over plain numeric columns, for use in a pipeline."""

    def __init__(self, columns: Sequence[str], label: str, weight: str, settings: ForestSettings = ForestSettings()):
        super().__init__()
        self.columns, self.label, self.weight, self.settings = list(columns), label, weight, settings

    def _fit(self, dataset: DataFrame) -> ForestOfTrees:
        edges, trees, importances = fit_forest(dataset, self.columns, self.label, self.weight, self.settings)
        told = [[t.feature.tolist(), t.cut.tolist(), t.value.tolist()] for t in trees]
        return ForestOfTrees(state=json.dumps({"columns": self.columns, "edges": edges, "trees": told, "importances": importances}))
