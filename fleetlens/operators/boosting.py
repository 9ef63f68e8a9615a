"""Second-order gradient boosting for binary labels, on histograms summed over partitions.

Values are cut into at most `bins` quantile bins once, and rows are stored in blocks of bin numbers, feature by feature.
A level of inner nodes is one job: every task adds up gradient and Hessian of the logistic loss per (node, feature, bin)
for its blocks, and the sums are merged in a tree of bounded fan-in. Of two siblings only the lighter one is added up; the
other is what it leaves of their parent. The driver sees one histogram per level, whose size depends on the settings and
not on the rows. What a split leaves on either side is in its histogram, so the last level needs no job. The driver splits where

    G_l^2 / (H_l + lambda) + G_r^2 / (H_r + lambda) - G^2 / (H + lambda)

is greatest, and a leaf weighs -G / (H + lambda) times the learning rate. Blocks are kept by the executors, with new margins
after each tree, and checkpointed every few trees: a task whose block is lost starts from there. Models that differ in
their weights alone are grown side by side, over the same blocks and in the same jobs.

Gradients and Hessians are rounded to a fraction of a power of two so small that sums of all rows are exact in doubles:
they depend on no order, and a difference is what adding up would have given.

Missing values have a bin of their own below all others. Ties go to the first feature, then the lower cut.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.session import shared_folder

BLOCK_ROWS = 8192
JOINED_BLOCKS = 4  # blocks that the boosting takes together
PART_BLOCKS = 128  # of a task, at most
FAN_IN = 64
MOST_BYTES = 1 << 25  # of histograms that reach the driver at once
_BLOCK = "rows int, codes binary, y binary, w binary, margin binary"


@dataclass(frozen=True)
class Settings:
    """store_every: margins are checkpointed after so many trees."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.1
    bins: int = 64
    l2: float = 1.0
    min_gain: float = 0.0
    min_hessian: float = 1.0
    store_every: int = 10


@dataclass
class Tree:
    """A heap of nodes: node i has children 2 i + 1 and 2 i + 2; feature -1 marks a leaf. Bins up to `cut` go left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @staticmethod
    def blank(depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return Tree(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size))

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The node that each column of bin numbers (feature, row) comes to."""
        rows, values = np.arange(codes.shape[1]), np.ascontiguousarray(codes).ravel()
        at, heap, inner = np.zeros(len(rows), np.int64), np.arange(len(self.feature)), self.feature >= 0
        if not inner.any():
            return at
        # a leaf leads to itself: no bin number is above its cut
        begin, cut, down = np.where(inner, self.feature, 0) * len(rows), np.where(inner, self.cut, 255), np.where(inner, 2 * heap + 1, heap)
        for _ in range(int(heap[inner].max() + 1).bit_length()):
            right = values.take(begin.take(at) + rows) > cut.take(at)
            at = down.take(at)
            at += right
        return at


def bin_of(values: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Rows of values to rows of bin numbers; 0 is for missing ones."""
    out = np.empty(values.shape, dtype=np.uint8)
    for j, own in enumerate(edges):
        out[:, j] = np.where(np.isnan(values[:, j]), 0, 1 + np.searchsorted(own, values[:, j], side="left"))
    return out


def gradients(y: np.ndarray, w: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1.0 / (1.0 + np.exp(-margin))
    return w * (p - y), w * p * (1.0 - p)


def best_splits(histogram: np.ndarray, settings: Settings) -> list[tuple[float, int, int] | None]:
    """(gain, feature, cut) of each node of a histogram (node, feature, bin, gradient and Hessian)."""
    left = np.cumsum(histogram, axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left

    def score(part: np.ndarray) -> np.ndarray:
        return part[..., 0] ** 2 / (part[..., 1] + settings.l2)

    gain = score(left) + score(right) - score(whole)
    allowed = (left[..., 1] >= settings.min_hessian) & (right[..., 1] >= settings.min_hessian)
    gain = np.where(allowed, 0.5 * gain - settings.min_gain, -np.inf)
    out: list[tuple[float, int, int] | None] = []
    for node in gain:
        at = int(np.argmax(node))
        j, cut = divmod(at, node.shape[1])
        out.append((float(node[j, cut]), j, cut) if node[j, cut] > 1e-12 else None)
    return out


def _summed(partial: RDD, parts: int, size: int) -> np.ndarray:
    """The sum of arrays of at most `size` bytes, (number, array) in each of `parts`, by groups of `FAN_IN` until the rest fits `MOST_BYTES`."""
    while parts * size > MOST_BYTES and parts > 1:
        parts = to = -(-parts // FAN_IN)
        partial = partial.map(lambda x, to=to: (x[0] % to, x[1])).reduceByKey(np.add, to)
    return np.sum([sums for _, sums in partial.collect()], axis=0)


def _arrays(batch: pa.RecordBatch, features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for n, codes, y, w, margin in zip(*[batch.column(c).to_pylist() for c in ("rows", "codes", "y", "w", "margin")]):
        yield np.frombuffer(codes, np.uint8).reshape(features, n), *[np.frombuffer(b, np.float64) for b in (y, w, margin)]


def _block(codes: np.ndarray, y: np.ndarray, w: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([len(y)], pa.int32())] + [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in (codes, y, w, margin)]
    return pa.RecordBatch.from_arrays(cells, names=["rows", "codes", "y", "w", "margin"])


def _plus(margin: np.ndarray, codes: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    for tree in trees:
        margin = margin + tree.value[tree.nodes(codes)]
    return margin


def _stored(blocks: DataFrame) -> DataFrame:
    path = f"{shared_folder(blocks.sparkSession)}/boosting-{uuid.uuid4().hex}"
    blocks.write.parquet(path)
    return blocks.sparkSession.read.schema(_BLOCK).parquet(path)


def binned_blocks(rows: DataFrame, features: Sequence[str], label: str, weights: Sequence[str], bins: int) -> tuple[list[list[float]], DataFrame]:
    """(bin edges of each feature, stored blocks of bin numbers) of the rows that have a label; a block has one weight and margin after the other."""
    if bins > 255:
        raise ValueError("bins are stored in bytes")
    count = len(features)
    known = rows.where(F.col(label).isNotNull()).select(
        *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{j}") for j, c in enumerate(features)],
        F.col(label).cast("double").alias("y"), *[F.col(w).cast("double").alias(f"w{k}") for k, w in enumerate(weights)],
    )
    shares = [k / bins for k in range(1, bins)]
    found = known.agg(*[F.percentile_approx(f"x{j}", shares, 100 * bins).alias(f"x{j}") for j in range(count)]).first()
    edges = [sorted(set(found[f"x{j}"] or [])) for j in range(count)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                columns = [part.column(f"x{j}").to_numpy(zero_copy_only=False).astype(np.float64) for j in range(count)]
                y, *w = (part.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("y", *[f"w{k}" for k in range(len(weights))]))
                yield _block(bin_of(np.column_stack(columns), edges).T, y, np.stack(w), np.zeros((len(w), len(y))))

    return edges, _stored(known.mapInArrow(pack, _BLOCK))


Kept = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # bin numbers (feature, row), labels, weights and margins (model, row)


def _kept(blocks: DataFrame, features: int) -> RDD:
    """The stored blocks as arrays of some more rows, dealt evenly over all cores."""
    count, slots = blocks.count(), blocks.sparkSession.sparkContext.defaultParallelism

    def load(rows: Iterator) -> Iterator[Kept]:
        group: list[Kept] = []
        for r in rows:
            n = r["rows"]
            y, w, margin = (np.frombuffer(r[c], np.float64) for c in ("y", "w", "margin"))
            group.append((np.frombuffer(r["codes"], np.uint8).reshape(features, n), y, w.reshape(-1, n), margin.reshape(-1, n)))
            if len(group) == JOINED_BLOCKS:
                yield tuple(np.concatenate(a, axis=-1) for a in zip(*group))
                group = []
        if group:
            yield tuple(np.concatenate(a, axis=-1) for a in zip(*group))

    parts = min(slots * -(-count // (slots * PART_BLOCKS)), count)
    return blocks.repartition(max(parts, 1)).rdd.mapPartitions(load).persist(StorageLevel.MEMORY_AND_DISK)


def _grown(kept: RDD, trees: Sequence[Tree]) -> RDD:
    """The blocks with the newest tree of each model in its margins."""

    def add(blocks: Iterator[Kept]) -> Iterator[Kept]:
        for codes, y, w, margin in blocks:
            yield codes, y, w, np.stack([_plus(m, codes, [tree]) for m, tree in zip(margin, trees)])

    return kept.mapPartitions(add).persist(StorageLevel.MEMORY_AND_DISK)


def fit_trees(rows: DataFrame, features: Sequence[str], label: str, weight: str, settings: Settings = Settings()) -> tuple[list[list[float]], list[Tree]]:
    """(bin edges of each feature, trees) from rows of numeric columns; rows without a label are left out."""
    edges, models = fit_side_by_side(rows, features, label, [weight], settings)
    return edges, models[0]


def fit_side_by_side(
    rows: DataFrame, features: Sequence[str], label: str, weights: Sequence[str], settings: Settings = Settings(),
) -> tuple[list[list[float]], list[list[Tree]]]:
    """(bin edges of each feature, trees of a model for each column of weights), all models in the same jobs."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    count, width, models = len(features), 1 + settings.bins, range(len(weights))
    edges, blocks = binned_blocks(rows, features, label, weights, settings.bins)
    kept = _kept(blocks, count)
    parts = kept.getNumPartitions()
    total = kept.map(lambda block: block[2].sum(axis=1)).fold(np.zeros(len(weights)), np.add)
    units = [2.0 ** (51 - ceil(log2(max(t, 1.0)))) for t in total]

    def added(trees: list[Tree], slots: list[np.ndarray], level: int) -> list[np.ndarray]:
        """For each model the histogram (node, feature, bin, gradient and Hessian) of the nodes of a level that have a slot."""
        first, sizes = 2**level - 1, [int(s.max(initial=-1)) + 1 for s in slots]
        ends = np.cumsum([0] + [2 * count * n * width for n in sizes])

        def count_up(part: int, blocks: Iterator[Kept]) -> Iterator[tuple[int, np.ndarray]]:
            every = np.zeros(ends[-1])
            sums = [every[a:b].reshape(2, count, n * width) for a, b, n in zip(ends, ends[1:], sizes)]
            for codes, y, w, margin in blocks:
                for m, tree in enumerate(trees):
                    if not sizes[m]:
                        continue
                    node = tree.nodes(codes) - first
                    slot = np.where(node >= 0, slots[m].take(np.maximum(node, 0)), -1)
                    inside = np.flatnonzero(slot >= 0)
                    sides = [np.rint(side * units[m]) for side in gradients(y.take(inside), w[m].take(inside), margin[m].take(inside))]
                    first_bin = slot.take(inside) * width
                    for j in range(count):
                        cell = first_bin + (codes[j].take(inside) if len(inside) < len(y) else codes[j])
                        for k, values in enumerate(sides):
                            sums[m][k, j] += np.bincount(cell, values, sizes[m] * width)
            yield part, every

        every = _summed(kept.mapPartitionsWithIndex(count_up), parts, 16 * len(weights) * 2**level * count * width)
        return [
            np.transpose(np.reshape(every[a:b] / unit, (2, count, n, width)), (2, 1, 3, 0))
            for a, b, n, unit in zip(ends, ends[1:], sizes, units)
        ]

    def weigh(tree: Tree, node: int, sums: np.ndarray) -> None:
        tree.value[node] = -settings.rate * sums[0] / (sums[1] + settings.l2)

    forests: list[list[Tree]] = [[] for _ in models]
    left: list[RDD] = []  # blocks with the margins before, until the next ones are there
    for grown in range(1, settings.rounds + 1):
        trees = [Tree.blank(settings.depth) for _ in models]
        above: list[dict[int, np.ndarray]] = [{} for _ in models]  # histograms of nodes that were split
        opened = [[0] for _ in models]
        lighter: list[list[int]] = [[0] for _ in models]
        for level in range(max(settings.depth, 1)):
            slots = [np.full(2**level, -1) for _ in models]
            for slot, nodes in zip(slots, lighter):
                slot[np.array(nodes, np.int64) - (2**level - 1)] = np.arange(len(nodes))
            found = added(trees, slots, level)
            while left:
                left.pop().unpersist()
            for m, tree in enumerate(trees):
                sums = dict(zip(lighter[m], found[m]))
                sums |= {n: above[m][(n - 1) // 2] - sums[n + 1 if n % 2 else n - 1] for n in opened[m] if n not in sums}
                if level == 0:
                    weigh(tree, 0, sums[0][0].sum(axis=0))  # every row is in one bin of the first feature
                nodes, opened[m], lighter[m], above[m] = opened[m], [], [], sums
                splits = best_splits(np.stack([sums[n] for n in nodes]), settings) if settings.depth and nodes else []
                for node, split in zip(nodes, splits):
                    if split is not None:
                        _, feature, cut = split
                        tree.feature[node], tree.cut[node] = feature, cut
                        sides = sums[node][feature, : cut + 1].sum(axis=0), sums[node][feature, cut + 1 :].sum(axis=0)
                        children = 2 * node + 1, 2 * node + 2
                        for child, side in zip(children, sides):
                            weigh(tree, child, side)
                        opened[m] += children
                        lighter[m].append(children[int(sides[1][1] < sides[0][1])])
            if not any(opened):
                break
        for forest, tree in zip(forests, trees):
            forest.append(tree)
        if grown < settings.rounds:
            left.append(kept)
            kept = _grown(kept, trees)
            if grown % settings.store_every == 0:
                kept.checkpoint()
    kept.unpersist()
    return edges, forests


class BoostedTrees(Model, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted stage: adds `probability` and `prediction`. Its state is a parameter, so it is saved with a pipeline."""

    state = Param(Params._dummy(), "state", "columns, bin edges and trees as JSON")

    @keyword_only
    def __init__(self, state: str = "{}"):
        super().__init__()
        self._setDefault(state="{}")
        self._set(**self._input_kwargs)

    @staticmethod
    def chances(codes: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-_plus(np.zeros(codes.shape[1]), codes, trees)))

    @staticmethod
    def positive(chance: Column) -> Column:
        return chance >= 0.5

    def _transform(self, dataset: DataFrame) -> DataFrame:
        told = json.loads(self.getOrDefault(self.state))
        edges, columns = told["edges"], told["columns"]
        trees = [Tree(np.array(f, np.int32), np.array(c, np.int32), np.array(v)) for f, c, v in told["trees"]]
        chances = self.chances

        @F.pandas_udf("double")
        def chance(values: pd.Series) -> pd.Series:
            codes = np.ascontiguousarray(bin_of(np.array(values.tolist(), dtype=np.float64).reshape(len(values), len(columns)), edges).T)
            return pd.Series(chances(codes, trees))

        values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns])
        scored = dataset.withColumn("__p", chance(values))
        return scored.withColumns({
            "probability": array_to_vector(F.array(1.0 - F.col("__p"), F.col("__p"))), "prediction": self.positive(F.col("__p")).cast("double"),
        }).drop("__p")


class SecondOrderBoosting(Estimator):
    """The estimator over plain numeric columns, for use in a pipeline."""

    def __init__(self, columns: Sequence[str], label: str, weight: str, settings: Settings = Settings()):
        super().__init__()
        self.columns, self.label, self.weight, self.settings = list(columns), label, weight, settings

    def _fit(self, dataset: DataFrame) -> BoostedTrees:
        return self.side_by_side(dataset, [self.weight])[0]

    def side_by_side(self, dataset: DataFrame, weights: Sequence[str]) -> list[BoostedTrees]:
        """A model for each column of weights."""
        edges, models = fit_side_by_side(dataset, self.columns, self.label, weights, self.settings)
        told = [[[t.feature.tolist(), t.cut.tolist(), t.value.tolist()] for t in trees] for trees in models]
        return [BoostedTrees(state=json.dumps({"columns": self.columns, "edges": edges, "trees": trees})) for trees in told]
