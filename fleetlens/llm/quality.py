"""Quality classifier: a Gaussian kernel over document statistics by random Fourier features.

Each document becomes a few statistics of its characters, words and lines. They are standardised
and mapped to cos(Wx + b) with random W, which approximates a Gaussian kernel. Ridge regression on
the labels needs only the sums Z'Z and Z'y: each partition adds up its own, and the sums are added
in a tree of bounded fan-in. Scores of labelled rows that the ridge has not seen are then calibrated by isotonic
regression (pool adjacent violators over a histogram of scores), read off by linear interpolation.

Null and empty texts have statistics of 0 and get a score like any other. Where nothing can be
learned the score is 0.5. Labels of one document that differ are averaged; null labels are left
out. The fit uses at most about `train_rows` labelled rows, chosen by a hash of the id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Words, byte_spans, slices, stored
from fleetlens.llm.language import fold_of


@dataclass(frozen=True)
class Settings:
    features: int = 384
    width: float = 4.0
    ridge: float = 1.0
    bins: int = 2000
    train_rows: int = 100_000
    seed: int = 7


_CLASSES = 8


def _byte_classes() -> np.ndarray:
    """Class of each byte: 0 other, 1 a-z, 2 A-Z, 3 digit, 4 comma or full stop, 5 ! or ?,
    6 other ASCII punctuation, 7 space or line break."""
    table = np.zeros(256, dtype=np.int64)
    table[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 6
    table[97:123], table[65:91], table[48:58] = 1, 2, 3
    table[[44, 46]], table[[33, 63]], table[[9, 10, 13, 32]] = 4, 5, 7
    return table


_CLASS = _byte_classes()
N_STATISTICS = 22


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of statistics per text."""
    data, offsets = byte_spans(texts)
    words = Words(texts)
    out = np.zeros((len(texts), N_STATISTICS))
    for i in range(len(texts)):
        raw = data[offsets[i] : offsets[i + 1]]
        own = words.hashes[words.first[i] : words.first[i + 1]]
        if not len(raw) or not len(own):
            continue
        lengths = (words.ends - words.starts)[words.first[i] : words.first[i + 1]]
        first = raw[words.starts[words.first[i] : words.first[i + 1]] - offsets[i]]
        last = raw[words.ends[words.first[i] : words.first[i + 1]] - 1 - offsets[i]]
        share = np.bincount(_CLASS[raw], minlength=_CLASSES) / len(raw)
        n = len(own)
        kinds, times = np.unique(own, return_counts=True)
        pairs = own[1:] * np.uint64(31) + own[:-1] if n > 1 else own
        kinds2, times2 = np.unique(pairs, return_counts=True)
        breaks = np.flatnonzero(raw == 10)
        lines = len(breaks) + 1
        used = times / n
        out[i] = [
            np.log1p(n), np.log1p(len(raw)), lengths.mean(), lengths.std(), *share[1:7], np.log1p(lines), np.log1p(n / lines),
            len(kinds) / n, times.max() / n, times2[times2 > 1].sum() / len(pairs), (own[1:] == own[:-1]).sum() / n,
            -(used * np.log(used)).sum() / max(np.log(n), 1.0), (_CLASS[first] == 2).mean(), (_CLASS[last] == 6).mean(),
            (_CLASS[last] == 5).mean(), (lengths == 1).mean(), (_CLASS[last] == 4).mean(),
        ]
    return out


#: Vectors that are added up at a time, in a task or on the driver.
FAN_IN = 16


def summed(df: DataFrame, partial: Callable[[pa.RecordBatch], np.ndarray | None], fan_in: int = FAN_IN) -> np.ndarray | None:
    """The sum of one vector per batch: per partition, then level by level over `fan_in` neighbours.

    No task gets more than `fan_in` vectors at a time, and the driver at most as many, whatever the number of
    partitions. Each level adds in the order of the partitions, so the sum of the same partitions is the same.
    """

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            value = partial(batch) if batch.num_rows else None
            if value is not None:
                total = value if total is None else total + value
        if total is not None:
            k = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["k", "v"])

    def add(numbers: list[int], vectors: list[bytes]) -> np.ndarray:
        return sum(np.frombuffer(v, dtype=np.float64) for _, v in sorted(zip(numbers, vectors), key=lambda pair: pair[0]))

    def outer(key: tuple, group: pa.Table) -> pa.Table:
        total = add(group.column("k").to_pylist(), group.column("v").to_pylist())
        return pa.table({"k": pa.array([key[0].as_py()], pa.int64()), "v": pa.array([total.tobytes()], pa.binary())})

    level = stored(df.mapInArrow(inner, "k long, v binary"), "partial-sums")
    last = level.agg(F.max("k")).first()[0]
    if last is None:
        return None
    while last >= fan_in:
        level = level.groupBy(F.expr(f"k div {fan_in}").alias("above")).applyInArrow(outer, "k long, v binary")
        last //= fan_in
    rows = level.collect()
    return add([r["k"] for r in rows], [r["v"] for r in rows])


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, N_STATISTICS)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def mapped(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.mapped(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0.0, 1.0)


def isotonic(x: np.ndarray, total: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (mean place, level) of each pool of bins, ascending."""
    pools: list[list[float]] = []
    for place, t, c in zip(x, total, count):
        pools.append([place * c, t, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            top = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], top)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fit(labelled: DataFrame, calibration: DataFrame, settings: Settings = Settings()) -> Model:
    """From rows with `x` (packed statistics) and `y`; calibrated on the second table."""
    random = np.random.default_rng(settings.seed)
    w = random.normal(size=(N_STATISTICS, settings.features)) / settings.width
    b = random.uniform(0, 2 * np.pi, settings.features)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = _vectors(batch.column("x"))
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    none = np.zeros(0)
    got = summed(labelled, moments)
    if got is None:
        zeros = np.zeros(N_STATISTICS)
        return Model(zeros, zeros + 1, w, b, np.zeros(settings.features + 1), none, none)
    mean = got[1 : N_STATISTICS + 1] / got[0]
    scale = np.sqrt(np.maximum(got[N_STATISTICS + 1 :] / got[0] - mean**2, 0))
    empty = Model(mean, np.where(scale > 1e-9, scale, 1.0), w, b, none, none, none)

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z, y = empty.mapped(_vectors(batch.column("x"))), np.asarray(batch.column("y"))
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    size = settings.features + 1
    sums = summed(labelled, equations)
    penalty = settings.ridge * np.eye(size)
    penalty[-1, -1] = 1e-6
    weights = np.linalg.solve(sums[: size * size].reshape(size, size) + penalty, sums[size * size :])
    fitted = Model(mean, empty.scale, w, b, weights, none, none)
    low, high = -1.0, 2.0

    def histogram(batch: pa.RecordBatch) -> np.ndarray:
        raw, y = fitted.raw(_vectors(batch.column("x"))), np.asarray(batch.column("y"))
        place = np.clip(((raw - low) / (high - low) * settings.bins).astype(np.int64), 0, settings.bins - 1)
        return np.concatenate([np.bincount(place, weights=v, minlength=settings.bins) for v in (None, y, raw)])

    counts = summed(calibration, histogram)
    if counts is None:
        counts = summed(labelled, histogram)
    count, total, places = counts.reshape(3, settings.bins)
    used = count > 0
    knots, levels = isotonic(places[used] / count[used], total[used], count[used])
    return Model(mean, empty.scale, w, b, weights, knots, levels)


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    folds: int = 5, held_out: int = 0, calibration_fold: int = 4, settings: Settings = Settings(),
) -> DataFrame:
    """One row per row of `docs`: id, held_out, score. Labels of the held-out fold are not read."""
    base = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, batch.column("text")):
                found = statistics(texts)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([r.tobytes() for r in found], pa.binary())], names=["id", "x"])

    described = stored(base.mapInArrow(describe, "id long, x binary"), "quality-statistics")
    fold = fold_of(F.col("id"), folds)
    known = (
        labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("double").alias("y"))
        .where("id is not null and y is not null").where(fold != held_out).groupBy("id").agg(F.avg("y").alias("y"))
    )
    n = known.count()
    if n > settings.train_rows:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(settings.train_rows / n * (1 << 30)))
    training = stored(described.join(known, "id").select("id", "x", "y"), "quality-training")
    model = fit(training.where(fold != calibration_fold), training.where(fold == calibration_fold), settings)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = shared.value.score(_vectors(batch.column("x")))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score, pa.float64())], names=["id", "score"])

    return described.mapInArrow(apply, "id long, score double").select(
        "id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "score"
    )
