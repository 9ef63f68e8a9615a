"""Quality scores next to statistics in plain Python, a dense least-squares fit and plain pooling."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import quality

FOLDER = "/root/testdata/sf0.001"
GAPS = b" \t\n\v\f\r"


def plain_statistics(text: str | None) -> list[float]:
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * quality.N_STATISTICS

    def kind(byte: int) -> int:
        c = chr(byte)
        if byte > 127 or (byte in GAPS and c not in " \t\n\r"):
            return 0
        if c.isalpha():
            return 1 if c.islower() else 2
        if c.isdigit():
            return 3
        return 4 if c in ",." else 5 if c in "!?" else 7 if c in " \t\n\r" else 6 if 32 < byte < 127 else 0

    n, lines = len(words), raw.count(b"\n") + 1
    kinds = Counter(kind(b) for b in raw)
    lower = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    used = Counter(lower)
    pairs = Counter(zip(lower, lower[1:])) if n > 1 else Counter(lower)
    return [
        math.log1p(n), math.log1p(len(raw)), mean, math.sqrt(sum((x - mean) ** 2 for x in lengths) / n),
        *[kinds[k] / len(raw) for k in range(1, 7)], math.log1p(lines), math.log1p(n / lines),
        len(used) / n, max(used.values()) / n, sum(c for c in pairs.values() if c > 1) / sum(pairs.values()),
        sum(a == b for a, b in zip(lower, lower[1:])) / n,
        -sum(c / n * math.log(c / n) for c in used.values()) / max(math.log(n), 1.0),
        sum(kind(w[0]) == 2 for w in words) / n, sum(kind(w[-1]) == 6 for w in words) / n,
        sum(kind(w[-1]) == 5 for w in words) / n, sum(x == 1 for x in lengths) / n, sum(kind(w[-1]) == 4 for w in words) / n,
    ]


def pooled(points: list[tuple[float, float, int]]) -> list[tuple[float, float]]:
    """(place, label, weight) points in order: neighbours that do not ascend are merged until all do."""
    groups = [[p] for p in points]

    def level(group, k):
        return sum(p[k] * p[2] for p in group) / sum(p[2] for p in group)

    i = 0
    while i < len(groups) - 1:
        if level(groups[i], 1) >= level(groups[i + 1], 1) - 1e-15:
            groups[i : i + 2] = [groups[i] + groups[i + 1]]
            i = max(0, i - 1)
        else:
            i += 1
    return [(level(g, 0), level(g, 1)) for g in groups]


def test_statistics():
    texts = ["", None, " \n", "One two, two!\nThree", "a", "Ça été 12 12 12?\v\fx  y\n\n", "A b A b a B", "<#> {x} ~ \x7f \x01"]
    found = quality.statistics(pa.array(texts, pa.string()))
    np.testing.assert_allclose(found, [plain_statistics(t) for t in texts], atol=1e-12)


def test_scores_equal_a_dense_fit(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    settings = quality.Settings(features=48)
    scores = {r.id: r.score for r in quality.score_quality(docs, labels, settings=settings).collect()}

    x = {r.doc_id: plain_statistics(r.text) for r in docs.collect()}
    y = {r.doc_id: float(r.quality) for r in labels.collect() if r.quality is not None and r.doc_id in x}
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i in x}
    fit, held = [i for i in y if fold[i] not in (0, 4)], [i for i in y if fold[i] == 4]
    assert fit and held
    table = np.array([x[i] for i in fit])
    mean, scale = table.mean(axis=0), table.std(axis=0)
    scale[scale <= 1e-9] = 1.0
    random = np.random.default_rng(settings.seed)
    w = random.normal(size=(quality.N_STATISTICS, settings.features)) / settings.width
    b = random.uniform(0, 2 * np.pi, settings.features)

    def mapped(ids):
        z = np.clip((np.array([x[i] for i in ids]) - mean) / scale, -8, 8)
        return np.hstack([np.sqrt(2 / settings.features) * np.cos(z @ w + b), np.ones((len(ids), 1))])

    ridge = np.diag([math.sqrt(settings.ridge)] * settings.features + [1e-3])
    weights = np.linalg.lstsq(
        np.vstack([mapped(fit), ridge]), np.concatenate([[y[i] for i in fit], np.zeros(len(ridge))]), rcond=None
    )[0]
    raw = dict(zip(x, mapped(list(x)) @ weights))
    cells: dict[int, list[int]] = {}
    for i in held:
        cells.setdefault(min(max(int((raw[i] + 1) / 3 * settings.bins), 0), settings.bins - 1), []).append(i)
    points = [(np.mean([raw[i] for i in own]), np.mean([y[i] for i in own]), len(own)) for _, own in sorted(cells.items())]
    knots = pooled(points)
    expected = {i: float(np.interp(raw[i], [k for k, _ in knots], [v for _, v in knots])) for i in x}
    assert scores == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("fan_in", [2, 3, 16])
def test_sums_over_many_partitions(spark, fan_in):
    def partial(batch):
        v = np.asarray(batch.column("id"), dtype=np.float64)
        return np.array([len(v), v.sum(), (v * v).sum()])

    df = spark.range(0, 1000, 1, 11)
    total = np.arange(1000.0)
    assert quality.summed(df, partial, fan_in).tolist() == [1000, total.sum(), (total * total).sum()]
    assert quality.summed(df.where(F.col("id") < 0), partial, fan_in) is None
