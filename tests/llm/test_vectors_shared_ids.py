"""Rows that share an id are queries and candidates of their own."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from fleetlens.llm import vectors


def product(v, w) -> float:
    """From the first component to the last, without the compensation of the built-in sum."""
    return reduce(lambda total, pair: total + pair[0] * pair[1], zip(v, w), 0.0)


def test_repeated_ids(spark):
    r = np.random.default_rng(5)
    rows = [(i % 70, r.normal(size=8).tolist()) for i in range(200)]
    rows += [(40, rows[40][1]), (40, rows[40][1]), (3, rows[0][1])]  # also whole rows that repeat
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    settings = vectors.Settings(k=6, block=50, query_block=3, chunk=16)
    found = vectors.nearest(df, F.col("id") % 20 == 0, settings=settings).collect()
    expected = []
    for at, (q, v) in enumerate(rows):
        if q % 20 == 0:
            scored = sorted((-product(v, w), i) for k, (i, w) in enumerate(rows) if k != at)[:6]
            expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    assert sorted((x.query_id, x.rank, x.vec_id, x.score) for x in found) == sorted(expected)
