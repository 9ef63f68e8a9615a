"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Vectors are padded with zeros to `bits` dimensions or more, rotated by a random orthogonal matrix,
and each coordinate keeps its sign: a code of one bit per dimension, packed, with two scalars,
the vector's length and the inner product f of its direction with its code. For a query q the
inner product with a vector o is estimated as |o| <code, q> / f, and the error is, with high
probability, at most |o| |q| sqrt((1 - f^2) / f^2) e / sqrt(D - 1) with codes of D bits. The k
best estimates are scored exactly first; the k-th of these scores is a bound, and only vectors whose
upper bound reaches it are scored on the original numbers.

Queries and candidates meet block by block: a block of candidates holds about `block` rows, by a
hash of the id, one of queries about `query_block`. Every candidate is indexed. Vectors that are
null, zero or hold a null or non-finite component take no part, as queries or candidates, nor
do rows without an id. Only vectors of the same number of dimensions are compared. A row is no
candidate of its own; rows that share an id are rows like any other, so each query among them has its own k
neighbours, and the others are candidates. Ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import stored


@dataclass(frozen=True)
class Settings:
    """k neighbours; bits: least length of a code; error: width of the bound, in standard deviations;
    sizes of blocks; chunk: candidates that are estimated at a time."""

    k: int = 20
    bits: int = 512
    error: float = 4.0
    block: int = 8192
    query_block: int = 1024
    chunk: int = 8192
    seed: int = 11


@cache
def rotation(d: int, settings: Settings) -> np.ndarray:
    """The first d rows of a random rotation of the padded space: all that vectors padded with zeros meet."""
    q, r = np.linalg.qr(np.random.default_rng(settings.seed + d).normal(size=(max(d, settings.bits), d)))
    return np.ascontiguousarray((q * np.sign(np.diag(r))).T)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, length, inner product of direction and code) of each vector."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    turned = (vectors / lengths[:, None]) @ turn
    return np.packbits(turned > 0, axis=1), lengths, np.abs(turned).sum(axis=1) / math.sqrt(turn.shape[1])


def exact(queries: np.ndarray, vectors: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, added up from the first component to the last."""
    left, right = np.ascontiguousarray(queries.T), np.ascontiguousarray(vectors.T)
    total = np.zeros(len(rows))
    for x, y in zip(left, right):
        total += x[rows] * y[columns]
    return total


class Best:
    """The k best (score, smaller id first) seen so far for each query."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        order = np.lexsort((ids, -scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        first = np.r_[True, rows[1:] != rows[:-1]]
        place = np.arange(len(rows)) - np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))
        keep = place < self.k
        touched, index = np.unique(rows[keep], return_inverse=True)
        score = np.full((len(touched), self.k), -np.inf)
        id_ = np.full((len(touched), self.k), np.iinfo(np.int64).max)
        score[index, place[keep]], id_[index, place[keep]] = scores[keep], ids[keep]
        both, names = np.hstack([self.score[touched], score]), np.hstack([self.id[touched], id_])
        order = np.lexsort((names, -both), axis=1)[:, : self.k]
        self.score[touched] = np.take_along_axis(both, order, axis=1)
        self.id[touched] = np.take_along_axis(names, order, axis=1)


def search_block(query_rows, queries, ids, own_rows, vectors, codes, lengths, factors, settings: Settings) -> Best:
    """The best candidates of one block for each query of one block; a row's number tells it from its namesakes."""
    turn = rotation(queries.shape[1], settings)
    width = turn.shape[1]
    turned = (queries @ turn).astype(np.float32)
    size = np.sqrt((queries * queries).sum(axis=1))
    best = Best(len(queries), settings.k)
    spread = settings.error / math.sqrt(max(1, width - 1))
    for at in range(0, len(ids), settings.chunk):
        part = slice(at, at + settings.chunk)
        own, numbers, length = ids[part], vectors[part], lengths[part]
        signs = np.unpackbits(codes[part], axis=1, count=width).astype(np.float32) * 2 - 1
        estimate = (turned @ signs.T) * (length / factors[part] / math.sqrt(width)).astype(np.float32)
        estimate[query_rows[:, None] == own_rows[part]] = -np.inf
        # with a margin for rounding in single precision
        slack = length * (np.sqrt(np.maximum(1 - factors[part] ** 2, 0)) / factors[part] * spread + 1e-5)
        slack = slack.astype(np.float32)
        rows, columns = [], []
        for i, guess in enumerate(estimate):
            bound = best.score[i, -1]
            if len(guess) > settings.k:
                top = np.argpartition(guess, -settings.k)[-settings.k :]
                if np.isfinite(guess[top]).all():
                    # a little less than exact, as sums in another order differ in the last digits
                    bound = max(bound, (numbers[top] @ queries[i]).min() - 1e-12 * size[i] * length[top].max())
            reach = np.flatnonzero((guess + np.float32(size[i]) * slack >= np.float32(bound)) & (guess > -np.inf))
            rough = numbers[reach] @ queries[i]
            margin = 1e-12 * size[i] * length[reach]
            if len(reach) > settings.k:
                bound = max(bound, np.partition(rough - margin, -settings.k)[-settings.k])
            reach = reach[rough + margin >= bound]
            rows.append(np.full(len(reach), i)), columns.append(reach)
        r, c = np.concatenate(rows), np.concatenate(columns)
        for a in range(0, len(r), 200_000):
            pairs = r[a : a + 200_000], c[a : a + 200_000]
            best.add(pairs[0], own[pairs[1]], exact(queries, numbers, *pairs))
    return best


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def nearest(
    vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """One row per query and neighbour: query_id, rank, vec_id, score.

    `is_query` is a condition on the column `id`. The exchange carries each candidate once per
    block of queries and each query once per block of candidates.
    """
    valid = (
        vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("v"))
        .where("id is not null and v is not null and size(v) > 0")
        .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        .where(F.exists("v", lambda x: x != 0)).withColumn("d", F.size("v"))
    )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("d"))
            for d in np.unique(dims):
                rows = batch.filter(pa.array(dims == d))
                codes, lengths, factors = encode(_matrix(rows.column("v")), rotation(int(d), settings))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(lengths), pa.array(factors)],
                    names=["id", "v", "d", "code", "length", "factor"],
                )

    coded = valid.mapInArrow(index, "id long, v array<double>, d int, code binary, length double, factor double")
    # written once, so that a row keeps its number
    indexed = stored(coded.withColumn("row", F.monotonically_increasing_id()), "one-bit-codes")
    counts = indexed.agg(F.count(F.lit(1)), F.sum(F.when(is_query, 1).otherwise(0))).first()
    blocks = max(1, math.ceil((counts[0] or 0) / settings.block))
    query_blocks = max(1, math.ceil((counts[1] or 0) / settings.query_block))

    def block_of(n: int):
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = indexed.withColumn("block", block_of(blocks)).withColumn("query_block", all_of(query_blocks))
    queries = (
        indexed.where(is_query).select("id", "row", "v", "d").withColumn("query_block", block_of(query_blocks))
        .withColumn("block", all_of(blocks))
    )
    keys = ["d", "block", "query_block"]

    def search(_key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "row", "vec_id")} | {"score": pa.array([], pa.float64())})
        codes = np.frombuffer(b"".join(right.column("code").to_pylist()), dtype=np.uint8).reshape(right.num_rows, -1)
        query_ids, query_rows = np.asarray(left.column("id")), np.asarray(left.column("row"))
        best = search_block(
            query_rows, _matrix(left.column("v")), np.asarray(right.column("id")), np.asarray(right.column("row")), _matrix(right.column("v")),
            codes, np.asarray(right.column("length")), np.asarray(right.column("factor")), settings,
        )
        found = np.isfinite(best.score)
        times = found.sum(axis=1)
        return pa.table({
            "query_id": pa.array(np.repeat(query_ids, times)), "row": pa.array(np.repeat(query_rows, times)),
            "vec_id": pa.array(best.id[found]), "score": pa.array(best.score[found]),
        })

    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(search, "query_id long, row long, vec_id long, score double")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.k).select("query_id", "rank", "vec_id", "score")


def sql(k: int = 20, every: int = 20) -> str:
    """Brute force in DuckDB, components added up in order."""
    return f"""
    with valid as materialized (
      select row_number() over () as own, vec_id, embedding::double[] as v from embeddings
      where vec_id is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    scored as (
      select q.own, q.vec_id as query_id, c.vec_id, list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b) as score
      from valid q join valid c on q.own <> c.own and len(q.v) = len(c.v) where q.vec_id % {every} = 0)
    select query_id, rank::int as rank, vec_id, score
    from (select *, row_number() over (partition by own order by score desc, vec_id) as rank from scored) where rank <= {k}
    """
