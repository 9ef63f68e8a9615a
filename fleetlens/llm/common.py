"""What several operators share: the shared folder, stored intermediate tables, components, word hashing."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ID_LAST = 2**63 - 1

_LOCAL_FOLDER: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver see: `spark.checkpoint.dir` of the session.

    Only a session on one machine may do without the setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append("file://" + tempfile.mkdtemp(prefix="llm-"))
    return _LOCAL_FOLDER[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes an intermediate table to the shared folder and reads it back.

    This cuts the lineage: what is read later never depends on an executor that is gone, and
    branches that read the table do not compute it again.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_order(column: str) -> Column:
    """An id as a sort key: rows without one come last."""
    return F.coalesce(F.col(column).cast("long"), F.lit(ID_LAST))


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) of each node of an undirected graph, `root` being its component's smallest node.

    `edges` has the long columns `a` and `b`. Large-star and small-star steps alternate until
    the edges stay as they are: every node then points at its root. Each step takes a minimum
    for each node (combined before the shuffle) and joins it back, so a node with very many
    neighbours is not gathered anywhere. Only a count and a checksum come to the driver.
    """
    current = stored(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{name}-edges",
    )
    mark = None
    for _ in range(most_rounds):
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.where("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        current = stored(small, f"{name}-star")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


# --- word hashing of whole Arrow columns ------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 1024)
        factors = np.full(size, _BASE, dtype=np.uint64)
        factors[0] = 1
        _POWERS = np.cumprod(factors, dtype=np.uint64)
    return _POWERS


def lower_table() -> np.ndarray:
    """Byte to byte, A-Z to a-z. Bytes of other letters stay, so it is safe on UTF-8."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def byte_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the rows' offsets in them. Nulls are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


ASCII_SPACE = np.zeros(256, dtype=bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True

SLICE_BYTES = 2_000_000


def slices(batch: pa.RecordBatch, texts: pa.Array, most: int = SLICE_BYTES):
    """(rows of the batch, their texts) in runs of about `most` bytes of text, one row at least."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < len(texts):
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
        yield batch.slice(at, end - at), texts.slice(at, end - at)
        at = end


class Words:
    """The words of a batch of texts: runs of bytes that are not in the table `gaps`.

    ASCII letters are taken in lower case if `lower`. hashes: 64-bit hash of each word; starts,
    ends: its bytes in `data`; first: for each row the index of its first word, with the total
    at the end.
    """

    def __init__(self, column: pa.Array, gaps: np.ndarray = ASCII_SPACE, lower: bool = True):
        data, offsets = byte_spans(column)
        if lower:
            data = lower_table()[data]
        inside = ~gaps[data]
        # a word starts after a gap or where a row starts, and ends before a gap or a row
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(len(data), dtype=bool)
        after = np.empty(len(data), dtype=bool)
        if len(data):
            before[0] = after[-1] = False
            before[1:], after[:-1] = inside[:-1], inside[1:]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.data, self.starts, self.ends = data, starts, ends
        self.first = np.searchsorted(starts, offsets)
        self.hashes = _word_hashes(data, starts, ends)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 200_000) -> np.ndarray:
    """In blocks of words, which bounds the memory for very long texts."""
    parts = [_hash_block(data, starts[i : i + block], ends[i : i + block]) for i in range(0, len(starts), block)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def _hash_block(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    powers = _powers(int(lengths.max()))
    until = np.cumsum(lengths)
    begin = until - lengths
    place = np.arange(until[-1]) - np.repeat(begin, lengths)
    values = _BYTE_VALUE[data[np.repeat(starts, lengths) + place]] * powers[place]
    return mix64(np.add.reduceat(values, begin) + lengths.astype(np.uint64))
