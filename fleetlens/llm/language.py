"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, every character that is no letter counts as a space, and all runs of one
to `longest` characters are hashed into `buckets`. Training adds up counts per language and bucket
on a bounded sample of labelled rows, chosen by a hash of the id. The logarithms of the smoothed
shares form a matrix (languages x buckets) that is broadcast; at most `most_languages` times
`buckets` numbers of 4 bytes. Scoring gathers a text's cells of the matrix and adds them up.

A null text and one without a letter are `und` with score 0. So is everything if nothing could be
learned. The score is the posterior probability of the language predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import mix64, slices

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """train_rows: about so many labelled rows are learned from."""

    longest: int = 3
    buckets: int = 1 << 16
    smoothing: float = 0.5
    train_rows: int = 20_000
    most_languages: int = 500


@dataclass(frozen=True)
class Model:
    languages: list[str]
    logs: np.ndarray  # languages x buckets
    priors: np.ndarray


def fold_of(id_: Column, folds: int) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % folds


_LETTER: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


class Grams:
    """Buckets of all n-grams of some texts: grams[n - 1][i] for the run that ends at character i."""

    def __init__(self, texts: list[str | None], settings: Settings):
        lead = settings.longest - 1
        lowered = [" " * lead + (t or "").lower() + " " for t in texts]
        joined = "".join(lowered).encode("utf-32-le", "replace")
        chars = np.frombuffer(joined, dtype=np.uint32)
        letter = _is_letter()[chars]
        chars = np.where(letter, chars, np.uint32(32)).astype(np.uint64)
        lengths = np.array([len(t) for t in lowered], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.letters = np.add.reduceat(letter.astype(np.int64), self.starts) if len(lengths) else np.zeros(0, np.int64)
        self.grams = []
        code = np.zeros(len(chars), dtype=np.uint64)
        for n in range(1, settings.longest + 1):
            shifted = chars if n == 1 else np.concatenate([np.full(n - 1, 32, np.uint64), chars[: 1 - n]])
            code = code * np.uint64(0x100000001B3) + shifted
            mixed = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            self.grams.append((mixed >> np.uint64(40)).astype(np.int64) & (settings.buckets - 1))


def train(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from rows with id, text and lang, none of them null."""
    n = labelled.select("id").count()
    if n > settings.train_rows:
        share = int(settings.train_rows / n * (1 << 30))
        labelled = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            for part, texts in slices(batch, batch.column("text"), 1_000_000):
                grams = Grams(texts.to_pylist(), settings)
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                for lang in set(langs):
                    inside = np.repeat(langs == lang, grams.ends - grams.starts)
                    found = sum(np.bincount(g[inside], minlength=settings.buckets) for g in grams.grams)
                    totals[lang] = totals.get(lang, 0) + found
                    rows[lang] = rows.get(lang, 0) + int((langs == lang).sum())
        for lang, found in totals.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int64()),
                 pa.array(np.append(found[at], rows[lang]), pa.int64())], names=["lang", "bucket", "times"],
            )

    def column(key: tuple, group: pa.Table) -> pa.Table:
        counts = np.zeros(settings.buckets, dtype=np.float64)
        at, times = np.asarray(group.column("bucket")), np.asarray(group.column("times"))
        counts[at[at >= 0]] = times[at >= 0]
        logs = np.log((counts + settings.smoothing) / (counts.sum() + settings.smoothing * settings.buckets))
        return pa.table({
            "lang": pa.array([key[0].as_py()]), "rows": pa.array([int(times[at < 0].sum())], pa.int64()),
            "logs": pa.array([logs.astype(np.float32).tobytes()], pa.binary()),
        })

    counted = labelled.select("text", "lang").mapInArrow(count, "lang string, bucket long, times long")
    summed = counted.groupBy("lang", "bucket").agg(F.sum("times").alias("times"))
    columns = summed.groupBy("lang").applyInArrow(column, "lang string, rows long, logs binary")
    found = sorted(columns.limit(settings.most_languages + 1).collect(), key=lambda r: r["lang"])
    if len(found) > settings.most_languages:
        raise ValueError(f"more than {settings.most_languages} languages: raise most_languages if the matrix may grow")
    rows = np.array([r["rows"] for r in found], dtype=np.float64)
    return Model(
        [r["lang"] for r in found],
        np.array([np.frombuffer(r["logs"], dtype=np.float32) for r in found]).reshape(len(found), settings.buckets),
        np.log(rows / rows.sum()) if len(found) else rows,
    )


def scores(texts: list[str | None], model: Model, settings: Settings) -> tuple[list[str], np.ndarray]:
    """The language and its posterior probability for each text."""
    grams = Grams(texts, settings)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    table = np.empty((len(model.languages), len(texts)))
    for i, logs in enumerate(model.logs):
        total = logs[grams.grams[0]].astype(np.float64)
        for g in grams.grams[1:]:
            total += logs[g]
        table[i] = model.priors[i] + np.add.reduceat(total, grams.starts)
    best = table.argmax(axis=0)
    posterior = 1.0 / np.exp(table - table.max(axis=0)).sum(axis=0)
    known = grams.letters > 0
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, posterior, 0.0)


def predict(docs: DataFrame, model: Model, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of `docs`: source (the row as it was), lang_pred, score."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("source"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, batch.column("source").field(text_col).cast(pa.string()), 1_000_000):
                found, score = scores(texts.to_pylist(), shared.value, settings)
                yield pa.RecordBatch.from_arrays(
                    [part.column("source"), pa.array(found, pa.string()), pa.array(score, pa.float64())],
                    names=["source", "lang_pred", "score"],
                )

    schema = T.StructType([rows.schema["source"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    folds: int = 4, held_out: int = 2, settings: Settings = Settings(),
) -> DataFrame:
    """Learns from the labelled rows outside the held-out fold and predicts every row.

    Adds `held_out` to what `predict` returns; a row without an id is not held out, and nothing
    is learned from it.
    """
    labelled = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
    labelled = labelled.where("text is not null and lang is not null").where(fold_of(F.col("id"), folds) != held_out)
    found = predict(docs, train(labelled, settings), text_col, settings)
    fold = F.coalesce(fold_of(F.col("source")[id_col], folds) == held_out, F.lit(False))
    return found.withColumn("held_out", fold)
