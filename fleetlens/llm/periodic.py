"""Runs of periodic repetition, found by a sparse online dynamic program over diagonals.

Diagonal d pairs every word with the word d places before it. A run of smallest period d and
length >= 4 d is a stretch of at least 3 d consecutive matches on diagonal d. Words are read in
order; a word's earlier occurrence adds one to the match length of its diagonal, a diagonal that
is not continued ends, and one that ends long enough emits its run at once.

What keeps the diagonals sparse: for diagonals 2^k to 2^(k+1) - 1 a match counts only where the
next 3 * 2^k words match too, and only the nearest earlier occurrence of these words is followed.
Neither loses a run. A run holds 3 d >= 3 * 2^k matches in a row. If the same 3 * 2^k words also
occur nearer, they have a smaller period d'; d + d' (or 2 d - d') is no more than their
number, so by the periodicity lemma gcd(d, d') is a period of the whole stretch and d is not the
smallest one. For the same reason every emitted period is the smallest. So a word costs one step for each
power of two, also in a text that is one word repeated, and equality is exact: words and their
sequences are told apart by ranks, not by hashes.

Defined results: a null or empty text and one of spaces have no words and no runs. Repeated rows and rows
without an id are treated each for itself; extra columns are ignored. A text is one unit of work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import slices
from fleetlens.llm.rules import bound, words_of
from fleetlens.llm.sqltext import crc32

RUN = "struct<start: bigint, length: bigint, period: bigint>"


@dataclass(frozen=True)
class Settings:
    """A run has at least `min_words` words. Four periods at least are part of the method."""

    min_words: int = 6
    min_periods: int = 4


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each key, how often it occurs)."""
    _, rank, times = np.unique(keys, return_inverse=True, return_counts=True)
    return rank, times[rank]


def _paired(place: np.ndarray, rank: np.ndarray, gap: int, place2: np.ndarray, rank2: np.ndarray, row: np.ndarray):
    """(places p, keys) where p is in `place`, p + gap in `place2`, both in one row."""
    if not len(place) or not len(place2):
        return place[:0], rank[:0]
    at = np.minimum(np.searchsorted(place2, place + gap), len(place2) - 1)
    met = (place2[at] == place + gap) & (row[place] == row[place2[at]])
    return place[met], rank[met] * (int(rank2.max()) + 1) + rank2[at[met]]


def _nearest(place: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places with an earlier one of the same key, the distance to the nearest)."""
    order = np.lexsort((place, keys))
    same = keys[order[1:]] == keys[order[:-1]]
    later, lag = place[order[1:]][same], (place[order[1:]] - place[order[:-1]])[same]
    back = np.argsort(later)
    return later[back], lag[back]


def matches(codes: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, diagonals): for each scale, where the next 3 * 2^k words occurred 2^k to 2^(k+1) - 1 before.

    `codes` are ranks of words and `row` the texts they belong to, ascending. Sequences that occur
    only once in their text are left out as soon as that is known.
    """
    place = np.arange(len(codes), dtype=np.int64)
    rank, times = _grouped(row.astype(np.int64) * (int(codes.max(initial=0)) + 1) + codes)
    place, rank, k = place[times > 1], rank[times > 1], 0
    while len(place):
        double, keys = _paired(place, rank, 1 << k, place, rank, row)
        rank2, times = _grouped(keys)
        double, rank2 = double[times > 1], rank2[times > 1]
        where, lags = _nearest(*_paired(double, rank2, 2 << k, place, rank, row))
        mine = (lags >= 1 << k) & (lags < 2 << k)
        yield k, where[mine], lags[mine]
        place, rank, k = double, rank2, k + 1


def diagonals(events: list[tuple[int, int, int]], settings: Settings) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) from ascending (place, diagonal, scale) of one batch of texts.

    `active` holds the one open diagonal of each scale: where it began and how far it came.
    """
    active: dict[int, tuple[int, int, int]] = {}
    runs = []

    def end(scale: int) -> None:
        lag, first, last = active.pop(scale)
        length = last - first + (3 << scale) + lag
        if length >= max(settings.min_words, settings.min_periods * lag):
            runs.append((first - lag, length, lag))

    for place, lag, scale in events:
        if scale in active:
            if active[scale][0] == lag and active[scale][2] == place - 1:
                active[scale] = (lag, active[scale][1], place)
                continue
            end(scale)
        active[scale] = (lag, place, place)
    for scale in list(active):
        end(scale)
    return sorted((start, length, lag) for start, length, lag in runs)


def _analysed(texts: pa.Array, settings: Settings) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(number of words, runs, text without the repetitions) of each text."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, row = parts.flatten(), pc.list_parent_indices(parts)
    words = pc.greater(pc.binary_length(flat), 0)
    flat, row = flat.filter(words), row.filter(words).to_numpy()
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.searchsorted(row, np.arange(len(texts) + 1))

    events = []
    for k, where, lags in matches(codes, row):
        events += zip(where.tolist(), lags.tolist(), [k] * len(where))
    events.sort()
    found = diagonals(events, settings)

    dropped = np.zeros(len(codes) + 1, dtype=np.int64)
    for start, length, period in found:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    left = pa.ListArray.from_arrays(pa.array(np.searchsorted(kept, first), pa.int32()), flat.take(pa.array(kept)))
    owner = row[[start for start, _, _ in found]] if found else np.zeros(0, dtype=np.int64)
    runs = [{"start": start - int(first[r]), "length": length, "period": period} for (start, length, period), r in zip(found, owner)]
    cuts = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    return (
        pa.array(np.diff(first), pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(runs, kind)),
        pc.binary_join(left, pa.scalar(" ", left.type.value_type)).cast(pa.string()),
    )


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of `docs`: id, n_words, runs (by start, then period; start in words), collapsed.

    `collapsed` is the text's words without those that a run contains after its first period.
    """
    if settings.min_periods < 4:
        raise ValueError("a diagonal is followed over three matches of its length, so runs have four periods or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, batch.column("text")):
                n_words, runs, left = _analysed(texts, settings)
                yield pa.RecordBatch.from_arrays([part.column("id"), n_words, runs, left], names=["id", "n_words", "runs", "collapsed"])

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"id long, n_words long, runs array<{RUN}>, collapsed string")


def with_repeated_tail(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts of a tenth of the ids, by their CRC-32, end in a repetition of their own words.

    From word a on, word i becomes word a + (i - a) mod p. A row without an id stays as it is.
    """
    h = F.crc32(docs[id_col].cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        a = F.pmod(g, F.size(words))
        p = F.floor((F.size(words) - a) / (3 + g % 8)) + 1
        at = bound(F.struct(a.cast("int").alias("a"), p.cast("int").alias("p")), lambda s: F.transform(
            words, lambda word, i: F.when(i < s["a"], word).otherwise(F.get(words, s["a"] + (i - s["a"]) % s["p"]))
        ))
        return F.when(F.size(words) > 0, F.array_join(at, " ")).otherwise(F.lit(""))

    changed = F.when(h % 10 == 0, bound(words_of(docs[text_col]), repeated)).otherwise(docs[text_col])
    return docs.select(docs[id_col].alias(id_col), changed.alias(text_col))


def digest(found: DataFrame) -> DataFrame:
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def sql() -> str:
    """DuckDB SQL: all pairs of equal words of a text up to a quarter of its length apart."""
    return rf"""
with t as (select row_number() over () as r, doc_id, {crc32("cast(doc_id as varchar)")} as h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as old from documents),
u as (select *, len(old) as n, h // 10 as g from t),
v as (select *, case when h % 10 = 0 and n > 0 then g % n else n end as a, 1 + (n - g % n) // (3 + g % 8) as p from u),
w as (select r, n, i, case when i < coalesce(a, n) then old[i + 1] else old[a + (i - a) % p + 1] end as word from (select *, unnest(range(n)) as i from v)),
m as (select a.r, b.i, b.i - a.i as lag from w a join w b on a.r = b.r and a.word = b.word and b.i > a.i and 4 * (b.i - a.i) <= a.n),
s as (select r, lag, min(i) - lag as start, count(*) + lag as length from (select *, i - row_number() over (partition by r, lag order by i) as island from m) group by r, lag, island),
long as (select * from s where length >= greatest(6, 4 * lag)),
runs as (select r, start, length, lag as period from long a where not exists (
  select 1 from long b where b.r = a.r and b.lag < a.lag and b.start <= a.start and b.start + b.length >= a.start + a.length)),
gone as (select distinct r, unnest(range(start + period, start + length)) as i from runs),
kept as (select r, string_agg(word, ' ' order by i) as words from w anti join gone using (r, i) group by r),
told as (select r, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as list,
  first(struct_pack(start, length, period) order by length desc, start, period) as best from runs group by r)
select doc_id, coalesce(n_runs, 0) as n_runs, best.start, best.length, best.period, 1000 * best.length // best.period as exponent_milli,
  sha256(coalesce(list, '')) as runs_sha256, sha256(coalesce(words, '')) as collapsed_sha256
from t left join told using (r) left join kept using (r)"""
