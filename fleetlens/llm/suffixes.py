"""Repeated passages by sparse suffix arrays over words.

Every run of `min_words` words has a minimiser: the leftmost of its `gram`-word runs with the
smallest hash. Only the suffixes that start at minimisers are kept, about two in 44 words.
Equal runs have the same minimiser at the same place, so a repeated passage always shares one.

Suffixes whose first `gram` words occur once are dropped. Where they occur twice, the two suffixes
are neighbours in the order of the words that follow, sorted over all partitions; the match is
extended to the right and to the left of the shared suffix. Contexts of `min_words` words suffice:
longer passages hold further minimisers, and spans that overlap are joined.

Where they occur more often, a suffix's neighbours need not be its best partners. There every run
of `min_words` words with that minimiser is hashed, and the runs are counted; what is left of a
minimiser's runs beside those that occur once is repeated.

Documents with the same words are one class and represented by one of them; they are repeated
as a whole if they have `min_words` words. Words are white-space separated, A-Z in lower case,
and compared by 32-bit hashes: a span of 50 equal hashes is a repeat, while a span's ends could
be off by a word with a chance of 2^-32.

Texts of fewer than `min_words` words, empty and null ones have no passages. Rows without an id
take no part. Rows alike in id and text count as one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Words, mix64, slices, stored


@dataclass(frozen=True)
class Settings:
    min_words: int = 50
    gram: int = 8

    @property
    def window(self) -> int:
        """Gram starts in a run of `min_words` words."""
        return self.min_words - self.gram + 1


def gram_hashes(hashes: np.ndarray, gram: int) -> np.ndarray:
    n = len(hashes) - gram + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(gram):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return mix64(total)


def minimisers(grams: np.ndarray, window: int, block: int = 20_000) -> np.ndarray:
    """Places of the leftmost smallest gram of each window, ascending."""
    return np.unique(smallest_places(grams, window, block))


def smallest_places(grams: np.ndarray, window: int, block: int = 20_000) -> np.ndarray:
    """For each window the place of its leftmost smallest gram; never descending."""
    n = len(grams) - window + 1
    found = [np.zeros(0, dtype=np.int64)]
    for at in range(0, n, block):
        view = np.lib.stride_tricks.sliding_window_view(grams[at : min(at + block, n) + window - 1], window)
        found.append(view.argmin(axis=1) + np.arange(at, at + len(view)))
    return np.concatenate(found)


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _suffixes(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, batch.column("text")):
                words = Words(texts)
                sizes, keys, places, grams = [], [], [], []
                for i in range(len(texts)):
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    sizes.append(len(own))
                    keys.append(_digest(own))
                    if len(own) < settings.min_words:
                        places.append([]), grams.append([])
                        continue
                    hashed = gram_hashes(own, settings.gram)
                    at = minimisers(hashed, settings.window)
                    places.append(at.astype(np.int32)), grams.append(hashed[at].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(places, pa.list_(pa.int32())), pa.array(grams, pa.list_(pa.int64()))],
                    names=["id", "n", "digest", "places", "grams"],
                )

    return run


_PLACES = "id long, place long, after binary, before binary, digest binary, gram long, runs array<long>"


def _contexts(settings: Settings):
    """For each of `places` the words from there on, and those up to the gram's end backwards.

    For each of `crowded`, places whose gram occurs more than twice, the hashes of the runs of
    which it is the minimiser; `place` is then the first run's.
    """
    width = settings.min_words

    def runs(own: np.ndarray, crowded: np.ndarray):
        grams = gram_hashes(own, settings.gram)
        smallest = smallest_places(grams, settings.window)
        begin, end = (np.searchsorted(smallest, crowded, side) for side in ("left", "right"))
        hashes = gram_hashes(own, width).view(np.int64)
        return begin, grams[crowded].view(np.int64), [hashes[a:b] for a, b in zip(begin, end)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, batch.column("text")):
                words = Words(texts)
                for i in range(len(texts)):
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    digest, one = part.column("digest")[i].as_py(), part.column("id")[i].as_py()
                    if _digest(own) != digest:
                        continue  # another row with this id
                    at, crowded = (np.unique(np.asarray(part.column(c)[i].values, dtype=np.int64)) for c in ("places", "crowded"))
                    small = (own >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                    padded = np.concatenate([np.zeros(width, np.uint32), small, np.zeros(width, np.uint32)])
                    reach = np.arange(width)
                    after = padded[width + at[:, None] + reach]
                    before = padded[width + at[:, None] + settings.gram - 1 - reach]
                    first, grams, hashes = runs(own, crowded) if len(crowded) else ([], [], [])
                    none, others = [None] * len(at), [None] * len(crowded)
                    digests = [digest] * (len(at) + len(crowded))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at) + len(crowded), one), pa.int64()), pa.array([*at, *first], pa.int64()),
                         pa.array([*(r.tobytes() for r in after.astype(">u4")), *others], pa.binary()),
                         pa.array([*(r.tobytes() for r in before.astype(">u4")), *others], pa.binary()),
                         pa.array(digests, pa.binary()), pa.array([*none, *grams], pa.int64()),
                         pa.array([*none, *hashes], pa.list_(pa.int64()))],
                        names=["id", "place", "after", "before", "digest", "gram", "runs"],
                    )

    return run


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading words agree; 0 is no word."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _as_words(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u4").reshape(-1, width)


_SPANS = "id long, begin long, end long, edge int, place long, after binary, before binary"


def _spans(ids, places, after, before, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted suffixes: which lie in a repeated passage, and the span that their neighbours show."""
    right = _common(after[:-1], after[1:])
    left = np.maximum(_common(before[:-1], before[1:]) - settings.gram, 0)
    good = (right >= settings.gram) & (left + right >= settings.min_words)
    right, left = np.where(good, right, 0), np.where(good, left, 0)
    zero = np.zeros(1, dtype=right.dtype)
    begin = places - np.maximum(np.append(left, zero), np.append(zero, left))
    end = places + np.maximum(np.append(right, zero), np.append(zero, right))
    found = np.append(good, False) | np.append(False, good)
    return found, begin, end


def _without_twins(ids, places, after, before) -> tuple[np.ndarray, ...]:
    """A suffix that comes twice, from a repeated row or as both ends of a partition, is no repeat of itself."""
    new = (ids[1:] != ids[:-1]) | (places[1:] != places[:-1])
    new |= (after[1:] != after[:-1]).any(axis=1) | (before[1:] != before[:-1]).any(axis=1)
    new = np.append(True, new)
    return ids[new], places[new], after[new], before[new]


def _compare(settings: Settings, edges: bool):
    """Spans from neighbours in a sorted partition; with `edges`, also its first and last suffix."""

    def row_batch(ids, begin, end, edge, places, after, before) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(begin, pa.int64()), pa.array(end, pa.int64()), pa.array(edge, pa.int32()),
             pa.array(places, pa.int64()), pa.array(after, pa.binary()), pa.array(before, pa.binary())],
            names=["id", "begin", "end", "edge", "place", "after", "before"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, places = (np.asarray(batch.column(c), dtype=np.int64) for c in ("id", "place"))
            after, before = (_as_words(batch.column(c), settings.min_words) for c in ("after", "before"))
            if last is None and edges:
                one = batch.slice(0, 1)
                yield row_batch(ids[:1], [None], [None], [1], places[:1], one.column("after").to_pylist(), one.column("before").to_pylist())
            if last is not None:
                ids, places = np.append(last[0], ids), np.append(last[1], places)
                after, before = np.concatenate([last[2], after]), np.concatenate([last[3], before])
            ids, places, after, before = _without_twins(ids, places, after, before)
            found, begin, end = _spans(ids, places, after, before, settings)
            n = int(found.sum())
            if n:
                none = [None] * n
                yield row_batch(ids[found], begin[found], end[found], np.zeros(n, np.int32), none, none, none)
            last = ids[-1:], places[-1:], after[-1:].copy(), before[-1:].copy()
        if last is not None and edges:
            yield row_batch(last[0], [None], [None], [2], last[1], [last[2].tobytes()], [last[3].tobytes()])

    return run


def _run_spans(places: DataFrame, settings: Settings) -> DataFrame:
    """Spans (class, begin, end) from the runs at crowded minimisers.

    Runs are counted with a partial aggregation, so a passage found in a third of all documents is
    one row from each task. Only runs that occur once go back to their minimiser. Its runs begin
    less than `min_words` words apart, so those that are left make one span.
    """
    own = places.select(F.xxhash64("digest").alias("class"), F.col("place").alias("first"), "gram", "runs")
    each = own.select("class", "first", "gram", F.posexplode("runs").alias("step", "run"))
    place = F.xxhash64("class", F.col("first") + F.col("step"))  # the same for repeated rows
    counted = each.groupBy("gram", "run").agg(
        (F.min(place) == F.max(place)).alias("once"), *[F.first(c).alias(c) for c in ("class", "first", "step")]
    )
    single = counted.where("once").select("class", "first", "step", F.lit(None).cast("int").alias("n"))
    whole = own.select("class", "first", F.lit(None).cast("int").alias("step"), F.size("runs").alias("n"))
    gathered = whole.unionByName(single).groupBy("class", "first").agg(F.max("n").alias("n"), F.collect_list("step").alias("single"))
    kept = F.array_except(F.sequence(F.lit(0), F.col("n") - 1), F.col("single"))
    return (
        gathered.select("class", "first", kept.alias("kept")).where(F.size("kept") > 0)
        .select("class", (F.col("first") + F.array_min("kept")).alias("begin"),
                (F.col("first") + F.array_max("kept") + settings.min_words).alias("end"))
    )


#: A gram that more than this share of all repeated ones has is hot; there are at most as many hot grams.
HOT_SHARE = 50_000


def _with_times(suffixes: DataFrame, shared: DataFrame) -> DataFrame:
    """The suffixes whose gram occurs more than once, with `times`.

    A hot gram may have a third of all suffixes. Hot ones are at most `HOT_SHARE`, as each
    holds more than a `HOT_SHARE`-th of all, so they are broadcast and their suffixes stay where they
    are; all others meet their count by a join whose largest key is small.
    """
    total = shared.agg(F.sum("times")).first()[0] or 0
    hot = shared.where(F.col("times") * HOT_SHARE > total).where("times > 1000")
    marked = suffixes.join(F.broadcast(hot), "gram", "left")
    cold = marked.where("times is null").drop("times").join(shared.join(F.broadcast(hot.select("gram")), "gram", "left_anti"), "gram")
    return marked.where("times is not null").unionByName(cold)


def _sorted_spans(contexts: DataFrame, order: str, settings: Settings, name: str) -> DataFrame:
    """Spans (id, begin, end) from the suffix order by `order`.

    The order is total, so suffixes spread over as many partitions as they need. Neighbours on two sides of a partition's border are
    compared afterwards: two suffixes from each partition.
    """
    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = contexts.repartitionByRange(parts, order, "id", "place").sortWithinPartitions(order, "id", "place")
    found = stored(ordered.mapInArrow(_compare(settings, True), _SPANS), name)
    borders = (
        found.where("edge > 0").select("id", "place", "after", "before")
        .repartition(1).sortWithinPartitions(order, "id", "place").mapInArrow(_compare(settings, False), _SPANS)
    )
    return found.where("edge = 0").unionByName(borders).select("id", "begin", "end")


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per maximal repeated passage: id, begin, end (word places, end exclusive).

    A word belongs to a passage if some run of `min_words` words around it occurs elsewhere, in
    another document or at another place of the same one.
    """
    base = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).where("id is not null")
    known = stored(
        base.mapInArrow(_suffixes(settings), "id long, n long, digest binary, places array<int>, grams array<long>")
        .where(F.col("n") >= settings.min_words), "suffix-places",
    )
    classes = known.groupBy("digest").agg(
        F.min("id").alias("id"), F.max("id").alias("other"), F.first("n").alias("n"),
        F.first("places").alias("places"), F.first("grams").alias("grams"),
    )
    classes = stored(classes, "suffix-classes")
    pairs = F.explode(F.arrays_zip("places", "grams")).alias("s")
    suffixes = classes.select("id", "digest", pairs).select("id", "digest", F.col("s.places").alias("place"), F.col("s.grams").alias("gram"))
    shared = stored(suffixes.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "suffix-grams")
    wanted = _with_times(suffixes, shared).groupBy("id", "digest").agg(
        F.collect_list(F.when(F.col("times") == 2, F.col("place"))).alias("places"),
        F.collect_list(F.when(F.col("times") > 2, F.col("place"))).alias("crowded"),
    )
    contexts = stored(
        wanted.join(base.where("text is not null"), "id").select("id", "digest", "places", "crowded", "text")
        .mapInArrow(_contexts(settings), _PLACES), "suffix-contexts",
    )
    # from here on a text is known by its digest: ids may be shared by different texts
    code = F.xxhash64("digest")
    pairs = contexts.where("after is not null").select(code.alias("id"), "place", "after", "before")
    spans = _sorted_spans(pairs, "after", settings, "suffix-after")
    runs = _run_spans(contexts.where("runs is not null").select("digest", "place", "gram", "runs"), settings)
    runs = runs.join(classes.select("digest", code.alias("class")), "class").select("digest", "begin", "end")
    # copies of a class take over its spans; a class of several ids is repeated as a whole
    per_class = spans.join(classes.where("id = other").select(code.alias("id"), "digest"), "id")
    copied = classes.where("id != other").select("digest", F.lit(0).cast("long").alias("begin"), F.col("n").alias("end"))
    by_digest = per_class.select("digest", "begin", "end").unionByName(copied).unionByName(runs).groupBy("digest").agg(
        F.collect_set(F.struct("begin", "end")).alias("spans")
    )
    merged = by_digest.select("digest", F.explode(_merged("spans")).alias("span"))
    return (
        known.select("id", "digest").distinct().join(merged, "digest")
        .select("id", F.col("span.begin").alias("begin"), F.col("span.end").alias("end"))
    )


def _merged(spans: str):
    """Spans that overlap or touch become one: begins and ends of the islands, in order."""
    ordered = F.array_sort(spans)
    state = "struct<done:array<struct<begin:bigint,end:bigint>>,begin:bigint,end:bigint>"
    empty = F.struct(
        F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("done"),
        F.lit(None).cast("long").alias("begin"), F.lit(None).cast("long").alias("end"),
    ).cast(state)

    def step(s, x):
        grown = F.struct(s["done"].alias("done"), s["begin"].alias("begin"), F.greatest(s["end"], x["end"]).alias("end"))
        opened = F.struct(
            F.when(s["begin"].isNull(), s["done"])
            .otherwise(F.concat(s["done"], F.array(F.struct(s["begin"].alias("begin"), s["end"].alias("end"))))).alias("done"),
            x["begin"].alias("begin"), x["end"].alias("end"),
        )
        return F.when(x["begin"] <= s["end"], grown).otherwise(opened)

    return F.aggregate(
        ordered, empty, step,
        lambda s: F.concat(s["done"], F.array(F.struct(s["begin"].alias("begin"), s["end"].alias("end")))),
    )


def sql(min_words: int = 50) -> str:
    """The same in DuckDB: all runs of `min_words` words, and the words under repeated ones."""
    return f"""
    with docs as (
      select doc_id, list_filter(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
      from documents where text is not null and doc_id is not null),
    runs as (
      select doc_id, s, md5(array_to_string(list_slice(w, s + 1, s + {min_words}), ' ')) as h
      from (select doc_id, w, unnest(range(len(w) - {min_words} + 1)) as s from docs where len(w) >= {min_words})),
    repeated as (select doc_id, s from (select doc_id, s, count(*) over (partition by h) as c from runs) where c > 1),
    marked as (
      select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + {min_words} then 0 else 1 end as opens from repeated),
    islands as (select doc_id, s, sum(opens) over (partition by doc_id order by s) as k from marked)
    select doc_id, min(s)::bigint as begin_word, (max(s) + {min_words})::bigint as end_word,
           (max(s) + {min_words} - min(s))::bigint as n_words
    from islands group by doc_id, k
    """
