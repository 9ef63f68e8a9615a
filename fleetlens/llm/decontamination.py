"""Benchmark decontamination by Wu-Manber search over words.

The strings searched for are the windows of `width` consecutive words of benchmark items (an
item of fewer words is one window). Words are the symbols. For all windows of one length a
block shift table says, for the pair of words that ends at the current place, how far the
search may move because no window can end before; a pair that ends some window selects, by the
window's last and first words, a bucket of windows, which are compared word by word.

A document word inside any occurrence is hit. A null or wordless text has no words and no
hits. Items without an id or without words are not searched for; repeated items count once.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = 10
#: Bytes of item text that are searched for in one pass, and so the bound of what is broadcast.
BLOCK_BYTES = 4_000_000

#: Bytes that are not part of a word become spaces, A-Z become a-z. Every byte of a
#: character beyond ASCII is part of a word.
_KEPT = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(b + 32 if 0x41 <= b < 0x5B else b if b in _KEPT else 0x20 for b in range(256))

RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField(
        "spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    ),
    T.StructField("items", T.ArrayType(T.LongType())),
]
_ARROW = pa.schema([
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.int64())),
])


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Search:
    """Windows of one length, ready to be searched for."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], set[int]]):
        self.length, self.block = length, min(2, length)
        self.free = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[tuple[list[bytes], set[int]]]]] = {}
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                key = b" ".join(window[end - self.block : end])
                left = length - end
                if left < self.shift.get(key, self.free):
                    self.shift[key] = left
            bucket = self.buckets.setdefault(b" ".join(window[-self.block :]), {})
            bucket.setdefault(window[0], []).append((list(window), items))

    def run(self, words: list[bytes], spans: list[list[int]], found: set[int]) -> None:
        length, single = self.length, self.block == 1
        shift, free, buckets = self.shift.get, self.free, self.buckets
        end, last = length, len(words)
        while end <= last:
            key = words[end - 1] if single else words[end - 2] + b" " + words[end - 1]
            step = shift(key, free)
            if step:
                end += step
                continue
            begin = end - length
            for window, items in buckets[key].get(words[begin], ()):
                if words[begin:end] == window:
                    spans.append([begin, end])
                    found |= items
            end += 1


class Searches:
    """All windows of a block of items, grouped by length."""

    def __init__(self, items: list[tuple[int, bytes]], width: int):
        by_length: dict[int, dict[tuple[bytes, ...], set[int]]] = {}
        for item, text in items:
            words = words_of(text)
            length = min(width, len(words))
            if length:
                windows = by_length.setdefault(length, {})
                for i in range(len(words) - length + 1):
                    windows.setdefault(tuple(words[i : i + length]), set()).add(item)
        self.all = [Search(length, windows) for length, windows in sorted(by_length.items())]

    def run(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], list[int]]:
        words, spans, found = words_of(text), [], set()
        for search in self.all:
            search.run(words, spans, found)
        return len(words), merged(spans), sorted(found)


def merged(spans: list) -> list[tuple[int, int]]:
    """Spans that overlap or touch become one."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [tuple(x) for x in out]


#: By the block's name, which no other call has: workers live on after a call.
_READY: dict[str, Searches] = {}


def _ready(block: Broadcast, width: int) -> Searches:
    if block.value["block"] not in _READY:
        _READY.clear()
        _READY[block.value["block"]] = Searches(block.value["items"], width)
    return _READY[block.value["block"]]


def _pass(rows: DataFrame, text_col: str, block: Broadcast, width: int) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _ready(block, width)
        for batch in batches:
            source = batch.column("source")
            texts = source.field(text_col).cast(pa.binary()) if isinstance(source, pa.StructArray) else source
            results = [searches.run(text.as_py()) for text in texts]
            columns = list(zip(*results)) or [[], [], []]
            extra = [pa.array(list(c), type=f.type) for c, f in zip(columns, _ARROW)]
            yield pa.RecordBatch.from_arrays([source, *extra], names=["source", *_ARROW.names])

    return rows.mapInArrow(search, T.StructType([rows.schema["source"], *RESULT]))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of `docs`: source (the row as it was), n_words, spans of hit words, items.

    The items are searched for in blocks of about `block_bytes`, so what is broadcast has a
    bound however many there are; one block is one pass over the documents, without a shuffle.
    """
    spark = docs.sparkSession
    chosen = items.select(
        items[item_id].cast("long").alias("item"), items[item_text].cast("binary").alias("words")
    ).where("item is not null and words is not null").distinct()
    total = chosen.agg(F.sum(F.octet_length("words") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    rows = docs.select(F.struct(*[docs[c].cast("string").alias(c) if c == text_col else docs[c] for c in docs.columns]).alias("source"))
    passes = []
    for k in range(blocks):
        mine = chosen.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == k).collect()
        value = {"block": uuid.uuid4().hex, "items": sorted((r["item"], bytes(r["words"])) for r in mine)}
        passes.append(_pass(rows, text_col, spark.sparkContext.broadcast(value), width))
    if len(passes) == 1:
        return passes[0]
    # several blocks: what each finds is put together per document; rows alike are one
    together = passes[0]
    for more in passes[1:]:
        together = together.unionByName(more)
    key = F.md5(F.to_json("source", {"ignoreNullFields": "false"}))
    narrow = together.select(key.alias("key"), "n_words", "spans", "items").groupBy("key").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return (
        rows.withColumn("key", key).join(narrow, "key")
        .select("source", "n_words", merge_spans(F.col("spans")).alias("spans"), "items")
    )


def merge_spans(spans):
    """The same as `merged`, as a column."""
    kind = "array<struct<begin:bigint,end:bigint>>"

    def step(done, span):
        last = F.element_at(done, -1)
        grown = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"))
        return (
            F.when((F.size(done) > 0) & (span["begin"] <= F.try_element_at(done, F.lit(-1))["end"]),
                   F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown)))
            .otherwise(F.concat(done, F.array(span)))
        )

    last_safe = F.array_sort(spans)
    return F.aggregate(last_safe, F.array().cast(kind), step)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query from the operator's result."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    named = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        F.col("source.doc_id").alias("doc_id"), "n_words", hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(named, 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def sql(width: int = WIDTH) -> str:
    """The same in DuckDB: windows of documents joined to windows of items."""
    words = (
        "regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    return f"""
    with items as (select item_id, {words.format(t='text')} as w from benchmark where item_id is not null and text is not null),
    sized as (select item_id, w, least({width}, len(w)) as n from items where len(w) > 0),
    windows as (
      select distinct item_id, n, list_slice(w, s + 1, s + n) as x
      from (select item_id, w, n, unnest(range(len(w) - n + 1)) as s from sized)),
    docs as (select doc_id, coalesce({words.format(t='text')}, []) as w from documents),
    places as (
      select doc_id, n, s, list_slice(w, s + 1, s + n) as x
      from (select doc_id, w, n, unnest(range(len(w) - n + 1)) as s
            from docs, (select distinct n from windows) where len(w) >= n)),
    found as (select doc_id, item_id, p.n, s from places p join windows i on p.n = i.n and p.x = i.x),
    hit as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(s, s + n)) as k from found) group by doc_id),
    named as (
      select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as items
      from (select distinct doc_id, item_id::varchar as i from found) group by doc_id)
    select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
           sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from docs d left join hit using (doc_id) left join named using (doc_id)
    """
