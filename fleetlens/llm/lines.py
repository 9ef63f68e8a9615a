"""Line dedup over content-defined chunks of lines. DataFrame functions only.

A rolling hash over the hashes of the last `window` lines ends a chunk wherever it is 0 modulo
`divisor`. Boundaries depend on nearby lines alone, so a line put in or taken out moves the
chunks around it and no others. Chunks of `min_lines` lines or more that occur in several
places are removed everywhere but at their first place. Equal hashes only nominate a chunk:
places are grouped by the chunk's own bytes.

Every row of the input is one document. Null text stays null and has no lines; an empty text
has one empty line. The first place is the one with the smallest (id, chunk number), rows
without an id last; among different texts of one id, or without one, the smallest digest goes first. Rows alike in id and text count as one document, so a repeated row keeps
what its twin keeps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import id_order, stored

HEX_DIGITS = 7  # 28 bits of a line's MD5
MULTIPLIER = 31


def _line_value(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, HEX_DIGITS), 16, 10).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once: a column used inside a lambda would be
    computed again for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def chunks_of(text: Column, window: int, divisor: int) -> Column:
    """The chunks of a text: an array of arrays of lines, null for null."""

    def ends_after(values: Column, i: Column, last: Column) -> Column:
        """Line i ends a chunk. Lines before the first one add nothing."""
        total = F.get(values, i)
        for back in range(1, window):
            total = total + F.coalesce(F.get(values, i - back), F.lit(0)) * F.lit(MULTIPLIER**back)
        return (i == last) | (total % divisor == 0)

    def cut(lines: Column, ends: Column) -> Column:
        def chunk(end: Column, k: Column) -> Column:
            begin = F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1) + 1)
            return F.slice(lines, begin + 1, end - begin + 1)

        return F.transform(ends, chunk)

    def ends_of(values: Column) -> Column:
        marked = F.transform(values, lambda v, i: F.when(ends_after(values, i, F.size(values) - 1), i))
        return F.filter(marked, lambda e: e.isNotNull())

    return _let(
        F.split(text, "\n", -1),
        lambda lines: _let(F.transform(lines, _line_value), lambda values: _let(ends_of(values), lambda ends: cut(lines, ends))),
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 2,
    divisor: int = 3,
    min_lines: int = 2,
) -> DataFrame:
    """The documents without repeated multi-line chunks.

    Returns one row per row of `docs`: source (the whole row as it was), id, text, n_lines,
    n_chunks, n_removed (lines).

    Plan: chunk hashes are counted with a partial aggregation, so that a chunk found in a third
    of all documents is one row from each task; only chunks with a repeated hash are moved with
    their bytes; the text itself is moved once, to meet what is to be removed.
    """
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("source"))
    own_id, own_text = F.col("source")[id_col].cast("long"), F.col("source")[text_col].cast("string")
    rows = whole.withColumn("key", F.md5(F.concat_ws("\n", F.coalesce(own_id.cast("string"), F.lit("-")), own_text)))

    def places(base: DataFrame) -> DataFrame:
        chunked = base.select(
            own_id.alias("id"), "key", F.posexplode(chunks_of(own_text, window, divisor)).alias("number", "lines")
        )
        chunked = chunked.where(F.size("lines") >= min_lines)
        bytes_ = F.array_join("lines", "\n")
        return chunked.select("id", "key", "number", F.size("lines").alias("n"), bytes_.alias("bytes"))

    found = places(rows)
    hashed = found.withColumn("hash", F.xxhash64("bytes"))
    repeated = hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("hash")
    nominated = stored(hashed.join(repeated, "hash", "left_semi"), "line-chunks")

    place = nominated.withColumn("order", id_order("id"))
    # the smallest chunk number of each document, then the first document: rows may share an id or have none
    smallest = place.groupBy("bytes", "order", "key").agg(F.min("number").alias("number"))
    first = smallest.groupBy("bytes").agg(F.min(F.struct("order", "key", "number")).alias("first"))
    later = (
        place.join(first, "bytes")
        .where((F.col("key") != F.col("first.key")) | (F.col("number") != F.col("first.number")))
        .select("key", "number", "n")
    )
    removed = (
        later.distinct().groupBy("key")
        .agg(F.collect_set("number").alias("gone"), F.sum("n").cast("long").alias("n_removed"))
    )
    joined = rows.join(removed, "key", "left")

    def result(chunks: Column) -> Column:
        kept = F.filter(chunks, lambda c, i: ~F.array_contains(F.col("gone"), i))
        return F.struct(
            F.when(F.col("gone").isNull(), own_text).otherwise(F.array_join(F.flatten(kept), "\n")).alias("text"),
            F.aggregate(chunks, F.lit(0), lambda n, c: n + F.size(c)).alias("lines"), F.size(chunks).alias("chunks"),
        )

    done = joined.select("source", own_id.alias("id"), "n_removed", _let(chunks_of(own_text, window, divisor), result).alias("r"))
    return done.select(
        "source", "id", F.when(F.col("source")[text_col].isNotNull(), F.col("r.text")).alias("text"),
        *[F.coalesce(F.when(F.col("source")[text_col].isNotNull(), F.col(f"r.{c}")), F.lit(0)).cast("long").alias(f"n_{c}")
          for c in ("lines", "chunks")],
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
    )


def dedup_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without any run of two or more lines that came before.

    A run came before exactly if each of its pairs of neighbouring lines did, so a line goes if
    it is in a pair that is not the first of its kind by (id, line number). A pair that overlaps
    the first of its kind (three equal lines) takes only its second line along, so that a line
    repeated many times in one document leaves two.

    Returns one row per row of `docs`: source, id, text, n_lines, n_removed (lines).

    Plan: the first place of each pair is a minimum, combined before the shuffle, so a pair found
    in a third of all documents is one row from each task. What goes is what is left of a document
    beside its first places; repeats are never moved. Pairs are compared by their MD5.
    """
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("source"))
    own_id, own_text = F.col("source")[id_col].cast("long"), F.col("source")[text_col].cast("string")
    name = F.md5(F.concat_ws("\n", F.coalesce(own_id.cast("string"), F.lit("-")), own_text))
    rows = whole.withColumn("key", F.unhex(name))

    def pairs(lines: Column) -> Column:
        joined = F.transform(lines, lambda line, i: F.concat(line, F.lit("\n"), F.get(lines, i + 1)))
        return F.transform(F.slice(joined, 1, F.size(joined) - 1), lambda pair: F.unhex(F.md5(pair)))

    found = rows.where(own_text.contains("\n")).select(
        own_id.alias("id"), "key", F.posexplode(_let(F.split(own_text, "\n", -1), pairs)).alias("number", "pair")
    )
    first = found.groupBy("pair").agg(F.min(F.struct(id_order("id").alias("order"), "key", "number")).alias("first"))
    firsts = first.select("first.key", "first.number").groupBy("key").agg(F.collect_list("number").alias("firsts"))
    joined = rows.join(firsts, "key", "left")

    def kept_of(lines: Column, gone: Column) -> Column:
        """Numbers of the lines that stay. Set functions, so linear in the lines."""
        after = F.transform(gone, lambda i: i + 1)
        equal = F.filter(gone, lambda i: (F.get(lines, i - 1) == F.get(lines, i)) & (F.get(lines, i) == F.get(lines, i + 1)))
        overlapping = F.array_except(equal, after)
        lost = F.array_union(after, F.array_except(gone, overlapping))
        return F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost)

    def result(lines: Column) -> Column:
        nothing = F.array().cast("array<int>")
        numbers = F.when(F.size(lines) > 1, F.sequence(F.lit(0), F.size(lines) - 2)).otherwise(nothing)
        gone = F.array_except(numbers, F.coalesce(F.col("firsts"), nothing))
        return _let(gone, lambda g: _let(kept_of(lines, g), lambda kept: F.struct(
            F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n").alias("text"),
            F.size(lines).alias("lines"), (F.size(lines) - F.size(kept)).alias("removed"),
        )))

    done = joined.select("source", own_id.alias("id"), _let(F.split(own_text, "\n", -1), result).alias("r"))
    there = F.col("source")[text_col].isNotNull()
    return done.select(
        "source", "id", F.when(there, F.col("r.text")).alias("text"),
        *[F.coalesce(F.when(there, F.col(f"r.{c}")), F.lit(0)).cast("long").alias(f"n_{c}") for c in ("lines", "removed")],
    )


def sql(window: int = 2, divisor: int = 3, min_lines: int = 2) -> str:
    """The same for `documents` in DuckDB, by list functions and windows (ids without repeats)."""
    terms = " + ".join(f"coalesce(lag(v, {b}) over w, 0) * {MULTIPLIER**b}" if b else "v" for b in range(window))
    return f"""
    with lines as (
      select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i
      from documents where text is not null),
    valued as (select *, ('0x' || substr(md5(line), 1, {HEX_DIGITS}))::bigint as v from lines),
    marked as (
      select *, case when ({terms}) % {divisor} = 0 then 1 else 0 end as ends
      from valued window w as (partition by doc_id order by i)),
    numbered as (
      select *, coalesce(sum(ends) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as k
      from marked),
    chunks as (
      select doc_id, k, count(*) as n, string_agg(line, chr(10) order by i) as bytes from numbered group by doc_id, k),
    judged as (
      select *, n >= {min_lines} and row_number() over (partition by bytes order by doc_id, k) > 1 as gone from chunks),
    docs as (
      select doc_id, sum(n) as n_lines, count(*) as n_chunks, coalesce(sum(n) filter (gone), 0) as n_removed,
             coalesce(string_agg(bytes, chr(10) order by k) filter (not gone), '') as text
      from judged group by doc_id)
    select d.doc_id, case when d.text is null then null else x.text end as text,
           coalesce(x.n_lines, 0)::bigint as n_lines, coalesce(x.n_chunks, 0)::bigint as n_chunks,
           coalesce(x.n_removed, 0)::bigint as n_removed
    from documents d left join docs x using (doc_id)
    """


def runs_sql() -> str:
    """`dedup_runs` for `documents` in DuckDB, by windows over pairs of lines (ids without repeats)."""
    return """
    with lines as (
      select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i
      from documents where text is not null),
    pairs as (select *, lead(line) over (partition by doc_id order by i) as follower from lines),
    ranked as (
      select doc_id, i, first_value(doc_id) over w as first_doc, first_value(i) over w as first_i
      from pairs where follower is not null window w as (partition by line, follower order by doc_id, i)),
    gone as (
      select doc_id, i, first_doc = doc_id and first_i = i - 1 as overlapping from ranked where first_doc <> doc_id or first_i <> i),
    lost as (select doc_id, i + 1 as i from gone union select doc_id, i from gone where not overlapping),
    docs as (
      select l.doc_id, count(*) as n_lines, count(g.i) as n_removed,
             coalesce(string_agg(line, chr(10) order by l.i) filter (g.i is null), '') as text
      from lines l left join lost g on g.doc_id = l.doc_id and g.i = l.i group by l.doc_id)
    select d.doc_id, case when d.text is null then null else x.text end as text,
           coalesce(x.n_lines, 0)::bigint as n_lines, coalesce(x.n_removed, 0)::bigint as n_removed
    from documents d left join docs x using (doc_id)
    """
