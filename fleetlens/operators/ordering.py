"""Ordered computations that stay parallel when one group holds much of the table.

`Window.partitionBy(entity)` gives each group to one task, whatever its size. Here every group is cut
into chunks, always and in the same way:

* `time_chunks` cuts by stretches of time of a given width. A row's chunk is a function of the row
  alone: no split points, nothing on the driver, and a task's size does not depend on the
  table's.
* `range_chunks` cuts by range partitions, for orders that are no time (scores, sensor values).

Cumulative windows (`running`) run per chunk and add what earlier chunks sum up to. Sliding windows run
per chunk with the few rows the frame reaches back to copied in from earlier chunks and dropped
again (`halo_rows`, `drop_halo`). Chunk summaries hold one row per chunk; only they are
scanned per group. Results are the plain window's.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.session import cut_lineage

GROUP = "__group"
CHUNK = "__chunk"
HALO = "__halo"
PART = (GROUP, CHUNK)

#: Default width of a chunk: a week, 1,008 readings at one every ten minutes.
CHUNK_SECONDS = 7 * 86_400

NO_TIME = -(1 << 62)  # stands for a missing time, which comes first


# --- time as numbers --------------------------------------------------------------------


def epoch_micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970, in time order whatever the session's time zone does.

    Times without a zone are counted on their own calendar, so no gap or repeated hour of a
    zone can move them.
    """
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long") * 86_400_000_000
    seconds = F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3600 + F.minute(c) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since 1970 of a time column; a numeric column is taken as seconds."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        return F.floor(F.col(column)).cast("long")
    return F.floor(epoch_micros(df, column) / 1_000_000).cast("long")


# --- chunks -----------------------------------------------------------------------------


def group_key(by: Sequence[str]) -> Column:
    """One key for the group. Inside a struct nulls equal each other, so plain joins find them."""
    return F.struct(*[F.col(c) for c in by]) if by else F.lit(0)


def time_chunks(df: DataFrame, by: Sequence[str], order: str, seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Adds the group and the number of the stretch of `seconds` that `order` falls into."""
    number = F.floor(epoch_seconds(df, order) / seconds)
    return df.withColumns({GROUP: group_key(by), CHUNK: F.coalesce(number, F.lit(NO_TIME))})


def range_chunks(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Adds the group and the number of the range partition by (group, order).

    The partitions are stored with their numbers, so a repeated task finds the same ones. Rows that
    agree on `by` and `order` share a partition: reduce them to counts first.
    """
    ranged = df.repartitionByRange(*by, order).withColumns({GROUP: group_key(by), CHUNK: F.spark_partition_id().cast("long")})
    return cut_lineage(ranged)


def crowded(df: DataFrame, by: str, rows: int) -> Column | None:
    """Whether a row's group has more than `rows` rows, and more than a thousandth of all; None if no group has.

    So at most a thousand groups are named in the condition, which is a function of the row alone: no row moves for it.
    """
    counts = df.groupBy(by).count()
    least = max(rows, (counts.agg(F.sum("count")).first()[0] or 0) // 1000)
    found = [r[0] for r in counts.where(F.col("count") > least).select(by).collect()]
    if not found:
        return None
    named = F.coalesce(F.col(by).isin([v for v in found if v is not None]), F.lit(False))
    return named | F.col(by).isNull() if None in found else named


def drop_chunk(df: DataFrame) -> DataFrame:
    return df.drop(GROUP, CHUNK)


# --- cumulative -------------------------------------------------------------------------

_MERGE: dict[str, Callable[[Column, Column], Column]] = {
    "sum": lambda own, carried: F.coalesce(own + carried, own, carried),
    "min": F.least,
    "max": F.greatest,
}


def running(
    chunked: DataFrame,
    order: str,
    outputs: Mapping[str, tuple[str, str]],
    order_by: Sequence[str] | None = None,
    descending: bool = False,
    whole: Mapping[str, tuple[str, str]] = MappingProxyType({}),
) -> DataFrame:
    """Cumulative `sum`, `min` or `max` up to and including the peers of the current row.

    `outputs` maps a new column to (function, input column); `whole` does the same for values of
    the entire group. A frame growing from one end costs one update per row; the suffix form is the
    same frame over the descending order. The rows are shuffled once, by (group, chunk); what is
    carried comes to them by the same key, from a table of one row per chunk.
    """
    direct = F.desc if descending else F.asc
    frame = (
        Window.partitionBy(*PART).orderBy(*[direct(c) for c in (order_by or [order])])
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    own = chunked.withColumns({o: getattr(F, fn)(c).over(frame) for o, (fn, c) in outputs.items()})
    totals = chunked.groupBy(*PART).agg(*[getattr(F, fn)(c).alias(o) for o, (fn, c) in {**outputs, **whole}.items()])
    order = F.desc(CHUNK) if descending else F.asc(CHUNK)
    series = Window.partitionBy(GROUP)
    before = series.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *PART,
        *[getattr(F, fn)(o).over(before).alias(f"__carry_{o}") for o, (fn, _) in outputs.items()],
        *[getattr(F, fn)(o).over(series).alias(o) for o, (fn, _) in whole.items()],
    )
    merged = {o: _MERGE[fn](F.col(o), F.col(f"__carry_{o}")) for o, (fn, _) in outputs.items()}
    return own.join(carry, list(PART), "left").withColumns(merged).select(*own.columns, *whole)


# --- sliding ----------------------------------------------------------------------------


def halo_rows(chunked: DataFrame, order: str, rows: int, sources: Sequence[str], among: Column | None = None) -> DataFrame:
    """For frames that reach back `rows` rows: a marked copy of each row in every later chunk that sees it.

    Only a chunk's last `rows` rows can be seen from a later one, and only with their `sources`. A
    chunk is seen by as many of its successors as it takes to hold `rows` rows, so gaps and
    chunks of any size are right. `among` leaves out groups that are one chunk.
    """
    backwards = Window.partitionBy(*PART).orderBy(F.desc(order))
    tails = (
        (chunked if among is None else chunked.where(among)).select(*PART, order, *[c for c in dict.fromkeys(sources) if c != order])
        .withColumn("__rank", F.row_number().over(backwards)).where(F.col("__rank") <= rows)
    )
    sizes = tails.groupBy(*PART).agg(F.max("__rank").cast("long").alias("__n"))
    series = Window.partitionBy(GROUP).orderBy(CHUNK)
    begins = sizes.withColumn("__begin", F.sum("__n").over(series) - F.col("__n"))
    following = F.collect_list(F.struct(F.col(CHUNK).alias("chunk"), F.col("__begin").alias("begin"))).over(series.rowsBetween(1, rows))
    seen_by = F.filter(following, lambda x: x["begin"] < F.col("__begin") + F.col("__n") + rows)
    plan = begins.withColumn("__later", seen_by).where(F.size("__later") > 0)
    place = F.col("__begin") + F.col("__n") - F.col("__rank")
    copies = (
        tails.join(plan, list(PART)).withColumn("__place", place)
        .withColumn("__to", F.explode(F.filter("__later", lambda x: x["begin"] <= F.col("__place") + rows)))
        .withColumns({CHUNK: F.col("__to.chunk"), HALO: F.lit(True)})
        .drop("__rank", "__n", "__begin", "__later", "__place", "__to")
    )
    return chunked.withColumn(HALO, F.lit(False)).unionByName(copies, allowMissingColumns=True)


def drop_halo(df: DataFrame) -> DataFrame:
    """Removes the copies and the helper columns."""
    return drop_chunk(df.where(~F.col(HALO))).drop(HALO)


# --- ranks ------------------------------------------------------------------------------

#: Cells of one histogram pass: 16 bits of an order code.
CELLS = 1 << 16
_TEXT_BYTES = 7


def _codes(df: DataFrame, column: str, longest: int) -> list[Column]:
    """Numbers whose order, one after the other, is that of the column."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType):
        return [epoch_micros(df, column)]
    if isinstance(kind, T.StringType):
        raw = c.cast("binary")
        pieces = [F.rpad(F.hex(F.substring(raw, 1 + i, _TEXT_BYTES)), 2 * _TEXT_BYTES, "0") for i in range(0, max(longest, 1), _TEXT_BYTES)]
        return [F.conv(p, 16, 10).cast("long") for p in pieces] + [F.octet_length(c).cast("long")]
    if isinstance(kind, T.IntegralType | T.BooleanType):
        return [c.cast("long")]
    return [c.cast("double")]


def _cell(code: Column, low: float, high: float) -> Column:
    """The cell of a code between `low` and `high`: never descending, so cells can be counted in order."""
    if isinstance(low, int):
        wide = code.cast("decimal(20,0)") if high - low >= 1 << 63 else code
        return F.call_function("div", wide - low, F.lit((high - low) // CELLS + 1))
    return F.least(F.floor((code / 2 - low / 2) / (high / 2 - low / 2) * CELLS), F.lit(CELLS - 1))


def _ends(code: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.count(code).alias("known"), F.min(code).alias("low"), F.max(code).alias("high")]


def _select(codes: DataFrame, names: list[str], ranks: list[int]) -> list[tuple]:
    """The tuple of codes at each 0-based rank, nulls first, by histogram passes.

    A pass counts the cells of the interval a rank lies in and keeps the one that holds it, with
    its least and greatest code; two equal codes end the search. All ranks share their passes.
    """
    first, rest = names[0], names[1:]
    head = codes.agg(*_ends(F.col(first))).first()
    nulls = head["n"] - head["known"]
    # rank -> (rank within the interval, least and greatest code of the interval, rows in it)
    spots = {r: (r - nulls, head["low"], head["high"], head["known"]) if r >= nulls else (r, None, None, nulls) for r in ranks}
    tails: dict[int, list] = {}
    while True:
        opened = sorted({s[1:3] for s in spots.values() if s[1] != s[2]})
        if not opened:
            break
        interval, cell = F.lit(None).cast("int"), F.lit(None).cast("long")
        for i, (low, high) in enumerate(opened):
            inside = F.col(first).between(low, high)
            interval = F.when(inside, i).otherwise(interval)
            cell = F.when(inside, _cell(F.col(first), low, high).cast("long")).otherwise(cell)
        cells = (
            codes.withColumns({"__interval": interval, "__cell": cell}).where("__interval is not null").groupBy("__interval", "__cell")
            .agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("low"), F.max(first).alias("high"), *[F.min(c).alias(c) for c in rest])
        )
        upto = F.sum("n").over(Window.partitionBy("__interval").orderBy("__cell"))
        wanted = F.lit(False)
        for within, low, high, _ in spots.values():
            if low != high:
                wanted = wanted | ((F.col("__interval") == opened.index((low, high))) & (F.col("upto") > within) & (F.col("upto") - F.col("n") <= within))
        found = cells.withColumn("upto", upto).where(wanted).collect()
        for r, (within, low, high, _) in spots.items():
            if low != high:
                at = opened.index((low, high))
                row = next(x for x in found if x["__interval"] == at and x["upto"] - x["n"] <= within < x["upto"])
                spots[r] = (within - row["upto"] + row["n"], row["low"], row["high"], row["n"])
                if row["n"] == 1:
                    tails[r] = [row[c] for c in rest]
    answers = {}
    for key in {s[1] for s in spots.values()}:
        same = [r for r in ranks if spots[r][1] == key]
        missing = [r for r in same if r not in tails]
        if rest and missing:
            tied = codes.where(F.col(first) == key if key is not None else F.col(first).isNull())
            inner = _select(tied, rest, [spots[r][0] for r in missing])
            tails |= {r: list(t) for r, t in zip(missing, inner)}
        answers |= {r: (key, *(tails[r] if rest else ())) for r in same}
    return [answers[r] for r in ranks]


def keys_at_ranks(df: DataFrame, order: Sequence[str], ranks: Callable[[int], Sequence[int]]) -> tuple[list[Column], list[tuple | None]]:
    """(codes of `order` as columns over `df`, the codes found at each 0-based rank, nulls first).

    `ranks` gets the number of rows; a rank beyond the last row has no key. Only the `order` columns are stored
    and counted; a few rows come to the driver in each pass.
    """
    narrow = cut_lineage(df.select(*order))
    texts = [c for c in order if isinstance(df.schema[c].dataType, T.StringType)]
    told = narrow.agg(F.count(F.lit(1)).alias("__n"), *[F.max(F.octet_length(c)).alias(c) for c in texts]).first()
    codes = [code for c in order for code in _codes(df, c, (told[c] or 0) if c in texts else 0)]
    names = [f"__code{i}" for i in range(len(codes))]
    wanted = list(ranks(told["__n"]))
    inside = sorted({r for r in wanted if r < told["__n"]})
    found = dict(zip(inside, _select(narrow.select(*[c.alias(n) for c, n in zip(codes, names)]), names, inside))) if inside else {}
    return codes, [found.get(r) for r in wanted]


def before_key(codes: Sequence[Column], key: Sequence) -> Column:
    """True for rows strictly before `key` in the ascending order, nulls first: a map-side test."""
    column, value = codes[0], key[0]
    if value is None:
        smaller, equal = F.lit(False), column.isNull()
    else:
        smaller, equal = F.coalesce(column < value, F.lit(True)), F.coalesce(column == value, F.lit(False))
    return smaller if len(codes) == 1 else smaller | (equal & before_key(codes[1:], key[1:]))
