"""Sharding by histogram sort. DataFrame functions only.

The law is `bytes`: cut the documents, in the order of a 60-bit key, into shards of equal size.
The key is a hash of the text followed by a hash of the id: copies are neighbours and share a
shard, unless a border falls among them.

Histogram sort finds the borders without sorting anything: each round counts, exactly and over
all partitions, the bytes below 2^`bits` equally spaced candidate keys in the range that is still
open for a border, and narrows that range to one step. A border is settled once its range holds
one key, or no more than `tolerance` bytes. After a few rounds one exchange moves every document
to its place. Only counts come to the driver: at most (shards - 1) * 2^bits rows a round.

Shard of a key: floor(shards * bytes under smaller keys / all bytes). Null text is of size 8.
Rows alike in text and id have the same key and stay together. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import id_order, stored

TEXT_DIGITS, ID_DIGITS = 8, 7  # hex digits of MD5: 32 and 28 bits
KEY_BITS = 4 * (TEXT_DIGITS + ID_DIGITS)
ROW_BYTES = 8
#: Rows that one task numbers at a time, about.
BLOCK_ROWS = 20_000


def _bits(value: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")


def key_of(text: Column, id_: Column) -> Column:
    high = _bits(F.coalesce(text, F.lit("")), TEXT_DIGITS)
    low = _bits(F.coalesce(id_.cast("string"), F.lit("")), ID_DIGITS)
    return F.shiftleft(high, 4 * ID_DIGITS).bitwiseOR(low)


def find_borders(keys: DataFrame, shards: int, bits: int = 10, tolerance: int = 0) -> tuple[int, list[int]]:
    """(all bytes, border i: the smallest key that belongs to shard i or a later one), i from 1.

    `keys` has `key` and `size`. Ranges are aligned to powers of two, so a candidate's number is
    a shift of the key.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    wanted = {i: None for i in range(1, shards)}
    if not total:
        return 0, []
    # per open border: the range [low, low + 2^width) and the bytes under it
    open_ = {i: (0, KEY_BITS, 0) for i in wanted}
    while open_:
        width = next(iter(open_.values()))[1]
        step = max(0, width - bits)
        ranges = sorted({low >> width for low, _, _ in open_.values()})
        counted = (
            keys.where(F.shiftright("key", width).isin(ranges)).groupBy(F.shiftright("key", step).alias("cell"))
            .agg(F.sum("size").alias("bytes"), F.min("key").alias("least"), F.max("key").alias("most")).collect()
        )
        cells: dict[int, list] = {}
        for r in sorted(counted, key=lambda r: r["cell"]):
            cells.setdefault(r["cell"] << step >> width, []).append(r)
        still = {}
        for i, (low, _, under) in open_.items():
            below = under
            for r in cells[low >> width]:
                # the first key whose bytes below reach i/shards of all belongs to shard i
                if below * shards >= i * total:
                    wanted[i] = r["least"]
                    break
                if (below + r["bytes"]) * shards > i * total:
                    if r["least"] == r["most"]:
                        below += r["bytes"]
                        continue
                    if r["bytes"] <= tolerance:
                        wanted[i] = r["least"]
                        break
                    still[i] = (r["cell"] << step, step, below)
                    break
                below += r["bytes"]
            if wanted[i] is None and i not in still:
                wanted[i] = (low + (1 << open_[i][1]))  # the range's keys are all smaller
        open_ = still
    return total, [wanted[i] for i in range(1, shards)]


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 24, bits: int = 10, tolerance: int = 0
) -> DataFrame:
    """One row per row of `docs`: source (the row), id, size, shard, slot (gapless from 0 in a shard).

    Slots follow the key. They are numbered in blocks of neighbouring keys, whose starts are sums
    of the counts of earlier blocks; a block that copies of one text fill is divided by the id.
    """
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("source"))
    text, own = F.col("source")[text_col].cast("string"), F.col("source")[id_col].cast("long")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")
    rows = whole.select("source", own.alias("id"), size.alias("size"), key_of(text, own).alias("key"))
    keys = stored(rows.select("key", "size"), "shard-keys")
    _, borders = find_borders(keys, shards, bits, tolerance)
    shard = F.lit(0)
    for border in borders:
        shard = shard + (F.col("key") >= F.lit(border)).cast("int")

    n = keys.count()
    wide = min(4 * TEXT_DIGITS, max(0, (n // BLOCK_ROWS).bit_length()))
    block = F.shiftright("key", KEY_BITS - wide) if wide else F.lit(0).cast("long")
    counts = keys.select(block.alias("block")).groupBy("block").agg(F.count(F.lit(1)).alias("rows"))
    full = counts.where(F.col("rows") > 4 * BLOCK_ROWS).select(
        "block", F.ceil(F.log2(F.col("rows") / BLOCK_ROWS)).cast("int").alias("extra")
    )
    full = stored(full, "shard-full-blocks")

    def placed(frame: DataFrame) -> DataFrame:
        """Adds shard, block and, in blocks with too many rows, the part by leading bits that differ."""
        with_block = frame.withColumn("shard", shard).withColumn("block", block).join(full, "block", "left")
        # the extra bits: the rest of the text's hash, then as many of the id's
        rest = KEY_BITS - wide
        text_rest = 4 * TEXT_DIGITS - wide
        by_text = F.shiftright(F.col("key"), 4 * ID_DIGITS).bitwiseAND(F.lit((1 << text_rest) - 1))
        low = F.col("key").bitwiseAND(F.lit((1 << 4 * ID_DIGITS) - 1))
        part = F.when(F.col("extra").isNull(), F.lit(0).cast("long")).otherwise(
            F.shiftleft(by_text, 12).bitwiseOR(F.shiftright(low, 4 * ID_DIGITS - 12))
        )
        return with_block.withColumn("part", part).drop("extra")

    groups = placed(keys).groupBy("shard", "block", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        groups.select("shard", "block", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")), "shard-starts"
    )
    inside = Window.partitionBy("shard", "block", "part").orderBy("key", id_order("id"))
    numbered = placed(rows).withColumn("place", F.row_number().over(inside))
    return (
        numbered.join(starts, ["shard", "block", "part"])
        .select("source", "id", "size", "shard", (F.col("start") + F.col("place") - 1).cast("long").alias("slot"))
    )


def digest(sharded: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("source.text"), F.lit(""))
    return sharded.select(
        F.col("source.doc_id").alias("doc_id"), "size", F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
