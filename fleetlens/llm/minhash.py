"""MinHash near-dedup with sequential Bayesian verification.

1. One Python pass gives each document its shingle set's size and digest, band hashes and a
   signature of one byte per hash function. Documents with the same set form a class; from here
   on only classes are compared, so copies cost nothing more.
2. Classes that agree in a band share a bucket. First each member is compared with the bucket's
   most central member, the one with the fullest buckets (as many pairs as members): in a family
   of copies this is the text they come from. Links join classes to components.
3. Buckets of three or more members that still hold several components are put together by their
   most frequent component: a family. Its members outside that component are compared with all
   its members of other components, cell by cell of a bounded size, and each cell reports one
   link to a component. Neither pairs inside a component nor candidate pairs leave a cell.
4. A pair is compared batch by batch of its signatures. After each batch the posterior
   probability (uniform prior) of a similarity of `threshold` or more decides: below `miss` the
   pair is dropped. Survivors are confirmed on the full shingle sets of their texts.

A document without words has an empty set and no links. A row without an id takes no part:
its component is null and it is kept. Rows that share an id are one node, linked if any of
their texts is.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import ASCII_SPACE, Words, components, mix64, slices, stored

_JOIN = [np.uint64(0xA24BAED4963EE407 + 2 * 0x632BE59BD9B4E019 * i & 0xFFFFFFFFFFFFFFFF | 1) for i in range(16)]


@dataclass(frozen=True)
class Settings:
    """words: shingle length; threshold: in percent; bands of rows: which pairs are candidates;
    batch: hashes per comparison step; miss: probability of dropping a pair at the threshold."""

    words: int = 5
    threshold: int = 80
    bands: int = 40
    rows: int = 6
    batch: int = 24
    miss: float = 1e-6

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def shingle_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """Distinct hashes of the runs of `words` words; of the whole sequence where it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(words, n)
    total = hashes[: n - width + 1] * _JOIN[0]
    for k in range(1, width):
        total = total + hashes[k : n - width + 1 + k] * _JOIN[k]
    return np.unique(mix64(total + np.uint64(width)))


def _functions(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * settings.hashes + 1, dtype=np.uint64))
    a = (seeds[: settings.hashes] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return a[:, None], (seeds[settings.hashes :] >> np.uint64(32)).astype(np.uint32)[:, None]


def minima(values: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 2048) -> np.ndarray:
    small = (values >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(small), block):
        np.minimum(best, (a * small[None, at : at + block] + b).min(axis=1), out=best)
    return best


def _fingerprints(settings: Settings):
    a, b = _functions(settings)
    salt = mix64(np.arange(1, settings.bands + 1, dtype=np.uint64))
    weight = mix64(np.arange(1001, 1001 + settings.rows, dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, batch.column("text")):
                words = Words(texts, ASCII_SPACE)
                sizes, keys, bands, signatures = [], [], [], []
                for i in range(len(texts)):
                    values = shingle_hashes(words.hashes[words.first[i] : words.first[i + 1]], settings.words)
                    sizes.append(len(values))
                    if not len(values):
                        keys.append(None), bands.append(None), signatures.append(None)
                        continue
                    least = minima(values, a, b)
                    mixed = mix64(least)
                    rows = mixed.reshape(settings.bands, settings.rows)
                    bands.append(mix64((rows * weight).sum(axis=1, dtype=np.uint64) ^ salt).view(np.int64))
                    signatures.append((mixed & np.uint64(255)).astype(np.uint8).tobytes())
                    keys.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                    names=["id", "n", "set_key", "bands", "signature"],
                )

    return run


def least_matches(settings: Settings) -> np.ndarray:
    """For each number of compared hashes, the fewest matches with which a pair goes on.

    With m of n matches and a uniform prior, P(p >= t) = sum over i <= m of C(n+1, i) t^i
    (1-t)^(n+1-i). Signatures keep one byte, so two sets of similarity s match with
    s + (1 - s) / 256.
    """
    s = settings.threshold / 100
    t = s + (1 - s) / 256
    table = []
    for n in range(settings.batch, settings.hashes + 1, settings.batch):
        below, fewest = 0.0, n + 1
        for m in range(n + 1):
            below += math.exp(
                math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                + m * math.log(t) + (n + 1 - m) * math.log1p(-t)
            )
            if below >= settings.miss:
                fewest = m
                break
        table.append(fewest)
    return np.array(table)


def _prune(settings: Settings):
    fewest = least_matches(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = settings.hashes
        for batch in batches:
            sides = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, width)
                for c in ("sa", "sb")
            ]
            alive = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, dtype=np.int64)
            for step, least in enumerate(fewest):
                part = slice(step * settings.batch, (step + 1) * settings.batch)
                matches[alive] += (sides[0][alive, part] == sides[1][alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= least]
                if not len(alive):
                    break
            kept = pa.array(alive, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(kept), batch.column("b").take(kept)], names=["a", "b"])

    return run


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_set(text: bytes, words: int) -> set[tuple[bytes, ...]]:
    """The distinct shingles of a text, as words."""
    found = text.translate(_LOWER).split()
    if len(found) < words:
        return {tuple(found)} if found else set()
    return set(zip(*[found[i:] for i in range(words)]))


def _confirm(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, set] = (b"", set())
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch.column("ta"), batch.column("tb"))):
                left, right = x.as_py(), y.as_py()
                if last[0] != left:
                    last = (left, shingle_set(left, settings.words))
                other = shingle_set(right, settings.words)
                common = len(last[1] & other)
                if 100 * common >= settings.threshold * (len(last[1]) + len(other) - common):
                    kept.append(i)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(rows), batch.column("b").take(rows)], names=["a", "b"])

    return run


def _links(pairs: DataFrame, signatures: DataFrame, texts: DataFrame, settings: Settings, name: str) -> DataFrame:
    """The pairs (a, b) that are links, by pruning on signatures and confirming on texts."""
    left = signatures.select(F.col("id").alias("a"), F.col("signature").alias("sa"))
    right = signatures.select(F.col("id").alias("b"), F.col("signature").alias("sb"))
    survivors = stored(
        pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
        .mapInArrow(_prune(settings), "a long, b long").distinct(), f"{name}-survivors",
    )
    # the ids grow with the input, so texts meet them in the same way at every size
    ends = survivors.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = stored(texts.join(ends.hint("merge"), "id", "left_semi"), f"{name}-texts")
    return stored(
        survivors.join(needed.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        .join(needed.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        .select("a", "b", "ta", "tb").mapInArrow(_confirm(settings), "a long, b long").distinct(),
        f"{name}-links",
    )


#: Shingles of the members that meet in one cell, and askers in one cell, about.
CELL_SHINGLES, CELL_ASKERS, GROUP_SHINGLES = 300_000, 500, 1_000_000


def _first_links(settings: Settings):
    """For each asker of a cell and each other component, one member that it is linked with, if any."""
    fewest = least_matches(settings)

    def sets_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        words = Words(table.column("text").combine_chunks())
        own = [shingle_hashes(words.hashes[a:b], settings.words) for a, b in zip(words.first[:-1], words.first[1:])]
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(o) for o in own])])

    def signatures(table: pa.Table) -> np.ndarray:
        return np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint8).reshape(-1, settings.hashes)

    def cell(askers: pa.Table, members: pa.Table) -> Iterator[tuple[int, int]]:
        x_sign, y_sign = signatures(askers), signatures(members)
        x_sets, x_first = sets_of(askers)
        y_sets, y_first = sets_of(members)
        sizes = np.diff(y_first)
        x_ids, y_ids, x_roots, y_roots = (t.column(c).to_numpy() for c in ("id", "root") for t in (askers, members))
        # two members outside the main component are compared once
        asks_too = y_roots != members.column("family")[0].as_py()
        for i in range(askers.num_rows):
            own = x_sets[x_first[i] : x_first[i + 1]]
            close = np.minimum(sizes, len(own)) * 100 >= settings.threshold * np.maximum(sizes, len(own))
            alive = np.flatnonzero(close & (y_roots != x_roots[i]) & ~(asks_too & (y_ids > x_ids[i])))
            matches = np.zeros(len(alive), dtype=np.int64)
            for step, least in enumerate(fewest):
                part = slice(step * settings.batch, (step + 1) * settings.batch)
                matches = matches + (y_sign[alive, part] == x_sign[i, part]).sum(axis=1)
                alive, matches = alive[matches >= least], matches[matches >= least]
            linked = set()
            for y in alive[np.argsort(-matches, kind="stable")]:
                if y_roots[y] in linked:
                    continue
                common = len(np.intersect1d(own, y_sets[y_first[y] : y_first[y + 1]], assume_unique=True))
                if 100 * common >= settings.threshold * (len(own) + int(sizes[y]) - common):
                    left, right = (shingle_set(t.column("text")[int(k)].as_py(), settings.words) for t, k in ((askers, i), (members, y)))
                    if 100 * len(left & right) >= settings.threshold * len(left | right):
                        linked.add(y_roots[y])
                        yield int(x_ids[i]), int(y_ids[y])

    def run(_key: tuple, askers: pa.Table, members: pa.Table) -> pa.Table:
        found = []
        if askers.num_rows and members.num_rows:
            names = [askers.column("cell").to_numpy(), members.column("cell").to_numpy()]
            order = [np.argsort(n, kind="stable") for n in names]
            cells = [n[o] for n, o in zip(names, order)]
            for name in np.intersect1d(*cells):
                sides = [np.searchsorted(c, [name, name + 1]) for c in cells]
                found += cell(*[t.take(o[lo:hi]) for t, o, (lo, hi) in zip((askers, members), order, sides)])
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return run


def _family_links(families: DataFrame, signatures: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between members of a family outside its main component and its other members.

    `families` has family (its main component), class, n, root. Members are dealt out over cells
    by the id, so a family of any size is searched by as many tasks as it needs.
    """
    asks = F.col("root") != F.col("family")
    plan = stored(
        families.groupBy("family").agg(
            F.ceil(F.sum("n") / CELL_SHINGLES).cast("int").alias("blocks"),
            F.ceil(F.count_if(asks) / CELL_ASKERS).cast("int").alias("asker_blocks"), F.sum("n").alias("shingles"),
        ), "minhash-cells",
    )
    total = plan.agg(F.sum(F.col("shingles") * F.col("asker_blocks"))).first()[0] or 0
    groups = max(int(families.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / GROUP_SHINGLES))

    def all_of(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def part_of(n: str):
        return F.pmod(F.xxhash64("class"), F.col(n)).cast("int")

    def celled(frame: DataFrame) -> DataFrame:
        named = F.xxhash64("family", "block", "asker_block")
        return (
            frame.select(F.col("family").alias("family"), F.col("root").alias("root"), F.col("class").alias("id"), named.alias("cell"))
            .withColumn("group", F.pmod("cell", F.lit(groups)).cast("int"))
        )

    planned = families.join(plan.select("family", "blocks", "asker_blocks"), "family")
    askers = celled(planned.where(asks).withColumn("asker_block", part_of("asker_blocks")).withColumn("block", all_of("blocks")))
    members = celled(planned.withColumn("block", part_of("blocks")).withColumn("asker_block", all_of("asker_blocks")))
    ids = families.select(F.col("class").alias("id")).distinct()
    known = stored(texts.join(ids.hint("merge"), "id", "left_semi").join(signatures, "id"), "minhash-family-texts")
    return stored(
        askers.join(known, "id").groupBy("group")
        .cogroup(members.join(known.select(*[F.col(c).alias(c) for c in known.columns]), "id").groupBy("group"))
        .applyInArrow(_first_links(settings), "a long, b long"), "minhash-family-links",
    )


def _same_id(whole: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between the classes that texts of one id belong to. None where ids are unique."""
    code = F.xxhash64("set_key")
    several = whole.groupBy("id").agg(F.min(code).alias("low"), F.max(code).alias("high")).where("low != high").select("id")
    named = stored(
        whole.join(several, "id").select("id", "set_key").join(classes.select("set_key", "class"), "set_key").select("id", "class").distinct(),
        "minhash-shared-ids",
    )
    least = named.groupBy("id").agg(F.min("class").alias("a"))
    return named.join(least, "id").select("a", F.col("class").alias("b")).where("a != b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id (smallest id reachable), kept."""
    base = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").cast("binary").alias("text"))
    prints = stored(
        base.mapInArrow(
            _fingerprints(settings), "id long, n long, set_key binary, bands array<long>, signature binary"
        ), "minhash-prints",
    )
    whole = prints.where("id is not null and n > 0")
    classes = stored(
        whole.groupBy("set_key").agg(F.min("id").alias("class"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "minhash-classes",
    )
    members = classes.select(F.explode("bands").alias("bucket"), "class", "n")
    full = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stored(members.join(full, "bucket").select("bucket", "class", "n", "size"), "minhash-buckets")
    central = shared.groupBy("class").agg(F.sum("size").alias("weight"))
    # the fullest buckets first, then the smaller id
    ranked = shared.join(central, "class").groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("class")).alias("minus"))).alias("top"))
    leaders = ranked.select("bucket", (-F.col("top.minus")).alias("leader"))
    led = shared.join(leaders, "bucket")
    close = f"least(n, m) * 100 >= {settings.threshold} * greatest(n, m)"
    size_of = classes.select(F.col("class").alias("leader"), F.col("n").alias("m"))
    stars = stored(
        led.where("class != leader").select("leader", "class", "n").distinct().join(size_of, "leader").where(close)
        .select(F.least("leader", "class").alias("a"), F.greatest("leader", "class").alias("b")).distinct(), "minhash-stars",
    )
    signatures = whole.join(classes.select(F.col("class").alias("id"), "set_key"), ["id", "set_key"], "left_semi").select("id", "signature")
    texts = base.where("id is not null and text is not null")
    first = _links(stars, signatures, texts, settings, "minhash-first").unionByName(_same_id(whole, classes))
    roots = components(first, "minhash-first")
    placed = stored(
        classes.select("class", "n").join(roots.withColumnRenamed("node", "class"), "class", "left")
        .select("class", "n", F.coalesce("root", "class").alias("root")), "minhash-placed",
    )
    # two members of a bucket have met already
    inside = shared.where("size > 2").select("bucket", "class").join(placed, "class")
    counts = inside.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("times"))
    mixed = (
        counts.groupBy("bucket").agg(F.max(F.struct("times", "root")).alias("most"), F.count(F.lit(1)).alias("roots"))
        .where("roots > 1").select("bucket", F.col("most.root").alias("family"))
    )
    families = stored(inside.join(mixed, "bucket").select("family", "class", "n", "root").distinct(), "minhash-families")
    second = _family_links(families, signatures, texts, settings)
    final = components(
        roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(second), "minhash-final"
    )
    named = classes.select("set_key", "class").join(final.withColumnRenamed("node", "class"), "class", "left")
    component = named.select("set_key", F.coalesce("root", "class").alias("component_id"))
    filled = prints.where("set_key is not null").select("id", "n", "set_key").join(component, "set_key", "left").select("id", "n", "component_id")
    # an empty text goes with the other texts of its id, if there are any
    empty = prints.where("set_key is null").select("id", "n")
    empty = empty.join(filled.groupBy("id").agg(F.min("component_id").alias("component_id")), "id", "left")
    return (
        filled.unionByName(empty)
        .select(
            "id", F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    )
