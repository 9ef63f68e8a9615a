"""A manifest of a dataset as Merkle trees, and its verification by recursive queries that climb them.

A leaf is the hash of a row's columns. The leaves of a group (here: a language) ascend by id; every
`fanout` consecutive nodes become one node of the next level until one is left, the group's subroot.
The subroots, in order of their groups, become the dataset's root in the same way.

Build. Leaves are range partitioned by (group, id, leaf) and stored, so that a group of any size
is ordered by many tasks; positions come from counts per partition. Each level is a grouping of at most
`fanout` rows by (tree, position div fanout) and is stored as rows that name their parent.

Climb. A recursive query joins each row with its parent, appends the siblings found there to the
proof and folds the hash one level up, until no parent is left. The leaves of one run share every
sibling above the run, so they ascend in one row that holds a folded hash for each of them.
Near the top many rows meet few nodes: the levels of at most `broadcast_nodes` nodes are broadcast and
climbed by a second recursive query; below, at most `fanout` to the power of the level rows meet a node.

Defined results: a row without a group forms part of the null group, which comes first; rows without
an id follow all others of their group; equal ids are ordered by leaf, equal rows are leaves of their own. A lone
leaf is its group's subroot, a lone subroot the root; the proof is then the hash of nothing. An
empty table has no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import id_order, stored
from fleetlens.llm.sqltext import crc32

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HASH_BYTES = 32
TOP = -1  # the tree over the subroots


@dataclass(frozen=True)
class Settings:
    """broadcast_nodes: levels are broadcast while they hold at most so many nodes of about 350 bytes."""

    fanout: int = 8
    broadcast_nodes: int = 30_000


@dataclass(frozen=True)
class Manifest:
    """runs: level 1, a row per run of leaves; nodes: (tree, level, at), hash, children, link to the parent.

    inner: number of nodes of each level of the group's trees from 2 on, for the choice of the join.
    """

    runs: DataFrame
    nodes: DataFrame
    inner: list[int]


def field(column: Column) -> Column:
    """A value as it enters a leaf: its UTF-8 byte count, a colon and itself; a dash for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


def hash_of(children: Column) -> Column:
    """The hash over the hex text of concatenated digests."""
    return F.unhex(F.sha2(F.lower(F.hex(children)).cast("binary"), 256))


def _ranked(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """`df` with place (from 0 in its group, by `order`) and members (of its group).

    Range partitions are written with their number, so a repeated task finds the same ones.
    """
    cut = stored(df.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id()), name)
    counts = cut.groupBy(group, "part").agg(F.count(F.lit(1)).alias("own"))
    whole = Window.partitionBy(group)
    counts = counts.select(
        group, "part", (F.sum("own").over(whole.orderBy("part")) - F.col("own")).alias("before"),
        F.sum("own").over(whole).alias("members"),
    )
    inside = Window.partitionBy(group, "part").orderBy(*order)
    placed = cut.withColumn("place", F.row_number().over(inside).cast("long") - 1).join(counts, [group, "part"])
    return placed.withColumn("place", F.col("place") + F.col("before")).drop("part", "before")


def _link(trees: int, fanout: int) -> list[Column]:
    """up_tree, up_level, up_at, up_place of a node; null for the root."""
    inside, crossing = F.col("width") > 1, (F.col("tree") != TOP) & F.lit(trees > 1)
    at = F.when(inside, F.col("at")).when(crossing, F.col("tree"))
    return [
        F.when(inside, F.col("tree")).when(crossing, F.lit(TOP).cast("long")).alias("up_tree"),
        F.when(inside, F.col("level") + 1).when(crossing, F.lit(1)).alias("up_level"),
        F.floor(at / fanout).alias("up_at"), (at % fanout).cast("int").alias("up_place"),
    ]


def _levels_above(base: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """The stored levels above `base` (tree, level, at, width, hash), lowest first."""
    most, levels, now = base.agg(F.max("width")).first()[0] or 0, [], base
    while most > 1:
        children = F.array_sort(F.collect_list(F.struct("at", "hash")))
        groups = now.where("width > 1").withColumn("up", F.floor(F.col("at") / fanout)).groupBy("tree", "up", "level", "width")
        now = groups.agg(F.array_join(F.transform(children, lambda c: F.hex(c["hash"])), "").alias("hex")).select(
            "tree", (F.col("level") + 1).alias("level"), F.col("up").alias("at"),
            F.ceil(F.col("width") / fanout).alias("width"), F.unhex("hex").alias("children"),
            hash_of(F.unhex("hex")).alias("hash"),
        )
        now = stored(now, f"{name}-level")
        levels.append(now)
        most = -(-most // fanout)
    return levels


def build(
    docs: DataFrame, leaf: Column, claimed: Column, id_col: str = "doc_id", group_col: str = "lang",
    settings: Settings = Settings(), name: str = "merkle",
) -> Manifest:
    """The trees over the rows of `docs`. `claimed` is the leaf as somebody else states it (see `verify`)."""
    fanout = settings.fanout
    key = F.coalesce(F.concat(F.lit("="), docs[group_col].cast("string")), F.lit(""))
    leaves = docs.select(
        key.alias("grp"), docs[id_col].cast("long").alias("id"), leaf.alias("leaf"), claimed.alias("claimed"),
    ).select("*", id_order("id").alias("id_order"), F.monotonically_increasing_id().alias("row"))
    placed = _ranked(stored(leaves, f"{name}-leaves"), "grp", ["id_order", "leaf", "row"], f"{name}-ordered")
    member = F.struct((F.col("place") % fanout).alias("at"), "id", "leaf", "claimed")
    grouped = placed.withColumn("at", F.floor(F.col("place") / fanout)).groupBy("grp", "at", "members")
    runs = stored(grouped.agg(F.array_sort(F.collect_list(member)).alias("leaves")), f"{name}-grouped")

    groups = runs.where("at = 0").select("grp", F.lit(0).alias("all"))
    trees = _ranked(groups, "all", ["grp"], f"{name}-groups").select("grp", F.col("place").alias("tree"), F.col("members").alias("trees"))
    trees = stored(trees, f"{name}-trees")
    count = trees.count()

    children = F.unhex(F.array_join(F.transform("leaves", lambda x: F.hex(x["leaf"])), ""))
    level1 = runs.join(trees.select("grp", "tree"), "grp").select(
        "tree", F.lit(1).alias("level"), "at", F.ceil(F.col("members") / fanout).alias("width"), "leaves", children.alias("children"),
    ).withColumn("hash", F.when(F.size("leaves") + F.col("at") == 1, F.col("children")).otherwise(hash_of(F.col("children"))))
    level1 = stored(level1.select("*", *_link(count, fanout)), f"{name}-runs")

    slim = ["tree", "level", "at", "width", "hash"]
    inner = _levels_above(level1.select(slim), fanout, name)
    subroots = reduce(DataFrame.unionByName, [level.select(slim).where("width = 1") for level in [level1, *inner]])
    top = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"),
        F.lit(count).cast("long").alias("width"), "hash",
    )
    above = inner + _levels_above(top, fanout, f"{name}-top")
    empty = level1.select([*slim, "children"]).limit(0)
    nodes = reduce(DataFrame.unionByName, above, empty).select(*slim, "children", *_link(count, fanout))
    return Manifest(level1, stored(nodes, f"{name}-nodes"), [level.count() for level in inner])


def _without(children: str, place: str) -> str:
    """SQL: the siblings of the child at `place`, left to right."""
    left = f"substring({children}, 1, {HASH_BYTES} * {place})"
    return f"concat({left}, substring({children}, {HASH_BYTES} * ({place} + 1) + 1))"


def _with(children: str, place: str, digest: str) -> str:
    """SQL: the hash of the parent if the child at `place` has this digest."""
    left, right = f"substring({children}, 1, {HASH_BYTES} * {place})", f"substring({children}, {HASH_BYTES} * ({place} + 1) + 1)"
    return f"unhex(sha2(cast(lower(hex(concat({left}, {digest}, {right}))) as binary), 256))"


_CLIMB = f"""
with recursive climb (run_tree, run_at, folded, proof, subroot, hash, up_tree, up_level, up_at, up_place) as (
  select run_tree, run_at, folded, proof, subroot, hash, up_tree, up_level, up_at, up_place from {{rows}}
  union all
  select {{hint}} c.run_tree, c.run_at,
    transform(c.folded, x -> {_with("n.children", "c.up_place", "x")}),
    concat(c.proof, {_without("n.children", "c.up_place")}),
    coalesce(c.subroot, if(n.width = 1 and n.tree <> {TOP}, n.hash, null)), n.hash,
    n.up_tree, n.up_level, n.up_at, n.up_place
  from climb c join {{nodes}} n on n.tree = c.up_tree and n.level = c.up_level and n.at = c.up_at
)
select * from climb where up_tree is null or not ({{inside}})
"""

_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def _climbed(rows: DataFrame, nodes: DataFrame, inside: str, hint: str, name: str) -> DataFrame:
    """Rows carried up as far as their parents satisfy `inside`, stored."""
    spark: SparkSession = rows.sparkSession
    limit = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")  # a limit of the session would end the climb of large tables
    try:
        return stored(spark.sql(_CLIMB.replace("{hint}", hint).replace("{inside}", inside), rows=rows, nodes=nodes.where(inside.replace("up_", ""))), name)
    finally:
        spark.conf.set(_ROW_LIMIT, limit)


def verify(manifest: Manifest, settings: Settings = Settings(), name: str = "merkle") -> DataFrame:
    """One row per leaf: id, leaf, subroot, root, proof (the siblings' digests up to the root), folded_root.

    All digests are binary. folded_root is the claimed leaf, folded with the siblings of the true
    one: it equals root only where both are the same.
    """
    runs, at = manifest.runs, "x.at"
    lone = "size(children_of) = 1 and run_at = 0"
    start = runs.select(
        F.col("tree").alias("run_tree"), F.col("at").alias("run_at"), F.col("leaves").alias("children_of"), "children", "width",
        "hash", "up_tree", "up_level", "up_at", "up_place",
    ).select(
        "run_tree", "run_at",
        F.expr(f"transform(children_of, x -> if({lone}, x.claimed, {_with('children', at, 'x.claimed')}))").alias("folded"),
        F.expr("cast('' as binary)").alias("proof"), F.expr("if(width = 1, hash, null)").alias("subroot"),
        "hash", "up_tree", "up_level", "up_at", "up_place",
    )
    # the lowest level from which on all nodes together fit a broadcast
    wide = [level for level, n in enumerate(manifest.inner, 2) if n > settings.broadcast_nodes]
    cut = wide[-1] if wide else 0
    low = f"up_tree <> {TOP} and up_level <= {cut}"
    rows = _climbed(start, manifest.nodes, low, "", f"{name}-low") if wide else start
    high = f"(up_tree = {TOP} or up_level > {cut})"
    tops = manifest.nodes.where(f"tree = {TOP}").count()
    hint = "/*+ broadcast(n) */" if tops <= settings.broadcast_nodes else ""
    done = _climbed(rows, manifest.nodes, high, hint, f"{name}-high")
    met = runs.select("tree", "at", "leaves", "children").join(
        done.select(F.col("run_tree").alias("tree"), F.col("run_at").alias("at"), "folded", "proof", "subroot", F.col("hash").alias("root")), ["tree", "at"]
    )
    each = met.select("leaves", "children", "subroot", "root", "proof", F.posexplode("folded").alias("place", "folded_root"))
    return each.select(
        F.expr("leaves[place].id").alias("id"), F.expr("leaves[place].leaf").alias("leaf"), "subroot", "root",
        F.expr(f"concat({_without('children', 'place')}, proof)").alias("proof"), "folded_root",
    )


def tampered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 3) -> Column:
    """The text as tampering leaves it: A-Z in lower case where `modulus` divides the id's CRC-32."""
    hit = F.crc32(docs[id_col].cast("string").cast("binary")) % modulus == 0
    text = docs[text_col].cast("string")
    return F.when(hit, F.translate(text, UPPER, UPPER.lower())).otherwise(text)


def check_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Builds the manifest of a documents table and verifies every row after the tampering of `tampered`."""
    claimed = [tampered(docs) if c == "text" else docs[c] for c in FIELDS]
    manifest = build(docs, leaf_hash([docs[c] for c in FIELDS]), leaf_hash(claimed), settings=settings)
    return verify(manifest, settings)


def digest(found: DataFrame) -> DataFrame:
    def text(name: str) -> Column:
        return F.lower(F.hex(name)).alias(name)

    return found.select(
        F.col("id").alias("doc_id"), text("leaf"), text("subroot"), text("root"),
        F.sha2(F.lower(F.hex("proof")).cast("binary"), 256).alias("proof_sha256"), text("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def sql(fanout: int = 8, levels: int = 7, top_levels: int = 3) -> str:
    """DuckDB SQL for up to `fanout` ** `levels` rows of a group and `fanout` ** `top_levels` groups."""

    def fields(text: str) -> str:
        parts = [text if c == "text" else f"cast({c} as varchar)" for c in FIELDS]
        return "sha256(concat(" + ", ".join(f"coalesce(concat(cast(octet_length(encode({p})) as varchar), ':', {p}), '-')" for p in parts) + "))"

    low = f"case when {crc32('cast(doc_id as varchar)')} % 3 = 0 then translate(text, '{UPPER}', '{UPPER.lower()}') else text end"
    parts = [
        f"leaves as (select doc_id, lang, {fields('text')} as leaf, {fields(low)} as claimed from documents)",
        "t0 as (select doc_id, leaf, claimed, dense_rank() over (order by coalesce('=' || lang, '')) - 1 as tree, leaf as hash, claimed as folded, "
        "row_number() over (partition by lang order by doc_id nulls last, leaf) - 1 as pos, '' as proof from leaves)",
    ]

    def level(before: str, after: str, tree: str) -> list[str]:
        """Every leaf's row one level up: its node's hash, the folded hash, the siblings appended."""
        return [
            f"{after}n as (select {tree}, pos // {fanout} as up, max(many) as many, sha256(string_agg(hash, '' order by pos)) as hash, list(hash order by pos) as kids "
            f"from (select distinct {tree}, pos, hash, count(distinct pos) over (partition by {tree}) as many from {before}) group by all)",
            f"{after} as (select b.* replace (case when many = 1 then b.pos else b.pos // {fanout} end as pos, case when many = 1 then b.hash else n.hash end as hash, "
            f"case when many = 1 then folded else sha256(array_to_string(list_concat(kids[:b.pos % {fanout}], [folded], kids[b.pos % {fanout} + 2:]), '')) end as folded, "
            f"case when many = 1 then proof else proof || array_to_string(list_concat(kids[:b.pos % {fanout}], kids[b.pos % {fanout} + 2:]), '') end as proof) "
            f"from {before} b join {after}n n on n.{tree} = b.{tree} and n.up = b.pos // {fanout})",
        ]

    for k in range(levels):
        parts += level(f"t{k}", f"t{k + 1}", "tree")
    parts.append(f"u0 as (select * replace (tree as pos), hash as subroot, 0 as whole from t{levels})")
    for k in range(top_levels):
        parts += level(f"u{k}", f"u{k + 1}", "whole")
    return (
        "with " + ", ".join(parts) + " select doc_id, leaf, subroot, hash as root, sha256(proof) as proof_sha256, folded as folded_root, "
        f"folded = hash as verified from u{top_levels}"
    )
