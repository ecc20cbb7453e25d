"""Merkle manifest of a dataset by slot pivots.

Every row is a leaf: the SHA-256 of its fields, each written as its length and value. The leaves of a group stand in
order of their ids; every ``FANOUT`` neighbours make a parent, level by level up to the group's root, and the groups'
roots, in order of the group, make the dataset's root the same way.

A level is one grouping by parent: conditional aggregates spread its children into ``FANOUT`` slot columns. The slots
joined together hash to the parent; the same columns without a child's own are that child's siblings, those before it
and those after it. Going down again, each parent hands its own path to its children, so a leaf's proof is the list of
its siblings from its run up to the root. A level has an eighth of the rows below it, so all work is in proportion to
the leaves; the places of leaves come from a sort by ranges, so a group may hold any share of the rows.

Defined cases: a null field is written ``-``; null groups come first, as one group, and null ids first in their group;
rows with one id stand in order of their leaves; equal rows are leaves of their own; texts are hashed whole; an empty
table gives an empty result. Columns beyond the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from paperwarden.operators.ranks import rank_rows
from paperwarden.operators.scale import Workspace, broadcast_if_small, workspace

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def row_digest(values: Sequence[Column]) -> Column:
    """Digest of the values of one row."""
    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(told, values)), 256)


def _slots(without: int | None = None, after: bool | None = None) -> Column:
    """The digests of a parent's children in one string: all, or those before or after one slot."""
    wanted = [k for k in range(FANOUT) if without is None or (k > without if after else k < without)]
    return F.concat_ws("", *[F.col(f"s{k}")["digest"] for k in wanted]) if wanted else F.lit("")


def _parents(nodes: DataFrame) -> DataFrame:
    """(tree, n, pos, s0, s1, ..., digest): one row a run of ``FANOUT`` nodes (tree, n, pos, node)."""
    slot = F.col("pos") % FANOUT
    runs = nodes.where("n > 1").groupBy("tree", "n", F.expr(f"pos div {FANOUT}").alias("pos")).agg(
        *[F.max(F.when(slot == k, F.col("node"))).alias(f"s{k}") for k in range(FANOUT)])
    return runs.withColumn("digest", F.sha2(_slots(), 256)).withColumn("n", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}"))


def _climb(nodes: DataFrame, most: int, work: Workspace) -> tuple[list[DataFrame], DataFrame]:
    """All levels above ``nodes``, and the root of every tree (tree, level, digest); ``most`` nodes in one tree."""
    levels: list[DataFrame] = []
    tops = [nodes.where("n = 1").select("tree", F.lit(0).alias("level"), "node.digest")]
    while most > 1:
        level = work.table(_parents(nodes))
        levels.append(level)
        nodes = level.select("tree", "n", "pos", F.struct("digest").alias("node"))
        tops.append(level.where("n = 1").select("tree", F.lit(len(levels)).alias("level"), "digest"))
        most = -(-most // FANOUT)
    return levels, reduce(DataFrame.unionByName, tops)


def _descend(levels: list[DataFrame], leaves: DataFrame, starts: DataFrame, kept: list[str]) -> DataFrame:
    """(node, path, *kept) of every leaf, from ``starts`` (tree, level, path, *kept) at the roots of the trees."""
    def begun(level: int) -> DataFrame:
        return starts.where(F.col("level") == level).select("tree", F.lit(0).cast("long").alias("pos"), "path", *kept)

    above = None
    for number in range(len(levels), 0, -1):
        paths = begun(number) if above is None else above.unionByName(begun(number))
        child = F.filter(F.array(*[F.struct(
            F.lit(k).alias("slot"), F.col(f"s{k}").alias("node"),
            F.struct(_slots(k, False).alias("left"), _slots(k, True).alias("right")).alias("siblings"))
            for k in range(FANOUT)]), lambda c: c["node"].isNotNull())
        told = levels[number - 1].join(paths, ["tree", "pos"]).select("tree", "pos", "path", *kept, F.explode(child).alias("c"))
        above = told.select("tree", (F.col("pos") * FANOUT + F.col("c.slot")).alias("pos"), F.col("c.node").alias("node"),
                            F.concat(F.array("c.siblings"), "path").alias("path"), *kept)
        if number > 1:
            above = above.drop("node")
    alone = leaves.where("n = 1").join(begun(0), ["tree", "pos"]).select("node", "path", *kept)
    return alone if above is None else above.select("node", "path", *kept).unionByName(alone)


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
                    carry: dict[str, Column] | None = None) -> DataFrame:
    """Id, ``leaf``, ``subroot``, ``root`` and ``path`` of every row, and the columns of ``carry``.

    ``path`` lists, from the leaf's run to the root, the digests of its siblings before it and after it, each side as
    one string. ``carry`` maps names to expressions over ``docs`` that travel with the leaf, such as another copy's
    digest that is to be held against the manifest.
    """
    carry, work = carry or {}, workspace(docs.sparkSession)
    leaves = work.table(docs.select(
        docs[id_col].alias("id"), docs[group_col].alias("group"), row_digest([docs[f] for f in fields]).alias("leaf"),
        *[value.alias(f"carry_{name}") for name, value in carry.items()], F.monotonically_increasing_id().alias("row")))
    placed = work.table(rank_rows(leaves, ["group"], ["id", "leaf", "row"], work, "pos"))
    groups = placed.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    groups = work.table(rank_rows(groups, [], ["group"], work, "tree"))
    many, most = groups.agg(F.count(F.lit(1)), F.max("n")).first()

    node = F.struct(F.col("leaf").alias("digest"), "id", *[f"carry_{name}" for name in carry])
    named = broadcast_if_small(groups.withColumnRenamed("group", "of"))
    nodes = placed.join(named, F.col("group").eqNullSafe(F.col("of"))).select("tree", "n", "pos", node.alias("node"))
    nodes = work.table(nodes)
    work.drop(leaves, placed)
    levels, tops = _climb(nodes, most or 0, work)

    heads = work.table(tops.select(F.lit(0).cast("long").alias("tree"), F.lit(many).alias("n"), F.col("tree").alias("pos"),
                                   F.struct("digest", F.col("tree").alias("of"), "level").alias("node")))
    head_levels, head_top = _climb(heads, many, work)
    begin = head_top.select("tree", "level", F.expr(f"CAST(array() AS {PATH})").alias("path"), F.col("digest").alias("root"))
    starts = work.table(_descend(head_levels, heads, begin, ["root"]).select(
        F.col("node.of").alias("tree"), "node.level", "path", F.col("node.digest").alias("subroot"), "root"))
    found = _descend(levels, nodes, starts, ["subroot", "root"])
    return found.select(F.col("node.id").alias(id_col), F.col("node.digest").alias("leaf"), "subroot", "root", "path",
                        *[F.col(f"node.carry_{name}").alias(name) for name in carry])


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """One digest of all siblings on a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)
