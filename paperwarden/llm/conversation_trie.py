"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns. Peeling starts from the longest conversations: a conversation loses its
last turn again and again, and where its truncation is also one of a longer conversation, it is merged into that
survivor, with all that its own stripped turns have gathered. So every node has one survivor, the longest conversation
through it (the smallest id among equals); a conversation's own nodes are its last turns, from its end up to the turn
at which it meets a survivor; and what is stripped below a node is known once all merges are.

The rounds of the peeling do not wait for each other. Every conversation gives its truncations as one row a turn, with
a 128-bit key that is a running combination of its turns, so one grouping by key discovers all nodes with their
members, sizes and survivors. One row a conversation and survivor then tells the depth at which they meet, and running
totals along each survivor, from its end to the root, add up what its nodes and the merged conversations hold. Work
is in proportion to the turns whatever the depth, and neither a long conversation nor one shared by many is gathered:
places, keys and totals run over chunks of a conversation, and copies are counted.

Defined cases: turns are ordered by turn, nulls first, ties by role, then text; a null role or text counts as empty;
repeated rows are repeated turns; a row without a conversation id belongs to no conversation and is left out; an empty
table has no conversation and no node. Texts and roles are compared whole, by a 128-bit key. Columns beyond the named
ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from paperwarden.operators.ranks import rank_rows, running
from paperwarden.operators.scale import Workspace, workspace

#: Ids joined in one string before they are hashed.
ID_CHUNK = 1024


def turn_rows(turns: DataFrame, work: Workspace, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv, place, bytes, a, b): each turn's place from 0, the bytes of its text and two digests of role and text."""
    said = turns.select(turns[id_col].cast("long").alias("conv"), turns[turn_col].alias("turn"),
                        F.coalesce(turns[role_col], F.lit("")).alias("role"),
                        F.coalesce(turns[text_col], F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    said = said.where("conv IS NOT NULL").withColumn("digest", F.sha2(F.concat(
        F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    placed = rank_rows(said, ["conv"], ["turn", "role", "text", "row"], work, "place")
    return work.table(placed.select("conv", "place", F.octet_length("text").cast("long").alias("bytes"),
                                    *[F.xxhash64(F.lit(seed), "digest").alias(seed) for seed in ("a", "b")]))


def rebuild(turns: DataFrame, conversations: DataFrame, family: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are replaced by those of another.

    ``turns`` as of ``turn_rows`` and ``conversations`` (conv, n). The first ``head`` turns of a conversation (of all, if
    it has fewer) become the first ``head`` turns of conversation ``family``; both are expressions of ``conv``. Returns
    the turns and (conv, n) of all conversations, with n = 0 for those left without turns.
    """
    told = conversations.select("conv", "n", family.alias("family"), head.cast("long").alias("head"))
    first = conversations.select(F.col("conv").alias("family"), F.col("n").alias("family_n"))
    told = told.join(first, "family", "left").select(
        "conv", "family", "head", "n", F.least("head", F.coalesce("family_n", F.lit(0))).alias("taken"))
    told = told.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    longest = told.agg(F.max("head")).first()[0] or 0
    own = turns.join(told.select("conv", "head", "taken"), "conv").where("place >= head").select(
        "conv", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "bytes", "a", "b")
    # A family is as large as the table makes it, the turns taken from it are few.
    heads = turns.where(F.col("place") < longest).withColumnRenamed("conv", "family")
    lent = told.where("taken > 0").select("conv", "family", "taken").join(heads, "family").where("place < taken").select(
        "conv", "place", "bytes", "a", "b")
    return own.unionByName(lent), told.select("conv", F.col("length").alias("n"))


def truncations(turns: DataFrame, work: Workspace) -> DataFrame:
    """(conv, depth, bytes, k1, k2): every conversation cut after each of its turns; (k1, k2) tells the sequence."""
    placed = turns.select("conv", (F.col("place") + 1).alias("depth"), "bytes",
                          F.xxhash64("place", "a", F.lit(1), "b").alias("x"), F.xxhash64("b", F.lit(2), "place", "a").alias("y"))
    found = running(placed, "conv", "depth", {"k1": F.col("x"), "k2": F.col("y")}, work, xor=True)
    return work.table(found.select("conv", "depth", "bytes", "k1", "k2"))


def ends_digest(ends: DataFrame, work: Workspace) -> DataFrame:
    """(depth, k1, k2, ends_sha256): digest of the ids of ``ends`` (depth, k1, k2, conv), ascending, joined by commas.

    Ids are joined in chunks; the chunks of a node are hashed one after the other as they come, none is gathered.
    """
    node = ["depth", "k1", "k2"]
    placed = rank_rows(ends.select(*node, "conv"), node, ["conv"], work, "place")
    chunks = placed.groupBy(*node, F.expr(f"place div {ID_CHUNK}").alias("chunk")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = chunks.repartition(*node).sortWithinPartitions(*node, "chunk").select(*node, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, done = None, None, []
        for batch in batches:
            for *key, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if key == last:
                    state.update(b",")
                else:
                    if last:
                        done.append((*last, state.hexdigest()))
                    last, state = key, hashlib.sha256()
                state.update(ids.encode())
            if len(done) > 10_000:
                yield _rows(done)
                done = []
        if last:
            done.append((*last, state.hexdigest()))
        yield _rows(done)

    return ordered.mapInArrow(run, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    names = ["depth", "k1", "k2", "ends_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def build_trie(turns: DataFrame, conversations: DataFrame, work: Workspace) -> DataFrame:
    """One row a node of the conversations (conv, n) with their ``turns`` (conv, place, bytes, a, b).

    conv_id is the smallest member, parent_conv_id the parent's; n_convs counts members, n_children and n_leaves nodes;
    saved_tokens adds up, over the subtree, the bytes of a node's last text for every member but one; ends_sha256 is the
    digest of the members that end here.
    """
    node = ["depth", "k1", "k2"]
    cut = truncations(turns, work)
    conversations = work.table(conversations)
    root = conversations.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.min(
        F.struct((-F.col("n")).alias("length"), "conv")).alias("survivor")).first()
    zero = F.lit(0).cast("long")

    # Discover: all truncations that agree are one node.
    named = cut.join(conversations, "conv")
    found = named.groupBy(*node).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.max("bytes").alias("bytes"),
        F.min(F.struct((-F.col("n")).alias("length"), "conv")).alias("s"))
    nodes = work.table(found.select(*node, "n_convs", "conv_id", "bytes", F.col("s.conv").alias("survivor")))
    at_root = conversations.where("n = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv")
    ends = ends_digest(named.where("depth = n").select(*node, "conv").unionByName(at_root), work)

    # Merge: where each conversation meets the survivors on its way to the root.
    stats = nodes.select(*node, "survivor", "conv_id")
    way = work.table(cut.select("conv", *node).join(stats, node).select("conv", "depth", "survivor", "conv_id"))
    meets = way.where("conv <> survivor").groupBy("conv", "survivor").agg(F.max("depth").alias("depth"))
    if root["survivor"] is not None:
        top = F.lit(root["survivor"]["conv"])
        every = conversations.select("conv", top.alias("survivor"), zero.alias("depth")).where(F.col("conv") != F.col("survivor"))
        meets = meets.unionByName(every).groupBy("conv", "survivor").agg(F.max("depth").alias("depth"))
    own = nodes.select(F.col("survivor").alias("conv"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    tails = work.table(own.groupBy("conv").agg(F.sum("saved").alias("tail_saved")))
    merged = work.table(meets.join(tails, "conv"))  # conversations without nodes of their own bring nothing
    last = merged.groupBy("conv").agg(F.max("depth").alias("depth"), F.max_by("survivor", "depth").alias("survivor"))
    brought = merged.groupBy("survivor", "depth").agg(F.count(F.lit(1)).alias("leaves"), F.sum("tail_saved").alias("saved"))
    children = last.groupBy("survivor", "depth").agg(F.count(F.lit(1)).alias("joined"))

    # Strip: totals along each survivor from its end to the root.
    lines = nodes.select(*node, "n_convs", "conv_id", "bytes", "survivor")
    if root["survivor"] is not None:
        begin = conversations.where(F.col("conv") == root["survivor"]["conv"]).select(
            zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(root["n_convs"]).alias("n_convs"),
            F.lit(root["conv_id"]).alias("conv_id"), zero.alias("bytes"), F.col("conv").alias("survivor"))
        lines = lines.unionByName(begin)
    lines = (lines.join(brought, ["survivor", "depth"], "left").join(children, ["survivor", "depth"], "left")
             .join(conversations.withColumnRenamed("conv", "survivor"), "survivor"))
    totals = running(lines, "survivor", "depth", {
        "merged_leaves": F.coalesce("leaves", zero),
        "saved_tokens": F.coalesce("saved", zero) + (F.col("n_convs") - 1) * F.col("bytes")}, work, backwards=True)
    parent = way.select(F.col("conv").alias("survivor"), (F.col("depth") + 1).alias("depth"),
                        F.col("conv_id").alias("parent_conv_id"))
    above = F.when(F.col("depth") == 1, F.lit(root["conv_id"]).cast("long")).otherwise(F.col("parent_conv_id"))
    told = totals.join(parent, ["survivor", "depth"], "left").join(ends, node, "left")
    return told.select(
        "conv_id", "depth", above.alias("parent_conv_id"), "n_convs",
        (F.coalesce("joined", zero) + (F.col("depth") < F.col("n")).cast("long")).alias("n_children"),
        (F.col("merged_leaves") + 1).alias("n_leaves"), "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", rebuilt: Callable[[Column], tuple[Column, Column]] | None = None) -> DataFrame:
    """The trie of all conversations of a table of turns.

    ``rebuilt`` maps the column of conversation ids to the id of another conversation and a number of turns; each
    conversation then starts with so many first turns of that one instead of its own.
    """
    work = workspace(turns.sparkSession)
    rows = turn_rows(turns, work, id_col, turn_col, role_col, text_col)
    conversations = work.table(rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n")))
    if rebuilt:
        rows, conversations = rebuild(rows, conversations, *rebuilt(F.col("conv")))
    return build_trie(rows, conversations, work)
