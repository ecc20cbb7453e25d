"""Exact Jaccard join of documents on word shingles through a token-group matrix.

A document's set holds the hashes of its distinct runs of ``SHINGLE`` words. Two documents are linked if
100 * intersection >= ``PERCENT`` * union; the join gives every document the smallest id reachable by links.

1. Documents with equal sets are one class; one of them stands for it from here on, under a number of its own.
2. Of every set the first tokens in order of their hashes are its *pool*: the ``m + 1`` of the prefix filter, m being
   how many tokens of it a linked set may lack, and ``k`` more. A linked pair shares at least k + 1 tokens of the pool
   that ends first, and these lie in the other pool as well. So a set that has fewer pool tokens in common with others
   than any partner would need is linked with nothing. Most sets leave here; the others' whole sets are read once.
3. Similar documents are put into groups of at most ``GROUP``: documents sharing a minimum hash stand together in a
   range-partitioned order and are cut into blocks, in ``ORDERS`` different orders. All pairs inside a block are
   verified at once, and linked documents of a block of the first order are a group. This joins nearly all that
   belongs together, at a cost linear in the size of any crowd of copies.
4. Documents stay that have four fifths of their whole sets in other components' documents. The token-group matrix
   holds, for each group, the union of its members' pool tokens that stand in several
   components. A document with c such tokens asks by its c - k rarest ones only, as one of them must be shared, and a
   group is met by the rarest ones of its members only, for the same reason: at the first token that both have, either
   side must have k others left. How many follows from both sizes. They meet at the first such token, not at each. The
   groups met are held to the bound of step 2 with all of their union.
5. Groups that pass are opened: the document is checked against the union of their whole sets, then against each
   member. Every group opens the most promising ones first, in rounds of 1, 2, 4, ...; what a round connects is one
   component in the next, whose inner pairs need no opening. So a crowd of many groups is never opened pair by pair.

Steps 4 and 5 miss nothing, whatever step 3 left unlinked. No step lists the pairs of a component.

Defined cases: null, empty and word-less texts have empty sets and are linked with nothing; texts of fewer words than
a shingle are one shingle of all their words; texts are read whole, whatever their length; rows without an id are known
by a hash of their text behind all other ids, and have a null class if no row with an id is in it; repeated rows are
members of the same class, and unlike texts under one id are documents of their own; an empty table gives an empty
result. Columns beyond the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from paperwarden.llm.batches import SLICE, WordHashes
from paperwarden.llm.components import components
from paperwarden.operators.scale import Workspace, broadcast_if_small, workspace

SHINGLE = 5
PERCENT = 80
GROUP = 32
ORDERS = 3
#: While tokens stand in more components than this, documents that have too few shared tokens are dropped again.
HOT_CLASSES = 24
#: Sets of so many tokens have all of them in their pool.
KEPT_WHOLE = 192
#: Rarest tokens by which a document and a group know that they have met at an earlier token.
FIRST = 16
#: Documents that ask a group at a time.
ASKING = 128
#: Ids from here on stand for rows without one.
NO_ID = 1 << 62

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = [np.uint64(x) for x in (0, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The set of a text as sorted 64-bit hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.int64)
    word = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    length = min(SHINGLE, len(words))
    rolling = np.full(len(words) - length + 1, length, np.uint64)
    for i in range(length):
        rolling = rolling * _STEP + word[i:len(words) - length + 1 + i]
    return np.unique(_mixed(rolling).view(np.int64))


def _least_shared(n):
    """What a set of n must share with any set it is linked to."""
    return (PERCENT * n + 99) // 100


def _prefix(n):
    return n - _least_shared(n) + 1


def _kept(n: int) -> int:
    """Tokens in the pool of a set: its prefix and some more; all of a small set."""
    return min(n, max(KEPT_WHOLE, _prefix(n) + n // 10))


def _need(n):
    """Pool tokens that a set of n shares with any set it is linked to whose pool ends no sooner."""
    kept = np.minimum(n, np.maximum(KEPT_WHOLE, _prefix(n) + n // 10))
    return kept - _prefix(n) + 1


def _least_need(n: int) -> int:
    """Pool tokens that a set of n shares with any set it is linked to: the least that a partner of any size needs."""
    return int(_need(np.arange(_least_shared(n), 100 * n // PERCENT + 1)).min())


def _wanted(n: Column, need: Column, least_n: Column) -> Column:
    """``need`` of a set of n, if its partner has ``least_n`` tokens or more: what two sets must share grows with both."""
    shared = F.floor((PERCENT * (n + least_n) + 99 + PERCENT) / (100 + PERCENT))
    return need + F.greatest(shared - F.floor((PERCENT * n + 99) / 100), F.lit(0))


def token_sets(texts: pa.Array) -> list[np.ndarray]:
    """``shingles`` of all texts of a column."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, starts = split.values, split.offsets.to_numpy()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(real)])[starts]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    named = coded.dictionary.to_numpy(zero_copy_only=False)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, named), np.uint64, len(named))[coded.indices.to_numpy()]

    def rolled(words: np.ndarray, length: int) -> np.ndarray:
        rolling = np.full(max(0, len(words) - length + 1), length, np.uint64)
        for i in range(length):
            rolling = rolling * _STEP + words[i:i + len(rolling)]
        return _mixed(rolling).view(np.int64)

    whole = rolled(word, SHINGLE)
    return [np.unique(whole[a:b - SHINGLE + 1] if b - a >= SHINGLE else rolled(word[a:b], b - a)) if b > a
            else np.empty(0, np.int64) for a, b in zip(starts[:-1], starts[1:])]


def _to_lists(sets: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits that stand for each set, and the smallest of its hashes in ``ORDERS`` orders, as columns."""
    made = np.zeros((2 + ORDERS, len(sets)), np.int64)
    some = np.array([k for k, s in enumerate(sets) if len(s)], np.int64)
    if len(some):
        values = np.concatenate([sets[k] for k in some]).view(np.uint64)
        first = np.concatenate([[0], np.cumsum([len(sets[k]) for k in some])[:-1]])
        made[0, some] = np.add.reduceat(_mixed(values * _STEP), first).view(np.int64)
        made[1, some] = np.bitwise_xor.reduceat(_mixed(values + _STEP), first).view(np.int64)
        for r, seed in enumerate(_SEEDS[:ORDERS]):
            made[2 + r, some] = np.minimum.reduceat(_mixed(values ^ seed), first).view(np.int64)
    return made


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least_needs = {0: 0}
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            sets = token_sets(part.column(1))
            sizes = np.array([len(s) for s in sets], np.int64)
            least_needs.update((n, _least_need(n)) for n in {*sizes.tolist()} - least_needs.keys())
            needs = [least_needs[n] for n in sizes.tolist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes), pa.array(_need(sizes)), pa.array(needs, pa.int64()),
                 *map(pa.array, _signatures(sets)), _to_lists([s[:_kept(len(s))] for s in sets])],
                names=["row", "n", "need", "least_need", "sig_a", "sig_b", *(f"least_{r}" for r in range(ORDERS)), "pool"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut rows in order into blocks of equal minimum hash and compatible size; blocks of one are left out."""
    made: list[tuple[int, int, int]] = []
    block: list[int] = []
    key, least = None, 0

    def close():
        if len(block) > 1:
            made.extend((key[0], block[0], i) for i in block)
        block.clear()

    def batch_of():
        columns = list(zip(*made)) or [()] * 3
        made.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["r", "block", "id"])

    for batch in batches:
        for r, hashed, n, i in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (r, hashed) or len(block) == GROUP or 100 * least < PERCENT * n:
                close()
                key, least = (r, hashed), n
            block.append(i)
        yield batch_of()
    close()
    yield batch_of()


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    found = []
    for chunk in column.chunks:
        flat, offsets = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        found += [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    return found


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs, from the tokens that occur twice or more."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.concatenate(([True], tokens[1:] != tokens[:-1]))
    token = np.cumsum(new) - 1
    often = np.bincount(token) > 1
    column = np.cumsum(often) - 1
    keep = often[token]
    held = np.zeros((len(sets), int(often.sum())), np.float32)
    held[owner[keep], column[token[keep]]] = 1
    return np.rint(held @ held.T).astype(np.int64)


def _link_block(table: pa.Table) -> pa.Table:
    """Verify all pairs of a block; every linked document points to the first of its part."""
    sets = dict(zip(table.column("id").to_pylist(), _lists(table.column("tokens"))))
    names = sorted(sets)
    leader = {i: i for i in names}
    if len(names) > 1:
        sizes = np.array([len(sets[i]) for i in names])
        shared = _overlaps([sets[i] for i in names])
        linked = 100 * shared >= PERCENT * (sizes[:, None] + sizes[None, :] - shared)
        np.fill_diagonal(linked, True)
        part = np.arange(len(names))
        while True:
            lower = np.where(linked, part[None, :], len(names)).min(axis=1)
            if (lower == part).all():
                break
            part = lower
        leader = {i: names[p] for i, p in zip(names, part)}
    r = table.column("r")[0].as_py()
    found = [(r, i, to) for i, to in leader.items() if i != to]
    columns = list(zip(*found)) or [()] * 3
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["r", "id", "leader"])


def _open_group(table: pa.Table) -> pa.Table:
    """(a, b): classes of asking documents that are linked to a member of a group, and the group's class."""
    asking = np.array(table.column("asking").to_pylist(), bool)
    sets, classes = _lists(table.column("tokens")), table.column("class_id").to_pylist()
    members = [sets[k] for k in np.flatnonzero(~asking)]
    group = {classes[k] for k in np.flatnonzero(~asking)}
    union = np.unique(np.concatenate([np.empty(0, np.int64), *members]))
    found = set()
    for k in np.flatnonzero(asking):
        query = sets[k]
        if classes[k] in found or not len(union):
            continue
        places = np.minimum(np.searchsorted(union, query), len(union) - 1)
        if (union[places] == query).sum() < _least_shared(len(query)):
            continue
        for other in members:
            if 100 * min(len(query), len(other)) < PERCENT * max(len(query), len(other)):
                continue
            shared = len(np.intersect1d(query, other, assume_unique=True))
            if 100 * shared >= PERCENT * (len(query) + len(other) - shared):
                found.add(classes[k])
                break
    return pa.table({"a": pa.array(sorted(found), pa.int64()), "b": pa.array([*group] * len(found), pa.int64())})


def _groups(reps: DataFrame, sets: DataFrame, work: Workspace) -> DataFrame:
    """Links (r, id, leader) found inside blocks of similar documents."""
    # The first order keeps sizes together. The others deal the documents of like size anew, so that the blocks of a
    # large crowd overlap at random and connect it.
    size_class = F.floor(F.log("n") * 8)
    orders = F.explode(F.array(*[F.struct(
        F.lit(r).cast("long").alias("r"), F.col(f"least_{r}").alias("hashed"), (size_class if r else F.col("n")).alias("like"),
        (F.xxhash64("id", F.lit(r)) if r else F.col("id")).alias("dealt")) for r in range(ORDERS)]))
    by = ["r", "hashed", "like", "dealt"]
    rows = reps.select(orders.alias("o"), "n", "id").select("o.r", "o.hashed", "o.like", "o.dealt", "n", "id")
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("r", "hashed", "n", "id")
    members = work.table(ordered.mapInArrow(_blocks, "r bigint, block bigint, id bigint"))
    read = sets.join(members, "id").select("r", "block", "id", "tokens")
    links = work.table(read.groupBy("r", "block").applyInArrow(_link_block, "r bigint, id bigint, leader bigint"))
    work.drop(members)
    return links


def _shared(rows: DataFrame, work: Workspace) -> DataFrame:
    """The rows (id, token) whose token two or more documents have."""
    often = work.table(rows.groupBy("token").agg(F.min("id").alias("low"), F.max("id").alias("high")).where(
        "low < high").select("token"))
    found = work.table(rows.join(often, "token"))
    work.drop(often)
    return found


def _with_enough(rows: DataFrame, info: DataFrame, work: Workspace) -> DataFrame:
    """(id, c): documents with as many rows in ``rows`` as any link needs, and how many they have."""
    counts = rows.groupBy("id").agg(F.count(F.lit(1)).alias("c"))
    return work.table(counts.join(info.select("id", "least_need"), "id").where("c >= least_need").select("id", "c"))


def _active(matrix: DataFrame, info: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """The rows of documents that have enough tokens in common with others, and these documents (id, c)."""
    for again in (True, False):
        enough = _with_enough(matrix, info, work)
        rows = matrix.join(broadcast_if_small(enough.select("id")), "id", "left_semi")
        before, matrix = matrix, _shared(rows, work) if again else work.table(rows)
        work.drop(before)
    return matrix, enough


def _crossing(matrix: DataFrame, info: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """The rows (id, token, class_id, classes) whose token stands in several components, of documents that have enough
    of them, and these documents (id, c).

    Documents that leave make other tokens rarer, so they are counted again while many leave and frequent tokens stay.
    """
    named = work.table(matrix.join(info.select("id", "class_id"), "id"))
    while True:
        tokens = work.table(named.select("token", "class_id").distinct().groupBy("token").agg(
            F.count(F.lit(1)).alias("classes")).where("classes > 1"))
        crossing = work.table(named.join(tokens, "token"))
        enough = _with_enough(crossing, info, work)
        kept = work.table(crossing.join(broadcast_if_small(enough.select("id")), "id", "left_semi"))
        most = tokens.agg(F.max("classes")).first()[0] or 0
        stay, were = enough.count(), crossing.select("id").distinct().count()
        work.drop(named, crossing, tokens)
        if most <= HOT_CLASSES or 10 * stay >= 9 * were:
            return kept, enough
        named = kept.drop("classes")
        named.written_to = kept.written_to


def _mostly_shared(enough: DataFrame, sets: DataFrame, info: DataFrame, work: Workspace) -> DataFrame:
    """The documents (id, c) of ``enough`` whose whole sets have what a link needs in other components' sets."""
    rows = work.table(sets.join(broadcast_if_small(enough.select("id")), "id", "left_semi").select(
        "id", F.explode("tokens").alias("token")).join(info.select("id", "class_id"), "id"))
    tokens = rows.groupBy("token").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).where("low < high")
    counts = rows.join(work.table(tokens.select("token")), "token").groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
    wanted = counts.join(info.select("id", "n"), "id").where(100 * F.col("shared") >= PERCENT * F.col("n")).select("id")
    found = work.table(enough.join(wanted, "id"))
    work.drop(rows)
    return found


def _candidates(info: DataFrame, crossing: DataFrame, enough: DataFrame, work: Workspace) -> DataFrame:
    """(id, unit_a, class_a, unit_b, class_b, place): documents and the groups of other components that their bound
    lets through, numbered from 1 for each asking group, the most promising first."""
    known = info.select("id", "unit", "class_id", "n", "need", "least_need", "end").join(enough.select("id"), "id")
    # Tokens in order of rarity; no more of them than a pool has.
    own = crossing.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("classes", "token"))).alias("own"))
    docs = work.table(known.join(own, "id"))

    def rarest(need: str) -> Column:
        return F.posexplode(F.slice("own", F.lit(1), F.greatest(F.size("own") - F.col(need) + 1, F.lit(0)).cast("int")))

    left = (F.size("own") - F.col("place")).alias("left")
    asked = docs.select("*", rarest("need").alias("place", "key")).select(
        "key.token", "id", F.col("unit").alias("unit_a"), F.col("class_id").alias("class_a"), "n", "need", "end", left,
        F.slice(F.col("own")["token"], F.lit(1), F.least(F.col("place"), F.lit(FIRST))).alias("before"))
    held = docs.select("unit", "own", rarest("least_need").alias("place", "key")).select("unit", "key", left).groupBy(
        "unit", "key").agg(F.max("left").alias("left"))
    # Of what a token leaves behind it in a group, no less than of any later token, so that a pair that may meet at a
    # token may meet at every earlier one that both have.
    later = Window.partitionBy("unit").orderBy(F.desc("key.classes"), F.desc("key.token")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    held = work.table(held.withColumn("left", F.max("left").over(later)))
    units = docs.groupBy("unit").agg(F.min("class_id").alias("class_b"), F.min("n").alias("least_n"),
                                     F.max("n").alias("most_n"), F.max("end").alias("last_end"))
    firsts = held.groupBy("unit").agg(F.slice(F.array_sort(F.collect_list("key")), 1, FIRST).alias("first"))
    groups = held.join(units.join(firsts, "unit"), "unit").select(
        "key.token", F.col("unit").alias("unit_b"), "class_b", "least_n", "most_n", "last_end", F.col("left").alias("left_b"),
        F.filter("first", lambda k: k < F.col("key"))["token"].alias("before_b"))
    fit = (100 * F.col("most_n") >= PERCENT * F.col("n")) & (PERCENT * F.col("least_n") <= 100 * F.col("n"))
    req = _wanted(F.col("n"), F.col("need"), F.col("least_n"))
    meet = ((F.col("class_a") != F.col("class_b")) & (F.col("end") <= F.col("last_end")) & fit & (F.col("left") >= req)
            & (F.col("left_b") >= req) & ~F.arrays_overlap("before", "before_b"))
    met = work.table(asked.join(groups, "token").where(meet).select(
        "id", "unit_a", "class_a", "unit_b", "class_b", req.alias("req")).distinct())
    unions = docs.select(F.col("unit").alias("unit_b"), F.explode(F.col("own")["token"]).alias("token")).groupBy("unit_b").agg(
        F.collect_set("token").alias("held"))
    bounded = met.join(docs.select("id", F.col("own")["token"].alias("own")), "id").join(unions, "unit_b").withColumn(
        "shared", F.size(F.array_intersect("own", "held")))
    best = Window.partitionBy("unit_a").orderBy(F.desc("shared"), "unit_b", "id")
    found = work.table(bounded.where("shared >= req").withColumn("place", F.row_number().over(best)).select(
        "id", "unit_a", "class_a", "unit_b", "class_b", "place"))
    work.drop(docs, held, met)
    return found


def _opened(opened: DataFrame, info: DataFrame, sets: DataFrame, work: Workspace) -> DataFrame:
    """Links (a, b) between classes from opening groups (unit_b) for documents (id) of other classes."""
    parts = opened.groupBy("unit_b").agg(F.expr(f"(count(*) + {ASKING - 1}) div {ASKING}").alias("parts"))
    parts = work.table(parts)
    queries = opened.join(parts, "unit_b").select("unit_b", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), "id",
                                                  F.col("class_a").alias("class_id"), F.lit(True).alias("asking"))
    members = parts.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).join(
        info.select(F.col("unit").alias("unit_b"), "id", "class_id"), "unit_b").select(
        "unit_b", "part", "id", "class_id", F.lit(False).alias("asking"))
    asked = work.table(queries.unionByName(members))
    read = sets.join(asked, "id").select("unit_b", "part", "class_id", "asking", "tokens")
    links = work.table(read.groupBy("unit_b", "part").applyInArrow(_open_group, "a bigint, b bigint"))
    work.drop(parts, asked)
    return links


def _links_across(candidates: DataFrame, info: DataFrame, sets: DataFrame, work: Workspace) -> DataFrame | None:
    """(id, class_id): classes of ``info`` (id) that belong to one component with others, and that component."""
    last = candidates.agg(F.max("place")).first()[0] or 0
    links, merged, start = None, None, 1
    while start <= last:
        turn = candidates.where(F.col("place").between(start, 2 * start - 1))
        if merged is not None:
            for side in "ab":
                label = merged.select(F.col("id").alias(f"class_{side}"), F.col("class_id").alias(f"now_{side}"))
                turn = turn.join(label, f"class_{side}", "left").withColumn(
                    f"now_{side}", F.coalesce(f"now_{side}", f"class_{side}"))
            turn = turn.where("now_a <> now_b")
        turn = work.table(turn.select("id", "class_a", "unit_b"))
        found = _opened(turn, info, sets, work)
        work.drop(turn)
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            merged = components(links, work)
        start *= 2
    return merged


def _row_classes(docs: DataFrame, id_col: str, text_col: str, work: Workspace) -> DataFrame:
    """Row id (see ``row_id``), n and class_id of every row of ``docs``."""
    texts = docs.select(row_id(docs, id_col, text_col).alias("row"), docs[text_col].alias("text"))
    least = [f"least_{r}" for r in range(ORDERS)]
    sketch = work.table(texts.mapInArrow(_sketch, "row bigint, n bigint, need bigint, least_need bigint, sig_a bigint, "
                                         "sig_b bigint, " + "".join(f"{c} bigint, " for c in least) + "pool array<bigint>")
                        .withColumn("id", F.monotonically_increasing_id()))
    rows = work.table(sketch.select("row", "n", "sig_a", "sig_b", "id"))
    # Unlike texts may share an id, so a set is known by the number of its first row.
    firsts = work.table(rows.where("n > 0").groupBy("sig_a", "sig_b").agg(F.min(F.struct("row", "id")).alias("f")).select(
        "sig_a", "sig_b", F.col("f.id").alias("id")))
    reps = work.table(sketch.join(broadcast_if_small(firsts.select("id")), "id", "left_semi"))
    work.drop(sketch)
    narrow = work.table(reps.select("id", "row", "sig_a", "sig_b", "n", "need", "least_need", *least,
                                    F.element_at("pool", -1).alias("end")))
    matrix, enough = _active(_shared(reps.select("id", F.explode("pool").alias("token")), work), narrow, work)
    work.drop(reps)
    active = work.table(narrow.join(enough.select("id"), "id"))
    wanted = broadcast_if_small(active.select("id", "row", "sig_a", "sig_b"))
    sets = work.table(texts.join(wanted, "row").select("id", "sig_a", "sig_b", "text").mapInArrow(
        _whole_sets, "id bigint, tokens array<bigint>").dropDuplicates(["id"]))

    inside = _groups(active, sets, work)
    links = inside.select(F.col("id").alias("a"), F.col("leader").alias("b"))
    classes = components(links, work)
    leaders = inside.where("r = 0").select("id", F.col("leader").alias("unit"))
    units = work.table(leaders.unionByName(leaders.select(F.col("unit").alias("id"), "unit").distinct()))
    info = work.table(active.join(classes, "id", "left").join(units, "id", "left").select(
        "id", "n", "need", "least_need", "end", F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("unit", "id").alias("unit")))
    crossing, enough = _crossing(matrix, info, work)
    work.drop(matrix)
    enough = _mostly_shared(enough, sets, info, work)
    candidates = _candidates(info, crossing, enough, work)
    merged = _links_across(candidates, info, sets, work)
    work.drop(crossing, sets, candidates)

    found = info.select("id", "class_id")
    if merged is not None:
        found = found.join(merged.select(F.col("id").alias("class_id"), F.col("class_id").alias("whole")), "class_id", "left"
                           ).select("id", F.coalesce("whole", "class_id").alias("class_id"))
    found = firsts.join(found, "id", "left").select("sig_a", "sig_b", F.coalesce("class_id", "id").alias("part"))
    named = work.table(rows.drop("id").join(found, ["sig_a", "sig_b"], "left").select("row", "n", "part"))
    smallest = broadcast_if_small(work.table(named.where("part IS NOT NULL").groupBy("part").agg(F.min("row").alias("class_id"))))
    return named.join(smallest, "part", "left").select(F.col("row").alias("id"), "n", F.coalesce("class_id", "row").alias("class_id"))


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole sets of documents (id, sig_a, sig_b, text) whose text is the expected one."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            sets = token_sets(part.column(3))
            right = (_signatures(sets)[:2] == [part.column(1).to_numpy(), part.column(2).to_numpy()]).all(axis=0)
            yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(right)), _to_lists(
                [s for s, k in zip(sets, right) if k])], names=["id", "tokens"])


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_shingles`` and ``component_id`` of every row of ``docs``."""
    found = _row_classes(docs, id_col, text_col, workspace(docs.sparkSession))
    return found.select(
        F.when(F.col("id") < NO_ID, F.col("id")).alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("class_id") < NO_ID, F.col("class_id")).alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their class, with all their columns.

    Rows with equal id and text are one document. Different texts under the id of a class all stay.
    """
    work = workspace(docs.sparkSession)
    key = "_row_id"
    while key in docs.columns:
        key += "_"
    first = work.table(_row_classes(docs, id_col, text_col, work).where("id = class_id").select(
        F.col("id").alias(key)).distinct())
    kept = docs.withColumn(key, row_id(docs, id_col, text_col)).join(first, key, "left_semi")
    return kept.dropDuplicates([key, text_col]).select(*docs.columns)


def row_id(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """The id, or a number from ``NO_ID`` on made of the text."""
    made = F.xxhash64(docs[text_col]).bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(NO_ID)
    return F.coalesce(docs[id_col].cast("long"), made)
