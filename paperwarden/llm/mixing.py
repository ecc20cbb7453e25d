"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks. DataFrame functions only.

Every source's words are cut into blocks of (nearly) the same number of words. A source's target is its share by
weight of the words asked for, limited to ``cap`` times its own words, the excess going to the other sources by
weight. Blocks go to sources by the highest quotients ``v / (2k - 1)``, v being the target in blocks of the source
(Sainte-Laguë), then in the same way from a source to its shards. In a shard the documents stand in a seeded order;
a quota of q blocks out of n takes every block ``q div n`` times and ``q mod n`` blocks once more, chosen by a
seeded permutation of the block numbers. A document's taken words are its words in the chosen blocks.

Only ids, sources, sizes and a hash leave the scan of the texts. A hot source is many shards, and the tables of
sources and of shards are bounded by the number of sources times ``MAX_SHARDS``.

Defined cases: null text counts 0 words; the null source is a source of its own, last in order; null ids are rows
like others; rows with equal id and size are interchangeable, so reruns agree; documents without words take 0; equal
quotients go to the first source and block; long texts are counted whole, and may lie in several blocks; an empty table gives an empty result. Columns beyond the three named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperwarden.operators.scale import Workspace

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
CAP = 2
BLOCK_WORDS = 64
SHARD_WORDS = 65_536
MAX_SHARDS = 4_096
SEED = "mix-1"
#: Odd primes above any block count of a shard used here are coprime to it, so j -> j * p + c is a permutation.
PRIME = 2_147_483_647
#: Sources of more rows than this are joined by shuffle instead of broadcast.
BROADCAST_SOURCES = 100_000

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)).cast("long"), F.lit(0).cast("long"))


def _draw(key: Column, start: int) -> Column:
    """A number below 2**48 from twelve digits of a hash in hexadecimal."""
    return F.conv(F.substring(key, start, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT,
                   cap: int = CAP) -> DataFrame:
    """Targets of a table (source, source_size): weights by rank, limited by the cap, the excess reshared.

    With sources in order of cap / weight, the water level is that of the first source whose own limit reaches it.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(in_order)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    limits = sizes.select("source", "source_size", rank.alias("source_no"), weight.cast("double").alias("weight"),
                          (F.col("source_size") * cap).cast("double").alias("limit"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "source_no")
    before = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    whole = Window.partitionBy()
    wanted = F.sum("source_size").over(whole) * (share_percent / 100)
    levels = limits.withColumn("level", (wanted - before) / left)
    reached = F.min(F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.struct(
        F.col("limit") / F.col("weight"), "source_no", "level"))).over(whole)
    return levels.withColumn("level", reached["level"]).select(
        "source", "source_no", "source_size",
        F.least("limit", F.col("level") * F.col("weight")).alias("target"))


def apportion(parties: DataFrame, seats: Column, group: Sequence[str], party: str, votes: str) -> DataFrame:
    """Sainte-Laguë: ``seats`` of each group go to its parties by the highest quotients votes / (2k - 1).

    Rounded shares are nearly right; only as many seats a party as they are off in sum are ranked by quotient.
    """
    of_group = Window.partitionBy(*group)
    total = F.sum(votes).over(of_group)
    first = F.round(F.when(total > 0, F.col(votes) * F.col("_seats") / total).otherwise(0.0)).cast("long")
    guess = parties.withColumn("_seats", seats).withColumn("_first", first)
    guess = guess.withColumn("_off", F.abs(F.sum("_first").over(of_group) - F.col("_seats")) + 1)
    guess = guess.withColumn("_sure", F.greatest(F.lit(0), F.col("_first") - F.col("_off")))
    guess = guess.withColumn("_open", F.col("_seats") - F.sum("_sure").over(of_group))
    ranked = guess.where(F.col(votes) > 0).select(
        *group, party, "_open", votes, F.explode(F.sequence(F.col("_sure") + 1, F.col("_first") + F.col("_off"))).alias("_k"))
    place = F.row_number().over(of_group.orderBy((F.col(votes) / (2 * F.col("_k") - 1)).desc(), party, "_k"))
    won = ranked.withColumn("_place", place).where(F.col("_place") <= F.col("_open")).groupBy(*group, party).agg(
        F.count(F.lit(1)).alias("_won"))
    return guess.join(won, [*group, party], "left").withColumn(
        "quota", F.col("_sure") + F.coalesce("_won", F.lit(0))).drop("_seats", "_first", "_off", "_sure", "_open", "_won")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP,
                block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED) -> DataFrame:
    """Id, source, size, source_size, target and taken words of every row of ``docs``."""
    work = Workspace(docs.sparkSession)
    sized = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
                        word_count(docs[text_col]).alias("size"))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size")))
    sized = work.table(sized.withColumn("key", F.substring(key, 1, 24)))

    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, share_percent, cap).withColumn(
        "shards", F.least(F.lit(MAX_SHARDS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))))
    targets = work.table(targets)
    few = targets.count() <= BROADCAST_SOURCES
    named = sized.join(F.broadcast(targets) if few else targets, sized["source"].eqNullSafe(targets["source"])).drop(
        targets["source"]).withColumn("shard", _draw(F.col("key"), 1) % F.col("shards"))

    shards = named.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size")).withColumn(
        "blocks", F.when(F.col("shard_size") > 0, F.greatest(
            F.lit(1), F.round(F.col("shard_size") / block_words).cast("long"))).otherwise(0))
    shards = work.table(shards)
    sources = shards.groupBy("source_no").agg(F.sum("blocks").alias("source_blocks")).join(targets, "source_no").select(
        "source_no", "source_blocks", F.when(F.col("source_size") > 0, F.col("target") * F.col("source_blocks")
                                             / F.col("source_size")).otherwise(0.0).alias("votes"))
    seats = F.round(F.sum("votes").over(Window.partitionBy())).cast("long")
    quotas = apportion(sources, seats, [], "source_no", "votes").select(
        "source_no", F.least("quota", F.col("source_blocks") * cap).alias("source_quota"))
    quotas = apportion(shards.join(quotas, "source_no"), F.col("source_quota"), ["source_no"], "shard", "blocks")
    quotas = work.table(quotas.select("source_no", "shard", "shard_size", "blocks",
                                      F.least("quota", F.col("blocks") * cap).alias("quota")))

    in_shard = Window.partitionBy("source_no", "shard").orderBy(_draw(F.col("key"), 13), "doc_id", "size")
    placed = named.withColumn("end", F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0)))
    small = quotas.count() <= BROADCAST_SOURCES
    placed = placed.join(F.broadcast(quotas) if small else quotas, ["source_no", "shard"])
    n, blocks = F.col("shard_size"), F.col("blocks")
    start = F.col("end") - F.col("size")
    offset = F.pmod(F.expr("source_no * 1000003L + shard * 7919L"), F.greatest(blocks, F.lit(1)))

    def block_of(word: Column) -> Column:
        """Block j holds the words from floor(j * n / blocks) up to the start of the next."""
        return _div((word + 1) * blocks + n - 1, n) - 1

    def words_in(j: Column) -> Column:
        low, high = _div(j * n, blocks), _div((j + 1) * n, blocks)
        inside = F.least(high, F.col("end")) - F.greatest(low, start)
        chosen = F.pmod(j * PRIME + offset, blocks) < F.pmod(F.col("quota"), blocks)
        return F.when(chosen, inside).otherwise(F.lit(0).cast("long"))

    once = F.aggregate(F.sequence(block_of(start), block_of(F.col("end") - 1)), F.lit(0).cast("long"),
                       lambda total, j: total + words_in(j))
    taken = F.when(F.col("size") > 0, _div(F.col("quota"), blocks) * F.col("size") + once).otherwise(
        F.lit(0).cast("long"))
    return placed.select(F.col("doc_id").alias(id_col), F.col("source").alias(source_col), "size", "source_size",
                         "target", taken.alias("taken"))


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of non-negative longs."""
    return F.call_function("div", a, b)
