"""Places of rows in a sorted table, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .scale import Workspace, broadcast_if_small

#: Positions of one key that a single window runs over.
CHUNK = 4096


def rank_rows(df: DataFrame, group: list[str], order: list[str], work: Workspace, name: str) -> DataFrame:
    """``df`` with ``name``, the place from 0 of each row among its group's, nulls first.

    The table is sorted by ranges, so that a group with a third of all rows lies in many partitions; a row's place
    is its place inside its partition plus the rows of its group before that partition. Rows that agree in all of
    ``group`` and ``order`` share a partition, so ``order`` should end with something that tells copies apart.
    """
    keys = [*group, *order]
    placed = work.table(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                        .withColumn("_seq", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_seq", 33))
    runs = placed.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    runs = work.table(runs.select(F.col("_part").alias("_run"), *[F.col(g).alias(f"_run_{g}") for g in group], shift))
    same = F.col("_part") == F.col("_run")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_run_{g}"))
    return placed.join(broadcast_if_small(runs), same).select(
        *df.columns, (F.col("_seq") + F.col("_shift")).alias(name))


def running(df: DataFrame, key: str, place: str, values: dict[str, Column], work: Workspace, backwards: bool = False,
            xor: bool = False) -> DataFrame:
    """``df`` with running totals over the rows of each ``key`` up to the own one, in order of ``place``.

    ``values`` maps names to the columns added up (or combined by exclusive or). Places are cut into chunks, each with
    a window of its own; what the chunks before hold comes from one total a chunk.
    """
    total = F.bit_xor if xor else F.sum
    join_totals = (lambda a, b: a.bitwiseXOR(b)) if xor else (lambda a, b: a + b)
    df = work.table(df.select("*", *[v.alias(f"_{n}") for n, v in values.items()],
                              F.expr(f"{place} div {CHUNK}").alias("_chunk")))
    spot, chunk = (F.desc, F.desc) if backwards else (F.asc, F.asc)
    inside = Window.partitionBy(key, "_chunk").orderBy(spot(place)).rowsBetween(Window.unboundedPreceding, 0)
    found = df.select("*", *[total(f"_{n}").over(inside).alias(n) for n in values])
    long_keys = work.table(df.where("_chunk > 0").select(F.col(key).alias("_key")).distinct())
    whole = (df.join(broadcast_if_small(long_keys), F.col(key) == F.col("_key"), "left_semi").groupBy(key, "_chunk")
             .agg(*[total(f"_{n}").alias(f"_{n}") for n in values]))
    earlier = Window.partitionBy(key).orderBy(chunk("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    whole = work.table(whole.select(F.col(key).alias("_key"), F.col("_chunk").alias("_at"),
                                    *[total(f"_{n}").over(earlier).alias(f"_before_{n}") for n in values]))
    found = found.join(broadcast_if_small(whole), (F.col(key) == F.col("_key")) & (F.col("_chunk") == F.col("_at")), "left")
    kept = [c for c in df.columns if c not in {"_chunk", *[f"_{n}" for n in values]}]
    return found.select(*kept, *[join_totals(F.col(n), F.coalesce(f"_before_{n}", F.lit(0))).alias(n) for n in values])
