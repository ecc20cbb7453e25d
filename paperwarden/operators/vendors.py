"""Look-alike vendor names: the best fuzzy match of an unknown name among the known ones.

The similarity is the Ratcliff-Obershelp ratio 2M / S of the lower-cased names, S being both lengths together. Pairs
are found without comparing every name with every vendor, in two passes over one kind of candidates each:

* Few edits: a name that differs from a vendor by at most ``EDITS`` letters left out or put in is the same text as the
  vendor once both have lost those letters. So names and vendors meet by the texts that are left when letters go, first
  one letter on each side, then two on one side; what they begin or end with alike brings no pair together. Names of more
  than ``LONG`` letters meet vendors by ``EDITS`` + 1 equal parts of the vendor instead, one of which such a name leaves
  whole, at most ``EDITS`` places away. A match found this way is the best one if it beats what any vendor not met yet
  could reach, ``1 - edits / S``.
* All others: a ratio of r means M matched letters with 2M >= r * S; with one end mark on both sides the names then share
  at least 3M - S + 1 two-letter grams, because an unmatched letter breaks two grams and an insertion one. So a vendor may
  leave out all but its (grams - shared + 1) rarest grams. r is what the first pass found for the name, or one of
  ``LEVELS``, the highest first, and at last ``low``: names with a match at one level are not asked at the next.

A candidate carries a bound of its ratio, from the lengths, the edit distance and the letters that both names have. Per
name the pair with the best bound is rated first; only pairs whose bound reaches that rating are rated after it.
"""

from __future__ import annotations

import functools
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import kernels
from ..functions.fixed_values import VENDOR_SIMILARITY_HIGH, VENDOR_SIMILARITY_LOW
from .scale import broadcast_if_small, materialise, shuffled

SALTS = 16
EDITS = 2
LEVELS = (0.9,)
#: Longer names have too many texts without two letters, so they are looked up by their parts.
LONG = 48
_ROUNDING = 1e-9


def _grams(name: Column) -> Column:
    marked = F.concat(F.lit("\u0002"), name, F.lit("\u0003"))
    return F.transform(F.sequence(F.lit(1), F.length(marked) - 1), lambda i: F.substring(marked, i, 2))


def _kept_grams(length: Column, low: Column | float) -> Column:
    """How many of its rarest grams a vendor must keep to be met by every name with a ratio of at least ``low``."""
    shortest_total = length + F.ceil(length * (low / (2.0 - low)) - _ROUNDING)
    shared = F.ceil((1.5 * low - 1.0) * shortest_total + 1.0 - _ROUNDING)
    return F.greatest((length + 1) - shared + 1, F.lit(1))


def _lowered(known: DataFrame) -> DataFrame:
    return (known.select(F.col("vendor_name").alias("known_vendor"), F.lower("vendor_name").alias("known_lower"))
            .where(F.length("known_lower") > 0))


def gram_index(known: DataFrame, low: float = VENDOR_SIMILARITY_LOW) -> DataFrame:
    """(key, known_vendor, known_lower, place): the rarest grams of every known vendor, and how rare each is."""
    names = _lowered(known)
    grams = names.select("*", F.explode_outer(_grams(F.col("known_lower"))).alias("gram"))
    frequency = grams.groupBy("gram").agg(F.count("*").alias("frequency"))
    ranked = (grams.join(broadcast_if_small(frequency), "gram")
              .groupBy("known_vendor", "known_lower")
              .agg(F.array_sort(F.collect_list(F.struct("frequency", "gram"))).alias("grams")))
    kept = F.slice("grams", F.lit(1), _kept_grams(F.length("known_lower"), low).cast("int"))["gram"]
    return ranked.select("known_vendor", "known_lower", F.posexplode(kept).alias("place", "key")).groupBy(
        "key", "known_vendor", "known_lower").agg(F.min("place").alias("place"))


def _left(name: Column, gone: int) -> Column:
    """Hashes of the texts that are left of ``name`` without ``gone`` letters (0 to 2)."""
    places = F.sequence(F.lit(1), F.length(name))
    none = F.array().cast("array<string>")

    def without(text: Column, place: Column) -> Column:
        return F.concat(F.substring(text, F.lit(1), place - 1), F.substring(text, place + 1, F.length(text)))

    if gone == 0:
        texts = F.array(name)
    elif gone == 1:
        texts = F.when(F.length(name) > 0, F.transform(places, lambda i: without(name, i))).otherwise(none)
    else:
        texts = F.when(F.length(name) > 1, F.flatten(F.transform(
            F.sequence(F.lit(2), F.length(name)),
            lambda j: F.transform(F.sequence(F.lit(1), j - 1), lambda i: without(without(name, j), i))))).otherwise(none)
    return F.array_distinct(F.transform(texts, lambda t: F.xxhash64(t)))


def _near(names: DataFrame, known: DataFrame, gone: list[tuple[int, int]]) -> DataFrame:
    """Candidates of names (vendor_name, lower_name, need) that equal a vendor when (in the name, in the vendor) so many
    letters are gone. No key is frequent: few texts become the same by losing one or two letters.
    """
    vendors = _lowered(known)

    def keys(rows: DataFrame, name: str, side: int, *kept: str) -> DataFrame:
        left = F.flatten(F.array(*[_left(F.col(name), n) for n in sorted({g[side] for g in gone})]))
        return shuffled(rows.select(*kept, F.explode(F.array_distinct(left)).alias("key")))

    if len(gone) == 1:  # only lengths that occur on the other side
        apart = gone[0][1] - gone[0][0]
        lengths = names.select((F.length("lower_name") + apart).alias("length")).distinct()
        vendors = vendors.join(F.broadcast(lengths), F.length("known_lower") == F.col("length"), "left_semi")
        lengths = vendors.select((F.length("known_lower") - apart).alias("length")).distinct()
        names = names.join(F.broadcast(lengths), F.length("lower_name") == F.col("length"), "left_semi")
    # A name has many keys, so it goes to them without what follows from it.
    met = keys(names, "lower_name", 0, "vendor_name", "need").join(keys(vendors, "known_lower", 1, "known_vendor"), "key")
    return _bounded(met.withColumns({"lower_name": F.lower("vendor_name"), "known_lower": F.lower("known_vendor")}), EDITS)


def _part(length: Column, number: Column) -> tuple[Column, Column]:
    """Start from 0 and length of one of EDITS + 1 parts of a name."""
    start, stop = (F.floor(length * n / (EDITS + 1)).cast("int") for n in (number, number + 1))
    return start, stop - start


def part_index(known: DataFrame) -> DataFrame:
    """(key, known_vendor, known_lower): the parts of every known vendor, with its length and their number."""
    names = _lowered(known).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(EDITS))))
    start, size = _part(F.length("known_lower"), F.col("part"))
    return names.select(F.concat_ws(" ", F.length("known_lower"), "part", F.substring("known_lower", start + 1, size)).alias("key"),
                        "known_vendor", "known_lower")


def _part_keys(names: DataFrame) -> DataFrame:
    """``names`` with the ``key`` of every part that a vendor within EDITS edits could have."""
    la = F.length("lower_name")
    rows = names.withColumn("_length", F.explode(F.sequence(F.greatest(la - EDITS, F.lit(1)), la + EDITS)))
    rows = rows.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(EDITS))))
    rows = rows.withColumn("_shift", F.explode(F.sequence(F.lit(-EDITS), F.lit(EDITS))))
    start, size = _part(F.col("_length"), F.col("_part"))
    start = start + F.col("_shift")
    rows = rows.where((start >= 0) & (start + size <= la))
    return rows.select(*names.columns, F.concat_ws(" ", "_length", "_part", F.substring("lower_name", start + 1, size)).alias("key")
                       ).distinct()


def _met(names: DataFrame, index: DataFrame) -> DataFrame:
    """``names`` (with ``key``) next to the vendors of the same key."""
    small = broadcast_if_small(index, otherwise=lambda large: None)
    if small is not None:
        return names.join(small, "key")
    # A frequent key is split over SALTS tasks.
    salted = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    names = names.withColumn("salt", F.pmod(F.xxhash64("vendor_name"), F.lit(SALTS)).cast("int"))
    return shuffled(names).join(shuffled(salted), ["key", "salt"]).drop("salt")


def _common_letters(a: Column, b: Column) -> Column:
    """Letters of ``a`` that ``b`` has too, each as often as in both: no fewer than any matching."""
    letters = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(a)), lambda i: F.substring(a, i, 1)))

    def times(text: Column, letter: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, letter, F.lit("")))

    return F.aggregate(letters, F.lit(0), lambda n, c: n + F.least(times(a, c), times(b, c)))


def _bounded(pairs: DataFrame, longest: int) -> DataFrame:
    """(vendor_name, lower_name, known_vendor, known_lower, bound): each pair that may reach ``need`` once.

    ``longest`` is the largest sum of two lengths; the edit distance stops counting beyond what it allows.
    """
    la, lb = F.length("lower_name"), F.length("known_lower")
    total = la + lb
    pairs = pairs.where(2 * F.least(la, lb) >= F.col("need") * total - _ROUNDING)
    edits = F.levenshtein("lower_name", "known_lower", longest)
    pairs = pairs.withColumn("edits", edits).where(
        (F.col("edits") >= 0) & (1.0 - F.col("edits") / total >= F.col("need") - _ROUNDING))
    pairs = pairs.select("vendor_name", "lower_name", "need", "known_vendor", "known_lower", "edits").distinct()
    # A letter replaced by another is one edit, but neither of the two is matched.
    bound = F.least(1.0 - F.col("edits") / total, 2.0 * _common_letters(F.col("lower_name"), F.col("known_lower")) / total)
    return pairs.withColumn("bound", bound).where(F.col("bound") >= F.col("need") - _ROUNDING).drop("edits", "need")


@F.pandas_udf(T.DoubleType())
def _ratio(names: pd.Series, known: pd.Series) -> pd.Series:
    return pd.Series([kernels.matching_ratio(a, b) for a, b in zip(names, known)], dtype="float64")


def closest_vendors(names: DataFrame, known: DataFrame, low: float = VENDOR_SIMILARITY_LOW) -> DataFrame:
    """(vendor_name, closest_vendor, vendor_similarity) for unknown names with a match of at least ``low``.

    ``names`` and ``known`` carry vendor_name. Ties go to the alphabetically first vendor.
    """
    if not 2 / 3 < low <= 1:
        raise ValueError("low must be above 2/3 and at most 1")
    known = known.select("vendor_name").where(F.length("vendor_name") > 0)
    unknown = (names.select("vendor_name").where(F.length("vendor_name") > 0).distinct()
               .join(broadcast_if_small(known), "vendor_name", "left_anti")
               .select("vendor_name", F.lower("vendor_name").alias("lower_name")))
    # Few names may still mean many pairs, so they are spread over all cores.
    unknown = materialise(unknown.repartition(unknown.sparkSession.sparkContext.defaultParallelism))
    rest = unknown.withColumn("need", F.lit(float(low)))
    length = F.length("lower_name")
    answers = []
    # Letters gone in name and vendor, and the best ratio of a vendor that is met later: one that is two letters longer,
    # then one that is two letters shorter or, if larger, one that is three letters longer.
    two_longer, three = 1.0 - 2 / (2 * length + 2), 1.0 - 3 / (2 * length + 3)
    two_shorter = 1.0 - 2 / F.greatest(2 * length - 2, F.lit(1))
    for gone, later in (([(0, 0), (0, 1), (1, 0), (1, 1)], F.greatest(two_longer, three)),
                        ([(0, 2)], F.greatest(two_shorter, three)), ([(2, 0)], three)):
        pairs = _near(rest.where(length <= LONG), known, gone)
        if not answers:
            long = _part_keys(rest.where(length > LONG))
            pairs = pairs.unionByName(_bounded(_met(long, part_index(known.where(F.length("vendor_name") > LONG - 2 * EDITS))), EDITS))
        rest, done = _settled(rest, pairs, low, F.when(length > LONG, three).otherwise(later))
        answers.append(done)
        if rest.isEmpty():
            break
    for level in [*(level for level in LEVELS if level > low), low]:
        if rest.isEmpty():
            break
        asked = rest.withColumn("need", F.greatest("need", F.lit(float(level))))
        found = materialise(_best(_far(asked, known, level), level))
        rest = materialise(rest.join(broadcast_if_small(found.select("vendor_name")), "vendor_name", "left_anti"))
        answers.append(found)
    return functools.reduce(DataFrame.unionByName, [a.select("vendor_name", "closest_vendor", "vendor_similarity")
                                                    for a in answers])


def _settled(names: DataFrame, pairs: DataFrame, low: float, later: Column) -> tuple[DataFrame, DataFrame]:
    """The names (vendor_name, lower_name, need, and the best found) that a vendor met later could still match better,
    and those whose best match is among ``pairs`` and what earlier steps found."""
    if "closest_vendor" not in names.columns:
        names = names.select("*", F.lit(None).cast("string").alias("closest_vendor"),
                             F.lit(None).cast("double").alias("vendor_similarity"))
    found = _best(pairs, low).select("vendor_name", F.col("closest_vendor").alias("_vendor"),
                                                   F.col("vendor_similarity").alias("_ratio"))
    rows = names.join(found, "vendor_name", "left")
    best = F.array_min(F.array_compact(F.array(
        F.when(F.col("_ratio").isNotNull(), F.struct((-F.col("_ratio")).alias("ratio"), F.col("_vendor").alias("vendor"))),
        F.when(F.col("vendor_similarity").isNotNull(), F.struct((-F.col("vendor_similarity")).alias("ratio"),
                                                                F.col("closest_vendor").alias("vendor"))))))
    rows = rows.withColumn("_best", best).select(
        "vendor_name", "lower_name", F.coalesce(-F.col("_best.ratio"), F.col("need")).alias("need"),
        F.col("_best.vendor").alias("closest_vendor"), (-F.col("_best.ratio")).alias("vendor_similarity"))
    rows = materialise(rows.withColumn("done", F.coalesce(F.col("vendor_similarity") > later + _ROUNDING, F.lit(False))))
    return rows.where("not done").drop("done"), rows.where("done").drop("done")


def _far(names: DataFrame, known: DataFrame, low: float) -> DataFrame:
    """Candidates of names (vendor_name, lower_name, need) by shared grams."""
    shortest, longest = known.agg(F.min(F.length(F.lower("vendor_name"))),
                                  F.max(F.length(F.lower("vendor_name")))).first()
    reach = low / (2.0 - low)
    least, most = math.floor((shortest or 0) * reach), math.ceil((longest or 0) / reach)
    names = names.where(F.length("lower_name").between(least, most))
    index = materialise(gram_index(known, low))
    grams = names.select("*", F.explode_outer(F.array_distinct(_grams(F.col("lower_name")))).alias("key"))
    met = _met(grams, index).where(F.col("place") < _kept_grams(F.length("known_lower"), F.col("need")))
    return _bounded(met, math.floor((1.0 - low) * (most + (longest or 0)) + 1))


def _contenders(pairs: DataFrame, first: DataFrame) -> DataFrame:
    """The candidates that could win against the first one (vendor_name, leader, reached).

    Their bound is above its rating, or equal to it and they come before it in the alphabet. The leader is among them.
    """
    beyond = F.col("bound") > F.col("reached") + _ROUNDING
    equal = (F.col("bound") >= F.col("reached") - _ROUNDING) & (F.col("known_vendor") < F.col("leader"))
    return (pairs.join(broadcast_if_small(first), "vendor_name").where(beyond | equal | (F.col("known_vendor") == F.col("leader")))
            .select("vendor_name", "lower_name", "known_vendor", "known_lower"))


def _best(pairs: DataFrame, low: float) -> DataFrame:
    """(vendor_name, closest_vendor, vendor_similarity) of names with a candidate that reaches ``low``."""
    # Met once, read twice.
    pairs = materialise(pairs)
    # The pair with the best upper bound first; its true ratio rules out most other pairs.
    first = pairs.groupBy("vendor_name", "lower_name").agg(
        F.min(F.struct((-F.col("bound")).alias("bound"), "known_vendor", "known_lower")).alias("best"))
    first = materialise(first.select("vendor_name", F.col("best.known_vendor").alias("leader"),
                                     _ratio("lower_name", "best.known_lower").alias("reached")))
    scored = _contenders(pairs, first).select("vendor_name", "known_vendor", _ratio("lower_name", "known_lower").alias("ratio"))
    best = scored.groupBy("vendor_name").agg(
        F.min(F.struct((-F.col("ratio")).alias("ratio"), "known_vendor")).alias("best"))
    return best.select("vendor_name", F.col("best.known_vendor").alias("closest_vendor"),
                       (-F.col("best.ratio")).alias("vendor_similarity")).where(F.col("vendor_similarity") >= low)


def lookalike_vendors(names: DataFrame, known: DataFrame) -> DataFrame:
    """Closest vendors in the suspicious band: alike, but not the same name."""
    return closest_vendors(names, known).where(F.col("vendor_similarity") < VENDOR_SIMILARITY_HIGH)


def attach_closest_vendor(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Adds closest_vendor and vendor_similarity (null for known or unlike names) to documents."""
    found = broadcast_if_small(materialise(closest_vendors(docs, known)))
    return docs.join(found, "vendor_name", "left").select(*docs.columns, "closest_vendor", "vendor_similarity")
