import difflib
import random

import pytest

from paperwarden.operators import scale, vendors


def names(seed, count):
    rng = random.Random(seed)
    parts = ["acme", "blue", "co", "corp", "delta", "everwood", "freight", "inc", "it", "ko", "ltd", "peak", "x"]
    return sorted({" ".join(rng.choice(parts).title() for _ in range(rng.randint(1, 3))) for _ in range(count)})


def misspelt(rng, name):
    letters = list(name)
    for _ in range(rng.randint(1, 3)):
        at = rng.randrange(len(letters))
        change = rng.choice("drits")
        if change == "d" and len(letters) > 1:
            del letters[at]
        elif change == "r":
            letters[at] = rng.choice("abcxyz")
        elif change == "i":
            letters.insert(at, rng.choice("aeiou"))
        elif change == "t" and at:
            letters[at - 1], letters[at] = letters[at], letters[at - 1]
        else:
            letters[at] = letters[at].swapcase()
    return "".join(letters)


def brute_force(unknown, known, low):
    found = {}
    for name in set(unknown) - set(known) - {""}:
        scored = [(-difflib.SequenceMatcher(None, name.lower(), k.lower()).ratio(), k) for k in known if k]
        best = min(scored)
        if -best[0] >= low:
            found[name] = (best[1], -best[0])
    return found


@pytest.mark.parametrize("broadcast_bytes, low", [(1 << 26, 0.8), (0, 0.8), (1 << 26, 0.7)])
def test_same_as_comparing_all(spark, monkeypatch, broadcast_bytes, low):
    monkeypatch.setattr(vendors.broadcast_if_small, "__defaults__", (broadcast_bytes,))
    rng = random.Random(7)
    known = names(1, 120) + ["A", "ab", "Abc"]
    unknown = [misspelt(rng, rng.choice(known)) for _ in range(250)] + known[:5] + ["", "a", "aB", "ABC", "zzz"]
    rows = vendors.closest_vendors(
        spark.createDataFrame([(n,) for n in unknown], "vendor_name string"),
        spark.createDataFrame([(n,) for n in known], "vendor_name string"), low).collect()
    assert {r.vendor_name: (r.closest_vendor, r.vendor_similarity) for r in rows} == brute_force(unknown, known, low)


def shapes():
    """300 vendors, and names with two letters gone, with a word in front, and with an unread last digit."""
    rng = random.Random(11)
    parts = ["amber", "bolt", "cedar", "dune", "ember", "flint", "grove", "harbor", "iron", "juniper", "kelp", "larch", "moss"]
    known = sorted({" ".join(rng.sample(parts, 3)) for _ in range(500)})[:300]
    gone = []
    for name in known:
        a, b = sorted(rng.sample(range(len(name)), 2))
        gone.append(name[:a] + name[a + 1:b] + name[b + 1:])
    numbered = [f"Trader#{k:09d}" for k in range(1, 301)]
    return {"gone": (gone, known), "front": ([f"the {n}" for n in known], known),
            "digit": (sorted({n[:-1] + "x" for n in numbered}), numbered)}


@pytest.mark.parametrize("shape", ["gone", "front", "digit"])
def test_few_pairs_are_rated(spark, monkeypatch, shape):
    unknown, known = shapes()[shape]
    rated = spark.sparkContext.accumulator(0)
    contenders = vendors._contenders

    def counted(pairs, first):
        rated.add(contenders(pairs, first).count())
        return contenders(pairs, first)

    monkeypatch.setattr(vendors, "_contenders", counted)
    rows = vendors.closest_vendors(spark.createDataFrame([(n,) for n in unknown], "vendor_name string"),
                                   spark.createDataFrame([(n,) for n in known], "vendor_name string")).collect()
    assert {r.vendor_name: (r.closest_vendor, r.vendor_similarity) for r in rows} == brute_force(unknown, known, 0.8)
    assert rated.value <= 0.05 * len(unknown) * len(known)


def test_letters_beyond_the_basic_plane(spark):
    known = ["\U0001F600\U0001F601 Bäckerei Ömer", "İstanbul Tekstil"]
    unknown = ["\U0001F600\U0001F602 Bäckerei Ömer", "İstanbul Teksil", "x"]
    rows = vendors.closest_vendors(spark.createDataFrame([(n,) for n in unknown], "vendor_name string"),
                                   spark.createDataFrame([(n,) for n in known], "vendor_name string")).collect()
    assert {r.vendor_name: r.closest_vendor for r in rows} == {u: k for u, (k, _) in brute_force(unknown, known, 0.8).items()}


def test_case_only_difference_is_no_lookalike(spark):
    known = spark.createDataFrame([("Brindle Paper Works",)], "vendor_name string")
    asked = spark.createDataFrame([("BRINDLE PAPER WORKS",), ("Brindle Papre Works",)], "vendor_name string")
    rows = vendors.lookalike_vendors(asked, known).collect()
    assert [(r.vendor_name, round(r.vendor_similarity, 4)) for r in rows] == [("Brindle Papre Works", 0.9474)]


def test_no_known_vendors(spark):
    empty = spark.createDataFrame([], "vendor_name string")
    asked = spark.createDataFrame([("Brin",)], "vendor_name string")
    assert vendors.closest_vendors(asked, empty).count() == 0


def test_names_alike_at_both_ends_meet_few_vendors(spark, monkeypatch):
    """Names that begin alike, end alike and differ in few places are not compared with every vendor."""
    known = [f"Trader#{k:06d} Ltd" for k in range(600)]
    unknown = [f"Trader#{k:06d}x Ltd" for k in range(0, 600, 2)] + [f"Trder#{k:06d} Ltd" for k in range(0, 600, 2)]
    compared = spark.sparkContext.accumulator(0)
    bounded = vendors._bounded

    def counted(pairs, longest):
        compared.add(pairs.count())
        return bounded(pairs, longest)

    monkeypatch.setattr(vendors, "_bounded", counted)
    rows = vendors.closest_vendors(spark.createDataFrame([(n,) for n in unknown], "vendor_name string"),
                                   spark.createDataFrame([(n,) for n in known], "vendor_name string")).collect()
    assert {r.vendor_name: (r.closest_vendor, r.vendor_similarity) for r in rows} == brute_force(unknown, known, 0.8)
    assert compared.value <= 0.1 * len(unknown) * len(known)


def test_edits_of_short_and_long_names(spark):
    known = ["a", "bc", "ef g", "Abc", "x" * 46, "q" * 30 + "r" * 20, "m" * 60 + "n" * 9, "long name " * 5, "kk", "k k k k"]
    unknown = ["A", "b", "bcd", "efg", "abcd", "x" * 44, "x" * 48, "x" * 49, "q" * 30 + "r" * 18, "m" * 60 + "n" * 7, "zz",
               "long name " * 4 + "long nam", "kkk k", "y" * 3000]
    rows = vendors.closest_vendors(spark.createDataFrame([(n,) for n in unknown], "vendor_name string"),
                                   spark.createDataFrame([(n,) for n in known], "vendor_name string")).collect()
    assert {r.vendor_name: (r.closest_vendor, r.vendor_similarity) for r in rows} == brute_force(unknown, known, 0.8)


def test_keys_of_names_are_not_broadcast(spark, capsys):
    """A name has a hundred keys and more, which would all be collected on the driver."""
    known = scale.materialise(spark.createDataFrame([(n,) for n in names(5, 60)], "vendor_name string"))
    asked = known.selectExpr("vendor_name", "lower(vendor_name) AS lower_name", "CAST(0.8 AS DOUBLE) AS need")
    for gone in ([(0, 0), (0, 1), (1, 0), (1, 1)], [(0, 2)], [(2, 0)]):
        vendors._near(asked, known, gone).explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin [key" in plan and "BroadcastHashJoin [key" not in plan
