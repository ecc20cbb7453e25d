import hashlib
import random
import zlib

import plain
import pytest
from pyspark.sql import functions as F

from paperwarden.llm import conversation_trie, queries

FIELDS = "conv_id long, turn long, role string, text string, survivor string, depth string, place string"


def told(rows):
    """{id: [(role, text), ...]} in order of turns."""
    made = {}
    for i, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (
            r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        made.setdefault(i, []).append((role or "", text or ""))
    return made


def swapped(conversations):
    """Conversations with the first turns of the first one of their family of five."""
    made = {}
    for i, turns in conversations.items():
        h = zlib.crc32(str(i).encode()) % 9
        family = int(i - (abs(i) % 5) * (1 if i >= 0 else -1))
        made[i] = conversations.get(family, [])[:h] + turns[h:]
    return made


def peeled(conversations):
    """All nodes, by stripping one turn after the other from the deepest level up."""
    level, nodes = {}, {}
    for depth in range(max(map(len, conversations.values()), default=0), -1, -1):
        merged = {}
        for key, below in level.items():
            node = merged.setdefault(key[:-1], {"ids": [], "ended": [], "children": []})
            node["ids"] += below["ids"]
            node["children"].append(below)
        for i, turns in conversations.items():
            if len(turns) == depth:
                node = merged.setdefault(tuple(turns), {"ids": [], "ended": [], "children": []})
                node["ids"].append(i)
                node["ended"].append(i)
        for key, node in merged.items():
            node["leaves"] = sum(c["leaves"] for c in node["children"]) or 1
            text = key[-1][1] if key else ""
            node["saved"] = sum(c["saved"] for c in node["children"]) + (len(node["ids"]) - 1) * len(text.encode())
        nodes.update(merged)
        level = merged
    return sorted((min(n["ids"]), len(key), min(nodes[key[:-1]]["ids"]) if key else None, len(n["ids"]), len(n["children"]),
                   n["leaves"], n["saved"], hashlib.sha256(",".join(map(str, sorted(n["ended"]))).encode()).hexdigest())
                  for key, n in nodes.items() if n["ids"])


def rows_of(found):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in found.collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], FIELDS).repartition(6)


def grown(seed, count, deepest):
    """Conversations that branch off at all depths, are cut at all depths, and are copied."""
    rng = random.Random(seed)
    made = {}
    for i in rng.sample(range(-count, 3 * count), count):
        old = list(rng.choice(list(made.values()))) if made and rng.random() < 0.8 else []
        old = old[:rng.randint(0, len(old))]
        made[i] = old + [(rng.choice(("user", "assistant")), "é" * rng.randint(0, 3) + rng.choice("abc"))
                         for _ in range(rng.choice((0, 0, 1, 2, deepest)))]
    return [(i, turn, *said) for i, turns in made.items() for turn, said in enumerate(turns)]


@pytest.mark.parametrize("seed, count, deepest", [(1, 120, 5), (2, 60, 40)])
def test_trie_equals_plain_peeling(spark, seed, count, deepest):
    rows = grown(seed, count, deepest)
    assert rows_of(conversation_trie.conversation_trie(table(spark, rows))) == peeled(told(rows))


def test_query_rebuilds_conversations(spark, tmp_path):
    rows = [r for r in grown(3, 150, 9)]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_conversation_trie(spark, str(tmp_path))
    assert rows_of(found) == peeled(swapped(told(rows)))


def test_long_chains_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "ID_CHUNK", 7)
    monkeypatch.setattr("paperwarden.operators.ranks.CHUNK", 5)
    # Every cut of one conversation is a conversation of its own; many copies end at one node.
    rows = [(i, turn, "user", f"t{turn}") for i in range(40) for turn in range(i + 1)]
    rows += [(100 + i, turn, "user", f"t{turn}") for i in range(30) for turn in range(3)]
    rows += [(200, turn, "user", f"t{turn}" if turn < 33 else "other") for turn in range(60)]
    assert rows_of(conversation_trie.conversation_trie(table(spark, rows))) == peeled(told(rows))


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (2, None, "", ""),
            (3, 5, "b", "a"), (3, 5, "a", "b"), (3, 5, "a", "a"), (4, 1, "a", "a"), (5, 1, "user", "long " * 100_000),
            (6, 1, "user", "long " * 100_000), (7, 0, "us", "erx"), (8, 0, "user", "x"), (9, 0, "user", "😀")]
    assert rows_of(conversation_trie.conversation_trie(table(spark, rows))) == peeled(told(rows))
    assert conversation_trie.conversation_trie(table(spark, rows).limit(0)).count() == 0


def test_conversations_without_turns(spark):
    rows = [(i, 0, "user", "only") for i in (1, 2, 3)]
    none = conversation_trie.conversation_trie(table(spark, rows), rebuilt=lambda c: (F.lit(-1).cast("long"), F.lit(5)))
    assert rows_of(none) == [(1, 0, None, 3, 0, 1, 0, hashlib.sha256(b"1,2,3").hexdigest())]


def test_given_conversations(spark):
    found = rows_of(queries.op11_conversation_trie(spark, plain.BENCHMARK_PATH))
    given = spark.read.parquet(f"{plain.BENCHMARK_PATH}/conversations.parquet").collect()
    assert found == peeled(swapped(told([(r.conv_id, r.turn, r.role, r.text) for r in given])))
