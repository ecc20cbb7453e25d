"""Slow, obvious versions of the operators, and tables of odd rows, for the tests."""

import collections
import math
import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BENCHMARK_PATH = "/root/testdata/sf0.001"


def words(text):
    return WORDS.findall(text or "")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text):
    w = words(lowered(text))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def classes(rows):
    """(id, size, class) of rows (id, text) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                part[find(x)] = find(y)
    members = collections.defaultdict(list)
    for x, (i, _) in enumerate(rows):
        members[find(x)].append(i)
    return [(i, len(sets[x]), min((m for m in members[find(x)] if m is not None), default=None))
            for x, (i, _) in enumerate(rows)]


def rule_measures(text):
    w = words(text)
    chars = sum(map(len, w))

    def in_repeats(n):
        grams = [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
        often = collections.Counter(grams)
        return {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(n)}

    lines = (text or "").split("\n")
    again = [line for i, line in enumerate(lines) if words(line) and line in lines[:i]]
    return {"n_words": len(w), "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(again), "n_repeat_words": len(in_repeats(8)),
            "dup_line_chars": sum(len(x) for line in again for x in words(line)),
            **{f"dup_chars_{n}": sum(len(w[i]) for i in in_repeats(n)) for n in range(5, 11)}}


def rule_verdict(m):
    failed = m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
    many = 100 * m["dup_line_chars"] > 25 * m["word_chars"] or any(
        100 * m[f"dup_chars_{n}"] > 30 * m["word_chars"] for n in range(5, 11))
    return failed, not (failed or many)


def edits_in(piece, text):
    """Fewest edits that turn ``piece`` into some part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(piece, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            before, row[j] = row[j], min(before + (a != b), row[j] + 1, row[j - 1] + 1)
    return min(row)


def spans(parts, min_sentences, min_words):
    """The shortest run from and up to every sentence, as (first, number)."""
    counts = [len(w) for _, _, w in parts]
    found = set()
    for i in range(len(parts)):
        for j in range(i + min_sentences, len(parts) + 1):
            if sum(counts[i:j]) >= min_words:
                found.add((i, j - i))
                break
        for k in range(i + 1 - min_sentences, -1, -1):
            if sum(counts[k:i + 1]) >= min_words:
                found.add((k, i + 1 - k))
                break
    return found


def without_repeats(rows, sentences, min_sentences, min_words):
    """Texts of rows (id, text) with unlike ids, without sentences in places of a span that aren't its first."""
    cut = {i: sentences(t) for i, t in rows if t is not None}
    first = {}
    places = {}
    for i in sorted(cut):
        places[i] = sorted(spans(cut[i], min_sentences, min_words))
        for a, n in places[i]:
            first.setdefault(tuple(" ".join(w) for _, _, w in cut[i][a:a + n]), (i, a))
    made = {}
    for i, t in rows:
        if t is None:
            made[i] = None
            continue
        gone = {a + k for a, n in places[i] for k in range(n)
                if first[tuple(" ".join(w) for _, _, w in cut[i][a:a + n])] != (i, a)}
        made[i] = "".join(t[a:b] for k, (a, b, _) in enumerate(cut[i]) if k not in gone)
    return made


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Targets of {source: size} by halving the interval of the water level."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = share * sum(sizes.values())
    low, high = 0.0, 10.0 * total + 1
    for _ in range(300):
        level = (low + high) / 2
        if sum(min(cap * sizes[s], level * weight[s]) for s in names) < total:
            low = level
        else:
            high = level
    return {s: min(cap * sizes[s], high * weight[s]) for s in names}


def sainte_lague(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(votes, key=lambda p: (votes[p] / (2 * won[p] + 1), -p))
        won[best] += 1
    return won


def prose(rng, count, vocabulary=None):
    vocabulary = vocabulary or [f"{a}{b}{c}" for a in ("ba", "lo", "mi", "tre", "vu") for b in ("ka", "ne", "so", "ti")
                                for c in ("", "r", "st", "na", "lim")]
    made = []
    while len(made) < count:
        sentence = rng.choices(vocabulary, k=rng.randint(4, 14))
        made += [sentence[0].capitalize(), *sentence[1:-1], sentence[-1] + "."]
    return " ".join(made[:count])


#: Null, empty and very long texts, null ids, repeated rows, ties.
ODD_ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (None, "a row without an id and with some words"),
    (None, "a row without an id and with some words"), (None, None), (6, "x" * 70_000), (7, "long " * 30_000),
    (8, "Ünïcode \U0001F600 wörter, und mehr davon. " * 3), (9, "same row"), (9, "same row"),
    (10, "a\x00b \x0b c <b>&amp; </p> |<|im_end|>"), (11, "CC BY all rights reserved General Public License"),
]
EXTRA = ("id", "n", "size", "kept", "spans", "key", "shard", "class_id", "lang_pred", "score", "places", "target", "_x")


def odd_docs(spark, rows=None):
    """Documents with odd rows and with columns whose names operators use inside."""
    rows = ODD_ROWS if rows is None else rows
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
        f"{c} string" for c in EXTRA)
    full = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None, *EXTRA)
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


def near_copies(rng, count, base_words=90, edits=4, vocabulary=None):
    base = prose(rng, base_words, vocabulary).split()
    made = []
    for _ in range(count):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10 ** 6)}"
        made.append(" ".join(w))
    return made


def seats_rounded(x):
    return math.floor(x + 0.5)


def rng(seed):
    return random.Random(seed)
