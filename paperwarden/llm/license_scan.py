"""Licence scan by a positional index of rare licence words. DataFrame functions only.

A template is a sequence of words with a mandatory key phrase at a fixed place in it. Texts give the positions of
all template words. Document frequencies over the whole corpus rank each template's key words; the positions of its
two rarest (highest IDF) are shifted by their places in the template and intersected, which leaves few candidate
starts; the other key words are then intersected in the same way, which verifies the key phrase. A template's score
at a start is the share of its words that stand in place; a document's score is its best.

One scan of the texts writes word positions; frequencies of at most as many words as the templates have go to the
driver. Everything else is a projection of single rows, without a shuffle.

Defined cases: null and empty texts have no words and no labels, score 0; null ids and repeated rows are rows like
others; words of one frequency rank alphabetically, as all do without rows; texts are read whole, whatever their
length; an empty table gives an empty result. Columns beyond the id and the text are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from paperwarden.operators.scale import Workspace

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``key`` is the mandatory phrase and ``text`` the whole template, which holds it."""

    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_places(self) -> range:
        words, key = self.words, self.key.split()
        first = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
        return range(first, first + len(key))


TEMPLATES = (
    Template("cc-by", "cc by", "cc by", base=True),
    Template("gpl", "general public license", "general public license", base=True),
    Template("reserved", "all rights reserved", "all rights reserved", base=True),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose",
             "permission to use copy modify and or distribute this software"),
    Template("epl-2.0", "made available under the terms of the eclipse public license 2 0", "eclipse public license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
    Template("public-domain", "released into the public domain", "into the public domain"),
)


def vocabulary(templates: Sequence[Template]) -> list[str]:
    return sorted({word for t in templates for word in t.words})


def word_positions(docs: DataFrame, id_col: str, text_col: str, vocab: list[str]) -> DataFrame:
    """Id, number of words, and (word, position) of the words in ``vocab``."""
    lowered = F.translate(F.coalesce(docs[text_col], F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    words = docs.select(docs[id_col].alias("doc_id"), F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("words"))
    at = F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    return words.select("doc_id", F.size("words").cast("long").alias("n_words"),
                        F.filter(at, lambda p: p["word"].isin(vocab)).alias("places"))


def document_frequencies(positions: DataFrame) -> dict[str, int]:
    """Documents that hold each word; the keys are template words, so the answer is bounded."""
    found = positions.select(F.explode(F.array_distinct("places.word")).alias("word")).groupBy("word").count().collect()
    return {row["word"]: row["count"] for row in found}


def _starts(template: Template, place: int) -> Column:
    """Where the template would start for its word at ``place`` to stand where the text has that word."""
    word = template.words[place]
    return F.transform(F.filter("places", lambda p: p["word"] == word), lambda p: p["at"] - place)


def template_starts(template: Template, frequency: dict[str, int]) -> Column:
    """Starts at which the whole key phrase stands, found through the rarest key words first."""
    by_rarity = sorted(template.key_places, key=lambda i: (frequency.get(template.words[i], 0), template.words[i], i))
    found = _starts(template, by_rarity[0])
    for place in by_rarity[1:]:
        found = F.array_intersect(found, _starts(template, place))
    rare = F.lit(True)
    for place in by_rarity[:2]:
        rare = rare & F.array_contains("present", template.words[place])
    return F.when(rare, F.transform(found, lambda s: s.cast("long"))).otherwise(F.array().cast("array<bigint>"))


def _share_in_place(template: Template, starts: Column) -> Column:
    """The largest share of template words in place over all starts; 0 without any."""
    words = template.words

    def share(start: Column) -> Column:
        in_place = F.filter("places", lambda p: F.when(
            (p["at"] >= start) & (p["at"] < start + len(words)),
            p["word"] == F.element_at(F.array(*map(F.lit, words)), (p["at"] - start + 1).cast("int"))).otherwise(False))
        return F.size(in_place) / F.lit(float(len(words)))

    return F.when(F.size(starts) > 0, F.array_max(F.transform(starts, share))).otherwise(0.0)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Id, n_words, matches (label, base, start, share of words in place of every find), base_starts and score."""
    work = Workspace(docs.sparkSession)
    positions = work.table(word_positions(docs, id_col, text_col, vocabulary(templates)))
    frequency = document_frequencies(positions)
    found = positions.withColumn("present", F.array_distinct("places.word"))
    for i, template in enumerate(templates):
        found = found.withColumn(f"_{i}", template_starts(template, frequency))
    labels = F.array_compact(F.array(*[
        F.when(F.size(f"_{i}") > 0, F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
                                             F.col(f"_{i}").alias("starts"))) for i, t in enumerate(templates)]))
    base = F.flatten(F.array(*[F.col(f"_{i}") for i, t in enumerate(templates) if t.base]))
    score = F.greatest(*[_share_in_place(t, F.col(f"_{i}")) for i, t in enumerate(templates)])
    return found.select(F.col("doc_id").alias(id_col), "n_words", labels.alias("matches"),
                        F.array_sort(base).alias("base_starts"), score.alias("score"))
