"""License scans: named phrases, and an exact set-similarity join of text blocks with templates.

A document is cut into blocks of ``BLOCK`` words that overlap by half. A block meets a
template when it holds at least ``threshold`` of the template's different words
(containment). The join finds every such block:

* tokens are ordered by their count over all documents, rarest first, ties by the token. Only
  template words can overlap, so only they are counted and ordered;
* prefix filter: a template of n words that is met in at least k = ceil(threshold * n) of them
  has one of its n - k + 1 rarest words in the block. These prefixes make an inverted index
  (word -> templates), which is as large as the template table, a parameter;
* length filter: a block with fewer than k different template words cannot meet the template;
* positional filter: where the first shared word stands at place i of the template's n and at place j of
  the block's m words, in that order, at most min(n - i, m - j) words can be shared;
* the pairs left are verified by the exact intersection. Of the words that mark a template, those in
  no template of another label, the block must hold the same share, so texts that differ in the one
  deciding word (lesser, nc, mit) are told apart.

Each document's blocks probe the index in its own row, so nothing is shuffled but the
word counts, which are added up before the exchange, and a hot source changes nothing.

Defined results: a null or empty text has no words, no labels and score 0; a text of fewer
words than a block is one block; repeated rows are scanned one by one; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import SYMBOL_CLASS, lower_ascii, split_words, whole

#: Phrase and label.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Label and text of the templates: how licenses are usually named or opened in running text.
TEMPLATES = (
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license version 3"),
    ("gpl", "distributed under the gnu general public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("mpl", "subject to the terms of the mozilla public license"),
)

THRESHOLD = 0.8
BLOCK = 32


def template_sets(templates=TEMPLATES) -> list[tuple[str, list[str]]]:
    return [(label, sorted(set(text.split()))) for label, text in templates]


def marks(templates=TEMPLATES) -> list[list[str]]:
    """Per template its words that no template of another label has."""
    sets = template_sets(templates)
    return [[w for w in ws if not any(w in other for name, other in sets if name != label)] for label, ws in sets]


def _words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole(F.col(text_col))
    return docs.select(F.col(id_col), split_words(lower_ascii(text), SYMBOL_CLASS).alias("__w"))


def token_counts(words: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """How often each template word stands in all documents; the result is as large as the
    templates' vocabulary."""
    vocabulary = sorted({w for _, ws in template_sets(templates) for w in ws})
    hits = words.select(F.explode(F.filter("__w", lambda w: w.isin(vocabulary))).alias("w"))
    counts = {r["w"]: r["n"] for r in hits.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return {w: counts.get(w, 0) for w in vocabulary}


def prefix_index(order: list[str], templates=TEMPLATES, threshold: float = THRESHOLD) -> list[list[tuple[int, int]]]:
    """Per word of the common order: (template, place of the word in the template's order) where it is in the prefix."""
    rank, index = {w: r for r, w in enumerate(order)}, [[] for _ in order]
    for t, (_, ws) in enumerate(template_sets(templates)):
        ranks = sorted(rank[w] for w in ws)
        for i, r in enumerate(ranks[: len(ws) - needed(len(ws), threshold) + 1]):
            index[r].append((t, i))
    return index


def needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def phrase_starts(words: Column, phrases=PHRASES) -> Column:
    """Ascending array of struct(start, label) of all places of all phrases."""

    def at(w: Column, i: Column) -> Column:
        place = F.lit(None).cast("string")
        for phrase, label in phrases:
            first, *rest = phrase.split(" ")
            fits = w == first
            for k, word in enumerate(rest, 1):
                fits = fits & F.coalesce(F.get(words, i + k) == word, F.lit(False))
            place = F.when(fits, label).otherwise(place)
        return F.when(place.isNotNull(), F.struct(i.alias("start"), place.alias("label")))

    return F.array_compact(F.transform(words, at))


def scan(
    docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score (the
    greatest containment met, 1 where a phrase stands, else 0) and ``blocks``: the met
    (block, template, containment)."""
    words = _words(docs, id_col, text_col)
    sets = template_sets(templates)
    counts = token_counts(words, templates)
    order = sorted(counts, key=lambda x: (counts[x], x))
    index = prefix_index(order, templates, threshold)
    prefix_words = sorted(x for x, places in zip(order, index, strict=True) if places)
    half = block // 2
    w = F.col("__w")
    hits = F.array_compact(F.transform(w, lambda x, i: F.when(x.isin(prefix_words), i)))
    probed = words.select(id_col, "__w", phrase_starts(w, phrases).alias("__base"), hits.alias("__hits"))

    entry = "array<struct<t:int,i:int>>"
    table = F.array(*(F.array(*(F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for t, i in places)).cast(entry) for places in index))
    ranks = F.create_map(*(x for r, word in enumerate(order) for x in (F.lit(word), F.lit(r))))
    last_block = F.greatest(F.ceil((F.size("__w") - block) / half), F.lit(0)).cast("int")
    places = F.transform("__hits", lambda i: F.floor(i / half).cast("int"))
    near = F.array_distinct(F.flatten(F.transform(places, lambda b: F.filter(F.array(b - 1, b), lambda x: (x >= 0) & (x <= last_block)))))

    def contents(b: Column) -> Column:
        content = F.slice(w, b * half + 1, F.lit(block))
        own = F.array_compact(F.transform(F.array_distinct(content), lambda x: F.try_element_at(ranks, x)))
        return F.struct(b.alias("b"), content.alias("content"), F.array_sort(own).alias("ranks"))

    blocks = probed.select(
        id_col, "__w", "__base",
        F.transform(F.when(F.size("__hits") > 0, near).otherwise(F.array().cast("array<int>")), contents).alias("__blocks"),
    )
    sizes = F.array(*(F.lit(len(ws)) for _, ws in sets))
    needs = F.array(*(F.lit(needed(len(ws), threshold)) for _, ws in sets))
    members = F.array(*(F.array(*map(F.lit, ws)) for _, ws in sets))
    marked = F.array(*(F.array(*map(F.lit, ws)).cast("array<string>") for ws in marks(templates)))
    marks_needed = F.array(*(F.lit(needed(len(ws), threshold) if ws else 0) for ws in marks(templates)))

    def candidates(x: Column) -> Column:
        """Templates that may be met, by the length and the positional filter."""
        m = F.size(x["ranks"])

        def possible(r: Column, j: Column) -> Column:
            return F.transform(F.filter(F.get(table, r), lambda e: (
                (m >= F.get(needs, e["t"])) & (F.least(F.get(sizes, e["t"]) - e["i"], m - j) >= F.get(needs, e["t"]))
            )), lambda e: e["t"])

        return F.array_distinct(F.flatten(F.transform(x["ranks"], possible)))

    def verified(x: Column) -> Column:
        def one(t: Column) -> Column:
            shared = F.size(F.array_intersect(x["content"], F.get(members, t)))
            own = F.size(F.array_intersect(x["content"], F.get(marked, t)))
            return F.when((shared >= F.get(needs, t)) & (own >= F.get(marks_needed, t)), F.struct(
                x["b"].alias("block"), t.alias("template"), (shared / F.get(sizes, t)).alias("containment")
            ))

        return F.array_compact(F.transform(candidates(x), one))

    met = blocks.select(
        id_col, F.size("__w").cast("long").alias("n_words"), "__base",
        F.flatten(F.transform("__blocks", verified)).alias("blocks"),
    )
    names = F.array(*(F.lit(label) for label, _ in sets))
    base = F.transform("__base", lambda x: x["label"])
    own = F.transform("blocks", lambda x: F.get(names, x["template"]))
    return met.select(
        id_col, "n_words", F.size("__base").cast("long").alias("n_base"),
        F.array_min(F.transform("__base", lambda x: x["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("__base", lambda x: x["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.when(F.size("__base") > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.transform("blocks", lambda x: x["containment"])), F.lit(0.0))
        ).alias("score"),
        "blocks",
    )
