"""License scans: phrases, and an exact set-similarity join with license templates (built-in functions only).

Words are runs of ASCII letters, digits and all other non-ASCII characters, with A-Z lower-cased.
Base phrases are found where their words stand consecutively. Templates are found by containment:
a text block meets a template if it holds at least ``containment`` of the template's distinct words.
Blocks are windows over the words of the whole text, each half a window after the one before, so that
any half window of words lies in one block however the text is wrapped. A window has ``WINDOW`` words,
or twice as many as the longest template if those are more, so a template held whole is always
within a block. Lines are blocks too, cut the same way when they are longer: a line
lies whole in a block even where it crosses a window's edge.

The join: words are ordered by their frequency in all blocks, rarest first. A block that meets a
template of size n shares at least a = ceil(containment * n) words with it, so (length filter) it
has a template words at least, and (prefix filter) one of the n - a + 1 rarest words of the template
is among all but the a_least - 1 commonest template words of the block. A shared word at places i
and j leaves at most 1 + min(n - i, m - j) common words (positional filter). What is left is
compared in full. The filters drop no pair that meets the threshold.

Defined results: a null text is empty: no words, no labels; texts of any length are scanned whole;
repeated rows are kept as rows; an empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Templates (a parameter): opening words of public licenses and usual notices, with their labels.
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("all rights reserved", "reserved"),
)
CONTAINMENT, WINDOW = 0.9, 64
#: Everything but letters, digits and non-ASCII characters (A-Z count as letters; words are lower-cased after).
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def _known(word: Column, vocabulary: list[str]) -> Column:
    """Is the word, with A-Z lower-cased, in the vocabulary (ASCII words)? Other characters whose
    lower case is ASCII don't count."""
    return F.lower(word).isin(vocabulary) & (F.octet_length(word) == F.length(word))


def phrase_words(all_words: Column, phrases: dict[str, str] = PHRASES) -> Column:
    """Array of (w, i): the words of the phrases, with their places in the text."""
    vocabulary = sorted({w for p in phrases for w in p.split()})
    found = F.transform(
        all_words, lambda w, i: F.when(_known(w, vocabulary), F.struct(F.lower(w).alias("w"), i.alias("i"))))
    return F.filter(found, lambda h: h.isNotNull())


def phrase_places(hits: str, phrase: str) -> Column:
    """Places of one phrase in the column ``hits`` of ``phrase_words``."""
    p = phrase.split()

    def stands(x: Column, k: Column) -> Column:
        ok = x["w"] == p[0]
        for step, word in enumerate(p[1:], 1):
            after = F.get(F.col(hits), k + step)
            ok &= (after["w"] == word) & (after["i"] == x["i"] + step)
        return F.coalesce(ok, F.lit(False))

    return F.transform(F.filter(F.col(hits), stands), lambda x: x["i"])


def window_words(templates: tuple[tuple[str, str], ...]) -> int:
    """Words of a block: at least twice as many as the longest template."""
    return max(WINDOW, *(2 * len(t.split()) for t, _ in templates))


def text_blocks(text: Column, vocabulary: list[str], least: int, window: int) -> Column:
    """The distinct template words of every block that has at least ``least`` of them."""
    half = window // 2

    def windows(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(ws) - half - 1, F.lit(0)), F.lit(half))
        return F.transform(starts, lambda s: F.array_distinct(F.transform(
            F.filter(F.slice(ws, s + 1, window), lambda w: _known(w, vocabulary)), lambda w: F.lower(w))))

    parts = F.concat(F.array(words(text)), F.transform(F.split(text, "\n"), words))
    blocks = F.flatten(F.transform(F.array_distinct(parts), windows))
    return F.array_distinct(F.filter(blocks, lambda b: F.size(b) >= least))


def template_matches(blocks: DataFrame, templates: tuple[tuple[str, str], ...], containment: float) -> DataFrame:
    """(rid, labels, best) of the rows of ``blocks(rid, block)`` that meet a template."""
    spark = blocks.sparkSession
    sets = [(label, set(t.split())) for t, label in templates]
    need = {len(s): ceil(containment * len(s) - 1e-9) for _, s in sets}
    least = min(need.values())
    # frequencies over all blocks; one row per template word reaches the driver
    counted = blocks.select(F.explode("block").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    count = {r["w"]: r["n"] for r in counted}
    order = sorted({w for _, s in sets for w in s}, key=lambda w: (count.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for label, s in sets:
        ranks, a = sorted(rank[w] for w in s), need[len(s)]
        index += [(r, i, len(s), a, label, ranks) for i, r in enumerate(ranks[: len(s) - a + 1])]
    index = spark.createDataFrame(index, "r int, i int, n int, a int, label string, template array<int>")

    to_rank = F.create_map(*[F.lit(x) for w, i in rank.items() for x in (w, i)])
    ranked = blocks.select("rid", F.array_sort(F.transform("block", lambda w: F.element_at(to_rank, w))).alias("ranks"))
    prefix = ranked.select("rid", "ranks", F.posexplode(F.slice("ranks", F.lit(1), F.size("ranks") - least + 1)).alias("j", "r"))
    pairs = prefix.join(F.broadcast(index), "r").filter(  # the index holds the template list only
        (F.size("ranks") >= F.col("a")) & (1 + F.least(F.col("n") - 1 - F.col("i"), F.size("ranks") - 1 - F.col("j")) >= F.col("a")))
    common = F.size(F.array_intersect("ranks", "template"))
    met = pairs.withColumn("common", common).filter("common >= a")
    return met.groupBy("rid").agg(F.collect_set("label").alias("labels"), F.max(F.col("common") / F.col("n")).alias("best"))


def license_scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the best containment of a template that is met, and 1 with a base phrase."""
    sets = [set(t.split()) for t, _ in templates]
    vocabulary = sorted(set().union(*sets))
    least = min(ceil(containment * len(s) - 1e-9) for s in sets)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", words(text).alias("ws"), text_blocks(text, vocabulary, least, window_words(templates)).alias("blocks"))
    rows = rows.select("doc_id", F.size("ws").cast("long").alias("n_words"), phrase_words(F.col("ws")).alias("hits"), "blocks")
    names = [f"p{i}" for i in range(len(PHRASES))]
    rows = rows.select("doc_id", "n_words", "blocks", *[phrase_places("hits", p).alias(n) for n, p in zip(names, PHRASES)])
    rows = rows.withColumn("places", F.concat(*names)).select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "n_words", "blocks",
        F.size("places").cast("long").alias("n_base"), F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_compact(F.array(*[F.when(F.size(n) > 0, F.lit(b)) for n, b in zip(names, PHRASES.values())])).alias("base"))
    rows = staged(rows, "license-rows")  # fixes the row ids
    met = template_matches(rows.select("rid", F.explode("blocks").alias("block")), templates, containment)
    rows = rows.select("rid", "doc_id", "n_words", "n_base", "first_word", "last_word", "base").join(met, "rid", "left")
    base = F.array_sort(F.array_distinct("base"))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("labels", F.array().cast("array<string>")))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(base, ",").alias("base_labels"),
                       F.array_join(labels, ",").alias("labels"), score.alias("score"))
