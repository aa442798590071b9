"""Licence scans: exact set-similarity join of text blocks with licence templates, and exact phrases.

Words are runs of ASCII letters and digits and of characters beyond ASCII. A
block is a window of twice the longest template's words, one for every such
length of words, so each passage as long as a template lies whole in a block.
A block matches a template when it holds at least ``threshold`` of the
template's distinct words (containment), and all of them where they are under
``SHORT``: one word less may be another licence ("the BSD License").

The join is exact. Template words are ordered by their frequency in all
documents, rare ones first. A template of m words that needs o of them shares
at least one of its first m - o + 1 with any matching block (prefix filter);
a block with fewer than o template words can't match (length filter); nor one
where too few words follow the shared one in either order (positional filter).
What is left is verified by counting.

All DataFrame functions. Literals hold template words only, at most
``MAX_TEMPLATE_WORDS``. Documents are read twice: once for the frequencies,
once for the blocks; a document with no prefix word makes no block. Hits are
gathered by the text's SHA-256, so copies of one text share them.

Defined results: null and blank texts have no words, no places and no labels;
their first and last word are null and their score is 0. Score: 1 if a phrase
stands in the text, else the greatest containment that reached the threshold.
Capitals beyond ASCII count as their small letters in templates and blocks.
Without templates only the phrases are found. Repeated rows give equal rows.
A very long text is scanned whole, block by block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import bind, col, fresh, prepared_session, staged, table

#: Phrases and their labels.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
#: Labels and the opening words of public licence notices.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
]
THRESHOLD = 0.8
SHORT = 10
MAX_TEMPLATE_WORDS = 20_000
OUTPUTS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def license_words(text: Column) -> Column:
    """Lower-cased words of a text. The Kelvin sign, whose small letter is ASCII, stays beyond ASCII."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.filter(F.split(lowered, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def phrase_places(w: Column, joined: Column, phrase: str) -> Column:
    """Start positions of a phrase in ``w``; ``joined`` is `` w1 w2 ... `` and spares most texts the search."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        same = F.lit(True)
        for k, p in enumerate(parts):
            same = same & (F.get(w, i + k) == p)
        return same

    found = F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), here)
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))


class Templates:
    """Distinct template words, their global order, and each template's prefix."""

    def __init__(self, spark: SparkSession, templates: list[tuple[str, str]], threshold: float):
        if not 0 < threshold <= 1:
            raise ValueError("threshold must lie in (0, 1]")
        rows = spark.createDataFrame(templates, "label string, text string").select("label", license_words(F.col("text")).alias("w")).collect()
        self.items = [(r.label, sorted(set(r.w)), len(r.w)) for r in rows if r.w]
        self.threshold = threshold
        self.vocabulary = sorted({w for _, ws, _ in self.items for w in ws})
        if len(self.vocabulary) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates have more than {MAX_TEMPLATE_WORDS} distinct words")
        self.step = max([n for _, _, n in self.items], default=1)

    def order(self, counts: dict[str, int]) -> None:
        by_rarity = sorted(self.vocabulary, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(by_rarity)}
        self.rows = []
        for k, (label, ws, _) in enumerate(self.items):
            ranks = sorted(self.rank[w] for w in ws)
            need = len(ranks) if len(ranks) < SHORT else math.ceil(self.threshold * len(ranks) - 1e-9)
            self.rows += [(k, label, ranks, need, i, r) for i, r in enumerate(ranks[: len(ranks) - need + 1])]
        self.prefix = sorted({by_rarity[r[5]] for r in self.rows})


def word_counts(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """How often each template word occurs in all documents: at most one row a template word comes back."""
    if not vocabulary:
        return {}
    kept = F.filter(license_words(col(text)), lambda w: w.isin(vocabulary))
    return {r.w: r.n for r in docs.select(F.explode(kept).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}


def scan_licenses(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                  templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
                  phrases: list[tuple[str, str]] | None = None) -> DataFrame:
    """Append n_words, n_base, first_word, last_word, base_labels, labels, score; clashing columns are replaced."""
    spark = prepared_session(docs.sparkSession)
    known = Templates(spark, TEMPLATES if templates is None else templates, threshold)
    known.order(word_counts(docs, text, known.vocabulary))
    phrases = PHRASES if phrases is None else phrases
    step = known.step
    own = [c for c in (docs.columns if keep is None else keep) if c.lower() not in OUTPUTS]
    name, digest, hits_ = fresh(docs, "license_row"), fresh(docs, "license_digest"), fresh(docs, "license_hits")

    def measured(w: Column) -> Column:
        joined = F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
        places = bind(joined, lambda j: F.array(*[phrase_places(w, j, p) for p, _ in phrases])) if phrases else F.array().cast("array<array<int>>")
        hits = F.filter(F.transform(w, lambda x, i: F.when(x.isin(known.prefix), i)), lambda i: i.isNotNull()) if known.prefix else F.array().cast("array<int>")
        # a hit at word i lies in the window that starts at its step and in the one before
        firsts = lambda h: F.array_distinct(F.flatten(F.transform(h, lambda i: F.array((i / step).cast("int"), F.greatest((i / step).cast("int") - 1, F.lit(0))))))
        known_words = lambda b: F.array_distinct(F.filter(F.slice(w, b * step + 1, 2 * step), lambda x: x.isin(known.vocabulary)))
        blocks = bind(hits, lambda h: F.transform(firsts(h), known_words))
        return F.struct(F.size(w).cast("long").alias("n_words"), places.alias("places"), blocks.alias("blocks"))

    marked = docs.select(*[col(c) for c in own], F.sha2(F.coalesce(col(text), F.lit("")), 256).alias(digest), bind(license_words(col(text)), measured).alias(name))
    rows, r = staged(marked, "license-blocks"), F.col(name)

    # block x template, by the words of the templates' prefixes
    ranks = F.create_map(*[F.lit(x) for p in known.rank.items() for x in p]) if known.rank else F.create_map().cast("map<string,int>")
    block = F.sort_array(F.transform(F.col("block"), lambda x: F.element_at(ranks, x)))
    blocks = rows.select(F.col(digest).alias("d"), F.explode(r["blocks"]).alias("block")).distinct().select("d", block.alias("block"))
    words_ = blocks.select("d", "block", F.posexplode("block").alias("j", "rank"))
    right = spark.createDataFrame(known.rows, "t int, label string, t_ranks array<int>, need int, i int, rank int")
    left_over = F.least(F.size("t_ranks") - F.col("i"), F.size("block") - F.col("j"))
    reached = F.lit(1) + F.least(F.col("i"), F.col("j")) - 1 + left_over  # words up to the shared one, and after it
    pairs = words_.join(right, "rank").where((F.size("block") >= F.col("need")) & (reached >= F.col("need")))
    pairs = pairs.select("d", "block", "t", "label", "t_ranks", "need").distinct()
    overlap = F.size(F.array_intersect("block", "t_ranks"))
    matches = pairs.where(overlap >= F.col("need")).select("d", "label", (overlap / F.size("t_ranks")).alias("share"))
    found = matches.groupBy("d").agg(F.collect_set("label").alias("labels"), F.max("share").alias("share"))
    found = found.select(F.col("d").alias(digest), F.struct("labels", "share").alias(hits_))
    # written first: a join that reads both sides anew can split the partition of a text with many copies
    found = staged(found, "license-hits")

    all_places = F.flatten(r["places"])
    labelled = [F.when(F.size(r["places"][k]) > 0, F.lit(label)) for k, (_, label) in enumerate(phrases)]
    base = F.array_distinct(F.filter(F.array(*labelled), lambda x: x.isNotNull())) if labelled else F.array().cast("array<string>")
    listed = lambda a: F.array_join(F.sort_array(a), ",")
    both = F.array_distinct(F.concat(base, F.coalesce(F.col(hits_)["labels"], F.array().cast("array<string>"))))
    return rows.join(found, digest, "left").select(
        *[col(c) for c in own], r["n_words"].alias("n_words"), F.size(all_places).cast("long").alias("n_base"),
        F.array_min(all_places).cast("long").alias("first_word"), F.array_max(all_places).cast("long").alias("last_word"),
        listed(base).alias("base_labels"), listed(both).alias("labels"),
        F.when(F.size(all_places) > 0, F.lit(1.0)).otherwise(F.coalesce(F.col(hits_)["share"], F.lit(0.0))).alias("score"),
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
