"""License scans: phrases, and an exact set-similarity join with license templates.

The plain part finds fixed phrases.  The method part finds every block of text
(a sentence or line) that contains at least ``THRESHOLD`` of the distinct words
of a template.  Template words are ordered by how often they occur in all
documents, the rarest first.  A block that contains enough of a template must
contain one of the template's first words (prefix filter), have enough template
words at all (length filter), and the places of a shared word in both orders
must leave room for enough others (positional filter).  Pairs that pass are
counted exactly.

A notice that is wrapped has no such block, so with ``wrapped``, as in the query,
runs of words are compared as well, whatever line or sentence ends are in them:
``length of the template / THRESHOLD`` words, rounded up.  Every such run contains
a first word, so only runs around these are looked at; those with enough template
words within reach are counted exactly, from every start.

Everything is DataFrame functions.  Only template words and templates, which are
parameters, are broadcast; documents without any first word leave early.

Null text is the empty text: no words, no labels, score 0.  ``base_labels`` and
``labels`` are empty strings where there are none.  Rows with equal ``doc_id``
and text have equal results, one per row; null ids are kept.  The score is 1
with a phrase, else the greatest containment found, else 0.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragcube.session import literal

THRESHOLD = 0.8
#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Opening words of well-known license notices and their labels (fixed values).
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Where a block ends: a line end, or a sentence end before white space.
BLOCK_END = "\\n|[.!?](?=\\s)"


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), CAPITALS, CAPITALS.lower())


def spaced(text: Column) -> Column:
    """The words of a lower-cased text, each between single spaces."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, NOT_WORD, " ")), F.lit(" "))


def spaces(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def word_frequency(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """Places of each given word in all documents; one row per given word reaches the driver."""
    each = docs.select(F.explode(F.split(spaced(lowered(F.col("text"))), " ")).alias("w")).filter(F.col("w").isin(words))
    found = {r["w"]: r["n"] for r in each.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: found.get(w, 0) for w in words}


def phrase_columns(t: Column, phrases: dict[str, str]) -> list[Column]:
    """Counts, places and labels of the phrases in the spaced words ``t``."""
    any_of = "|".join(sorted(phrases, key=lambda p: (-len(p), p)))
    has = F.lit(False)
    for p in phrases:
        has = has | F.contains(t, F.lit(f" {p} "))
    parts = F.split(t, f"(?<= )(?=(?:{any_of}) )")
    n_words = F.when(t == "  ", 0).otherwise(spaces(t) - 1).cast("long")
    labels = F.array(*(F.when(F.contains(t, F.lit(f" {p} ")), F.lit(label)) for p, label in phrases.items()))
    return [
        n_words.alias("n_words"),
        F.when(has, F.size(parts) - 1).otherwise(0).cast("long").alias("n_base"),
        F.when(has, spaces(F.element_at(parts, 1)) - 1).alias("first_word"),
        F.when(has, n_words - spaces(F.element_at(parts, -1))).alias("last_word"),
        F.when(has, F.array_distinct(F.array_compact(labels))).otherwise(F.array().cast("array<string>")).alias("base"),
    ]


def template_tables(docs: DataFrame, templates: tuple, threshold: float) -> tuple[DataFrame, DataFrame, list[str]]:
    """(word, rank), (rank, template, place, size, need, ranks, label) of the prefixes, and the prefix words."""
    spark = docs.sparkSession
    sets = [(label, sorted(set(text.split()))) for label, text in templates]
    counts = word_frequency(docs, sorted({w for _, s in sets for w in s}))
    order = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}
    prefixes = []
    for t, (label, words) in enumerate(sets):
        ranks = sorted(order[w] for w in words)
        need = math.ceil(threshold * len(ranks) - 1e-9)
        for place, rank in enumerate(ranks[: len(ranks) - need + 1]):
            prefixes.append((rank, t, place, len(ranks), need, ranks, label))
    names = sorted(order, key=order.get)
    words = literal(spark, [(w, i) for i, w in enumerate(names)], "word string, rank int")
    table = literal(spark, prefixes, "rank int, template int, place int, size int, need int, ranks array<int>, label string")
    return words, table, sorted({names[p[0]] for p in prefixes})


def matches(docs: DataFrame, templates: tuple = TEMPLATES, threshold: float = THRESHOLD, tables: tuple | None = None) -> DataFrame:
    """``doc_id``, ``key`` (of the text), ``block`` (number), ``template``, ``label`` and ``containment`` of every match."""
    words, prefixes, first_words = tables or template_tables(docs, templates, threshold)
    texts = docs.select("doc_id", "text", lowered(F.col("text")).alias("low"))
    some = texts.filter(F.exists(F.split(spaced(F.col("low")), " "), lambda w: w.isin(first_words)))
    blocks = some.select("doc_id", F.md5("text").alias("key"), F.posexplode(F.split("low", BLOCK_END)).alias("block", "line"))
    each = blocks.select("doc_id", "key", "block", F.explode(F.split(spaced(F.col("line")), " ")).alias("word"))
    ranked = each.join(F.broadcast(words), "word").groupBy("doc_id", "key", "block").agg(F.sort_array(F.collect_set("rank")).alias("own"))
    at = ranked.select("*", F.size("own").alias("own_size"), F.posexplode("own").alias("own_place", "rank"))
    pairs = at.join(F.broadcast(prefixes), "rank").filter("own_size >= need").filter(
        "least(own_place, place) + 1 + least(own_size - own_place - 1, size - place - 1) >= need"
    )
    shared = F.size(F.array_intersect("own", "ranks"))
    counted = pairs.withColumn("shared", shared).filter("shared >= need")
    return counted.select("doc_id", "key", "block", "template", "label", (F.col("shared") / F.col("size")).alias("containment")).distinct()


def run_matches(docs: DataFrame, templates: tuple = TEMPLATES, threshold: float = THRESHOLD, tables: tuple | None = None) -> DataFrame:
    """``doc_id``, ``key`` (of the text), ``template``, ``label`` and ``containment`` of the best run of words for each template that has one."""
    words, prefixes, first_words = tables or template_tables(docs, templates, threshold)
    widths = [math.ceil(len(text.split()) / threshold - 1e-9) for _, text in templates]
    sets = literal(
        docs.sparkSession, [(t, widths[t], sorted(set(text.split()))) for t, (_, text) in enumerate(templates)], "template int, width int, words array<string>"
    )
    anchors = prefixes.join(words, "rank").join(sets, "template").select("template", "label", "size", "need", "width", "words", "word")
    wide = max(widths, default=1)
    texts = docs.select("doc_id", F.md5("text").alias("key"), F.split(F.trim(spaced(lowered(F.col("text")))), " ").alias("own"))
    some = texts.filter(F.exists("own", lambda w: w.isin(first_words)))

    def around(w: Column, i: Column) -> Column:
        """A first word with the words that can share a run with it; ``at`` is its place among them."""
        before = F.least(i, F.lit(wide - 1))
        near = F.slice("own", i - before + 1, before + wide)
        return F.when(w.isin(first_words), F.struct(w.alias("word"), (before + 1).alias("at"), near.alias("near")))

    each = some.select("doc_id", "key", F.explode(F.array_compact(F.transform("own", around))).alias("a")).select("doc_id", "key", "a.*")
    pairs = each.join(F.broadcast(anchors), "word")
    start = F.greatest(F.col("at") - F.col("width") + 1, F.lit(1))
    reach = F.slice("near", start, F.col("at") - start + F.col("width"))
    close = pairs.filter(F.size(F.array_intersect(reach, "words")) >= F.col("need"))
    shared = F.array_max(F.transform(F.sequence(start, F.col("at")), lambda s: F.size(F.array_intersect(F.slice("near", s, F.col("width")), "words"))))
    counted = close.withColumn("shared", shared).filter("shared >= need")
    return counted.groupBy("doc_id", "key", "template", "label").agg(F.max(F.col("shared") / F.col("size")).alias("containment"))


def scan(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: tuple = TEMPLATES, threshold: float = THRESHOLD, wrapped: bool = False
) -> DataFrame:
    """One row per document; ``wrapped`` also finds notices over several lines, in :func:`run_matches`."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    t = F.col("t")
    base = docs.select("doc_id", F.coalesce(F.md5("text"), F.lit("")).alias("key"), spaced(lowered(F.col("text"))).alias("t"))
    base = base.select("doc_id", "key", *phrase_columns(t, phrases))
    tables = template_tables(docs, templates, threshold)
    hits = matches(docs, templates, threshold, tables).select("doc_id", "key", "label", "containment")
    if wrapped:
        hits = hits.unionByName(run_matches(docs, templates, threshold, tables).select("doc_id", "key", "label", "containment"))
    found = hits.groupBy("doc_id", "key").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    same = F.col("b.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("b.key") == F.col("f.key"))
    joined = base.alias("b").join(found.alias("f"), same, "left")
    all_labels = F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        "b.doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(F.array_sort(all_labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
