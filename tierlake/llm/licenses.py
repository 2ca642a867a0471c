"""License scans: base phrases, and notices found by an exact set-similarity join.

A block (a line of a text) matches a template when it holds at least ``threshold`` of the
template's distinct words, its distinguishing words among them. Words are put into one global order, rarest first by the number of
blocks that have them. If the overlap must reach ``least`` words, a block and a template that
match share a word among the first ``size - least + 1`` of each (prefix filter); blocks need at
least that many template words (length filter); and from the places of the shared word the overlap
still to be had must suffice (position filter). What remains is counted exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.session import materialize

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices as public licenses word them, by label.
TEMPLATES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-conditions": "you may not use this file except in compliance with the license",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-program": "this program is free software you can redistribute it and or modify it under the terms of the"
                   " gnu general public license",
    "mit-notice": "released under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software"
                      " and associated documentation files",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are"
                          " permitted provided that the following conditions are met",
}
# Words without which a block isn't that notice, however many of the others it has.
DISTINGUISHING = {
    "apache-notice": "apache",
    "gpl-notice": "gnu general public",
    "gpl-program": "gnu general public",
    "mit-notice": "mit",
    "cc-by-notice": "cc by",
    "cc-by-nc-notice": "cc by nc",
}
THRESHOLD = 0.8

_APART = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"  # what parts words, but for the line feed
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _count(text: Column, char: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))).cast("long")


def least_overlap(words: int, threshold: float) -> int:
    """Fewest shared words that make a share of at least ``threshold``."""
    return max(1, math.ceil(round(threshold * words, 9)))


def _documents(docs: DataFrame, id_column: str, text_column: str, vocabulary: list[str], fewest: int) -> DataFrame:
    """One row for each document: counts of words and phrases, and its blocks' template words."""
    lowered = F.translate(F.coalesce(F.col(text_column).cast("string"), F.lit("")), _UPPER, _LOWER)
    rows = docs.select(F.col(id_column).alias("id"), F.regexp_replace(lowered, _APART, " ").alias("spaced"))
    flat = F.concat(F.lit(" "), F.trim(F.regexp_replace("spaced", r"[ \n]+", " ")), F.lit(" "))
    rows = rows.select("id", "spaced", flat.alias("flat"))
    anywhere = "|".join(PHRASES)
    parts = F.when(
        F.expr(" OR ".join(f"contains(flat, ' {phrase} ')" for phrase in PHRASES)),
        F.split("flat", f"(?<= )(?=(?:{anywhere}) )"))
    known = F.array(*map(F.lit, vocabulary))
    blocks = F.filter(
        F.transform(F.split("spaced", "\n"), lambda line: F.array_intersect(F.split(line, " "), known)),
        lambda words: F.size(words) >= fewest)
    labels = [F.when(F.col("flat").contains(f" {phrase} "), F.lit(label)) for phrase, label in PHRASES.items()]
    rows = rows.select(
        "id", F.when(F.col("flat") == "  ", F.lit(0)).otherwise(_count(F.col("flat"), " ") - 1).cast("long").alias("n_words"),
        parts.alias("parts"), F.array_sort(F.array_compact(F.array(*labels))).alias("base"), blocks.alias("blocks"))
    return rows.select(
        "id", "n_words", F.coalesce(F.size("parts") - 1, F.lit(0)).cast("long").alias("n_base"),
        (_count(F.element_at("parts", 1), " ") - 1).alias("first_word"),
        (F.col("n_words") - _count(F.element_at("parts", -1), " ")).alias("last_word"), "base", "blocks")


def _word_ranks(blocks: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """The global order: words by the number of blocks that have them, then by spelling."""
    counts = blocks.select(F.explode("words").alias("word")).groupBy("word").count().collect()  # at most the vocabulary
    seen = {r["word"]: r["count"] for r in counts}
    return {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}


def matching_blocks(
    blocks: DataFrame, templates: dict[str, str], threshold: float = THRESHOLD, distinguishing: dict[str, str] | None = None,
) -> DataFrame:
    """(row, block, label, containment) of all blocks of ``blocks(row, block, words)`` that match a template.

    ``words`` are distinct words of the templates; ``distinguishing`` gives, by label, words of the template
    that a block must have. The templates are few and fixed by the caller, so their side is broadcast;
    blocks never move.
    """
    spark = blocks.sparkSession
    sets = {label: sorted(set(text.split())) for label, text in templates.items()}
    ranks = _word_ranks(blocks, sorted({w for words in sets.values() for w in words}))
    prefixes = []
    for label, words in sets.items():
        words = sorted(words, key=ranks.__getitem__)
        least = least_overlap(len(words), threshold)
        needed = [ranks[w] for w in (distinguishing or {}).get(label, "").split()]
        prefixes += [(ranks[w], label, at, len(words), least, sorted(map(ranks.__getitem__, words)), needed)
                     for at, w in enumerate(words[:len(words) - least + 1])]
    index = F.broadcast(spark.createDataFrame(
        prefixes, "rank int, label string, at int, size int, least int, template array<int>, needed array<int>"))
    order = F.create_map(*(F.lit(x) for pair in ranks.items() for x in pair))
    ordered = blocks.select("row", "block", F.array_sort(F.transform("words", lambda w: order[w])).alias("own"))
    smallest = min(p[4] for p in prefixes)
    prefix = F.slice("own", F.lit(1), F.size("own") - smallest + 1)
    found = ordered.filter(F.size("own") >= smallest).select(
        "row", "block", "own", F.posexplode(prefix).alias("place", "rank")).join(index, "rank")
    reachable = F.least(F.col("size") - F.col("at"), F.size("own") - F.col("place"))
    found = found.filter(
        (F.size("own") >= F.col("least")) & (F.col("place") <= F.size("own") - F.col("least"))
        & (reachable >= F.col("least") - F.least("at", "place")))
    overlap = F.size(F.array_intersect("own", "template"))
    has_needed = F.size(F.array_except("needed", "own")) == 0
    return (found.filter(has_needed).select("row", "block", "label", overlap.alias("overlap"), "least", "size")
            .filter("overlap >= least")
            .select("row", "block", "label", (F.col("overlap") / F.col("size")).alias("containment")).distinct())


def scan_licenses(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD, distinguishing: dict[str, str] | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: (id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are the
    smallest and largest word number at which one starts, null if none does. ``labels`` adds the
    labels of matching templates. ``score`` is 1 with a base phrase, else the best containment that
    reached the threshold, else 0. Null and empty texts have no words, no labels and score 0.
    Repeated rows give repeated rows. Other columns are not looked at.
    """
    if not templates:
        templates, distinguishing = TEMPLATES, DISTINGUISHING if distinguishing is None else distinguishing
    vocabulary = sorted({w for text in templates.values() for w in text.split()})
    fewest = min(least_overlap(len(set(t.split())), threshold) for t in templates.values())
    rows = materialize(_documents(docs, id_column, text_column, vocabulary, fewest).withColumn(
        "row", F.monotonically_increasing_id()))
    blocks = rows.select("row", F.posexplode("blocks").alias("block", "words"))
    best = matching_blocks(blocks, templates, threshold, distinguishing).groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("containment"))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))))
    return rows.join(best, "row", "left").select(
        "id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"))
