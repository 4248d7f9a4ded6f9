"""License notices by exact set-similarity join.

A text block is a window of BLOCK words; a window begins every STEP words, so that any passage
of up to BLOCK - STEP + 1 words lies in one window whole. A template is found in a block when
the block has at least ``threshold`` of the template's distinct words. Longer templates enter
as consecutive pieces of PIECE words.

The join is exact. Template words are ordered by their frequency in all documents, rarest
first. A block that reaches the overlap must have one of the first ``size - overlap + 1`` words
of the template (prefix filter), at least as many template words as the overlap (length
filter), and enough words left in the order from the one that matched (positional filter).
What passes is verified on the whole sets. Everything is DataFrame functions.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import ascii_lower, stored

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK, STEP, PIECE = 64, 32, 32
THRESHOLD = 0.9

# Phrases that give a label wherever their words stand consecutively.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}

# Public notices, in lower case and without punctuation.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved"),
]


def template_sets(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[tuple[str, list[str], int]]:
    """``(label, distinct words, least overlap)`` of every template piece."""
    out = []
    for label, text in templates:
        own = text.split()
        for i in range(0, len(own), PIECE):
            piece = list(dict.fromkeys(own[i : i + PIECE]))
            out.append((label, piece, ceil(threshold * len(piece) - 1e-9)))
    return out


def _strings(values) -> Column:
    return F.array(*(F.lit(v) for v in values))


def word_line(text: Column) -> Column:
    """The words in lower case with one space before, between and after; empty without words."""
    line = F.regexp_replace(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), NOT_WORD, " ")
    bare = F.trim(line)
    return F.when(bare == "", F.lit("")).otherwise(F.concat(F.lit(" "), bare, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _frequencies(lines: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each template word is; one row per template word is collected."""
    found = lines.select(F.explode(F.array_intersect(F.split("line", " "), _strings(vocabulary))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def find_blocks(lines: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``uid, block, label, containment``: every block and template piece that meet the threshold.

    ``lines`` has ``uid`` and ``line`` as made by ``word_line``.
    """
    spark = lines.sparkSession
    sets = template_sets(templates, threshold)
    vocabulary = sorted({w for _, own, _ in sets for w in own})
    counts = _frequencies(lines, vocabulary)
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for label, own, least in sets:
        ranks = sorted(rank[w] for w in own)
        rows += [(r, label, ranks, least) for r in ranks[: len(ranks) - least + 1]]
    # Bounded by the words of the templates, which are a parameter.
    prefixes = F.broadcast(spark.createDataFrame(rows, "rank int, label string, ranks array<int>, least int"))
    rare = sorted({order[r] for r, *_ in rows})
    shortest = min(least for *_, least in sets)

    own = F.split(F.trim("line"), " ")
    near = lines.select("uid", own.alias("own")).filter(F.arrays_overlap("own", _strings(rare)))
    last = F.greatest(F.lit(0), F.ceil((F.size("own") - BLOCK) / STEP)).cast("int")
    blocks = near.select("uid", "own", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    words = F.slice("own", F.col("block") * STEP + 1, F.lit(BLOCK))
    numbers = F.create_map(*(F.lit(x) for w in order for x in (w, rank[w])))
    hits = blocks.select("uid", "block", F.array_intersect(words, _strings(order)).alias("hits")).filter(
        (F.size("hits") >= shortest) & F.arrays_overlap("hits", _strings(rare))
    )
    ranked = hits.select("uid", "block", F.array_sort(F.transform("hits", lambda w: numbers[w])).alias("mine"))
    probes = ranked.select("uid", "block", "mine", F.posexplode("mine").alias("place", "rank"))
    met = probes.join(prefixes, "rank").filter(F.size("mine") - F.col("place") >= F.col("least"))
    overlap = F.size(F.array_intersect("mine", "ranks"))
    checked = met.select("uid", "block", "label", "least", F.size("ranks").alias("whole"), overlap.alias("overlap"))
    return checked.filter(F.col("overlap") >= F.col("least")).select(
        "uid", "block", "label", (F.col("overlap") / F.col("whole")).alias("containment")
    ).distinct()


def find_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row.

    ``n_base`` counts the places of all phrases, ``first_word`` and ``last_word`` are the
    smallest and largest start among them, null without any. ``labels`` adds those of the
    templates found in a block. ``score`` is 1 with a phrase, else the largest containment
    found, else 0. A null or empty text has no words and empty labels. Rows are independent of
    each other: repeated rows and null ids give a row each. Columns other than ``doc_id`` and
    ``text`` are not read. An empty table gives an empty result.
    """
    lines = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), word_line(F.col("text")).alias("line"))
    lines = lines.withColumn("uid", F.xxhash64("line"))
    found = find_blocks(lines, templates, threshold).groupBy("uid").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best")
    )
    size = F.when(F.col("line") == "", F.lit(0)).otherwise(_spaces(F.col("line")) - 1)
    based = lines.select("doc_id", "uid", "line", size.cast("bigint").alias("n_words"))
    counts, firsts, lasts, names = [], [], [], []
    for label, phrase in PHRASES.items():
        spaced = f" {phrase} "
        there = F.col("line").contains(spaced)
        counts.append(F.when(there, F.regexp_count("line", F.lit(f"(?<= ){phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(there, _spaces(F.substring_index("line", spaced, 1))))
        lasts.append(F.when(there, F.col("n_words") - len(phrase.split()) - _spaces(F.substring_index("line", spaced, -1))))
        names.append(F.when(there, F.lit(label)))
    base = based.select(
        "doc_id", "uid", "n_words", sum(counts[1:], counts[0]).cast("bigint").alias("n_base"),
        F.least(*firsts).cast("bigint").alias("first_word"), F.greatest(*lasts).cast("bigint").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*names))).alias("phrases"),
    )
    # Stored, so that both sides of the join come straight from a shuffle and a hot text can be split.
    merged = base.join(stored(found, "license-blocks"), "uid", "left")
    both = F.array_sort(F.array_union("phrases", F.coalesce("more", F.array().cast("array<string>"))))
    return merged.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("phrases", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
