"""License scans (operator 10): an exact set-similarity join of text blocks with templates. DataFrame functions only.

A template of L words meets the blocks of 2 L words that start at every word, so that its position in a text
doesn't matter. A block contains a template if it has at least the template's share of its distinct tokens.
Blocks are found by stretches of 3 L words that start at every L-th word: each block lies whole in the one
it starts in the first third of.
Tokens are ordered by their frequency in the whole corpus, the rarest first. To hold a block that reaches the
share a stretch must have one of the template's first n - need + 1 tokens (prefix filter), enough words
(length filter), and after its first common token enough tokens must be left in the order (positional
filter); only such stretches are counted out, and where they have the share, their blocks from every listed word. Templates are code, a few hundred tokens; the
texts are read once, to list their words that are such tokens.

Phrases are templates that need all their tokens; the stretches found are then searched for the places where the
words stand consecutively. Only stretches' words are shuffled, not the texts' lists of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LETTER_WORD, lower_ascii, materialize, table

#: Label and words of the base phrases.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

# Notices by which works name their license.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
SHARE = 0.9


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    share: float
    phrase: bool

    @property
    def tokens(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.words))

    @property
    def need(self) -> int:
        return max(1, math.ceil(self.share * len(self.tokens) - 1e-9))


def _words(text: str) -> tuple[str, ...]:
    return tuple("".join(c if ord(c) > 127 or c.isalnum() else " " for c in "".join(c.lower() if c.isascii() else c for c in text)).split())


def templates(notices=NOTICES, phrases=PHRASES, share: float = SHARE) -> list[Template]:
    """Phrases and notices without the empty ones."""
    out = [Template(label, _words(text), 1.0, True) for label, text in phrases] + [Template(label, _words(text), share, False) for label, text in notices]
    return [t for t in out if t.words]


def frequencies(base: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In the whole corpus, of the words in the vocabulary, from the listed hits; as many rows at most."""
    found = base.select(F.explode("hits.token").alias("token")).groupBy("token").count()
    return {**dict.fromkeys(vocabulary, 0), **{r[0]: r[1] for r in found.collect()}}


def scan(docs: DataFrame, *, id_col="doc_id", text_col="text", notices=NOTICES, phrases=PHRASES, share: float = SHARE) -> DataFrame:
    """Per row of `docs`: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base: places of phrases, overlaps counted; first_word and last_word: their smallest and largest
    start, words from 0, null without any. base_labels, labels: those of phrases, and of all
    templates, distinct, sorted, comma-joined, "" if none. score: the largest share of a template's
    tokens in a block that contains it, else 0. Null and empty texts have no words. Repeated rows, and rows
    with equal or null ids, are scanned each on its own. Other columns aren't read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    known = templates(notices, phrases, share)
    vocabulary = sorted({w for t in known for w in t.words})
    # the texts are read once: every word of the vocabulary is listed with its place
    words = F.regexp_extract_all(lower_ascii(F.col(text_col)), F.lit(LETTER_WORD), F.lit(0))
    worded = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), words.alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(i.alias("at"), w.alias("token")))), lambda x: x.isNotNull())
    base = materialize(worded.select("_row", "_id", F.size("words").cast("long").alias("n_words"), hits.alias("hits")), "licenses")
    count = frequencies(base, vocabulary)
    order = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (count[w], w)))}
    number = {w: k for k, w in enumerate(vocabulary)}
    rows, prefix, phrase_places = [], set(), {}
    for k, t in enumerate(known):
        ranked = sorted(t.tokens, key=order.get)
        first = ranked[: len(ranked) - t.need + 1]
        prefix |= set(first)
        rows += [(k, number[w], at, at < len(first), len(t.words), len(ranked), t.need) for at, w in enumerate(ranked)]
        if t.phrase:
            phrase_places[k] = [ranked.index(w) for w in t.words]
    schema = "template int, token string, place int, prefix boolean, span int, n int, need int"
    parts = F.broadcast(spark.createDataFrame([(r[0], vocabulary[r[1]], *r[2:]) for r in rows], schema))  # as long as the templates
    of_template = [(k, len(t.words), len(t.tokens), t.need, t.label, t.phrase) for k, t in enumerate(known)]
    of_template = F.broadcast(spark.createDataFrame(of_template, "template int, span int, n int, need int, label string, phrase boolean"))

    some = base.filter(F.exists("hits", lambda x: x["token"].isin(list(prefix))))
    hits = some.select("_row", "n_words", F.explode("hits").alias("h")).select("_row", "n_words", "h.at", "h.token")
    third = (F.col("at") / F.col("span")).cast("int")
    in_stretches = hits.join(parts, "token").withColumn("stretch", F.explode(F.sequence(F.greatest(F.lit(0), third - 2), third)))
    long_enough = F.least(F.col("n_words") - F.col("stretch") * F.col("span"), 2 * F.col("span")) >= F.col("need")
    stretch = ["_row", "template", "stretch"]
    candidates = in_stretches.filter(F.col("prefix") & long_enough).groupBy(*stretch, "n", "need").agg(F.min("place").alias("first"))
    candidates = candidates.filter(F.col("n") - F.col("first") >= F.col("need")).select(*stretch)
    listed_in = in_stretches.select(*stretch, "at", "place").join(candidates, stretch).groupBy(*stretch).agg(F.collect_list(F.struct("at", "place")).alias("words"))
    listed_in = listed_in.join(of_template, "template").filter(F.size(F.array_distinct("words.place")) >= F.col("need"))
    end = (F.col("stretch") + 1) * F.col("span")  # of the places that count for this stretch; the next ones are in the next
    counted = listed_in.withColumn("common", F.array_max(_commons("words", "span", end))).filter("common >= need")
    starts = F.array().cast("array<int>")
    for k, places in phrase_places.items():
        starts = F.when(F.col("template") == k, _starts("listed", places, end)).otherwise(starts)
    counted = counted.withColumn("listed", F.array_sort("words")).withColumn("starts", starts)
    found = counted.groupBy("_row").agg(
        F.sum(F.size("starts")).alias("n_base"), F.min(F.array_min("starts")).alias("first_word"), F.max(F.array_max("starts")).alias("last_word"),
        F.collect_set(F.when(F.size("starts") > 0, F.col("label"))).alias("base"), F.collect_set(F.when(~F.col("phrase"), F.col("label"))).alias("others"),
        F.max(F.when(~F.col("phrase"), F.col("common") / F.col("n"))).alias("share"),
    )
    found = materialize(found, "licenses-found")

    out = base.select("_row", "_id", "n_words").join(found, "_row", "left")
    none = F.array().cast("array<string>")
    base_labels, others = F.coalesce(F.array_sort("base"), none), F.coalesce("others", none)
    return out.select(
        F.col("_id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base_labels, others)), ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(0.0), F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _commons(words: str, span: str, end):
    """Distinct tokens of the block of two spans from each word before `end`; at most three spans of words are given."""

    def common(start):
        block = F.filter(words, lambda x: (x["at"] >= start["at"]) & (x["at"] < start["at"] + 2 * F.col(span)))
        return F.size(F.array_distinct(F.transform(block, lambda x: x["place"])))

    return F.transform(F.filter(words, lambda x: x["at"] < end), common)


def _starts(words: str, places: list[int], end):
    """Before `end`, where a phrase's words stand one after the other; given all of them by place, so they are neighbours."""

    def stands(i):
        out = F.get(words, i)["at"] < end
        for j, place in enumerate(places):
            out = out & (F.get(words, i + j)["place"] == place) & (F.get(words, i + j)["at"] == F.get(words, i)["at"] + j)
        return out

    at_first = F.filter(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - len(places))), stands)
    return F.transform(at_first, lambda i: F.get(words, i)["at"])


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
