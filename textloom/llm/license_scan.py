"""License scans: phrases, and an exact set-similarity join of text blocks with templates, in DataFrame functions only."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from fractions import Fraction
from math import ceil
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import ascii_lower, fresh

WORD, GAP = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Notices that stand in texts to tell their license.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)
#: Share of a template's distinct words that a block must have.
CONTAINMENT = 0.8
#: Words of a block; blocks overlap by half.
BLOCK_WORDS = 64
#: Parts of the dictionary of the templates' words: one is searched for a word.
BUCKETS = 256
MOST_TEMPLATES = 1000


def words_of(text: str) -> list[str]:
    return re.findall(WORD + "+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD + "++"), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD + "++")).cast("long")


def frequencies(docs: DataFrame, text: str, vocabulary: Sequence[str]) -> dict[str, int]:
    """In how many rows of all each word of the templates occurs; words that don't have 0."""
    low = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    found = docs.select(F.explode(F.array_intersect(words(low), F.array(*map(F.lit, vocabulary)))).alias("word"))
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def _constant(value: list, kind: str) -> Column:
    """Nested lists as one literal of the plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def scan(docs: DataFrame, text: str = "text", into: str = "licenses", phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """Add a struct to every row: n_words, n_base, first_word, last_word, base_labels, labels (sorted arrays), score.

    Base: every place where a phrase's words stand one after another. A template's label
    is added if a block has ``containment`` of its distinct words. Blocks are windows over
    the words of the whole text, of BLOCK_WORDS words (more for longer templates), and
    overlap by half, so that a notice stands in one of them however it is wrapped. Words
    of the templates are ordered by their frequency over all rows, rarest first, and a
    template of m words that needs o has the first m - o + 1 as prefix. An index gives
    the templates for each word of a prefix; so a block meets those alone with which it
    shares one, and of these it passes over any that need more words than it has, or than
    come after the first that both have. What is left is counted in full. score is the
    highest containment found, 0 if below. Null and empty texts have no words and no labels.
    """
    if fresh(docs.columns, into) != into:
        raise ValueError(f"the column {into} exists")
    sets = [(label, sorted(set(words_of(t)))) for label, t in templates]
    if len(sets) > MOST_TEMPLATES or not all(s for _, s in sets):
        raise ValueError(f"templates must have words, and be {MOST_TEMPLATES} at most")
    half = max(BLOCK_WORDS // 2, *(len(words_of(t)) for _, t in templates), 0)
    vocabulary = sorted({w for _, s in sets for w in s})
    often = frequencies(docs, text, vocabulary)
    ranked = sorted(vocabulary, key=lambda w: (often[w], w))
    rank = {w: i + 1 for i, w in enumerate(ranked)}
    share = Fraction(containment).limit_denominator(1_000_000)
    made, index = [], [[] for _ in ranked]
    for number, (label, s) in enumerate(sets):
        tokens = sorted(rank[w] for w in s)
        need = max(1, ceil(share * len(tokens)))
        made.append({"label": label, "tokens": tokens, "need": need})
        for x in tokens[: len(tokens) - need + 1]:
            index[x - 1].append(number + 1)
    first = [w for w, found in zip(ranked, index, strict=True) if found]
    buckets = [{} for _ in range(BUCKETS)]
    for w, i in rank.items():
        buckets[crc32(w.encode()) % BUCKETS][w] = i
    templates_, index_, buckets_ = _constant(made, "array<struct<label:string,tokens:array<int>,need:int>>"), _constant(index, "array<array<int>>"), _constant(buckets, "array<map<string,int>>")

    low_, words_, hits_, base_ = (fresh(docs.columns, c) for c in ("low", "words", "hits", "base"))
    rows = docs.withColumn(low_, ascii_lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    low = F.col(low_)
    found = []
    for phrase, label in phrases:
        head, *rest = words_of(phrase)
        # only the first word is taken, so places may overlap
        pattern = rf"(?<!{WORD}){re.escape(head)}" + (f"(?={''.join(f'{GAP}++{re.escape(w)}' for w in rest)}(?!{WORD}))" if rest else f"(?!{WORD})")
        found.append(F.struct(F.lit(label).alias("label"), F.when(low.contains((rest or [head])[-1]), F.split(low, pattern, -1)).otherwise(F.array(low)).alias("parts")))
    rows = rows.withColumn(base_, F.filter(F.array(*found), lambda f: F.size(f["parts"]) > 1)).withColumn(words_, words(low))

    def ranks(w: Column) -> Column:
        """The sorted ranks of a block's words that are in templates."""
        of = F.transform(F.array_distinct(w), lambda x: F.element_at(F.element_at(buckets_, (F.crc32(x.cast("binary")) % BUCKETS + 1).cast("int")), x))
        return F.array_sort(F.filter(of, lambda x: x.isNotNull()))

    def candidates(b: Column) -> Column:
        """The templates that have one of the block's words in their prefix, from the index, with as many words as they share."""
        numbers = F.array_distinct(F.flatten(F.transform(b, lambda x: F.element_at(index_, x))))
        possible = F.filter(F.transform(numbers, lambda i: F.element_at(templates_, i)), lambda t: (F.size(b) >= t["need"]) & after(b, t))
        return F.transform(possible, lambda t: F.struct(t["label"].alias("label"), t["need"].alias("need"), F.size(t["tokens"]).alias("m"), F.size(F.array_intersect(b, t["tokens"])).alias("shared")))

    def after(b: Column, t: Column) -> Column:
        """Whether enough words come after the first that block and template share; both are sorted."""
        at = F.array_min(F.array_intersect(b, t["tokens"]))
        return F.least(F.size(t["tokens"]) - F.array_position(t["tokens"], at), F.size(b) - F.array_position(b, at)) + 1 >= t["need"]

    all_ = F.col(words_)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(all_) / half).cast("int") - 1, F.lit(1)) - 1)
    blocks = F.filter(F.transform(starts, lambda i: F.slice(all_, i * half + 1, F.lit(2 * half))), lambda w: F.arrays_overlap(w, F.array(*map(F.lit, first))))
    hits = F.filter(F.flatten(F.transform(F.transform(blocks, ranks), candidates)), lambda x: x["shared"] >= x["need"])
    rows = rows.withColumn(hits_, F.when(F.arrays_overlap(all_, F.array(*map(F.lit, first))), hits) if first else F.lit(None).cast("array<struct<label:string,need:int,m:int,shared:int>>"))
    base, total = F.col(base_), F.size(all_).cast("long")
    hit = F.coalesce(F.col(hits_), F.array().cast(rows.schema[hits_].dataType))
    base_labels = F.array_sort(F.array_distinct(F.transform(base, lambda f: f["label"])))
    places = F.transform(base, lambda f: n_words(f["parts"][0]))
    ends = F.transform(base, lambda f: n_words(F.element_at(f["parts"], -1)))
    out = F.struct(
        total.alias("n_words"),
        F.aggregate(base, F.lit(0).cast("long"), lambda a, f: a + F.size(f["parts"]) - 1).alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.when(F.size(base) > 0, total - F.array_min(ends) - 1).alias("last_word"),
        base_labels.alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat(base_labels, F.transform(hit, lambda x: x["label"])))).alias("labels"),
        F.aggregate(hit, F.lit(0.0), lambda a, x: F.greatest(a, x["shared"] / x["m"])).alias("score"),
    )
    return rows.withColumn(into, out).drop(low_, words_, hits_, base_)
