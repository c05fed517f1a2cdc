"""License scans: an exact set-similarity join of the blocks of all texts with license templates.

A block is a window of WIDTH words, and windows overlap so far that every run of words as long as a template lies whole
in one. A block meets a template if it holds at least THRESHOLD of the template's distinct words, in any order. Words are
ordered by their count in all texts, the rarest first, alike on both sides, which gives three filters that lose nothing:
the first word that a pair shares stands early in both (prefix), a block with fewer words than needed is out (length), and
what follows that word on either side must be enough for the rest (position). Only pairs that pass are compared.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ordering import attach
from .common import bounded_batches, stored, whole_text

WIDTH, STRIDE = 48, 24
THRESHOLD = (85, 100)
MOST_TEMPLATES = 10_000
"""Bound on the templates: their prefix index is broadcast."""
# Phrases and the labels that they stand for.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Sentences of public licenses, by label.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc", "licensed under a Creative Commons Attribution International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("reserved", "All rights reserved."),
)
_SPACED = bytes(32 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of a text with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_SPACED).split()


@dataclass(frozen=True)
class Template:
    """The distinct words of a license sentence, and how many of them a block has to hold."""

    label: str
    words: frozenset[bytes]
    needed: int


def compile_templates(templates: Sequence[tuple[str, str]], threshold: tuple[int, int] = THRESHOLD, longest: int = WIDTH - STRIDE + 1) -> list[Template]:
    out = []
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    for label, text in templates:
        words = words_of(text)
        if not 0 < len(words) <= longest:
            raise ValueError(f"a template needs 1 to {longest} words: {text!r}")
        distinct = frozenset(words)
        out.append(Template(label, distinct, -(-threshold[0] * len(distinct) // threshold[1])))
    return out


def scan_words(docs: DataFrame, vocabulary: Sequence[bytes], phrases: Mapping[str, str]) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, found, places, tokens) for every row: the phrases' places counted, and
    the places and numbers of those words that are in the vocabulary (which holds the phrases' words)."""
    import pyarrow as pa

    numbers = {w: i for i, w in enumerate(vocabulary)}
    wanted = [([numbers[w] for w in words_of(p)], label) for p, label in phrases.items()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, starts_of, found, places, tokens = [], [], [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                held = np.array([numbers.get(w, -1) for w in words], dtype=np.int32)
                at = np.flatnonzero(held >= 0).astype(np.int32)
                starts, labels = [], []
                for phrase, label in wanted:
                    n = len(held) - len(phrase) + 1
                    hit = at[at < n]
                    for i, number in enumerate(phrase):
                        hit = hit[held[hit + i] == number]
                    if len(hit):
                        starts.append(hit)
                        labels.append(label)
                sizes.append(len(words))
                starts_of.append(np.concatenate(starts) if starts else None)
                found.append(sorted(set(labels)))
                places.append(at)
                tokens.append(held[at])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()),
                pa.array([0 if s is None else len(s) for s in starts_of], pa.int64()),
                pa.array([None if s is None else int(s.min()) for s in starts_of], pa.int64()),
                pa.array([None if s is None else int(s.max()) for s in starts_of], pa.int64()),
                pa.array(found, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32())),
            ], ["doc_id", "n_words", "n_base", "first_word", "last_word", "found", "places", "tokens"])

    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, found array<string>, "
                                 "places array<int>, tokens array<int>")


def word_ranks(scanned: DataFrame, vocabulary: Sequence[bytes]) -> list[int]:
    """Rank of every word of the vocabulary in the global order: the rarest in all texts first, ties as the words themselves."""
    counts = {r["t"]: r["n"] for r in scanned.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(range(len(vocabulary)), key=lambda i: (counts.get(i, 0), vocabulary[i]))
    ranks = [0] * len(vocabulary)
    for rank, i in enumerate(order):
        ranks[i] = rank
    return ranks


def blocks(scanned: DataFrame, ranks: Sequence[int], leads: Sequence[int], least: int, width: int = WIDTH, stride: int = STRIDE) -> DataFrame:
    """(row, block, words) for the blocks that can meet any template: words, the block's distinct ranks in order, are at least
    `least` and have a member of `leads`, the words with which a template's prefix is made."""
    import pyarrow as pa

    ranked, lead = np.array(ranks, dtype=np.int32), np.zeros(len(ranks) + 1, dtype=bool)
    lead[list(leads)] = True
    reach = width // stride

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, words = [], [], []
            for row, n, places, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                at, rank = places.values.to_numpy(), ranked[tokens.values.to_numpy()]
                last = max(0, -(-(n - width) // stride))
                home = at // stride
                meets = np.unique(np.concatenate([home[lead[rank]] - i for i in range(reach)]))
                meets = meets[(meets >= 0) & (meets <= last)]
                for block in meets.tolist():
                    lo, hi = np.searchsorted(at, (block * stride, block * stride + width))
                    held = np.unique(rank[lo:hi])
                    if len(held) >= least:
                        rows.append(row)
                        numbers.append(block)
                        words.append(held)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(numbers, pa.int64()), pa.array(words, pa.list_(pa.int32()))],
                                             ["row", "block", "words"])

    return scanned.select("row", "n_words", "places", "tokens").mapInArrow(cut, "row long, block long, words array<int>")


def join_templates(found: DataFrame, templates: Sequence[Template], ranks: Mapping[bytes, int]) -> DataFrame:
    """(row, block, template, overlap) for all blocks that hold enough of a template."""
    spark = found.sparkSession
    sets = [sorted(ranks[w] for w in t.words) for t in templates]
    index = [(rank, place, number, len(s), t.needed) for number, (t, s) in enumerate(zip(templates, sets))
             for place, rank in enumerate(s[:len(s) - t.needed + 1])]
    prefixes = F.broadcast(spark.createDataFrame(index, "word int, place int, template int, size int, needed int"))
    whole = F.broadcast(spark.createDataFrame(list(enumerate(sets)), "template int, members array<int>"))
    least = min(t.needed for t in templates)
    starts = found.select("row", "block", "words", F.posexplode(F.slice("words", F.lit(1), F.size("words") - least + 1)).alias("at", "word"))
    enough = (F.size("words") >= F.col("needed")) & (
        F.least(F.size("words") - F.col("at"), F.col("size") - F.col("place")) >= F.col("needed"))
    pairs = starts.join(prefixes, "word").filter(enough).join(whole, "template")
    # A pair that shares several prefix words is kept at the first of them only.
    shared = F.array_intersect("words", "members")
    overlap = F.size(shared)
    return (pairs.withColumns({"overlap": overlap, "lead": F.element_at(shared, 1)})
            .filter((F.col("overlap") >= F.col("needed")) & (F.col("lead") == F.col("word")))
            .select("row", "block", "template", "overlap", (F.col("overlap") / F.col("size")).alias("held")))


def scan_licenses(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES,
                  threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """A row per row of docs: doc_id, n_words, n_base (places of the phrases), first_word, last_word (their smallest and largest
    start), base_labels, labels (those of the templates too), score (1 with a phrase, else the largest share of a met template,
    else 0) and matches (block, label, share of the template, for every block that meets a template).

    A missing or empty text has no words, no labels and score 0; a missing doc_id stays missing; rows that repeat an id are rows
    of their own. Equal templates count once per label. An empty table gives an empty one. Other columns are not read.
    """
    compiled = compile_templates(templates, threshold)
    vocabulary = sorted({w for t in compiled for w in t.words} | {w for p in phrases for w in words_of(p)})
    # The rows are numbered before they are written: all later steps see the same numbers.
    scanned = stored(scan_words(docs, vocabulary, phrases).withColumn("row", F.monotonically_increasing_id()), "license_words")
    ranks = word_ranks(scanned, vocabulary)
    by_word = dict(zip(vocabulary, ranks))
    leads = {r for t in compiled for r in sorted(by_word[w] for w in t.words)[:len(t.words) - t.needed + 1]}
    found = blocks(scanned, ranks, sorted(leads), min(t.needed for t in compiled))
    names = F.array(*[F.lit(t.label) for t in compiled])
    matched = join_templates(found, compiled, by_word).groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct(F.col("block"), F.element_at(names, F.col("template") + 1).alias("label"), "held"))).alias("matches"))
    matched = stored(matched, "license_matches")
    rows = attach(scanned.drop("places", "tokens"), matched, "row", null_safe=False)
    met = F.coalesce(F.transform("matches", lambda m: m["label"]), F.array().cast("array<string>"))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["held"])), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("found", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("found", met)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"), "matches")
