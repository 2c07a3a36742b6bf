"""License scan: exact set-similarity join of text blocks with license templates.

A template is one notice or clause; a block is a stretch of words of a document, over lines or not, with at most
1 / ``CONTAINMENT`` as many words as the template (notices are wrapped and indented, and not all
words of a stretch must be the template's).  Tokens are ordered by how often they stand in the corpus, the
rarest first.  A block holds a template when it has at least ``CONTAINMENT`` of the template's
tokens.  Then it has a token of the template's prefix in that order (prefix filter), enough known words near that
token (length filter), and enough different ones behind it in the order (positional filter); what is left is
verified on all stretches around the token.  Texts are cut into overlapping chunks of two longest
stretches, so each stretch lies in one and a chunk is small however long a line or text is.  Nothing is
estimated: every block that meets the threshold is found, and words scattered over a long line are no block.

The templates are a fixed list (its size is the bound of what is broadcast).

Defined cases: null and empty text has no words, no labels and score 0; a text without line feeds is like
any other; repeated rows give repeated rows; tokens of equal counts are ordered by their number; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import column, stored, table, tuned
from .words import ALNUM, Words, pieces

CONTAINMENT = 0.9

# Phrases and their labels; notices and clauses of public licenses and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-notice", "Licensed under the MIT License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit-text", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-text", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("gpl-3.0", "This program is free software under the GNU General Public License, version 3"),
    ("gpl-3.0", "Licensed under the GNU General Public License, version 3"),
    ("gpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl-text", "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "All rights reserved"),
    ("warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
]

RESULT = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


class _Lexicon:
    """Numbers of the words of templates and phrases; a filter in front of the lookup."""

    def __init__(self, texts: list[str]):
        words = Words(pa.array(texts, pa.large_string()), ALNUM, lower=True)
        self.hashes, ids = np.unique(words.hash, return_inverse=True)
        self.of = [ids[a:b].tolist() for a, b in zip(words.first, words.first[1:])]
        self.common = np.zeros(1 << 16, dtype=bool)
        self.common[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def number(self, words: Words) -> np.ndarray:
        """The number of each word, -1 for words outside the lexicon."""
        out = np.full(len(words.start), -1, dtype=np.int64)
        maybe = np.flatnonzero(self.common[(words.hash >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, words.hash[maybe]), len(self.hashes) - 1)
        good = self.hashes[at] == words.hash[maybe]
        out[maybe[good]] = at[good]
        return out


def _frequencies(texts: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _Lexicon(texts)
        total = np.zeros(len(lexicon.hashes), dtype=np.int64)
        for batch in batches:
            for _, part in pieces(batch):
                number = lexicon.number(Words(part, ALNUM, lower=True))
                total += np.bincount(number[number >= 0], minlength=len(total))
        yield pa.RecordBatch.from_pydict({"token": np.arange(len(total)), "n": total})
    return run


def token_order(docs: DataFrame, texts: list[str]) -> list[int]:
    """Rank of every token of the templates by its count in the whole corpus, the rarest first."""
    counts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_frequencies(texts), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    n = {r["token"]: r["n"] for r in counts.toLocalIterator()}  # as many rows as the templates have tokens
    size = len(_Lexicon(texts).hashes)
    ranks = [0] * size
    for rank, token in enumerate(sorted(range(size), key=lambda t: (n.get(t, 0), t))):
        ranks[token] = rank
    return ranks


def _chunks(words: Words, rank: np.ndarray, begins: np.ndarray, reach: int) -> list[list[list[dict]]]:
    """Per text the known words (place, rank) of each chunk that holds a token of some template's prefix.

    Chunk c has the words from c * reach on, 2 * reach of them: any stretch of ``reach`` words lies in one."""
    out: list[list[list[dict]]] = [[] for _ in words.count]
    known = np.flatnonzero(rank >= 0)
    if not len(known):
        return out
    doc = words.doc[known]
    at = known - words.first[doc]
    first = np.concatenate([[0], np.cumsum(words.count // reach + 1)])  # numbers of the texts' chunks
    own = first[doc] + at // reach
    prefix = begins[rank[known]]
    hit = np.unique(np.concatenate([own[prefix], (own[prefix] - 1)[at[prefix] >= reach]]))
    chunk, word = np.concatenate([own, own - 1]), np.concatenate([np.arange(len(known))] * 2)
    fits = np.concatenate([np.ones(len(known), dtype=bool), at >= reach]) & np.isin(chunk, hit)
    chunk, word = chunk[fits], word[fits]
    order = np.lexsort((word, chunk))
    chunk, word = chunk[order], word[order]
    cuts = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1))
    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
        w = word[a:b]
        out[doc[w[0]]].append([{"at": x, "rank": y} for x, y in zip(at[w].tolist(), rank[known[w]].tolist())])
    return out


def _scan(texts: list[str], phrases: list[tuple[list[int], str]], ranks: list[int], prefix: list[int], reach: int):
    """Base columns of each document, and its chunks that hold a token of some template's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, rank = _Lexicon(texts), np.array(ranks)
        begins = np.zeros(len(ranks), dtype=bool)
        begins[prefix] = True
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, texts_ in pieces(batch):
                words = Words(texts_, ALNUM, lower=True)
                number, n = lexicon.number(words), part.num_rows
                doc = words.doc
                places: list[tuple[np.ndarray, str]] = []
                for tokens, label in phrases:
                    at = np.flatnonzero(number[:len(number) - len(tokens) + 1] == tokens[0]) if len(number) >= len(tokens) else np.zeros(0, np.int64)
                    for k, t in enumerate(tokens[1:], 1):
                        at = at[(number[at + k] == t) & (doc[at + k] == doc[at])]
                    places.append((at, label))
                every = np.sort(np.concatenate([at for at, _ in places]))
                owner = doc[every]
                count = np.bincount(owner, minlength=n)
                first, last = np.full(n, -1), np.full(n, -1)
                within = every - words.first[owner]
                last[owner] = within  # ascending: the last one stays
                first[owner[::-1]] = within[::-1]
                labels: list[set[str]] = [set() for _ in range(n)]
                for at, label in places:
                    for d in np.unique(doc[at]).tolist():
                        labels[d].add(label)
                blocks = _chunks(words, np.where(number >= 0, rank[number], -1), begins, reach)
                null = lambda v: pa.array(v.astype(np.int64), mask=v < 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + n)), column(part, "doc_id"), pa.array(words.count.astype(np.int64)), pa.array(count.astype(np.int64)),
                    null(first), null(last), pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                    pa.array(blocks, pa.list_(pa.list_(pa.struct([("at", pa.int32()), ("rank", pa.int32())]))))],
                    names=["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "found", "blocks"])
                row += n
    return run


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: base places and labels, the labels of matched templates, and the best containment."""
    spark = tuned(docs.sparkSession)
    templates = TEMPLATES if templates is None else templates
    texts = [t for _, t in templates] + list(PHRASES)
    lexicon = _Lexicon(texts)
    ranks = token_order(docs, texts)
    phrases = [(lexicon.of[len(templates) + i], label) for i, label in enumerate(PHRASES.values())]
    sets = [sorted({ranks[t] for t in tokens}) for tokens in lexicon.of[:len(templates)]]
    need = [max(1, math.ceil(containment * len(s) - 1e-9)) for s in sets]
    prefixes = [s[:len(s) - o + 1] for s, o in zip(sets, need)]
    length = [math.ceil(len(tokens) / containment - 1e-9) for tokens in lexicon.of[:len(templates)]]
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scanned = stored(source.mapInArrow(_scan(texts, phrases, ranks, sorted({r for p in prefixes for r in p}), max(length, default=1)), (
        "row long, doc_id long, n_words long, n_base long, first_word long, last_word long, found array<string>, blocks array<array<struct<at: int, rank: int>>>")), "licenses")

    rows = [(label, s, len(s), o, n, r, k) for (label, _), s, o, n, p in zip(templates, sets, need, length, prefixes) for k, r in enumerate(p)]
    index = spark.createDataFrame(rows, "label string, tokens array<int>, size int, need int, length int, token int, place int")
    begins = scanned.select("row", F.explode("blocks").alias("block")).select("row", "block", F.explode("block").alias("p")).join(F.broadcast(index), F.col("p.rank") == F.col("token"))
    reached = F.filter("block", lambda x: (x["at"] > F.col("p.at") - F.col("length")) & (x["at"] < F.col("p.at") + F.col("length")))
    near = begins.withColumn("near", reached).where(F.size("near") >= F.col("need"))
    behind = F.size(F.array_distinct(F.transform(F.filter("near", lambda x: x["rank"] > F.col("token")), lambda x: x["rank"])))
    candidates = near.where((F.col("size") - F.col("place") >= F.col("need")) & (behind + 1 >= F.col("need")))
    starts = F.filter("near", lambda x: (x["at"] <= F.col("p.at")) & F.array_contains("tokens", x["rank"]))
    held = F.transform(starts, lambda s: F.size(F.array_intersect(F.col("tokens"), F.transform(
        F.filter("near", lambda x: (x["at"] >= s["at"]) & (x["at"] < s["at"] + F.col("length"))), lambda x: x["rank"]))))
    matches = candidates.withColumn("shared", F.array_max(held)).where(F.col("shared") >= F.col("need")).groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max(F.col("shared") / F.col("size")).alias("best"))
    some = F.coalesce("more", F.array().cast("array<string>"))
    score = F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("found") > 0, F.lit(1.0)).otherwise(0.0))
    return scanned.drop("blocks").join(matches, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("found", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("found", some)), ",").alias("labels"), score.alias("score"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
