"""Substring dedup by recompression: repeated runs of words share interior symbols.

Each text is a sequence of words, reduced in rounds.  A round names runs of one
symbol, then pairs of a left and a right symbol (every symbol falls on a side by
its name and the round).  A name is the 64-bit hash of what it stands for, so
the rounds of all tasks agree without exchanging a dictionary.  Every symbol
carries the range of words that its existence depends on: inside equal windows
the symbols whose range lies within the window are equal.

A window's *anchor* is the longest of these symbols.  Spark finds the anchors
that stand in two or more documents; only windows with such an anchor are
hashed and compared, exactly, with the smallest document of each window.

Contract: every word covered by a window of ``window`` words that also starts in a
document with a smaller id goes; windows are judged on the input.

Defined cases: null and empty texts have no words and keep nothing; texts under
the window keep all; repeated rows and equal ids never remove each other; rows
with a null id neither remove nor lose words; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import column, sized, stored, table, tuned
from .words import Words, mix, pieces, run_hashes, signed

WINDOW = 50
#: Run and pair rounds; after five, a symbol stands for about four words.
ROUNDS = 5
_FAR = np.int64(1) << np.int64(40)


class Symbols:
    """Symbols of the texts of a piece: name, word range [a, b) and the range [da, db) it depends on."""

    def __init__(self, words: Words, rounds: int = ROUNDS):
        n = len(words.start)
        self.name = words.hash.copy()
        self.a = np.arange(n, dtype=np.int64)
        self.b = self.a + 1
        self.da, self.db = self.a.copy(), self.b.copy()
        self.text, self.first = words.doc, words.first
        for k in range(rounds):
            self._runs(k)
            self._pairs(k)

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether the next symbol is of the same text; how far the symbols before and after reach."""
        n = len(self.name)
        same = np.zeros(n, dtype=bool)
        same[:-1] = self.text[1:] == self.text[:-1]
        before, after = np.full(n, -_FAR), np.full(n, _FAR)  # beyond a text's end nothing is known
        before[1:][same[:-1]] = self.da[:-1][same[:-1]]
        after[:-1][same[:-1]] = self.db[1:][same[:-1]]
        return same, before, after

    def _runs(self, k: int) -> None:
        """A maximal run of one symbol becomes one symbol; both neighbours must be known to differ."""
        if not len(self.name):
            return
        same, before, after = self._neighbours()
        joined = np.zeros(len(self.name), dtype=bool)
        joined[:-1] = same[:-1] & (self.name[1:] == self.name[:-1])
        head = np.ones(len(self.name), dtype=bool)
        head[1:] = ~joined[:-1]
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(self.name)) - 1
        size = (last - first + 1).astype(np.uint64)
        many = size > 1
        name = self.name[first]
        name[many] = mix(name[many] * np.uint64(0x9E3779B97F4A7C15) + size[many] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(2 * k + 1))
        self.da, self.db = np.minimum(self.da[first], before[first]), np.maximum(self.db[last], after[last])
        self.name, self.a, self.b, self.text = name, self.a[first], self.b[last], self.text[first]

    def _pairs(self, k: int) -> None:
        """A left symbol and the right symbol after it become one; a symbol that stays needs the neighbour it might have joined."""
        if not len(self.name):
            return
        same, before, after = self._neighbours()
        left = (mix(self.name + np.uint64(0x632BE59BD9B4E019 * (k + 1) & (2**64 - 1))) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(self.name), dtype=bool)
        pair[:-1] = same[:-1] & left[:-1] & ~left[1:]
        second = np.zeros(len(self.name), dtype=bool)
        second[1:] = pair[:-1]
        single = ~pair & ~second
        da = np.where(single & ~left, np.minimum(self.da, before), self.da)
        db = np.where(single & left, np.maximum(self.db, after), self.db)
        at = np.flatnonzero(pair)
        name = self.name
        name[at] = mix(self.name[at] * np.uint64(0xA0761D6478BD642F) + mix(self.name[at + 1] + np.uint64(2 * k + 2)))
        db[at] = np.maximum(db[at], db[at + 1])
        da[at] = np.minimum(da[at], da[at + 1])
        self.b[at] = self.b[at + 1]
        keep = ~second
        self.name, self.a, self.b, self.da, self.db, self.text = name[keep], self.a[keep], self.b[keep], da[keep], db[keep], self.text[keep]

    def anchors(self, at: np.ndarray, own: np.ndarray, window: int) -> np.ndarray:
        """For windows at words ``at`` (with hashes ``own``): the name of the longest symbol that
        the window alone determines; a window without one is its own anchor."""
        out = own.copy()
        if not len(self.name) or not len(at):
            return out
        # both ends of the dependence grow from symbol to symbol; a text's first and last symbols depend on its ends
        lo = np.searchsorted(np.where(self.da < 0, self.first[self.text], self.da), at, side="left")
        hi = np.searchsorted(np.where(self.db >= _FAR, self.first[self.text + 1], self.db), at + window, side="right")
        fixed = (self.da >= 0) & (self.db < _FAR)
        length = np.minimum(self.b - self.a, 1023).astype(np.uint64)
        key = np.where(fixed, (length << np.uint64(54)) | (self.name >> np.uint64(10)), np.uint64(0))
        levels = [key]  # levels[j][i]: the largest of 2**j keys from i
        longest = int((hi - lo).max())
        while 1 << len(levels) <= longest:
            step = 1 << (len(levels) - 1)
            up = levels[-1].copy()
            up[:-step] = np.maximum(up[:-step], levels[-1][step:])
            levels.append(up)
        size = hi - lo
        best = np.zeros(len(at), dtype=np.uint64)
        for j in range(len(levels)):
            here = np.flatnonzero((size >= 1 << j) & (size < 2 << j))
            if len(here):
                best[here] = np.maximum(levels[j][lo[here]], levels[j][hi[here] - (1 << j)])
        some = best > 0
        out[some] = mix(best[some])
        return out


def _windows(texts: pa.Array, window: int, rounds: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    words = Words(texts)
    at, own = words.runs(window)
    return words, at, own, Symbols(words, rounds).anchors(at, own, window)


def _sha(words: Words, d: int, gone: np.ndarray | None = None) -> str:
    """Hash of text d's words, joined by one space, without those that ``gone`` marks."""
    lo, hi = words.first[d], words.first[d + 1]
    raw = words.raw
    kept = range(lo, hi) if gone is None else (lo + np.flatnonzero(~gone)).tolist()
    if gone is None and hi > lo:
        inside = raw[words.start[lo]:words.end[hi - 1]].tobytes()
        return hashlib.sha256(b" ".join(inside.split())).hexdigest()
    return hashlib.sha256(b" ".join(raw[words.start[i]:words.end[i]].tobytes() for i in kept)).hexdigest()


def _describe(window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                words, at, _, anchor = _windows(texts, window, rounds)
                where = np.searchsorted(at, words.first)
                yield pa.RecordBatch.from_arrays([
                    column(part, "doc_id"), column(part, "key"), column(part, "digest"), pa.array(words.count.astype(np.int64)),
                    pa.array([_sha(words, d) for d in range(part.num_rows)]),
                    pa.array([signed(np.unique(anchor[a:b])) for a, b in zip(where, where[1:])], pa.list_(pa.int64()))],
                    names=["doc_id", "key", "digest", "n_words", "sha", "anchors"])
    return run


def _emit(window: int, rounds: int):
    """(document, window hash, places) of the windows whose anchor stands in several documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                words, at, own, anchor = _windows(texts, window, rounds)
                where = np.searchsorted(at, words.first)
                shared = column(part, "shared")
                for d, (a, b) in enumerate(zip(where, where[1:])):
                    names = np.sort(np.asarray(shared[d].values.to_numpy(zero_copy_only=False), dtype=np.int64))
                    mine = signed(anchor[a:b])
                    found = np.flatnonzero(names[np.minimum(np.searchsorted(names, mine), len(names) - 1)] == mine)
                    if len(found):
                        order = found[np.argsort(own[a:b][found], kind="stable")]
                        h = own[a:b][order]
                        head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                        size = len(head)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(size, part["doc_id"][d].as_py()), pa.int64()), pa.array(np.full(size, part["key"][d].as_py()), pa.int64()),
                            pa.array(mine[order[head]]), pa.array(signed(h[head])),
                            pa.ListArray.from_arrays(np.append(head, len(order)).astype(np.int32), (at[a:b][order] - words.first[d]).astype(np.int32))],
                            names=["doc_id", "key", "anchor", "hash", "at"])
    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                words = Words(texts)
                removed, sha = [], []
                for d, at in enumerate(column(part, "places")):
                    step = np.zeros(words.count[d] + 1, dtype=np.int64)
                    places = np.unique(at.values.to_numpy(zero_copy_only=False))
                    step[places] += 1
                    ends = places + window
                    step[ends] -= 1
                    gone = np.cumsum(step[:-1]) > 0
                    removed.append(int(gone.sum()))
                    sha.append(_sha(words, d, gone))
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "key"), pa.array(removed, pa.int64()), pa.array(sha)], names=["doc_id", "key", "removed", "kept"])
    return run


def _merge_batches(batches: Iterator[pa.RecordBatch], rows: int = 20000) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def repeated_spans(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (hash of the kept words)."""
    tuned(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key: Column = F.xxhash64("text")
    described = stored(source.withColumn("key", key).withColumn("digest", F.unhex(F.md5("text"))).mapInArrow(
        _describe(window, rounds), "doc_id long, key long, digest binary, n_words long, sha string, anchors array<long>"), "words")

    # of equal texts only the smallest id takes part; the others lose every window
    long = described.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    first = stored(long.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("key").alias("key"), F.first("anchors").alias("anchors")), "first")
    anchors = first.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("anchor")
    candidates = stored(first.select("doc_id", "key", F.explode("anchors").alias("anchor")).join(shared, "anchor")
                        .groupBy("doc_id", "key").agg(F.collect_list("anchor").alias("shared")), "shared")
    emit = _emit(window, rounds)
    keyed = source.withColumn("key", key)
    windows = keyed.join(sized(candidates, 64, F.size("shared") * 8), ["doc_id", "key"]).mapInArrow(
        lambda batches: _merge_batches(emit(batches)), "doc_id long, key long, anchor long, hash long, at array<int>")
    least = windows.groupBy("anchor", "hash").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least <> most").select("anchor", "hash", "least")
    flags = stored(windows.join(least, ["anchor", "hash"]).where("least < doc_id").groupBy("doc_id", "key").agg(F.flatten(F.collect_list("at")).alias("places")), "places")
    cut = stored(keyed.join(sized(flags, 64, F.size("places") * 4), ["doc_id", "key"]).mapInArrow(_cut(window), "doc_id long, key long, removed long, kept string"), "cut")
    cut = cut.groupBy("doc_id", "key").agg(F.first("removed").alias("removed"), F.first("kept").alias("kept"))

    copies = first.select("digest", F.col("doc_id").alias("least"))
    copy = F.col("least") < F.col("doc_id")
    return (described.select("doc_id", "key", "digest", "n_words", "sha").join(copies, "digest", "left").join(cut, ["doc_id", "key"], "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))


#: Every window as text; feasible on small tables only.
ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
m AS (SELECT h, min(doc_id) AS least FROM w GROUP BY h),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM w JOIN m USING (h) WHERE least < doc_id),
g AS (SELECT doc_id, list(p) AS ps FROM x GROUP BY doc_id)
SELECT d.doc_id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(CASE WHEN ps IS NULL THEN array_to_string(ws, ' ')
    ELSE (SELECT string_agg(v, ' ' ORDER BY j) FROM (SELECT unnest(ws) AS v, unnest(range(1, len(ws) + 1)) AS j) LEFT JOIN (SELECT unnest(ps) AS p) q ON q.p = j WHERE q.p IS NULL) END, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""
