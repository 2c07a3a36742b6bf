"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words go into one automaton (per block of bounded size).  Training
tokens are streamed through it, which gives the longest match ending at every
token; a match of at least ``window`` words contains a benchmark window.  Only
stretches whose words all occur in some item are streamed, as no other stretch
can match.

Defined cases: null text and null item text have no words; an item without
words has no window; an item of fewer than ``window`` words is one window;
repeated items count as items of their own; equal ids of different items are one name; repeated documents give repeated
rows; an empty benchmark leaves all documents clean; no documents give no rows; a text of any
length is streamed in linear time; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import column, stored, table, tuned, unused, with_text
from .words import ALNUM, Words, pieces

WINDOW = 10
#: Bytes of item texts in one automaton, and so in one broadcast closure.
BLOCK_BYTES = 2_000_000
#: Blocks that one stage runs one after the other; after them the marks are stored.
STAGE_BLOCKS = 8
#: A document is dropped by ``remove_spans`` when more than this share of its words is hit.
MAX_COVERAGE = 0.5

DIGEST = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class Automaton:
    """Generalised suffix automaton over word ids, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        n = len(self.length)
        # items of each state: every state met while reading the item, and its suffixes
        self.items: list[list[int]] = [[] for _ in range(n)]
        self.short: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        seen = [-1] * n
        self.least = window
        for k, (_, words) in enumerate(items):
            s = 0
            for w in words:
                s = t = self.next[s][w]
                while t > 0 and seen[t] != k:
                    seen[t] = k
                    self.items[t].append(k)
                    t = self.link[t]
            if 0 < len(words) < window:
                self.short[s].append((len(words), k))
                self.least = min(self.least, len(words))
        # for each state, the state whose strings include its suffix of `window` words;
        # the nearest proper suffix state where a short item ends
        order = sorted(range(1, n), key=self.length.__getitem__)
        self.of_window, self.short_up = [0] * n, [0] * n
        for s in order:
            up = self.link[s]
            if self.length[s] >= window:
                self.of_window[s] = s if self.length[up] < window else self.of_window[up]
            self.short_up[s] = up if up > 0 and self.short[up] else self.short_up[max(up, 0)]
        self.names = [name for name, _ in items]

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """A state for the longest suffix that p's transition by w really has."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w, self.next[last][w])
        state = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, w, self.next[p][w])
        return state

    def matches(self, words: list[int], at: int, spans: list[tuple[int, int]], found: set[int]) -> None:
        """Adds the word ranges of all windows in ``words`` (which start at word ``at``) and their items."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        short, short_up = self.short, self.short_up
        s = size = 0
        for i, w in enumerate(words, at + 1):
            while s and w not in nxt[s]:
                s = link[s]
                size = length[s]
            if w in nxt[s]:
                s = nxt[s][w]
                size += 1
            if size >= window:
                spans.append((i - window, i))
                found.update(self.items[self.of_window[s]])
            if self.least < window:
                t = s
                while t > 0:
                    for n, k in short[t]:
                        if n <= size:
                            spans.append((i - n, i))
                            found.add(k)
                    t = short_up[t]


class Marker:
    """Finds the hit words and items of the texts of a piece; built once per worker process."""

    _last: tuple = ()

    def __init__(self, items: list[tuple[str, str]], window: int):
        words = Words(pa.array([t for _, t in items], type=pa.large_string()), ALNUM, lower=True)
        self.vocabulary, ids = np.unique(words.hash, return_inverse=True)
        self.common = np.zeros(1 << 16, dtype=bool)
        self.common[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        self.automaton = Automaton([(name, ids[a:b].tolist()) for (name, _), a, b in zip(items, words.first, words.first[1:])], window)

    @classmethod
    def of(cls, items: list[tuple[str, str]], window: int) -> Marker:
        key = (window, hash(tuple(items)))
        if not cls._last or cls._last[0] != key:
            cls._last = (key, cls(items, window))
        return cls._last[1]

    def mark(self, texts: pa.Array) -> tuple[Words, np.ndarray, dict[int, set[str]]]:
        """The words, which of them are hit, and the item names of each text that has any."""
        words = Words(texts, ALNUM, lower=True)
        n = len(words.start)
        steps = np.zeros(n + 1, dtype=np.int64)
        items: dict[int, set[str]] = {}
        if n and len(self.vocabulary):
            ids = np.full(n, -1, dtype=np.int64)
            maybe = np.flatnonzero(self.common[(words.hash >> np.uint64(48)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.vocabulary, words.hash[maybe]), len(self.vocabulary) - 1)
            good = self.vocabulary[at] == words.hash[maybe]
            ids[maybe[good]] = at[good]
            known = ids >= 0
            begin = known.copy()
            begin[1:] &= ~known[:-1]
            begin[words.first[:-1][words.count > 0]] |= known[words.first[:-1][words.count > 0]]
            starts = np.flatnonzero(begin)
            # a stretch ends where a word is unknown or the text ends
            stop = np.flatnonzero(~known)
            after = stop[np.minimum(np.searchsorted(stop, starts), max(len(stop) - 1, 0))] if len(stop) else np.full(len(starts), n)
            after = np.where(after < starts, n, after)
            doc = words.doc[starts]
            ends = np.minimum(after, words.first[doc + 1])
            for a, b, d in zip(*(x[ends - starts >= self.automaton.least].tolist() for x in (starts, ends, doc))):
                spans: list[tuple[int, int]] = []
                found: set[int] = set()
                self.automaton.matches(ids[a:b].tolist(), a, spans, found)
                for lo, hi in spans:
                    steps[lo] += 1
                    steps[hi] -= 1
                if found:
                    items.setdefault(d, set()).update(self.automaton.names[k] for k in found)
        return words, np.cumsum(steps[:-1]) > 0, items


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[bool, list[tuple[str, str]]]]:
    """(whether it is the last, items) of blocks of about ``block_bytes``, each read when it is asked for."""
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("t"))
    total = items.agg(F.sum(F.octet_length("t")).alias("b")).first()["b"] or 0
    n = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("id", "t"), F.lit(n))
    if n > 1:  # each block is then a read of its own files
        items = stored(items.withColumn("block", block).repartitionByRange(int(n), "block", "id").sortWithinPartitions("block"), "items")
        block = F.col("block")
    for k in range(n):
        yield k == n - 1, sorted((r["id"] or "", r["t"]) for r in items.where(block == k).toLocalIterator())


def _marked(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, finish: Callable, schema) -> DataFrame:
    """Runs the blocks of items over the documents, ``STAGE_BLOCKS`` one after the other in a stage;
    ``finish(batch, texts, words, hit, items)`` gives the rows of the last one.

    Between stages the documents are stored with their marks, so that the driver holds the items of
    one stage and a lost executor repeats one stage."""
    marks = unused(docs, "hit_bits"), unused(docs, "hit_items")
    marked = T.StructType([*docs.schema.fields, T.StructField(marks[0], T.BinaryType()), T.StructField(marks[1], T.ArrayType(T.StringType()))])
    for k, (last, items) in enumerate(_blocks(benchmark, block_bytes), 1):
        docs = docs.mapInArrow(_pass(items, window, finish if last else None, marks), schema if last else marked)
        if not last and k % STAGE_BLOCKS == 0:
            docs = stored(docs, "marks")
    return docs


def _pass(items: list[tuple[str, str]], window: int, finish: Callable | None, marks: tuple[str, str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marker = Marker.of(items, window)
        for batch in batches:
            for part, texts in pieces(batch):
                words, hit, found = marker.mark(texts)
                before = part.schema.get_field_index(marks[0])
                if before >= 0:
                    earlier = part.column(before).to_pylist()
                    hit = hit | np.unpackbits(np.frombuffer(b"".join(earlier), np.uint8))[_bits(words)].astype(bool) if len(hit) else hit
                    for d, names in enumerate(column(part, marks[1]).to_pylist()):
                        if names:
                            found.setdefault(d, set()).update(names)
                plain = [c for c in part.schema.names if c not in marks]
                if finish is not None:
                    yield from finish(part.select(plain), texts, words, hit, found)
                    continue
                bits = [np.packbits(hit[a:b]).tobytes() for a, b in zip(words.first, words.first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(column(part, c) for c in plain), pa.array(bits, pa.binary()), pa.array([sorted(found.get(d, ())) for d in range(part.num_rows)], pa.list_(pa.string()))],
                    names=[*plain, *marks])
    return run


def _bits(words: Words) -> np.ndarray:
    """Where each word's bit stands when every text's bits are padded to bytes."""
    size = (words.count + 7) // 8 * 8
    begin = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size
    return np.arange(len(words.start)) - np.repeat(words.first[:-1], words.count) + np.repeat(begin, words.count)


def _digest(part, texts, words, hit, found):
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total[words.first[1:]] - total[words.first[:-1]]
    names = [sorted(found.get(d, ())) for d in range(part.num_rows)]
    yield pa.RecordBatch.from_pydict({
        "doc_id": column(part, "doc_id").cast(pa.int64()),
        "n_words": words.count.astype(np.int64),
        "n_hit": n_hit.astype(np.int64),
        "n_items": pa.array([len(x) for x in names], pa.int64()),
        "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names],
        "contaminated": n_hit > 0})


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: its words, the words inside benchmark windows and their items."""
    tuned(docs.sparkSession)
    return _marked(docs.select("doc_id", "text"), benchmark, window, block_bytes, _digest, DIGEST)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without the spans that stand in benchmark windows.

    A document with more than ``max_coverage`` of its words hit goes as a whole;
    one without a hit word stays byte for byte."""
    tuned(docs.sparkSession)

    def finish(part, texts, words, hit, found):
        total = np.concatenate([[0], np.cumsum(hit)])
        n_hit = total[words.first[1:]] - total[words.first[:-1]]
        keep = n_hit <= max_coverage * words.count
        new: list[str | None] = column(part, "text").to_pylist()
        for d in np.flatnonzero(n_hit):
            lo, hi = words.first[d], words.first[d + 1]
            inside = np.concatenate([[False], hit[lo:hi], [False]])
            begins, ends = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:])
            raw, base, out, at = new[d].encode(), words.off[d], [], 0
            for a, b in zip(begins, ends):
                out.append(raw[at:words.start[lo + a] - base])
                at = words.end[lo + b] - base
            new[d] = b"".join([*out, raw[at:]]).decode()
        yield with_text(part, new).filter(pa.array(keep))

    return _marked(docs, benchmark, window, block_bytes, finish, docs.schema)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = """
WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS size, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM w, sizes WHERE len(ws) >= size)),
m AS (SELECT doc_id, i, bw.size AS size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT w.doc_id AS doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
