"""Katz backoff language model over word pairs, fitted and evaluated by exchanges of packed blocks.

Texts are cut once into stored blocks: distinct words and, per token, which of them it is.
Blocks send each distinct word once to the word's bucket, which counts it over all blocks, numbers it and answers;
then they send each distinct pair of known words once to the context's bucket, which counts it and answers.  The
buckets store what they counted: words with counts, pairs with counts, by bucket.  A context that holds over a
``HOT_SHARE``-th of all tokens has its pairs dealt by pair; its sums over buckets are added up by Spark
(there are at most ``HOT_SHARE`` such contexts, so they may be sent to every task).

p(w)   = d(c) c / N for a known word, and what Good-Turing takes away for the one class of unknown words;
p(w|h) = d(c(hw)) c(hw) / c(h) for a known pair, else backoff(h) p(w), or p(w) after an unknown h.
d is Katz's discount for counts up to the largest k <= 5 for which the counts of counts give discounts between 0
and 1; if no k does (small or heavily copied corpora), half a count is taken from counts up to 5.  Where
nothing can be taken away (all counts above k), one is added to the denominator.  So p(.) sums to one over known words and the unknown
class, after every context.  The context of a text's first token is the start of text; the end of text is a token.
Words are told apart by 64-bit hashes; pairs by the exact numbers of their words.

Defined cases: a null text is empty (one token, its end); a null doc_id is trained on where ``trained`` is null or true; repeated rows
count and are scored one by one; without training texts every token has base score 0 and probability one;
an empty table gives no rows; texts longer than a block are cut between words and summed again; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import column, groups, shared_path, stored, table, tuned
from .merkle import CRC32
from .words import SPACE, Words, mix, pieces, text_bytes

#: Bytes of text in a block; a task holds a few blocks' worth of numbers.
BLOCK_BYTES = 6 << 20
#: Tokens per bucket, about.
BUCKET_TOKENS = 2_000_000
HOT_SHARE = 1000
#: Counts above this are trusted as they are.
K = 5

END = np.uint64(0x51ED270B9F1C3A77)  # the end of a text, as a word
START = 0  # number of the start of a text, as a context; words are numbered from 1

BLOCK = "block long, rows array<long>, ids array<long>, trained array<boolean>, counts binary, before binary, words binary, tokens binary, n_tokens long, n_trained long, n_starts long"
#: a..d: packed numbers; what they are depends on the kind of row
PACKED = "block long, kind int, seq int, a binary, b binary, c binary, d binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, all lowest bytes first, in as many bytes as the largest needs."""
    raw = np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8)
    width = next((k for k in range(8, 0, -1) if raw[:, k - 1].any()), 0)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw[:, :width].T).tobytes())


def unpack(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    if data[0]:
        out[:, :data[0]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8).reshape(data[0], n).T
    return out.reshape(-1).view("<u8").astype(np.int64)


def floats(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype="<f8")


def pack_floats(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<f8").tobytes())


def discounts(n: list[int]) -> np.ndarray:
    """d[r] for r = 0 .. K from the counts of counts n[1] .. n[K + 1]; d[r] = 1 beyond the largest k that works."""
    for k in range(K, 1, -1):
        if min(n[1:k + 2]) <= 0 or (k + 1) * n[k + 1] >= n[1]:
            continue
        a = (k + 1) * n[k + 1] / n[1]
        d = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([1.0, *d, *[1.0] * (K - k)])
    return np.array([1.0, *((r - 0.5) / r for r in range(1, K + 1))])


@dataclass
class Words1:
    """The unigram level: p(w) by count, and what it was made from."""

    tokens: int
    starts: int
    known: int
    counts: list[int]  # counts of counts

    def __post_init__(self):
        self.d = discounts(self.counts)
        self.taken = float(sum((1 - self.d[r]) * r * self.counts[r] for r in range(1, K + 1)))
        self.total = self.tokens if self.taken > 0 else self.tokens + 1
        self.unknown = (self.taken or 1.0) / self.total

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.d[np.where(c > K, 0, c)] * c / self.total, self.unknown)


class _Cut:
    """Segments of texts (whole texts but for very long ones) until they make a block."""

    def __init__(self):
        self.hashes, self.counts, self.before, self.rows, self.ids, self.trained, self.size = [], [], [], [], [], [], 0

    def add(self, part: pa.RecordBatch, texts: pa.Array, row: int, before: int = 0, last: bool = True) -> int:
        """Takes the texts in; returns the hash of the last word.  ``before``: the word before the (only) text; ``last``: it ends."""
        words = Words(texts, SPACE, lower=True)
        n = len(texts)
        size = words.count + last
        flat = np.empty(int(size.sum()), dtype=np.uint64)
        if last:
            ends = words.first[1:] + np.arange(n)
            inside = np.ones(len(flat), dtype=bool)
            inside[ends] = False
            flat[ends], flat[inside] = END, words.hash
        else:
            flat[:] = words.hash
        self.hashes.append(flat)
        self.counts.append(size)
        self.before.append(np.full(n, before, dtype=np.uint64))
        self.rows += range(row, row + n)
        self.ids += column(part, "doc_id").to_pylist()
        self.trained += column(part, "trained").to_pylist()
        self.size += len(words.raw) + 64 * n
        return int(words.hash[-1]) if len(words.start) else before

    def block(self, number: int) -> pa.RecordBatch:
        flat, counts, before = np.concatenate(self.hashes), np.concatenate(self.counts), np.concatenate(self.before)
        words, token, n = np.unique(np.concatenate([flat, before[before > 0]]), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # frequent words get small numbers, which pack well
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        token = rank[token]
        first = np.zeros(len(counts), dtype=np.int64)  # word before a segment, from 1; 0: start of text
        first[before > 0] = token[len(flat):] + 1
        trained = np.array(self.trained, dtype=bool)
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([self.rows], pa.list_(pa.int64())), pa.array([self.ids], pa.list_(pa.int64())), pa.array([self.trained], pa.list_(pa.bool_())),
            pa.array([pack(counts)], pa.binary()), pa.array([pack(first)], pa.binary()), pa.array([words[order].astype("<u8").tobytes()], pa.binary()), pa.array([pack(token[:len(flat)])], pa.binary()),
            pa.array([len(flat)], pa.int64()), pa.array([int(counts[trained].sum())], pa.int64()), pa.array([int((trained & (before == 0)).sum())], pa.int64())],
            names=["block", "rows", "ids", "trained", "counts", "before", "words", "tokens", "n_tokens", "n_trained", "n_starts"])


def _segments(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """One very long text in parts that end between words."""
    raw, _ = text_bytes(texts)
    at = 0
    while at < len(raw):
        to = min(len(raw), at + size)
        while to < len(raw) and SPACE[raw[to]]:  # up to the end of the word
            step = np.flatnonzero(~SPACE[raw[to:to + size]])
            to += int(step[0]) if len(step) else min(size, len(raw) - to)
        yield pa.array([raw[at:to].tobytes()], pa.large_binary()).cast(pa.large_string())
        at = to


def _cut(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        row, cut = number, _Cut()
        for batch in batches:
            for part, texts in pieces(batch):
                raw, _ = text_bytes(texts)
                parts = list(_segments(texts, block_bytes)) if len(texts) == 1 and len(raw) > 2 * block_bytes else [texts]
                before = 0
                for k, text in enumerate(parts):
                    before = cut.add(part, text, row, before, k == len(parts) - 1)
                    if cut.size >= block_bytes:
                        yield cut.block(number)
                        number, cut = number + 1, _Cut()
                row += part.num_rows
        if cut.rows:
            yield cut.block(number)
    return run


class _Block:
    """A stored block's tokens as numbers of its words, and the context of each."""

    def __init__(self, row: dict):
        self.words = np.frombuffer(row["words"], dtype="<u8")
        self.counts = unpack(row["counts"], len(row["ids"]))
        self.token = unpack(row["tokens"], row["n_tokens"])
        self.trained = np.repeat(np.array(row["trained"], dtype=bool), self.counts)
        self.row = row

    def contexts(self) -> np.ndarray:
        """The word before each token, from 1; 0: the start of text."""
        out = np.empty(len(self.token), dtype=np.int64)
        out[1:] = self.token[:-1] + 1
        some = self.counts > 0
        out[(np.cumsum(self.counts) - self.counts)[some]] = unpack(self.row["before"], len(self.counts))[some]
        return out

    def dealt(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """The words' order by bucket, and where each bucket's begin."""
        bucket = (self.words % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((self.words, bucket))
        return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _ask_words(buckets: int):
    """(bucket, block, words, their training counts, all counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                v = len(block.words)
                count = np.bincount(block.token[block.trained], minlength=v)
                order, cuts = block.dealt(buckets)
                full = np.flatnonzero(np.diff(cuts))
                lists = [order[cuts[b]:cuts[b + 1]] for b in full]
                yield pa.RecordBatch.from_arrays([
                    pa.array(full.astype(np.int32)), pa.array([row["block"]] * len(full), pa.int64()), pa.array([len(x) for x in lists], pa.int32()),
                    pa.array([pack(np.diff(block.words[x], prepend=np.uint64(0))) for x in lists], pa.binary()), pa.array([pack(count[x]) for x in lists], pa.binary())],
                    names=["bucket", "block", "n", "words", "counts"])
    return run


def _columns(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["block", "kind", "seq", "a", "b", "c", "d"])


def _tally(counts: np.ndarray) -> bytes:
    """Number of positive counts, and how many counts are 1, 2 .. K + 1."""
    return np.bincount(np.minimum(counts, K + 2), minlength=K + 3).astype("<i8").tobytes()


def _count_words(buckets: int, hot: int):
    """A bucket's words counted and numbered.  Kind 0: the words (block: bucket) with counts, and those that are hot; kind 1: answers to blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), rows in groups(batches, "bucket"):
            rows = rows.to_pylist()
            asked = np.concatenate([np.cumsum(unpack(r["words"], r["n"]).view(np.uint64), dtype=np.uint64) for r in rows])
            words, which = np.unique(asked, return_inverse=True)
            count = np.bincount(which, weights=np.concatenate([unpack(r["counts"], r["n"]) for r in rows])).astype(np.int64)
            order = np.argsort(-count, kind="stable")
            number = np.empty(len(order), dtype=np.int64)
            number[order] = 1 + np.arange(len(order)) * buckets + bucket
            hot_ones = number[count >= hot]
            yield _columns([(bucket, 0, len(words), words[order].astype("<u8").tobytes(), pack(count[order]), _tally(count), hot_ones.astype("<i8").tobytes())])
            at = 0
            for r in rows:
                mine = which[at:at + r["n"]]
                at += r["n"]
                yield _columns([(r["block"], 1, bucket, pack(number[mine]), pack(count[mine]), b"", b"")])
    return run


class _Known(_Block):
    """A block with the number and the training count of each of its words (index 0: the start of text)."""

    def __init__(self, row: dict, answers: list[dict], buckets: int, starts: int):
        super().__init__(row)
        order, cuts = self.dealt(buckets)
        self.number, self.count = np.zeros(len(self.words) + 1, dtype=np.int64), np.zeros(len(self.words) + 1, dtype=np.int64)
        self.count[0] = starts
        for r in answers:
            mine = order[cuts[r["seq"]]:cuts[r["seq"] + 1]] + 1
            self.number[mine], self.count[mine] = unpack(r["a"], len(mine)), unpack(r["b"], len(mine))

    def pairs(self, buckets: int, hot: np.ndarray):
        """Distinct pairs of known context and word by bucket: (context, word, training count, bucket cuts), and the pair of each token (-1: none).

        All unknown words are word 0, so that a context's backoff weight is asked for once."""
        h, w = self.contexts(), np.where(self.count[self.token + 1] > 0, self.token + 1, 0)
        ask = np.flatnonzero(self.count[h] > 0)
        key, which = np.unique(h[ask] * len(self.count) + w[ask], return_inverse=True)
        n = np.bincount(which, weights=self.trained[ask], minlength=len(key)).astype(np.int64)
        h, w = key // len(self.count), key % len(self.count)
        bucket = self.number[h] % buckets
        split = np.flatnonzero(np.isin(self.number[h], hot))
        bucket[split] = (mix(self.number[h[split]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.number[w[split]].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        pair = np.full(len(self.token), -1, dtype=np.int64)
        pair[ask] = place[which]
        return h[order], w[order], n[order], np.searchsorted(bucket[order], np.arange(buckets + 1)), pair


def _runs(h: np.ndarray) -> np.ndarray:
    """Where a new context begins."""
    return np.flatnonzero(np.diff(h, prepend=-1))


ASKED = "bucket int, block long, n int, m int, contexts binary, runs binary, words binary, counts binary, word_counts binary"


def _ask_pairs(word_buckets: int, buckets: int, hot: np.ndarray, starts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_,), rows in groups(batches, "block"):
            rows = rows.to_pylist()
            block = _Known(rows[0], rows[1:], word_buckets, starts)
            h, w, n, cuts, _ = block.pairs(buckets, hot)
            out = []
            for b in np.flatnonzero(np.diff(cuts)):
                mine = slice(cuts[b], cuts[b + 1])
                begin = _runs(h[mine])
                out.append((b, rows[0]["block"], len(h[mine]), len(begin), pack(block.number[h[mine][begin]]), pack(np.diff(begin, append=len(h[mine]))), pack(block.number[w[mine]]), pack(n[mine]),
                            pack(np.where(n[mine] > 0, block.count[w[mine]], 0))))
            if out:
                types = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["bucket", "block", "n", "m", "contexts", "runs", "words", "counts", "word_counts"])
    return run


def _count_pairs(hot: np.ndarray, words: Words1):
    """A bucket's pairs counted.  Kind 0: the pairs (block: bucket) with counts; kind 3: this bucket's part of the hot contexts;
    kind 2: answers to blocks, with the sums of the contexts after which a block has an unknown pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), rows in groups(batches, "bucket"):
            rows = rows.to_pylist()
            runs = [unpack(r["runs"], r["m"]) for r in rows]
            hs, h = np.unique(np.concatenate([np.repeat(unpack(r["contexts"], r["m"]), k) for r, k in zip(rows, runs)]), return_inverse=True)
            ws, w = np.unique(np.concatenate([unpack(r["words"], r["n"]) for r in rows]), return_inverse=True)
            key, which = np.unique(h * len(ws) + w, return_inverse=True)
            n = np.concatenate([unpack(r["counts"], r["n"]) for r in rows])
            count = np.bincount(which, weights=n).astype(np.int64)
            of_word = np.zeros(len(key), dtype=np.int64)
            seen = np.flatnonzero(n)
            of_word[which[seen]] = np.concatenate([unpack(r["word_counts"], r["n"]) for r in rows])[seen]
            known = np.flatnonzero(count)
            context = key[known] // len(ws)
            small = np.bincount(context * (K + 2) + np.minimum(count[known], K + 1), minlength=len(hs) * (K + 2)).reshape(-1, K + 2)
            lower = np.bincount(context, weights=words.p(of_word[known]), minlength=len(hs))
            least = np.where(small[:, 1:].any(axis=1), 1 + (small[:, 1:] > 0).argmax(axis=1), K + 1)
            begin = _runs(context)
            yield _columns([(bucket, 0, len(known), len(begin).to_bytes(8, "little") + pack(hs[context[begin]]), pack(np.diff(begin, append=len(known))), pack(ws[key[known] % len(ws)]), pack(count[known]) + _tally(count))])
            mine = np.flatnonzero(np.isin(hs, hot))
            if len(mine):
                yield _columns([(bucket, 3, len(mine), hs[mine].astype("<i8").tobytes(), small[mine, 1:K + 1].astype("<i8").tobytes(), lower[mine].astype("<f8").tobytes(), least[mine].astype("<i8").tobytes())])
            at = 0
            for r, k in zip(rows, runs):
                got = count[which[at:at + r["n"]]]
                ctx = h[at:at + r["n"]][np.cumsum(k) - k]
                at += r["n"]
                need = ctx[np.minimum.reduceat(got, np.cumsum(k) - k) == 0]
                yield _columns([(r["block"], 2, bucket, pack(got), pack(least[ctx]), pack(small[need, 1:K + 1].reshape(-1)), pack_floats(lower[need]))])
    return run


def _score(word_buckets: int, buckets: int, words: Words1, d: np.ndarray, hot: dict[int, tuple]):
    """Per segment: tokens, known tokens, base score and the recursive score of its tokens."""
    hot_ids = np.array(sorted(hot), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = max([r for r in range(1, K + 1) if d[r] < 1], default=0)
        taken = (1 - d[1:]) * np.arange(1, K + 1)
        for (_,), rows in groups(batches, "block"):
            rows = rows.to_pylist()
            block = _Known(rows[0], [r for r in rows if r["kind"] == 1], word_buckets, words.starts)
            h, w, _, cuts, pair = block.pairs(buckets, hot_ids)
            count = np.zeros(len(h) + 1, dtype=np.int64)
            v = len(block.count)
            least, backoff = np.full(v, K + 1), np.ones(v)
            for r in rows:
                if r["kind"] != 2:
                    continue
                lo, hi = cuts[r["seq"]], cuts[r["seq"] + 1]
                count[lo:hi] = unpack(r["a"], hi - lo)
                begin = _runs(h[lo:hi])
                ctx = h[lo:hi][begin]
                least[ctx] = unpack(r["b"], len(ctx))
                need = ctx[np.minimum.reduceat(count[lo:hi], begin) == 0]
                mass = unpack(r["c"], len(need) * K).reshape(-1, K) @ taken
                c = block.count[need]
                backoff[need] = np.where(least[need] <= last, mass / c, 1 / (c + 1)) / (1 - floats(r["d"]))
            for c in np.flatnonzero(np.isin(block.number, hot_ids)):
                if int(block.number[c]) in hot:  # the end of text is frequent, but no context
                    small, lower, least[c] = hot[int(block.number[c])]
                    backoff[c] = (np.dot(small, taken) / block.count[c] if least[c] <= last else 1 / (block.count[c] + 1)) / (1 - lower)
            known = block.count[block.token + 1]
            context = block.contexts()
            c = count[pair]  # -1: the zero at the end
            total = block.count + (least > last)
            one = np.log10(words.p(block.count))
            with np.errstate(divide="ignore", invalid="ignore"):
                seen = np.log10(d[np.where(c > K, 0, c)] * c / total[context])
            score = np.where(c > 0, seen, one[block.token + 1] + np.where(block.count[context] > 0, np.log10(backoff)[context], 0.0))
            base = np.log10((known + 1) / (words.tokens + words.known + 1))
            ends = np.concatenate([[0], np.cumsum(block.counts)])

            def sums(x: np.ndarray) -> np.ndarray:
                out = np.zeros(len(block.counts), dtype=x.dtype)
                some = block.counts > 0
                if some.any():
                    out[some] = np.add.reduceat(x, ends[:-1][some])
                return out

            one_row = rows[0]
            yield pa.RecordBatch.from_arrays([
                pa.array(one_row["rows"], pa.int64()), pa.array(one_row["ids"], pa.int64()), pa.array([not t for t in one_row["trained"]], pa.bool_()), pa.array(block.counts, pa.int64()),
                pa.array(sums((known > 0).astype(np.int64)), pa.int64()), pa.array(sums(base)), pa.array(sums(score))], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


@dataclass
class Model:
    """Stored tables and the few numbers that evaluation needs of them."""

    blocks: DataFrame
    words: DataFrame    # kind 0: words by bucket; kind 1: answers to the blocks
    pairs: DataFrame    # kind 0: pairs by bucket; kind 2: answers; kind 3: parts of hot contexts
    word_buckets: int
    pair_buckets: int
    unigrams: Words1
    d: np.ndarray       # discounts of pair counts
    hot: dict[int, tuple]


def _kept(rows: DataFrame, tag: str) -> DataFrame:
    """Stored by kind, so that what answers blocks is read apart from the tables of the model."""
    path = shared_path(rows.sparkSession, tag)
    rows.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    schema = rows.schema
    return rows.sparkSession.read.schema(schema).parquet(path)


def _by_block(model_blocks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Every block (kind 0, first) with the answers to it, in one task each."""
    columns = [c.split()[0] for c in BLOCK.split(", ")]
    kinds = {f.name: f.dataType for f in model_blocks.schema}
    rows = model_blocks.select("block", F.lit(0).alias("kind"), F.lit(0).alias("seq"), *(F.lit(None).cast("binary").alias(c) for c in "abcd"), *columns[1:])
    for a in answers:
        rows = rows.unionByName(a.select("block", "kind", "seq", "a", "b", "c", "d", *(F.lit(None).cast(kinds[c]).alias(c) for c in columns[1:])))
    return rows.repartition("block").sortWithinPartitions("block", "kind", "seq")


def fit(docs: DataFrame, trained: Column, block_bytes: int = BLOCK_BYTES, bucket_tokens: int = BUCKET_TOKENS, hot_share: int = HOT_SHARE) -> Model:
    """Counts words and pairs of the texts for which ``trained`` holds (or is null); all texts are in the blocks."""
    spark = tuned(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(trained, F.lit(True)).alias("trained"))
    blocks = stored(texts.mapInArrow(_cut(block_bytes), BLOCK), "blocks")
    size = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_tokens", "n_trained", "n_starts"))).first()
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), size["n_tokens"] // bucket_tokens)
    hot_count = max(1, size["n_tokens"] // hot_share)
    asked = blocks.mapInArrow(_ask_words(buckets), "bucket int, block long, n int, words binary, counts binary")
    words = _kept(asked.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(_count_words(buckets, hot_count), PACKED), "words")
    tallies, hot = np.zeros(K + 3, dtype=np.int64), [START]
    for r in words.where("kind = 0").select("c", "d").toLocalIterator():  # a few numbers a bucket; hot words: at most hot_share
        tallies += np.frombuffer(r["c"], dtype="<i8")
        hot += np.frombuffer(r["d"], dtype="<i8").tolist()
    unigrams = Words1(size["n_trained"], size["n_starts"], int(tallies[1:].sum()), tallies.tolist())
    hot_ids = np.array(sorted(hot), dtype=np.int64)
    asked = _by_block(blocks, words.where("kind = 1")).mapInArrow(_ask_pairs(buckets, buckets, hot_ids, unigrams.starts), ASKED)
    pairs = _kept(asked.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(_count_pairs(hot_ids, unigrams), PACKED), "pairs")
    tallies = np.zeros(K + 3, dtype=np.int64)
    for r in pairs.where("kind = 0").select(F.expr(f"substring(d, -{8 * (K + 3)}, {8 * (K + 3)})").alias("t")).toLocalIterator():
        tallies += np.frombuffer(r["t"], dtype="<i8")
    return Model(blocks, words, pairs, buckets, buckets, unigrams, discounts(tallies.tolist()), _hot(pairs))


def _hot_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            n = r["seq"]
            small = np.frombuffer(r["b"], dtype="<i8").reshape(n, K)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r["a"], dtype="<i8")), *(pa.array(small[:, k].copy()) for k in range(K)), pa.array(np.frombuffer(r["c"], dtype="<f8")), pa.array(np.frombuffer(r["d"], dtype="<i8"))],
                                             names=["h", *(f"n{k + 1}" for k in range(K)), "lower", "least"])


def _hot(pairs: DataFrame) -> dict[int, tuple]:
    """The hot contexts' sums over all buckets; there are at most HOT_SHARE and the start of text."""
    parts = pairs.where("kind = 3").mapInArrow(_hot_parts, "h long, " + "".join(f"n{k + 1} long, " for k in range(K)) + "lower double, least long")
    rows = parts.groupBy("h").agg(*(F.sum(f"n{k + 1}").alias(f"n{k + 1}") for k in range(K)), F.sum("lower").alias("lower"), F.min("least").alias("least")).collect()
    return {r["h"]: (np.array([r[f"n{k + 1}"] for k in range(K)], dtype=np.int64), r["lower"], r["least"]) for r in rows}


def scores(model: Model) -> DataFrame:
    """One row per text of the model's blocks, trained on or held out."""
    rows = _by_block(model.blocks, model.words.where("kind = 1"), model.pairs.where("kind = 2"))
    parts = rows.mapInArrow(_score(model.word_buckets, model.pair_buckets, model.unigrams, model.d, model.hot), "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    whole = parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.unigrams.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            words = np.frombuffer(r["a"], dtype="<u8")
            yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * len(words), pa.int32()), pa.array(words.view(np.int64)), pa.array(unpack(r["b"], len(words)))], names=["bucket", "word_hash", "count"])


def unigrams(model: Model) -> DataFrame:
    """(bucket, word_hash, count) of the training words."""
    return model.words.where("kind = 0").select("block", "a", "b").mapInArrow(_word_rows, "bucket int, word_hash long, count long").where("count > 0")


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            n, m = r["seq"], int.from_bytes(r["a"][:8], "little")
            h = np.repeat(unpack(r["a"][8:], m), unpack(r["b"], m))
            yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * n, pa.int32()), pa.array(h), pa.array(unpack(r["c"], n)), pa.array(unpack(r["d"][:-8 * (K + 3)], n))], names=["bucket", "context", "word", "count"])


def bigrams(model: Model) -> DataFrame:
    """(bucket, context, word, count) of the training pairs; words by number (context 0: the start of text)."""
    return model.pairs.where("kind = 0").select("block", "seq", "a", "b", "c", "d").mapInArrow(_pair_rows, "bucket int, context long, word long, count long")


def two_of_seven(docs: DataFrame) -> Column:
    return F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 2


def op13_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scores(fit(docs, ~two_of_seven(docs)))


def _oracle() -> str:
    d = lambda k, r: f"((({r} + 1) * n{r + 1} / ({r} * n{r}) - {k + 1.0} * n{k + 1} / n1) / (1 - {k + 1.0} * n{k + 1} / n1))"
    valid = {k: " AND ".join([*(f"n{r} > 0" for r in range(1, k + 2)), f"{k + 1} * n{k + 1} < n1", *(f"{d(k, r)} > 0 AND {d(k, r)} < 1" for r in range(1, k + 1))]) for k in range(K, 1, -1)}
    discount = lambda r: "CASE " + " ".join(f"WHEN {v} THEN {d(k, r) if r <= k else '1.0'}" for k, v in valid.items()) + f" ELSE ({r} - 0.5) / {r} END AS d{r}"
    counted = lambda t: f"SELECT CAST(sum(c) AS DOUBLE) AS n, CAST(count(*) AS DOUBLE) AS v, {', '.join(f'CAST(count(*) FILTER (c = {r}) AS DOUBLE) AS n{r}' for r in range(1, K + 2))} FROM {t}"
    of = lambda t: f"CASE c {' '.join(f'WHEN {r} THEN {t}.d{r}' for r in range(1, K + 1))} ELSE 1.0 END"
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({CRC32.format('doc_id')} % 7 <> 2, true) AS trained,
  list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), '') AS ws FROM documents),
tok AS (SELECT r, trained, ws[i] AS w, CASE WHEN i = 1 THEN ' ' ELSE ws[i - 1] END AS h FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM doc)),
c1 AS (SELECT w, CAST(count(*) AS DOUBLE) AS c FROM tok WHERE trained GROUP BY w),
c2 AS (SELECT h, w, CAST(count(*) AS DOUBLE) AS c FROM tok WHERE trained GROUP BY h, w),
s1 AS (SELECT *, {', '.join(discount(r) for r in range(1, K + 1))} FROM ({counted('c1')})),
s2 AS (SELECT *, {', '.join(discount(r) for r in range(1, K + 1))} FROM ({counted('c2')})),
u AS (SELECT n, v, {' + '.join(f'(1 - d{r}) * {r} * n{r}' for r in range(1, K + 1))} AS taken FROM s1),
p1 AS (SELECT w, c, {of('s1')} * c / CASE WHEN taken > 0 THEN u.n ELSE u.n + 1 END AS p FROM c1, s1, u),
ctx AS (SELECT h, sum(c) AS ch, sum((1 - {of('s2')}) * c) AS mass, sum(p) AS lower FROM (SELECT h, c2.w AS w, c2.c AS c, p FROM c2 JOIN p1 USING (w)), s2 GROUP BY h),
b AS (SELECT h, CASE WHEN mass > 0 THEN ch ELSE ch + 1 END AS total, CASE WHEN mass > 0 THEN mass / ch ELSE 1 / (ch + 1) END / (1 - lower) AS backoff FROM ctx),
p2 AS (SELECT h, w, {of('s2')} * c / total AS p FROM c2 JOIN b USING (h), s2),
x AS (SELECT r, p1.c AS c, log10((coalesce(p1.c, 0) + 1) / (u.n + u.v + 1)) AS base,
  CASE WHEN p2.p IS NOT NULL THEN log10(p2.p) ELSE log10(coalesce(backoff, 1)) + log10(coalesce(p1.p, CASE WHEN taken > 0 THEN taken / u.n ELSE 1 / (u.n + 1) END)) END AS s
  FROM tok LEFT JOIN p1 USING (w) LEFT JOIN p2 ON tok.h = p2.h AND tok.w = p2.w LEFT JOIN b ON tok.h = b.h, u)
SELECT doc_id, NOT trained AS held_out, count(*) AS n_tokens, count(c) AS n_known, CAST((SELECT n FROM u) AS BIGINT) AS train_tokens, sum(base) AS base_score, sum(s) AS score
FROM x JOIN doc USING (r) GROUP BY r, doc_id, trained
"""


ORACLE = _oracle()
