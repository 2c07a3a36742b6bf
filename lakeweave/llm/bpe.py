"""Byte-level BPE over a global shuffle of distinct words.

A pass cuts the texts into pre-tokens and gathers them in blocks of bounded size.
Per block, the distinct pre-tokens are dealt by hash to buckets; the task of a bucket
merges every distinct word of the corpus once and sends the ids back to the blocks
that asked.  The other product of the pass, the texts as positions into their
block's words, meets the ids there and the token sequences are put together.
A frequent word is sent once per block, not once per occurrence.  Decoding
joins ids with the table of token bytes, which has as many rows as the vocabulary.

Both passes carry a hash of the block that they cut: if a lost executor's second try cut another one (an input
without a fixed order), the job fails and gives no wrong ids.

Defined cases: null text counts as empty and has no tokens; a word of any length is
merged (long ones over a heap); pairs of equal rank are merged from the left; repeated rows give repeated rows; null ids stay
null; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import column, groups, table, tuned
from .words import pieces, text_bytes

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text in one block; a longer text is a block of its own.
BLOCK_BYTES = 14_000_000
#: Buckets of words; with more shuffle partitions there are more.
BUCKETS = 2048
_NEXT = 1 << 20


class Vocabulary:
    """Ranks of byte strings, and the bytes of each rank as one flat table."""

    def __init__(self, content: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.pattern, self.by_class = regex.compile(pattern), pattern == CLASS_PATTERN
        size = max(self.ranks.values(), default=-1) + 1
        self.type = np.uint16 if size <= 1 << 16 else np.uint32
        tokens: list[bytes] = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank is merged first, the leftmost of equals."""
        rank = self.ranks.get(word)
        if rank is not None:
            return [rank]
        if len(word) > 100:
            return self._encode_long(word)
        ranks = self.ranks
        parts = [word[i:i + 1] for i in range(len(word))]
        pairs = [ranks.get(a + b, _NEXT) for a, b in zip(parts, parts[1:])]
        while pairs:
            least = min(pairs)
            if least == _NEXT:
                break
            i = pairs.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], _NEXT)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], _NEXT)
        return [ranks[p] for p in parts]

    def _encode_long(self, word: bytes) -> list[int]:
        ranks = self.ranks
        parts: list[bytes | None] = [word[i:i + 1] for i in range(len(word))]
        after, before = [*range(1, len(parts)), -1], [-1, *range(len(parts) - 1)]
        heap = [(r, i, 2) for i in range(len(parts) - 1) if (r := ranks.get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, size = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or len(parts[i]) + len(parts[j]) != size or ranks.get(parts[i] + parts[j]) != r:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (new := ranks.get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (new, a, len(parts[a]) + len(parts[b])))
        return [ranks[p] for p in parts if p is not None]


@lru_cache(maxsize=2)
def _vocabulary(content: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(content, pattern)


# The pre-token pattern that ``cut`` covers without a regular expression.
CLASS_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point."""
    points = "".join(map(chr, [*range(0xD800), *([0x21] * 0x800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, _OTHER, dtype=np.uint8)
    for number, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, points):
            out[m.start():m.end()] = number
    return out


def cut(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens (by CLASS_PATTERN) in the UTF-8 bytes of texts with offsets ``off``.

    Pre-tokens are runs of one class of characters; one space before a run
    belongs to it, a longer white-space run leaves its last character to what
    follows, and a lone apostrophe may take one of seven endings."""
    n = len(raw)
    if not n:
        return np.zeros(0, dtype=np.int64)
    table = _classes()
    kind = table[:256][raw]
    lead = np.flatnonzero(raw >= 0xC0)
    if len(lead):
        size = np.where(raw[lead] >= 0xF0, 4, np.where(raw[lead] >= 0xE0, 3, 2))
        point = raw[lead].astype(np.int64) & (0xFF >> (size + 1))
        for k in range(1, 4):
            more = size > k
            point[more] = point[more] << 6 | (raw[lead[more] + k] & 0x3F)
        kinds = table[point]
        for k in range(4):
            kind[(lead + k)[size > k]] = kinds[size > k]
    head = np.zeros(n + 1, dtype=bool)
    head[off] = True
    edge = head.copy()
    head[1:-1] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(head)
    begin, end = runs[:-1], runs[1:]
    of = kind[begin]
    starts = np.zeros(n + 1, dtype=bool)

    dark = begin[of != _SPACE]
    joined = ~edge[dark] & (raw[dark - 1] == 0x20)
    starts[dark - joined] = True

    white = of == _SPACE
    a, b = begin[white], end[white]
    last = b - 1
    for _ in range(3):
        last = last - ((raw[last] & 0xC0) == 0x80)
    closes = edge[b]
    starts[a[closes | (last > a)]] = True
    starts[last[~closes & (raw[last] != 0x20)]] = True

    # a lone apostrophe that begins a pre-token and is followed by an ending
    mark = begin[(raw[begin] == 0x27) & (end - begin == 1) & ~edge[end] & (of == _OTHER)]
    for i in mark[starts[mark]].tolist():
        ending = raw[i + 1:i + 3].tobytes()
        size = 1 if ending[:1] in (b"s", b"t", b"m", b"d") else 2 if ending in (b"re", b"ve", b"ll") and not edge[i + 2] else 0
        if size:
            starts[i + 1] = False
            if i + 1 + size < n:
                starts[i + 1 + size] |= kind[i + 1 + size] == _LETTER
    return np.flatnonzero(starts[:-1])


class _Block:
    """Pre-tokens of some batches: distinct words, and every text as numbers of its words."""

    def __init__(self):
        self.number: dict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.batches: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: pa.Array, vocabulary: Vocabulary) -> None:
        raw, off = text_bytes(texts)
        if vocabulary.by_class:
            at = cut(raw, off)
            data = raw.tobytes()
            words = [data[a:b] for a, b in zip(at.tolist(), [*at[1:].tolist(), len(data)])]
            counts = np.diff(np.searchsorted(at, off))
        else:
            found = [[w.encode() for w in vocabulary.pattern.findall(text)] for text in texts.to_pylist()]
            words, counts = [w for f in found for w in f], np.array([len(f) for f in found], dtype=np.int64)
        self.batches.append((ids, counts, np.fromiter(map(self.number.__getitem__, words), dtype=np.int32, count=len(words))))
        self.size += len(raw)

    def checksum(self) -> int:
        """Hash of the block's words and of where they stand: both passes must have cut the same block."""
        h = xxhash.xxh3_64(b"\0".join(self.number))
        for _, counts, flat in self.batches:
            h.update(counts.astype("<i8").tobytes() + flat.tobytes())
        return h.intdigest() - (1 << 63)

    def dealt(self, buckets: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The words, their buckets, and their order by bucket."""
        words = list(self.number)
        bucket = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) % buckets
        return words, bucket, np.argsort(bucket, kind="stable")


def _blocks(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, block_bytes: int) -> Iterator[tuple[int, _Block]]:
    """(number, block): numbered by partition, so both passes over the texts agree."""
    number, block = TaskContext.get().partitionId() << 24, _Block()
    for batch in batches:
        for part, texts in pieces(batch):
            block.add(column(part, "doc_id"), texts, vocabulary)
            if block.size >= block_bytes:
                yield number, block
                number, block = number + 1, _Block()
    if block.batches:
        yield number, block


def _planes(numbers: np.ndarray) -> bytes:
    """Packed numbers, all lowest bytes first: the higher ones are mostly zero."""
    raw = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(raw.tobytes())


def _unplanes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view("<u4").astype(np.int64)


def _words(content: bytes, pattern: str, block_bytes: int, buckets: int):
    """Pass for the words: (bucket, block, lengths, words) of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(batches, _vocabulary(content, pattern), block_bytes):
            words, bucket, order = block.dealt(buckets)
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            rows = [[words[i] for i in order[a:b]] for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_pydict({
                "bucket": bucket[order][cuts[:-1]].astype(np.int32), "block": pa.array([number] * len(rows), pa.int64()),
                "check": pa.array([block.checksum()] * len(rows), pa.int64()),
                "lengths": [np.array([len(w) for w in r], dtype="<u4").tobytes() for r in rows], "words": [b"".join(r) for r in rows]})
    return run


def _places(content: bytes, pattern: str, block_bytes: int, buckets: int):
    """Pass for the texts: per block, the order of its words (kind 0) and its texts (kind 2).

    Numbers follow frequency, which packs them; the order leads from them to the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(batches, _vocabulary(content, pattern), block_bytes):
            words, _, order = block.dealt(buckets)
            place = np.empty(len(words), dtype=np.int64)
            place[order] = np.arange(len(words))
            count = np.zeros(len(words), dtype=np.int64)
            for _, _, flat in block.batches:
                count += np.bincount(flat, minlength=len(words))
            by_count = np.argsort(-count, kind="stable")
            rank = np.empty(len(words), dtype=np.int64)
            rank[by_count] = np.arange(len(words))
            yield _row(number, 0, 0, _planes(place[by_count]), b"", pa.array([block.checksum()], pa.int64()))
            for seq, (ids, counts, flat) in enumerate(block.batches):
                yield _row(number, 2, seq, _planes(rank[flat]), counts.astype("<u4").tobytes(), ids)
    return run


ROWS = "block long, kind int, seq int, data binary, counts binary, ids array<long>"


def _row(block: int, kind: int, seq: int, data: bytes, counts: bytes, ids: pa.Array | None) -> pa.RecordBatch:
    ids = pa.array([], pa.int64()) if ids is None else ids.cast(pa.int64())
    return pa.RecordBatch.from_arrays([
        pa.array([block], pa.int64()), pa.array([kind], pa.int32()), pa.array([seq], pa.int32()), pa.array([data], pa.binary()), pa.array([counts], pa.binary()),
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], names=["block", "kind", "seq", "data", "counts", "ids"])


def _merge(content: bytes, pattern: str):
    """The bucket's task: each distinct word is merged once, whatever the number of blocks that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(content, pattern)
        known: dict[bytes, tuple[int, bytes]] = {}
        current = None
        for batch in batches:
            out: list[tuple] = []
            for bucket, block, check, lengths, words in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != current:
                    known, current = {}, bucket
                at, sizes, ids = 0, [], []
                for n in np.frombuffer(lengths, dtype="<u4").tolist():
                    word = words[at:at + n]
                    at += n
                    got = known.get(word)
                    if got is None:
                        tokens = vocabulary.encode(word)
                        got = known[word] = (len(tokens), np.array(tokens, dtype=vocabulary.type).tobytes())
                    sizes.append(got[0])
                    ids.append(got[1])
                out.append((block, bucket, check, b"".join(ids), np.array(sizes, dtype="<u4").tobytes()))
            if out:
                block, bucket, check, ids, sizes = zip(*out)
                n = len(out)
                yield pa.RecordBatch.from_arrays([
                    pa.array(block, pa.int64()), pa.array([1] * n, pa.int32()), pa.array(bucket, pa.int32()), pa.array(ids, pa.binary()), pa.array(sizes, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(range(n + 1), pa.int32()), pa.array(check, pa.int64()))], names=["block", "kind", "seq", "data", "counts", "ids"])
    return run


def _take(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of all items of the ranges begin[i] .. begin[i] + length[i], one after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - length), length)


def _assemble(content: bytes, pattern: str, finish: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(content, pattern)
        for _, rows in groups(batches, "block"):
            kind, data, counts = rows["kind"].to_pylist(), rows["data"].to_pylist(), rows["counts"].to_pylist()
            words = [i for i, k in enumerate(kind) if k == 1]  # by bucket
            length = np.concatenate([np.frombuffer(counts[i], dtype="<u4") for i in words]).astype(np.int64) if words else np.zeros(0, np.int64)
            ids = np.frombuffer(b"".join(data[i] for i in words), dtype=vocabulary.type)
            begin = np.cumsum(length) - length
            order = _unplanes(data[kind.index(0)])
            check = rows["ids"][kind.index(0)].as_py()
            if len(order) != len(length) or any(rows["ids"][i].as_py() != check for i in words):
                raise RuntimeError("the passes over the texts cut different blocks")
            for i, k in enumerate(kind):
                if k != 2:
                    continue
                word = order[_unplanes(data[i])]
                size = length[word]
                n = np.frombuffer(counts[i], dtype="<u4").astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
                yield finish(rows["ids"][i].values, ids[_take(begin[word], size)], ends, vocabulary)
    return run


def _digest(doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> pa.RecordBatch:
    wide = ids.astype("<u4")
    length = vocabulary.length[ids]
    decoded = vocabulary.bytes[_take(vocabulary.begin[ids], length)]
    at = np.concatenate([[0], np.cumsum(length)])[ends]
    return pa.RecordBatch.from_arrays([
        doc_ids, pa.array(np.diff(ends), pa.int64()),
        pa.array([hashlib.sha256(wide[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]),
        pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(at, at[1:])])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _tokens(doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([doc_ids, pa.ListArray.from_arrays(ends.astype(np.int32), ids.astype(np.int32))], names=["doc_id", "ids"])


def _encoded(docs: DataFrame, path: str, pattern: str, finish: Callable, schema: str, block_bytes: int, buckets: int) -> DataFrame:
    spark = tuned(docs.sparkSession)
    with open(path, "rb") as f:
        content = f.read()
    buckets = max(buckets, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    words = texts.mapInArrow(_words(content, pattern, block_bytes, buckets), "bucket int, block long, check long, lengths binary, words binary")
    ids = words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge(content, pattern), ROWS)
    # the texts come first: a union keeps its first child's partition numbers, which number the blocks
    rows = texts.mapInArrow(_places(content, pattern, block_bytes, buckets), ROWS).unionByName(ids)
    return rows.repartition("block").sortWithinPartitions("block", "kind", "seq").mapInArrow(_assemble(content, pattern, finish), schema)


def encode(docs: DataFrame, path: str, pattern: str, block_bytes: int = BLOCK_BYTES, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, ids) of every document, without special tokens."""
    return _encoded(docs, path, pattern, _tokens, "doc_id long, ids array<int>", block_bytes, buckets)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, data): the bytes of each row's ids, from the table of token bytes."""
    with open(path, "rb") as f:
        content = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(content, pattern)
        for batch in batches:
            data = []
            for ids in column(batch, "ids").to_pylist():
                i = np.array(ids or [], dtype=np.int64)
                data.append(vocabulary.bytes[_take(vocabulary.begin[i], vocabulary.length[i])].tobytes())
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def token_digests(docs: DataFrame, path: str, pattern: str, block_bytes: int = BLOCK_BYTES, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: n_tokens, and hashes of its ids and of the bytes they decode to."""
    return _encoded(docs, path, pattern, _digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", block_bytes, buckets)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
