"""Vectorised words, word hashes and window hashes of Arrow text columns.

All functions work on pieces of a record batch (``pieces``), so memory follows
the piece size, not the batch size.  A word is a maximal run of word bytes; the
two classes used by the contracts are given by ASCII separators only, so they
can be decided on UTF-8 bytes.  Hashes are 64-bit polynomials over random byte
values, the same in every task and at every position of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1_000_000

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_BASE = 0x9E3779B97F4A7C15 | 5
_WORD_BASE = 0xC2B2AE3D27D4EB4F & ~7 | 3

SPACE = np.ones(256, dtype=bool)                       # [^\x20\x09-\x0D]+
SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)                      # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_BYTE_POWERS, _WORD_POWERS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def as_text(column: pa.Array) -> pa.Array:
    """The column as large_string without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 byte offsets of the texts in them."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(batch: pa.RecordBatch, text: str = "text", size: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Row ranges of the batch with about ``size`` bytes of text each, and their texts."""
    texts = as_text(batch.column(batch.schema.get_field_index(text)))
    _, off = text_bytes(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at = to


class Words:
    """The words of some texts.

    start, end: byte range of each word in ``raw``; first: n + 1 offsets of the
    texts' words; doc: the text of each word.
    """

    def __init__(self, texts: pa.Array, word_bytes: np.ndarray = SPACE, lower: bool = False):
        self.raw, self.off = text_bytes(texts)
        if lower:
            self.raw = _LOWER[self.raw]
        n = len(self.raw)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = word_bytes[self.raw]
        begins = inside[1:-1] & ~inside[:-2]
        closes = inside[1:-1] & ~inside[2:]
        full = self.off[:-1] < self.off[1:]
        heads, tails = self.off[:-1][full], self.off[1:][full] - 1
        begins[heads] = inside[1:-1][heads]
        closes[tails] = inside[1:-1][tails]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, self.off)
        self.count = np.diff(self.first)
        self._hash = None

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    @property
    def hash(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        if self._hash is None:
            self._hash = byte_hashes(self.raw, self.start, self.end)
        return self._hash

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Start word and hash of every run of ``size`` words inside one text."""
        h = run_hashes(self.hash, size)
        room = np.repeat(self.first[1:], self.count) - size
        at = np.flatnonzero(np.arange(len(self.start)) <= room)
        return at, h[at]


def byte_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end)."""
    up, down = _BYTE_POWERS.get(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[raw] * up[:len(raw)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of words[i:i + size] for every i with so many words after it."""
    n = len(words)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    up, down = _WORD_POWERS.get(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * up[:n], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[:n - size + 1] + np.uint64(size))


def sequence_hash(words: np.ndarray) -> int:
    return int(run_hashes(words, len(words))[0]) if len(words) else 0


def signed(h: np.ndarray) -> np.ndarray:
    """Spark's long of a 64-bit hash."""
    return h.astype(np.uint64, copy=False).view(np.int64)
