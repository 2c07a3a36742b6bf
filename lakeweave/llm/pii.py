"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF.

The patterns give the base spans.  The network, written in numpy, learns from base
spans in a bounded sample of windows (and from copies of them with other digits,
letters and separators) and adds spans that no pattern takes.  Texts are covered by
windows of ``WINDOW`` code points that overlap by half; each is decoded by itself.
A span that touches a cut edge is left to the neighbour window, which has it whole; of
overlapping spans of a text the longest stays, and none may overlap a base span.  A span is widened
to the whole number or address that it is part of.

A span holds a digit or an @ by definition, so a window without either has the empty
decoding as its only one, and is not run through the network.

Defined cases: null text counts as empty and has no spans; repeated rows give repeated
rows, and so do they in the sample, whose ties go by doc_id and start; texts of any length take time in proportion to it; an empty table has no rows and no network; without a single labelled span there is no network, and the base spans are all;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import column, stored, table, tuned, with_text
from .words import pieces, text_bytes

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
HIDDEN = 16
#: Windows with and without spans in the sample.
SAMPLE, SAMPLE_PLAIN = 900, 300
EPOCHS, BATCH, RATE = 6, 64, 0.02
#: Windows decoded at once.
DECODE = 256

_TRIGGER = np.zeros(256, dtype=bool)
_TRIGGER[[*range(0x30, 0x3A), 0x40]] = True
# The patterns of the base spans, taken apart so that each runs in linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, end, kind


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The patterns' spans: per kind leftmost and not overlapping, by start and kind."""
    out: list[Span] = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), 0))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for m in _CHAIN.finditer(text):
        if m[0].count(".") >= 3:
            parts, place = m[0].split("."), m.start()
            for k in range(0, len(parts), 4):
                four = parts[k:k + 4]
                size = sum(map(len, four)) + len(four) - 1
                if len(four) == 4 and all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                    out.append((place, place + size, 1))
                place += size + 1
    for m in _CARD.finditer(text):
        digits = re.sub(r"[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def _windows(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an @."""
    marks = [m.start() for m in re.finditer(r"[0-9@]", text)]
    starts = {k for p in marks for k in (p // STRIDE, p // STRIDE - 1) if k >= 0}
    return sorted(k * STRIDE for k in starts if k == 0 or k * STRIDE + STRIDE < len(text))


_ID = np.full(0x250, 97, dtype=np.int64)
_ID[0x20:0x7F] = np.arange(1, 96)
_ID[0x0A] = 96
CHARACTERS = 99


def character_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the characters, padded to the window, and which are there."""
    ids = np.zeros((len(texts), WINDOW), dtype=np.int64)
    for i, t in enumerate(texts):
        points = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
        ids[i, :len(t)] = np.where(points < len(_ID), _ID[np.minimum(points, len(_ID) - 1)], 98)
    return ids, ids > 0


TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind


def _allowed() -> np.ndarray:
    """Penalty of a transition: the inside of a kind follows its begin or inside only."""
    a = np.zeros((TAGS, TAGS))
    for to in range(2, TAGS, 2):
        a[:, to] = -1e4
        a[[to - 1, to], to] = 0
    return a


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Tagger:
    """BiLSTM over characters with a linear-chain CRF on top."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 3):
        r = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            x = r.normal(0, 0.3, (CHARACTERS, 4 * hidden))
            x[:, hidden:2 * hidden] += 1  # remember at first
            self.p["x" + d] = x
            self.p["h" + d] = r.normal(0, hidden ** -0.5, (hidden, 4 * hidden))
        self.p["out"] = r.normal(0, 0.2, (2 * hidden, TAGS))
        self.p["out_b"] = np.zeros(TAGS)
        self.p["trans"] = np.zeros((TAGS, TAGS))

    def _lstm(self, d: str, ids: np.ndarray, mask: np.ndarray, keep: bool):
        """Hidden states [T, N, H] in time order, and what the way back needs."""
        n, t_all, size = len(ids), ids.shape[1], self.hidden
        x, w = self.p["x" + d], self.p["h" + d]
        h, c = np.zeros((n, size)), np.zeros((n, size))
        out, memo = np.zeros((t_all, n, size)), []
        for t in range(t_all) if d == "f" else range(t_all - 1, -1, -1):
            z = x[ids[:, t]] + h @ w
            gates = _sigmoid(z[:, :3 * size])
            g = np.tanh(z[:, 3 * size:])
            i, f, o = gates[:, :size], gates[:, size:2 * size], gates[:, 2 * size:]
            m = mask[:, t, None]
            new = (f * c + i * g) * m
            tanh = np.tanh(new)
            if keep:
                memo.append((t, h, c, i, f, o, g, tanh, m))
            h, c = o * tanh * m, new
            out[t] = h
        return out, memo

    def emissions(self, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        hf, mf = self._lstm("f", ids, mask, keep)
        hb, mb = self._lstm("b", ids, mask, keep)
        both = np.concatenate([hf, hb], axis=2)
        return both @ self.p["out"] + self.p["out_b"], both, mf, mb

    def gradients(self, ids: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags, and its gradients."""
        e, both, mf, mb = self.emissions(ids, mask, True)
        t_all, n = e.shape[:2]
        trans = self.p["trans"] + _allowed()
        first = _allowed()[0] * 0
        alpha = np.zeros((t_all, n, TAGS))
        alpha[0] = e[0] + first
        for t in range(1, t_all):
            s = alpha[t - 1][:, :, None] + trans
            top = s.max(axis=1)
            alpha[t] = np.where(mask[:, t, None], top + np.log(np.exp(s - top[:, None, :]).sum(axis=1)) + e[t], alpha[t - 1])
        top = alpha[-1].max(axis=1)
        total = top + np.log(np.exp(alpha[-1] - top[:, None]).sum(axis=1))
        rows = np.arange(n)
        gold = e[0][rows, tags[:, 0]]
        for t in range(1, t_all):
            gold = gold + np.where(mask[:, t], trans[tags[:, t - 1], tags[:, t]] + e[t][rows, tags[:, t]], 0)
        beta = np.zeros((n, TAGS))
        de, dtrans = np.zeros_like(e), np.zeros((TAGS, TAGS))
        for t in range(t_all - 1, -1, -1):
            m = mask[:, t, None]
            de[t] = np.exp(np.minimum(alpha[t] + beta - total[:, None], 0)) * m
            de[t][rows, tags[:, t]] -= mask[:, t]
            if t:
                s = trans + (e[t] + beta)[:, None, :]
                pair = np.exp(np.minimum(alpha[t - 1][:, :, None] + s - total[:, None, None], 0)) * m[:, :, None]
                dtrans += pair.sum(axis=0)
                np.add.at(dtrans, (tags[:, t - 1], tags[:, t]), -mask[:, t].astype(float))
                top = s.max(axis=2)
                beta = np.where(m, top + np.log(np.exp(s - top[:, :, None]).sum(axis=2)), beta)
        de /= n
        grads = {"trans": dtrans / n, "out": np.einsum("tnh,tnk->hk", both, de), "out_b": de.sum(axis=(0, 1))}
        dboth = de @ self.p["out"].T
        for d, memo, dh_all in (("f", mf, dboth[:, :, :self.hidden]), ("b", mb, dboth[:, :, self.hidden:])):
            w = self.p["h" + d]
            dx, dw = np.zeros_like(self.p["x" + d]), np.zeros_like(w)
            dh, dc = np.zeros((n, self.hidden)), np.zeros((n, self.hidden))
            for t, h0, c0, i, f, o, g, tanh, m in reversed(memo):
                dh = (dh + dh_all[t]) * m
                dnew = (dc + dh * o * (1 - tanh * tanh)) * m
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c0 * f * (1 - f), dh * tanh * o * (1 - o), dnew * i * (1 - g * g)], axis=1)
                np.add.at(dx, ids[:, t], dz)
                dw += h0.T @ dz
                dh, dc = dz @ w.T, dnew * f
            grads["x" + d], grads["h" + d] = dx, dw
        return float((total - gold).mean()), grads

    def fit(self, texts: list[str], tags: list[list[int]], epochs: int = EPOCHS, seed: int = 4) -> list[float]:
        r = np.random.default_rng(seed)
        ids, mask = character_ids(texts)
        gold = np.zeros(ids.shape, dtype=np.int64)
        for i, t in enumerate(tags):
            gold[i, :len(t)] = t
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        losses, step = [], 0
        for epoch in range(epochs):
            order = r.permutation(len(ids))
            rate = RATE * (1 - epoch / epochs) + 5e-4
            for lo in range(0, len(order), BATCH):
                at = order[lo:lo + BATCH]
                loss, g = self.gradients(ids[at], mask[at], gold[at])
                losses.append(loss)
                step += 1
                norm = np.sqrt(sum((x * x).sum() for x in g.values()))
                for k, x in g.items():
                    x = x * min(1.0, 5.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * x
                    v[k] = 0.99 * v[k] + 0.01 * x * x
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
        return losses

    def decode(self, texts: list[str]) -> list[list[Span]]:
        """Spans of each window by the best path of the CRF."""
        out: list[list[Span]] = []
        trans = self.p["trans"] + _allowed()
        for lo in range(0, len(texts), DECODE):
            part = texts[lo:lo + DECODE]
            ids, mask = character_ids(part)
            e = self.emissions(ids, mask)[0]
            best, back = e[0], np.zeros((WINDOW, len(part), TAGS), dtype=np.int8)
            for t in range(1, WINDOW):
                s = best[:, :, None] + trans
                back[t] = np.where(mask[:, t, None], s.argmax(axis=1), np.arange(TAGS))
                best = np.where(mask[:, t, None], s.max(axis=1) + e[t], best)
            path = np.zeros((len(part), WINDOW), dtype=np.int64)
            path[:, -1] = best.argmax(axis=1)
            for t in range(WINDOW - 1, 0, -1):
                path[:, t - 1] = back[t][np.arange(len(part)), path[:, t]]
            for text, tags in zip(part, path):
                out.append(spans_of(tags[:len(text)].tolist()))
        return out


def spans_of(tags: list[int]) -> list[Span]:
    spans, start = [], None
    for i, t in enumerate([*tags, 0]):
        if start is not None and (t == 0 or t % 2 or t // 2 - 1 != kind):  # noqa: F821
            spans.append((start, i, kind))  # noqa: F821
            start = None
        if t and start is None:
            start, kind = i, (t - 1) // 2
    return spans


def tags_of(spans: list[Span], start: int, end: int) -> list[int]:
    """Tags of the window [start, end); a span that began before it is inside at once."""
    tags = [0] * (end - start)
    for a, b, kind in spans:
        for i in range(max(a, start), min(b, end)):
            if not tags[i - start]:
                tags[i - start] = 1 + 2 * kind + (i > a)
    return tags


def _likely(text: str, kind: int) -> bool:
    digits = sum("0" <= c <= "9" for c in text)
    return "@" in text[1:-1] if kind == 0 else 4 <= digits and text.count(".") == 3 if kind == 1 else 12 <= digits <= 19 if kind == 2 else 7 <= digits <= 15


#: What may stand between the digit groups of one number, and the characters of an address.
_JOINS = frozenset(" .-/()")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+@-]")
_MOST_DIGITS = {1: 12, 2: 19, 3: 15}


def _digit(c: str) -> bool:
    return "0" <= c <= "9"


def _group(text: str, at: int, step: int) -> int:
    """Where the digits end that stand next to ``at`` in the direction of ``step``, behind at most two joining characters; ``at`` if there are none."""
    k, joins = at, 0
    while 0 <= k < len(text) and joins < 2 and text[k] in _JOINS:
        k, joins = k + step, joins + 1
    end = k
    while 0 <= end < len(text) and _digit(text[end]) and abs(end - k) < 20:
        end += step
    return end if end != k else at


def whole_token(text: str, a: int, b: int, kind: int) -> tuple[int, int]:
    """The span widened to the number or address that it is part of: no number is cut in half.

    Digits that touch the span belong to it; so do digit groups joined to it, as long as the number has no more
    digits than its kind allows, and a plus sign or a bracket before it."""
    if kind == 0:
        while a and b - a < WINDOW and _ADDRESS.match(text[a - 1]):
            a -= 1
        while b < len(text) and b - a < 2 * WINDOW and _ADDRESS.match(text[b]):
            b += 1
        return a, b - (text[b - 1] in ".%+-") if b > a else b
    for _ in range(20):
        if a and _digit(text[a - 1]) and _digit(text[a]):
            a -= 1
        if b < len(text) and _digit(text[b]) and _digit(text[b - 1]):
            b += 1
    digits = sum(map(_digit, text[a:b]))
    for step in (-1, 1):
        while True:
            edge = a - 1 if step < 0 else b
            end = _group(text, edge, step)
            more = sum(map(_digit, text[end + 1:a] if step < 0 else text[b:end])) if end != edge else 0
            if not more or digits + more > _MOST_DIGITS[kind] or kind == 1 and "." not in (text[a - 1], text[min(b, len(text) - 1)]):
                break
            digits += more
            a, b = (end + 1, b) if step < 0 else (a, end)
    while a and text[a - 1] in "+(":
        a -= 1
    return a, b


def reconciled(text: str, base: list[Span], starts: list[int], found: list[list[Span]]) -> list[Span]:
    """Base spans and, from all windows of the text, the whole numbers and addresses that fit beside them.

    Longer spans come first, of equally long ones the earlier, then the kind listed first."""
    whole = set()
    for start, spans in zip(starts, found):
        end = min(start + WINDOW, len(text))
        for a, b, kind in spans:
            a, b = a + start, b + start
            if (a == start and start) or (b == end and end < len(text)):
                continue
            while b > a and text[a].isspace():
                a += 1
            while b > a and (text[b - 1].isspace() or text[b - 1] in ".,;:"):
                b -= 1
            if b > a:
                a, b = whole_token(text, a, b, kind)
            if _likely(text[a:b], kind):
                whole.add((a, b, kind))
    kept, taken = list(base), bytearray(len(text))
    for a, b, _ in base:
        taken[a:b] = b"\1" * (b - a)
    for a, b, kind in sorted(whole, key=lambda s: (s[0] - s[1], s)):
        if taken.find(1, a, b) < 0:
            kept.append((a, b, kind))
            taken[a:b] = b"\1" * (b - a)
    return sorted(kept, key=lambda s: (s[0], s[2]))


def _marked(texts: pa.Array) -> list[int]:
    """Texts that hold a digit or an @."""
    raw, off = text_bytes(texts)
    return np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(_TRIGGER[raw])])[off])).tolist()


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in pieces(batch):
            ids = column(part, "doc_id").to_pylist()
            rows = []
            for d in _marked(texts):
                text = texts[d].as_py()
                base = sorted(base_spans(text))
                begins, reach = [a for a, _, _ in base], list(accumulate((b for _, b, _ in base), max))
                for start in _windows(text):
                    end = min(start + WINDOW, len(text))
                    # only the spans that may meet the window
                    tags = tags_of(base[bisect_right(reach, start):bisect_left(begins, end)], start, end)
                    rows.append((ids[d], start, text[start:start + WINDOW], tags, any(tags)))
            if rows:
                doc, start, window, tags, some = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(window), pa.array(tags, pa.list_(pa.int32())), pa.array(some)], names=["doc_id", "start", "window", "tags", "some"])


def varied(window: str, tags: list[int], r: np.random.Generator) -> tuple[str, list[int]]:
    """The window with other digits and letters in its spans, now and then without a phone's
    country code or with a card's digits in groups."""
    out, marks, at = [], [], 0
    for a, b, kind in [*spans_of(tags), (len(window), len(window), -1)]:
        out.append(window[at:a])
        marks += tags[at:a]
        span = "".join(str(r.integers(10)) if "0" <= c <= "9" and kind != 1 else chr(97 + r.integers(26)) if "a" <= c <= "z" and kind == 0 and r.random() < 0.5 else c for c in window[a:b])
        if kind == 3 and r.random() < 0.25:
            span = re.sub(r"^\+[0-9]+\s*", "", span)
        if kind == 3 and r.random() < 0.25:
            span = re.sub(r"[ -]", ".", span)
        if kind == 2 and r.random() < 0.3:
            span = r.choice([" ", "-"]).join(span[i:i + 4] for i in range(0, len(span), 4))
        out.append(span)
        if span:
            marks += [tags[a]] + [2 + 2 * kind] * (len(span) - 1)
        at = b
    return "".join(out)[:WINDOW], marks[:WINDOW]


def fit(docs: DataFrame, sample: int = SAMPLE, plain: int = SAMPLE_PLAIN) -> Tagger | None:
    """The network fitted on ``sample`` windows with spans and ``plain`` ones without, those with the smallest hashes."""
    tuned(docs.sparkSession)
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _examples, "doc_id long, start long, window string, tags array<int>, some boolean")
    rows = stored(rows, "windows").withColumn("h", F.xxhash64("doc_id", "start", "window"))
    chosen = [r for some, n in ((True, sample), (False, plain)) for r in rows.where(F.col("some") == some).orderBy("h", "doc_id", "start").limit(n).collect()]
    if not any(r["some"] for r in chosen):
        return None
    r = np.random.default_rng(8)
    texts, tags = [x["window"] for x in chosen], [list(x["tags"]) for x in chosen]
    with_spans = [i for i, t in enumerate(tags) if any(t)]
    while len(texts) < sample + plain or len(texts) < len(with_spans) * 1.5:  # small corpora get more copies
        window, marks = varied(texts[i := with_spans[r.integers(len(with_spans))]], tags[i], r)
        texts.append(window)
        tags.append(marks)
    tagger = Tagger()
    tagger.fit(texts, tags)
    return tagger


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def _found(texts: pa.Array, tagger: Tagger | None) -> dict[int, tuple[str, list[Span], list[Span]]]:
    """(text, base spans, all spans) of the texts that may hold any."""
    marked = {d: texts[d].as_py() for d in _marked(texts)}
    starts = {d: _windows(t) for d, t in marked.items()}
    spans = iter(tagger.decode([marked[d][s:s + WINDOW] for d in marked for s in starts[d]]) if tagger else [])
    out = {}
    for d, text in marked.items():
        base = base_spans(text)
        out[d] = (text, base, reconciled(text, base, starts[d], [next(spans) for _ in starts[d]]) if tagger else base)
    return out


def personal_data(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """One row per document: counts of the base kinds, the base spans' hash, and all spans."""
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for part, texts in pieces(batch):
                n = part.num_rows
                count, sha, spans = np.zeros((n, len(KINDS)), dtype=np.int64), [nothing] * n, [""] * n
                for d, (_, base, both) in _found(texts, tagger).items():
                    count[d] = np.bincount([k for _, _, k in base], minlength=len(KINDS))
                    sha[d], spans[d] = hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(both)
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), *(pa.array(c) for c in count.T.copy()), pa.array(sha), pa.array(spans)],
                                                 names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, " + "".join(f"n_{k} long, " for k in KINDS) + "base_sha256 string, spans string")


def masked(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; others stay byte for byte."""
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                new = None
                for d, (text, _, spans) in _found(texts, tagger).items():
                    if spans:
                        new = column(part, "text").to_pylist() if new is None else new
                        out, at = [], 0
                        for a, b, k in spans:
                            if b > at:
                                out += [text[at:a], f"[{KINDS[k]}]"] if a >= at else []
                                at = b
                        new[d] = "".join([*out, text[at:]])
                yield part if new is None else with_text(part, new)
    return docs.mapInArrow(run, docs.schema)


def op6_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal_data(docs, fit(docs))
