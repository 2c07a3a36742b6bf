"""Quality rules with the perplexity of a modified Kneser-Ney n-gram model.

The model is over characters folded to 64 symbols: a to z, one each for capitals, digits,
punctuation, other signs and the gap between words, and 32 for the code points from U+0080, by
their last five bits.  In the alphabets of Latin-1, Greek and Cyrillic these bits tell the letters of
one case apart and are the same for both cases; in larger scripts several characters share a symbol.
The model has runs of ``ORDER`` symbols, one model a language.  Spark counts the runs of all
documents, and derives from the counts the continuation counts of the lower orders and
the three discounts of each order.  A model is stored as sorted arrays of run codes with
these counts.  A text is scored under the counts without its own runs and those of the texts
equal to it (counts and continuation counts of all orders and contexts; the discounts stay
those of all texts), so a group of copies doesn't teach the model itself.  The model grows
with the different runs of the corpus, so it is not held whole: a pass scores as many languages as stay under ``MODEL_ENTRIES``, and a
language beyond that is dealt by the two symbols before the last, which a run shares with
all it backs off to; runs of up to three symbols are in every share.  A document's log
probability is the sum over the passes.

A document is rejected when its log perplexity leaves its language's band.  Its distance
from the median of all the language's documents that have ``BAND_WORDS`` words or more and
pass the base rules (the others are rejected without a band) counts in
spreads s(n) = sqrt(q**2 + NOISE**2 / n), q the distance of the quartiles and n the document's
symbols (a mean over few symbols strays more); the band ends at ``REACH`` times the first and the
last decile of these distances, counted over the same documents.  So it is no quota: where the
distances fall off as a normal distribution's do, 1 document in 10 000 lies outside, and up to a
tenth of a language's documents on either side may be far off without moving its band.

Defined cases: null text has no words and fails the base rules; null languages are one
language; a language without documents long enough has no band and rejects none;
repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import column, sized, stored, table, tuned
from .words import SPACE, Words, byte_hashes, pieces, mix, text_bytes

ORDER = 5
BITS = 6
#: Entries (about 20 bytes each) of the models that are scored at once.
MODEL_ENTRIES = 6_000_000
#: Different runs that a counting task holds before it hands them on.
HELD_RUNS = 2_000_000
BATCH_ROWS = 100_000
#: Values of the two symbols that deal the runs of a large language.
SHARES = 1 << 2 * BITS
LEAST_WORDS = 20
MAX_REPEATED = 30
WINDOW = 8
BAND_WORDS = 50
#: Ends of a band, as multiples of the outer deciles of the distances; a decile counts as ``LEAST_DECILE`` spreads at least.
REACH = 3.0
LEAST_DECILE = 0.5
#: Spread of one symbol's log probability, least distance of quartiles, and steps in which quartiles are counted.
NOISE = 1.0
LEAST_WIDTH = 0.02
STEP = 0.001

RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity"]

_FOLD = np.full(256, 30, dtype=np.uint8)          # other signs
_FOLD[[0x20, *range(0x09, 0x0E)]] = 0              # gap
_FOLD[0x61:0x7B] = np.arange(1, 27)                # a-z
_FOLD[0x41:0x5B] = 27                              # A-Z
_FOLD[0x30:0x3A] = 28                              # digits
_FOLD[[ord(c) for c in ".,;:!?'\"()-"]] = 29       # punctuation
_FOLD[0x80:] = 32 + (np.arange(0x80, 0x100) & 31)  # others: the last byte holds the last bits of the code point
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[ord(c) for c in "#*$%&|<>"]] = True


def codes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, n + 1 offsets): each text's runs of ORDER symbols, one ending at every symbol.

    White space of any length is one gap; each text begins after gaps."""
    white = ~SPACE[raw]
    # a character counts at its last byte
    keep = np.ones(len(raw), dtype=bool)
    keep[:-1] = (raw[1:] & 0xC0) != 0x80
    again = white.copy()
    again[1:] &= white[:-1]
    again[:1] = False
    heads = off[:-1][off[:-1] < off[1:]]
    again[heads] = False
    keep &= ~again
    first = np.concatenate([[0], np.cumsum(keep)])[off]
    # gaps before each text: symbols move right by ORDER - 1 for every text begun
    pad = ORDER - 1
    symbols = np.zeros(first[-1] + pad * (len(off) - 1) + pad, dtype=np.int32)
    where = np.arange(first[-1]) + np.repeat((np.arange(len(off) - 1) + 1) * pad, np.diff(first))
    symbols[where] = _FOLD[raw[keep]]
    code = symbols.copy()
    for k in range(1, ORDER):
        code[k:] |= symbols[:-k] << (BITS * k)
    return code[where], first


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several (runs, counts) as one, each run once."""
    code, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])[:len(code)])
    return code[first], np.add.reduceat(n, first) if len(first) else n


def _counts(held_runs: int = HELD_RUNS):
    """(lang, run, n): runs of each language, summed over what a task holds at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                code, n = _merged(parts)
                for at in range(0, len(code), BATCH_ROWS):
                    some = code[at:at + BATCH_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(some)), pa.array(some), pa.array(n[at:at + BATCH_ROWS])], names=["lang", "run", "n"])

        for batch in batches:
            for part, texts in pieces(batch):
                for lang, code, _, _ in _by_language(part, texts):
                    found, n = np.unique(code, return_counts=True)
                    held.setdefault(lang, []).append((found, n))
                    size += len(found)
                if size > held_runs:
                    for lang, parts in held.items():
                        held[lang] = [_merged(parts)]
                    size = sum(len(parts[0][0]) for parts in held.values())
                    if 2 * size > held_runs:
                        yield from out()
                        held.clear()
                        size = 0
        yield from out()
    return run


def _by_language(part: pa.RecordBatch, texts: pa.Array) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(language, codes, offsets, rows) of the piece's texts of each language."""
    langs = np.array(column(part, "lang").to_pylist(), dtype=object)
    for lang in sorted(set(langs)):
        rows = np.flatnonzero(langs == lang)
        chosen = texts.take(pa.array(rows)) if len(rows) < len(langs) else texts
        code, first = codes(*text_bytes(chosen))
        yield lang, code, first, rows


def estimate(docs: DataFrame) -> DataFrame:
    """(lang, order, kind, run, n, raw, value): kind 0 runs with their count (below ORDER: in how many runs they
    are continued) and how often they stand in the texts, kind 1 the discounts 1 to 3 of an order."""
    texts = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counts = texts.mapInArrow(_counts(), "lang string, run int, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    levels = {ORDER: stored(counts, "runs").withColumn("raw", F.col("n"))}
    for order in range(ORDER - 1, 0, -1):
        # a lower order counts in how many different runs it is continued
        short = (F.col("run").bitwiseAND((1 << BITS * order) - 1)).alias("run")
        levels[order] = levels[order + 1].groupBy("lang", short).agg(F.count(F.lit(1)).alias("n"), F.sum("raw").alias("raw"))
    runs = None
    for order, level in levels.items():
        some = level.select("lang", F.lit(order).alias("order"), F.lit(0).alias("kind"), "run", "n", "raw", F.lit(None).cast("double").alias("value"))
        runs = some if runs is None else runs.unionByName(some)
    runs = stored(runs, "levels")
    of = lambda k: F.sum(F.when(F.col("n") == k, 1).otherwise(0)).cast("double")
    d = runs.groupBy("lang", "order").agg(*(of(k).alias(f"n{k}") for k in (1, 2, 3, 4)))
    y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
    step = lambda k: F.greatest(F.lit(0.1), F.least(F.lit(float(k)), F.when(F.col(f"n{k}") > 0, k - (k + 1) * y * F.col(f"n{k + 1}") / F.greatest(F.col(f"n{k}"), F.lit(1.0))).otherwise(0.5)))
    none = F.lit(None).cast("long")
    d = d.select("lang", "order", F.explode(F.array(*(F.struct(F.lit(k).alias("run"), step(k).alias("value")) for k in (1, 2, 3)))).alias("d"))
    return stored(runs.unionByName(d.select("lang", "order", F.lit(1).alias("kind"), "d.run", none.alias("n"), none.alias("raw"), "d.value")), "model")


class Model:
    """One language: by order the sorted runs with their counts and places, their contexts, and three discounts."""

    def __init__(self, runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], discounts: dict[int, np.ndarray]):
        # the shares of a pass may have no runs of an order
        none = (np.full(1, -1, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64))
        self.runs = {order: runs.get(order, none) for order in range(1, ORDER + 1)}
        self.discounts = {order: np.concatenate([[0.0], d]) for order, d in discounts.items()}
        self.contexts = {}
        for order, (run, n, _) in self.runs.items():
            # sorted runs: those of a context stand side by side
            context = run >> BITS
            first = np.flatnonzero(np.diff(context, prepend=-2))
            bins = [np.add.reduceat(x, first, dtype=np.int8) for x in (n == 1, n == 2, n > 2)]
            self.contexts[order] = (context[first], np.add.reduceat(n, first), np.array(bins))

    @staticmethod
    def _at(keys: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, run), len(keys) - 1)
        return keys[at] == run, at

    def _probability(self, key: np.ndarray, own: np.ndarray, copies: np.ndarray, gone: np.ndarray | None, order: int) -> np.ndarray:
        """Probability of the last symbol of every (text, run) in ``key``, which is sorted and has each once.

        own: how often the run stands in the text; copies: texts equal to it; gone: how many of the runs that
        continue it stand in no other text (None: the highest order)."""
        if not len(key):
            return np.zeros(0)
        run = (key & ((1 << BITS * order) - 1)).astype(np.int32)
        keys, counts, raws = self.runs[order]
        known, at = self._at(keys, run)
        n = np.where(known, counts[at], 0)
        mine = copies * own
        left = np.maximum(n - (mine if gone is None else gone), 0)
        if order > 1:
            alone = known & (raws[at] <= mine)
            short = (key >> BITS * order << BITS * (order - 1)) | (key & ((1 << BITS * (order - 1)) - 1))
            below, to = np.unique(short, return_inverse=True)
            heads = np.zeros(len(below), dtype=np.int64)
            heads[to] = copies
            lower = self._probability(below, np.bincount(to, own, len(below)).astype(np.int64), heads, np.bincount(to, alone, len(below)).astype(np.int64), order - 1)[to]
        else:
            lower = np.full(len(key), 1.0 / (1 << BITS))
        # the runs of a context of a text stand side by side
        first = np.flatnonzero(np.diff(key >> BITS, prepend=-1))
        size = np.diff(first, append=len(key))
        keys, totals, bins = self.contexts[order]
        seen, at = self._at(keys, run[first] >> BITS)
        total = np.where(seen, totals[at], 0) - np.add.reduceat(n - left, first)
        d = self.discounts[order]
        before, after = np.minimum(n, 3), np.minimum(left, 3)
        mass = np.where(seen, d[1:] @ bins[:, at], 0.0) + np.add.reduceat(d[after] - d[before], first)
        total, mass = np.repeat(total, size), np.repeat(mass, size)
        return np.where(total > 0, (left - d[after] + mass * lower) / np.maximum(total, 1), lower)

    def log_probability(self, run: np.ndarray) -> np.ndarray:
        """Log probability of each run's last symbol after the others, under the counts of all texts."""
        key, at = np.unique(run.astype(np.int64), return_inverse=True)
        none = np.zeros(len(key), dtype=np.int64)
        return np.log(self._probability(key, none, none, None, ORDER))[at]

    def score(self, code: np.ndarray, first: np.ndarray, copies: np.ndarray, shares: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each text (its runs lie between two offsets of ``first``) under the counts of the texts
        that are not equal to it; the runs outside the shares add 0."""
        n = len(first) - 1
        key, own = np.unique(np.repeat(np.arange(n, dtype=np.int64) << BITS * ORDER, np.diff(first)) | code, return_counts=True)
        text = key >> BITS * ORDER
        p = self._probability(key, own, copies[text], None, ORDER)
        log = own * np.log(p)
        if shares is not None:
            log *= shares[(key >> BITS) & (SHARES - 1)]
        return np.bincount(text, log, n)


@lru_cache(maxsize=1)
def _models(packed: tuple) -> dict[str, Model]:
    runs: dict[str, dict] = {}
    discounts: dict[str, dict] = {}
    for lang, order, kind, *arrays in packed:
        if kind == 0:
            runs.setdefault(lang, {})[order] = tuple(np.frombuffer(a, t) for a, t in zip(arrays, (np.int32, np.int64, np.int64)))
        else:
            discounts.setdefault(lang, {})[order] = np.frombuffer(arrays[0], np.float64)
    return {lang: Model(of, discounts[lang]) for lang, of in runs.items()}


def _share() -> Column:
    """The two symbols before the last of a run."""
    return F.shiftright("run", BITS).bitwiseAND(SHARES - 1)


def _packed(model: DataFrame, units: dict[str, list[int] | None] | None = None) -> list[tuple]:
    """The model's arrays by language, order and kind; of the languages (None: all of them) in
    ``units`` and the shares given there (None: all).  ``passes`` bounds what that comes to."""
    if units is not None:
        whole = [lang for lang, shares in units.items() if shares is None]
        chosen: Column = F.col("lang").isin(whole)
        for lang, shares in units.items():
            if shares is not None:
                # runs of up to three symbols and the discounts belong to every share
                chosen = chosen | ((F.col("lang") == lang) & ((F.col("order") < 4) | (F.col("kind") == 1) | _share().isin(shares)))
        model = model.where(chosen)
    rows = model.select("lang", (F.col("order") * 2 + F.col("kind")).cast("int").alias("slot"), "run", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("value", F.lit(0.0)).alias("value")).toArrow()
    rows = rows.combine_chunks()
    lang = rows["lang"].combine_chunks().dictionary_encode()
    slot, run, n, raw, value = (rows[c].to_numpy() for c in ("slot", "run", "n", "raw", "value"))
    out = []
    for code, name in enumerate(lang.dictionary.to_pylist()):
        of_lang = lang.indices.to_numpy() == code
        for s in np.unique(slot[of_lang]).tolist():
            at = np.flatnonzero(of_lang & (slot == s))
            at = at[np.argsort(run[at])]
            out.append((name, s // 2, s % 2, *((value[at].tobytes(),) if s % 2 else (run[at].astype(np.int32).tobytes(), n[at].tobytes(), raw[at].tobytes()))))
    return sorted(out, key=lambda x: x[:3])


def passes(model: DataFrame, entries: int = MODEL_ENTRIES, most: int = MODEL_ENTRIES) -> list[dict[str, list[int] | None]]:
    """The languages, or shares of a language of over ``most`` entries, that each pass scores.

    A pass stays under ``entries`` unless one language (under ``most``) or one share (under 64**3
    runs of five, and all of up to three symbols) is larger."""
    sizes = sorted((r["lang"], r["n"]) for r in model.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).toLocalIterator())
    large = [lang for lang, n in sizes if n > most]
    units: list[tuple[str, list[int] | None, int]] = [(lang, None, n) for lang, n in sizes if n <= most]
    for lang in large:
        counted = model.where((F.col("lang") == lang) & (F.col("kind") == 0) & (F.col("order") > 3)).groupBy(_share().alias("share")).agg(F.count(F.lit(1)).alias("n"))
        held = {r["share"]: r["n"] for r in counted.collect()}
        shares: list[int] = []
        total = 0
        # all shares are dealt: a run of another text may be in one that the model has nothing in
        for share in range(SHARES):
            if shares and total + held.get(share, 0) > most:
                units.append((lang, shares, total))
                shares, total = [], 0
            shares.append(share)
            total += held.get(share, 0)
        units.append((lang, shares, total))
    out: list[dict[str, list[int] | None]] = [{}]
    room = entries
    for lang, shares, n in units:
        if out[-1] and (n > room or lang in out[-1]):
            out.append({})
            room = entries
        out[-1][lang] = shares
        room -= n
    return out


def describe(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base measures of each text."""
    words = Words(texts)
    raw, off, n = words.raw, words.off, len(texts)
    per = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[off])
    lead = (raw & 0xC0) != 0x80
    # lines: cut at line feeds and at texts' ends
    stop = np.flatnonzero(raw == 0x0A)
    begin = np.unique(np.concatenate([off[:-1], stop + 1]))
    begin = begin[begin < len(raw)]
    line_of = np.searchsorted(off, begin, side="right") - 1
    end = np.minimum(stop[np.minimum(np.searchsorted(stop, begin), max(len(stop) - 1, 0))] if len(stop) else off[line_of + 1], off[line_of + 1])
    end = np.where(end < begin, off[line_of + 1], end)
    with_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, begin)
    begin, end, line_of = begin[with_word], end[with_word], line_of[with_word]
    h = byte_hashes(raw, begin, end)
    order = np.lexsort((h, line_of))
    same = (line_of[order][1:] == line_of[order][:-1]) & (h[order][1:] == h[order][:-1])
    dup = np.bincount(line_of[order][1:][same], minlength=n)
    # windows found twice or more cover words
    at, runs = words.runs(WINDOW)
    owner = words.doc[at]
    key = mix(runs + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
    return {
        "n_words": words.count.astype(np.int64), "word_chars": per(lead & SPACE[raw]).astype(np.int64), "n_symbols": per(_SIGN[raw]).astype(np.int64),
        "n_dup_lines": dup.astype(np.int64), "n_repeat_words": np.diff(covered[words.first]).astype(np.int64)}


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _score(packed: list[tuple], units: dict[str, list[int] | None], first: bool):
    """A pass over the documents: the log probability under the models here, and (in the first pass) the base measures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = _models(tuple(packed))
        masks: dict[str, np.ndarray | None] = {}
        for lang, shares in units.items():
            masks[lang] = None if shares is None else np.isin(np.arange(SHARES), shares)
        for batch in batches:
            for part, texts in pieces(batch):
                copies = column(part, "copies").to_numpy()
                surprise, symbols = np.zeros(part.num_rows), np.zeros(part.num_rows, dtype=np.int64)
                for lang, code, begin, rows in _by_language(part, texts):
                    symbols[rows] = np.diff(begin)
                    if lang in models:
                        surprise[rows] = -models[lang].score(code, begin, copies[rows], masks[lang])
                if first:
                    d = describe(texts)
                    measures = [*(pa.array(d[m]) for m in MEASURES), pa.array(symbols)]
                else:
                    measures = [pa.nulls(part.num_rows, pa.int64())] * (len(MEASURES) + 1)
                yield pa.RecordBatch.from_arrays(
                    [column(part, "row"), column(part, "doc_id"), column(part, "lang"), *measures, pa.array(surprise)],
                    names=["row", "doc_id", "lang", *MEASURES, "symbols", "surprise"])
    return run


def _with_copies(texts: DataFrame) -> DataFrame:
    """The texts with the number of equal ones of their language (by two hashes), themselves included."""
    texts = texts.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), "text"))
    more = stored(texts.groupBy("lang", "h1", "h2").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1), "copies")
    return texts.join(sized(more, 64), ["lang", "h1", "h2"], "left").withColumn("copies", F.coalesce("copies", F.lit(1).cast("long"))).drop("h1", "h2")


def measured(docs: DataFrame, model: DataFrame, entries: int = MODEL_ENTRIES, most: int = MODEL_ENTRIES) -> DataFrame:
    """One stored row per document: the base measures and the log perplexity under its language's model,
    without the runs of the texts equal to it."""
    texts = docs.select(F.lit(None).cast("long").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "row long, doc_id long, lang string, " + "".join(f"{m} long, " for m in MEASURES) + "symbols long, surprise double"
    texts = _with_copies(texts)
    plan = passes(model, entries, most)
    if len(plan) > 1:  # rows need a name by which their passes are summed
        texts = stored(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
    parts = []
    for k, units in enumerate(plan):
        mine = texts if k == 0 else texts.where(F.col("lang").isin(list(units)))
        parts.append(stored(mine.mapInArrow(_score(_packed(model, units), units, k == 0), schema), "measured"))
    out = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            out = out.unionByName(p)
        out = stored(out.groupBy("row").agg(*(F.max(c).alias(c) for c in ("doc_id", "lang", *MEASURES, "symbols")), F.sum("surprise").alias("surprise")), "measured")
    return out.withColumn("log_perplexity", F.when(F.col("symbols") > 0, F.col("surprise") / F.col("symbols")).otherwise(0.0)).drop("row", "surprise")


def _quantiles(values: DataFrame, value: Column, at: dict[str, float]) -> DataFrame:
    """(lang, one column a quantile): exact quantiles in steps of STEP, from counts of all rows."""
    steps = values.groupBy("lang", F.floor(value / STEP).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    seen = steps.withColumn("upto", F.sum("n").over(Window.partitionBy("lang").orderBy("step"))).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    return seen.groupBy("lang").agg(*((F.min(F.when(F.col("upto") >= F.lit(q) * F.col("all"), F.col("step"))) * STEP).alias(name) for name, q in at.items()))


def _failed() -> Column:
    """Too few words, or too many in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _spread() -> Column:
    return F.sqrt(F.col("width") * F.col("width") + F.lit(NOISE ** 2) / F.greatest(F.col("symbols"), F.lit(1)))


def bands(scores: DataFrame, band_words: int = BAND_WORDS, reach: float = REACH) -> DataFrame:
    """(lang, mid, width, low, high): median and distance of quartiles of the log perplexity, and ``reach`` times the outer
    deciles of its distance from the median in spreads, over all documents long enough that pass the base rules."""
    long = scores.where((F.col("n_words") >= band_words) & ~_failed())
    middle = stored(_quantiles(long, F.col("log_perplexity"), {"mid": 0.5, "q1": 0.25, "q3": 0.75}).select(
        "lang", "mid", F.greatest(F.lit(LEAST_WIDTH), F.col("q3") - F.col("q1")).alias("width")), "middle")
    away = long.join(sized(middle, 100), "lang")
    ends = _quantiles(away, (F.col("log_perplexity") - F.col("mid")) / _spread(), {"low": 0.1, "high": 0.9})
    # the values of a step lie up to one step above it
    least = F.lit(LEAST_DECILE)
    return middle.join(ends, "lang").withColumn("low", reach * F.least(F.col("low"), -least)).withColumn("high", reach * F.greatest(F.col("high") + STEP, least))


def quality_rules(docs: DataFrame, reach: float = REACH, band_words: int = BAND_WORDS) -> DataFrame:
    """One row per document: the base measures, whether it fails the base rules, whether it is kept, and its log perplexity."""
    tuned(docs.sparkSession)
    scores = measured(docs, estimate(docs))
    limits = stored(bands(scores, band_words, reach), "bands")
    away = (F.col("log_perplexity") - F.col("mid")) / _spread()
    inside = F.coalesce(away.between(F.col("low"), F.col("high")), F.lit(True))
    return scores.join(sized(limits, 100), "lang", "left").withColumn("base_failed", _failed()).withColumn("kept", ~_failed() & inside).select(*RESULT)


def op3_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
