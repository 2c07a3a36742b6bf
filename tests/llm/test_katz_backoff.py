"""The Katz model against a plain one in memory."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import katz

DOCS = "doc_id long, text string, trained boolean, block long, kind int, `row` long, words string, n_tokens long, bucket int, score double"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "</s>"]


class Plain:
    """Counts in dictionaries, probabilities by the definition."""

    def __init__(self, texts):
        seqs = [tokens(t) for t in texts]
        self.c1 = Counter(w for s in seqs for w in s)
        self.c2 = Counter(p for s in seqs for p in zip(["<s>", *s], s))
        self.after = defaultdict(list)
        for h, w in self.c2:
            self.after[h].append(w)
        tally = lambda c: [sum(1 for x in c.values() if x == r) for r in range(katz.K + 2)]
        self.d1, self.d2 = katz.discounts(tally(self.c1)), katz.discounts(tally(self.c2))
        self.n = sum(self.c1.values())
        self.taken = sum((1 - self.cut(self.d1, c)) * c for c in self.c1.values())
        self.memo = {}

    @staticmethod
    def cut(d, c):
        return d[c] if c <= katz.K else 1.0

    def one(self, w):
        total = self.n if self.taken > 0 else self.n + 1
        return self.cut(self.d1, self.c1[w]) * self.c1[w] / total if self.c1[w] else (self.taken or 1.0) / total

    def context(self, h):
        if h not in self.memo:
            counts = [self.c2[h, w] for w in self.after[h]]
            mass, total = sum((1 - self.cut(self.d2, c)) * c for c in counts), sum(counts)
            total, mass = (total, mass) if mass > 0 else (total + 1, 1)
            self.memo[h] = total, mass / total / (1 - sum(self.one(w) for w in self.after[h]))
        return self.memo[h]

    def p(self, h, w):
        if not self.after.get(h):
            return self.one(w)
        total, backoff = self.context(h)
        c = self.c2.get((h, w), 0)
        return self.cut(self.d2, c) * c / total if c else backoff * self.one(w)

    def score(self, text):
        s = tokens(text)
        base = sum(math.log10((self.c1.get(w, 0) + 1) / (self.n + len(self.c1) + 1)) for w in s)
        return len(s), sum(w in self.c1 for w in s), base, sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *s], s))


def corpus(copies):
    r = random.Random(2)
    voc = [f"w{int(r.paretovariate(0.7))}" for _ in range(4000)] + ["The", "the", "Étude", "日本"]
    texts = [" ".join(r.choice(voc) for _ in range(r.randint(0, 60))) for _ in range(400)]
    texts += [None, "", " \t\n", "the the THE", "never seen words here", "new the new", "the", " ".join(r.choice(voc) for _ in range(4000))]
    texts += [texts[3]] * copies
    return texts


@pytest.mark.parametrize("copies, block_bytes, hot_share", [(0, 6 << 20, 1000), (0, 3000, 10), (300, 5000, 30), (2000, 20_000, 3)])
def test_scores_are_those_of_the_plain_model(spark, copies, block_bytes, hot_share):
    texts = corpus(copies)
    rows = [(i if i % 50 else None, t, None if i % 11 == 0 else i % 3 != 0, 1, 2, 3, "w", 4, 5, 0.5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    model = katz.fit(docs, F.col("trained"), block_bytes, 500, hot_share)
    plain = Plain([t for _, t, trained, *_ in rows if trained is not False])
    got = katz.scores(model).collect()
    assert {r["train_tokens"] for r in got} == {plain.n}
    key = lambda x: (x[0] is None, x[0] or 0, x[1], *(round(v, 4) for v in x[2:]))
    have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got), key=key)
    want = sorted(((i, trained is False, *plain.score(t)) for i, t, trained, *_ in rows), key=key)
    assert [x[:4] for x in have] == [x[:4] for x in want]
    np.testing.assert_allclose([x[4:] for x in have], [x[4:] for x in want], rtol=1e-9)
    if copies == 300:  # the stored tables are the counts, and every context's probabilities sum to one
        assert sorted(r["count"] for r in katz.unigrams(model).collect()) == sorted(plain.c1.values())
        assert sorted(r["count"] for r in katz.bigrams(model).collect()) == sorted(plain.c2.values())
    for h in ["<s>", "the", "w1", "never", *list(plain.after)[:40]]:
        assert abs(sum(plain.p(h, w) for w in plain.c1) + plain.p(h, "unknown word") - 1) < 1e-9


def test_pairs_tables_hold_every_pair_once(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus(50))], "doc_id long, text string").repartition(4)
    model = katz.fit(docs, F.lit(True), 4000, 400, 20)
    assert katz.bigrams(model).groupBy("context", "word").count().where("count > 1").count() == 0
    assert model.pairs.where("kind = 3").count() > 0


def test_discounts_are_good_turings_or_half_a_count():
    d = katz.discounts([0, 1000, 300, 120, 60, 35, 20, 9])
    a = 6 * 20 / 1000
    assert d[0] == 1 and abs(d[1] - (2 * 300 / 1000 - a) / (1 - a)) < 1e-12 and all(0 < x < 1 for x in d[1:])
    assert katz.discounts([0, 10, 0, 5, 0, 0, 0, 0])[1:].tolist() == [0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9]
    short = katz.discounts([0, 1000, 300, 120, 600, 35, 20, 9])
    assert short[3:].tolist() == [1, 1, 1] and 0 < short[2] < 1


def test_numbers_survive_packing():
    for x in (np.array([], dtype=np.int64), np.zeros(5, np.int64), np.array([0, 255, 256, 2**40]), np.array([2**64 - 1, 1], dtype=np.uint64)):
        assert katz.unpack(katz.pack(x), len(x)).view(np.uint64).tolist() == x.tolist()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in katz.scores(katz.fit(docs, F.lit(False))).collect()}
    assert {(i, r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"], r["held_out"]) for i, r in got.items()} == {
        (1, 3, 0, 0, 0.0, 0.0, True), (2, 1, 0, 0, 0.0, 0.0, True), (3, 1, 0, 0, 0.0, 0.0, True)}
    assert katz.scores(katz.fit(docs.limit(0), F.lit(True))).count() == 0
