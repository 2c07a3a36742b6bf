"""Operator tests on small literal frames (ties, NULLs, empty input, duplicates)."""

import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeweave.operators.dedupe import first_by_key, keep_last_rows, last_by_key
from lakeweave.operators.intervals import uptime_from_transitions
from lakeweave.operators.joins import any_join_by_priority, label_match
from lakeweave.operators.quality import (expect_accepted_values, expect_foreign_key, expect_not_empty,
                                         expect_not_null, expect_unique, ratio_round)
from lakeweave.operators.ranking import (exact_quantiles, global_row_number, qcut_bin, qcut_edges,
                                         rank_first_bin)


# ------------------------------------------------------------------ ranking / quantiles
def test_global_row_number_is_a_total_order(spark):
    rows = [(i % 7, f"k{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "v int, k string")
    got = global_row_number(df, ["v", "k"], num_partitions=5).orderBy("rn").collect()
    expect = sorted(rows)
    assert [r["rn"] for r in got] == list(range(1, 201))
    assert [(r["v"], r["k"]) for r in got] == expect


def test_global_row_number_empty(spark):
    df = spark.createDataFrame([], "v int, k string")
    assert global_row_number(df, ["v", "k"]).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_qcut_matches_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    vals = rng.integers(0, 1000, size=300).astype(float) / 7.0
    pdf = pd.DataFrame({"id": [f"c{i}" for i in range(300)], "x": vals})
    df = spark.createDataFrame(pdf)
    edges = qcut_edges(df, "x", 5, ["id"])
    expected_codes = pd.qcut(pdf["x"], 5, labels=False) + 1
    got = dict(df.select("id", qcut_bin("x", edges).alias("b")).collect())
    assert [got[i] for i in pdf["id"]] == list(expected_codes)


def test_qcut_raises_on_repeated_edges(spark):
    df = spark.createDataFrame([(f"c{i}", 1.0 if i < 80 else float(i)) for i in range(100)], "id string, x double")
    with pytest.raises(ValueError):
        qcut_edges(df, "x", 5, ["id"])


@pytest.mark.parametrize("n", list(range(5, 60)) + [97, 250, 1001])
def test_rank_first_bin_matches_pandas(spark, n):
    ranks = pd.Series(np.arange(1, n + 1), dtype=float)
    expected = list(pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int))
    df = spark.createDataFrame([(i,) for i in range(1, n + 1)], "r long")
    got = [row[0] for row in df.orderBy("r").select(rank_first_bin("r", n)).collect()]
    assert got == expected


def test_exact_quantiles_linear(spark):
    xs = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(xs)], "id string, x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, "x", probs, ["id"])
    assert got == pytest.approx(list(np.quantile(xs, probs)))


# ------------------------------------------------------------------ dedupe
def test_first_and_last_by_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None), ("b", 5, "z")],
                               "k string, o int, v string")
    first = dict(first_by_key(df, ["k"], ["v"], ["o", "v"]).collect())
    last = dict(last_by_key(df, ["k"], ["v"], ["o", "v"]).collect())
    assert first == {"a": "y", "b": None}
    assert last == {"a": "x", "b": "z"}
    assert keep_last_rows(df, ["k"], ["o"]).count() == 2


# ------------------------------------------------------------------ joins
def test_any_join_by_priority_picks_strongest_key(spark):
    left = spark.createDataFrame([(1, 10, "Bob"), (2, 20, "Ann"), (3, 30, "Zed"), (4, None, "bob")],
                                 "id int, guid int, name string")
    right = spark.createDataFrame([("bob-by-name", 99, "BOB"), ("bob-by-guid", 10, "x"), ("ann", 20, "Ann"),
                                   ("ann2", 20, "ann")], "label string, guid int, nm string")
    alts = [[(F.col("guid"), "guid")], [(F.lower(F.col("name")), F.lower(F.col("nm")))]]
    out = dict(any_join_by_priority(left, right, ["id"], alts, pick=["label"], take=["label"])
               .select("id", "label").collect())
    assert out == {1: "bob-by-guid", 2: "ann", 3: None, 4: "bob-by-name"}


def test_label_match_priority(spark):
    labels = spark.createDataFrame([("Lots of nature",), ("soft  stuff",), ("nope",)], "label string")
    themes = spark.createDataFrame([("Nature",), ("Soft Stuff",)], "theme string")
    lo = F.lower(F.col("label"))
    tail = F.regexp_extract("label", r"(?i)^lots\s+of\s+(.+)$", 1)
    cands = [lo, F.when(tail != "", F.lower(tail)), F.lower(F.regexp_replace("label", r"\s+", " "))]
    out = {r["label"]: (r["theme"], r["match_rank"]) for r in
           label_match(labels, "label", themes, "theme", cands, ["theme"]).collect()}
    assert out == {"Lots of nature": ("Nature", 2), "soft  stuff": ("Soft Stuff", 3), "nope": (None, None)}


# ------------------------------------------------------------------ uptime
def _fold(transitions, start, end):
    acc_sum, acc_state, acc_ts = 0, 0, start
    for ts, st in sorted(transitions) + [(end, 0)]:
        acc_sum += max(ts - acc_ts, 0) if acc_state == 1 else 0
        acc_state, acc_ts = st, ts
    return acc_sum


def test_uptime_equals_array_fold(spark):
    rnd = random.Random(7)
    rows, expected = [], {}
    for g in range(300):
        start, end = 1000, 1000 + rnd.randint(0, 5000)
        tr = [(rnd.randint(500, 7000), rnd.randint(0, 1)) for _ in range(rnd.randint(1, 8))]
        expected[g] = _fold(tr, start, end)
        rows += [(g, ts, st, start, end) for ts, st in tr]
    df = spark.createDataFrame(rows, "g int, ts long, state int, start_ts long, end_ts long")
    got = dict(uptime_from_transitions(df, ["g"]).select("g", "uptime").collect())
    assert got == expected
    assert all(v <= 7000 for v in got.values())


# ------------------------------------------------------------------ quality
def test_ratio_round_is_exact_half_up(spark):
    pairs = [(n, d) for d in (1, 2, 3, 7, 8, 40, 400, 2000) for n in range(0, 3 * d, max(1, d // 7))]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", ratio_round("n", "d", 2).alias("r")).collect()
    for r in got:
        q = Fraction(r["n"], r["d"]) * 100
        expect = (q * 2 + 1) // 2 / Fraction(100)
        assert r["r"] == pytest.approx(float(expect), abs=1e-12)


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "zz")], "k int, v string")
    nn = {r["column_name"]: r["failures"] for r in expect_not_null(df, ["k", "v"]).collect()}
    assert nn == {"k": 0, "v": 1}
    assert expect_unique(df, ["k"]).first()["failures"] == 1
    assert expect_accepted_values(df, "v", ["a"]).first()["failures"] == 1
    assert expect_not_empty(df.limit(0)).first()["failures"] == 1
    parent = spark.createDataFrame([(1,)], "k int")
    assert expect_foreign_key(df, parent, ["k"]).first()["failures"] == 1
