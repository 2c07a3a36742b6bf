"""The whole-table profile against pandas."""

import random

import numpy as np
import pandas as pd

from lakeweave.operators import profile as P


def table():
    r = random.Random(9)
    n = 3000
    return pd.DataFrame({
        "k": [r.choice(["a", "a", "a", "b", None, "", "c d"]) for _ in range(n)], "v": [r.choice([1.5, -2.0, 1e9, 0.1, float("nan"), None]) for _ in range(n)],
        "i": [7 if r.random() < 0.9 else r.randint(-50, 50) for _ in range(n)], "w": np.round(np.random.default_rng(1).normal(size=n), 3), "none": [None] * n, "odd name": [r.random() < 0.5 for _ in range(n)]})


SCHEMA = "k string, v double, i long, w double, none double, `odd name` boolean"


def test_profile_equals_pandas(spark):
    rows = table()
    data = [tuple(None if x is None or x is pd.NA else (x.item() if hasattr(x, "item") else x) for x in rec) for rec in rows.itertuples(index=False)]
    data += data[:10]
    pdf = pd.concat([rows, rows[:10]], ignore_index=True)
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    counts = P.value_counts(df)
    got = {r["column_name"]: r for r in P.whole_profile(df).collect()}
    assert {c: got[c]["missing"] for c in pdf} == {c: sum(1 for rec in data if rec[k] is None) for k, c in enumerate(pdf)}
    assert {c: got[c]["rows"] for c in pdf} == {c: len(data) for c in pdf}
    assert {c: got[c]["distinct_values"] for c in pdf} == {c: len({str(rec[k]) for rec in data if rec[k] is not None}) for k, c in enumerate(pdf)}
    want = pdf[["v", "i", "w"]].describe()
    for c in ("v", "i", "w"):
        have = [got[c][x] for x in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
        np.testing.assert_allclose(have, want[c].to_numpy(), rtol=1e-9)
    assert got["none"]["count"] is None and got["none"]["missing"] == len(data) and got["none"]["missing_pct"] == 100.0
    tops = [(r["value"], r["n"]) for r in P.top_values(counts, 2).where("column_name = 'k'").orderBy("rank").collect()]
    assert tops == list(pdf["k"].value_counts().head(2).items())
    dup = P.duplicates(df).first()
    assert (dup["rows"], dup["duplicate_rows"], dup["unique_rows"]) == (len(data), len(data) - len({tuple(map(str, x)) for x in data}), len({tuple(map(str, x)) for x in data}))


def test_nulls_in_different_places_are_different_rows(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), ("x", None)], "a string, b string")
    assert tuple(P.duplicates(df).first()) == (3, 2, 1)


def test_profile_of_an_empty_table_and_of_one_row(spark):
    df = spark.createDataFrame([(4.0,)], "x double")
    r = P.whole_profile(df).first()
    assert (r["count"], r["mean"], r["std"], r["q50"]) == (1, 4.0, None, 4.0)
    assert P.whole_profile(df.limit(0)).count() == 0 and tuple(P.duplicates(df.limit(0)).first()) == (0, 0, 0)
