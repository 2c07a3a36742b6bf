"""Time covered by at least one of several sources, against a millisecond by millisecond count."""

import random

from lakeweave.operators.intervals import covered_time


def plain(rows, end):
    """rows of one group: (source, ts, state) -> (covered, most)."""
    by_source = {}
    for source, ts, state in rows:
        by_source.setdefault(source, []).append((ts, state))
    def on(t):
        n = 0
        for steps in by_source.values():
            past = [s for s in sorted(steps) if s[0] <= t]
            n += bool(past and past[-1][1])
        return n
    first = min(ts for _, ts, _ in rows)
    return sum(on(t) > 0 for t in range(first, end)), max(on(ts) for _, ts, _ in rows)


def test_covered_time_of_overlapping_sources(spark):
    r = random.Random(4)
    end, rows = 60, []
    for group in range(40):
        rows += [(group, r.choice([None, 1, 2, 3]), r.randint(0, end), r.choice([0, 1, 1]), end, f"n{r.randint(1, 3)}") for _ in range(r.randint(1, 14))]
    df = spark.createDataFrame(rows, "g int, src int, ts long, state int, end_ts long, label string")
    got = {x["g"]: (x["covered"], x["most"], x["label"]) for x in covered_time(df, ["g"], "src", carry=["label"]).collect()}
    want = {g: (*plain([(s, t, st) for k, s, t, st, *_ in rows if k == g], end), min(x[5] for x in rows if x[0] == g)) for g in range(40)}
    assert got == want


def test_refreshes_and_removals_without_application(spark):
    rows = [(1, 7, 10, 1), (1, 7, 12, 1), (1, 8, 15, 1), (1, 7, 20, 0), (1, 7, 21, 0), (1, 8, 30, 0), (2, 7, 5, 0), (3, 7, 5, 0), (3, 7, 5, 1)]
    df = spark.createDataFrame([(*x, 40) for x in rows], "g int, src int, ts long, state int, end_ts long")
    got = {x["g"]: (x["covered"], x["most"]) for x in covered_time(df, ["g"], "src").collect()}
    assert got == {1: (20, 2), 2: (0, 0), 3: (35, 1)}   # a removal and an application in one moment: the aura stays
