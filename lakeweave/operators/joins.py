"""Joins Spark cannot express efficiently as written in the reference.

``any_join_by_priority`` (J7): a LEFT join whose condition is an OR of several
key equalities, keeping at most one right row per left row.  Written as an OR
it becomes a nested-loop join; here each side is exploded into one row per
alternative key (tagged with its priority), the two are equi-joined once on
(priority, key), the candidates are reduced per left row with ``min_by`` (a
partial aggregate), then joined back on the left row id.

``label_match`` (J13): candidate keys derived from a label in priority order,
exploded, equi-joined to the dictionary, best candidate per label kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(parts: list) -> Column:
    """One string key per alternative; NULL if any component is NULL (no match)."""
    strs = [p.cast("string") for p in parts]
    if len(strs) == 1:
        return strs[0]
    out = [strs[0]]
    for p in strs[1:]:
        out += [F.lit("\u0001"), p]
    return F.concat(*out)


def _exploded(df: DataFrame, columns: list, keys: list) -> DataFrame:
    """One row per alternative whose key is not NULL: (columns, _prio, _k)."""
    rows = F.explode(F.array(*[F.struct(F.lit(prio).alias("_prio"), k.alias("_k")) for prio, k in enumerate(keys, start=1)]))
    return df.select(*columns, rows.alias("_x")).select(*columns, "_x._prio", "_x._k").filter(F.col("_k").isNotNull())


def left_keys(left: DataFrame, columns: list, alternatives: list) -> DataFrame:
    """The keys by which left rows look for a match, by alternative."""
    keys = []
    for alt in alternatives:
        k = _key([item[0] for item in alt if isinstance(item, tuple)])
        for cond in (item for item in alt if isinstance(item, Column)):
            k = F.when(cond, k)
        keys.append(k)
    return _exploded(left, columns, keys)


def right_keys(right: DataFrame, columns: list, alternatives: list) -> DataFrame:
    """The keys by which right rows are found, by alternative."""
    keys = [_key([F.col(item[1]) if isinstance(item[1], str) else item[1] for item in alt if isinstance(item, tuple)]) for alt in alternatives]
    return _exploded(right, columns, keys)


def any_join_by_priority(left: DataFrame, right: DataFrame, left_id: list,
                         alternatives: list, pick: list, take: list,
                         prefix: str = "") -> DataFrame:
    """LEFT join ``right`` columns ``take`` onto ``left`` through the first matching alternative.

    alternatives: list of lists of (left Column, right Column|name) equalities,
    in priority order (first = strongest); an extra ``Column`` item is a
    condition on the left row for that alternative.
    pick: right columns breaking ties inside one priority (smallest wins).

    Plan: both sides are exploded into (alternative, key) rows and joined once
    on that pair (one equi-join instead of one join per alternative); the best
    candidate per left row is a ``min_by`` partial aggregate.
    """
    right_cols = list(dict.fromkeys([*take, *pick]))     # ordered, unique
    lx = left_keys(left, left_id, alternatives)
    rx = right_keys(right, right_cols, alternatives)
    cand = lx.join(rx, ["_prio", "_k"])
    best = (cand.groupBy(*left_id)
                .agg(F.min_by(F.struct(*take), F.struct("_prio", *pick)).alias("_best"))
                .select(*left_id, *[F.col("_best")[c].alias(prefix + c) for c in take]))
    return left.join(best, left_id, "left")


def label_match(labels: DataFrame, label_col: str, dictionary: DataFrame, dict_key: str,
                candidates: list, take: list) -> DataFrame:
    """Best dictionary row per label; ``candidates`` = key expressions in priority order."""
    cands = F.array(*[F.struct(F.lit(i + 1).alias("prio"), c.alias("key"))
                      for i, c in enumerate(candidates)])
    ex = (labels.select(label_col, F.explode(cands).alias("_c"))
                .select(label_col, F.col("_c.prio").alias("_prio"), F.col("_c.key").alias("_key"))
                .filter(F.col("_key").isNotNull() & (F.col("_key") != "")))
    d = dictionary.select(F.lower(F.col(dict_key)).alias("_key"), *take)
    m = ex.join(d, "_key")
    best = (m.groupBy(label_col)
             .agg(F.min_by(F.struct(*take), F.struct("_prio", *take)).alias("_b"),
                  F.min("_prio").alias("match_rank"))
             .select(label_col, "match_rank", *[F.col("_b")[c].alias(c) for c in take]))
    return labels.join(best, label_col, "left")
