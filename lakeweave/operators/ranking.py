"""Global ranks, exact quantiles and quantile binning without a global window.

A ``Window.orderBy`` with no ``partitionBy`` pulls every row into one task.
Here a total order is produced with a range-partitioned sort (balanced by
sampling, so a hot value does not land in one task as long as the order key
is unique), the sorted partitions are checkpointed to the shared checkpoint
folder (which fixes the row order and survives executor loss), and each row's
global position is its partition offset plus its position inside the
partition.  Only one row per partition (the counts) is combined in one place.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, pinned, shuffle_partitions

_PART_SHIFT = 1 << 33  # monotonically_increasing_id = partition_id << 33 | record_no


def global_row_number(df: DataFrame, order_cols: list, name: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """Append ``name`` = 1-based position of each row in ``order_cols`` order.

    ``order_cols`` must identify rows uniquely (append a key as tie-break);
    otherwise positions of equal rows are arbitrary but still a permutation.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or shuffle_partitions(spark)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ordered = pinned(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    ordered = ordered.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_local", F.monotonically_increasing_id() - F.col("_pid").cast("long") * F.lit(_PART_SHIFT))
    # one row per partition: bounded by the partition count, safe to combine
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    return (ordered.join(F.broadcast(offsets), "_pid")
                   .withColumn(name, F.col("_off") + F.col("_local") + F.lit(1))
                   .drop("_pid", "_local", "_off"))


def _lerp(a: float, b: float, t: float) -> float:
    # the same two-sided linear interpolation numpy uses for percentiles
    diff = b - a
    return b - diff * (1 - t) if t >= 0.5 else a + diff * t


def exact_quantiles(df: DataFrame, col: str, probs, tiebreak: list, n: int | None = None) -> list:
    """Exact linear-interpolation quantiles (pandas/numpy ``linear``).

    Nulls are ignored.  Only the values at the <= 2 * len(probs) needed ranks
    reach the driver.  ``n`` (the non-null count) may be passed when the
    caller already knows it, saving a pass.
    """
    base = df.select(col, *tiebreak).filter(F.col(col).isNotNull())
    if n is None:
        n = base.count()
    if n == 0:
        return [None] * len(probs)
    wanted = {}
    for p in probs:
        pos = float(p) * (n - 1)
        lo = int(math.floor(pos))
        hi = min(lo + 1, n - 1)
        wanted[p] = (lo, hi, pos - lo)
    need = sorted({r + 1 for lo, hi, _ in wanted.values() for r in (lo, hi)})
    ranked = global_row_number(base, [col] + list(tiebreak), name="_rank")
    got = {int(r["_rank"]): r[col] for r in
           ranked.filter(F.col("_rank").isin(need)).select("_rank", col).collect()}
    out = []
    for p in probs:
        lo, hi, t = wanted[p]
        a, b = float(got[lo + 1]), float(got[hi + 1])
        out.append(a if t == 0 else _lerp(a, b, t))
    return out


def qcut_edges(df: DataFrame, col: str, q: int, tiebreak: list,
               duplicates: str = "raise", n: int | None = None) -> list:
    """Edges of ``pandas.qcut(col, q)``; repeated edges raise like pandas."""
    probs = np.linspace(0, 1, q + 1)
    edges = exact_quantiles(df, col, probs, tiebreak, n=n)
    if any(e is None for e in edges):
        raise ValueError(f"qcut on empty column {col!r}")
    uniq = sorted(set(edges))
    if len(uniq) != len(edges):
        if duplicates == "raise":
            raise ValueError(f"Bin edges must be unique for {col!r}: {edges}")
        edges = uniq
    return edges


def qcut_bin(col: Column | str, edges: list) -> Column:
    """1-based bin of a right-closed cut with the lowest edge included."""
    c = F.col(col) if isinstance(col, str) else col
    b = F.lit(1)
    for e in edges[1:-1]:
        b = b + F.when(c > F.lit(float(e)), 1).otherwise(0)
    return F.when(c.isNull(), None).otherwise(b)


def rank_first_bin(rank: Column | str, n: int, q: int = 5) -> Column:
    """Bin of ``qcut(rank(method='first'), q)`` for ranks 1..n in closed form.

    The quantile edges of 1..n are 1 + i(n-1)/q, so the bin is the smallest i
    with rank - 1 <= i(n-1)/q.
    """
    r = F.col(rank) if isinstance(rank, str) else rank
    if n <= 1:
        return F.lit(1)
    return F.greatest(F.lit(1), F.ceil((r - 1) * F.lit(q) / F.lit(n - 1))).cast("int")
