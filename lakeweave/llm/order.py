"""Places of rows inside their groups, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import sized, stored

_SHIFT = 33  # monotonically_increasing_id: partition << 33 | row


def null_safe(left: DataFrame, right: DataFrame, names: list[str], prefix: str):
    """Condition of equal columns, null equal to null; right's columns carry the prefix."""
    on = F.lit(True)
    for c in names:
        on = on & left[c].eqNullSafe(right[f"{prefix}{c}"])
    return on


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the stored rows with ``place``, from 0 in each group by ``order``, and ``size``, the group's rows;
    the groups with their sizes).  Nulls come first and are a group of their own.

    Rows are sorted over range partitions, so a group may span many of them; only one row per
    (group, partition) is combined.  ``order`` should tell rows apart, or a value that many
    rows share stays in one partition."""
    keys = [F.col(c) for c in [*group, *order]]
    sort = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = stored(sort.withColumn("_at", F.monotonically_increasing_id()), "sorted").withColumn("_part", F.shiftright("_at", _SHIFT))
    runs = at.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.select("_part", *group, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("size")), "runs")
    offsets = runs.select(*(F.col(c).alias(f"_{c}") for c in ["_part", *group]), "_first", "_before", F.col("size").alias("_size"))
    placed = at.join(sized(offsets, 64 + 32 * len(group)), null_safe(at, offsets, ["_part", *group], "_"))
    placed = placed.select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"), F.col("_size").alias("size"))
    return placed, runs.select(*group, "size").distinct()
