"""Interval arithmetic over ordered state transitions.

``uptime_from_transitions`` replaces a per-group array fold: each transition
row learns the next transition's time with ``lead`` inside its group (sorted by
time, removal before application at the same millisecond), and the active
time is the sum of the gaps that start in state 1, the last gap ending at the
group's end time.  Transitions after the end add 0 (``greatest``).  No group
is materialised as one array; the window sorts and spills like any sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def uptime_from_transitions(transitions: DataFrame, group_cols: list, ts: str = "ts",
                            state: str = "state", end_col: str = "end_ts",
                            start_col: str = "start_ts", carry: list | None = None) -> DataFrame:
    """Per group: ``uptime`` (sum of active time), ``present_at_start`` and the smallest value of each ``carry`` column.

    ``transitions`` has one row per transition with ``ts``, ``state`` (1 active,
    0 inactive) and the group's ``start_ts``/``end_ts`` on every row."""
    w = Window.partitionBy(*group_cols).orderBy(F.col(ts), F.col(state))
    nxt = F.coalesce(F.lead(ts).over(w), F.col(end_col))
    seg = transitions.withColumn(
        "_seg", F.when(F.col(state) == 1, F.greatest(nxt - F.col(ts), F.lit(0))).otherwise(F.lit(0)))
    return seg.groupBy(*group_cols).agg(
        F.sum("_seg").alias("uptime"),
        F.max(((F.col(state) == 1) & (F.col(ts) <= F.col(start_col))).cast("int")).alias("present_at_start"),
        *(F.min(c).alias(c) for c in carry or []))


def covered_time(transitions: DataFrame, group_cols: list, source: str, ts: str = "ts", state: str = "state",
                 end_col: str = "end_ts", carry: list | None = None) -> DataFrame:
    """Per group: ``covered`` (time in which at least one source is on) and ``most`` (sources on at once).

    A sweep over open intervals: each source's transitions become +1 when it opens and -1 when it
    closes (repeated and refreshing states change nothing), the changes of one moment are
    added up, and their running sum is the number of open intervals until the next moment."""
    own = Window.partitionBy(*group_cols, source).orderBy(F.col(ts), F.col(state))
    steps = transitions.withColumn("_step", F.col(state) - F.coalesce(F.lag(state).over(own), F.lit(0)))
    moments = steps.groupBy(*group_cols, ts).agg(F.sum("_step").alias("_step"), F.max(end_col).alias(end_col), *(F.min(c).alias(c) for c in carry or []))
    sweep = Window.partitionBy(*group_cols).orderBy(ts)
    open_now = F.sum("_step").over(sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    length = F.coalesce(F.lead(ts).over(sweep), F.greatest(F.col(end_col), F.col(ts))) - F.col(ts)
    swept = moments.withColumns({"_open": open_now, "_length": length})
    return swept.groupBy(*group_cols).agg(
        F.sum(F.when(F.col("_open") > 0, F.col("_length")).otherwise(0)).alias("covered"), F.max("_open").alias("most"), *(F.min(c).alias(c) for c in carry or []))
