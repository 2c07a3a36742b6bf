"""Keep-first / keep-last per key as aggregates.

Rows carry no file order in Spark, so "first" is defined by explicit order
columns.  ``min_by``/``max_by`` over a struct is a partial aggregate: each task
reduces its rows before the shuffle, so a key holding a third of all rows
costs one row per task on the wire instead of one group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def together(df: DataFrame, keys: list) -> DataFrame:
    """The rows of each key in one partition, before a pick over keys that hold few rows each.

    Where nearly every row has its own key, reducing before the shuffle only sorts all rows
    once more: here they are shuffled as they come, and sorted once.  Not for keys that hold much of the table."""
    return df.repartition(*keys)


def _pick(df: DataFrame, keys: list, values: list, order: list, fn) -> DataFrame:
    order_struct = F.struct(*[F.col(c) for c in order])
    value_struct = F.struct(*[F.col(c) for c in values])
    return (df.groupBy(*keys)
              .agg(fn(value_struct, order_struct).alias("_v"))
              .select(*keys, *[F.col("_v")[c].alias(c) for c in values]))


def first_by_key(df: DataFrame, keys: list, values: list, order: list) -> DataFrame:
    """Values of the row with the smallest ``order`` per key."""
    return _pick(df, keys, values, order, F.min_by)


def last_by_key(df: DataFrame, keys: list, values: list, order: list) -> DataFrame:
    """Values of the row with the largest ``order`` per key (keep-last)."""
    return _pick(df, keys, values, order, F.max_by)


def keep_last_rows(df: DataFrame, keys: list, order: list) -> DataFrame:
    """Whole rows, one per key, the one with the largest ``order`` (keep='last')."""
    values = [c for c in df.columns if c not in keys]
    return _pick(df, keys, values, order, F.max_by).select(*df.columns)
