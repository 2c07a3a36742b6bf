"""Whole-table profile from one frame of (column, value, count).

Columns are counted batch by batch (Arrow ``value_counts``) before anything is shuffled, so a value that
holds most rows costs one row a batch, and no row is expanded by the number of columns.  Missing values,
cardinalities, frequent values and the describe table are all read from the stored counts: quantiles of all numeric columns
together from running sums over range partitions, frequent values by a rank filter that
keeps only the best rows of each partition before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, pinned
from .quality import ratio_round

COUNTS = "column_name string, value string, n long"
QUANTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, values in zip(batch.schema.names, batch.columns):
            seen = pc.value_counts(values)
            if len(seen):
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(seen)), seen.field("values").cast(pa.string()), seen.field("counts").cast(pa.int64())], names=["column_name", "value", "n"])


def value_counts(df: DataFrame) -> DataFrame:
    """(column_name, value, n), stored: each column's values as strings, null one of them."""
    strings = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return materialize(strings.mapInArrow(_counted, COUNTS).groupBy("column_name", "value").agg(F.sum("n").alias("n")), "counts")


def _order(columns: list[str]) -> Column:
    """Position of the column in the table."""
    return F.array_position(F.array(*map(F.lit, columns)), F.col("column_name"))


def missing_values(counts: DataFrame) -> DataFrame:
    """Columns with missing values: how many, and their share in percent."""
    sums = counts.groupBy("column_name").agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"), F.sum("n").alias("rows"))
    return sums.where("missing > 0").select("column_name", "missing", ratio_round(F.col("missing") * 100, F.col("rows"), 2).alias("missing_pct"))


def cardinalities(counts: DataFrame) -> DataFrame:
    """Distinct values of each column; null is none."""
    return counts.groupBy("column_name").agg(F.count("value").alias("distinct_values"))


def top_values(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of each column; ties by value.  The rank filter runs before the shuffle too."""
    best = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n"), "value"))
    return counts.where(F.col("value").isNotNull()).withColumn("rank", best).where(F.col("rank") <= k)


def duplicates(df: DataFrame) -> DataFrame:
    """Rows, rows that repeat an earlier one, and different rows, by two 64-bit hashes of the whole row (nulls told apart by place)."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    rows = df.select(F.xxhash64(*cols, nulls).alias("a"), F.xxhash64(F.lit(1), nulls, *reversed(cols)).alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("unique_rows")).withColumn("duplicate_rows", F.col("rows") - F.col("unique_rows"))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (column, number) with the count of what stands before them in their partition and column."""
    column, total = None, 0
    for batch in batches:
        names, n = batch.column(0), batch.column(2).to_numpy()
        before = np.zeros(len(n), dtype=np.int64)
        codes = names.dictionary_encode()
        index, labels = codes.indices.to_numpy(), codes.dictionary.to_pylist()
        cuts = [0, *(np.flatnonzero(np.diff(index)) + 1).tolist(), len(n)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if labels[index[lo]] != column:
                column, total = labels[index[lo]], 0
            before[lo:hi] = total + np.cumsum(n[lo:hi]) - n[lo:hi]
            total += int(n[lo:hi].sum())
        yield pa.RecordBatch.from_arrays([names, batch.column(1), batch.column(2), pa.array(before)], names=["column_name", "number", "n", "before"])


def _ranked(numbers: DataFrame) -> DataFrame:
    """(column_name, number, n, first): how many values of the column are smaller, without a task that holds a column."""
    order = ["column_name", "number"]
    rows = pinned(numbers.select(*order, "n").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_running, "column_name string, number double, n long, before long"))
    rows = rows.withColumn("part", F.spark_partition_id())
    sums = rows.groupBy("part", "column_name").agg(F.sum("n").alias("size"))     # a row per partition and column
    earlier = Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", "column_name", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    return rows.join(offsets, ["part", "column_name"]).select("column_name", "number", "n", (F.col("before") + F.col("offset")).alias("first"))


def describe(counts: DataFrame, numeric: list[str], quantiles: dict[str, float] | None = None) -> DataFrame:
    """count, mean, std (of a sample), min, quantiles (linear), max of the numeric columns; NaN counts as missing."""
    quantiles = quantiles or QUANTILES
    numbers = counts.where(F.col("value").isNotNull() & F.col("column_name").isin(numeric)).select("column_name", F.col("value").cast("double").alias("number"), "n").where(~F.isnan("number"))
    x, n = F.col("number"), F.col("n")
    sums = materialize(numbers.groupBy("column_name").agg(F.sum("n").alias("count"), F.sum(x * n).alias("total"), F.min(x).alias("min"), F.max(x).alias("max")).withColumn("mean", F.col("total") / F.col("count")), "sums")
    off = numbers.join(F.broadcast(sums.select("column_name", "mean", "count")), "column_name")      # a row per numeric column
    spread = off.groupBy("column_name").agg(F.when(F.max("count") > 1, F.sqrt(F.sum((x - F.col("mean")) * (x - F.col("mean")) * n) / (F.max("count") - 1))).alias("std"))
    places = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(q) * (F.col("count") - 1)).alias("at")) for name, q in quantiles.items()])).alias("p")
    wanted = sums.select("column_name", places).select("column_name", "p.*")
    # the values at the two places around each quantile
    ranked = _ranked(numbers)
    met = ranked.join(F.broadcast(wanted), "column_name").where((F.col("first") <= F.ceil("at")) & (F.col("first") + n > F.floor("at")))
    ends = met.groupBy("column_name", "name", "at").agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    values = ends.withColumn("v", F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at")))
    at = values.groupBy("column_name").agg(*[F.max(F.when(F.col("name") == q, F.col("v"))).alias(q) for q in quantiles])
    return sums.join(spread, "column_name").join(at, "column_name").select("column_name", "count", "mean", "std", "min", *quantiles, "max")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def whole_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, missing values, distinct values, and the describe columns where it is numeric."""
    counts = value_counts(df)
    sums = counts.groupBy("column_name").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"), F.count("value").alias("distinct_values"))
    base = sums.withColumn("missing_pct", ratio_round(F.col("missing") * 100, F.col("rows"), 2)).withColumn("position", _order(df.columns).cast("int"))
    numeric = numeric_columns(df)
    return base.join(describe(counts, numeric), "column_name", "left") if numeric else base
