"""Data-quality operators (Q1-Q4, Q9, A23) and exact ratio rounding.

Every check is a single aggregate pass returning a small frame of counts;
no failing rows are collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio_round(num, den, scale: int = 1) -> Column:
    """round(num / den, scale) half-up on the exact rational (integer inputs).

    Integer arithmetic only, so the result does not depend on how an engine
    rounds binary fractions (PostgreSQL numeric semantics)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    f = 10 ** scale
    a = num.cast("bigint") * F.lit(2 * f) + den.cast("bigint")
    b = den.cast("bigint") * F.lit(2)
    q = (a - F.pmod(a, b)) / b
    return F.when(den == 0, None).otherwise(q / F.lit(float(f)))


def expect_not_null(df: DataFrame, columns: list, model: str = "") -> DataFrame:
    """Q1: failing-row count per column (dbt ``not_null``)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (agg.unpivot([], columns, "column_name", "failures")
               .withColumns({"test": F.lit("not_null"), "model": F.lit(model)}))


def expect_unique(df: DataFrame, columns: list, model: str = "") -> DataFrame:
    """Q2: number of key values seen more than once (dbt ``unique``)."""
    dup = (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
             .agg(F.count_if(F.col("_n") > 1).alias("failures")))
    return dup.select(F.lit("unique").alias("test"), F.lit(model).alias("model"),
                      F.lit(",".join(columns)).alias("column_name"), "failures")


def expect_accepted_values(df: DataFrame, column: str, values: list, model: str = "") -> DataFrame:
    """Q3: rows whose value is outside the accepted list (NULL passes, as in dbt)."""
    bad = df.agg(F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values)).alias("failures"))
    return bad.select(F.lit("accepted_values").alias("test"), F.lit(model).alias("model"),
                      F.lit(column).alias("column_name"), "failures")


def expect_not_empty(df: DataFrame, model: str = "") -> DataFrame:
    """Q4: 1 failure when the table has no row (reads at most one row per partition)."""
    n = df.limit(1).agg(F.count(F.lit(1))).scalar()
    return df.sparkSession.range(1).select(
        F.lit("not_empty").alias("test"), F.lit(model).alias("model"),
        F.lit("*").alias("column_name"), F.when(n == 0, 1).otherwise(0).cast("bigint").alias("failures"))


def expect_foreign_key(child: DataFrame, parent: DataFrame, keys: list, model: str = "") -> DataFrame:
    """Q9: child rows whose non-null key has no parent row."""
    k = child.select(*keys).dropna()
    orphans = k.join(parent.select(*keys).distinct(), keys, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("relationships").alias("test"), F.lit(model).alias("model"),
        F.lit(",".join(keys)).alias("column_name"), "failures")


def union_results(frames: list) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
