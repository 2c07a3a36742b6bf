"""First look at raw tables (A26): missing values, duplicates, cardinalities, frequent values, describe, relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import try_double
from ..operators import profile as P
from ..sources.fixtures import retail_lines
from ..sources.tables import read


def retail_profile(lines: DataFrame) -> DataFrame:
    """Rows, missing and distinct values of every raw column."""
    counts = P.value_counts(lines)
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"), F.count("value").alias("distinct_values"))


def numeric_lines(lines: DataFrame) -> DataFrame:
    """Quantity and price as numbers where they are some, and their product."""
    out = lines.select("invoice", "stock_code", try_double("quantity").alias("quantity"), try_double("price").alias("price"))
    return out.withColumn("total_line", F.col("quantity") * F.col("price"))


def _shown(table: DataFrame) -> DataFrame:
    """Means and deviations as printed, to four places."""
    return table.withColumns({c: F.round(c, 4) for c in ("mean", "std")})


def describe_lines(lines: DataFrame) -> DataFrame:
    numeric = ["quantity", "price", "total_line"]
    return _shown(P.describe(P.value_counts(numeric_lines(lines).select(*numeric)), numeric))


def distinct_per(lines: DataFrame, key: str, value: str, name: str, k: int = 10) -> DataFrame:
    """The keys with most different values, as a check of a supposed relation; ties by key."""
    pairs = lines.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(key, value).distinct()
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), key).limit(k)


def _raw(fn):
    return lambda spark, sf: fn(retail_lines(spark, sf))


def lineitem_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(P.whole_profile(read(spark, sf_dir, "lineitem")))


QUERIES = {
    "retail_profile": _raw(retail_profile),
    "retail_missing_values": _raw(lambda d: P.missing_values(P.value_counts(d))),
    "retail_duplicates": _raw(P.duplicates),
    "retail_cardinalities": _raw(lambda d: P.cardinalities(P.value_counts(d))),
    "retail_top_values": _raw(lambda d: P.top_values(P.value_counts(d))),
    "retail_describe": _raw(describe_lines),
    "retail_descriptions_per_product": _raw(lambda d: distinct_per(d, "stock_code", "description", "descriptions")),
    "retail_countries_per_customer": _raw(lambda d: distinct_per(d, "customer_id", "country", "countries")),
    "retail_invoices_per_country": _raw(lambda d: distinct_per(d, "country", "invoice", "invoices")),
    "retail_customers_per_country": _raw(lambda d: distinct_per(d, "country", "customer_id", "customers")),
    "lineitem_profile": lineitem_profile,
}
