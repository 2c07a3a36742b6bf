"""File sources and sinks.

Raw files are read with an explicit all-string schema (no inference pass
over the data); typed projection happens in the jobs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _header(spark: SparkSession, path: str, sep: str) -> list:
    first = spark.read.option("sep", sep).option("header", "false").csv(path).limit(1).collect()
    if not first:
        return []
    return [c for c in first[0]]


def read_all_string_csv(spark: SparkSession, parts: list, sep: str = ",") -> DataFrame:
    """Several CSV parts (sheets) with a header, every column a string,
    concatenated by column name (a column missing in one part is NULL there)."""
    frames = []
    for path in parts:
        cols = _header(spark, path, sep)
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
        frames.append(spark.read.option("sep", sep).option("header", "true").schema(schema).csv(path))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_semicolon_gz(spark: SparkSession, paths: list, partitions: int | None = None) -> DataFrame:
    """S2: ';'-separated gzip CSV files, all strings.  Gzip is not splittable,
    so the scan yields one task per file; repartition spreads the rows."""
    df = read_all_string_csv(spark, paths, sep=";")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n)


def land_parquet(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """Land a frame as Parquet, replacing the target (writer partitions, no chunks)."""
    if partitions:
        df = df.repartition(partitions)
    df.write.mode("overwrite").parquet(path)
    return path


def export_csv_tables(tables: dict, out_dir: str, skip_empty: bool = True) -> list:
    """One header CSV folder per table; empty tables are skipped."""
    written = []
    for name, df in tables.items():
        if skip_empty and df.isEmpty():
            continue
        target = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").option("header", "true").csv(target)
        written.append(name)
    return written


def export_json(df: DataFrame, path: str) -> str:
    """A report frame as JSON lines, one file per partition."""
    df.write.mode("overwrite").json(path)
    return path
