"""Readers for the driver tables (one parquet file or directory per table)."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


_KEPT: dict = {}
_KEEPERS: list = []


def fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the folder's tables: a folder whose tables changed is another input."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def kept(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table of one input folder, built once per session and state of the
    folder, and then read as stored Parquet: marts read stored silver and curated tables."""
    from ..session import materialize

    if _KEEPERS:
        return _KEEPERS[-1](spark, sf_dir, name, build)
    key = (spark.sparkContext.applicationId, sf_dir, name, fingerprint(spark, sf_dir))
    if key not in _KEPT:
        _KEPT[key] = materialize(build(), name)
    return _KEPT[key]


@contextmanager
def keeping(keeper):
    """While it is open, ``keeper`` says where derived tables are stored."""
    _KEEPERS.append(keeper)
    try:
        yield
    finally:
        _KEEPERS.pop()


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """One temp view per lake table so ad-hoc SQL can run on them."""
    for name in names:
        read(spark, sf_dir, name).createOrReplaceTempView(name)
