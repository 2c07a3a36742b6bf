"""Table writes: overwrite, upsert by key, replace by group, guarded snapshot.

The DataFrame functions (``upsert``, ``replace_by_group``...) are pure and used by
jobs and by streaming ``foreachBatch`` alike.  Path tables write complete data
first and then append one row to a commit log (a small dataset of its own), so
readers see the old or the new version and nothing is ever deleted; where the
catalog has a table format with MERGE, ``merge_into_table`` is the way.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ------------------------------------------------------------------ pure frame operators
def upsert(existing: DataFrame, updates: DataFrame, keys: list, order: list,
           created_col: str | None = None, updated_col: str | None = None, run_ts=None) -> DataFrame:
    """Insert new keys, replace every non-key column of known keys.

    ``updates`` is first reduced to one row per key, the last by ``order`` (without
    an order, which of two updates wins would be chance: it is required).
    ``created_col`` keeps the value of the existing row; ``updated_col`` is
    stamped with ``run_ts``."""
    if not order:
        raise ValueError("upsert needs the columns that order two updates of a key")
    values = [c for c in updates.columns if c not in keys]
    last = F.max_by(F.struct(*values), F.struct(*order))
    updates = updates.groupBy(*keys).agg(last.alias("_v")).select(*keys, "_v.*")
    cols = existing.columns
    if created_col:
        created = existing.select(*keys, F.col(created_col).alias("_created"))
        updates = (updates.join(created, keys, "left")
                          .withColumn(created_col, F.coalesce("_created", F.lit(run_ts).cast("timestamp")))
                          .drop("_created"))
    if updated_col:
        updates = updates.withColumn(updated_col, F.lit(run_ts).cast("timestamp"))
    kept = existing.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates.select(*cols), allowMissingColumns=False)


def insert_missing(existing: DataFrame, incoming: DataFrame, keys: list) -> DataFrame:
    """MERGE ... WHEN NOT MATCHED THEN INSERT."""
    new = incoming.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(new.select(*existing.columns))


def replace_by_group(existing: DataFrame, incoming: DataFrame, group_cols: list) -> DataFrame:
    """Drop every existing row of the groups present in ``incoming``, then append.

    Empty input is a no-op.  Replaying the same batch gives the same table."""
    groups = incoming.select(*group_cols).distinct()
    kept = existing.join(groups, group_cols, "left_anti")
    return kept.unionByName(incoming.select(*existing.columns))


def conform(df: DataFrame, target_schema) -> DataFrame:
    """Add missing target columns as NULL, cast to the target types, drop extras."""
    out = []
    for f in target_schema.fields:
        if f.name in df.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


# ------------------------------------------------------------------ path tables
def _read(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options) -> DataFrame | None:
    """The dataset at ``path``, None if there is none yet."""
    reader = spark.read.format(fmt).options(**options)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


class VersionedTable:
    """A path table whose versions are named by a commit log.

    A write goes to a new folder ``<root>/v=<id>``; then one row (version, path) is
    appended to ``<root>/commits``.  The current version is the last committed one:
    a job that fails before the append leaves the table as it was, and nothing that a
    reader may hold is removed.  Contract: one writer per table."""

    _LOG = "version long, path string, committed_at timestamp"

    def __init__(self, spark: SparkSession, root: str, partition_by: list | None = None,
                 cluster_by: list | None = None, sort_by: list | None = None):
        """``cluster_by``/``sort_by`` give the stored layout (O6): rows of one key land
        together (a large key in several files) and are sorted inside a file, so
        Parquet min/max statistics prune row groups for filters on the sort key."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = partition_by or []
        self.cluster_by = cluster_by or []
        self.sort_by = sort_by or []

    def _last(self) -> tuple[int, str | None]:
        log = _read(self.spark, f"{self.root}/commits", "json", self._LOG)
        last = log.agg(F.max(F.struct("version", "path")).alias("c")).first()["c"] if log is not None else None
        return (last["version"], last["path"]) if last else (0, None)

    def current_path(self) -> str | None:
        return self._last()[1]

    def exists(self) -> bool:
        return self.current_path() is not None

    def read(self) -> DataFrame:
        path = self.current_path()
        if path is None:
            raise FileNotFoundError(self.root)
        return self.spark.read.option("mergeSchema", "true").parquet(path)

    def _commit(self, df: DataFrame) -> str:
        path = f"{self.root}/v={uuid.uuid4().hex}"
        if self.cluster_by:
            df = df.hint("rebalance", *self.cluster_by)
        if self.sort_by:
            df = df.sortWithinPartitions(*self.sort_by)
        w = df.write.mode("errorifexists")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(path)
        row = (self._last()[0] + 1, path, datetime.now(timezone.utc))
        self.spark.createDataFrame([row], self._LOG).coalesce(1).write.mode("append").json(f"{self.root}/commits")
        return path

    def overwrite(self, df: DataFrame, skip_if_empty: bool = False) -> str | None:
        """Full replace; with ``skip_if_empty`` an empty input keeps the table."""
        if skip_if_empty and df.isEmpty():
            return self.current_path()
        return self._commit(df)

    def append(self, df: DataFrame) -> str:
        """Append with additive schema merge."""
        if not self.exists():
            return self._commit(df)
        return self._commit(self.read().unionByName(df, allowMissingColumns=True))

    def upsert(self, updates: DataFrame, keys: list, order: list, **kw) -> str:
        return self._commit(upsert(self.read() if self.exists() else updates.limit(0), updates, keys, order, **kw))

    def replace_groups(self, incoming: DataFrame, group_cols: list) -> str | None:
        """Replace the groups present in ``incoming``; empty input is a no-op."""
        if incoming.isEmpty():
            return self.current_path()
        if not self.exists():
            return self._commit(incoming)
        return self._commit(replace_by_group(self.read(), incoming, group_cols))


class BucketedTable:
    """Parquet path table hash-bucketed on ``bucket_cols``; writes touch only
    the buckets present in the input (S22/S24 at scale).

    Layout: ``<path>/_bucket=<b>/part-*.parquet`` with
    ``_bucket = pmod(xxhash64(bucket_cols), buckets)``.  A replace or upsert
    reads just the touched buckets (partition pruning), computes their new
    content, stores it (lineage cut, survives executor loss) and writes it back
    with dynamic partition overwrite: untouched buckets are never read or
    rewritten, and a large bucket is written by several tasks.  The
    group/upsert key must contain ``bucket_cols`` so a group never spans two
    buckets.  Only the touched bucket ids (at most ``buckets`` values) reach the
    driver.  The overwrite of several buckets is not one commit: after a crash
    some buckets are new and some old, and the replayed batch sets them right."""

    def __init__(self, spark: SparkSession, path: str, bucket_cols: list, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.bucket_cols, self.buckets = list(bucket_cols), buckets

    def _bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", F.pmod(F.xxhash64(*self.bucket_cols), F.lit(self.buckets)).cast("int"))

    def _touched(self, df: DataFrame) -> list:
        return sorted(r[0] for r in df.select("_bucket").distinct().collect())

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("_bucket")

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """Rows whose bucket key is in ``keys``: only those buckets are scanned."""
        part = self.spark.read.parquet(self.path).filter(F.col("_bucket").isin(self._touched(self._bucket(keys)))).drop("_bucket")
        return part.join(keys.select(*self.bucket_cols).distinct(), self.bucket_cols, "left_semi")

    def _rewrite(self, incoming: DataFrame, new_content) -> list:
        from ..session import materialize

        inc = self._bucket(incoming)
        touched = self._touched(inc)
        if not touched:
            return []
        table = _read(self.spark, self.path)
        current = table.filter(F.col("_bucket").isin(touched)) if table is not None else inc.limit(0)
        new = materialize(new_content(current, inc), "buckets")
        (new.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("_bucket").parquet(self.path))
        return touched

    def replace_groups(self, incoming: DataFrame, group_cols: list) -> list:
        assert set(self.bucket_cols) <= set(group_cols), "group key must contain the bucket key"
        return self._rewrite(incoming, lambda current, inc: replace_by_group(current, inc, group_cols))

    def upsert(self, updates: DataFrame, keys: list, order: list) -> list:
        assert set(self.bucket_cols) <= set(keys), "upsert key must contain the bucket key"
        return self._rewrite(updates, lambda current, inc: upsert(current, inc, keys, order))


def merge_into_table(updates: DataFrame, table_name: str, keys: list) -> None:
    """S22 on a table format with MERGE support (Delta/Iceberg catalog tables):
    the engine rewrites only the touched files.  Plain Parquet path tables use
    ``BucketedTable`` instead."""
    cond = " AND ".join(f"{table_name}.`{k}` = s.`{k}`" for k in keys)
    (updates.alias("s").mergeInto(table_name, F.expr(cond))
            .whenMatched().updateAll().whenNotMatched().insertAll().merge())
