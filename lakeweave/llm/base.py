"""Shared plumbing of the operators: tables, Arrow settings, stored tables, grouped streams."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, prepare

#: A side is broadcast only when it was counted and stays under this many bytes.
BROADCAST_BYTES = 32_000_000


def tuned(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: a task's memory then follows the batch, not the partition."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """The frame written as Parquet in the shared folder and read again.

    Cuts the lineage: Python passes run once however often the result is used,
    and a lost executor costs a read, not a recomputation of the pass."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, bytes_per_row: int = 64, weight: F.Column | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The (stored) frame, with a broadcast hint only if its measured size is under ``limit``.

    Beyond the limit the join is an ordinary shuffled join, which adaptive execution
    splits where keys are skewed.  ``weight``: bytes of a row's variable part."""
    total = F.count(F.lit(1)) * bytes_per_row
    if weight is not None:
        total = total + F.coalesce(F.sum(weight), F.lit(0))
    return F.broadcast(df) if (df.agg(total.alias("b")).first()["b"] or 0) <= limit else df


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, pa.Table]]:
    """(key values, rows) for each run of equal keys in a stream sorted by the (non-null integer) keys."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(n, dtype=bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [*np.flatnonzero(new).tolist(), n]
        for lo, hi in zip(cuts, cuts[1:]):
            key = tuple(int(c[lo]) for c in columns)
            if held and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            held_key = key
    if held:
        yield held_key, pa.Table.from_batches(held)


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def with_text(batch: pa.RecordBatch, texts: list[str], name: str = "text", lengths: str = "n_chars") -> pa.RecordBatch:
    """The batch with other texts; a column of text lengths follows."""
    out = []
    for i, field in enumerate(batch.schema):
        if field.name == name:
            out.append(pa.array(texts, type=field.type))
        elif field.name == lengths and pa.types.is_integer(field.type):
            out.append(pa.array([len(t) if t is not None else None for t in texts], type=field.type))
        else:
            out.append(batch.column(i))
    return pa.RecordBatch.from_arrays(out, schema=batch.schema)
