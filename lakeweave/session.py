"""Session construction and cluster-wide settings.

All semantics decisions that depend on the session live here: UTC time zone,
ANSI on (every lenient cast is explicit), AQE with skew-join handling, and the
checkpoint directory used to cut lineage.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # client-side call-site capture on every DataFrame call: costs seconds of
    # plan-building time on large plans, no effect on execution
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "lakeweave",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession, sf_dir: str | None = None) -> SparkSession:
    """Apply the SQL settings a job relies on to an existing session; with ``sf_dir`` also
    those by which a task's share stays the same however large that folder's tables are."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    _share(spark, sf_dir)
    try:
        spark.conf.set("spark.python.sql.dataFrameDebugging.enabled", "false")
    except Exception:  # noqa: BLE001 - optional client setting
        pass
    ensure_checkpoint_dir(spark)
    return spark


#: Stored bytes of input that a shuffle partition stands for (its rows take about thirty times that in memory).
PARTITION_BYTES = 4 << 20
#: What adaptive execution may merge partitions to, what a task reads of a file, and what goes to Python at once.
SHARES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 << 20), "spark.sql.files.maxPartitionBytes": str(32 << 20),
          "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
_PARTITIONS = "spark.sql.shuffle.partitions"
_BASE: dict = {}


def _share(spark: SparkSession, sf_dir: str | None) -> None:
    """Shuffle partitions in proportion to the stored input, never fewer than the session had; without a
    folder, the session's own settings again.  A value set in between by the user is the new base."""
    app = spark.sparkContext.applicationId
    base = _BASE.setdefault(app, {})
    wanted = {}
    if sf_dir is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
        stored = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
        wanted = {**SHARES, _PARTITIONS: str(-(-stored // PARTITION_BYTES))}
    for key in (*SHARES, _PARTITIONS):
        now = spark.conf.get(key)
        own, ours = base.get(key, (now, now))
        if now != ours:
            own = now
        value = wanted.get(key, own)
        if key == _PARTITIONS:
            value = str(max(int(own), int(value)))
        if value != now:
            spark.conf.set(key, value)
        base[key] = (own, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when it is unset *and* the session runs in local mode (tests, the
    bench) a private scratch folder is created.  On a cluster an unset
    checkpoint dir is an error: a machine-local folder would not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        base = os.environ.get("LAKEWEAVE_SCRATCH") or tempfile.gettempdir()
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lakeweave-ckpt-", dir=base))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it to a shared folder "
        "(HDFS/S3/ABFS) so checkpointed stages survive executor loss")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def materialize(df, tag: str = "table"):
    """The frame written once as Parquet in the shared folder and read again.

    Readers get pruned columns, pushed filters and file statistics, and a lost
    executor costs a read, not a recomputation."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pinned(df):
    """Reliable checkpoint that keeps partitions and their row order (a sorted frame's ranks
    are positions in them)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
