"""Incremental ingest with Structured Streaming.

Ingestion runs as scheduled micro-batches.  A file source (new landed files
only, tracked by the checkpoint) is drained with ``trigger(availableNow=True)``
and every micro-batch goes through ``foreachBatch`` into a table with an
upsert or a replace by group, so a replayed batch (after a failure) produces
the same table.  Checkpoints and tables live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import keep_last_rows, together
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as fx
from ..sources.sinks import BucketedTable, VersionedTable
from ..sources.tables import table_path

EVENT_KEY = ["report_code", "page_index", "event_index"]


def scratch_root(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for one job run."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakeweave-{name}-{uuid.uuid4().hex[:10]}"


def deliver(root: str, parts, ingest) -> None:
    """Each part lands as files under ``<root>/landing/part=<k>``, written by as many tasks as its plan has,
    and is drained before the next one lands: one batch is one delivery, however many files it has.

    ``ingest(source)`` runs the stream over all that has landed, from the same checkpoint each time."""
    for k, part in enumerate(parts):
        part.hint("rebalance").write.parquet(f"{root}/landing/part={k}")
        ingest(f"{root}/landing/part=*")


def run_available_now(stream: DataFrame, sink, checkpoint: str, output_mode: str = "append") -> None:
    q = (stream.writeStream.outputMode(output_mode).foreachBatch(sink)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def landed_stream(spark: SparkSession, source: str, per_trigger: int | None = None) -> DataFrame:
    """New files only; ``_landed`` orders two deliveries of one row (time, then file)."""
    schema = spark.read.parquet(source).schema
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(source).select("*", F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("_landed"))


def _bronze(spark: SparkSession, batch: DataFrame) -> DataFrame:
    """Bronze rows of a batch; of an event delivered twice in it the later delivery counts."""
    rest = [c for c in batch.columns if c not in ("event_id", "_landed")]
    last = together(batch, ["event_id"]).groupBy("event_id").agg(F.max_by(F.struct(*rest), F.col("_landed")).alias("_v")).select("event_id", "_v.*")
    return fx.combat_events_bronze(spark, None, events=last)


def ingest_events_to_bronze(spark: SparkSession, source: str, table, checkpoint: str, per_trigger: int | None = None):
    """Landed raw event files -> bronze events, merged by (report, page, event).

    A page may arrive in pieces over files and batches, again, or grown by events: its
    rows are those of all deliveries, the latest of each event.  Nothing depends on
    when a file arrives, so there is no watermark and no late row is lost.  A
    replayed batch gives the same table."""
    def sink(batch: DataFrame, epoch_id: int) -> None:
        table.upsert(_bronze(spark, batch), EVENT_KEY, order=["timestamp_ms"])

    run_available_now(landed_stream(spark, source, per_trigger), sink, checkpoint)
    return table


def ingest_and_refresh_silver(spark: SparkSession, source: str, bronze, silver, checkpoint: str):
    """T4 + T6: after each bronze batch, rebuild silver events only for the
    reports the batch touched (all their pages, from the bronze table) and
    swap those report groups in the silver table (delete + insert by report)."""
    from types import SimpleNamespace

    from ..plans.combat import silver_events

    def sink(batch: DataFrame, epoch_id: int) -> None:
        new = _bronze(spark, batch)
        bronze.upsert(new, EVENT_KEY, order=["timestamp_ms"])
        touched = new.select("report_code").distinct()
        if isinstance(bronze, BucketedTable):     # scan the touched buckets only
            events = bronze.read_keys(touched)
        else:
            events = bronze.read().join(touched, "report_code", "left_semi")
        silver.replace_groups(silver_events(SimpleNamespace(events=events)), ["report_code"])

    run_available_now(landed_stream(spark, source), sink, checkpoint)
    return silver


def climate_daily_upsert(spark: SparkSession, source: str, table, checkpoint: str, curate, per_trigger: int | None = None):
    """T5: each landed daily file is curated and upserted by (station, date); of two
    deliveries of a day in one batch the later file counts."""
    from ..plans.climate import KEY

    def sink(batch: DataFrame, epoch_id: int) -> None:
        rows = keep_last_rows(together(curate(batch.drop("_landed")), KEY), KEY, ["_file"]).drop("_file")
        table.upsert(rows, KEY, order=KEY)

    run_available_now(landed_stream(spark, source, per_trigger), sink, checkpoint)
    return table


# ------------------------------------------------------------------ registered jobs
def _events_glob(sf_dir: str) -> str:
    # the driver table is one parquet file; a glob turns it into a file-stream source
    return table_path(sf_dir, "events").replace("events.parquet", "events*.parquet")


def stream_bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_root(spark, "stream-bronze")
    table = BucketedTable(spark, root + "/table", ["report_code"], buckets=16)
    t = ingest_events_to_bronze(spark, _events_glob(sf_dir), table, root + "/checkpoint")
    return t.read()


def stream_bronze_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land in two deliveries that split every page; each is a batch, and the first is delivered again."""
    root = scratch_root(spark, "stream-two")
    events = spark.read.parquet(table_path(sf_dir, "events"))
    table = BucketedTable(spark, root + "/table", ["report_code"], buckets=16)
    deliver(root, [events.filter(part) for part in (F.col("event_id") % 3 == 0, F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0)],
            lambda source: ingest_events_to_bronze(spark, source, table, root + "/checkpoint"))
    return table.read()


def stream_climate_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 as a job: the two climate deliveries land and are upserted one after the other."""
    from ..plans.climate import climate_raw, curate

    root = scratch_root(spark, "stream-climate")
    raw = climate_raw(spark, sf_dir)
    table = VersionedTable(spark, root + "/table")
    deliver(root, [raw.filter(F.col("_file") == k) for k in (1, 2)],
            lambda source: climate_daily_upsert(spark, source, table, root + "/checkpoint", curate))
    return table.read()


QUERIES = {
    "stream_bronze_events": stream_bronze_events,
    "stream_bronze_two_batches": stream_bronze_two_batches,
    "stream_climate_upsert": stream_climate_upsert,
}
