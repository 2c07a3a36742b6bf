"""Exact micro-batches over append-only stores: border duplicates and a maintained aggregate.

A store is a Parquet dataset with one folder per micro-batch (``epoch=<id>``).  A batch reads
the folders of earlier epochs only and overwrites its own, so a batch that is run again
after a failure gives the same folders, whatever the first try left behind, and no batch
rewrites what an earlier one wrote.  There is no watermark: an event counts however late it comes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.dedupe import together
from .incremental import landed_stream, run_available_now

#: Place of an event in its delivery; everything else is its content.
PLACE = ["report_code", "page_index", "event_index"]
#: A counted value is kept exactly, so that taking it back leaves nothing.
EXACT = "decimal(30,6)"


class EpochStore:
    """An append-only dataset, one folder per micro-batch."""

    def __init__(self, spark: SparkSession, path: str, schema: str, sort: list[str]):
        """``sort``: order of rows inside files, by which readers skip what a batch cannot touch."""
        self.spark, self.path, self.schema, self.sort = spark, path.rstrip("/"), schema, sort
        spark.createDataFrame([], f"{schema}, epoch long").write.mode("append").partitionBy("epoch").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, epoch long").parquet(self.path)

    def before(self, epoch: int) -> DataFrame:
        return self.read().where(F.col("epoch") < epoch).drop("epoch")

    def write(self, rows: DataFrame, epoch: int) -> None:
        (rows.hint("rebalance").sortWithinPartitions(*self.sort).withColumn("epoch", F.lit(epoch).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(self.path))


def _between(store_rows: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` lies in the batch's range: a range reaches the scan, where file statistics prune."""
    ends = batch.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return store_rows.where(F.col(column).between(F.lit(ends["lo"]), F.lit(ends["hi"])))


# ------------------------------------------------------------------ T3: page borders
def content_key(columns: list[str]) -> F.Column:
    """Hash of all that an event says; its place is not part of it."""
    return F.sha2(F.to_json(F.struct(*[c for c in columns if c not in PLACE]), {"ignoreNullFields": "false"}).cast("binary"), 256)


def occurrences(pages: DataFrame) -> DataFrame:
    """Whole pages -> one row per real event: (report, content, occurrence) with its first place.

    The page border delivers an event twice, once at the end of a page and once at the start
    of the next; two equal events of one page are two events.  So an event is real as often as the page that
    has it most often, and its k-th occurrence in one page is the k-th in any other.  The
    window is bounded by a page; pages are compared by a partial aggregate."""
    rest = [c for c in pages.columns if c not in PLACE]
    keyed = pages.withColumn("content", content_key(pages.columns))
    in_page = Window.partitionBy("report_code", "page_index", "content").orderBy("event_index")
    nth = keyed.withColumn("occurrence", F.row_number().over(in_page).cast("long"))
    first = nth.groupBy("report_code", "content", "occurrence").agg(F.min_by(F.struct("page_index", "event_index", *rest), F.struct("page_index", "event_index")).alias("e"))
    return first.select("report_code", "content", "occurrence", "e.*")


def given_store(spark: SparkSession, root: str, schema: str) -> EpochStore:
    """Where ``ingest_events_once`` puts the events that it gives out."""
    return EpochStore(spark, f"{root}/given", f"{schema}, content string, occurrence long", ["report_code", "content"])


def ingest_events_once(spark: SparkSession, source: str, root: str, schema: str, per_trigger: int | None = None) -> EpochStore:
    """Landed event pages -> every real event once, over batches, replays and page borders.

    Two stores: what was delivered (so that a page that comes in pieces is counted as a whole), and the
    events given out, whose (report, content, occurrence) is the key of later batches.  A place is taken
    to say the same whenever it is delivered; a report that changed is ingested anew (T2)."""
    delivered = EpochStore(spark, f"{root}/delivered", schema, PLACE)
    given = given_store(spark, root, schema)

    def sink(batch: DataFrame, epoch: int) -> None:
        batch = batch.drop("_landed").dropDuplicates(PLACE)
        earlier = _between(delivered.before(epoch), batch, "report_code")
        delivered.write(batch.join(earlier, PLACE, "left_anti"), epoch)
        pages = batch.select("report_code", "page_index").distinct()
        whole = earlier.unionByName(delivered.read().where(F.col("epoch") == epoch).drop("epoch")).join(pages, ["report_code", "page_index"], "left_semi")
        known = _between(given.before(epoch), batch, "report_code").select("report_code", "content", "occurrence")
        given.write(occurrences(whole).join(known, ["report_code", "content", "occurrence"], "left_anti").select(*[f.name for f in given.read().schema if f.name != "epoch"]), epoch)

    run_available_now(landed_stream(spark, source, per_trigger), sink, f"{root}/checkpoint")
    return given


# ------------------------------------------------------------------ maintained hourly aggregate (ours)
CONTRIBUTION = f"event_id long, window_start timestamp, event_type string, amount {EXACT}"
DELTA = f"window_start timestamp, event_type string, events long, amount {EXACT}"


def _contributions(batch: DataFrame) -> DataFrame:
    """What each event of the batch adds, by its last delivery."""
    last = together(batch, ["event_id"]).groupBy("event_id").agg(F.max_by(F.struct("ts", "event_type", "value"), F.col("_landed")).alias("e"))
    return last.select("event_id", F.date_trunc("hour", F.col("e.ts").cast("timestamp")).alias("window_start"), "e.event_type", F.col("e.value").cast(EXACT).alias("amount"))


def delta_store(spark: SparkSession, root: str) -> EpochStore:
    """Where ``maintain_hourly`` puts what each batch changed."""
    return EpochStore(spark, f"{root}/deltas", DELTA, ["window_start", "event_type"])


def maintain_hourly(spark: SparkSession, source: str, root: str, per_trigger: int | None = None) -> EpochStore:
    """Counts and sums per (hour, type), kept by deltas: an event that is delivered again takes its old
    contribution out and puts its new one in, so duplicates and corrections (another value, type or
    time) over files and batches give what the last delivery of each event gives.

    ``contributions`` holds what each batch put in; ``deltas`` a row per (hour, type) that it changed."""
    contributions = EpochStore(spark, f"{root}/contributions", CONTRIBUTION, ["event_id"])
    deltas = delta_store(spark, root)

    def sink(batch: DataFrame, epoch: int) -> None:
        contributions.write(_contributions(batch), epoch)
        new = contributions.read().where(F.col("epoch") == epoch).drop("epoch")
        history = contributions.read().where(F.col("epoch") < epoch)
        old = _between(history, new, "event_id").join(new.select("event_id"), "event_id", "left_semi")
        old = old.groupBy("event_id").agg(F.max_by(F.struct("window_start", "event_type", "amount"), F.col("epoch")).alias("e")).select("event_id", "e.*")
        signed = new.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1)))
        change = signed.groupBy("window_start", "event_type").agg(F.sum("sign").alias("events"), F.sum(F.col("amount") * F.col("sign")).cast(EXACT).alias("amount"))
        deltas.write(change.where("events <> 0 or amount <> 0"), epoch)

    run_available_now(landed_stream(spark, source, per_trigger), sink, f"{root}/checkpoint")
    return deltas


def hourly_now(deltas: EpochStore) -> DataFrame:
    """The aggregate as it stands: hours of which every event was taken back are gone."""
    now = deltas.read().groupBy("window_start", "event_type").agg(F.sum("events").alias("events"), F.sum("amount").alias("amount"))
    return now.where("events > 0").select("window_start", "event_type", "events", F.col("amount").cast("double").alias("value_sum"))
