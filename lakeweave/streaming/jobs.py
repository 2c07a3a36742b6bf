"""Registered stream jobs over landed deliveries derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.combat import Bronze
from ..session import materialize
from ..sources import fixtures as fx
from ..sources.tables import table_path
from . import epochs, refresh
from .incremental import deliver, scratch_root


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


# ------------------------------------------------------------------ T3
def bordered_pages(events: DataFrame) -> DataFrame:
    """Event pages as the API gives them: damage events with an odd number come twice in their page (two
    equal hits), and the last event of a page is delivered again as the first of the report's next page."""
    twins = events.where((F.col("event_type") == "damage") & (F.col("event_index") % 7 == 3)).withColumn("event_index", F.col("event_index") + 1000)
    pages = events.unionByName(twins).withColumn("event_index", F.col("event_index") + 1)
    at = Window.partitionBy("report_code").orderBy("page_index")
    last = pages.groupBy("report_code", "page_index").agg(F.max_by(F.struct(*[c for c in pages.columns if c not in epochs.PLACE]), F.col("event_index")).alias("e"))
    again = last.withColumn("page_index", F.lead("page_index").over(at)).where("page_index is not null").select("report_code", "page_index", F.lit(0).cast("long").alias("event_index"), "e.*")
    return pages.unionByName(again.select(*pages.columns))


def stream_border_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages land in two deliveries, so that most borders lie between two batches, and the first is delivered again."""
    root = scratch_root(spark, "stream-borders")
    pages = materialize(bordered_pages(Bronze(spark, sf_dir).events), "pages")
    parts = [pages.where(part) for part in (F.col("page_index") % 2 == 0, F.col("page_index") % 2 == 1, F.col("page_index") % 2 == 0)]
    deliver(root, parts, lambda source: epochs.ingest_events_once(spark, source, root, ddl(pages)))
    return epochs.given_store(spark, root, ddl(pages)).read().drop("epoch", "content", "page_index", "event_index")


# ------------------------------------------------------------------ maintained aggregate
def stream_hourly_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_root(spark, "stream-hourly")
    glob = table_path(sf_dir, "events").replace("events.parquet", "events*.parquet")
    return epochs.hourly_now(epochs.maintain_hourly(spark, glob, root)).withColumn("value_sum", F.round("value_sum", 2))


def stream_hourly_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries: wrong values, types and hours for every fifth event, then corrections
    with duplicates of what was right, then the rest; the aggregate ends as if only the last had come."""
    root = scratch_root(spark, "stream-corrections")
    events = spark.read.parquet(table_path(sf_dir, "events"))
    five, half = F.col("event_id") % 5 == 0, F.col("event_id") % 2 == 0
    wrong = events.where(five).withColumns({"value": F.col("value") * 3 + 1, "ts": F.col("ts") + F.expr("INTERVAL 5 HOURS"), "event_type": F.lit("view")})
    parts = [wrong.unionByName(events.where(half & ~five)), events.where(five | (F.col("event_id") % 4 == 0)), events.where(~half & ~five)]
    deliver(root, parts, lambda source: epochs.maintain_hourly(spark, source, root))
    return epochs.hourly_now(epochs.delta_store(spark, root)).withColumn("value_sum", F.round("value_sum", 2))


# ------------------------------------------------------------------ T4
def earlier_roster(roster: DataFrame) -> DataFrame:
    """The roster some time ago: members missing, others with another name or rank, and some who have left since."""
    guid = F.col("player_guid")
    here = roster.where(guid % 9 != 0).withColumns({
        "guild_rank": F.when(guid % 6 == 1, F.col("guild_rank") + 1).otherwise(F.col("guild_rank")),
        "character_name": F.when(guid % 7 == 2, F.concat(F.lit("Old"), F.trim("character_name"))).otherwise(F.col("character_name"))})
    left = roster.where(guid % 8 == 3).withColumns({"player_guid": guid + 1, "canonical_id": guid + 2, "log_character_id": F.col("log_character_id") + 1, "character_name": F.concat("character_name", F.lit("2"))})
    return here.unionByName(left)


def _refreshed(spark: SparkSession, sf_dir: str, gold: dict) -> refresh.Lake:
    """Events in two batches under the earlier roster, then the roster of today."""
    root = scratch_root(spark, "refresh")
    b, lake = Bronze(spark, sf_dir), refresh.Lake(spark, f"{root}/lake")
    for name in refresh.BRONZE[1:]:
        lake.replace(name, getattr(b, name))
    before = lake.put_roster(earlier_roster(b.roster), 0)
    deliver(root, [b.events.where(F.col("page_index") % 2 == k) for k in (0, 1)],
            lambda source: refresh.ingest_and_refresh(lake, source, before, f"{root}/checkpoint", gold=gold))
    refresh.apply_roster(lake, b.roster, 1, gold)
    return lake


def stream_gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, refresh.GOLD).read("gold_fight_player_perf")


def stream_silver_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, {}).read("silver_actors").drop("icon")


QUERIES = {
    "stream_border_duplicates": stream_border_duplicates,
    "stream_hourly_event_counts": stream_hourly_event_counts,
    "stream_hourly_corrections": stream_hourly_corrections,
    "stream_gold_refresh": stream_gold_refresh,
    "stream_silver_refresh": stream_silver_refresh,
}
