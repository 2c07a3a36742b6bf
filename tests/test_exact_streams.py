"""Border duplicates, the maintained aggregate and the roster-driven refresh, on deliveries small enough to follow."""

import glob
import os
from datetime import datetime
from types import SimpleNamespace

from conftest import SF_SMALL
from pyspark.sql import functions as F

from lakeweave.plans import combat as C
from lakeweave.streaming import epochs, jobs, refresh

EVENT = "report_code string, page_index long, event_index long, timestamp_ms long, event_type string, source_id long, event_json string"


def land(df, root, part):
    df.coalesce(1).write.parquet(f"{root}/landing/part={part}")


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_border_event_counts_once_and_equal_hits_count_twice(spark, scratch):
    hit = (5, "damage", 1, '{"amount":7}')
    first = [("R1", 0, 0, 1, "cast", 1, "{}"), ("R1", 0, 1, *hit), ("R1", 0, 2, *hit), ("R2", 0, 0, *hit)]
    # the next page begins with the two hits of the border, in two pieces; a null source is content like any other
    second = [("R1", 1, 0, *hit), ("R1", 1, 2, 9, "death", None, "{}"), ("R1", 1, 3, 9, "death", None, "{}")]
    third = [("R1", 1, 1, *hit), ("R1", 2, 0, 9, "death", None, "{}"), ("R1", 2, 1, 9, "death", None, None)]
    for k, rows in enumerate((first, second, third, first, second)):
        land(spark.createDataFrame(rows, EVENT), scratch, k)
    given = epochs.ingest_events_once(spark, f"{scratch}/landing/part=*", scratch, EVENT, per_trigger=1)
    got = sorted((r["report_code"], r["timestamp_ms"], r["event_type"], str(r["event_json"]), r["occurrence"]) for r in given.read().collect())
    assert got == sorted([("R1", 1, "cast", "{}", 1), ("R1", 5, "damage", hit[3], 1), ("R1", 5, "damage", hit[3], 2), ("R2", 5, "damage", hit[3], 1),
                          ("R1", 9, "death", "{}", 1), ("R1", 9, "death", "{}", 2), ("R1", 9, "death", "None", 1)])
    before = files(f"{scratch}/given")
    epochs.ingest_events_once(spark, f"{scratch}/landing/part=*", scratch, EVENT)  # nothing new
    assert files(f"{scratch}/given").items() >= before.items() and given.read().count() == 7


def test_hours_follow_the_last_delivery_of_each_event(spark, scratch):
    row = "event_id long, ts timestamp, event_type string, value double"
    at = lambda h: datetime(2024, 1, 1, h, 30)
    deliveries = [
        [(1, at(1), "click", 0.1), (2, at(1), "click", 0.2), (3, at(2), "view", None), (4, at(5), "error", 4.0)],
        [(1, at(1), "click", 0.1), (2, at(3), "view", 0.7), (4, at(5), "view", 4.0)],  # a duplicate, another hour and type, another type
        [(2, at(1), "click", 0.3), (5, at(1), "click", 1.0), (5, at(1), "click", 1.0)]]
    for k, rows in enumerate(deliveries):
        land(spark.createDataFrame(rows, row), scratch, k)
    deltas = epochs.maintain_hourly(spark, f"{scratch}/landing/part=*", scratch, per_trigger=1)
    got = {(r["window_start"].hour, r["event_type"]): (r["events"], r["value_sum"]) for r in epochs.hourly_now(deltas).collect()}
    assert got == {(1, "click"): (3, 1.4), (2, "view"): (1, None), (5, "view"): (1, 4.0)}
    assert deltas.read().where("event_type = 'error'").agg(F.sum("events")).first()[0] == 0
    # a batch that is run again writes its own folder anew and no other
    first = files(f"{scratch}/deltas/epoch=0")
    deltas.write(deltas.read().where("epoch = 2").drop("epoch"), 2)
    assert files(f"{scratch}/deltas/epoch=0") == first
    assert {(r["window_start"].hour, r["event_type"]): r["events"] for r in epochs.hourly_now(deltas).collect()} == {k: v[0] for k, v in got.items()}


def test_roster_change_refreshes_its_reports_only(spark, scratch):
    b = C.Bronze(spark, SF_SMALL)
    lake = refresh.Lake(spark, f"{scratch}/lake")
    few = [r[0] for r in b.reports.select("report_code").orderBy("report_code").limit(12).collect()]
    gone, moved = 12, 6  # found by guid and name, and by character id; both play in the first five reports only
    for name in refresh.BRONZE:
        rows = getattr(b, name).where(F.col("report_code").isin(few))
        who = {"actors": "actor_id", "player_details": "player_id"}.get(name)
        lake.replace(name, rows.where(~F.col(who).isin(gone, moved) | F.col("report_code").isin(few[:5])) if who else rows)
    old = lake.put_roster(b.roster, 0)
    gold = {"gold_deaths": C.gold_deaths}
    refresh.refresh(lake, refresh.Touched(lake.read("reports")), old, gold=gold)
    stranger = spark.createDataFrame([(77, "G", "EU", "hyjal", 1_000_000, None, 4242, "Nobody Seen", 1, 80, 1)], old.schema)
    new = old.where(F.trim(F.lower("character_name")) != f"player_{gone}").withColumn(
        "guild_rank", F.when(F.col("log_character_id") == moved, F.lit(99).cast("long")).otherwise(F.col("guild_rank"))).unionByName(stranger)
    was = {name: files(lake.path(name)) for name in ("silver_actors", "silver_player_details", "gold_deaths", "silver_events", "roster_index")}
    touched = refresh.apply_roster(lake, new, 1, gold)
    codes = {r[0] for r in touched.codes.collect()}
    seen = {r[0] for r in lake.read("actors").where(F.col("actor_id").isin(gone, moved)).select("report_code").distinct().collect()}
    assert codes == seen and 0 < len(codes) <= 5
    for name, before in was.items():
        now = files(lake.path(name))
        kept = {f: t for f, t in before.items() if name in ("silver_events", "roster_index") or f.split("report_code=")[1].split("/")[0] not in codes}
        assert kept and kept.items() <= now.items(), name
    whole = SimpleNamespace(**{name: lake.read(name) for name in refresh.BRONZE}, roster=lake.roster(1), land=False)
    for name, build in (("silver_actors", C.silver_actors), ("silver_player_details", C.silver_player_details), ("gold_deaths", C.gold_deaths)):
        want, got = build(whole), lake.read(name)
        got = got.select(*want.columns)
        assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0, name
    assert not refresh.apply_roster(lake, new, 2, gold)  # the same roster again touches nothing


def test_delivered_borders_lie_between_pages(spark):
    events = C.Bronze(spark, SF_SMALL).events
    pages = jobs.bordered_pages(events)
    assert pages.count() > events.count()
    assert pages.groupBy("report_code", "page_index", "event_index").count().where("count > 1").count() == 0
