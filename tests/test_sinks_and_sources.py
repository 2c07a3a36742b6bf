"""Sinks (upsert, replace by group, versioned tables) and text sources."""

import datetime

import pytest
from pyspark.sql import functions as F

from lakeweave.plans.reviews import parse_french_date
from lakeweave.sources.html import extract_reviews
from lakeweave.sources.sinks import (VersionedTable, conform, insert_missing, replace_by_group,
                                     upsert)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_insert_update_and_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert(old, new, ["k"], order=["v"])
    assert _rows(once) == [(1, "a"), (2, "B"), (3, "c")]
    assert _rows(upsert(once, new, ["k"], order=["v"])) == _rows(once)


def test_upsert_keep_last_and_created_at(spark):
    old = spark.createDataFrame([(1, "a", datetime.datetime(2020, 1, 1), None)],
                                "k int, v string, created_at timestamp, updated_at timestamp")
    new = spark.createDataFrame([(1, "x", 1, None, None), (1, "y", 2, None, None)],
                                "k int, v string, seq int, created_at timestamp, updated_at timestamp")
    out = upsert(old, new, ["k"], order=["seq"], created_col="created_at",
                 updated_col="updated_at", run_ts="2024-01-01 00:00:00")
    r = out.first()
    assert r["v"] == "y" and r["created_at"] == datetime.datetime(2020, 1, 1)
    assert r["updated_at"] == datetime.datetime(2024, 1, 1)


def test_replace_by_group_and_insert_missing(spark):
    old = spark.createDataFrame([("r1", 1), ("r1", 2), ("r2", 1)], "g string, x int")
    inc = spark.createDataFrame([("r1", 9)], "g string, x int")
    out = replace_by_group(old, inc, ["g"])
    assert _rows(out) == [("r1", 9), ("r2", 1)]
    assert _rows(replace_by_group(out, inc, ["g"])) == _rows(out)
    assert _rows(replace_by_group(old, inc.limit(0), ["g"])) == _rows(old)
    assert _rows(insert_missing(old, spark.createDataFrame([("r3", 1), ("r1", 1)], "g string, x int"),
                                ["g", "x"])) == [("r1", 1), ("r1", 2), ("r2", 1), ("r3", 1)]


def test_conform_adds_missing_columns(spark):
    target = spark.createDataFrame([], "a int, b string, c double").schema
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    out = conform(df, target)
    assert out.schema == target and out.first()["c"] is None


def test_versioned_table_overwrite_guard_and_replace(spark, scratch):
    t = VersionedTable(spark, scratch + "/state")
    df = spark.createDataFrame([("r1", 1), ("r2", 2)], "report_code string, n int")
    p1 = t.overwrite(df)
    assert t.overwrite(df.limit(0), skip_if_empty=True) == p1
    t.replace_groups(spark.createDataFrame([("r1", 5)], "report_code string, n int"), ["report_code"])
    assert _rows(t.read()) == [("r1", 5), ("r2", 2)]
    t.upsert(spark.createDataFrame([("r3", 3)], "report_code string, n int"), ["report_code"], order=["n"])
    assert t.read().count() == 3


HTML = """<html><ul>
<li id="reviews__item__1" class="skp-review-item">
<div data-global-modal-review-id="u1"></div><p class="skp-review-item__info">  Jean   D. </p>
<span data-rating="4"></span><p class="skp-review-item__date">3 févr. 2024</p>
<p class="skp-review-item__text x">Tr&egrave;s bien &amp; rapide
 merci</p>
<p class="skp-review-moderation__header">R&eacute;ponse de <b>la boutique</b></p>
<div class="skp-review-moderation__text"><p>Merci !</p></div>
<p class="skp-review-moderation__header">Suivi</p>
</li>
<li id="reviews__item__2" class="skp-review-item"><p class="skp-review-item__info">sans id</p></li>
<li id="reviews__item__3" class="skp-review-item">
<div data-global-modal-review-id="u3"></div><p class="skp-review-item__date">31 févr. 2024</p>
</li></ul></html>"""


def test_extract_reviews_edge_cases(spark):
    pages = spark.createDataFrame([(0, HTML)], "page_no long, html string")
    reviews, responses = extract_reviews(pages)
    r = {x["review_uid"]: x for x in reviews.collect()}
    assert set(r) == {"u1", "u3"}                      # block without id dropped
    assert r["u1"]["author"] == "Jean D." and r["u1"]["rating"] == 4
    assert r["u1"]["review_text"] == "Très bien & rapide merci"
    assert r["u3"]["rating"] is None and r["u3"]["review_text"] == ""
    resp = sorted((x["review_uid"], x["response_rank"], x["response_header_raw"], x["response_text_raw"])
                  for x in responses.collect())
    assert resp == [("u1", 1, "Réponse de la boutique", "Merci !"), ("u1", 2, "Suivi", None)]


def test_parse_french_date(spark):
    cases = {"3 févr. 2024": datetime.date(2024, 2, 3), " 12 AOÛT 2023 ": datetime.date(2023, 8, 12),
             "1 déc. 2022": datetime.date(2022, 12, 1), "31 févr. 2024": None, "12 janvier 2024": None,
             "mars 2024": None, None: None, "x mai 2024": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["d"] for r in df.select("s", parse_french_date("s").alias("d")).collect()}
    assert got == cases


def test_stream_ingest_is_idempotent_and_incremental(spark, scratch):
    """Landed files arrive in two rounds; replaying a round changes nothing."""
    from lakeweave.sources import fixtures as fx
    from lakeweave.streaming.incremental import ingest_events_to_bronze

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    land = scratch + "/landing"
    events.filter(F.col("event_id") < 500).write.parquet(land + "/part=1")
    table = VersionedTable(spark, scratch + "/bronze")
    ingest_events_to_bronze(spark, land + "/part=*", table, scratch + "/ckpt")
    first = table.read().count()
    events.filter(F.col("event_id") >= 500).write.parquet(land + "/part=2")
    ingest_events_to_bronze(spark, land + "/part=*", table, scratch + "/ckpt")
    batch = fx.combat_events_bronze(spark, "/root/testdata/sf0.001")
    assert first < table.read().count() == batch.count()
    assert table.read().exceptAll(batch.select(*table.read().columns)).count() == 0
    # replay of everything with a fresh checkpoint: same table
    ingest_events_to_bronze(spark, land + "/part=*", table, scratch + "/ckpt2")
    assert table.read().count() == batch.count()


def test_incremental_silver_refresh_matches_batch(spark, scratch):
    """Two landing rounds split reports across batches; silver equals the batch build."""
    from lakeweave.plans import combat as C
    from lakeweave.streaming.incremental import ingest_and_refresh_silver

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    land = scratch + "/landing"
    # a page (event_id div 100) is the landing unit; reports span both rounds
    events.filter(F.expr("(event_id div 100) % 2 = 0")).write.parquet(land + "/part=1")
    from lakeweave.sources.sinks import BucketedTable
    bronze = BucketedTable(spark, scratch + "/bronze", ["report_code"], buckets=8)
    silver = VersionedTable(spark, scratch + "/silver", cluster_by=["report_code"],
                            sort_by=["report_code", "fight_id", "event_type", "timestamp_ms"])
    ingest_and_refresh_silver(spark, land + "/part=*", bronze, silver, scratch + "/ckpt")
    events.filter(F.expr("(event_id div 100) % 2 = 1")).write.parquet(land + "/part=2")
    ingest_and_refresh_silver(spark, land + "/part=*", bronze, silver, scratch + "/ckpt")
    expected = C.silver_events(C.Bronze(spark, "/root/testdata/sf0.001", land=False))
    got = silver.read()
    assert got.count() == expected.count()
    assert got.exceptAll(expected.select(*got.columns)).count() == 0


def test_append_with_schema_merge(spark, scratch):
    t = VersionedTable(spark, scratch + "/app")
    t.append(spark.createDataFrame([(1,)], "a int"))
    t.append(spark.createDataFrame([(2, "x")], "a int, fetched_at string"))
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, None), (2, "x")]


def test_pages_in_pieces_again_and_grown(spark, scratch):
    """A page delivered twice, over two files, and again with more events keeps every event once."""
    from lakeweave.sources import fixtures as fx
    from lakeweave.streaming.incremental import ingest_events_to_bronze

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter(F.col("event_id") < 200)
    land = scratch + "/landing"
    table = VersionedTable(spark, scratch + "/bronze")
    events.filter("event_id % 2 = 0").write.parquet(land + "/part=1")
    events.filter("event_id % 2 = 0").write.parquet(land + "/part=2")           # delivered twice
    ingest_events_to_bronze(spark, land + "/part=*", table, scratch + "/c")
    events.filter("event_id % 2 = 1 and event_id < 150").write.parquet(land + "/part=3")   # the other half
    ingest_events_to_bronze(spark, land + "/part=*", table, scratch + "/c")
    events.filter("event_id >= 100").write.parquet(land + "/part=4")             # a page again, grown
    ingest_events_to_bronze(spark, land + "/part=*", table, scratch + "/c")
    want = fx.combat_events_bronze(spark, None, events=events)
    assert table.read().count() == want.count()
    assert want.exceptAll(table.read().select(*want.columns)).count() == 0


def test_a_crash_before_the_commit_leaves_the_table(spark, scratch):
    t = VersionedTable(spark, scratch + "/t")
    t.overwrite(spark.createDataFrame([(1,), (2,)], "a int"))
    spark.createDataFrame([(9,)], "a int").write.parquet(scratch + "/t/v=unfinished")   # data without its commit
    assert _rows(t.read()) == [(1,), (2,)]
    t.upsert(spark.createDataFrame([(2,), (3,)], "a int"), ["a"], order=["a"])
    assert _rows(t.read()) == [(1,), (2,), (3,)]


def test_bucketed_table_rewrites_only_touched_buckets(spark, scratch):
    import glob
    import os

    from lakeweave.sources.sinks import BucketedTable

    t = BucketedTable(spark, scratch + "/bt", ["report_code"], buckets=8)
    base = spark.createDataFrame([(f"R{i}", p, i * 10 + p) for i in range(40) for p in range(3)],
                                 "report_code string, page_index int, n int")
    t.replace_groups(base, ["report_code", "page_index"])
    before = {d: os.path.getmtime(d) for d in glob.glob(scratch + "/bt/_bucket=*")}
    inc = spark.createDataFrame([("R1", 0, -1), ("R1", 1, -2)], "report_code string, page_index int, n int")
    touched = t.replace_groups(inc, ["report_code", "page_index"])
    assert len(touched) == 1
    after = {d: os.path.getmtime(d) for d in glob.glob(scratch + "/bt/_bucket=*")}
    changed = [d for d in after if after[d] != before.get(d)]
    assert len(changed) <= 1
    rows = {(r["report_code"], r["page_index"]): r["n"] for r in t.read().collect()}
    assert len(rows) == 120 and rows[("R1", 0)] == -1 and rows[("R1", 2)] == 12 and rows[("R2", 0)] == 20
    t.replace_groups(inc, ["report_code", "page_index"])        # replay: same table
    assert t.read().count() == 120
    t.upsert(spark.createDataFrame([("R99", 0, 5)], "report_code string, page_index int, n int"),
             ["report_code", "page_index"], order=["n"])
    assert t.read().count() == 121
    twice = spark.createDataFrame([("R99", 0, 6), ("R99", 0, 7)], "report_code string, page_index int, n int")
    t.upsert(twice, ["report_code", "page_index"], order=["n"])
    assert [r["n"] for r in t.read().filter("report_code = 'R99'").collect()] == [7]
    with pytest.raises(ValueError):
        t.upsert(twice, ["report_code", "page_index"], order=[])
