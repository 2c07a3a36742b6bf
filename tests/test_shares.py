"""A task's share stays the same however large the input: partitions, landings, Python batches, joins."""

import glob

import pandas as pd
from pyspark.sql import functions as F

from lakeweave import session
from lakeweave.plans import climate, reviews, scoring
from lakeweave.sources import records
from lakeweave.streaming import incremental


def test_partitions_follow_the_stored_input_and_go_back(spark, scratch):
    with open(f"{scratch}/lineitem.parquet", "wb") as f:
        f.truncate(10 * session.PARTITION_BYTES)
    own = {k: spark.conf.get(k) for k in (*session.SHARES, "spark.sql.shuffle.partitions")}
    session.prepare(spark, scratch)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "10"
    assert {k: spark.conf.get(k) for k in session.SHARES} == session.SHARES
    session.prepare(spark)
    assert {k: spark.conf.get(k) for k in own} == own
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "300")       # the user's own larger number stays
        session.prepare(spark, scratch)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "300"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own["spark.sql.shuffle.partitions"])
        session.prepare(spark)
    assert {k: spark.conf.get(k) for k in own} == own


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def curated(spark, rows):
    return spark.createDataFrame(rows, "station_id long, station_nom string, date_mesure timestamp_ntz, temp_min double, temp_max double, latitude double, longitude double")


def test_days_are_compared_once_per_year_of_a_station(spark):
    at = lambda y, d: pd.Timestamp(y, 1, d).to_pydatetime()
    rows = [(1, "A", at(2000, 1), 0.0, 10.0, 50.0, 3.0), (1, "A", at(2001, 1), -9.0, 20.0, 51.0, None), (2, "B", at(2001, 1), 1.0, 1.0, None, None),
            (None, "C", at(2001, 1), 1.0, 1.0, 49.0, 2.0), (None, "C", at(2002, 1), 1.0, 1.0, 48.0, 2.5)]
    year = climate.hot_cold_year(curated(spark, rows))
    got = {(r["station_id"], r["annee"]): (r["nb_jours_chauds"], r["nb_jours_froids"], r["latitude"], r["longitude"]) for r in year.collect()}
    assert got == {(1, 2000): (0, 0, 51.0, 3.0), (1, 2001): (1, 1, 51.0, 3.0), (2, 2001): (0, 0, None, None),
                   (None, 2001): (0, 0, None, None), (None, 2002): (0, 0, None, None)}
    assert "Join" not in plan(year)


def test_hours_that_are_none_are_null(spark):
    hours = ["7", "0960", "2359", "2400", "0000", None, "12a4", "99", "-5", "12345"]
    df = spark.createDataFrame([("20240229", h) for h in hours] + [("20230229", "0100"), (None, "0100")], "d string, h string")
    plain = F.try_to_timestamp(F.concat("d", F.lpad("h", 4, "0")), F.lit("yyyyMMddHHmm"))
    got = df.select("h", climate._hour_ts(F.col("d"), F.col("h")).alias("a"), plain.alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] and sum(r["a"] is not None for r in got) >= 3
    assert "CASE WHEN" in plan(df.select(climate._hour_ts(F.col("d"), F.col("h"))))      # told apart before parsing


def test_a_key_is_sorted_once(spark):
    from lakeweave.operators.dedupe import keep_last_rows, together

    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 1), (None, "d", 3), (2, None, 1)], "k long, v string, f int")
    once, twice = (keep_last_rows(x, ["k"], ["f"]) for x in (together(df, ["k"]), df))
    assert plan(once).count("Sort [") == 1 < plan(twice).count("Sort [")      # before they run: the plan stands there once
    assert sorted(once.collect(), key=str) == sorted(twice.collect(), key=str)


def test_deliveries_land_in_many_files_and_are_a_batch_each(spark, scratch):
    batches = []
    rows = spark.range(0, 400_000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), F.sha2((-F.col("id")).cast("string"), 256).alias("t"))
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(1 << 20))

        def ingest(source):
            incremental.run_available_now(incremental.landed_stream(spark, source), lambda b, e: batches.append((e, b.count())), f"{scratch}/checkpoint")

        incremental.deliver(scratch, [rows, rows.where("id < 7"), rows.where("id < 100000")], ingest)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
    assert batches == [(0, 400_000), (1, 7), (2, 100_000)]
    assert len(glob.glob(f"{scratch}/landing/part=0/*.parquet")) > 1


def test_failed_units_are_asked_again_together(spark):
    units = pd.DataFrame({"review_id": range(700), "review_text": ["two words", *["long enough for an answer"] * 699], "model_used": reviews.MODELS[1]})
    calls = []

    def counting(u, attempt):
        calls.append((attempt, len(u)))
        return scoring.rule_scorer(u, attempt)

    columns = [c.split()[0] for c in scoring.RESULT.split(", ")]
    got = pd.concat(scoring._rounds(units, counting, 3, columns))
    assert calls == [(0, 700), (1, 100)]             # not each of 700 by itself
    assert sorted(got["review_id"]) == list(range(700)) and got["attempts"].sum() == 800
    bad = got[~got["ok"].astype(bool)].iloc[0]
    assert (bad["review_id"], bad["code_error"], bad["attempts"], bad["error_text"], bad["sentiment"]) == (0, 422, 1, "ScoringError: text too short", None)
    down = units.assign(model_used=reviews.MODELS[0])
    got = pd.concat(scoring._rounds(down, scoring.rule_scorer, 3, columns))
    assert sorted(got.loc[~got["ok"].astype(bool), "review_id"]) == [0, *range(11, 700, 11)]
    assert set(got.loc[got["code_error"] == 503, "attempts"]) == {3}


def test_a_small_file_of_pages_is_not_one_task(spark):
    pages = spark.createDataFrame([(i, f"<h1>#{i} Name</h1>") for i in range(200)], "page_id long, html string").coalesce(1)
    got = records.detail_records(pages)
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert {r["num"] for r in got.collect()} == {f"{i:03d}" for i in range(200)}
