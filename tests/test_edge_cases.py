"""Hostile inputs: odd numbers, unknown classes, missing gear, catalogue entries without or with a repeated code."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from lakeweave.functions.casts import try_double
from lakeweave.plans import combat as C
from lakeweave.plans import combat_ops as O
from lakeweave.plans import payloads as P
from lakeweave.plans import retail


def test_only_plain_numbers_are_numbers(spark):
    given = {"3": 3.0, " 4.5 ": 4.5, "-2e3": -2000.0, ".5": 0.5, "3d": None, "4f": None, "NaN": None, "inf": None, "-Infinity": None, "1,5": None, "0x1": None, "": None, None: None}
    rows = spark.createDataFrame([(k,) for k in given], "s string").select("s", try_double("s").alias("d")).collect()
    assert {r["s"]: r["d"] for r in rows} == given


def test_odd_numbers_reach_no_total(spark):
    cols = "invoice string, stock_code string, description string, quantity string, invoice_date string, price string, customer_id string, country string"
    rows = [("1", "a", "d", q, "2024-01-01 00:00:00", p, "7", "FR") for q, p in (("2", "1.5"), ("NaN", "1"), ("3d", "1"), ("1", "NaN"), ("1", "inf"))]
    rfm = retail.compute_rfm(retail.clean_orders(spark.createDataFrame(rows, cols))).collect()
    assert [(r["customer_id"], r["monetary"]) for r in rfm] == [("7", 3.0)]


def test_unknown_class_and_missing_gear(spark):
    roster = spark.createDataFrame([(1, "g", "EU", "h", 5, None, 9, "n", c, 80, 1) for c in (1, 13, 14, 0, -3, None)],
                                   "guild_id long, guild_name string, server_region string, server_slug string, log_character_id long, canonical_id long, player_guid long, "
                                   "character_name string, class_id int, character_level int, guild_rank long")
    got = {r["class_id"]: r["class_name"] for r in C.silver_roster(SimpleNamespace(roster=roster)).collect()}
    assert got == {1: "Warrior", 13: "Evoker", 14: None, 0: None, -3: None, None: None}
    events = spark.createDataFrame([("r", 1, 2, 3, "combatantinfo", j) for j in ('{"specID":1}', '{"gear":null,"auras":[]}', '{"gear":[{"itemLevel":500}]}')],
                                   "report_code string, fight_id long, source_id long, timestamp_ms long, event_type string, event_json string")
    got = [(r["gear_count"], r["avg_item_level"], r["auras_count"]) for r in C.silver_pull_combatants(SimpleNamespace(events=events)).collect()]
    assert got == [(0, None, 0), (0, None, 0), (1, 500.0, 0)]


def test_catalogue_refresh_skips_and_reduces(spark):
    cat_schema = "report_code string, title string, start_time_ms long, guild_id long, guild_name string, server_region string, server_slug string"
    cat = spark.createDataFrame([(None, "x", 1, 1, "g", "EU", "s"), ("", "x", 1, 1, "g", "EU", "s"), ("A", "old", 1, 1, "g", "EU", "s"), ("A", "new", 2, None, None, "EU", "s")], cat_schema)
    state = spark.createDataFrame([], O.state_before(C.Bronze(spark, "/root/testdata/sf0.001", land=False)).schema)
    rows = O.refresh_catalogue(state, cat).collect()
    assert [(r["report_code"], r["title"], r["status"]) for r in rows] == [("A", "new", "pending")]
    assert '"guild":{"id":null,"name":null}' in rows[0]["catalog_json"] and '"server_slug":"s"' in rows[0]["catalog_json"]


def test_error_text_is_kept_whole(spark):
    b = C.Bronze(spark, "/root/testdata/sf0.001", land=False)
    errors = O._after_run(b).filter(F.col("last_error").startswith("HTTP 429")).select(F.length("last_error").alias("n")).distinct().collect()
    assert [r["n"] for r in errors] == [3010]


def test_broken_payloads_give_no_rows(spark):
    pages = spark.createDataFrame([("r", 0, p) for p in (
        '{"data":[{"type":"a"},null,7,"{x",{"type":"b","amount":1.50}]}', '{"data":[{"type":"cut"}', '{"data":[{"type":"tail"}]}]', "nonsense", "", None, "[]", '{"data":null}', "{}")],
        "report_code string, page_index long, payload string")
    got = sorted((r["event_index"], r["event_type"], r["event_json"]) for r in P.event_rows(pages).collect())
    assert [g[:2] for g in got] == [(0, "a"), (4, "b")]
    assert got[0][2] == '{"type":"a"}'


def test_pull_rows_of_unresolved_pets_stay(spark):
    b = C.Bronze(spark, "/root/testdata/sf0.001")
    pets = C.gold_fight_player_perf(b).filter(F.col("player_name").startswith("pet_"))
    assert pets.count() > 0
