"""Data-quality job over the gold marts (the dbt schema tests, Q1-Q4).

Each check is one aggregate pass per mart; the result is a small table
(test, model, column, failures) — failing rows are never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..operators.quality import (expect_accepted_values, expect_foreign_key, expect_not_empty, expect_not_null,
                                 expect_unique, union_results)
from . import combat as C
from .reference import sales_daily_kpis, silver_sales
from ..sources import fixtures as fx

# FIXED VALUES: columns under not_null per model, unique and accepted-values tests
SCHEMA_TESTS = {
    "sales_daily_kpis": {"not_null": ["event_date", "region", "total_revenue"]},
    "gold_fight_player_perf": {"not_null": ["report_code", "fight_id", "player_name", "dps", "is_guild_member",
                                            "fight_duration_sec"]},
    "gold_damage_taken": {"not_null": ["report_code", "player_name", "source_name", "damage_taken"]},
    "gold_consumables": {"not_null": ["report_code", "player_name", "consumable_type", "present_at_pull"],
                         "accepted_values": ("consumable_type", ["flask", "food", "augment_rune", "weapon_buff",
                                                                 "potion", "healthstone"])},
    "gold_deaths": {"not_null": ["report_code", "player_name", "death_rank"]},
    "gold_raid_nights": {"not_null": ["report_code", "total_pulls"], "unique": ["report_code"]},
    "gold_attendance_summary": {"not_null": ["player_guid", "character_name", "reports_attended"]},
}


def _marts(spark: SparkSession, sf_dir: str) -> dict:
    b = C.Bronze(spark, sf_dir)
    return {
        "sales_daily_kpis": sales_daily_kpis(silver_sales(fx.sales_lines(spark, sf_dir))),
        "gold_fight_player_perf": C.gold_fight_player_perf(b),
        "gold_damage_taken": C.gold_damage_taken(b),
        "gold_consumables": C.gold_consumables(b),
        "gold_deaths": C.gold_deaths(b),
        "gold_raid_nights": C.gold_raid_nights(b),
        "gold_attendance_summary": C.gold_attendance_summary(b),
    }


def run_schema_tests(marts: dict) -> DataFrame:
    out = []
    for model, tests in SCHEMA_TESTS.items():
        df = marts[model]
        out.append(expect_not_null(df, tests["not_null"], model))
        if "unique" in tests:
            out.append(expect_unique(df, tests["unique"], model))
        if "accepted_values" in tests:
            col, values = tests["accepted_values"]
            out.append(expect_accepted_values(df, col, values, model))
        out.append(expect_not_empty(df, model))
    return union_results([f.select("test", "model", "column_name", "failures") for f in out])


def schema_tests_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the tests run on built tables, as after a dbt run: each mart is materialised once
    built = {k: materialize(v) for k, v in _marts(spark, sf_dir).items()}
    return run_schema_tests(built)


def foreign_key_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: relationships of the lake; pets whose owner isn't in the report are found here."""
    b = C.Bronze(spark, sf_dir)
    reports, fights, actors = C.silver_reports(b), C.silver_fights(b), C.silver_actors(b)
    owner = actors.select("report_code", F.col("pet_owner_id").alias("actor_id"))
    source = C.silver_events(b).select("report_code", F.col("source_id").alias("actor_id"))
    checks = [
        expect_foreign_key(fights, reports, ["report_code"], "fights"),
        expect_foreign_key(C.silver_events(b), fights, ["report_code", "fight_id"], "events"),
        expect_foreign_key(source, actors, ["report_code", "actor_id"], "event_sources"),
        expect_foreign_key(owner, actors, ["report_code", "actor_id"], "pet_owners"),
        expect_foreign_key(C.silver_pull_combatants(b), fights, ["report_code", "fight_id"], "pull_combatants")]
    return union_results([f.select("test", "model", "column_name", "failures") for f in checks])


QUERIES = {"gold_schema_tests": schema_tests_job, "lake_foreign_keys": foreign_key_job}
