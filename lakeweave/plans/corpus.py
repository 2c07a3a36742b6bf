"""Ad-hoc statements over the stored silver and gold tables (the rest of SURVEY 2.13).

Most are one of a few shapes (top rows of a measure, history of a player, one report), so
they are given by parameters.  A limit is the statement's own top-k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quality import ratio_round
from . import combat as C
from . import metrics as M
from . import combat_ops as O

PLAYER, OWNER, OWNER_ID, BOSS, LEVEL = "player_1", "owner_1", 501, "Queen Ansurek", 12


def _perf(b) -> DataFrame:
    return b.keep("gold_fight_player_perf", C.gold_fight_player_perf)


def _long(b) -> DataFrame:
    return b.keep("metric_long", M.metric_long)


def _consumables(b) -> DataFrame:
    return b.keep("gold_consumables", C.gold_consumables)


def _boss() -> Column:
    return F.col("is_boss") == 1


def _outcome() -> Column:
    return F.when(F.col("is_kill") == 1, "kill").otherwise("wipe").alias("outcome")


def top_rows(df: DataFrame, measure: str, columns: list, n: int, where: Column | None = None) -> DataFrame:
    """The n rows of the largest measure; ties by report, fight and player."""
    df = df if where is None else df.filter(where)
    return df.orderBy(F.desc(measure), "report_code", "fight_id", "player_name").limit(n).select(*columns, measure)


def player_history(df: DataFrame, player: str, columns: list, where: Column, n: int | None = None) -> DataFrame:
    """A player's rows, the newest first."""
    df = df.filter(F.lower("player_name").contains(player.lower()) & where)
    return (df.orderBy(F.desc("report_start_at"), "report_code", "fight_id", "player_name").limit(n) if n else df).select(*columns)


def _with_reports(b, fights: DataFrame) -> DataFrame:
    return fights.join(C.silver_reports(b), "report_code")


def _first_report(b) -> Column:
    """The report that the single-report statements look at: the first by code."""
    return F.col("report_code") == C.silver_reports(b).agg(F.min("report_code")).scalar()


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def boss_deaths_by_player(b):
    d = _perf(b).filter(_boss() & (F.col("deaths") > 0)).groupBy("player_name", "class_name").agg(F.sum("deaths").alias("total_deaths"))
    return d.orderBy(F.desc("total_deaths"), "player_name", "class_name").limit(25)


def raid_deaths(b):
    d = _perf(b).filter(_boss()).groupBy("report_title", "boss_name", "report_code", "fight_id").agg(F.sum("deaths").alias("raid_deaths"))
    return d.orderBy(F.desc("raid_deaths"), "report_code", "fight_id").limit(20).select("report_title", "boss_name", "raid_deaths")


def best_per_boss_of(b, player: str = PLAYER):
    p = _perf(b).filter(_boss() & F.lower("player_name").contains(player))
    key = F.struct("dps", "report_code", "player_name")
    return p.groupBy("boss_name").agg(F.max("dps").alias("best_dps"), F.max_by("raid_or_dungeon", key).alias("zone_name"), F.max_by("report_start_at", key).alias("best_run_date"))


def mythic_plus_players(b, level: int = 10, runs: int = 2):
    p = _perf(b).filter(F.col("keystone_level") >= level)
    g = p.groupBy("player_name", "class_name", "keystone_level").agg(F.bround(F.avg("dps"), 0).alias("avg_dps"), _count("fights")).filter(F.col("fights") >= runs)
    return g.orderBy(F.desc("keystone_level"), F.desc("avg_dps"), "player_name", "class_name").limit(40)


def boss_attempt_durations(b):
    return C.silver_fights(b).filter(_boss()).groupBy("fight_name", "encounter_id").agg(
        _count("attempts"), F.count_if(F.col("is_kill") == 1).alias("kills"),
        ratio_round(F.count_if(F.col("is_kill") == 1) * 100, F.count(F.lit(1)), 1).alias("kill_pct"), F.bround(F.avg("duration_ms") / 1000, 0).alias("avg_duration_sec"))


def guild_activity(b):
    p = _perf(b).join(C.silver_reports(b).select("report_code", "log_source"), "report_code").filter(F.col("log_source") == "guild")
    return p.groupBy("player_name", "class_name").agg(F.count_distinct("report_code").alias("reports"), F.max("report_start_at").alias("last_seen"))


def resolved_damage(b):
    e = C.silver_events(b).filter(F.col("event_type") == "damage").groupBy("report_code", F.col("source_id").alias("actor_id")).agg(_count("n"))
    a = C.silver_actors(b).select("report_code", "actor_id", F.col("resolved_player_name").alias("player_name"), F.col("resolved_actor_type").alias("resolved_type"))
    g = e.join(a, ["report_code", "actor_id"]).groupBy("player_name", "resolved_type").agg(F.sum("n").alias("n"))
    return g.orderBy(F.desc("n"), "player_name", "resolved_type").limit(30)


def details_with_roster(b):
    d = b.player_details.select("report_code", "player_name", "role", "class_name", F.col("max_item_level").cast("int").alias("max_item_level"), "player_guid")
    g = C.silver_roster(b).select("player_guid", "guild_name", "character_name")
    j = d.join(g, "player_guid", "left").orderBy(F.desc("max_item_level"), "report_code", "player_name", "character_name").limit(30)
    return j.select("report_code", "player_name", "role", "class_name", "max_item_level", "player_guid", "guild_name")


def player_boss_dps(b):
    g = _perf(b).filter(_boss() & (F.col("damage_events") > 0)).groupBy("player_name").agg(F.sum("damage_done").alias("d"), F.max("fight_duration_sec").alias("s"))
    return g.select("player_name", F.bround(F.col("d") / F.col("s"), 2).alias("dps"))


def pull_buffs(b):
    a = C.silver_actors(b).select("report_code", F.col("actor_id").alias("player_actor_id"), F.col("name").alias("player"))
    ab = C.silver_abilities(b).select("report_code", "ability_game_id", F.col("name").alias("buff"))
    j = C.silver_pull_auras(b).groupBy("report_code", "player_actor_id", "ability_game_id").agg(_count("n"))
    return j.join(a, ["report_code", "player_actor_id"]).join(ab, ["report_code", "ability_game_id"]).groupBy("player", "buff").agg(F.sum("n").alias("pulls"))


def _on_boss(b, rows):
    """Entries of boss fights, with the boss."""
    fights = C.silver_fights(b).filter(_boss() & (F.col("duration_sec") > 0)).select("report_code", "fight_id", F.col("fight_name").alias("boss_name"))
    return rows.join(fights, ["report_code", "fight_id"])


def top_casts(b, k: int = 40):
    return _on_boss(b, M.player_casts(b)).orderBy(F.desc("casts"), *M.KEY, "ability").limit(k).select("boss_name", "player_name", "ability", "casts")


def top_buffs(b, k: int = 30):
    rows = _on_boss(b, M.player_buffs(b)).filter(F.col("uptime_ms") > 0)
    return rows.orderBy(F.desc("uptime_ms"), *M.KEY, "aura", "ability_game_id").limit(k).select("player_name", "aura", F.bround(F.col("uptime_ms") / 1000, 0).alias("uptime_sec"))


def _fights_of_reports(b):
    return _with_reports(b, C.silver_fights(b))


STATEMENTS = {
    "corpus_top_hps": lambda b: top_rows(_perf(b), "hps", ["report_start_at", "boss_name", "player_name"], 40, _boss()),
    "corpus_top_dispels": lambda b: top_rows(_perf(b), "dispels", ["boss_name", "player_name"], 30, _boss() & (F.col("dispels") > 0)),
    "corpus_top_dtps": lambda b: top_rows(_perf(b), "dtps", ["boss_name", "player_name"], 30, _boss()),
    "corpus_top_interrupts": lambda b: top_rows(_perf(b), "interrupts", ["raid_or_dungeon", "boss_name", "player_name"], 30, _boss()),
    "corpus_one_boss_dps": lambda b: top_rows(_perf(b), "dps", ["report_start_at", "player_name", "class_name", _outcome()], 20, _boss() & (F.col("boss_name") == BOSS)),
    "corpus_dps_by_zone": lambda b: top_rows(_perf(b), "dps", ["raid_or_dungeon", "boss_name", "player_name"], 30, _boss()),
    "corpus_dps_with_item_level": lambda b: top_rows(
        _perf(b), "dps", ["report_start_at", "report_code", "raid_or_dungeon", "boss_name", _outcome(), "player_name", "class_name", "spec_id", "avg_item_level"], 50, _boss()),
    "corpus_mythic_plus_level_top": lambda b: top_rows(_perf(b), "dps", ["report_start_at", "boss_name", "player_name"], 25, F.col("keystone_level") == LEVEL),
    "corpus_top_consumable_casts": lambda b: _consumables(b).filter(_boss() & (F.col("casts") > 0)).orderBy(
        F.desc("casts"), "report_code", "fight_id", "player_name", "consumable_name").limit(40).select("boss_name", "player_name", "consumable_name", "casts"),
    "corpus_buff_uptime": lambda b: _consumables(b).filter(_boss() & (F.col("uptime_sec") > 0)).orderBy(
        F.desc("uptime_sec"), "report_code", "fight_id", "player_name", "consumable_name").limit(30).select("player_name", "consumable_name", "uptime_sec"),
    "corpus_top_casts": top_casts,
    "corpus_top_buffs": top_buffs,
    "corpus_boss_deaths_by_player": boss_deaths_by_player,
    "corpus_raid_deaths": raid_deaths,
    "corpus_player_dps_history": lambda b: player_history(
        _perf(b), PLAYER, ["report_start_at", "raid_or_dungeon", "boss_name", "player_name", _outcome(), F.bround("fight_duration_sec", 0).alias("fight_sec"), "spec_id", "dps", "avg_item_level"], _boss()),
    "corpus_player_hps_history": lambda b: player_history(_perf(b), PLAYER, ["report_start_at", "boss_name", "hps"], F.lit(True), 50),
    "corpus_player_deaths": lambda b: player_history(_perf(b), PLAYER, ["report_title", "boss_name", "player_name", "deaths", _outcome()], F.col("deaths") > 0),
    "corpus_player_best_per_boss": best_per_boss_of,
    "corpus_owner_reports": lambda b: C.silver_reports(b).filter((F.col("owner_user_id") == OWNER_ID) | F.lower("owner_name").contains(OWNER)).select("report_code", "title", "zone_name", "report_start_at"),
    "corpus_metric_counts": lambda b: _long(b).groupBy("metric").agg(_count("rows")),
    "corpus_mythic_plus_list": lambda b: _fights_of_reports(b).filter(F.col("keystone_level") > 0).select(
        "report_start_at", "title", "zone_name", "fight_name", "keystone_level", F.bround("duration_sec", 0).alias("fight_sec"), F.when(F.col("is_kill") == 1, "done").otherwise("wipe").alias("outcome")),
    "corpus_mythic_plus_players": mythic_plus_players,
    "corpus_boss_attempt_durations": boss_attempt_durations,
    "corpus_boss_pulls": lambda b: _fights_of_reports(b).filter(_boss()).orderBy(F.desc("report_start_at"), "report_code", "fight_id").limit(50).select(
        "report_start_at", "title", "fight_name", _outcome(), F.bround("duration_sec", 0).alias("duration_sec"), F.bround("boss_percentage", 1).alias("boss_pct")),
    "corpus_players_per_night": lambda b: _perf(b).groupBy("report_start_at", "raid_or_dungeon", "report_title", "report_code").agg(F.count_distinct("player_name").alias("players")),
    "corpus_report_header": lambda b: C.silver_reports(b).filter(_first_report(b)).select("report_code", "log_source", "owner_name", "title", "zone_name", "report_start_at"),
    "corpus_report_fights": lambda b: C.silver_fights(b).filter(_first_report(b)).select("fight_id", "fight_name", "is_boss", "is_kill", "keystone_level", F.bround("duration_sec", 1).alias("duration_sec")),
    "corpus_report_dps": lambda b: _perf(b).filter(_first_report(b) & _boss()).select("boss_name", "player_name", "dps"),
    "corpus_report_metric_counts": lambda b: _long(b).filter(_first_report(b)).groupBy("metric").agg(_count("rows")),
    "corpus_report_ingestion": lambda b: O._after_run(b).filter(_first_report(b)).select("status", "ingestion_attempts", "last_error"),
    "corpus_guild_activity": guild_activity,
    "corpus_zone_sources": lambda b: C.silver_reports(b).filter(F.col("zone_name").isNotNull()).groupBy("zone_name", "log_source").agg(_count("reports")),
    "corpus_source_counts": lambda b: C.silver_reports(b).groupBy("log_source").agg(_count("reports")),
    "corpus_latest_owners": lambda b: C.silver_reports(b).orderBy(F.desc("report_start_at"), "report_code").limit(25).select("report_code", "owner_name", "title", "zone_name"),
    "corpus_most_fights": lambda b: O.corpus_fights_per_report(b).orderBy(F.desc("fights"), "report_code").limit(20),
    "corpus_resolved_damage": resolved_damage,
    "corpus_details_with_roster": details_with_roster,
    "corpus_player_boss_dps": player_boss_dps,
    "corpus_pull_buffs": pull_buffs,
}


def silver_ingestion_state(b) -> DataFrame:
    """The work queue as read by the dashboards: typed, with a short preview of the error beside nothing cut in the table."""
    return O._after_run(b).select(
        "report_code", "status", "title", F.col("ingestion_attempts").cast("int").alias("ingestion_attempts"), F.timestamp_millis("start_time_ms").alias("report_start_at"),
        "synced_at", F.substring("last_error", 1, 500).alias("last_error_preview"), F.col("last_ingest_points").cast("int").alias("last_ingest_points"), F.col("fetched_at").alias("bronze_fetched_at"))


def lake_tables(b) -> dict:
    """The ten tables of the lake, as stored."""
    from . import payloads as P

    raw = b.keep("reports_raw", P.report_payloads)
    return {
        "ingestion_state": b.keep("ingestion_state", O._after_run), "guild_reports": b.reports, "fights": b.fights, "reports_raw": raw, "master_info": P.master_info(raw),
        "master_actors": b.actors, "master_abilities": b.abilities, "player_details": b.player_details, "events": b.events, "guild_roster": b.roster}


def register_lake_views(b) -> list:
    """One view ``v_<table>`` each, for ad-hoc SQL."""
    tables = lake_tables(b)
    for name, df in tables.items():
        df.createOrReplaceTempView(f"v_{name}")
    return list(tables)


def lake_view_counts(b) -> DataFrame:
    """Volumes of the lake by SQL over its views."""
    return b.spark.sql(" UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n FROM v_{t}" for t in register_lake_views(b)))


STATEMENTS["lake_view_counts"] = lake_view_counts
QUERIES = {name: C._b(build) for name, build in {**STATEMENTS, "combat_silver_ingestion_state": silver_ingestion_state}.items()}
