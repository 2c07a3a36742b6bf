"""Long metric table of players (§2.12) and the entries behind it: casts by ability, auras by uptime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import safe_div
from ..functions.labels import difficulty_label
from ..operators.intervals import covered_time
from . import combat as C

KEY = ["report_code", "fight_id", "player_name"]
CONTEXT = ["class_name", "boss_name", "is_boss", "is_kill", "difficulty_label"]
# metric, total and rate columns of the player x fight mart
FROM_MART = [("dps", "damage_done", "dps"), ("hps", "healing_done", "hps"), ("dtps", "damage_taken", "dtps"),
             ("deaths", "deaths", None), ("interrupts", "interrupts", None), ("dispels", "dispels", None),
             ("potion_casts", "potion_casts", None), ("healthstone_casts", "healthstone_casts", None)]
AURA_EVENTS = ["applybuff", "applybuffstack", "removebuffstack", "refreshbuff", "removebuff"]


def _ability_names(b) -> DataFrame:
    return C.silver_abilities(b).groupBy("report_code", "ability_game_id").agg(F.min("name").alias("_name"))


def _named(other: Column | None = None) -> Column:
    names = [F.col("_name"), *([other] if other is not None else []), F.concat(F.lit("ability_"), F.col("ability_game_id").cast("string"))]
    return F.coalesce(*names)


def player_casts(b) -> DataFrame:
    """Casts of a player (pets included) in a fight, by ability; summed by ids before names are looked up."""
    by_id = C.silver_events(b).filter(F.col("event_type") == "cast").groupBy("report_code", "fight_id", F.col("source_id").alias("actor_id"), "ability_game_id").agg(F.count(F.lit(1)).alias("n"))
    named = by_id.join(C._players(C.silver_actors(b)), ["report_code", "actor_id"]).join(_ability_names(b), ["report_code", "ability_game_id"], "left")
    return named.groupBy(*KEY, _named().alias("ability")).agg(F.sum("n").alias("casts"))


def aura_states(b) -> DataFrame:
    """Every aura change on a player, by its source, inside its fight; auras worn at the pull are on from its start."""
    fights = C.silver_fights(b).select("report_code", "fight_id", "start_time_ms", "end_time_ms")
    key = ["report_code", "fight_id", "actor_id", "ability_game_id", "source_id"]
    changes = C.silver_events(b).filter(F.col("event_type").isin(AURA_EVENTS)).select(
        "report_code", "fight_id", F.col("target_id").alias("actor_id"), "ability_game_id", "source_id", F.col("timestamp_ms").alias("ts"),
        F.when(F.col("event_type") == "removebuff", 0).otherwise(1).alias("state"), F.lit(None).cast("string").alias("aura_name"), F.col("stack").cast("int").alias("stack"))
    worn = C.silver_pull_auras(b).select(
        "report_code", "fight_id", F.col("player_actor_id").alias("actor_id"), "ability_game_id", F.col("aura_source_id").alias("source_id"),
        F.lit(None).cast("long").alias("ts"), F.lit(1).alias("state"), "aura_name", F.col("stacks").cast("int").alias("stack"))
    moment = F.greatest("start_time_ms", F.least("end_time_ms", F.coalesce("ts", "start_time_ms")))
    return changes.unionByName(worn).join(fights, ["report_code", "fight_id"]).select(*key, moment.alias("ts"), "state", "end_time_ms", "aura_name", "stack")


def player_buffs(b) -> DataFrame:
    """Time in which a player wore each aura in a fight, whoever cast it, and how many sources and stacks it had at most."""
    own = C.silver_actors(b).filter(F.col("actor_type") == "Player").select("report_code", "actor_id", F.col("resolved_player_name").alias("player_name"))
    up = covered_time(aura_states(b).withColumn("_less", -F.col("stack")), ["report_code", "fight_id", "actor_id", "ability_game_id"], "source_id", end_col="end_time_ms", carry=["aura_name", "_less"])
    named = up.join(own, ["report_code", "actor_id"]).join(_ability_names(b), ["report_code", "ability_game_id"], "left")
    return named.select(*KEY, "ability_game_id", _named(F.col("aura_name")).alias("aura"), F.col("covered").cast("long").alias("uptime_ms"),
                        F.col("most").cast("long").alias("most_sources"), (-F.col("_less")).alias("most_stacks"))


def player_summary(b) -> DataFrame:
    """All that a player did in a fight: events, and the time from the first to the last."""
    by_id = C.silver_events(b).groupBy("report_code", "fight_id", F.col("source_id").alias("actor_id")).agg(F.count(F.lit(1)).alias("n"), F.min("timestamp_ms").alias("a"), F.max("timestamp_ms").alias("z"))
    named = by_id.join(C._players(C.silver_actors(b)), ["report_code", "actor_id"])
    return named.groupBy(*KEY).agg(F.sum("n").alias("events"), (F.max("z") - F.min("a")).alias("active_time_ms"))


def _entries(rows: DataFrame, metric: str, entry: str, total: str) -> DataFrame:
    """The sum over a player's entries, and the largest of them (ties by name)."""
    best = F.min_by(F.struct(F.col(entry).alias("name"), F.col(total).alias("n")), F.struct((-F.col(total)).alias("n"), F.col(entry).alias("name")))
    return rows.groupBy(*KEY).agg(F.sum(total).alias("sum"), best.alias("e")).select(
        *KEY, F.lit(metric).alias("metric"), F.col("sum").cast("double").alias("total"), F.lit(None).cast("long").alias("active_time_ms"), F.col("e.name").alias("entry_name"), F.col("e.n").cast("double").alias("entry_total"))


def metric_long(b) -> DataFrame:
    """One row per (report, fight, player, metric): total, rate per second, and for casts and buffs the largest entry.

    casts: cast events; buffs: milliseconds worn, summed over auras (its rate is the mean number worn); summary: events."""
    perf = C.gold_fight_player_perf(b)
    null = lambda t: F.lit(None).cast(t)
    arr = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(tot).cast("double").alias("total"), (F.col(rate).cast("double") if rate else null("double")).alias("rate")) for m, tot, rate in FROM_MART])
    known = perf.select(*KEY, *CONTEXT, F.explode(arr).alias("m")).select(
        *KEY, *CONTEXT, "m.metric", "m.total", "m.rate", null("long").alias("active_time_ms"), null("string").alias("entry_name"), null("double").alias("entry_total"))
    summary = player_summary(b).select(*KEY, F.lit("summary").alias("metric"), F.col("events").cast("double").alias("total"), "active_time_ms", null("string").alias("entry_name"), null("double").alias("entry_total"))
    more = _entries(player_casts(b), "casts", "ability", "casts").unionByName(_entries(player_buffs(b), "buffs", "aura", "uptime_ms")).unionByName(summary)
    seconds = F.when(F.col("metric") == "buffs", F.col("duration_sec") * 1000).otherwise(F.col("duration_sec"))
    context = C._fight_context(b).select("report_code", "fight_id", F.col("fight_name").alias("boss_name"), "is_boss", "is_kill", difficulty_label("difficulty", "keystone_level").alias("difficulty_label"), "duration_sec")
    classes = C.silver_actors(b).filter(F.col("resolved_actor_type") == "Player").groupBy("report_code", F.col("resolved_player_name").alias("player_name")).agg(F.min("resolved_class").alias("class_name"))
    more = more.join(context, ["report_code", "fight_id"]).join(classes, ["report_code", "player_name"], "left").withColumn("rate", F.bround(safe_div(F.col("total"), seconds), 2))
    return known.unionByName(more.select(*known.columns))


QUERIES = {
    "metric_long": C._b(metric_long),
    "combat_player_casts": C._b(player_casts),
    "combat_player_buffs": C._b(player_buffs),
    "combat_player_summary": C._b(player_summary),
}
