"""F2 — combat-log lakehouse: bronze -> silver -> gold marts.

Plan choices for scale (events are the only big input; one report can hold
millions of events, so every key below includes fight and player/actor):
* the player x fight mart reads the events once: each event is emitted for its
  source and its target side, joined to the player dimension once, and all
  metrics are conditional sums of one aggregation (the reference scans the
  events five times and joins eight pre-aggregates);
* the roster match is four equi-joins + a priority pick (no OR join);
* buff uptime is a ``lead`` window per (report, fight, player, ability).
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import safe_div
from ..functions.labels import (BUFF_TYPES, CAST_TYPES, consumable_type, content_type,
                                difficulty_label)
from ..operators.intervals import uptime_from_transitions
from ..operators.joins import any_join_by_priority
from ..sources import fixtures as fx
from ..sources.tables import kept

EVENT_JSON_SCHEMA = T.StructType([
    T.StructField("amount", T.LongType()), T.StructField("unmitigatedAmount", T.LongType()),
    T.StructField("mitigated", T.LongType()), T.StructField("absorbed", T.LongType()),
    T.StructField("overkill", T.LongType()), T.StructField("overheal", T.LongType()),
    T.StructField("hitType", T.IntegerType()), T.StructField("tick", T.BooleanType()),
    T.StructField("melee", T.BooleanType()), T.StructField("stack", T.IntegerType()),
    T.StructField("extraAbilityGameID", T.LongType()), T.StructField("killerID", T.IntegerType()),
])
INFO_SCHEMA = T.StructType([
    T.StructField("specID", T.IntegerType()), T.StructField("faction", T.IntegerType()),
    T.StructField("gear", T.ArrayType(T.StructType([T.StructField("itemLevel", T.LongType())]))),
    T.StructField("auras", T.ArrayType(T.StructType([
        T.StructField("source", T.IntegerType()), T.StructField("ability", T.LongType()),
        T.StructField("stacks", T.IntegerType()), T.StructField("name", T.StringType()),
        T.StructField("icon", T.StringType())]))),
])
# the home guild of the lake (LIKE pattern on the report guild name)
GUILD_LIKE = "%les gardiens%"


class Bronze:
    """The bronze tables of one lake.

    In the lake these are stored tables written by ingestion; here they are
    derived from the driver tables and landed once per session as Parquet in
    the shared checkpoint folder (``spark.checkpoint.dir``), so every
    silver/gold job reads stored bronze with pruned columns and pushed
    filters, as in production.  Events are sorted by report, fight and type
    inside their files."""

    def __init__(self, spark: SparkSession, sf_dir: str, land: bool = True):
        self.spark, self.sf_dir, self.land = spark, sf_dir, land

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        fn = getattr(fx, f"combat_{name}_bronze")
        if not self.land:
            return fn(self.spark, self.sf_dir)

        def build():
            df = fn(self.spark, self.sf_dir)
            return df.sortWithinPartitions("report_code", "fight_id", "event_type", "timestamp_ms") if name == "events" else df
        return kept(self.spark, self.sf_dir, f"bronze-{name}", build)

    def keep(self, name: str, build) -> DataFrame:
        """A silver or gold table of this lake, built once per session and then read as Parquet."""
        return kept(self.spark, self.sf_dir, name, lambda: build(self))


def _stored(build):
    """Gold reads silver tables: a lake that lands its bronze lands its silver too."""
    @wraps(build)
    def table(b):
        return b.keep(build.__name__, build) if getattr(b, "land", False) else build(b)
    return table


# ------------------------------------------------------------------ silver
def silver_reports(b: Bronze) -> DataFrame:
    r = b.reports
    return r.select(
        "report_code", F.col("guild_id").cast("bigint").alias("guild_id"), "guild_name", "server_region",
        "server_slug", "title", "zone_name", "owner_name",
        F.col("owner_user_id").cast("bigint").alias("owner_user_id"), "log_source", "visibility",
        F.timestamp_millis("start_time_ms").alias("report_start_at"),
        F.timestamp_millis("end_time_ms").alias("report_end_at"))


def silver_fights(b: Bronze) -> DataFrame:
    f = b.fights
    enc = F.coalesce(F.col("encounter_id"), F.lit(0)).cast("int")
    return f.select(
        "report_code", F.col("fight_id").cast("int").alias("fight_id"), enc.alias("encounter_id"),
        "fight_name", F.col("start_time_ms").cast("bigint").alias("start_time_ms"),
        F.col("end_time_ms").cast("bigint").alias("end_time_ms"),
        F.col("duration_ms").cast("bigint").alias("duration_ms"),
        (F.col("duration_ms").cast("double") / 1000.0).alias("duration_sec"),
        F.col("kill").cast("int").alias("is_kill"),
        F.col("difficulty").cast("int").alias("difficulty"), F.col("size").cast("int").alias("raid_size"),
        F.col("boss_percentage").cast("double").alias("boss_percentage"),
        F.col("keystone_level").cast("int").alias("keystone_level"),
        F.col("keystone_time_ms").cast("bigint").alias("keystone_time_ms"),
        (enc != 0).cast("int").alias("is_boss"))


@_stored
def silver_events(b: Bronze) -> DataFrame:
    e = b.events.filter(F.col("event_type") != "combatantinfo")
    j = F.from_json("event_json", EVENT_JSON_SCHEMA)
    return e.select(
        "report_code", F.coalesce(F.col("fight_id").cast("int"), F.lit(0)).alias("fight_id"),
        F.col("timestamp_ms").cast("bigint").alias("timestamp_ms"), "event_type",
        F.col("source_id").cast("int").alias("source_id"),
        F.col("source_instance").cast("int").alias("source_instance"),
        F.col("target_id").cast("int").alias("target_id"),
        F.col("target_instance").cast("int").alias("target_instance"),
        F.col("ability_game_id").cast("bigint").alias("ability_game_id"), j.alias("_j"),
    ).select("*", F.col("_j.amount").alias("amount"), F.col("_j.unmitigatedAmount").alias("unmitigated_amount"),
             F.col("_j.mitigated").alias("mitigated"), F.col("_j.absorbed").alias("absorbed"),
             F.col("_j.overkill").alias("overkill"), F.col("_j.overheal").alias("overheal"),
             F.col("_j.hitType").alias("hit_type"), F.col("_j.tick").alias("is_tick"),
             F.col("_j.melee").alias("is_melee"), F.col("_j.stack").alias("stack"),
             F.col("_j.extraAbilityGameID").alias("extra_ability_game_id"),
             F.col("_j.killerID").alias("killer_id")).drop("_j")


def silver_abilities(b: Bronze) -> DataFrame:
    a = b.abilities.filter(F.col("ability_game_id").isNotNull())
    return a.select("report_code", F.col("ability_game_id").cast("bigint").alias("ability_game_id"),
                    "name", "ability_type", "icon")


def silver_roster(b: Bronze) -> DataFrame:
    r = b.roster
    out = r.select(
        F.col("guild_id").cast("bigint").alias("guild_id"), "guild_name", "server_region", "server_slug",
        F.col("log_character_id").cast("bigint").alias("log_character_id"),
        F.col("canonical_id").cast("bigint").alias("canonical_id"),
        F.col("player_guid").cast("bigint").alias("player_guid"), "character_name",
        F.col("class_id").cast("int").alias("class_id"),
        F.when(F.col("class_id") > 0, F.try_element_at(F.array(*[F.lit(n) for n in fx.CLASS_NAMES]), F.col("class_id").cast("int"))).alias("class_name"),
        F.col("character_level").cast("int").alias("character_level"),
        F.col("guild_rank").cast("int").alias("guild_rank"))
    return out.filter((F.col("character_name") != "") & F.col("player_guid").isNotNull()
                      & (F.col("player_guid") > 0))


def _norm(c):
    return F.lower(F.trim(c))


def _roster_flags(df: DataFrame) -> DataFrame:
    return df.withColumn("is_guild_member", F.when(
        F.col("roster_character_name").isNotNull() & (F.col("roster_character_name") != ""), 1).otherwise(0))


def resolved_actors(b: Bronze) -> DataFrame:
    """Actors with their pet's owner resolved, before the roster is matched."""
    a = b.actors.select(
        "report_code", F.col("actor_id").cast("int").alias("actor_id"),
        F.col("game_id").cast("bigint").alias("game_id"), "name", "actor_type", "sub_type",
        F.col("pet_owner_id").cast("int").alias("pet_owner_id"), "server", "icon")
    # owner side renamed entirely: a self-join must not share column names
    o = a.select(F.col("report_code").alias("_orc"), F.col("actor_id").alias("_oid"),
                 F.col("name").alias("_oname"), F.col("actor_type").alias("_otype"),
                 F.col("sub_type").alias("_osub"), F.col("game_id").alias("_ogame"))
    r = a.join(o, (F.col("report_code") == F.col("_orc")) & (F.col("pet_owner_id") == F.col("_oid")), "left")
    rtype = F.coalesce("_otype", "actor_type")
    return r.select(*a.columns,
                    F.coalesce("_oname", "name").alias("resolved_player_name"),
                    rtype.alias("resolved_actor_type"),
                    F.coalesce("_osub", "sub_type").alias("resolved_class"),
                    F.when(rtype == "Player", F.coalesce("_ogame", "game_id")).alias("player_guid"))


def actor_matches() -> list:
    """The four ways an actor is found in the roster, strongest first."""
    return [
        [(F.col("player_guid"), "player_guid")],
        [(F.col("player_guid"), "canonical_id")],
        [F.col("resolved_actor_type") == "Player", (F.col("actor_id").cast("bigint"), "log_character_id")],
        [F.col("resolved_player_name") != "",
         (_norm(F.col("resolved_player_name")), _norm(F.col("character_name"))),
         (_norm(F.col("server")), _norm(F.col("server_slug")))],
    ]


@_stored
def silver_actors(b: Bronze) -> DataFrame:
    joined = any_join_by_priority(
        resolved_actors(b), silver_roster(b), ["report_code", "actor_id"], actor_matches(),
        pick=["character_name", "player_guid"], take=["character_name", "guild_name", "guild_rank"], prefix="_gr_")
    joined = joined.withColumnsRenamed({"_gr_character_name": "roster_character_name",
                                        "_gr_guild_name": "player_guild_name", "_gr_guild_rank": "guild_rank"})
    return _roster_flags(joined)


def plain_player_details(b: Bronze) -> DataFrame:
    """Player details before the roster is matched."""
    return b.player_details.select(
        "report_code", "role", F.col("player_id").cast("int").alias("player_actor_id"),
        F.col("player_guid").cast("bigint").alias("player_guid"), "player_name", "server", "region",
        "class_name", F.col("min_item_level").cast("int").alias("min_item_level"),
        F.col("max_item_level").cast("int").alias("max_item_level"),
        F.col("potion_use").cast("int").alias("potion_use"),
        F.col("healthstone_use").cast("int").alias("healthstone_use"))


def detail_matches() -> list:
    """The four ways a row of player details is found in the roster, strongest first."""
    return [
        [(F.col("player_guid"), "player_guid")],
        [(F.col("player_guid"), "canonical_id")],
        [(F.col("player_actor_id").cast("bigint"), "log_character_id")],
        [F.col("player_name") != "",
         (_norm(F.col("player_name")), _norm(F.col("character_name"))),
         (_norm(F.col("server")), _norm(F.col("server_slug")))],
    ]


@_stored
def silver_player_details(b: Bronze) -> DataFrame:
    joined = any_join_by_priority(
        plain_player_details(b), silver_roster(b), ["report_code", "role", "player_actor_id"], detail_matches(),
        pick=["character_name", "player_guid"], take=["character_name", "guild_name", "guild_rank"], prefix="_gr_")
    joined = joined.withColumnsRenamed({"_gr_character_name": "roster_character_name",
                                        "_gr_guild_name": "player_guild_name", "_gr_guild_rank": "guild_rank"})
    return _roster_flags(joined)


def _combatantinfo(b: Bronze) -> DataFrame:
    e = b.events.filter(F.col("event_type") == "combatantinfo")
    return e.select("report_code", F.col("fight_id").cast("int").alias("fight_id"),
                    F.col("source_id").cast("int").alias("player_actor_id"),
                    F.col("timestamp_ms").cast("bigint").alias("pull_timestamp_ms"),
                    F.from_json("event_json", INFO_SCHEMA).alias("_j"))


@_stored
def silver_pull_combatants(b: Bronze) -> DataFrame:
    ci = _combatantinfo(b)
    ilvls = F.filter(F.transform(F.col("_j.gear"), lambda g: g["itemLevel"]), lambda x: x > 1)
    ci = ci.withColumn("_il", ilvls)
    avg = safe_div(F.aggregate("_il", F.lit(0).cast("bigint"), lambda acc, x: acc + x), F.size("_il"))
    return ci.select(
        "report_code", "fight_id", "player_actor_id", "pull_timestamp_ms",
        F.col("_j.specID").alias("spec_id"), F.col("_j.faction").alias("faction"),
        F.when(F.size("_il") > 0, F.bround(avg, 1)).alias("avg_item_level"),
        F.coalesce(F.size("_il"), F.lit(0)).alias("gear_count"), F.coalesce(F.size("_j.auras"), F.lit(0)).alias("auras_count"))


@_stored
def silver_pull_auras(b: Bronze) -> DataFrame:
    ci = _combatantinfo(b)
    return ci.select("report_code", "fight_id", "player_actor_id",
                     F.explode("_j.auras").alias("a")).select(
        "report_code", "fight_id", "player_actor_id", F.col("a.source").alias("aura_source_id"),
        F.col("a.ability").alias("ability_game_id"), F.col("a.stacks").alias("stacks"),
        F.nullif(F.col("a.name"), F.lit("")).alias("aura_name"),
        F.nullif(F.col("a.icon"), F.lit("")).alias("aura_icon"))


def guild_flags(b: Bronze, actors: DataFrame | None = None, details: DataFrame | None = None,
                with_roster_name: bool = True) -> DataFrame:
    """U1 + A4: one flag row per (report, player) from details and resolved actors."""
    actors = actors if actors is not None else silver_actors(b)
    details = details if details is not None else silver_player_details(b)
    src1 = details.select("report_code", "player_name", F.col("is_guild_member").alias("g"),
                          F.col("player_guild_name").alias("gn"), F.col("roster_character_name").alias("rn"),
                          F.col("role").alias("ro"))
    src2 = (actors.filter((F.col("resolved_actor_type") == "Player") & (F.col("resolved_player_name") != ""))
                  .select("report_code", F.col("resolved_player_name").alias("player_name"),
                          F.col("is_guild_member").alias("g"), F.col("player_guild_name").alias("gn"),
                          F.col("roster_character_name").alias("rn"), F.lit(None).cast("string").alias("ro")))
    aggs = [F.max("g").alias("is_guild_member"),
            F.min(F.when(F.col("g") == 1, F.col("gn"))).alias("player_guild_name")]
    if with_roster_name:
        aggs.append(F.min(F.when(F.col("g") == 1, F.col("rn"))).alias("roster_character_name"))
    aggs.append(F.min(F.when(F.col("ro").isNotNull() & (F.col("ro") != ""), F.col("ro"))).alias("role"))
    return src1.unionByName(src2).groupBy("report_code", "player_name").agg(*aggs)


# ------------------------------------------------------------------ gold helpers
def _fight_context(b: Bronze) -> DataFrame:
    """Fights with duration > 0 joined to their report (a small dimension)."""
    f = silver_fights(b).filter(F.col("duration_sec") > 0)
    r = silver_reports(b)
    return f.join(r, "report_code")


def _context_cols():
    return [
        F.col("report_start_at"), F.to_date("report_start_at").alias("report_date"),
        F.col("report_code"), F.col("guild_name").alias("report_guild_name"),
        F.col("zone_name").alias("raid_or_dungeon"), F.col("fight_id"),
        F.col("fight_name").alias("boss_name"), F.col("is_boss"), F.col("is_kill"),
        difficulty_label("difficulty", "keystone_level").alias("difficulty_label"),
    ]


def consumable_abilities(b: Bronze) -> DataFrame:
    a = silver_abilities(b).groupBy("report_code", "ability_game_id").agg(F.min("name").alias("ability_name"))
    a = a.withColumn("consumable_type", consumable_type("ability_name"))
    return a.filter(F.col("consumable_type") != "")


def _players(actors: DataFrame) -> DataFrame:
    return actors.filter(F.col("resolved_actor_type") == "Player").select(
        "report_code", "actor_id", F.col("resolved_player_name").alias("player_name"))


# ------------------------------------------------------------------ gold marts
def gold_fight_player_perf(b: Bronze) -> DataFrame:
    actors = silver_actors(b)
    players = _players(actors)
    ev = silver_events(b).filter(F.col("event_type").isin(
        "damage", "heal", "absorbed", "interrupt", "dispel", "cast", "death"))
    cons = consumable_abilities(b).select("report_code", "ability_game_id", "consumable_type")
    ev = ev.join(cons, ["report_code", "ability_game_id"], "left")
    sides = ev.select(
        "report_code", "fight_id", "event_type", "amount", "absorbed", "overheal", "hit_type",
        "consumable_type",
        # the target side only matters for damage taken and deaths
        F.explode(F.array(
            F.struct(F.lit("s").alias("side"), F.col("source_id").alias("actor_id")),
            F.when(F.col("event_type").isin("damage", "death"),
                   F.struct(F.lit("t").alias("side"), F.col("target_id").alias("actor_id"))))).alias("_x"))
    sides = sides.select("*", F.col("_x.side").alias("side"), F.col("_x.actor_id").alias("actor_id")).drop("_x")
    sides = sides.filter(F.col("actor_id").isNotNull())    # no side, or no actor on that side
    ev_rows = sides.join(players, ["report_code", "actor_id"]).withColumns(
        {"spec_id": F.lit(None).cast("int"), "avg_item_level": F.lit(None).cast("double")})
    pc = silver_pull_combatants(b).withColumnRenamed("player_actor_id", "actor_id")
    # pull information keeps every actor: an unresolved pet has a row of its own
    everyone = actors.select("report_code", "actor_id", F.col("resolved_player_name").alias("player_name"))
    pull_rows = pc.join(everyone, ["report_code", "actor_id"]).select(
        "report_code", "fight_id", F.lit("pull").alias("event_type"), F.lit(None).cast("bigint").alias("amount"),
        F.lit(None).cast("bigint").alias("absorbed"), F.lit(None).cast("bigint").alias("overheal"),
        F.lit(None).cast("int").alias("hit_type"), F.lit(None).cast("string").alias("consumable_type"),
        F.lit("p").alias("side"), "actor_id", "player_name", "spec_id", "avg_item_level")
    rows = ev_rows.unionByName(pull_rows)
    s, t, p = F.col("side") == "s", F.col("side") == "t", F.col("side") == "p"
    et = F.col("event_type")
    dmg, heal = et == "damage", et.isin("heal", "absorbed")
    amt = F.coalesce(F.col("amount"), F.lit(0))
    agg = rows.groupBy("report_code", "fight_id", "player_name").agg(
        F.sum(F.when(s & dmg, amt)).alias("damage_done"),
        F.count_if(s & dmg & (F.col("hit_type") == 2)).alias("crit_hits"),
        F.count_if(s & dmg).alias("damage_events"),
        F.sum(F.when(t & dmg, amt)).alias("damage_taken"),
        F.sum(F.when(t & dmg, F.coalesce(F.col("absorbed"), F.lit(0)))).alias("damage_absorbed"),
        F.count_if(t & dmg).alias("hits_taken"),
        F.sum(F.when(s & heal, amt)).alias("healing_done"),
        F.sum(F.when(s & heal, F.coalesce(F.col("overheal"), F.lit(0)))).alias("overheal"),
        F.count_if(s & heal).alias("_heal_events"),
        F.count_if(t & (et == "death")).alias("deaths"),
        F.count_if(s & (et == "interrupt")).alias("interrupts"),
        F.count_if(s & (et == "dispel")).alias("dispels"),
        F.count_if(s & (et == "cast") & (F.col("consumable_type") == "potion")).alias("potion_casts"),
        F.count_if(s & (et == "cast") & (F.col("consumable_type") == "healthstone")).alias("healthstone_casts"),
        F.min(F.when(p, F.col("spec_id"))).alias("spec_id"),
        F.min(F.when(p, F.col("avg_item_level"))).alias("avg_item_level"),
        F.count_if(p).alias("_pulls"),
    )
    spine = agg.filter((F.col("damage_events") > 0) | (F.col("hits_taken") > 0)
                       | (F.col("_heal_events") > 0) | (F.col("_pulls") > 0))
    dim = (actors.filter(F.col("resolved_actor_type") == "Player")
                 .groupBy("report_code", F.col("resolved_player_name").alias("player_name"))
                 .agg(F.min("player_guid").alias("player_guid"), F.min("resolved_class").alias("class_name")))
    gf = guild_flags(b, actors=actors, with_roster_name=False)
    ctx = _fight_context(b)
    out = (spine.join(ctx, ["report_code", "fight_id"])
                .join(dim, ["report_code", "player_name"], "left")
                .join(gf, ["report_code", "player_name"], "left"))
    dur = F.col("duration_sec")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select(
        "report_start_at", F.to_date("report_start_at").alias("report_date"),
        F.timestamp_add("MILLISECOND", F.col("start_time_ms"), F.col("report_start_at")).alias("fight_start_at"),
        "report_code", F.col("guild_name").alias("report_guild_name"), F.col("title").alias("report_title"),
        F.col("zone_name").alias("raid_or_dungeon"), "fight_id", F.col("fight_name").alias("boss_name"),
        "is_boss", "is_kill", "difficulty",
        difficulty_label("difficulty", "keystone_level").alias("difficulty_label"),
        "keystone_level", "boss_percentage", dur.alias("fight_duration_sec"),
        content_type("keystone_level", "is_boss").alias("content_type"),
        "player_name", "player_guid", "class_name", "spec_id", "avg_item_level", "role",
        F.coalesce(F.col("is_guild_member"), F.lit(0)).alias("is_guild_member"), "player_guild_name",
        F.when(F.lower(F.coalesce(F.col("guild_name"), F.lit(""))).like(GUILD_LIKE), 1).otherwise(0)
         .alias("is_home_guild_report"),
        z("damage_done").alias("damage_done"), F.bround(safe_div(z("damage_done"), dur), 0).alias("dps"),
        z("crit_hits").alias("crit_hits"), z("damage_events").alias("damage_events"),
        z("damage_taken").alias("damage_taken"), F.bround(safe_div(z("damage_taken"), dur), 0).alias("dtps"),
        z("damage_absorbed").alias("damage_absorbed"), z("hits_taken").alias("hits_taken"),
        z("healing_done").alias("healing_done"), F.bround(safe_div(z("healing_done"), dur), 0).alias("hps"),
        z("overheal").alias("overheal"), z("deaths").alias("deaths"), z("interrupts").alias("interrupts"),
        z("dispels").alias("dispels"), z("potion_casts").alias("potion_casts"),
        z("healthstone_casts").alias("healthstone_casts"))


def gold_damage_taken(b: Bronze) -> DataFrame:
    actors = silver_actors(b)
    ev = silver_events(b).filter(F.col("event_type") == "damage")
    tgt = actors.filter(F.col("resolved_actor_type") == "Player").select(
        "report_code", F.col("actor_id").alias("target_id"), F.col("resolved_player_name").alias("player_name"),
        "player_guid", F.col("resolved_class").alias("class_name"))
    src = actors.select("report_code", F.col("actor_id").alias("source_id"), F.col("name").alias("_src_name"),
                        F.col("sub_type").alias("_src_type"))
    ab = silver_abilities(b).select("report_code", "ability_game_id", F.col("name").alias("_ab_name"))
    gf = guild_flags(b, actors=actors, with_roster_name=False).select("report_code", "player_name", "is_guild_member")
    amt = F.coalesce(F.col("amount"), F.lit(0))
    # events are summed by their ids first; names are joined to the small result
    ids = ["report_code", "fight_id", "target_id", "source_id", "ability_game_id"]
    by_id = ev.groupBy(*ids).agg(
        F.sum(amt).alias("damage_taken"), F.sum(F.coalesce(F.col("absorbed"), F.lit(0))).alias("damage_absorbed"),
        F.sum(F.coalesce(F.col("unmitigated_amount"), F.lit(0))).alias("unmitigated_damage"),
        F.count(F.lit(1)).alias("hits"),
        F.count_if(F.coalesce(F.col("overkill"), F.lit(0)) > 0).alias("killing_hits"),
        F.max(amt).alias("max_hit"))
    j = (by_id.join(tgt, ["report_code", "target_id"])
              .join(src, ["report_code", "source_id"], "left")
              .join(ab, ["report_code", "ability_game_id"], "left"))
    j = j.withColumns({
        "source_name": F.coalesce(F.col("_src_name"), F.lit("(inconnu)")),
        "source_type": F.coalesce(F.col("_src_type"), F.lit("")),
        "ability_name": F.coalesce(F.col("_ab_name"),
                                   F.concat(F.lit("ability_"), F.col("ability_game_id").cast("string")))})
    keys = ["report_code", "fight_id", "player_name", "player_guid", "class_name", "source_name", "source_type", "ability_name"]
    named = j.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("damage_taken", "damage_absorbed", "unmitigated_damage", "hits", "killing_hits")),
                                 F.max("max_hit").alias("max_hit"))
    g = (named.join(_fight_context(b), ["report_code", "fight_id"])
              .join(gf, ["report_code", "player_name"], "left")
              .withColumn("is_guild_member", F.coalesce(F.col("is_guild_member"), F.lit(0))))
    return g.select(
        "report_start_at", F.to_date("report_start_at").alias("report_date"), "report_code",
        F.col("guild_name").alias("report_guild_name"), F.col("zone_name").alias("raid_or_dungeon"),
        "fight_id", F.col("fight_name").alias("boss_name"), "is_boss", "is_kill",
        difficulty_label("difficulty", "keystone_level").alias("difficulty_label"), "keystone_level",
        F.col("duration_sec").alias("fight_duration_sec"), "player_name", "player_guid", "class_name",
        "is_guild_member", "source_name", "source_type", "ability_name", "damage_taken",
        F.bround(safe_div(F.col("damage_taken"), F.col("duration_sec")), 0).alias("dtps"),
        "damage_absorbed", "unmitigated_damage", "hits", "killing_hits", "max_hit")


def gold_deaths(b: Bronze) -> DataFrame:
    actors = silver_actors(b)
    ev = silver_events(b).filter(F.col("event_type") == "death")
    tgt = actors.filter(F.col("resolved_actor_type") == "Player").select(
        "report_code", F.col("actor_id").alias("target_id"), F.col("resolved_player_name").alias("player_name"),
        "player_guid", F.col("resolved_class").alias("class_name"))
    killer = actors.select("report_code", F.col("actor_id").alias("killer_id"), F.col("name").alias("killer_name"))
    ab = silver_abilities(b).select("report_code", "ability_game_id", F.col("name").alias("killing_ability"))
    gf = guild_flags(b, actors=actors, with_roster_name=False).select("report_code", "player_name", "is_guild_member")
    j = (ev.join(tgt, ["report_code", "target_id"])
           .join(_fight_context(b), ["report_code", "fight_id"])
           .join(ab, ["report_code", "ability_game_id"], "left")
           .join(killer, ["report_code", "killer_id"], "left")
           .join(gf, ["report_code", "player_name"], "left"))
    w = F.row_number().over(Window.partitionBy("report_code", "fight_id").orderBy("timestamp_ms", "player_name"))
    rel = F.col("timestamp_ms") - F.col("start_time_ms")
    return j.select(*_context_cols(), F.col("duration_sec").alias("fight_duration_sec"), "player_name", "player_guid", "class_name",
                    F.coalesce(F.col("is_guild_member"), F.lit(0)).alias("is_guild_member"),
                    F.bround(rel / 1000.0, 1).alias("death_at_sec"),
                    F.bround(safe_div(rel * 100.0, F.col("duration_ms")), 1).alias("death_at_pct_of_fight"),
                    w.alias("death_rank"), "killing_ability", "killer_name")


def gold_raid_nights(b: Bronze) -> DataFrame:
    f = silver_fights(b).filter(F.col("duration_sec") > 0)
    boss = F.col("is_boss") == 1
    fs = f.groupBy("report_code").agg(
        F.count(F.lit(1)).alias("total_pulls"), F.count_if(boss).alias("boss_pulls"),
        F.count_if(boss & (F.col("is_kill") == 1)).alias("boss_kills"),
        F.count_if(boss & (F.col("is_kill") == 0)).alias("boss_wipes"),
        F.count_distinct(F.when(boss, F.col("fight_name"))).alias("distinct_bosses"),
        F.count_if(F.coalesce(F.col("keystone_level"), F.lit(0)) > 0).alias("mythic_plus_runs"),
        F.bround(F.sum("duration_sec") / 60.0, 1).alias("combat_minutes"),
        F.bround(F.avg(F.when(boss, F.col("duration_sec"))), 0).alias("avg_boss_pull_sec"),
        F.min(F.when(boss & (F.col("is_kill") == 0), F.col("boss_percentage"))).alias("best_wipe_boss_pct"))
    gf = guild_flags(b, with_roster_name=False)
    rs = gf.groupBy("report_code").agg(
        F.count_distinct("player_name").alias("players_total"),
        F.count_distinct(F.when(F.col("is_guild_member") == 1, F.col("player_name"))).alias("players_guild"))
    il = silver_player_details(b).groupBy("report_code").agg(
        F.bround(F.avg("max_item_level"), 1).alias("avg_max_item_level"))
    r = silver_reports(b)
    j = r.join(fs, "report_code").join(rs, "report_code", "left").join(il, "report_code", "left")
    hours = (F.unix_millis("report_end_at") - F.unix_millis("report_start_at")) / 3600000.0
    return j.select(
        "report_start_at", F.to_date("report_start_at").alias("report_date"), "report_code",
        F.col("title").alias("report_title"), F.col("guild_name").alias("report_guild_name"),
        F.when(F.lower(F.coalesce(F.col("guild_name"), F.lit(""))).like(GUILD_LIKE), 1).otherwise(0)
         .alias("is_home_guild_report"),
        F.col("zone_name").alias("raid_or_dungeon"), F.bround(hours, 2).alias("report_hours"),
        "total_pulls", "boss_pulls", "boss_kills", "boss_wipes", "distinct_bosses", "mythic_plus_runs",
        "combat_minutes", "avg_boss_pull_sec", "best_wipe_boss_pct",
        F.bround(safe_div(F.col("boss_kills") * 100.0, F.col("boss_pulls")), 1).alias("boss_kill_rate_pct"),
        "players_total", "players_guild", "avg_max_item_level")


def gold_attendance_summary(b: Bronze) -> DataFrame:
    """Re-aimed attendance: per roster member, reports attended out of all reports.

    The reference emits roster x reports (a cartesian product); the same KPI is
    computed here from the participation pairs that exist plus one scalar
    (number of reports), so the output grows with members, not members x reports.
    """
    roster = (silver_roster(b).groupBy("player_guid")
              .agg(F.min("character_name").alias("character_name"), F.min("class_name").alias("class_name"),
                   F.min("guild_rank").alias("guild_rank")))
    part = (silver_player_details(b).filter(F.col("player_guid").isNotNull())
            .select("report_code", "player_guid").distinct())
    attended = part.groupBy("player_guid").agg(F.count(F.lit(1)).alias("reports_attended"),
                                               F.max("report_code").alias("last_report_code"))
    n_reports = silver_reports(b).agg(F.count_distinct("report_code")).scalar()
    out = roster.join(attended, "player_guid", "left")
    return out.select("player_guid", "character_name", "class_name", "guild_rank",
                      F.coalesce(F.col("reports_attended"), F.lit(0)).alias("reports_attended"),
                      n_reports.alias("reports_total"), "last_report_code").withColumn(
        "attendance_pct", F.bround(safe_div(F.col("reports_attended") * 100.0, F.col("reports_total")), 1))


def gold_consumables(b: Bronze) -> DataFrame:
    ca = consumable_abilities(b)
    fights = silver_fights(b).select("report_code", "fight_id", "start_time_ms", "end_time_ms")
    ev = silver_events(b)
    buff_changes = (ev.filter(F.col("event_type").isin("applybuff", "refreshbuff", "removebuff"))
                      .join(ca.filter(F.col("consumable_type").isin(*BUFF_TYPES)), ["report_code", "ability_game_id"])
                      .select("report_code", "fight_id", F.col("target_id").alias("player_actor_id"),
                              "ability_game_id", "ability_name", "consumable_type",
                              F.col("timestamp_ms").alias("ts"),
                              F.when(F.col("event_type") == "removebuff", 0).otherwise(1).alias("state")))
    pa = silver_pull_auras(b)
    seeds = (pa.join(fights, ["report_code", "fight_id"])
               .join(ca.select("report_code", "ability_game_id", F.col("ability_name").alias("_ca_name")),
                     ["report_code", "ability_game_id"], "left"))
    seed_name = F.coalesce("aura_name", "_ca_name", F.concat(F.lit("ability_"), F.col("ability_game_id").cast("string")))
    seed_type = consumable_type(F.coalesce("aura_name", "_ca_name", F.lit("")))
    seeds = (seeds.withColumn("_t", seed_type).filter(F.col("_t").isin(*BUFF_TYPES))
                  .select("report_code", "fight_id", "player_actor_id", "ability_game_id",
                          seed_name.alias("ability_name"), F.col("_t").alias("consumable_type"),
                          F.col("start_time_ms").alias("ts"), F.lit(1).alias("state")))
    trans = buff_changes.unionByName(seeds).join(fights, ["report_code", "fight_id"])
    keys = ["report_code", "fight_id", "player_actor_id", "ability_game_id"]
    up = uptime_from_transitions(trans, keys, ts="ts", state="state", end_col="end_time_ms",
                                 start_col="start_time_ms", carry=["ability_name", "consumable_type"])
    buffs = up.select(
        *keys, "ability_name", "consumable_type", F.col("present_at_start").alias("present_at_pull"),
        F.col("uptime").cast("bigint").alias("uptime_ms"), F.lit(None).cast("bigint").alias("casts"))
    casts = (ev.filter(F.col("event_type") == "cast")
               .join(ca.filter(F.col("consumable_type").isin(*CAST_TYPES)), ["report_code", "ability_game_id"])
               .groupBy("report_code", "fight_id", F.col("source_id").alias("player_actor_id"), "ability_game_id")
               .agg(F.min("ability_name").alias("ability_name"), F.min("consumable_type").alias("consumable_type"),
                    F.count(F.lit(1)).alias("casts"))
               .select(*keys, "ability_name", "consumable_type", F.lit(0).alias("present_at_pull"),
                       F.lit(None).cast("bigint").alias("uptime_ms"), "casts"))
    u = buffs.unionByName(casts)
    actors = silver_actors(b)
    a = actors.filter(F.col("resolved_actor_type") == "Player").select(
        "report_code", F.col("actor_id").alias("player_actor_id"),
        F.col("resolved_player_name").alias("player_name"), "player_guid",
        F.col("resolved_class").alias("class_name"))
    gf = guild_flags(b, actors=actors, with_roster_name=False).select("report_code", "player_name", "is_guild_member")
    j = (u.join(_fight_context(b), ["report_code", "fight_id"])
          .join(a, ["report_code", "player_actor_id"])
          .join(gf, ["report_code", "player_name"], "left"))
    return j.select(
        *_context_cols(), "keystone_level", F.col("duration_sec").alias("fight_duration_sec"),
        "player_name", "player_guid", "class_name",
        F.coalesce(F.col("is_guild_member"), F.lit(0)).alias("is_guild_member"),
        "consumable_type", F.col("ability_name").alias("consumable_name"), "present_at_pull",
        F.bround(F.col("uptime_ms") / 1000.0, 1).alias("uptime_sec"),
        F.bround(safe_div(F.col("uptime_ms") * 100.0, F.col("duration_ms")), 1).alias("uptime_pct"),
        "casts")


# ------------------------------------------------------------------ registered queries
def _b(fn):
    return lambda spark, sf: fn(Bronze(spark, sf))


def _guild_flags_full(b: Bronze) -> DataFrame:
    return guild_flags(b, with_roster_name=True)


def _actors_out(b: Bronze) -> DataFrame:
    return silver_actors(b).drop("icon")


QUERIES = {
    "combat_silver_reports": _b(silver_reports),
    "combat_silver_fights": _b(silver_fights),
    "combat_silver_events": _b(silver_events),
    "combat_silver_abilities": _b(silver_abilities),
    "combat_silver_guild_roster": _b(silver_roster),
    "combat_silver_actors": _b(_actors_out),
    "combat_silver_player_details": _b(silver_player_details),
    "combat_silver_pull_combatants": _b(silver_pull_combatants),
    "combat_silver_pull_auras": _b(silver_pull_auras),
    "combat_guild_flags": _b(_guild_flags_full),
    "gold_fight_player_perf": _b(gold_fight_player_perf),
    "gold_damage_taken": _b(gold_damage_taken),
    "gold_deaths": _b(gold_deaths),
    "gold_raid_nights": _b(gold_raid_nights),
    "gold_attendance_summary": _b(gold_attendance_summary),
    "gold_consumables": _b(gold_consumables),
}
