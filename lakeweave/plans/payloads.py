"""API payloads to rows: events pages, report payloads, player details, guild rosters.

Each raw row holds one response as text.  A response that isn't JSON, or isn't an
object, gives no rows; array items that aren't objects are dropped but keep
their place in the numbering.  Items stay text until their fields are taken, so
the whole event travels in ``event_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import fixtures as fx
from . import combat as C

ROLES = ("tanks", "healers", "dps")


def _whole(payload: str) -> Column:
    """True for one well-formed JSON value: a parser would take a cut-off response up to the
    cut, and one with something behind it up to there; inside an object both break it."""
    keys = F.json_object_keys(F.concat(F.lit('{"p":'), F.col(payload), F.lit(',"end":1}')))
    return F.coalesce(keys == F.array(F.lit("p"), F.lit("end")), F.lit(False))


def _items(df: DataFrame, array: Column, keep: list) -> DataFrame:
    """One row per object of the array: its place and its text."""
    return df.select(*keep, F.posexplode(array).alias("place", "item")).filter(F.col("item").startswith("{") & F.json_object_keys("item").isNotNull())


def event_rows(pages: DataFrame) -> DataFrame:
    """(report_code, page_index, payload) -> one row per event, navigation fields and whole text."""
    data = F.from_json("payload", "data array<string>")["data"]
    rows = _items(pages.filter(_whole("payload")), data, ["report_code", "page_index"])
    e = F.from_json("item", "fight bigint, timestamp bigint, type string, sourceID bigint, sourceInstance bigint, targetID bigint, targetInstance bigint, abilityGameID bigint")
    return rows.withColumn("e", e).select(
        "report_code", F.col("e.fight").alias("fight_id"), "page_index", F.col("place").cast("bigint").alias("event_index"), F.col("e.timestamp").alias("timestamp_ms"),
        F.col("e.type").alias("event_type"), F.col("e.sourceID").alias("source_id"), F.col("e.sourceInstance").alias("source_instance"), F.col("e.targetID").alias("target_id"),
        F.col("e.targetInstance").alias("target_instance"), F.col("e.abilityGameID").alias("ability_game_id"), F.col("item").alias("event_json"))


_REPORT = "masterData struct<logVersion: int, gameVersion: int, lang: string, actors: array<string>, abilities: array<string>>, fights array<string>"


def _reports(raw: DataFrame) -> DataFrame:
    return raw.filter(_whole("payload")).select("report_code", F.from_json("payload", _REPORT).alias("p"))


def master_info(raw: DataFrame) -> DataFrame:
    """One row per report; the counts are those of the arrays as sent."""
    m = F.col("p.masterData")
    size = lambda c: F.coalesce(F.size(m[c]), F.lit(0))
    return _reports(raw).select("report_code", m["logVersion"].alias("log_version"), m["gameVersion"].alias("game_version"), m["lang"].alias("lang"),
                                size("actors").alias("actors_count"), size("abilities").alias("abilities_count"))


def master_actors(raw: DataFrame) -> DataFrame:
    rows = _items(_reports(raw), F.col("p.masterData.actors"), ["report_code"])
    a = F.from_json("item", "id bigint, gameID bigint, name string, type string, subType string, petOwner bigint, server string, icon string")
    return rows.withColumn("a", a).select(
        "report_code", F.col("a.id").alias("actor_id"), F.col("a.gameID").alias("game_id"), F.col("a.name").alias("name"), F.col("a.type").alias("actor_type"),
        F.col("a.subType").alias("sub_type"), F.col("a.petOwner").alias("pet_owner_id"), F.col("a.server").alias("server"), F.col("a.icon").alias("icon"))


def master_abilities(raw: DataFrame) -> DataFrame:
    rows = _items(_reports(raw), F.col("p.masterData.abilities"), ["report_code"])
    a = F.from_json("item", "gameID bigint, name string, type string, icon string")
    return rows.withColumn("a", a).select("report_code", F.col("a.gameID").alias("ability_game_id"), F.col("a.name").alias("name"), F.col("a.type").alias("ability_type"), F.col("a.icon").alias("icon"))


def fight_rows(raw: DataFrame) -> DataFrame:
    """Duration from both ends, no encounter is encounter 0, a boss is any other."""
    rows = _items(_reports(raw), F.col("p.fights"), ["report_code"])
    f = F.from_json("item", "id bigint, encounterID bigint, name string, startTime bigint, endTime bigint, kill boolean, difficulty bigint, size bigint, bossPercentage double, keystoneLevel bigint, keystoneTime bigint")
    encounter = F.coalesce(F.col("f.encounterID"), F.lit(0))
    return rows.withColumn("f", f).select(
        "report_code", F.col("f.id").alias("fight_id"), encounter.alias("encounter_id"), F.col("f.name").alias("fight_name"), F.col("f.startTime").alias("start_time_ms"),
        F.col("f.endTime").alias("end_time_ms"), (F.col("f.endTime") - F.col("f.startTime")).alias("duration_ms"), F.col("f.kill").alias("kill"), F.col("f.difficulty").alias("difficulty"),
        F.col("f.size").alias("size"), F.col("f.bossPercentage").alias("boss_percentage"), F.col("f.keystoneLevel").alias("keystone_level"), F.col("f.keystoneTime").alias("keystone_time_ms"),
        (encounter != 0).alias("is_boss"))


def player_detail_rows(raw: DataFrame) -> DataFrame:
    """One row per role and player, from ``data.playerDetails`` or ``playerDetails``."""
    roles = "struct<" + ", ".join(f"{r}: array<string>" for r in ROLES) + ">"
    p = F.from_json("payload", f"data struct<playerDetails: {roles}>, playerDetails {roles}")
    block = raw.filter(_whole("payload")).withColumn("p", p).select("report_code", F.coalesce(F.col("p.data.playerDetails"), F.col("p.playerDetails")).alias("d"))
    sides = F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"d.{r}").alias("players")) for r in ROLES])
    rows = _items(block.select("report_code", F.explode(sides).alias("s")).select("report_code", "s.role", "s.players"), F.col("players"), ["report_code", "role"])
    q = F.from_json("item", "id bigint, guid bigint, name string, server string, region string, type string, icon string, minItemLevel bigint, maxItemLevel bigint, potionUse bigint, healthstoneUse bigint, specs string, combatantInfo string")
    return rows.withColumn("q", q).select(
        "report_code", "role", F.col("q.id").alias("player_id"), F.col("q.guid").alias("player_guid"), F.col("q.name").alias("player_name"), F.col("q.server").alias("server"),
        F.col("q.region").alias("region"), F.col("q.type").alias("class_name"), F.col("q.icon").alias("icon"), F.col("q.minItemLevel").alias("min_item_level"),
        F.col("q.maxItemLevel").alias("max_item_level"), F.col("q.potionUse").alias("potion_use"), F.col("q.healthstoneUse").alias("healthstone_use"),
        F.coalesce("q.specs", F.lit("[]")).alias("specs_json"), F.coalesce("q.combatantInfo", F.lit("{}")).alias("combatant_info_json"), F.col("item").alias("player_json"))


_PLACE = "struct<slug: string, region: struct<slug: string>>"


def roster_rows(raw: DataFrame) -> DataFrame:
    """Trimmed names, nameless members dropped, canonical id before character id, class by number."""
    p = F.from_json("payload", "guild struct<id: bigint, name: string>, keys struct<guild_name: string, server_region: string, server_slug: string>, members array<string>")
    rows = _items(raw.filter(_whole("payload")).withColumn("p", p).select("p.*"), F.col("members"), ["guild", "keys"])
    m = F.from_json("item", f"id bigint, canonicalID bigint, name string, classID int, level bigint, guildRank bigint, server {_PLACE}")
    name, full = F.trim(F.col("m.name")), lambda c: F.nullif(c, F.lit(""))
    classes = F.array(*[F.lit(n) for n in fx.CLASS_NAMES])
    return rows.withColumn("m", m).filter(F.coalesce(name, F.lit("")) != "").select(
        F.col("guild.id").alias("guild_id"), F.coalesce(full(F.col("guild.name")), F.col("keys.guild_name")).alias("guild_name"),
        F.coalesce(full(F.col("keys.server_region")), F.col("m.server.region.slug")).alias("server_region"),
        F.coalesce(full(F.col("keys.server_slug")), F.col("m.server.slug")).alias("server_slug"),
        F.col("m.id").alias("log_character_id"), F.col("m.canonicalID").alias("canonical_id"),
        F.coalesce(F.nullif(F.col("m.canonicalID"), F.lit(0)), F.col("m.id")).alias("player_guid"), name.alias("character_name"), F.col("m.classID").alias("class_id"),
        F.when(F.col("m.classID") > 0, F.try_element_at(classes, F.col("m.classID"))).alias("class_name"),
        F.col("m.level").alias("character_level"), F.col("m.guildRank").alias("guild_rank"))


def catalogue_rows(raw: DataFrame) -> DataFrame:
    """The report with its zone, owner and guild; the searched guild and owner stand in where the report names none."""
    p = F.from_json("payload", ("report struct<code: string, title: string, visibility: string, startTime: bigint, endTime: bigint, zone: struct<name: string>, owner: struct<id: bigint, name: string>, "
                                "guild: struct<id: bigint, name: string>, _owner_user_id: bigint, _log_source: string>, guild struct<id: bigint, name: string>, keys struct<server_region: string, server_slug: string>"))
    some = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit(0)), F.col(b))
    text = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit("")), b)
    return raw.filter(_whole("payload")).withColumn("p", p).select("p.*").select(
        F.col("report.code").alias("report_code"), some("report.guild.id", "guild.id").alias("guild_id"), text("report.guild.name", F.col("guild.name")).alias("guild_name"),
        F.col("keys.server_region").alias("server_region"), F.col("keys.server_slug").alias("server_slug"), F.col("report.title").alias("title"), F.col("report.zone.name").alias("zone_name"),
        F.col("report.owner.name").alias("owner_name"), some("report._owner_user_id", "report.owner.id").alias("owner_user_id"),
        text("report._log_source", F.lit("guild")).alias("log_source"), F.col("report.visibility").alias("visibility"),
        F.col("report.startTime").alias("start_time_ms"), F.col("report.endTime").alias("end_time_ms"))


# ------------------------------------------------------------------ raw responses from the driver tables
def _json(*columns) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _array(df: DataFrame, keys: list, order: str, text: Column) -> DataFrame:
    """The group's items joined to the inside of an array; a group is one response, whose size the API bounds.

    Before every item whose number divides by 7 stands an item that is no object."""
    item = F.when(F.col(order) % 7 == 0, F.concat(F.lit('7,null,"x",'), text)).otherwise(text)
    return df.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("t")))), lambda x: x["t"]), ",").alias("items"))


def _number(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


def event_pages(b) -> DataFrame:
    """Pages of at most 200 events; pages whose number divides by 29 are cut off in the middle."""
    rest = F.when(F.col("event_json") == "{}", F.lit("}")).otherwise(F.concat(F.lit(","), F.substr("event_json", F.lit(2))))
    text = F.concat(F.lit('{"fight":'), _number("fight_id"), F.lit(',"timestamp":'), _number("timestamp_ms"), F.lit(',"type":"'), F.col("event_type"), F.lit('","sourceID":'), _number("source_id"),
                    F.lit(',"targetID":'), _number("target_id"), F.lit(',"abilityGameID":'), _number("ability_game_id"), rest)
    pages = _array(b.events, ["report_code", "page_index"], "event_index", text)
    end = F.when(F.col("page_index") % 29 == 0, F.lit(',{"cut')).otherwise(F.lit("]}"))
    return pages.select("report_code", "page_index", F.concat(F.lit('{"data":['), F.col("items"), end).alias("payload"))


def report_payloads(b) -> DataFrame:
    actors = _array(b.actors, ["report_code"], "actor_id", _json(
        F.col("actor_id").alias("id"), F.col("game_id").alias("gameID"), "name", F.col("actor_type").alias("type"), F.col("sub_type").alias("subType"), F.col("pet_owner_id").alias("petOwner"), "server", "icon"))
    abilities = _array(b.abilities, ["report_code"], "ability_game_id", _json(F.col("ability_game_id").alias("gameID"), "name", F.col("ability_type").alias("type"), "icon"))
    fights = _array(b.fights, ["report_code"], "fight_id", _json(
        F.col("fight_id").alias("id"), F.col("encounter_id").alias("encounterID"), F.col("fight_name").alias("name"), F.col("start_time_ms").alias("startTime"), F.col("end_time_ms").alias("endTime"), "kill", "difficulty",
        "size", F.col("boss_percentage").alias("bossPercentage"), F.col("keystone_level").cast("bigint").alias("keystoneLevel"), F.col("keystone_time_ms").alias("keystoneTime")))
    j = actors.withColumnRenamed("items", "a").join(abilities.withColumnRenamed("items", "b"), "report_code").join(fights.withColumnRenamed("items", "f"), "report_code")
    return j.select("report_code", F.concat(F.lit('{"masterData":{"logVersion":48,"gameVersion":1,"lang":"fr","actors":['), "a", F.lit('],"abilities":['), "b", F.lit(']},"fights":['), "f", F.lit("]}")).alias("payload"))


def player_detail_payloads(b) -> DataFrame:
    """With and without the outer object, by report; every fifth report's text is cut."""
    players = _array(b.player_details, ["report_code", "role"], "player_id", _json(
        F.col("player_id").alias("id"), F.col("player_guid").alias("guid"), F.col("player_name").alias("name"), "server", "region", F.col("class_name").alias("type"), "icon",
        F.col("min_item_level").alias("minItemLevel"), F.col("max_item_level").alias("maxItemLevel"), F.col("potion_use").alias("potionUse"), F.col("healthstone_use").alias("healthstoneUse")))
    one = players.groupBy("report_code").agg(*(F.max(F.when(F.col("role") == r, F.col("items"))).alias(r) for r in ROLES))
    block = F.concat(F.lit('{"playerDetails":{'), F.array_join(F.array(*[F.concat(F.lit(f'"{r}":['), F.coalesce(r, F.lit("")), F.lit("]")) for r in ROLES]), ","), F.lit("}}"))
    day = F.substring("report_code", 8, 2).cast("int")
    return one.select("report_code", F.when(day % 5 == 0, F.concat(block, F.lit("]"))).when(day % 2 == 0, block).otherwise(F.concat(F.lit('{"data":'), block, F.lit("}"))).alias("payload"))


def roster_payloads(b) -> DataFrame:
    """One response per class; every ninth member is nameless, class 14 is unknown."""
    r = b.roster.withColumn("n", F.col("player_guid") % 9)
    server = F.struct(F.col("server_slug").alias("slug"), F.struct(F.lit("eu").alias("slug")).alias("region")).alias("server")
    member = _json(F.col("log_character_id").alias("id"), F.when(F.col("n") == 1, F.lit(0)).otherwise(F.col("canonical_id")).alias("canonicalID"),
                   F.when(F.col("n") == 0, F.lit("  ")).otherwise(F.col("character_name")).alias("name"), F.when(F.col("n") == 2, 14).otherwise(F.col("class_id")).alias("classID"),
                   F.col("character_level").alias("level"), F.col("guild_rank").alias("guildRank"), server)
    m = _array(r, ["class_id"], "player_guid", member)
    head = F.when(F.col("class_id") % 2 == 0, F.lit('{"guild":{"id":77,"name":null},"keys":{"guild_name":"Les Gardiens","server_region":"eu","server_slug":""},"members":[')).otherwise(
        F.lit('{"guild":{"id":77,"name":"Les Gardiens"},"keys":{"guild_name":"g","server_region":null,"server_slug":"hyjal"},"members":['))
    return m.select(F.concat(head, F.col("items"), F.lit("]}")).alias("payload"))


def catalogue_payloads(b) -> DataFrame:
    day = F.substring("report_code", 8, 2).cast("int")
    report = F.struct(
        F.col("report_code").alias("code"), "title", "visibility", F.col("start_time_ms").alias("startTime"), F.col("end_time_ms").alias("endTime"), F.struct(F.col("zone_name").alias("name")).alias("zone"),
        F.when(day % 4 != 0, F.struct(F.col("owner_user_id").alias("id"), F.col("owner_name").alias("name"))).alias("owner"),
        F.when(F.col("guild_id").isNotNull(), F.struct(F.col("guild_id").alias("id"), F.col("guild_name").alias("name"))).alias("guild"),
        F.when(day % 3 == 0, F.lit(900)).alias("_owner_user_id"), F.when(day % 2 == 0, F.col("log_source")).alias("_log_source")).alias("report")
    return b.reports.select(_json(report, F.struct(F.lit(5).alias("id"), F.lit("Searched").alias("name")).alias("guild"), F.struct("server_region", "server_slug").alias("keys")).alias("payload"))


QUERIES = {
    "payload_events": C._b(lambda b: event_rows(event_pages(b))),
    "payload_master_info": C._b(lambda b: master_info(report_payloads(b))),
    "payload_master_actors": C._b(lambda b: master_actors(report_payloads(b))),
    "payload_master_abilities": C._b(lambda b: master_abilities(report_payloads(b))),
    "payload_fights": C._b(lambda b: fight_rows(report_payloads(b))),
    "payload_player_details": C._b(lambda b: player_detail_rows(player_detail_payloads(b))),
    "payload_roster": C._b(lambda b: roster_rows(roster_payloads(b))),
    "payload_catalogue": C._b(lambda b: catalogue_rows(catalogue_payloads(b))),
}
