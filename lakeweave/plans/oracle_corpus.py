"""DuckDB oracles for the ad-hoc statements."""

from .oracle_combat import ORACLES as _GOLD
from .oracle_combat import _ML, _PERF, W
from .oracle_combat_ops import STATE, _rr

_OUT = "CASE WHEN is_kill = 1 THEN 'kill' ELSE 'wipe' END AS outcome"
_ONE = "report_code = (SELECT min(report_code) FROM s_reports)"
_TIES = "report_code, fight_id, player_name"
_ME = "contains(lower(player_name), 'player_1')"


def _top(measure, columns, n, where="is_boss = 1"):
    return f"{_PERF} SELECT {columns}, {measure} FROM perf WHERE {where} ORDER BY {measure} DESC, {_TIES} LIMIT {n}"


ORACLES = {
    "corpus_top_hps": _top("hps", "report_start_at, boss_name, player_name", 40),
    "corpus_top_dispels": _top("dispels", "boss_name, player_name", 30, "is_boss = 1 AND dispels > 0"),
    "corpus_top_dtps": _top("dtps", "boss_name, player_name", 30),
    "corpus_top_interrupts": _top("interrupts", "raid_or_dungeon, boss_name, player_name", 30),
    "corpus_one_boss_dps": _top("dps", f"report_start_at, player_name, class_name, {_OUT}", 20, "is_boss = 1 AND boss_name = 'Queen Ansurek'"),
    "corpus_dps_by_zone": _top("dps", "raid_or_dungeon, boss_name, player_name", 30),
    "corpus_dps_with_item_level": _top("dps", f"report_start_at, report_code, raid_or_dungeon, boss_name, {_OUT}, player_name, class_name, spec_id, avg_item_level", 50),
    "corpus_mythic_plus_level_top": _top("dps", "report_start_at, boss_name, player_name", 25, "keystone_level = 12"),
    "corpus_top_consumable_casts": f"""SELECT boss_name, player_name, consumable_name, casts FROM ({_GOLD['gold_consumables']}) WHERE is_boss = 1 AND casts > 0
        ORDER BY casts DESC, {_TIES}, consumable_name LIMIT 40""",
    "corpus_buff_uptime": f"""SELECT player_name, consumable_name, uptime_sec FROM ({_GOLD['gold_consumables']}) WHERE is_boss = 1 AND uptime_sec > 0
        ORDER BY uptime_sec DESC, {_TIES}, consumable_name LIMIT 30""",
    "corpus_boss_deaths_by_player": f"""{_PERF} SELECT player_name, class_name, CAST(sum(deaths) AS BIGINT) AS total_deaths FROM perf WHERE is_boss = 1 AND deaths > 0
        GROUP BY ALL ORDER BY total_deaths DESC, player_name, class_name LIMIT 25""",
    "corpus_raid_deaths": f"""{_PERF} SELECT report_title, boss_name, raid_deaths FROM (
        SELECT report_title, boss_name, report_code, fight_id, CAST(sum(deaths) AS BIGINT) AS raid_deaths FROM perf WHERE is_boss = 1 GROUP BY ALL)
        ORDER BY raid_deaths DESC, report_code, fight_id LIMIT 20""",
    "corpus_player_dps_history": f"""{_PERF} SELECT report_start_at, raid_or_dungeon, boss_name, player_name, {_OUT}, round_even(fight_duration_sec, 0) AS fight_sec, spec_id, dps, avg_item_level
        FROM perf WHERE is_boss = 1 AND {_ME}""",
    "corpus_player_hps_history": f"{_PERF} SELECT report_start_at, boss_name, hps FROM perf WHERE {_ME} ORDER BY report_start_at DESC, {_TIES} LIMIT 50",
    "corpus_player_deaths": f"{_PERF} SELECT report_title, boss_name, player_name, deaths, {_OUT} FROM perf WHERE deaths > 0 AND {_ME}",
    "corpus_player_best_per_boss": f"""{_PERF} SELECT boss_name, max(dps) AS best_dps, arg_max(raid_or_dungeon, (dps, report_code, player_name)) AS zone_name,
        arg_max(report_start_at, (dps, report_code, player_name)) AS best_run_date FROM perf WHERE is_boss = 1 AND {_ME} GROUP BY boss_name""",
    "corpus_owner_reports": f"{W} SELECT report_code, title, zone_name, report_start_at FROM s_reports WHERE owner_user_id = 501 OR contains(lower(owner_name), 'owner_1')",
    "corpus_metric_counts": f"SELECT metric, CAST(count(*) AS BIGINT) AS rows FROM ({_GOLD['metric_long']}) GROUP BY metric",
    "corpus_mythic_plus_list": f"""{W} SELECT report_start_at, title, zone_name, fight_name, keystone_level, round_even(duration_sec, 0) AS fight_sec,
        CASE WHEN is_kill = 1 THEN 'done' ELSE 'wipe' END AS outcome FROM s_fights JOIN s_reports USING (report_code) WHERE keystone_level > 0""",
    "corpus_mythic_plus_players": f"""{_PERF} SELECT player_name, class_name, keystone_level, round_even(avg(dps), 0) AS avg_dps, CAST(count(*) AS BIGINT) AS fights FROM perf
        WHERE keystone_level >= 10 GROUP BY ALL HAVING count(*) >= 2 ORDER BY keystone_level DESC, avg_dps DESC, player_name, class_name LIMIT 40""",
    "corpus_boss_attempt_durations": f"""{W} SELECT fight_name, encounter_id, CAST(count(*) AS BIGINT) AS attempts, CAST(count(*) FILTER (WHERE is_kill = 1) AS BIGINT) AS kills,
        {_rr("count(*) FILTER (WHERE is_kill = 1) * 100", "count(*)", 1)} AS kill_pct, round_even(avg(duration_ms) / 1000, 0) AS avg_duration_sec
        FROM s_fights WHERE is_boss = 1 GROUP BY fight_name, encounter_id""",
    "corpus_boss_pulls": f"""{W} SELECT report_start_at, title, fight_name, {_OUT}, round_even(duration_sec, 0) AS duration_sec, round_even(boss_percentage, 1) AS boss_pct
        FROM s_fights JOIN s_reports USING (report_code) WHERE is_boss = 1 ORDER BY report_start_at DESC, report_code, fight_id LIMIT 50""",
    "corpus_players_per_night": f"""{_PERF} SELECT report_start_at, raid_or_dungeon, report_title, report_code, CAST(count(DISTINCT player_name) AS BIGINT) AS players
        FROM perf GROUP BY ALL""",
    "corpus_report_header": f"{W} SELECT report_code, log_source, owner_name, title, zone_name, report_start_at FROM s_reports WHERE {_ONE}",
    "corpus_report_fights": f"{W} SELECT fight_id, fight_name, is_boss, is_kill, keystone_level, round_even(duration_sec, 1) AS duration_sec FROM s_fights WHERE {_ONE}",
    "corpus_report_dps": f"{_PERF} SELECT boss_name, player_name, dps FROM perf WHERE is_boss = 1 AND {_ONE}",
    "corpus_report_metric_counts": f"{_ML} SELECT metric, CAST(count(*) AS BIGINT) AS rows FROM ml WHERE {_ONE} GROUP BY metric",
    "corpus_top_casts": f"""{_ML} SELECT fight_name AS boss_name, who AS player_name, entry AS ability, CAST(n AS BIGINT) AS casts FROM cast_entries JOIN fctx USING (report_code, fight_id)
        WHERE is_boss = 1 ORDER BY n DESC, report_code, fight_id, who, entry LIMIT 40""",
    "corpus_top_buffs": f"""{_ML} SELECT who AS player_name, entry AS aura, round_even(n / 1000, 0) AS uptime_sec FROM aura_entries JOIN fctx USING (report_code, fight_id)
        WHERE is_boss = 1 AND n > 0 ORDER BY n DESC, report_code, fight_id, who, entry, ability_game_id LIMIT 30""",
    "corpus_report_ingestion": f"{STATE} SELECT status, ingestion_attempts, last_error FROM after_run WHERE {_ONE}",
    "corpus_guild_activity": f"""{_PERF} SELECT player_name, class_name, CAST(count(DISTINCT perf.report_code) AS BIGINT) AS reports, max(perf.report_start_at) AS last_seen
        FROM perf JOIN s_reports USING (report_code) WHERE log_source = 'guild' GROUP BY player_name, class_name""",
    "corpus_zone_sources": f"{W} SELECT zone_name, log_source, CAST(count(*) AS BIGINT) AS reports FROM s_reports WHERE zone_name IS NOT NULL GROUP BY ALL",
    "corpus_source_counts": f"{W} SELECT log_source, CAST(count(*) AS BIGINT) AS reports FROM s_reports GROUP BY ALL",
    "corpus_latest_owners": f"{W} SELECT report_code, owner_name, title, zone_name FROM s_reports ORDER BY report_start_at DESC, report_code LIMIT 25",
    "corpus_most_fights": f"""{W} SELECT report_code, CAST(count(*) AS BIGINT) AS fights, CAST(count(*) FILTER (WHERE is_boss = 1) AS BIGINT) AS boss_fights
        FROM s_fights GROUP BY report_code ORDER BY fights DESC, report_code LIMIT 20""",
    "corpus_resolved_damage": f"""{W} SELECT resolved_player_name AS player_name, resolved_actor_type AS resolved_type, CAST(count(*) AS BIGINT) AS n
        FROM s_events e JOIN s_actors a ON a.report_code = e.report_code AND a.actor_id = e.source_id WHERE event_type = 'damage'
        GROUP BY ALL ORDER BY n DESC, player_name, resolved_type LIMIT 30""",
    "corpus_details_with_roster": f"""{W} SELECT report_code, player_name, role, d.class_name, CAST(max_item_level AS INTEGER) AS max_item_level, d.player_guid, guild_name
        FROM b_player_details d LEFT JOIN s_roster r ON r.player_guid = d.player_guid
        ORDER BY max_item_level DESC, report_code, player_name, character_name NULLS FIRST LIMIT 30""",
    "corpus_player_boss_dps": f"""{_PERF} SELECT player_name, round_even(sum(damage_done) / max(fight_duration_sec), 2) AS dps FROM perf
        WHERE is_boss = 1 AND damage_events > 0 GROUP BY player_name""",
    "corpus_pull_buffs": f"""{W} SELECT a.name AS player, b.name AS buff, CAST(count(*) AS BIGINT) AS pulls FROM s_pull_auras p
        JOIN s_actors a ON a.report_code = p.report_code AND a.actor_id = p.player_actor_id
        JOIN s_abilities b ON b.report_code = p.report_code AND b.ability_game_id = p.ability_game_id GROUP BY ALL""",
    "combat_silver_ingestion_state": f"""{STATE} SELECT report_code, status, title, CAST(ingestion_attempts AS INTEGER) AS ingestion_attempts,
        epoch_ms(start_time_ms) AS report_start_at, synced_at, substr(last_error, 1, 500) AS last_error_preview,
        CAST(last_ingest_points AS INTEGER) AS last_ingest_points, fetched_at AS bronze_fetched_at FROM after_run""",
}

_SIZES = {"ingestion_state": "after_run", "guild_reports": "b_reports", "fights": "b_fights", "reports_raw": "b_reports", "master_info": "b_reports", "master_actors": "b_actors",
          "master_abilities": "b_abilities", "player_details": "b_player_details", "events": "b_events", "guild_roster": "b_roster"}
ORACLES["lake_view_counts"] = f"{STATE} " + " UNION ALL ".join(f"SELECT '{t}' AS t, CAST(count(*) AS BIGINT) AS n FROM {source}" for t, source in _SIZES.items())
