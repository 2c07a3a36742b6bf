"""DuckDB oracles of the marts in Spark SQL: those of the same marts as frames, and plain statements."""

from .oracle_climate import ORACLES as _CLIMATE
from .oracle_combat import ORACLES as _COMBAT
from .oracle_combat import W
from .oracle_reviews import ORACLES as _REVIEWS
from .sql_fixtures import COMBAT_BRONZE

ORACLES = {
    "sql_gold_deaths": _COMBAT["gold_deaths"],
    "sql_guild_flags": _COMBAT["combat_guild_flags"],
    "sql_roster_matches": f"""{W}, m AS (
        SELECT a.report_code, a.actor_id, r.character_name, r.player_guid, CASE WHEN a.player_guid = r.player_guid THEN 1 WHEN a.player_guid = r.canonical_id THEN 2
            WHEN a.resolved_actor_type = 'Player' AND a.actor_id = r.log_character_id THEN 3
            WHEN a.resolved_player_name <> '' AND lower(trim(a.resolved_player_name)) = lower(trim(r.character_name)) AND lower(trim(a.server)) = lower(trim(r.server_slug)) THEN 4 END AS prio
        FROM s_actors a, s_roster r)
        SELECT report_code, actor_id, arg_min(character_name, (prio, character_name, player_guid)) AS roster_character_name, min(prio) AS matched_by FROM m WHERE prio IS NOT NULL GROUP BY ALL""",
    "sql_page_links": _REVIEWS["pages_links"],
    "climate_view_rain_year": _CLIMATE["climate_rain_year"],
    "climate_view_hot_cold_year": _CLIMATE["climate_hot_cold_year"],
    "climate_view_records": _CLIMATE["climate_records"],
    "lake_appended_pages": f"""WITH {COMBAT_BRONZE} SELECT * EXCLUDE (ability_game_id), CASE WHEN page_index % 3 <> 2 THEN ability_game_id END AS ability_game_id,
        CASE WHEN page_index % 3 = 1 THEN CAST(length(event_json) AS BIGINT) END AS resources, 'p' || CAST(page_index % 3 AS VARCHAR) AS batch,
        TIMESTAMP '2024-01-01' + to_days(CAST(page_index % 3 AS INTEGER)) AS fetched_at FROM b_events""",
    "climate_qc_report": f"""SELECT fichier, lignes, tn_zero_ete, alertes, fusion_lignes, fusion_pct_tn_null, table_rows AS table_lignes, pct_table_null AS pct_temp_min_null, verdict
        FROM ({_CLIMATE['climate_qc_files']}), ({_CLIMATE['climate_qc_fusion']}), ({_CLIMATE['climate_qc_drift']})""",
}
