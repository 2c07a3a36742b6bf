"""DuckDB oracles for the streaming jobs (the batch equivalent of the stream)."""

from .oracle_climate import ORACLES as CLIMATE_ORACLES
from .oracle_combat import ORACLES as COMBAT_ORACLES
from .sql_fixtures import COMBAT_BRONZE

ORACLES = {
    "stream_bronze_events": f"""WITH {COMBAT_BRONZE} SELECT *, CAST(NULL AS BIGINT) AS source_instance,
            CAST(NULL AS BIGINT) AS target_instance FROM b_events""",
    "stream_climate_upsert": CLIMATE_ORACLES["climate_upsert"],
    "stream_hourly_event_counts": """SELECT date_trunc('hour', ts) AS window_start, event_type,
            CAST(count(*) AS BIGINT) AS events, round(sum(value), 2) AS value_sum
        FROM events GROUP BY ALL""",
}

ORACLES["stream_bronze_two_batches"] = ORACLES["stream_bronze_events"]
ORACLES["stream_hourly_corrections"] = ORACLES["stream_hourly_event_counts"]
ORACLES["stream_gold_refresh"] = COMBAT_ORACLES["gold_fight_player_perf"]
ORACLES["stream_silver_refresh"] = COMBAT_ORACLES["combat_silver_actors"]

# an event is real as often as the page that has it most often; equal hits of one page are both real
_CONTENT = "report_code, fight_id, timestamp_ms, event_type, source_id, target_id, ability_game_id, event_json"
ORACLES["stream_border_duplicates"] = f"""WITH {COMBAT_BRONZE},
    per_page AS (SELECT {_CONTENT}, page_index, sum(CASE WHEN event_type = 'damage' AND event_index % 7 = 3 THEN 2 ELSE 1 END) AS n FROM b_events GROUP BY {_CONTENT}, page_index),
    times AS (SELECT {_CONTENT}, max(n) AS n FROM per_page GROUP BY {_CONTENT})
    SELECT {_CONTENT}, CAST(NULL AS BIGINT) AS source_instance, CAST(NULL AS BIGINT) AS target_instance, CAST(unnest(range(1, CAST(n AS BIGINT) + 1)) AS BIGINT) AS occurrence FROM times"""
