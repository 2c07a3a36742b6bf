"""DuckDB oracles for the work-queue operations and the ad-hoc corpus."""

from .oracle_combat import ORACLES as _GOLD
from .oracle_combat import W, _PERF

_STATE_COLS = ("report_code, status, title, start_time_ms, last_error, ingestion_attempts, last_ingest_points, "
               "synced_at, fetched_at, catalog_json")


def _rr(num, den, scale):
    f = 10 ** scale
    return f"(({num}) * {2 * f} + ({den})) // (2 * ({den})) / {float(f)}"


def _cj(prefix=""):
    p = prefix
    return (f"json_object('report', json_object('code', {p}report_code, 'title', {p}title, 'startTime', {p}start_time_ms), "
            f"'guild', json_object('id', {p}guild_id, 'name', {p}guild_name), "
            f"'keys', json_object('guild_name', {p}guild_name, 'server_region', {p}server_region, 'server_slug', {p}server_slug))::VARCHAR")


STATE = f"""{W},
rep AS (SELECT *, dayofmonth(epoch_ms(start_time_ms)) AS dom FROM b_reports),
state0 AS (
    SELECT report_code, ['pending', 'ok', 'error', 'ok'][dom % 4 + 1] AS status, title, start_time_ms,
           CASE WHEN dom % 4 = 2 THEN 'HTTP 500 on ' || report_code END AS last_error,
           CAST(dom % 3 AS INTEGER) AS ingestion_attempts,
           CAST(CASE WHEN dom % 4 IN (1, 3) THEN dom * 7 + 11 END AS BIGINT) AS last_ingest_points,
           CASE WHEN dom % 4 IN (1, 3) THEN epoch_ms(start_time_ms) + INTERVAL 1 HOUR END AS synced_at,
           epoch_ms(start_time_ms) AS fetched_at, {_cj()} AS catalog_json
    FROM rep WHERE dom % 5 != 0),
cat AS (SELECT * FROM b_reports),
refreshed AS (
    SELECT CASE WHEN keep THEN e.report_code ELSE c.report_code END AS report_code,
           CASE WHEN keep THEN e.status ELSE 'pending' END AS status,
           CASE WHEN keep THEN e.title ELSE c.title END AS title,
           CASE WHEN keep THEN e.start_time_ms ELSE c.start_time_ms END AS start_time_ms,
           CASE WHEN keep THEN e.last_error END AS last_error,
           CASE WHEN keep THEN e.ingestion_attempts ELSE CAST(coalesce(e.ingestion_attempts, 0) AS INTEGER) END AS ingestion_attempts,
           CASE WHEN keep THEN e.last_ingest_points END AS last_ingest_points,
           CASE WHEN keep THEN e.synced_at END AS synced_at,
           CASE WHEN keep THEN e.fetched_at ELSE TIMESTAMP '2024-02-01 00:00:00' END AS fetched_at,
           CASE WHEN keep THEN e.catalog_json ELSE {_cj('c.')} END AS catalog_json
    FROM (SELECT e.*, c.report_code AS c_code, c.title AS c_title, c.start_time_ms AS c_start,
                 (c.report_code IS NULL OR e.status = 'ok') AS keep
          FROM state0 e FULL OUTER JOIN cat c ON e.report_code = c.report_code) e
    LEFT JOIN cat c ON e.c_code = c.report_code),
res AS (
    SELECT t.report_code, CASE WHEN f.k > 0 THEN 'ok' ELSE 'error' END AS outcome, f.n * 10 AS points,
           'HTTP 429: ' || repeat('x', 3000) AS error
    FROM refreshed t LEFT JOIN (SELECT report_code, count(*) AS n,
                                       count(*) FILTER (WHERE is_boss = 1 AND is_kill = 1) AS k
                                FROM s_fights GROUP BY report_code) f ON t.report_code = f.report_code
    WHERE t.status IN ('pending', 'error')),
after_run AS (
    SELECT s.report_code,
           CASE r.outcome WHEN 'ok' THEN 'ok' WHEN 'error' THEN 'error' ELSE s.status END AS status,
           s.title, s.start_time_ms,
           CASE r.outcome WHEN 'ok' THEN NULL WHEN 'error' THEN r.error ELSE s.last_error END AS last_error,
           CASE WHEN r.outcome = 'error' THEN s.ingestion_attempts + 1 ELSE s.ingestion_attempts END AS ingestion_attempts,
           CASE WHEN r.outcome = 'ok' AND r.points IS NOT NULL THEN CAST(r.points AS BIGINT) ELSE s.last_ingest_points END AS last_ingest_points,
           CASE WHEN r.outcome = 'ok' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE s.synced_at END AS synced_at,
           CASE WHEN r.outcome IN ('ok', 'error') THEN TIMESTAMP '2024-02-01 00:00:00' ELSE s.fetched_at END AS fetched_at,
           s.catalog_json
    FROM refreshed s LEFT JOIN res r ON s.report_code = r.report_code)"""

ORACLES = {
    "ingestion_state_refresh": f"{STATE} SELECT {_STATE_COLS} FROM refreshed",
    "ingestion_state_after_run": f"{STATE} SELECT {_STATE_COLS} FROM after_run",
    "ingestion_state_reset": f"""{STATE} SELECT report_code,
            CASE WHEN status IN ('ok', 'error') THEN 'pending' ELSE status END AS status, title, start_time_ms,
            CASE WHEN status IN ('ok', 'error') THEN NULL ELSE last_error END AS last_error,
            ingestion_attempts, last_ingest_points,
            CASE WHEN status IN ('ok', 'error') THEN NULL ELSE synced_at END AS synced_at,
            CASE WHEN status IN ('ok', 'error') THEN TIMESTAMP '2024-02-01 00:00:00' ELSE fetched_at END AS fetched_at,
            catalog_json FROM after_run""",
    "ingestion_reset_dry_run": f"""{STATE} SELECT CAST(count(*) FILTER (WHERE status IN ('ok', 'error')) AS BIGINT)
            AS would_reset FROM after_run""",
    "ingestion_pending_work": f"""{STATE} SELECT report_code, status, start_time_ms, ingestion_attempts
            FROM refreshed WHERE status IN ('pending', 'error')
            ORDER BY start_time_ms DESC NULLS LAST, report_code LIMIT 25""",
    "ingestion_median_points": f"""{STATE} SELECT median(CAST(last_ingest_points AS DOUBLE)) AS median_points,
            CAST(count(*) AS BIGINT) AS sample_size FROM (
              SELECT * FROM after_run WHERE status = 'ok' AND last_ingest_points IS NOT NULL
              ORDER BY synced_at DESC NULLS LAST, report_code DESC LIMIT 20)""",
    "ingestion_status_counts": f"{STATE} SELECT status, CAST(count(*) AS BIGINT) AS nb FROM after_run GROUP BY status",
    "corpus_top_dps_bosses": f"""{_PERF}, ml AS (
            SELECT report_code, fight_id, player_name, class_name, boss_name, is_boss, dps AS rate,
                   CAST(damage_done AS DOUBLE) AS total FROM perf)
        SELECT report_code, fight_id, boss_name, player_name, class_name, rate AS dps, total AS damage
        FROM ml WHERE is_boss = 1 ORDER BY rate DESC, report_code, fight_id, player_name LIMIT 20""",
    "corpus_table_counts": f"""{W} SELECT 'reports' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM s_reports
        UNION ALL SELECT 'fights', count(*) FROM s_fights UNION ALL SELECT 'events', count(*) FROM s_events
        UNION ALL SELECT 'actors', count(*) FROM s_actors UNION ALL SELECT 'abilities', count(*) FROM s_abilities
        UNION ALL SELECT 'roster', count(*) FROM s_roster""",
    "corpus_latest_reports": f"""{W} SELECT report_code, title, zone_name, report_start_at FROM s_reports
        ORDER BY report_start_at DESC, report_code LIMIT 15""",
    "corpus_fights_per_report": f"""{W} SELECT report_code, CAST(count(*) AS BIGINT) AS fights,
        CAST(count(*) FILTER (WHERE is_boss = 1) AS BIGINT) AS boss_fights FROM s_fights GROUP BY report_code""",
    "corpus_events_by_type": f"{W} SELECT event_type, CAST(count(*) AS BIGINT) AS events FROM b_events GROUP BY ALL",
    "corpus_events_pages": f"""{W} SELECT report_code, CAST(count(*) AS BIGINT) AS events,
        max(page_index) + 1 AS pages FROM b_events GROUP BY report_code""",
    "corpus_actors_by_type": f"{W} SELECT actor_type, CAST(count(*) AS BIGINT) AS actors FROM b_actors GROUP BY ALL",
    "corpus_json_keys_by_type": f"""{W} SELECT event_type, json_key, CAST(count(*) AS BIGINT) AS occurrences
        FROM (SELECT event_type, unnest(json_keys(event_json)) AS json_key FROM b_events) GROUP BY ALL""",
    "corpus_boss_attempts": f"""{W} SELECT fight_name AS boss_name, CAST(count(*) AS BIGINT) AS attempts,
        CAST(count(*) FILTER (WHERE is_kill = 1) AS BIGINT) AS kills,
        {_rr("count(*) FILTER (WHERE is_kill = 1) * 100", "count(*)", 1)} AS kill_pct
        FROM s_fights WHERE is_boss = 1 GROUP BY fight_name""",
    "corpus_players_per_report": f"""{_PERF} SELECT report_code, CAST(count(DISTINCT player_name) AS BIGINT) AS players
        FROM perf GROUP BY report_code""",
    "corpus_mean_dps_per_class": f"""{_PERF} SELECT class_name, round_even(avg(CAST(dps AS DOUBLE)), 0) AS mean_dps,
        CAST(count(*) AS BIGINT) AS n FROM perf WHERE is_boss = 1 GROUP BY class_name HAVING count(*) >= 5""",
    "corpus_best_per_boss": f"""{_PERF} SELECT player_name, boss_name, max(CAST(dps AS DOUBLE)) AS best_dps,
        arg_max(report_code, (CAST(dps AS DOUBLE), report_code)) AS best_report
        FROM perf WHERE is_boss = 1 GROUP BY player_name, boss_name""",
    "corpus_mythic_plus_runs": f"""{W} SELECT keystone_level, CAST(count(*) AS BIGINT) AS runs,
        CAST(count(*) FILTER (WHERE is_kill = 1) AS BIGINT) AS completed,
        round_even(avg(duration_sec), 1) AS avg_duration_sec
        FROM s_fights WHERE coalesce(keystone_level, 0) > 0 GROUP BY keystone_level""",
    "corpus_reports_per_week_source": f"""{W} SELECT date_trunc('week', report_start_at) AS week_start, log_source,
        CAST(count(*) AS BIGINT) AS reports FROM s_reports GROUP BY ALL""",
    "corpus_deaths_per_player": _GOLD["gold_deaths"].replace(
        "SELECT f.report_start_at", "SELECT player_name, CAST(count(*) AS BIGINT) AS deaths, "
        "CAST(count(DISTINCT (report_code, fight_id)) AS BIGINT) AS fights FROM (SELECT f.report_start_at", 1)
        + ") GROUP BY player_name",
    "corpus_players_per_class_spec": f"""{_PERF} SELECT class_name, spec_id,
        CAST(count(DISTINCT player_name) AS BIGINT) AS players FROM perf GROUP BY class_name, spec_id""",
}

_CONS = _GOLD["gold_consumables"]

ORACLES.update({
    "combat_report_sources": f"""{W}, u AS (
            SELECT report_code, title, owner_name, 'personal' AS log_source, 2 AS prio FROM s_reports
            UNION ALL SELECT report_code, title, owner_name, 'guild', 1 FROM s_reports WHERE guild_name IS NOT NULL)
        SELECT report_code, title, owner_name, log_source FROM (
            SELECT *, row_number() OVER (PARTITION BY report_code ORDER BY prio) AS rn FROM u) WHERE rn = 1""",
    "dps_series": f"""{_PERF} SELECT report_date, boss_name, difficulty_label,
            CAST(count(DISTINCT (report_code, fight_id)) AS BIGINT) AS fights,
            CAST(count(DISTINCT player_name) AS BIGINT) AS players,
            round_even(avg(dps), 0) AS avg_dps, max(dps) AS max_dps
        FROM perf WHERE is_guild_member = 1 AND is_boss = 1 GROUP BY ALL""",
    "consumable_views": f"""SELECT player_name, CAST(count(DISTINCT (report_code, fight_id)) AS BIGINT) AS fights,
            max(CASE WHEN consumable_type = 'flask' THEN uptime_pct END) AS max_flask_uptime_pct,
            max(CASE WHEN consumable_type = 'food' THEN uptime_pct END) AS max_food_uptime_pct,
            CAST(sum(CASE WHEN consumable_type = 'potion' THEN casts END) AS BIGINT) AS potions,
            CAST(sum(CASE WHEN consumable_type = 'healthstone' THEN casts END) AS BIGINT) AS healthstones
        FROM ({_CONS}) c GROUP BY player_name""",
})
