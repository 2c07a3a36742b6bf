"""DuckDB oracles of the payload flattening: the same responses, taken apart by JSON functions."""

from .oracle_combat import W


def _items(source, array, keys):
    """Objects of a JSON array with their place from 0."""
    return (f"SELECT {keys}, i - 1 AS place, e FROM (SELECT {keys}, unnest(a) AS e, unnest(range(1, len(a) + 1)) AS i FROM "
            f"(SELECT {keys}, CAST(json_extract(payload, '{array}') AS JSON[]) AS a FROM {source} WHERE json_valid(payload))) WHERE json_type(e) = 'OBJECT'")


def _join(keys, order, text, source):
    return (f"SELECT {keys}, string_agg(CASE WHEN {order} % 7 = 0 THEN '7,null,\"x\",' ELSE '' END || t, ',' ORDER BY {order}, t) AS items "
            f"FROM (SELECT *, {text} AS t FROM {source}) GROUP BY {keys}")


def _n(c):
    return f"coalesce(CAST({c} AS VARCHAR), 'null')"


def _get(path, kind):
    return f"TRY_CAST(json_extract_string(e, '$.{path}') AS {kind})"


_EVENT = (f"'{{\"fight\":' || {_n('fight_id')} || ',\"timestamp\":' || {_n('timestamp_ms')} || ',\"type\":\"' || event_type || '\",\"sourceID\":' || {_n('source_id')} || ',\"targetID\":' || {_n('target_id')} "
          f"|| ',\"abilityGameID\":' || {_n('ability_game_id')} || CASE WHEN event_json = '{{}}' THEN '}}' ELSE ',' || substr(event_json, 2) END")
_ACTOR = "json_object('id', actor_id, 'gameID', game_id, 'name', name, 'type', actor_type, 'subType', sub_type, 'petOwner', pet_owner_id, 'server', server, 'icon', sub_type || '.jpg')::VARCHAR"
_ABILITY = "json_object('gameID', ability_game_id, 'name', name, 'type', ability_type, 'icon', 'ability_' || CAST(ability_game_id - 100 AS VARCHAR) || '.jpg')::VARCHAR"
_FIGHT = ("json_object('id', fight_id, 'encounterID', encounter_id, 'name', fight_name, 'startTime', start_time_ms, 'endTime', end_time_ms, 'kill', kill, 'difficulty', difficulty, 'size', size, "
          "'bossPercentage', boss_percentage, 'keystoneLevel', CAST(keystone_level AS BIGINT), 'keystoneTime', keystone_time_ms)::VARCHAR")
_PLAYER = ("json_object('id', player_id, 'guid', player_guid, 'name', player_name, 'server', server, 'region', region, 'type', class_name, 'icon', class_name || '.jpg', 'minItemLevel', min_item_level, "
           "'maxItemLevel', max_item_level, 'potionUse', potion_use, 'healthstoneUse', healthstone_use)::VARCHAR")
_MEMBER = ("json_object('id', log_character_id, 'canonicalID', CASE WHEN player_guid % 9 = 1 THEN 0 ELSE canonical_id END, 'name', CASE WHEN player_guid % 9 = 0 THEN '  ' ELSE character_name END, "
           "'classID', CASE WHEN player_guid % 9 = 2 THEN 14 ELSE class_id END, 'level', character_level, 'guildRank', guild_rank, 'server', json_object('slug', server_slug, 'region', json_object('slug', 'eu')))::VARCHAR")
_DAY = "CAST(substr(report_code, 8, 2) AS INTEGER)"

RAW = f"""{W},
pg AS ({_join('report_code, page_index', 'event_index', _EVENT, 'b_events')}),
pages_raw AS (SELECT report_code, page_index, '{{"data":[' || items || CASE WHEN page_index % 29 = 0 THEN ',{{"cut' ELSE ']}}' END AS payload FROM pg),
ra AS ({_join('report_code', 'actor_id', _ACTOR, 'b_actors')}),
rb AS ({_join('report_code', 'ability_game_id', _ABILITY, 'b_abilities')}),
rf AS ({_join('report_code', 'fight_id', _FIGHT, 'b_fights')}),
reports_raw AS (SELECT ra.report_code, '{{"masterData":{{"logVersion":48,"gameVersion":1,"lang":"fr","actors":[' || ra.items || '],"abilities":[' || rb.items || ']}},"fights":[' || rf.items || ']}}' AS payload
    FROM ra JOIN rb USING (report_code) JOIN rf USING (report_code)),
pl AS ({_join('report_code, role', 'player_id', _PLAYER, 'b_player_details')}),
details_raw AS (SELECT report_code, CASE WHEN {_DAY} % 5 = 0 THEN block || ']' WHEN {_DAY} % 2 = 0 THEN block ELSE '{{"data":' || block || '}}' END AS payload FROM (
    SELECT report_code, '{{"playerDetails":{{"tanks":[' || coalesce(max(items) FILTER (role = 'tanks'), '') || '],"healers":[' || coalesce(max(items) FILTER (role = 'healers'), '')
        || '],"dps":[' || coalesce(max(items) FILTER (role = 'dps'), '') || ']}}}}' AS block FROM pl GROUP BY report_code)),
mb AS ({_join('class_id', 'player_guid', _MEMBER, 'b_roster')}),
roster_raw AS (SELECT CASE WHEN class_id % 2 = 0 THEN '{{"guild":{{"id":77,"name":null}},"keys":{{"guild_name":"Les Gardiens","server_region":"eu","server_slug":""}},"members":['
    ELSE '{{"guild":{{"id":77,"name":"Les Gardiens"}},"keys":{{"guild_name":"g","server_region":null,"server_slug":"hyjal"}},"members":[' END || items || ']}}' AS payload FROM mb)"""

ORACLES = {
    "payload_events": f"""{RAW} SELECT report_code, {_get('fight', 'BIGINT')} AS fight_id, page_index, place AS event_index, {_get('timestamp', 'BIGINT')} AS timestamp_ms, {_get('type', 'VARCHAR')} AS event_type,
        {_get('sourceID', 'BIGINT')} AS source_id, CAST(NULL AS BIGINT) AS source_instance, {_get('targetID', 'BIGINT')} AS target_id, CAST(NULL AS BIGINT) AS target_instance,
        {_get('abilityGameID', 'BIGINT')} AS ability_game_id, e::VARCHAR AS event_json FROM ({_items('pages_raw', '$.data', 'report_code, page_index')})""",
    "payload_master_info": f"""{RAW} SELECT report_code, 48 AS log_version, 1 AS game_version, 'fr' AS lang, CAST(json_array_length(payload, '$.masterData.actors') AS INTEGER) AS actors_count,
        CAST(json_array_length(payload, '$.masterData.abilities') AS INTEGER) AS abilities_count FROM reports_raw""",
    "payload_master_actors": f"""{RAW} SELECT report_code, {_get('id', 'BIGINT')} AS actor_id, {_get('gameID', 'BIGINT')} AS game_id, {_get('name', 'VARCHAR')} AS name, {_get('type', 'VARCHAR')} AS actor_type,
        {_get('subType', 'VARCHAR')} AS sub_type, {_get('petOwner', 'BIGINT')} AS pet_owner_id, {_get('server', 'VARCHAR')} AS server, {_get('icon', 'VARCHAR')} AS icon FROM ({_items('reports_raw', '$.masterData.actors', 'report_code')})""",
    "payload_master_abilities": f"""{RAW} SELECT report_code, {_get('gameID', 'BIGINT')} AS ability_game_id, {_get('name', 'VARCHAR')} AS name, {_get('type', 'VARCHAR')} AS ability_type, {_get('icon', 'VARCHAR')} AS icon
        FROM ({_items('reports_raw', '$.masterData.abilities', 'report_code')})""",
    "payload_fights": f"""{RAW} SELECT report_code, {_get('id', 'BIGINT')} AS fight_id, coalesce({_get('encounterID', 'BIGINT')}, 0) AS encounter_id, {_get('name', 'VARCHAR')} AS fight_name, {_get('startTime', 'BIGINT')} AS start_time_ms,
        {_get('endTime', 'BIGINT')} AS end_time_ms, {_get('endTime', 'BIGINT')} - {_get('startTime', 'BIGINT')} AS duration_ms, {_get('kill', 'BOOLEAN')} AS kill, {_get('difficulty', 'BIGINT')} AS difficulty, {_get('size', 'BIGINT')} AS size,
        {_get('bossPercentage', 'DOUBLE')} AS boss_percentage, {_get('keystoneLevel', 'BIGINT')} AS keystone_level, {_get('keystoneTime', 'BIGINT')} AS keystone_time_ms, coalesce({_get('encounterID', 'BIGINT')}, 0) <> 0 AS is_boss
        FROM ({_items('reports_raw', '$.fights', 'report_code')})""",
    "payload_player_details": f"""{RAW}, blocks AS (SELECT report_code, coalesce(json_extract(payload, '$.data.playerDetails'), json_extract(payload, '$.playerDetails')) AS d FROM details_raw WHERE json_valid(payload)),
        sides AS (SELECT report_code, role, json_extract(d, '$.' || role)::VARCHAR AS payload FROM blocks, (SELECT unnest(['tanks', 'healers', 'dps']) AS role))
        SELECT report_code, role, {_get('id', 'BIGINT')} AS player_id, {_get('guid', 'BIGINT')} AS player_guid, {_get('name', 'VARCHAR')} AS player_name, {_get('server', 'VARCHAR')} AS server, {_get('region', 'VARCHAR')} AS region,
        {_get('type', 'VARCHAR')} AS class_name, {_get('icon', 'VARCHAR')} AS icon, {_get('minItemLevel', 'BIGINT')} AS min_item_level, {_get('maxItemLevel', 'BIGINT')} AS max_item_level, {_get('potionUse', 'BIGINT')} AS potion_use,
        {_get('healthstoneUse', 'BIGINT')} AS healthstone_use, '[]' AS specs_json, '{{}}' AS combatant_info_json, e::VARCHAR AS player_json FROM ({_items('sides', '$', 'report_code, role')})""",
    "payload_roster": f"""{RAW} SELECT 77::BIGINT AS guild_id, 'Les Gardiens' AS guild_name, 'eu' AS server_region, CASE WHEN even THEN {_get('server.slug', 'VARCHAR')} ELSE 'hyjal' END AS server_slug,
        {_get('id', 'BIGINT')} AS log_character_id, {_get('canonicalID', 'BIGINT')} AS canonical_id, coalesce(nullif({_get('canonicalID', 'BIGINT')}, 0), {_get('id', 'BIGINT')}) AS player_guid,
        trim({_get('name', 'VARCHAR')}) AS character_name, {_get('classID', 'INTEGER')} AS class_id,
        CASE WHEN {_get('classID', 'INTEGER')} BETWEEN 1 AND 13 THEN ['Warrior', 'Paladin', 'Hunter', 'Rogue', 'Priest', 'Death Knight', 'Shaman', 'Mage', 'Warlock', 'Monk', 'Druid', 'Demon Hunter', 'Evoker'][{_get('classID', 'INTEGER')}] END AS class_name,
        {_get('level', 'BIGINT')} AS character_level, {_get('guildRank', 'BIGINT')} AS guild_rank
        FROM ({_items("(SELECT *, contains(payload, 'name\":null') AS even FROM roster_raw)", '$.members', 'even')}) WHERE trim(coalesce({_get('name', 'VARCHAR')}, '')) <> ''""",
    "payload_catalogue": f"""{W} SELECT report_code, coalesce(guild_id, 5) AS guild_id, coalesce(guild_name, 'Searched') AS guild_name, server_region, server_slug, title, zone_name,
        CASE WHEN {_DAY} % 4 <> 0 THEN owner_name END AS owner_name, CAST(CASE WHEN {_DAY} % 3 = 0 THEN 900 WHEN {_DAY} % 4 <> 0 THEN owner_user_id END AS BIGINT) AS owner_user_id,
        CASE WHEN {_DAY} % 2 = 0 THEN log_source ELSE 'guild' END AS log_source, visibility, start_time_ms, end_time_ms FROM b_reports""",
}
