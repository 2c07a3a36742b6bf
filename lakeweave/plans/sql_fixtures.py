"""DuckDB text of the family fixtures (mirrors ``sources/fixtures.py``).

Each constant is a comma-free list of CTE bodies to be placed after ``WITH``.
"""

RETAIL_LINES = """
retail_lines AS (
    SELECT
        (CASE WHEN l.l_returnflag = 'R' THEN 'C' ELSE '' END) || CAST(o.o_orderkey AS VARCHAR) AS invoice,
        CAST(l.l_partkey AS VARCHAR) AS stock_code,
        p.p_name AS description,
        CASE WHEN l.l_orderkey % 101 = 0 THEN 'n/a'
             WHEN l.l_suppkey % 61 = 0 THEN '0'
             ELSE CAST(l.l_quantity AS VARCHAR) END AS quantity,
        CASE WHEN o.o_orderkey % 89 = 0 THEN 'unknown'
             ELSE strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') END AS invoice_date,
        CASE WHEN l.l_partkey % 53 = 0 THEN '-' || CAST(p.p_retailprice AS VARCHAR)
             ELSE CAST(p.p_retailprice AS VARCHAR) END AS price,
        CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE CAST(c.c_custkey AS VARCHAR) END AS customer_id,
        n.n_name AS country
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN part p ON l.l_partkey = p.p_partkey,
    LATERAL (SELECT unnest(CASE WHEN l.l_orderkey % 113 = 0 THEN [1, 2] ELSE [1] END) AS _copy) cp
),
retail_typed AS (
    SELECT invoice, stock_code, description,
           TRY_CAST(quantity AS DOUBLE) AS quantity,
           TRY_CAST(invoice_date AS TIMESTAMP) AS invoice_date,
           TRY_CAST(price AS DOUBLE) AS price,
           customer_id, country
    FROM retail_lines
),
clean_orders AS (
    SELECT *, quantity * price AS total_price
    FROM (
        SELECT DISTINCT * FROM retail_typed
        WHERE customer_id IS NOT NULL AND quantity IS NOT NULL AND price IS NOT NULL
          AND invoice_date IS NOT NULL
          AND invoice IS NOT NULL AND NOT starts_with(invoice, 'C')
          AND quantity > 0 AND price > 0
    )
),
rfm_base AS (
    SELECT customer_id,
           CAST(floor((epoch_us((SELECT max(invoice_date) FROM clean_orders) + INTERVAL 1 DAY)
                       - epoch_us(max(invoice_date))) / 86400000000) AS INTEGER) AS recency,
           CAST(count(DISTINCT invoice) AS BIGINT) AS frequency,
           sum(total_price) AS monetary
    FROM clean_orders GROUP BY customer_id
),
rfm_edges AS (
    SELECT quantile_cont(recency, 0.2) AS r1, quantile_cont(recency, 0.4) AS r2,
           quantile_cont(recency, 0.6) AS r3, quantile_cont(recency, 0.8) AS r4,
           quantile_cont(monetary, 0.2) AS m1, quantile_cont(monetary, 0.4) AS m2,
           quantile_cont(monetary, 0.6) AS m3, quantile_cont(monetary, 0.8) AS m4,
           count(*) AS n
    FROM rfm_base
),
rfm_scored AS (
    SELECT b.customer_id, b.recency, b.frequency, b.monetary,
           CAST(6 - (1 + (b.recency > e.r1)::INT + (b.recency > e.r2)::INT
                       + (b.recency > e.r3)::INT + (b.recency > e.r4)::INT) AS INTEGER) AS r_score,
           CAST(greatest(1, ceil((row_number() OVER (ORDER BY b.frequency, b.customer_id) - 1) * 5.0
                                  / (e.n - 1))) AS INTEGER) AS f_score,
           CAST(1 + (b.monetary > e.m1)::INT + (b.monetary > e.m2)::INT
                  + (b.monetary > e.m3)::INT + (b.monetary > e.m4)::INT AS INTEGER) AS m_score
    FROM rfm_base b, rfm_edges e
),
rfm_scores AS (
    SELECT customer_id, recency, frequency, monetary, r_score, f_score, m_score,
           CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score,
           r_score + f_score + m_score AS rfm_total,
           CASE WHEN CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) = '555' THEN 'Champion'
                WHEN r_score >= 4 AND f_score >= 4 THEN 'Client fidele'
                WHEN r_score >= 4 AND f_score <= 2 THEN 'Nouveau client'
                WHEN r_score <= 2 AND f_score >= 3 THEN 'Client a risque'
                WHEN r_score <= 2 AND f_score <= 2 THEN 'Client perdu'
                ELSE 'Client moyen' END AS segment,
           CASE WHEN r_score + f_score + m_score >= 13 THEN 'VIP'
                WHEN r_score + f_score + m_score >= 10 THEN 'Fidele'
                WHEN r_score + f_score + m_score >= 7 THEN 'Regulier'
                WHEN r_score + f_score + m_score >= 4 THEN 'A risque'
                ELSE 'Inactif' END AS categorisation
    FROM rfm_scored
)
"""

CLIMATE = """
climate_g AS (
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day,
           min(l_quantity) AS qmin, max(l_quantity) AS qmax,
           CAST(sum(round(l_discount * 100)) AS BIGINT) AS rr10,
           min(l_linenumber) AS lmin, max(l_linenumber) AS lmax, count(*) AS cnt
    FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
),
climate_f AS (
    SELECT g.*, s.s_suppkey AS k, s.s_nationkey,
           (g.day >= DATE '1999-01-01' AND g.day < DATE '1999-02-01') AS in_overlap,
           unnest(CASE WHEN g.day >= DATE '1999-01-01' AND g.day < DATE '1999-02-01' THEN [1, 2]
                       WHEN g.day < DATE '1999-01-01' THEN [1] ELSE [2] END) AS _file
    FROM climate_g g JOIN supplier s ON g.l_suppkey = s.s_suppkey
),
climate_raw AS (
    SELECT _file,
        CAST(59000000 + k AS VARCHAR) AS NUM_POSTE,
        'STATION_' || lpad(CAST(k % 37 AS VARCHAR), 2, '0') AS NOM_USUEL,
        '50.' || lpad(CAST((k * 7919) % 100000 AS VARCHAR), 5, '0') AS LAT,
        '3.' || lpad(CAST((k * 104729) % 100000 AS VARCHAR), 5, '0') AS LON,
        CAST(s_nationkey * 10 + k % 7 AS VARCHAR) AS ALTI,
        strftime(day, '%Y%m%d') AS AAAAMMJJ,
        CAST(rr10 // 10 AS VARCHAR) || '.' || CAST(rr10 % 10 AS VARCHAR) AS RR,
        '1' AS QRR,
        CASE WHEN k % 10 = 9 THEN NULL
             WHEN k % 23 = 0 AND dayofmonth(day) = 1 THEN '-999'
             ELSE CAST(CAST(qmin AS BIGINT) - 20 AS VARCHAR) END AS TN,
        CASE WHEN k % 10 != 9 THEN '1' END AS QTN,
        CASE WHEN k % 10 != 9 THEN CAST((lmin * 137 + k) % 2400 AS VARCHAR) END AS HTN,
        CASE WHEN k % 10 != 9 THEN '9' END AS QHTN,
        CASE WHEN k % 10 = 9 THEN NULL
             WHEN (k + dayofyear(day)) % 7 = 0 THEN NULL
             ELSE CAST(CAST(qmax AS BIGINT) - 10 - (CASE WHEN in_overlap AND _file = 1 THEN 1 ELSE 0 END) AS VARCHAR) END AS TX,
        CASE WHEN k % 10 != 9 THEN '1' END AS QTX,
        CASE WHEN k % 10 != 9 THEN CAST((lmax * 211 + k * 3) % 2400 AS VARCHAR) END AS HTX,
        CASE WHEN k % 10 != 9 THEN '9' END AS QHTX,
        CAST(cnt % 3 AS VARCHAR) AS DG,
        '1' AS QDG
    FROM climate_f
),
climate_typed AS (
    SELECT _file,
        CAST(NUM_POSTE AS BIGINT) AS station_id, NOM_USUEL AS station_nom,
        strptime(AAAAMMJJ, '%Y%m%d') AS date_mesure,
        CAST(RR AS DOUBLE) AS quantite_precipitations, CAST(QRR AS BIGINT) AS qualite_quantite_precipitations,
        CAST(TN AS DOUBLE) AS temp_min, CAST(QTN AS BIGINT) AS qualite_temp_min,
        CAST(TX AS DOUBLE) AS temp_max, CAST(QTX AS BIGINT) AS qualite_temp_max,
        try_strptime(AAAAMMJJ || lpad(HTN, 4, '0'), '%Y%m%d%H%M') AS temp_min_at,
        CAST(QHTN AS BIGINT) AS qualite_heure_temp_min,
        try_strptime(AAAAMMJJ || lpad(HTX, 4, '0'), '%Y%m%d%H%M') AS temp_max_at,
        CAST(QHTX AS BIGINT) AS qualite_heure_temp_max,
        CAST(DG AS BIGINT) AS duree_gel, CAST(QDG AS BIGINT) AS qualite_duree_gel,
        CAST(ALTI AS BIGINT) AS altitude, CAST(LON AS DOUBLE) AS longitude, CAST(LAT AS DOUBLE) AS latitude
    FROM climate_raw
),
climat_data AS (
    SELECT * EXCLUDE (_file, _rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY station_id, date_mesure ORDER BY _file DESC) AS _rn
        FROM climate_typed) WHERE _rn = 1
),
climate_daily AS (
    SELECT station_id, station_nom, CAST(date_mesure AS DATE) AS date_mesure,
           CAST(year(date_mesure) AS INTEGER) AS annee, CAST(month(date_mesure) AS INTEGER) AS mois,
           CAST(day(date_mesure) AS INTEGER) AS jour, temp_min, temp_max, latitude, longitude
    FROM climat_data WHERE temp_max IS NOT NULL
),
climate_normals AS (
    SELECT station_id, max(station_nom) AS station_nom, mois, jour,
           round(avg(temp_min), 2) AS tn_moy, round(min(temp_min), 2) AS tn_min_hist,
           round(max(temp_min), 2) AS tn_max_hist, round(avg(temp_max), 2) AS tx_moy,
           round(min(temp_max), 2) AS tx_min_hist, round(max(temp_max), 2) AS tx_max_hist,
           CAST(count(temp_min) AS BIGINT) AS nb_annees_tn, CAST(count(temp_max) AS BIGINT) AS nb_annees_tx,
           max(latitude) AS latitude, max(longitude) AS longitude
    FROM climate_daily GROUP BY station_id, mois, jour
),
climate_day AS (
    SELECT d.station_id, d.station_nom, d.date_mesure, d.annee, d.mois, d.jour, d.temp_min, d.temp_max,
           n.tn_moy AS tn_moy_normale, n.tx_moy AS tx_moy_normale,
           round(d.temp_min - n.tn_moy, 2) AS ecart_tn_normale,
           round(d.temp_max - n.tx_moy, 2) AS ecart_tx_normale
    FROM climate_daily d LEFT JOIN climate_normals n
      ON n.station_id = d.station_id AND n.mois = d.mois AND n.jour = d.jour
),
climate_rain_month AS (
    SELECT station_id, max(station_nom) AS station_nom,
           CAST(year(date_mesure) AS INTEGER) AS annee, CAST(month(date_mesure) AS INTEGER) AS mois,
           round(sum(quantite_precipitations), 1) AS rr_sum_mm,
           CAST(count(*) FILTER (WHERE quantite_precipitations > 0) AS BIGINT) AS nb_jours_pluie,
           max(latitude) AS latitude, max(longitude) AS longitude
    FROM climat_data WHERE quantite_precipitations IS NOT NULL
    GROUP BY station_id, year(date_mesure), month(date_mesure)
)
"""

_NAMES = ("['Flacon de puissance alchimique', 'Well Fed', 'Healthstone', 'Tempered Potion', "
          "'Crystallized Augment Rune', 'Huile d''arme algari', 'Fireball', 'Boule de feu', "
          "'Shadow Word: Pain', 'Festin copieux', 'Pierre de soins', 'Melee']")
_CLASSES = ("['Warrior', 'Paladin', 'Hunter', 'Rogue', 'Priest', 'Death Knight', 'Shaman', 'Mage', "
            "'Warlock', 'Monk', 'Druid', 'Demon Hunter', 'Evoker']")

COMBAT_BRONZE = f"""
cb_ev AS (
    SELECT event_id, user_id, event_type AS src_type, value,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CAST(ts AS DATE) AS day, 'R' || strftime(ts, '%Y%m%d') AS report_code,
           hour(ts) // 4 AS block,
           (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 1000 AS ts_ms,
           dayofmonth(ts) AS dom
    FROM events
),
b_reports AS (
    SELECT report_code,
           CASE WHEN dom % 3 IN (0, 1) THEN 77 + dom % 3 END AS guild_id,
           CASE dom % 3 WHEN 0 THEN 'Les Gardiens' WHEN 1 THEN 'Les Veilleurs' END AS guild_name,
           'EU' AS server_region, 'hyjal' AS server_slug,
           'Raid ' || strftime(day, '%Y-%m-%d') AS title,
           CASE WHEN dom % 2 = 0 THEN 'Palais des Nerubiens' ELSE 'Liberation of Undermine' END AS zone_name,
           'owner_' || CAST(dom % 4 AS VARCHAR) AS owner_name, 500 + dom % 4 AS owner_user_id,
           CASE WHEN dom % 3 IN (0, 1) THEN 'guild' ELSE 'personal' END AS log_source,
           'public' AS visibility,
           epoch_ms(CAST(day AS TIMESTAMP)) AS start_time_ms,
           epoch_ms(CAST(day AS TIMESTAMP)) + 86400000 AS end_time_ms
    FROM (SELECT DISTINCT report_code, day, dom FROM cb_ev)
),
b_fights AS (
    SELECT report_code, CAST(block + 1 AS BIGINT) AS fight_id,
           CAST(CASE WHEN block % 2 = 1 THEN 2900 + block WHEN dom % 2 = 1 THEN 0 END AS BIGINT) AS encounter_id,
           CASE block WHEN 1 THEN 'Ulgrax the Devourer' WHEN 3 THEN 'The Bloodbound Horror'
                      WHEN 5 THEN 'Queen Ansurek' ELSE 'Trash' END AS fight_name,
           CAST(block * 14400000 AS BIGINT) AS start_time_ms,
           CAST(block * 14400000 + CASE WHEN dom % 10 = 5 AND block = 0 THEN 0 ELSE 14400000 END AS BIGINT) AS end_time_ms,
           CAST(CASE WHEN dom % 10 = 5 AND block = 0 THEN 0 ELSE 14400000 END AS BIGINT) AS duration_ms,
           CASE WHEN block % 2 = 1 AND dom % 3 != 0 THEN (dom + block) % 2 = 0 END AS kill,
           CAST(CASE WHEN block % 2 = 1 THEN CASE WHEN dom % 7 = 0 THEN 2 ELSE 3 + dom % 3 END END AS BIGINT) AS difficulty,
           CAST(20 AS BIGINT) AS size,
           CASE WHEN block % 2 = 1 THEN
                CASE WHEN (CASE WHEN dom % 3 != 0 THEN (dom + block) % 2 = 0 END) THEN 0.0
                     ELSE CAST((dom * 7 + block * 13) % 100 AS DOUBLE) + 0.5 END END AS boss_percentage,
           CASE WHEN block = 4 THEN CAST(dom % 15 + 2 AS DOUBLE) END AS keystone_level,
           CAST(CASE WHEN block = 4 THEN 1800000 + dom * 1000 END AS BIGINT) AS keystone_time_ms,
           block % 2 = 1 AS is_boss
    FROM (SELECT DISTINCT report_code, dom, block FROM cb_ev)
),
b_actors AS (
    SELECT report_code, user_id AS actor_id,
           CASE WHEN user_id % 5 = 0 THEN 50000 + user_id ELSE 7000000 + user_id END AS game_id,
           CASE WHEN user_id % 5 = 0 THEN 'pet_' ELSE 'player_' END || CAST(user_id AS VARCHAR) AS name,
           CASE WHEN user_id % 5 = 0 THEN 'Pet' ELSE 'Player' END AS actor_type,
           CASE WHEN user_id % 5 = 0 THEN 'Pet' ELSE {_CLASSES}[user_id % 13 + 1] END AS sub_type,
           CASE WHEN user_id % 5 = 0 THEN user_id + 1 END AS pet_owner_id,
           CASE WHEN user_id % 5 = 0 THEN NULL WHEN user_id % 4 = 0 THEN 'Ysondre' ELSE 'Hyjal' END AS server
    FROM (SELECT DISTINCT report_code, user_id FROM cb_ev)
    UNION ALL
    SELECT report_code, 1000 + k, 200000 + k, 'npc_' || CAST(k AS VARCHAR), 'NPC', 'NPC', NULL, NULL
    FROM (SELECT DISTINCT report_code, k FROM cb_ev)
),
b_abilities AS (
    SELECT report_code, 100 + ai AS ability_game_id, {_NAMES}[ai + 1] AS name,
           CASE WHEN ai IN (0, 1, 4, 5, 9) THEN 'buff' ELSE 'spell' END AS ability_type
    FROM (SELECT DISTINCT report_code, k % 12 AS ai FROM cb_ev)
),
cb_typed AS (
    SELECT *, CAST(round(value * 100) AS BIGINT) AS amount,
           CASE src_type
             WHEN 'purchase' THEN CASE WHEN event_id % 10 = 0 THEN 'absorbed' ELSE 'damage' END
             WHEN 'click' THEN CASE WHEN event_id % 4 = 0 THEN 'cast' ELSE 'heal' END
             WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 'interrupt' WHEN 1 THEN 'dispel' ELSE 'death' END
             WHEN 'view' THEN CASE WHEN event_id % 5 = 0 THEN 'refreshbuff' ELSE 'applybuff' END
             ELSE 'removebuff' END AS etype,
           CAST(CASE WHEN event_id % 50 = 0 THEN NULL ELSE block + 1 END AS BIGINT) AS fight
    FROM cb_ev
),
b_events AS (
    SELECT report_code, fight AS fight_id, event_id // 100 AS page_index, event_id % 100 AS event_index,
           ts_ms AS timestamp_ms, etype AS event_type,
           CAST(CASE WHEN etype = 'damage' AND k % 2 = 1 THEN 1000 + k WHEN etype = 'death' THEN NULL
                     ELSE user_id END AS BIGINT) AS source_id,
           CAST(CASE WHEN etype = 'damage' THEN CASE WHEN k % 2 = 0 THEN 1000 + k ELSE user_id END
                     WHEN etype IN ('absorbed', 'applybuff', 'refreshbuff', 'removebuff', 'death') THEN user_id
                     WHEN etype = 'heal' THEN user_id + 1
                     WHEN etype IN ('interrupt', 'dispel') THEN 1000 + k END AS BIGINT) AS target_id,
           CAST(100 + k % 12 AS BIGINT) AS ability_game_id,
           CASE etype
             WHEN 'damage' THEN '{{' || CASE WHEN event_id % 13 = 0 THEN '' ELSE '"amount":' || CAST(amount AS VARCHAR) || ',' END
                  || '"unmitigatedAmount":' || CAST(amount + event_id % 50 AS VARCHAR)
                  || ',"absorbed":' || CAST(event_id % 7 AS VARCHAR)
                  || ',"overkill":' || CASE WHEN event_id % 11 = 0 THEN '10' ELSE '0' END
                  || ',"hitType":' || CASE WHEN event_id % 3 = 0 THEN '2' ELSE '1' END
                  || ',"tick":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END || '}}'
             WHEN 'heal' THEN '{{"amount":' || CAST(amount AS VARCHAR) || ',"overheal":' || CAST((event_id % 17) * 10 AS VARCHAR) || '}}'
             WHEN 'absorbed' THEN '{{"amount":' || CAST(amount AS VARCHAR) || '}}'
             WHEN 'death' THEN '{{"killerID":' || CAST(1000 + k AS VARCHAR) || '}}'
             WHEN 'applybuff' THEN '{{"stack":1}}' WHEN 'refreshbuff' THEN '{{"stack":1}}'
             ELSE '{{}}' END AS event_json
    FROM cb_typed
    UNION ALL
    SELECT report_code, fight, event_id // 100, event_id % 100 + 100, CAST(block * 14400000 AS BIGINT),
           'combatantinfo', CAST(user_id AS BIGINT), NULL, NULL,
           '{{"specID":' || CAST(250 + user_id % 30 AS VARCHAR) || ',"faction":' || CAST(user_id % 2 AS VARCHAR)
           || ',"gear":[' || CASE WHEN user_id % 17 = 0 THEN '{{"itemLevel":0}},{{"itemLevel":1}}'
                 ELSE '{{"itemLevel":' || CAST(600 + k AS VARCHAR) || '}},{{"itemLevel":1}},{{"itemLevel":'
                      || CAST(610 + user_id % 20 AS VARCHAR) || '}}' END
           || '],"auras":[{{"source":' || CAST(user_id AS VARCHAR) || ',"ability":' || CAST(100 + k % 12 AS VARCHAR)
           || ',"stacks":1,"name":"' || {_NAMES}[k % 12 + 1] || '"}},{{"source":' || CAST(user_id AS VARCHAR)
           || ',"ability":' || CAST(100 + (k + 5) % 12 AS VARCHAR) || ',"stacks":1,"name":""}}]}}'
    FROM cb_typed WHERE src_type = 'view' AND event_id % 3 = 0
),
b_roster AS (
    SELECT 77 AS guild_id, 'Les Gardiens' AS guild_name, 'EU' AS server_region,
           CASE WHEN user_id % 4 = 0 THEN 'ysondre' ELSE 'hyjal' END AS server_slug,
           CASE WHEN user_id % 4 IN (0, 2) THEN user_id ELSE 90000 + user_id END AS log_character_id,
           CASE WHEN user_id % 4 = 1 THEN 7000000 + user_id END AS canonical_id,
           CASE WHEN user_id % 4 = 0 THEN 7000000 + user_id ELSE 8000000 + user_id END AS player_guid,
           CASE WHEN user_id % 4 = 3 THEN ' PLAYER_' || CAST(user_id AS VARCHAR) || ' '
                WHEN user_id % 4 = 0 THEN 'player_' || CAST(user_id AS VARCHAR)
                ELSE 'Perso_' || CAST(user_id AS VARCHAR) END AS character_name,
           CAST(user_id % 13 + 1 AS INTEGER) AS class_id, 80 AS character_level, user_id % 5 AS guild_rank
    FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 3 = 0)
    UNION ALL
    SELECT 77, 'Les Gardiens', 'EU', 'ysondre', 95000 + user_id, NULL, 8500000 + user_id,
           'player_' || CAST(user_id AS VARCHAR), CAST(user_id % 13 + 1 AS INTEGER), 80, 9
    FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 12 = 0)
),
b_player_details AS (
    SELECT report_code, ['tanks', 'healers', 'dps'][(actor_id % 13) % 3 + 1] AS role,
           actor_id AS player_id, game_id AS player_guid, name AS player_name, server, 'EU' AS region,
           sub_type AS class_name, 600 + actor_id % 40 AS min_item_level, 605 + actor_id % 40 AS max_item_level,
           actor_id % 3 AS potion_use, actor_id % 2 AS healthstone_use
    FROM b_actors WHERE actor_type = 'Player'
)
"""


def _unesc(x):
    return (f"replace(replace(replace(replace({x}, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), "
            f"'&amp;', '&')")


def _strip(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _collapse(x):
    return f"regexp_replace({_strip(x)}, '\\s+', ' ', 'g')"


def _first(pattern):
    return (f"CASE WHEN regexp_matches(block, '{pattern}') "
            f"THEN {_strip(_unesc(f'regexp_extract(block, {chr(39)}{pattern}{chr(39)}, 1)'))} END")


def _tags(x):
    return f"nullif({_collapse(_unesc(f'regexp_replace({x}, {chr(39)}(?s)<[^>]+>{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})'))}, '')"


_P_UID = 'data-global-modal-review-id="([^"]+)"'
_P_AUTHOR = '(?s)<p class="skp-review-item__info">\\s*(.*?)\\s*</p>'
_P_DATE = '(?s)<p class="skp-review-item__date">\\s*(.*?)\\s*</p>'
_P_TEXT = '(?s)<p class="skp-review-item__text[^"]*">\\s*(.*?)\\s*</p>'
_P_EXP = '(?s)<p class="skp-review-item__summary">\\s*Expérience du:\\s*(.*?)\\s*</p>'
_P_RH = '(?s)<p class="skp-review-moderation__header">\\s*(.*?)\\s*</p>'
_P_RT = '(?s)<div class="skp-review-moderation__text">\\s*(.*?)\\s*</div>'

REVIEWS = f"""
rv_docs AS (
    SELECT doc_id, text,
           CAST(doc_id % 31 + 1 AS VARCHAR) AS d_txt,
           ['janv.', 'févr.', 'mars', 'avr.', 'mai', 'juin', 'juil.', 'août', 'sept.', 'oct.', 'nov.', 'déc.'][(doc_id // 31) % 12 + 1] AS mon,
           CAST(2023 + (doc_id // 372) % 3 AS VARCHAR) AS y_txt
    FROM documents
),
rv_blocks AS (
    SELECT doc_id // 20 AS page_no, doc_id,
        '<li id="reviews__item__' || CAST(doc_id AS VARCHAR) || '" class="skp-review-item">' || chr(10)
        || CASE WHEN doc_id % 41 = 0 THEN '' ELSE '<div data-global-modal-review-id="rv-' || CAST(doc_id AS VARCHAR) || '"></div>' || chr(10) END
        || '<p class="skp-review-item__info">' || chr(10) || '  Client ' || CAST(doc_id % 97 AS VARCHAR) || chr(10) || '</p>' || chr(10)
        || CASE WHEN doc_id % 23 = 0 THEN '' ELSE '<span data-rating="' || CAST(doc_id % 5 + 1 AS VARCHAR) || '"></span>' || chr(10) END
        || '<p class="skp-review-item__date">'
        || CASE WHEN doc_id % 29 = 0 THEN d_txt || ' janvier ' || y_txt ELSE d_txt || ' ' || mon || ' ' || y_txt END
        || '</p>' || chr(10)
        || '<p class="skp-review-item__text skp-review-item__text--full">'
        || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')
        || '</p>' || chr(10)
        || '<p class="skp-review-item__summary">Expérience du: ' || CAST((doc_id + 3) % 28 + 1 AS VARCHAR) || ' ' || mon || ' ' || y_txt || '</p>' || chr(10)
        || CASE WHEN doc_id % 3 = 0 THEN '<p class="skp-review-moderation__header">Réponse de <b>la boutique</b></p>' || chr(10)
                || '<div class="skp-review-moderation__text">Merci &amp; à bientôt (' || CAST(doc_id AS VARCHAR) || ')</div>' || chr(10) ELSE '' END
        || CASE WHEN doc_id % 9 = 0 THEN '<p class="skp-review-moderation__header">Suivi <i>client</i></p>' || chr(10) ELSE '' END
        || '</li>' || chr(10) AS b
    FROM rv_docs
),
rv_pages AS (
    SELECT page_no, '<html><body><ul class="reviews">' || chr(10) || string_agg(b, '' ORDER BY doc_id) || '</ul></body></html>' AS html
    FROM rv_blocks GROUP BY page_no
),
rv_parts AS (
    SELECT page_no, unnest(p) AS block, unnest(generate_series(0, len(p) - 1)) AS block_pos
    FROM (SELECT page_no, regexp_split_to_array(html, '<li id="reviews__item__[0-9]+" class="skp-review-item"') AS p FROM rv_pages)
),
rv_fields AS (
    SELECT page_no, block_pos,
        {_first(_P_UID)} AS review_uid,
        {_first(_P_AUTHOR)} AS author0,
        regexp_extract(block, 'data-rating="([0-9]+)"', 1) AS rating_raw,
        {_first(_P_DATE)} AS review_date_raw,
        {_first(_P_EXP)} AS experience_date_raw,
        {_first(_P_TEXT)} AS text0,
        regexp_extract_all(block, '{_P_RH}', 1) AS hs,
        regexp_extract_all(block, '{_P_RT}', 1) AS ts
    FROM rv_parts WHERE block_pos > 0
),
rv_first AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY review_uid ORDER BY page_no, block_pos) AS _rn
                   FROM rv_fields WHERE review_uid IS NOT NULL AND review_uid != '') WHERE _rn = 1
),
reviews AS (
    SELECT review_uid, {_collapse("coalesce(author0, '')")} AS author,
           CASE WHEN rating_raw != '' THEN CAST(rating_raw AS INTEGER) END AS rating,
           review_date_raw, experience_date_raw,
           {_collapse("coalesce(text0, '')")} AS review_text,
           'review-site' AS source
    FROM rv_first
),
responses AS (
    SELECT * FROM (
        SELECT review_uid, CAST(i AS INTEGER) AS response_rank,
               {_tags("hs[i]")} AS response_header_raw,
               {_tags("ts[i]")} AS response_text_raw
        FROM rv_first, LATERAL (SELECT unnest(generate_series(1, greatest(len(hs), len(ts)))) AS i)
    ) WHERE response_header_raw IS NOT NULL OR response_text_raw IS NOT NULL
),
reviews_dated AS (
    SELECT * EXCLUDE (parts, mm),
           CASE WHEN len(parts) = 3 AND regexp_full_match(parts[1], '[0-9]+') AND regexp_full_match(parts[3], '[0-9]+')
                     AND mm IS NOT NULL
                THEN CAST(try_strptime(parts[3] || '-' || CAST(mm AS VARCHAR) || '-' || parts[1], '%Y-%m-%d') AS DATE) END
           AS review_date_parsed
    FROM (SELECT *, CASE parts[2] WHEN 'janv' THEN 1 WHEN 'fevr' THEN 2 WHEN 'fev' THEN 2 WHEN 'mars' THEN 3
                        WHEN 'avr' THEN 4 WHEN 'mai' THEN 5 WHEN 'juin' THEN 6 WHEN 'juil' THEN 7 WHEN 'aout' THEN 8
                        WHEN 'sept' THEN 9 WHEN 'oct' THEN 10 WHEN 'nov' THEN 11 WHEN 'dec' THEN 12 END AS mm
          FROM (SELECT *, string_split_regex({_strip("replace(translate(lower(" + _strip("coalesce(review_date_raw, '')") + "), 'éèêàû', 'eeeau'), '.', '')")}, '\\s+') AS parts
                FROM reviews))
),
sentiment AS (
    SELECT CAST(d.doc_id AS VARCHAR) AS review_id, {_strip("d.text")} AS review_text,
           CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS polarity,
           make_timestamp((1700000000 + d.doc_id * 3600) * 1000000) AS created_at, d.doc_id
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)
"""

REFERENCE = r"""
items_rows AS (
    SELECT row_no,
           CASE WHEN row_no % 50 = 0 THEN ' ' ELSE upper(substr(t, 1, 1)) || lower(substr(t, 2)) END AS favorite_category,
           chair_item, medium_item, small_item
    FROM (SELECT p_partkey // 3 AS row_no, arg_min(p_type, p_partkey) AS t,
                 max(CASE WHEN p_partkey % 3 = 0 THEN cell END) AS chair_item,
                 max(CASE WHEN p_partkey % 3 = 1 THEN cell END) AS medium_item,
                 max(CASE WHEN p_partkey % 3 = 2 THEN cell END) AS small_item
          FROM (SELECT *, CASE WHEN p_size % 10 = 0 THEN '' ELSE INITCAP_NAME END AS cell FROM part)
          GROUP BY p_partkey // 3)
),
themes_t AS (
    SELECT regexp_replace(coalesce(favorite_category, ''), '^\s+|\s+$', '', 'g') AS theme, row_no FROM items_rows
),
items AS (
    SELECT i.row_no, t.theme AS gift_theme_valeur, regexp_replace(coalesce(u.name, ''), '^\s+|\s+$', '', 'g') AS name,
           u.type_valeur, u.slot
    FROM items_rows i JOIN themes_t t ON i.row_no = t.row_no,
         LATERAL (SELECT unnest([i.chair_item, i.medium_item, i.small_item]) AS name,
                         unnest(['chair', 'medium', 'small']) AS type_valeur, unnest([0, 1, 2]) AS slot) u
    WHERE t.theme != '' AND regexp_replace(coalesce(u.name, ''), '^\s+|\s+$', '', 'g') != ''
),
gift_themes AS (SELECT theme AS valeur, min(row_no) AS first_row FROM themes_t WHERE theme != '' GROUP BY theme),
species AS (
    SELECT INITCAP_NAME || ' #' || CAST(p_partkey AS VARCHAR) AS nom, p_partkey AS num,
           string_split(p_name, ' ') AS specialties,
           CASE WHEN p_size % 7 = 0 THEN '' ELSE INITCAP_BRAND END AS ideal_habitat,
           [CASE p_partkey % 4 WHEN 0 THEN 'Lots of ' || lower(p_type) WHEN 1 THEN INITCAP_TYPE
                               WHEN 2 THEN lower(p_type) || '  stuff' ELSE 'Unknown thing' END, INITCAP_TYPE] AS favorites
    FROM part
)
"""


def _initcap(col):
    # Spark initcap: first letter of each space-separated word upper, the rest lower
    return (f"array_to_string(list_transform(string_split(lower({col}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


REFERENCE = (REFERENCE.replace("INITCAP_NAME", _initcap("p_name"))
             .replace("INITCAP_BRAND", _initcap("regexp_replace(p_brand, '#', ' ', 'g')"))
             .replace("INITCAP_TYPE", _initcap("p_type")))

SALES = r"""
sales_lines AS (
    SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS event_date, r.r_name AS region, p.p_brand AS product,
           CAST(l.l_quantity AS INTEGER) AS quantity, p.p_retailprice AS unit_price
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
    JOIN part p ON l.l_partkey = p.p_partkey
),
sales_silver AS (
    SELECT CAST(event_date AS DATE) AS event_date, region, product, quantity, unit_price,
           CAST(quantity AS DOUBLE) * unit_price AS revenue
    FROM sales_lines
)
"""
