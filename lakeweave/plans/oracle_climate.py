"""DuckDB oracles for the climate family."""

from .sql_fixtures import CLIMATE

W = "WITH " + CLIMATE

_PARTS = ("CAST(year(date_mesure) AS INTEGER) AS annee, CAST(month(date_mesure) AS INTEGER) AS mois, "
          "CAST(day(date_mesure) AS INTEGER) AS jour")
_Y = "(SELECT max(year(date_mesure)) FROM climat_data)"


def _rr(num, den):
    """half-up rounding of num/den to 0.1 with integer arithmetic."""
    return f"(({num}) * 20 + ({den})) // (2 * ({den})) / 10.0"


_EVOLUTION = """rec AS (
            SELECT station_id, mois, jour, temp_max AS temp_max_record, annee AS annee_record FROM (
                SELECT *, row_number() OVER (PARTITION BY station_id, mois, jour
                                             ORDER BY temp_max DESC, annee DESC) AS _rn FROM climate_daily)
            WHERE _rn = 1),
        ev AS (SELECT d.station_id, d.station_nom, d.annee, d.date_mesure, d.mois, d.jour,
               d.temp_max AS temp_max_n, n1.temp_max AS temp_max_n1, r.temp_max_record, r.annee_record
        FROM climate_daily d
        LEFT JOIN climate_daily n1 ON d.station_id = n1.station_id AND d.mois = n1.mois
             AND d.jour = n1.jour AND n1.annee = d.annee - 1
        LEFT JOIN rec r ON d.station_id = r.station_id AND d.mois = r.mois AND d.jour = r.jour)"""

ORACLES = {
    "climate_period_series": f"""{W}, {_EVOLUTION}
        SELECT station_id, date_mesure, 'Annee N' AS serie, temp_max_n AS valeur FROM ev WHERE mois >= 11 OR mois <= 2
        UNION ALL SELECT station_id, date_mesure, 'Annee N-1', temp_max_n1 FROM ev WHERE mois >= 11 OR mois <= 2
        UNION ALL SELECT station_id, date_mesure, 'Record', temp_max_record FROM ev WHERE mois >= 11 OR mois <= 2""",
    "climate_qc_files": f"""{W}, r AS (SELECT *, TRY_CAST(TN AS DOUBLE) AS tnv, TRY_CAST(TX AS DOUBLE) AS txv,
                                     month(try_strptime(AAAAMMJJ, '%Y%m%d')) AS m FROM climate_raw),
        st AS (SELECT _file, CAST(count(*) AS BIGINT) AS stations, CAST(sum(h) AS BIGINT) AS stations_avec_tx
               FROM (SELECT _file, NUM_POSTE, max(CASE WHEN txv IS NOT NULL THEN 1 ELSE 0 END) AS h
                     FROM r GROUP BY ALL) GROUP BY _file),
        ky AS (SELECT _file, CAST(sum(n - 1) AS BIGINT) AS doublons_station_date
               FROM (SELECT _file, NUM_POSTE, AAAAMMJJ, count(*) AS n FROM r GROUP BY ALL) GROUP BY _file),
        mn AS (SELECT _file, CAST(count(*) AS BIGINT) AS lignes,
            {_rr("count(*) FILTER (WHERE tnv IS NULL) * 100", "count(*)")} AS pct_tn_null,
            {_rr("count(*) FILTER (WHERE txv IS NULL) * 100", "count(*)")} AS pct_tx_null,
            CAST(count(*) FILTER (WHERE tnv = 0) AS BIGINT) AS tn_zero,
            CAST(count(*) FILTER (WHERE txv = 0) AS BIGINT) AS tx_zero,
            CAST(count(*) FILTER (WHERE tnv IN (-999.0, -9999.0)) AS BIGINT) AS tn_sentinelles,
            CAST(count(*) FILTER (WHERE txv IN (-999.0, -9999.0)) AS BIGINT) AS tx_sentinelles,
            min(tnv) AS tn_min, max(tnv) AS tn_max, min(txv) AS tx_min, max(txv) AS tx_max,
            CAST(count(*) FILTER (WHERE tnv = 0 AND m IN (6, 7, 8)) AS BIGINT) AS tn_zero_ete,
            CAST(count(*) FILTER (WHERE tnv IS NOT NULL AND txv IS NOT NULL AND txv < tnv) AS BIGINT) AS tx_lt_tn,
            CAST(count(*) FILTER (WHERE tnv < -50.0 OR tnv > 50.0) AS BIGINT) AS tn_hors_plage,
            CAST(count(*) FILTER (WHERE txv < -50.0 OR txv > 55.0) AS BIGINT) AS tx_hors_plage
            FROM r GROUP BY _file)
        SELECT mn._file AS fichier, mn.* EXCLUDE (_file), st.stations, st.stations_avec_tx, ky.doublons_station_date,
            st.stations - st.stations_avec_tx AS stations_sans_tx,
            {_rr("st.stations_avec_tx * 100", "st.stations")} AS pct_stations_thermo,
            concat_ws(' | ',
                CASE WHEN tn_hors_plage > 0 THEN printf('%d TN hors plage', tn_hors_plage) END,
                CASE WHEN tn_sentinelles + tx_sentinelles > 0
                     THEN printf('Sentinelles -999 (TN=%d, TX=%d)', tn_sentinelles, tx_sentinelles) END,
                CASE WHEN tn_zero_ete > 50 THEN printf('%d TN=0 en ete', tn_zero_ete) END,
                CASE WHEN tx_lt_tn > 0 THEN printf('%d lignes avec TX < TN', tx_lt_tn) END,
                CASE WHEN pct_tn_null > 60 THEN 'TN vides > 60 %' END) AS alertes
        FROM mn JOIN st ON mn._file = st._file JOIN ky ON mn._file = ky._file""",
    "climate_curate": f"{W} SELECT * FROM climat_data",
    "climate_upsert": f"{W} SELECT * FROM climat_data",
    "climate_records": f"""{W} SELECT station_id, max(station_nom) AS station_nom, max(temp_max) AS temp_max_record,
        max(latitude) AS latitude, max(longitude) AS longitude FROM climat_data
        WHERE temp_max IS NOT NULL GROUP BY station_id""",
    "climate_evolution": f"""{W}, rec AS (
            SELECT station_id, mois, jour, temp_max AS temp_max_record, annee AS annee_record FROM (
                SELECT *, row_number() OVER (PARTITION BY station_id, mois, jour
                                             ORDER BY temp_max DESC, annee DESC) AS _rn FROM climate_daily)
            WHERE _rn = 1)
        SELECT d.station_id, d.station_nom, d.annee, d.date_mesure, d.mois, d.jour,
               d.temp_max AS temp_max_n, n1.temp_max AS temp_max_n1, r.temp_max_record, r.annee_record
        FROM climate_daily d
        LEFT JOIN climate_daily n1 ON d.station_id = n1.station_id AND d.mois = n1.mois
             AND d.jour = n1.jour AND n1.annee = d.annee - 1
        LEFT JOIN rec r ON d.station_id = r.station_id AND d.mois = r.mois AND d.jour = r.jour""",
    "climate_normals": f"{W} SELECT * FROM climate_normals",
    "climate_wettest_month": f"""{W} SELECT station_id, annee,
        arg_max(mois, (rr_sum_mm, mois)) AS mois_le_plus_pluvieux, max(rr_sum_mm) AS rr_mois_max,
        round(sum(rr_sum_mm), 1) AS rr_total_annuel FROM climate_rain_month GROUP BY station_id, annee""",
    "climate_day": f"{W} SELECT * FROM climate_day",
    "climate_rain_month": f"{W} SELECT * FROM climate_rain_month",
    "climate_rain_year": f"""{W} SELECT station_id, max(station_nom) AS station_nom, annee,
        round(sum(rr_sum_mm), 1) AS rr_sum_annuel, CAST(sum(nb_jours_pluie) AS INTEGER) AS nb_jours_pluie,
        max(latitude) AS latitude, max(longitude) AS longitude
        FROM climate_rain_month GROUP BY station_id, annee""",
    "climate_hot_cold_year": f"""{W} SELECT j.station_id, max(j.station_nom) AS station_nom, j.annee,
        CAST(count(*) FILTER (WHERE j.ecart_tx_normale > 2.0) AS BIGINT) AS nb_jours_chauds,
        CAST(count(*) FILTER (WHERE j.ecart_tn_normale < -2.0) AS BIGINT) AS nb_jours_froids,
        max(n.latitude) AS latitude, max(n.longitude) AS longitude
        FROM climate_day j LEFT JOIN (SELECT station_id, max(latitude) AS latitude, max(longitude) AS longitude
                                      FROM climate_normals GROUP BY station_id) n ON n.station_id = j.station_id
        GROUP BY j.station_id, j.annee""",
    "climate_last_day_kpis": f"""{W}, last AS (SELECT max(CAST(date_mesure AS DATE)) AS d FROM climat_data),
        nrm AS (SELECT round(avg(tx_moy), 2) AS moy_max_historique, round(avg(tn_moy), 2) AS moy_min_historique
                FROM climate_normals, last WHERE mois = month(last.d) AND jour = day(last.d))
        SELECT l.d AS date_mesure, min(c.temp_min) AS temp_min_jour, max(c.temp_max) AS temp_max_jour,
               (SELECT moy_max_historique FROM nrm) AS moy_max_historique,
               (SELECT moy_min_historique FROM nrm) AS moy_min_historique,
               CAST(count(*) FILTER (WHERE c.temp_max IS NOT NULL) AS BIGINT) AS nb_postes
        FROM last l JOIN climat_data c ON CAST(c.date_mesure AS DATE) = l.d GROUP BY l.d""",
    "climate_calendar": f"""{W} SELECT station_id, annee, CAST(weekofyear(date_mesure) AS INTEGER) AS semaine,
        CAST(isodow(date_mesure) AS INTEGER) AS jour_semaine, min(temp_max) AS temp_max
        FROM climate_daily GROUP BY ALL""",
    "climate_station_labels": f"""{W}, st AS (SELECT station_id, max(station_nom) AS station_nom
                                          FROM climat_data GROUP BY station_id)
        SELECT station_id, station_nom,
               CASE WHEN count(*) OVER (PARTITION BY station_nom) > 1
                    THEN station_nom || ' (' || CAST(station_id AS VARCHAR) || ')' ELSE station_nom END AS label
        FROM st""",
    "climate_top_temp_max": f"""{W} SELECT station_nom, date_mesure, temp_max FROM climat_data
        ORDER BY temp_max DESC NULLS LAST, station_id, date_mesure LIMIT 100""",
    "climate_year_pivot": f"""{W}, p AS (SELECT *, {_PARTS} FROM climat_data)
        SELECT station_id, station_nom, mois, jour,
            max(CASE WHEN annee = {_Y} THEN temp_max END) AS temp_max_y0,
            max(CASE WHEN annee = {_Y} - 1 THEN temp_max END) AS temp_max_y1,
            max(CASE WHEN annee = {_Y} - 2 THEN temp_max END) AS temp_max_y2,
            max(CASE WHEN annee = {_Y} - 3 THEN temp_max END) AS temp_max_y3
        FROM p WHERE mois BETWEEN 5 AND 8 GROUP BY station_id, station_nom, mois, jour""",
    "climate_years_present": f"""{W}, p AS (SELECT *, {_PARTS} FROM climat_data)
        SELECT station_id, station_nom, mois, jour,
               string_agg(DISTINCT CAST(annee AS VARCHAR), ',' ORDER BY CAST(annee AS VARCHAR)) AS annees_presentes
        FROM p WHERE mois BETWEEN 5 AND 8 GROUP BY station_id, station_nom, mois, jour""",
    "climate_summer_vs_record": f"""{W}, p AS (SELECT *, {_PARTS} FROM climat_data),
        hist AS (SELECT station_id, max(temp_max) AS temp_max_all_time FROM p
                 WHERE annee < {_Y} AND temp_max IS NOT NULL GROUP BY station_id),
        cur AS (SELECT station_id, station_nom, date_mesure, temp_max AS temp_max_target FROM p
                WHERE annee = {_Y} AND mois BETWEEN 5 AND 8)
        SELECT y.station_nom, y.date_mesure, y.temp_max_target, h.temp_max_all_time,
               y.temp_max_target - h.temp_max_all_time AS ecart_vs_record,
               CASE WHEN y.temp_max_target > h.temp_max_all_time THEN 1 ELSE 0 END AS bat_record_absolu
        FROM cur y JOIN hist h ON h.station_id = y.station_id""",
    "climate_summer_max": f"""{W}, p AS (SELECT *, {_PARTS} FROM climat_data
                                      WHERE temp_max IS NOT NULL AND month(date_mesure) BETWEEN 5 AND 8),
        y AS (SELECT max(temp_max) AS m FROM p WHERE annee = {_Y}),
        h AS (SELECT max(temp_max) AS m FROM p WHERE annee < {_Y})
        SELECT y.m AS max_target, h.m AS max_all_time, y.m - h.m AS ecart_vs_record,
               CASE WHEN y.m > h.m THEN 1 ELSE 0 END AS bat_record_absolu FROM y, h""",
    "climate_day_records": f"""{W}, p AS (SELECT *, {_PARTS} FROM climat_data
                                       WHERE temp_max IS NOT NULL AND month(date_mesure) BETWEEN 5 AND 8),
        hist AS (SELECT mois, jour, max(temp_max) AS max_all_time FROM p WHERE annee < {_Y} GROUP BY mois, jour),
        hist_record AS (SELECT h.mois, h.jour, h.max_all_time,
            (SELECT d.annee FROM p d WHERE d.mois = h.mois AND d.jour = h.jour AND d.annee < {_Y}
               AND d.temp_max = h.max_all_time ORDER BY d.annee DESC LIMIT 1) AS annee_record FROM hist h),
        y AS (SELECT mois, jour, max(temp_max) AS max_target FROM p WHERE annee = {_Y} GROUP BY mois, jour)
        SELECT y.mois, y.jour, printf('%d-%02d-%02d', {_Y}, y.mois, y.jour) AS date_target, y.max_target,
               r.max_all_time, r.annee_record, y.max_target - r.max_all_time AS ecart_vs_record,
               CASE WHEN y.max_target > r.max_all_time THEN 1 ELSE 0 END AS bat_record_jour
        FROM y LEFT JOIN hist_record r ON r.mois = y.mois AND r.jour = y.jour""",
    "climate_qc_fusion": f"""{W}, k AS (SELECT NUM_POSTE, AAAAMMJJ, count(DISTINCT _file) AS nf FROM climate_raw GROUP BY ALL)
        SELECT CAST(count(*) AS BIGINT) AS fusion_lignes,
               {_rr("count(*) FILTER (WHERE TRY_CAST(TN AS DOUBLE) IS NULL) * 100", "count(*)")} AS fusion_pct_tn_null,
               (SELECT CAST(count(*) AS BIGINT) FROM k WHERE nf = (SELECT count(DISTINCT _file) FROM climate_raw))
                 AS fusion_chevauchement_cles
        FROM climate_raw""",
    "climate_qc_drift": f"""{W}, x AS (SELECT (SELECT count(*) FROM climat_data) AS table_rows,
            (SELECT {_rr("count(*) FILTER (WHERE temp_min IS NULL) * 100", "count(*)")} FROM climat_data) AS pct_table_null,
            (SELECT {_rr("count(*) FILTER (WHERE TRY_CAST(TN AS DOUBLE) IS NULL) * 100", "count(*)")} FROM climate_raw) AS pct_raw_null)
        SELECT CAST(table_rows AS BIGINT) AS table_rows, pct_table_null, pct_raw_null, round(abs(pct_table_null - pct_raw_null), 1) AS gap,
            CASE WHEN round(abs(pct_table_null - pct_raw_null), 1) < 1.0 THEN 'source' ELSE 'ingestion' END AS verdict FROM x""",
    "climate_qc_transform": f"""{W} SELECT
        CAST(count(*) FILTER (WHERE TRY_CAST(TN AS DOUBLE) IS NULL) AS BIGINT) AS tn_null_brut,
        CAST(count(*) FILTER (WHERE TRY_CAST(TX AS DOUBLE) IS NULL) AS BIGINT) AS tx_null_brut,
        (SELECT CAST(count(*) FILTER (WHERE temp_min IS NULL) AS BIGINT) FROM climate_typed) AS tn_null_apres,
        (SELECT CAST(count(*) FILTER (WHERE temp_max IS NULL) AS BIGINT) FROM climate_typed) AS tx_null_apres,
        ((SELECT count(*) FILTER (WHERE temp_min IS NULL) FROM climate_typed) > count(*) FILTER (WHERE TRY_CAST(TN AS DOUBLE) IS NULL))
        OR ((SELECT count(*) FILTER (WHERE temp_max IS NULL) FROM climate_typed) > count(*) FILTER (WHERE TRY_CAST(TX AS DOUBLE) IS NULL)) AS perte
        FROM climate_raw""",
    "climate_station_completeness": f"""{W} SELECT NUM_POSTE, NOM_USUEL, CAST(count(AAAAMMJJ) AS BIGINT) AS jours,
        CAST(count(TRY_CAST(TX AS DOUBLE)) AS BIGINT) AS jours_tx,
        {_rr("count(TRY_CAST(TX AS DOUBLE)) * 100", "count(AAAAMMJJ)")} AS pct_tx
        FROM climate_raw GROUP BY NUM_POSTE, NOM_USUEL""",
}
