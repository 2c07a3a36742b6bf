"""Marts written in Spark SQL over the function surface, persistent views and an appended lake table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sql import register_functions, register_guild_flags
from ..sources.catalog import append, create_views
from ..sources.fixtures import climate_raw
from ..sources.tables import read
from ..streaming.incremental import scratch_root
from . import climate
from . import combat as C


def register_silver(b) -> None:
    """The silver tables as views, for SQL."""
    for name, build in (("reports", C.silver_reports), ("fights", C.silver_fights), ("events", C.silver_events), ("actors", C.silver_actors),
                        ("player_details", C.silver_player_details), ("abilities", C.silver_abilities), ("roster", C.silver_roster)):
        build(b).createOrReplaceTempView(f"silver_{name}")


DEATHS = """
WITH context AS (
    SELECT r.report_start_at, to_date(r.report_start_at) AS report_date, f.report_code, r.guild_name AS report_guild_name, r.zone_name AS raid_or_dungeon, f.fight_id,
        f.fight_name AS boss_name, f.is_boss, f.is_kill, difficulty_label(f.difficulty, f.keystone_level) AS difficulty_label, f.duration_sec, f.duration_ms, f.start_time_ms
    FROM silver_fights f JOIN silver_reports r USING (report_code) WHERE f.duration_sec > 0)
SELECT c.* EXCEPT (duration_sec, duration_ms, start_time_ms), c.duration_sec AS fight_duration_sec, p.resolved_player_name AS player_name, p.player_guid, p.resolved_class AS class_name,
    coalesce(g.is_guild_member, 0) AS is_guild_member, bround((e.timestamp_ms - c.start_time_ms) / 1000.0D, 1) AS death_at_sec,
    bround(try_divide((e.timestamp_ms - c.start_time_ms) * 100.0D, c.duration_ms), 1) AS death_at_pct_of_fight,
    row_number() OVER (PARTITION BY e.report_code, e.fight_id ORDER BY e.timestamp_ms, p.resolved_player_name) AS death_rank, a.name AS killing_ability, k.name AS killer_name
FROM silver_events e
JOIN silver_actors p ON p.report_code = e.report_code AND p.actor_id = e.target_id AND p.resolved_actor_type = 'Player'
JOIN context c ON c.report_code = e.report_code AND c.fight_id = e.fight_id
LEFT JOIN silver_abilities a ON a.report_code = e.report_code AND a.ability_game_id = e.ability_game_id
LEFT JOIN silver_actors k ON k.report_code = e.report_code AND k.actor_id = e.killer_id
LEFT JOIN guild_flags() g ON g.report_code = e.report_code AND g.player_name = p.resolved_player_name
WHERE e.event_type = 'death'"""

# members by the first of their four keys that matches, as one equi-join
MATCHED = """
WITH looked AS (SELECT report_code, actor_id, actor_roster_keys(player_guid, actor_id, resolved_actor_type, resolved_player_name, server) AS ks FROM silver_actors),
known AS (SELECT character_name, player_guid AS guid, member_keys(player_guid, canonical_id, log_character_id, character_name, server_slug) AS ks FROM silver_roster),
found AS (SELECT report_code, actor_id, explode(ks) AS x FROM looked),
member AS (SELECT character_name, guid, explode(ks) AS y FROM known)
SELECT report_code, actor_id, min_by(character_name, struct(x.prio, character_name, guid)) AS roster_character_name, min(x.prio) AS matched_by
FROM found JOIN member ON x.prio = y.prio AND x.k = y.k GROUP BY report_code, actor_id"""

LINKS = """
SELECT page_id, l.href, min(l.pos) AS first_pos, lower(regexp_replace(l.href, '^/+|/+$', '')) AS slug
FROM pages_view p, LATERAL page_links(p.html) l GROUP BY page_id, l.href"""


def _over_silver(statement: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_silver(C.Bronze(spark, sf_dir))
        register_functions(spark)
        register_guild_flags(spark)
        return spark.sql(statement)
    return run


def sql_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    read(spark, sf_dir, "pages").createOrReplaceTempView("pages_view")
    return spark.sql(LINKS)


def climate_views(table: str, tag: str) -> dict[str, str]:
    """Gold views over the curated table, the yearly ones over the monthly and daily ones; in no order."""
    v = lambda name: f"v_{name}_{tag}"
    place = "max(latitude) AS latitude, max(longitude) AS longitude"
    return {
        v("rain_year"): f"""SELECT station_id, max(station_nom) AS station_nom, annee, round(sum(rr_sum_mm), 1) AS rr_sum_annuel, CAST(sum(nb_jours_pluie) AS INT) AS nb_jours_pluie, {place}
            FROM {v('rain_month')} GROUP BY station_id, annee""",
        v("rain_month"): f"""SELECT station_id, max(station_nom) AS station_nom, year(date_mesure) AS annee, month(date_mesure) AS mois, round(sum(quantite_precipitations), 1) AS rr_sum_mm,
            count_if(quantite_precipitations > 0) AS nb_jours_pluie, {place} FROM {table} WHERE quantite_precipitations IS NOT NULL GROUP BY station_id, year(date_mesure), month(date_mesure)""",
        v("hot_cold_year"): f"""SELECT station_id, max(station_nom) AS station_nom, annee, count_if(ecart_tx_normale > 2.0D) AS nb_jours_chauds, count_if(ecart_tn_normale < -2.0D) AS nb_jours_froids,
            max(max(latitude)) OVER (PARTITION BY station_id) AS latitude, max(max(longitude)) OVER (PARTITION BY station_id) AS longitude FROM {v('day')} GROUP BY station_id, annee""",
        v("day"): f"""SELECT d.*, round(d.temp_min - n.tn_moy, 2) AS ecart_tn_normale, round(d.temp_max - n.tx_moy, 2) AS ecart_tx_normale
            FROM (SELECT station_id, station_nom, year(date_mesure) AS annee, month(date_mesure) AS mois, dayofmonth(date_mesure) AS jour, temp_min, temp_max, latitude, longitude FROM {table} WHERE temp_max IS NOT NULL) d
            JOIN {v('normals')} n USING (station_id, mois, jour)""",
        v("normals"): f"""SELECT station_id, month(date_mesure) AS mois, dayofmonth(date_mesure) AS jour, round(avg(temp_min), 2) AS tn_moy, round(avg(temp_max), 2) AS tx_moy
            FROM {table} WHERE temp_max IS NOT NULL GROUP BY station_id, month(date_mesure), dayofmonth(date_mesure)""",
        v("records"): f"SELECT station_id, max(station_nom) AS station_nom, max(temp_max) AS temp_max_record, {place} FROM {table} WHERE temp_max IS NOT NULL GROUP BY station_id",
    }


def _climate_view(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tag = uuid.uuid4().hex[:10]
        append(climate.climat_data(spark, sf_dir), f"climat_data_{tag}", "all", "2024-01-01 00:00:00", scratch_root(spark, "climat-table"))
        create_views(spark, climate_views(f"climat_data_{tag}", tag))
        return spark.table(f"v_{name}_{tag}")
    return run


def lake_appended_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event pages appended in three batches: as they are, with a new column, without one, and the second once more."""
    name = f"lake_events_{uuid.uuid4().hex[:10]}"
    root = scratch_root(spark, "lake-events")
    events = C.Bronze(spark, sf_dir).events.drop("source_instance", "target_instance")
    second = events.where("page_index % 3 = 1").withColumn("resources", F.length("event_json").cast("long"))
    append(events.where("page_index % 3 = 0"), name, "p0", "2024-01-01 00:00:00", root)
    for _ in range(2):
        append(second, name, "p1", "2024-01-02 00:00:00")
    append(events.where("page_index % 3 = 2").drop("ability_game_id"), name, "p2", "2024-01-03 00:00:00")
    return spark.table(name)


def qc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole climate quality report as one nested document (one row: a JSON text)."""
    raw, table = climate_raw(spark, sf_dir), climate.climat_data(spark, sf_dir)
    files = climate.qc_files(raw)
    listed = files.agg(F.sort_array(F.collect_list(F.struct("fichier", *[c for c in files.columns if c != "fichier"]))).alias("fichiers"))      # a row per delivery
    one = lambda df: df.select(F.struct(*df.columns)).scalar()  # noqa: E731  a one-row frame as a scalar subquery
    report = listed.select("fichiers", one(climate.qc_fusion(raw)).alias("f"), one(climate.qc_drift(raw, table)).alias("d"))
    stored = F.struct(F.col("d.table_rows").alias("lignes"), F.col("d.pct_table_null").alias("pct_temp_min_null"))
    return report.select(F.to_json(F.struct("fichiers", "f.fusion_lignes", "f.fusion_pct_tn_null", "f.fusion_chevauchement_cles", stored.alias("postgres"), "d.verdict"), {"ignoreNullFields": "false"}).alias("report"))


def qc_report_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document's files as rows, read from the JSON text."""
    doc = qc_report(spark, sf_dir).select(F.from_json("report", "fichiers array<struct<fichier: int, lignes: long, tn_zero_ete: long, alertes: string>>, fusion_lignes long, fusion_pct_tn_null double, postgres struct<lignes: long, pct_temp_min_null: double>, verdict string").alias("d"))
    return doc.select(F.explode("d.fichiers").alias("f"), "d.*").select("f.*", "fusion_lignes", "fusion_pct_tn_null", F.col("postgres.lignes").alias("table_lignes"), "postgres.pct_temp_min_null", "verdict")


QUERIES = {
    "sql_gold_deaths": _over_silver(DEATHS),
    "sql_guild_flags": _over_silver("SELECT * FROM guild_flags()"),
    "sql_roster_matches": _over_silver(MATCHED),
    "sql_page_links": sql_page_links,
    "climate_view_rain_year": _climate_view("rain_year"),
    "climate_view_hot_cold_year": _climate_view("hot_cold_year"),
    "climate_view_records": _climate_view("records"),
    "lake_appended_pages": lake_appended_pages,
    "climate_qc_report": qc_report_read_back,
}
