"""F2 operations: ingestion work-queue table (S28, S29, O5, A10) and the
ad-hoc query corpus over the silver/gold tables (§2.13).

The work-queue table is a small state table keyed by report; every
operation is a join + ``when`` over the whole table (no per-row loop).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import ratio_round
from . import combat as C
from . import metrics as M

RUN_TS = "2024-02-01 00:00:00"
STATE_COLS = ["report_code", "status", "title", "start_time_ms", "last_error", "ingestion_attempts",
              "last_ingest_points", "synced_at", "fetched_at", "catalog_json"]
CATALOGUE_COLS = ["report_code", "title", "start_time_ms", "guild_id", "guild_name", "server_region", "server_slug"]


def _catalog_json():
    """The report, its guild and the keys it was found by."""
    return F.to_json(F.struct(
        F.struct(F.col("report_code").alias("code"), F.col("title"), F.col("start_time_ms").alias("startTime")).alias("report"),
        F.struct(F.col("guild_id").alias("id"), F.col("guild_name").alias("name")).alias("guild"),
        F.struct("guild_name", "server_region", "server_slug").alias("keys")), {"ignoreNullFields": "false"})


def state_before(b: C.Bronze) -> DataFrame:
    """Work-queue rows as left by earlier runs (reports of days not divisible by 5)."""
    r = b.reports.withColumn("dom", F.dayofmonth(F.timestamp_millis("start_time_ms")))
    r = r.filter(F.col("dom") % 5 != 0)
    st = F.element_at(F.array(*[F.lit(x) for x in ["pending", "ok", "error", "ok"]]), (F.col("dom") % 4 + 1).cast("int"))
    return r.select(
        "report_code", st.alias("status"), "title", "start_time_ms",
        F.when(st == "error", F.concat(F.lit("HTTP 500 on "), F.col("report_code"))).alias("last_error"),
        (F.col("dom") % 3).cast("int").alias("ingestion_attempts"),
        F.when(st == "ok", F.col("dom") * 7 + 11).cast("bigint").alias("last_ingest_points"),
        F.when(st == "ok", F.timestamp_millis("start_time_ms") + F.expr("INTERVAL 1 HOUR")).alias("synced_at"),
        F.timestamp_millis("start_time_ms").alias("fetched_at"),
        _catalog_json().alias("catalog_json"))


def catalogue(b: C.Bronze) -> DataFrame:
    return b.reports.select(*CATALOGUE_COLS)


def refresh_catalogue(state: DataFrame, cat: DataFrame, run_ts: str = RUN_TS) -> DataFrame:
    """One full outer join: 'ok' rows untouched, others reset to pending
    with the attempts counter kept, new reports inserted as pending."""
    # entries without a code are skipped; of a repeated code the latest start wins
    rest = [c for c in cat.columns if c != "report_code"]
    cat = cat.filter(F.col("report_code").isNotNull() & (F.col("report_code") != "")).groupBy("report_code").agg(
        F.max_by(F.struct(*rest), F.struct(F.coalesce("start_time_ms", F.lit(0)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rest])).alias("_v")).select("report_code", "_v.*")
    e = state.select(*[F.col(c).alias(f"e_{c}") for c in STATE_COLS])
    j = e.join(cat, F.col("e_report_code") == F.col("report_code"), "full_outer")
    keep = F.col("report_code").isNull() | (F.col("e_status") == "ok")
    new_vals = {
        "report_code": F.col("report_code"), "status": F.lit("pending"), "title": F.col("title"),
        "start_time_ms": F.col("start_time_ms"), "last_error": F.lit(None).cast("string"),
        "ingestion_attempts": F.coalesce(F.col("e_ingestion_attempts"), F.lit(0)).cast("int"),
        "last_ingest_points": F.lit(None).cast("bigint"), "synced_at": F.lit(None).cast("timestamp"),
        "fetched_at": F.lit(run_ts).cast("timestamp"), "catalog_json": _catalog_json(),
    }
    return j.select(*[F.when(keep, F.col(f"e_{c}")).otherwise(new_vals[c]).alias(c) for c in STATE_COLS])


def apply_results(state: DataFrame, results: DataFrame, run_ts: str = RUN_TS) -> DataFrame:
    """Mark ok (points) / mark error (whole text, attempts + 1)."""
    r = results.select(F.col("report_code").alias("r_code"), "outcome", "points", "error")
    j = state.join(r, F.col("report_code") == F.col("r_code"), "left")
    ok, err = F.col("outcome") == "ok", F.col("outcome") == "error"
    ts = F.lit(run_ts).cast("timestamp")
    return j.select(
        "report_code",
        F.when(ok, F.lit("ok")).when(err, F.lit("error")).otherwise(F.col("status")).alias("status"),
        "title", "start_time_ms",
        F.when(ok, F.lit(None).cast("string")).when(err, F.col("error"))
         .otherwise(F.col("last_error")).alias("last_error"),
        F.when(err, F.col("ingestion_attempts") + 1).otherwise(F.col("ingestion_attempts")).alias("ingestion_attempts"),
        F.when(ok & F.col("points").isNotNull(), F.col("points").cast("bigint"))
         .otherwise(F.col("last_ingest_points")).alias("last_ingest_points"),
        F.when(ok, ts).otherwise(F.col("synced_at")).alias("synced_at"),
        F.when(ok | err, ts).otherwise(F.col("fetched_at")).alias("fetched_at"),
        "catalog_json")


def reset_to_pending(state: DataFrame, from_statuses=("ok", "error"), codes=None, run_ts: str = RUN_TS):
    """Reset matching rows to pending; returns (table, matched-row count column frame)."""
    m = F.col("status").isin(*from_statuses)
    if codes:
        m = m & F.col("report_code").isin(*[c.strip() for c in codes if c.strip()])
    out = state.select(
        "report_code", F.when(m, F.lit("pending")).otherwise(F.col("status")).alias("status"), "title",
        "start_time_ms", F.when(m, F.lit(None).cast("string")).otherwise(F.col("last_error")).alias("last_error"),
        "ingestion_attempts", "last_ingest_points",
        F.when(m, F.lit(None).cast("timestamp")).otherwise(F.col("synced_at")).alias("synced_at"),
        F.when(m, F.lit(run_ts).cast("timestamp")).otherwise(F.col("fetched_at")).alias("fetched_at"),
        "catalog_json")
    dry = state.agg(F.count_if(m).alias("would_reset"))
    return out, dry


def ingest_results(b: C.Bronze, state: DataFrame) -> DataFrame:
    """Outcome of one ingestion run for the pending/error reports (from the fights)."""
    f = C.silver_fights(b).groupBy("report_code").agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("is_boss") == 1) & (F.col("is_kill") == 1)).alias("k"))
    todo = state.filter(F.col("status").isin("pending", "error")).select("report_code")
    j = todo.join(f, "report_code", "left")
    return j.select("report_code",
                    F.when(F.col("k") > 0, F.lit("ok")).otherwise(F.lit("error")).alias("outcome"),
                    (F.col("n") * 10).alias("points"),
                    F.concat(F.lit("HTTP 429: "), F.repeat(F.lit("x"), 3000)).alias("error"))


def _refreshed(b):
    return refresh_catalogue(state_before(b), catalogue(b))


def _after_run(b):
    s = _refreshed(b)
    return apply_results(s, ingest_results(b, s))


def pending_work(state: DataFrame, limit: int = 25) -> DataFrame:
    """pending/error reports, newest first (a work list: the limit is the feature)."""
    return (state.filter(F.col("status").isin("pending", "error"))
                 .orderBy(F.desc_nulls_last("start_time_ms"), F.asc("report_code")).limit(limit)
                 .select("report_code", "status", "start_time_ms", "ingestion_attempts"))


def median_ingest_points(state: DataFrame, last_n: int = 20) -> DataFrame:
    """A10: median of the points of the last ``last_n`` ok reports (by sync time)."""
    ok = state.filter((F.col("status") == "ok") & F.col("last_ingest_points").isNotNull())
    last = ok.orderBy(F.desc_nulls_last("synced_at"), F.desc("report_code")).limit(last_n)
    return last.agg(F.median(F.col("last_ingest_points").cast("double")).alias("median_points"),
                    F.count(F.lit(1)).alias("sample_size"))


def status_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("nb"))


# ------------------------------------------------------------------ ad-hoc corpus
def corpus_top_dps_bosses(b, n: int = 20):
    m = M.metric_long(b).filter((F.col("metric") == "dps") & (F.col("is_boss") == 1))
    return (m.orderBy(F.desc("rate"), "report_code", "fight_id", "player_name").limit(n)
             .select("report_code", "fight_id", "boss_name", "player_name", "class_name",
                     F.col("rate").alias("dps"), F.col("total").alias("damage")))


def corpus_table_counts(b):
    parts = [("reports", C.silver_reports(b)), ("fights", C.silver_fights(b)), ("events", C.silver_events(b)),
             ("actors", C.silver_actors(b)), ("abilities", C.silver_abilities(b)), ("roster", C.silver_roster(b))]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def corpus_latest_reports(b, n: int = 15):
    return (C.silver_reports(b).orderBy(F.desc("report_start_at"), "report_code").limit(n)
            .select("report_code", "title", "zone_name", "report_start_at"))


def corpus_fights_per_report(b):
    return C.silver_fights(b).groupBy("report_code").agg(
        F.count(F.lit(1)).alias("fights"), F.count_if(F.col("is_boss") == 1).alias("boss_fights"))


def corpus_events_by_type(b):
    return b.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def corpus_events_pages(b):
    return b.events.groupBy("report_code").agg(F.count(F.lit(1)).alias("events"),
                                               (F.max("page_index") + 1).alias("pages"))


def corpus_actors_by_type(b):
    return b.actors.groupBy("actor_type").agg(F.count(F.lit(1)).alias("actors"))


def corpus_json_keys_by_type(b):
    e = b.events.select("event_type", F.explode(F.json_object_keys("event_json")).alias("json_key"))
    return e.groupBy("event_type", "json_key").agg(F.count(F.lit(1)).alias("occurrences"))


def corpus_boss_attempts(b):
    f = C.silver_fights(b).filter(F.col("is_boss") == 1)
    g = f.groupBy(F.col("fight_name").alias("boss_name")).agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("is_kill") == 1).alias("kills"))
    return g.withColumn("kill_pct", ratio_round(F.col("kills") * 100, F.col("attempts"), 1))


def corpus_players_per_report(b):
    p = C.gold_fight_player_perf(b)
    return p.groupBy("report_code").agg(F.count_distinct("player_name").alias("players"))


def corpus_mean_dps_per_class(b, min_rows: int = 5):
    m = M.metric_long(b).filter((F.col("metric") == "dps") & (F.col("is_boss") == 1))
    g = m.groupBy("class_name").agg(F.bround(F.avg("rate"), 0).alias("mean_dps"), F.count(F.lit(1)).alias("n"))
    return g.filter(F.col("n") >= min_rows)


def corpus_best_per_boss(b):
    m = M.metric_long(b).filter((F.col("metric") == "dps") & (F.col("is_boss") == 1))
    return m.groupBy("player_name", "boss_name").agg(
        F.max("rate").alias("best_dps"),
        F.max_by("report_code", F.struct("rate", "report_code")).alias("best_report"))


def corpus_mythic_plus_runs(b):
    f = C.silver_fights(b).filter(F.coalesce(F.col("keystone_level"), F.lit(0)) > 0)
    return f.groupBy("keystone_level").agg(F.count(F.lit(1)).alias("runs"),
                                           F.count_if(F.col("is_kill") == 1).alias("completed"),
                                           F.bround(F.avg("duration_sec"), 1).alias("avg_duration_sec"))


def corpus_reports_per_week_source(b):
    r = C.silver_reports(b)
    return r.groupBy(F.date_trunc("week", "report_start_at").alias("week_start"), "log_source").agg(
        F.count(F.lit(1)).alias("reports"))


def corpus_deaths_per_player(b):
    return C.gold_deaths(b).groupBy("player_name").agg(
        F.count(F.lit(1)).alias("deaths"), F.count_distinct("report_code", "fight_id").alias("fights"))


def corpus_players_per_class_spec(b):
    return C.gold_fight_player_perf(b).groupBy("class_name", "spec_id").agg(
        F.count_distinct("player_name").alias("players"))


def _b(fn):
    return lambda spark, sf: fn(C.Bronze(spark, sf))


QUERIES = {
    "ingestion_state_refresh": _b(_refreshed),
    "ingestion_state_after_run": _b(_after_run),
    "ingestion_state_reset": _b(lambda b: reset_to_pending(_after_run(b))[0]),
    "ingestion_reset_dry_run": _b(lambda b: reset_to_pending(_after_run(b), codes=None)[1]),
    "ingestion_pending_work": _b(lambda b: pending_work(_refreshed(b))),
    "ingestion_median_points": _b(lambda b: median_ingest_points(_after_run(b))),
    "ingestion_status_counts": _b(lambda b: status_counts(_after_run(b))),
    "corpus_top_dps_bosses": _b(corpus_top_dps_bosses),
    "corpus_table_counts": _b(corpus_table_counts),
    "corpus_latest_reports": _b(corpus_latest_reports),
    "corpus_fights_per_report": _b(corpus_fights_per_report),
    "corpus_events_by_type": _b(corpus_events_by_type),
    "corpus_events_pages": _b(corpus_events_pages),
    "corpus_actors_by_type": _b(corpus_actors_by_type),
    "corpus_json_keys_by_type": _b(corpus_json_keys_by_type),
    "corpus_boss_attempts": _b(corpus_boss_attempts),
    "corpus_players_per_report": _b(corpus_players_per_report),
    "corpus_mean_dps_per_class": _b(corpus_mean_dps_per_class),
    "corpus_best_per_boss": _b(corpus_best_per_boss),
    "corpus_mythic_plus_runs": _b(corpus_mythic_plus_runs),
    "corpus_reports_per_week_source": _b(corpus_reports_per_week_source),
    "corpus_deaths_per_player": _b(corpus_deaths_per_player),
    "corpus_players_per_class_spec": _b(corpus_players_per_class_spec),
}


# ------------------------------------------------------------------ S14: report sources with precedence
def report_sources(b: C.Bronze) -> DataFrame:
    """Guild reports win over personal ones: union, one row per code, tag log_source."""
    r = C.silver_reports(b)
    personal = r.select("report_code", "title", "owner_name", F.lit("personal").alias("log_source"),
                        F.lit(2).alias("_prio"))
    guild = r.filter(F.col("guild_name").isNotNull()).select(
        "report_code", "title", "owner_name", F.lit("guild").alias("log_source"), F.lit(1).alias("_prio"))
    u = personal.unionByName(guild)
    best = u.groupBy("report_code").agg(
        F.min_by(F.struct("title", "owner_name", "log_source"), F.col("_prio")).alias("_v"))
    return best.select("report_code", "_v.*")


# ------------------------------------------------------------------ P15: filtered marts of the pages
def combat_filter(df: DataFrame, guild: str | None = None, raid: str | None = None, bosses=None,
                  difficulties=None, kills_only: bool = False, guild_members_only: bool = False) -> DataFrame:
    """Optional filters folded into one predicate (NULL-safe, IN lists)."""
    preds = []
    if guild:
        preds.append(F.lower(F.coalesce(F.col("report_guild_name"), F.lit(""))).contains(guild.lower()))
    if raid:
        preds.append(F.col("raid_or_dungeon") == raid)
    if bosses:
        preds.append(F.col("boss_name").isin(*bosses))
    if difficulties:
        preds.append(F.col("difficulty_label").isin(*difficulties))
    if kills_only:
        preds.append(F.col("is_kill") == 1)
    if guild_members_only:
        preds.append(F.col("is_guild_member") == 1)
    for p in preds:
        df = df.filter(p)
    return df


def dps_series(b: C.Bronze) -> DataFrame:
    """DPS evolution: per night, boss and difficulty, boss fights of guild members."""
    p = combat_filter(C.gold_fight_player_perf(b), guild_members_only=True).filter(F.col("is_boss") == 1)
    return p.groupBy("report_date", "boss_name", "difficulty_label").agg(
        F.count_distinct("report_code", "fight_id").alias("fights"),
        F.count_distinct("player_name").alias("players"),
        F.bround(F.avg("dps"), 0).alias("avg_dps"), F.max("dps").alias("max_dps"))


def consumable_views(b: C.Bronze) -> DataFrame:
    """Per player: best uptime per buff type, potions and healthstones used, fights seen."""
    c = C.gold_consumables(b)
    return c.groupBy("player_name").agg(
        F.count_distinct("report_code", "fight_id").alias("fights"),
        F.max(F.when(F.col("consumable_type") == "flask", F.col("uptime_pct"))).alias("max_flask_uptime_pct"),
        F.max(F.when(F.col("consumable_type") == "food", F.col("uptime_pct"))).alias("max_food_uptime_pct"),
        F.sum(F.when(F.col("consumable_type") == "potion", F.col("casts"))).alias("potions"),
        F.sum(F.when(F.col("consumable_type") == "healthstone", F.col("casts"))).alias("healthstones"))


QUERIES.update({
    "combat_report_sources": _b(report_sources),
    "dps_series": _b(dps_series),
    "consumable_views": _b(consumable_views),
})
