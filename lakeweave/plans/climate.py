"""F3 — daily climate: curation, keep-last upsert, gold views, explorations, QC.

Layout decisions for scale:
* every calendar statistic (normals, day deviation, day record, year N-1)
  groups by (station, month, day); such a group holds at most one row per
  year, so one window pass over that partitioning replaces the reference's
  self-join + DISTINCT ON + join-to-normals and needs a single shuffle with
  bounded groups;
* yearly and monthly sums are plain partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.dedupe import keep_last_rows, together
from ..operators.quality import ratio_round
from ..sources.fixtures import climate_raw
from ..sources.sinks import upsert
from ..sources.tables import kept

KEY = ["station_id", "date_mesure"]

# FIXED VALUES: source column -> curated column
RENAMES = {
    "DG": "duree_gel", "QDG": "qualite_duree_gel",
    "HTX": "heure_temp_max", "QHTX": "qualite_heure_temp_max",
    "HTN": "heure_temp_min", "QHTN": "qualite_heure_temp_min",
    "NUM_POSTE": "station_id", "NOM_USUEL": "station_nom",
    "QRR": "qualite_quantite_precipitations", "RR": "quantite_precipitations",
    "AAAAMMJJ": "date_mesure", "ALTI": "altitude", "LON": "longitude", "LAT": "latitude",
    "TN": "temp_min", "QTN": "qualite_temp_min", "TX": "temp_max", "QTX": "qualite_temp_max",
}
LONG_COLS = ["duree_gel", "qualite_duree_gel", "qualite_heure_temp_max", "qualite_heure_temp_min",
             "station_id", "qualite_quantite_precipitations", "altitude", "qualite_temp_min",
             "qualite_temp_max"]
DOUBLE_COLS = ["quantite_precipitations", "longitude", "latitude", "temp_min", "temp_max"]

# FIXED VALUES: QC thresholds
SENTINELS = (-999.0, -9999.0)
RANGE_TN = (-50.0, 50.0)
RANGE_TX = (-50.0, 55.0)
HOT_DEVIATION = 2.0
COLD_DEVIATION = -2.0


def _hour_ts(date_txt, hhmm):
    """date + HHMM (left-padded to 4) -> timestamp, NULL when not a valid time.

    Digits that are no time of day (many: the hours are HHMM) are told apart before parsing,
    because the parser raises and catches an error for each text that it can't read."""
    txt = F.concat(date_txt, F.lpad(hhmm, 4, "0"))
    no_time = txt.rlike(r"^[0-9]{12}$") & ((F.substring(txt, 9, 2) > "23") | (F.substring(txt, 11, 2) > "59"))
    return F.when(~no_time, F.try_to_timestamp(txt, F.lit("yyyyMMddHHmm")))


def curate(raw: DataFrame) -> DataFrame:
    """P1 + P4: rename, strict typed projection (ANSI cast raises on bad input)."""
    keep = ["_file"] if "_file" in raw.columns else []
    df = raw.select(*keep, *[F.col(k).alias(v) for k, v in RENAMES.items()])
    typed = {c: F.col(c).cast("bigint") for c in LONG_COLS}
    typed.update({c: F.col(c).cast("double") for c in DOUBLE_COLS})
    typed["temp_min_at"] = _hour_ts(F.col("date_mesure"), F.col("heure_temp_min"))
    typed["temp_max_at"] = _hour_ts(F.col("date_mesure"), F.col("heure_temp_max"))
    typed["date_mesure"] = F.to_timestamp(F.col("date_mesure"), "yyyyMMdd")
    return df.withColumns(typed).drop("heure_temp_min", "heure_temp_max")


def climat_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated table: both files, keep-last per (station, date) by file order."""
    cur = curate(climate_raw(spark, sf_dir))
    return keep_last_rows(together(cur, KEY), KEY, ["_file"]).drop("_file")


def climate_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S22 as a job: table loaded from file 1, then file 2 upserted into it."""
    cur = curate(climate_raw(spark, sf_dir))
    existing = keep_last_rows(together(cur.filter(F.col("_file") == 1), KEY), KEY, ["_file"]).drop("_file")
    return upsert(existing, cur.filter(F.col("_file") == 2), KEY, order=["_file"])


# ------------------------------------------------------------------ gold views
def daily(clim: DataFrame) -> DataFrame:
    return (clim.filter(F.col("temp_max").isNotNull())
                .select("station_id", "station_nom", F.to_date("date_mesure").alias("date_mesure"),
                        F.year("date_mesure").alias("annee"), F.month("date_mesure").alias("mois"),
                        F.dayofmonth("date_mesure").alias("jour"), "temp_min", "temp_max",
                        "latitude", "longitude"))


def _calendar_window(order: bool = False):
    w = Window.partitionBy("station_id", "mois", "jour")
    if order:
        return w.orderBy("annee")
    return w


def records_per_station(clim: DataFrame) -> DataFrame:
    return (clim.filter(F.col("temp_max").isNotNull()).groupBy("station_id")
                .agg(F.max("station_nom").alias("station_nom"),
                     F.max("temp_max").alias("temp_max_record"),
                     F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude")))


def evolution(clim: DataFrame) -> DataFrame:
    """Day vs same day N-1 vs calendar-day record (latest year wins ties)."""
    d = daily(clim)
    w = _calendar_window(order=True)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rec = F.max(F.struct("temp_max", "annee")).over(whole)
    prev_year = F.lag("annee").over(w)
    return d.select(
        "station_id", "station_nom", "annee", "date_mesure", "mois", "jour",
        F.col("temp_max").alias("temp_max_n"),
        F.when(prev_year == F.col("annee") - 1, F.lag("temp_max").over(w)).alias("temp_max_n1"),
        rec["temp_max"].alias("temp_max_record"), rec["annee"].alias("annee_record"))


def normals(clim: DataFrame) -> DataFrame:
    """Per station and calendar day, only days with TX present."""
    return (daily(clim).groupBy("station_id", "mois", "jour").agg(
        F.max("station_nom").alias("station_nom"),
        F.round(F.avg("temp_min"), 2).alias("tn_moy"),
        F.round(F.min("temp_min"), 2).alias("tn_min_hist"),
        F.round(F.max("temp_min"), 2).alias("tn_max_hist"),
        F.round(F.avg("temp_max"), 2).alias("tx_moy"),
        F.round(F.min("temp_max"), 2).alias("tx_min_hist"),
        F.round(F.max("temp_max"), 2).alias("tx_max_hist"),
        F.count("temp_min").alias("nb_annees_tn"),
        F.count("temp_max").alias("nb_annees_tx"),
        F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude")))


def day_vs_normal(clim: DataFrame, keep_coords: bool = False) -> DataFrame:
    """Each day with its calendar normal and the deviation (window, no join)."""
    w = _calendar_window()
    tn_moy = F.round(F.avg("temp_min").over(w), 2)
    tx_moy = F.round(F.avg("temp_max").over(w), 2)
    out = daily(clim).select(
        "station_id", "station_nom", "date_mesure", "annee", "mois", "jour", "temp_min", "temp_max",
        tn_moy.alias("tn_moy_normale"), tx_moy.alias("tx_moy_normale"),
        *(["latitude", "longitude"] if keep_coords else []))
    return out.withColumns({
        "ecart_tn_normale": F.round(F.col("temp_min") - F.col("tn_moy_normale"), 2),
        "ecart_tx_normale": F.round(F.col("temp_max") - F.col("tx_moy_normale"), 2),
    })


def rain_month(clim: DataFrame) -> DataFrame:
    return (clim.filter(F.col("quantite_precipitations").isNotNull())
                .groupBy("station_id", F.year("date_mesure").alias("annee"),
                         F.month("date_mesure").alias("mois"))
                .agg(F.max("station_nom").alias("station_nom"),
                     F.round(F.sum("quantite_precipitations"), 1).alias("rr_sum_mm"),
                     F.count_if(F.col("quantite_precipitations") > 0).alias("nb_jours_pluie"),
                     F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude")))


def rain_year(clim: DataFrame) -> DataFrame:
    """The yearly total sums the monthly totals already rounded to 0.1."""
    return (rain_month(clim).groupBy("station_id", "annee")
            .agg(F.max("station_nom").alias("station_nom"),
                 F.round(F.sum("rr_sum_mm"), 1).alias("rr_sum_annuel"),
                 F.sum("nb_jours_pluie").cast("int").alias("nb_jours_pluie"),
                 F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude")))


def wettest_month(clim: DataFrame) -> DataFrame:
    """Per station and year, the month with the most rain and the annual total."""
    m = rain_month(clim)
    return m.groupBy("station_id", "annee").agg(
        F.max_by("mois", F.struct("rr_sum_mm", F.col("mois"))).alias("mois_le_plus_pluvieux"),
        F.max("rr_sum_mm").alias("rr_mois_max"),
        F.round(F.sum("rr_sum_mm"), 1).alias("rr_total_annuel"))


def hot_cold_year(clim: DataFrame) -> DataFrame:
    """The days are read and compared once; a station's coordinates are the largest of its yearly ones
    (a window over one row per station and year), and a station without a number has none."""
    per_year = day_vs_normal(clim, keep_coords=True).groupBy("station_id", "annee").agg(
        F.max("station_nom").alias("station_nom"),
        F.count_if(F.col("ecart_tx_normale") > HOT_DEVIATION).alias("nb_jours_chauds"),
        F.count_if(F.col("ecart_tn_normale") < COLD_DEVIATION).alias("nb_jours_froids"),
        F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"))
    station = Window.partitionBy("station_id")
    return per_year.withColumns({c: F.when(F.col("station_id").isNotNull(), F.max(c).over(station)) for c in ("latitude", "longitude")})


def last_day_kpis(clim: DataFrame) -> DataFrame:
    """Extremes of the latest day + the calendar normals of that day.

    The normals are averaged per station first (the reference's join had no
    station key, which multiplies the station count)."""
    last = clim.agg(F.max(F.to_date("date_mesure"))).scalar()
    norm = normals(clim).filter((F.col("mois") == F.month(last)) & (F.col("jour") == F.dayofmonth(last)))
    moy_max = norm.agg(F.round(F.avg("tx_moy"), 2)).scalar()
    moy_min = norm.agg(F.round(F.avg("tn_moy"), 2)).scalar()
    day = clim.filter(F.to_date("date_mesure") == last)
    return day.agg(
        F.min("temp_min").alias("temp_min_jour"), F.max("temp_max").alias("temp_max_jour"),
        F.count_if(F.col("temp_max").isNotNull()).alias("nb_postes"),
    ).select(last.alias("date_mesure"),
             "temp_min_jour", "temp_max_jour", moy_max.alias("moy_max_historique"),
             moy_min.alias("moy_min_historique"), "nb_postes")


def calendar_grid(clim: DataFrame) -> DataFrame:
    """P22 long form: station x year x ISO week x ISO weekday -> TX."""
    d = daily(clim)
    return (d.groupBy("station_id", "annee", F.weekofyear("date_mesure").alias("semaine"),
                      (F.weekday("date_mesure") + 1).alias("jour_semaine"))
             .agg(F.min("temp_max").alias("temp_max")))


# FIXED VALUES: series labels of the period chart
SERIES_LABELS = {"temp_max_n": "Annee N", "temp_max_n1": "Annee N-1", "temp_max_record": "Record"}


def period_series(clim: DataFrame, month_from: int = 11, month_to: int = 2) -> DataFrame:
    """P18 + P21: month range with wrap-around, melted to (serie, valeur)."""
    ev = evolution(clim)
    m = F.col("mois")
    in_range = (m >= month_from) & (m <= month_to) if month_from <= month_to else (m >= month_from) | (m <= month_to)
    long = ev.filter(in_range).unpivot(["station_id", "date_mesure"], list(SERIES_LABELS),
                                       "serie", "valeur")
    label = F.create_map(*[x for k, v in SERIES_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return long.withColumn("serie", label[F.col("serie")])


def station_labels(clim: DataFrame) -> DataFrame:
    """Name, or 'name (id)' when several stations share the name."""
    st = clim.groupBy("station_id").agg(F.max("station_nom").alias("station_nom"))
    # counts per name joined back: a name that most stations share is one partial count, not one window
    names = st.groupBy("station_nom").agg((F.count(F.lit(1)) > 1).alias("_shared"))
    st = st.join(names, st["station_nom"].eqNullSafe(names["station_nom"])).drop(names["station_nom"])
    shared = F.col("_shared")
    return st.withColumn("label", F.when(shared, F.format_string("%s (%d)", F.col("station_nom"),
                                                                  F.col("station_id")))
                                   .otherwise(F.col("station_nom"))).drop("_shared")


# ------------------------------------------------------------------ explorations
def _target_year(clim: DataFrame):
    return clim.agg(F.max(F.year("date_mesure"))).scalar()


def _with_parts(clim: DataFrame) -> DataFrame:
    return clim.withColumns({"annee": F.year("date_mesure"), "mois": F.month("date_mesure"),
                             "jour": F.dayofmonth("date_mesure")})


def top_temp_max(clim: DataFrame, n: int = 100) -> DataFrame:
    return (clim.orderBy(F.desc_nulls_last("temp_max"), "station_id", "date_mesure").limit(n)
                .select("station_nom", "date_mesure", "temp_max"))


def summer_year_pivot(clim: DataFrame, years_back: int = 4) -> DataFrame:
    """TX of the last four years side by side, May-August."""
    y = clim.agg(F.max(F.year("date_mesure"))).first()[0]   # one bounded scalar
    years = [y - i for i in range(years_back)]
    s = _with_parts(clim).filter(F.col("mois").between(5, 8))
    piv = s.groupBy("station_id", "station_nom", "mois", "jour").pivot("annee", years).agg(F.max("temp_max"))
    return piv.select("station_id", "station_nom", "mois", "jour",
                      *[F.col(str(yr)).alias(f"temp_max_y{i}") for i, yr in enumerate(years)])


def summer_years_present(clim: DataFrame) -> DataFrame:
    """Distinct years present per station and calendar day, May-August."""
    s = _with_parts(clim).filter(F.col("mois").between(5, 8))
    return (s.groupBy("station_id", "station_nom", "mois", "jour")
             .agg(F.array_join(F.array_sort(F.collect_set(F.col("annee").cast("string"))), ",")
                  .alias("annees_presentes")))


def summer_vs_station_record(clim: DataFrame) -> DataFrame:
    y = _target_year(clim)
    p = _with_parts(clim)
    hist = (p.filter((F.col("annee") < y) & F.col("temp_max").isNotNull())
             .groupBy("station_id").agg(F.max("temp_max").alias("temp_max_all_time")))
    cur = (p.filter((F.col("annee") == y) & F.col("mois").between(5, 8))
            .select("station_id", "station_nom", "date_mesure", F.col("temp_max").alias("temp_max_target")))
    return (cur.join(hist, "station_id")
               .withColumn("ecart_vs_record", F.col("temp_max_target") - F.col("temp_max_all_time"))
               .withColumn("bat_record_absolu",
                           F.when(F.col("temp_max_target") > F.col("temp_max_all_time"), 1).otherwise(0))
               .drop("station_id"))


def summer_max_vs_record(clim: DataFrame) -> DataFrame:
    """Two one-row aggregates side by side (scalar subqueries)."""
    y = _target_year(clim)
    p = _with_parts(clim).filter(F.col("mois").between(5, 8) & F.col("temp_max").isNotNull())
    cur = p.filter(F.col("annee") == y).agg(F.max("temp_max")).scalar()
    hist = p.filter(F.col("annee") < y).agg(F.max("temp_max")).scalar()
    one = clim.sparkSession.range(1)
    return one.select(cur.alias("max_target"), hist.alias("max_all_time"),
                      (cur - hist).alias("ecart_vs_record"),
                      F.when(cur > hist, 1).otherwise(0).alias("bat_record_absolu"))


def summer_day_records(clim: DataFrame) -> DataFrame:
    """Calendar-day record before the target year and its (latest) year."""
    y = _target_year(clim)
    p = _with_parts(clim).filter(F.col("mois").between(5, 8) & F.col("temp_max").isNotNull())
    hist = (p.filter(F.col("annee") < y).groupBy("mois", "jour")
             .agg(F.max("temp_max").alias("max_all_time"),
                  F.max_by("annee", F.struct("temp_max", "annee")).alias("annee_record")))
    cur = (p.filter(F.col("annee") == y).groupBy("mois", "jour")
            .agg(F.max("temp_max").alias("max_target")))
    return (cur.join(hist, ["mois", "jour"], "left")
               .withColumn("date_target", F.format_string("%d-%02d-%02d", y, F.col("mois"), F.col("jour")))
               .withColumn("ecart_vs_record", F.col("max_target") - F.col("max_all_time"))
               .withColumn("bat_record_jour", F.when(F.col("max_target") > F.col("max_all_time"), 1).otherwise(0)))


# ------------------------------------------------------------------ QC
def _num(c):
    return F.col(c).try_cast("double")


def qc_files(raw: DataFrame) -> DataFrame:
    """Per delivery file: null shares, zeros, sentinels, ranges, duplicates, alerts.

    One scan: counts at the (file, station, day) grain, rolled up to stations
    and files on the pre-aggregated rows (partial aggregation at each level)."""
    tn, tx = _num("TN"), _num("TX")
    month = F.month(F.try_to_timestamp(F.col("AAAAMMJJ"), F.lit("yyyyMMdd")))
    cnt = lambda c: F.count_if(c)
    key = raw.groupBy("_file", "NUM_POSTE", "AAAAMMJJ").agg(
        F.count(F.lit(1)).alias("n"), cnt(tn.isNull()).alias("tn_null"), cnt(tx.isNull()).alias("tx_null"),
        cnt(tn == 0).alias("tn_zero"), cnt(tx == 0).alias("tx_zero"),
        cnt(tn.isin(*SENTINELS)).alias("tn_sentinelles"), cnt(tx.isin(*SENTINELS)).alias("tx_sentinelles"),
        F.min(tn).alias("tn_min"), F.max(tn).alias("tn_max"), F.min(tx).alias("tx_min"), F.max(tx).alias("tx_max"),
        cnt((tn == 0) & month.isin(6, 7, 8)).alias("tn_zero_ete"),
        cnt(tn.isNotNull() & tx.isNotNull() & (tx < tn)).alias("tx_lt_tn"),
        cnt((tn < RANGE_TN[0]) | (tn > RANGE_TN[1])).alias("tn_hors_plage"),
        cnt((tx < RANGE_TX[0]) | (tx > RANGE_TX[1])).alias("tx_hors_plage"),
        F.max(tx.isNotNull().cast("int")).alias("has_tx"))
    sums = ["n", "tn_null", "tx_null", "tn_zero", "tx_zero", "tn_sentinelles", "tx_sentinelles", "tn_zero_ete",
            "tx_lt_tn", "tn_hors_plage", "tx_hors_plage"]
    extremes = [F.min("tn_min").alias("tn_min"), F.max("tn_max").alias("tn_max"),
                F.min("tx_min").alias("tx_min"), F.max("tx_max").alias("tx_max")]
    station = key.groupBy("_file", "NUM_POSTE").agg(
        *[F.sum(c).alias(c) for c in sums], *extremes, F.max("has_tx").alias("has_tx"),
        F.sum(F.col("n") - 1).alias("dups"))
    f = station.groupBy("_file").agg(
        *[F.sum(c).alias(c) for c in sums], *extremes, F.count(F.lit(1)).alias("stations"),
        F.sum("has_tx").alias("stations_avec_tx"), F.sum("dups").alias("doublons_station_date"))
    out = f.select(
        F.col("_file").alias("fichier"), F.col("n").alias("lignes"),
        ratio_round(F.col("tn_null") * 100, F.col("n"), 1).alias("pct_tn_null"),
        ratio_round(F.col("tx_null") * 100, F.col("n"), 1).alias("pct_tx_null"),
        "tn_zero", "tx_zero", "tn_sentinelles", "tx_sentinelles", "tn_min", "tn_max", "tx_min", "tx_max",
        "tn_zero_ete", "tx_lt_tn", "tn_hors_plage", "tx_hors_plage", "stations", "stations_avec_tx",
        "doublons_station_date",
        (F.col("stations") - F.col("stations_avec_tx")).alias("stations_sans_tx"),
        ratio_round(F.col("stations_avec_tx") * 100, F.col("stations"), 1).alias("pct_stations_thermo"))
    alerts = F.concat_ws(" | ",
        F.when(F.col("tn_hors_plage") > 0, F.format_string("%d TN hors plage", F.col("tn_hors_plage"))),
        F.when((F.col("tn_sentinelles") + F.col("tx_sentinelles")) > 0,
               F.format_string("Sentinelles -999 (TN=%d, TX=%d)", F.col("tn_sentinelles"), F.col("tx_sentinelles"))),
        F.when(F.col("tn_zero_ete") > 50, F.format_string("%d TN=0 en ete", F.col("tn_zero_ete"))),
        F.when(F.col("tx_lt_tn") > 0, F.format_string("%d lignes avec TX < TN", F.col("tx_lt_tn"))),
        F.when(F.col("pct_tn_null") > 60, F.lit("TN vides > 60 %")))
    return out.withColumn("alertes", alerts)


def qc_fusion(raw: DataFrame) -> DataFrame:
    """Concatenation of the files: rows, TN null share, keys present in every file."""
    files = raw.agg(F.count_distinct("_file")).scalar()
    overlap = (raw.select("_file", "NUM_POSTE", "AAAAMMJJ").distinct()
                  .groupBy("NUM_POSTE", "AAAAMMJJ").agg(F.count(F.lit(1)).alias("_k"))
                  .filter(F.col("_k") == files).agg(F.count(F.lit(1))).scalar())
    return raw.agg(
        F.count(F.lit(1)).alias("fusion_lignes"),
        ratio_round(F.count_if(_num("TN").isNull()) * 100, F.count(F.lit(1)), 1).alias("fusion_pct_tn_null"),
    ).withColumn("fusion_chevauchement_cles", overlap)


def qc_drift(raw: DataFrame, table: DataFrame, limit: float = 1.0) -> DataFrame:
    """Q7: does the stored table miss more minima than the deliveries did?  Under ``limit``
    points of difference the NULLs come from the source, else from ingestion."""
    seen = raw.agg(ratio_round(F.count_if(_num("TN").isNull()) * 100, F.count(F.lit(1)), 1)).scalar()
    counts = table.agg(F.count(F.lit(1)).alias("table_rows"), ratio_round(F.count_if(F.col("temp_min").isNull()) * 100, F.count(F.lit(1)), 1).alias("pct_table_null"))
    gap = F.round(F.abs(F.col("pct_table_null") - F.col("pct_raw_null")), 1)
    return counts.withColumn("pct_raw_null", seen).withColumn("gap", gap).withColumn(
        "verdict", F.when(F.col("gap") < limit, F.lit("source")).otherwise(F.lit("ingestion")))


def qc_transform_loss(raw: DataFrame) -> DataFrame:
    """Q6: NULL TN/TX before (lenient parse of the raw text) and after curation."""
    cur = curate(raw)
    before = raw.agg(F.count_if(_num("TN").isNull()).alias("tn_null_brut"),
                     F.count_if(_num("TX").isNull()).alias("tx_null_brut"))
    after_tn = cur.agg(F.count_if(F.col("temp_min").isNull())).scalar()
    after_tx = cur.agg(F.count_if(F.col("temp_max").isNull())).scalar()
    return before.select("*", after_tn.alias("tn_null_apres"), after_tx.alias("tx_null_apres")).withColumn(
        "perte", (F.col("tn_null_apres") > F.col("tn_null_brut")) | (F.col("tx_null_apres") > F.col("tx_null_brut")))


def station_completeness(raw: DataFrame) -> DataFrame:
    """Days and days with TX per station; rain-only stations have 0."""
    return (raw.groupBy("NUM_POSTE", "NOM_USUEL")
               .agg(F.count("AAAAMMJJ").alias("jours"), F.count(_num("TX")).alias("jours_tx"))
               .withColumn("pct_tx", ratio_round(F.col("jours_tx") * 100, F.col("jours"), 1)))


# ------------------------------------------------------------------ registered queries
def _c(spark, sf):
    """The curated table as stored: gold jobs read it, only ``climate_curate`` builds it."""
    return kept(spark, sf, "climat_data", lambda: climat_data(spark, sf))


QUERIES = {
    "climate_curate": climat_data,
    "climate_upsert": climate_upsert,
    "climate_records": lambda s, d: records_per_station(_c(s, d)),
    "climate_evolution": lambda s, d: evolution(_c(s, d)),
    "climate_normals": lambda s, d: normals(_c(s, d)),
    "climate_day": lambda s, d: day_vs_normal(_c(s, d)),
    "climate_rain_month": lambda s, d: rain_month(_c(s, d)),
    "climate_rain_year": lambda s, d: rain_year(_c(s, d)),
    "climate_hot_cold_year": lambda s, d: hot_cold_year(_c(s, d)),
    "climate_wettest_month": lambda s, d: wettest_month(_c(s, d)),
    "climate_last_day_kpis": lambda s, d: last_day_kpis(_c(s, d)),
    "climate_calendar": lambda s, d: calendar_grid(_c(s, d)),
    "climate_period_series": lambda s, d: period_series(_c(s, d)),
    "climate_station_labels": lambda s, d: station_labels(_c(s, d)),
    "climate_top_temp_max": lambda s, d: top_temp_max(_c(s, d)),
    "climate_year_pivot": lambda s, d: summer_year_pivot(_c(s, d)),
    "climate_years_present": lambda s, d: summer_years_present(_c(s, d)),
    "climate_summer_vs_record": lambda s, d: summer_vs_station_record(_c(s, d)),
    "climate_summer_max": lambda s, d: summer_max_vs_record(_c(s, d)),
    "climate_day_records": lambda s, d: summer_day_records(_c(s, d)),
    "climate_qc_files": lambda s, d: qc_files(climate_raw(s, d)),
    "climate_qc_fusion": lambda s, d: qc_fusion(climate_raw(s, d)),
    "climate_qc_drift": lambda s, d: qc_drift(climate_raw(s, d), _c(s, d)),
    "climate_qc_transform": lambda s, d: qc_transform_loss(climate_raw(s, d)),
    "climate_station_completeness": lambda s, d: station_completeness(climate_raw(s, d)),
}
