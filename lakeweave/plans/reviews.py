"""F4 — reviews: HTML extraction, KPIs, weekly series, sentiment records,
model scoring (pluggable scorer) and agreement statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import week_ending_monday
from ..operators.quality import ratio_round
from ..session import materialize
from ..sources import fixtures as fx
from ..sources.html import extract_links, extract_reviews, page_title, py_strip
from ..sources.sinks import replace_by_group, upsert
from ..sources.tables import read

# FIXED VALUES: French month tokens after accent folding and dot removal
FR_MONTHS = {"janv": 1, "fevr": 2, "fev": 2, "mars": 3, "avr": 4, "mai": 5, "juin": 6, "juil": 7,
             "aout": 8, "sept": 9, "oct": 10, "nov": 11, "dec": 12}
# FIXED VALUES: model identifiers of the annotation run
MODELS = ["llama-3.1-8b-instant", "llama-3.3-70b-versatile", "openai/gpt-oss-120b", "openai/gpt-oss-20b",
          "meta-llama/llama-4-scout-17b-16e-instruct", "qwen/qwen3-32b"]
REQUIRED_MODELS = len(MODELS)


def parse_french_date(col) -> Column:
    """'12 févr. 2024' -> date; anything else (3 tokens, known month, valid day) -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    t = F.replace(F.translate(F.lower(py_strip(c)), "éèêàû", "eeeau"), F.lit("."), F.lit(""))
    parts = F.split(py_strip(t), r"\s+")
    months = F.create_map(*[x for k, v in FR_MONTHS.items() for x in (F.lit(k), F.lit(v))])
    d, m, y = parts.getItem(0), months[parts.getItem(1)], parts.getItem(2)
    ok = (F.size(parts) == 3) & d.rlike(r"^\d+$") & y.rlike(r"^\d+$") & m.isNotNull()
    return F.when(ok, F.try_to_date(F.concat_ws("-", y, m.cast("string"), d), "y-M-d"))


# ------------------------------------------------------------------ extraction + KPIs
def reviews_and_responses(spark: SparkSession, sf_dir: str):
    """Silver reviews/responses: extracted once (the entity UDF runs once per
    block) and materialised, as the scraped tables are stored in the lake."""
    return extract_reviews(fx.review_pages(spark, sf_dir), materialize_first=True)


def reviews_with_dates(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("review_date_parsed", parse_french_date("review_date_raw"))


def reviews_kpis(reviews: DataFrame, responses: DataFrame) -> DataFrame:
    """Totals, mean rating, response rate (responded reviews / reviews)."""
    answered = responses.join(reviews.select("review_uid"), "review_uid", "left_semi")
    n_resp = answered.agg(F.count(F.lit(1))).scalar()
    n_answered = answered.agg(F.count_distinct("review_uid")).scalar()
    return reviews.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.round(F.avg("rating"), 4).alias("avg_rating"),
    ).select("total_reviews", n_resp.alias("total_responses"), "avg_rating",
             n_answered.alias("responded_reviews"),
             ratio_round(n_answered * 100, F.col("total_reviews"), 2).alias("response_rate_pct"))


def reviews_weekly(reviews: DataFrame) -> DataFrame:
    """Weekly mean rating (weeks ending Monday); empty weeks present with NULL."""
    dated = (reviews_with_dates(reviews)
             .filter(F.col("review_date_parsed").isNotNull() & F.col("rating").isNotNull())
             .withColumn("semaine", week_ending_monday("review_date_parsed")))
    weekly = dated.groupBy("semaine").agg(F.round(F.avg("rating"), 4).alias("note_moyenne"),
                                          F.count(F.lit(1)).alias("nb_avis"))
    # calendar from the weekly aggregate itself (one row per week, bounded);
    # both uses share the aggregate's shuffle
    cal = (weekly.agg(F.min("semaine").alias("lo"), F.max("semaine").alias("hi"))
                 .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))).alias("semaine")))
    return cal.join(weekly, "semaine", "left")


def reviews_last7(reviews: DataFrame) -> DataFrame:
    """Mean rating over the 7 days before the latest review date."""
    dated = reviews_with_dates(reviews).filter(F.col("review_date_parsed").isNotNull() & F.col("rating").isNotNull())
    last = dated.agg(F.max("review_date_parsed")).scalar()
    return (dated.filter(F.col("review_date_parsed") >= F.date_sub(last, 7))
                 .agg(F.round(F.avg("rating"), 4).alias("moyenne_7j"), F.count(F.lit(1)).alias("nb_avis"))
                 .select(last.alias("derniere_date"), "moyenne_7j", "nb_avis"))


def filter_reviews(reviews: DataFrame, keyword: str | None = None, ratings: list | None = None,
                   start=None, end=None) -> DataFrame:
    """Optional filters folded into one predicate; dates inclusive to end of day."""
    df = reviews_with_dates(reviews)
    preds = []
    if ratings:
        preds.append(F.col("rating").isin(*ratings))
    if keyword:
        preds.append(F.coalesce(F.col("review_text"), F.lit("")).rlike("(?i)" + keyword))
    if start is not None and end is not None:
        preds.append((F.col("review_date_parsed") >= F.lit(start).cast("date"))
                     & (F.col("review_date_parsed") < F.date_add(F.lit(end).cast("date"), 1)))
    for p in preds:
        df = df.filter(p)
    return df


# ------------------------------------------------------------------ sentiment records
SENTIMENT_SCHEMA = T.StructType([
    T.StructField("recommendationid", T.StringType()), T.StructField("review", T.StringType()),
    T.StructField("voted_up", T.BooleanType()), T.StructField("timestamp_created", T.LongType())])


def sentiment_reviews(payloads: DataFrame) -> DataFrame:
    j = payloads.select(F.from_json("payload", SENTIMENT_SCHEMA).alias("j"))
    return j.select(
        F.col("j.recommendationid").alias("review_id"), py_strip(F.col("j.review")).alias("review_text"),
        F.when(F.col("j.voted_up"), F.lit("positive")).otherwise(F.lit("negative")).alias("polarity"),
        F.timestamp_seconds(F.col("j.timestamp_created")).alias("created_at"))


def sentiment_kpis(sent: DataFrame) -> DataFrame:
    n = sent.agg(F.count(F.lit(1))).scalar()
    return sent.groupBy("polarity").agg(
        F.count(F.lit(1)).alias("nb_reviews"),
        ratio_round(F.sum(F.length("review_text")), F.count(F.lit(1)), 2).alias("avg_length")).withColumn(
        "pct_reviews", ratio_round(F.col("nb_reviews") * 100, n, 2))


# ------------------------------------------------------------------ model scoring
ANNOTATION_SCHEMA = T.StructType([
    T.StructField("review_id", T.LongType()), T.StructField("model_used", T.StringType()),
    T.StructField("ok", T.BooleanType()), T.StructField("sentiment", T.StringType()),
    T.StructField("confidence", T.DoubleType()), T.StructField("criticite", T.IntegerType()),
    T.StructField("serieux", T.IntegerType()), T.StructField("sarcasm_detected", T.BooleanType()),
    T.StructField("noise_level", T.IntegerType()), T.StructField("is_contructive", T.BooleanType()),
    T.StructField("keywords", T.ArrayType(T.StringType())),
    T.StructField("code_error", T.IntegerType()), T.StructField("error_text", T.StringType())])


def score_units(units: DataFrame, scorer) -> DataFrame:
    """Run a user's ``scorer`` (pandas in, pandas out) over (review x model) units in Arrow batches."""
    def run(batches):
        for b in batches:
            yield scorer(b)
    return units.mapInPandas(run, ANNOTATION_SCHEMA)


def pending_units(reviews: DataFrame, done: DataFrame | None, models=MODELS) -> DataFrame:
    """Every review x model pair (fan-out by the fixed model list), minus pairs already done."""
    ml = F.array(*[F.struct(F.lit(m).alias("model_used"), F.lit(i).alias("model_idx")) for i, m in enumerate(models)])
    units = reviews.select("review_id", "review_text", F.explode(ml).alias("m")).select(
        "review_id", "review_text", "m.model_used", "m.model_idx")
    if done is not None:
        units = units.join(done.select("review_id", "model_used"), ["review_id", "model_used"], "left_anti")
    return units


def annotation_tables(scored: DataFrame, run_ts: str = "2024-06-01 00:00:00"):
    """Split scorer output into annotations, keywords (child rows) and errors."""
    ok = scored.filter(F.col("ok"))
    aid = F.concat(F.col("model_used"), F.lit("__"), F.col("review_id").cast("string"))
    ann = ok.select(aid.alias("analysis_id"), "review_id", "model_used", "sentiment", "confidence", "criticite",
                    "serieux", "sarcasm_detected", "noise_level", "is_contructive")
    kw = ok.select(aid.alias("analysis_id"), F.posexplode("keywords").alias("pos", "keyword")).select(
        "analysis_id", F.lit("theme").alias("category"), "keyword", F.col("pos").alias("rank"))
    idx = F.array_position(F.array(*[F.lit(m) for m in MODELS]), F.col("model_used"))
    err = scored.filter(~F.col("ok")).select(
        "review_id", "model_used", "code_error", "error_text",
        (F.lit(run_ts).cast("timestamp") + F.make_interval(mins=idx.cast("int"))).alias("created_at"))
    return ann, kw, err


def sentiment_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews to annotate: labelled documents with their source polarity."""
    s = sentiment_reviews(fx.sentiment_payloads(spark, sf_dir))
    return s.select(F.col("review_id").cast("bigint").alias("review_id"), "review_text",
                    F.col("polarity").alias("source_polarity"))


def annotations(spark: SparkSession, sf_dir: str):
    """Two runs: first the even reviews on the first three models, then everything
    still missing; results upserted by analysis_id, keywords replaced per analysis."""
    src = sentiment_source(spark, sf_dir)
    # the responses of each run are landed, as rows that came from the models
    first_units = pending_units(src.filter(F.col("review_id") % 2 == 0), None, MODELS[:3])
    a1, k1, e1 = annotation_tables(materialize(fx.model_responses(first_units)), run_ts="2024-06-01 00:00:00")
    second_units = pending_units(src, a1)
    a2, k2, e2 = annotation_tables(materialize(fx.model_responses(second_units)), run_ts="2024-06-02 00:00:00")
    ann = upsert(a1, a2, ["analysis_id"], order=["model_used"])
    kw = replace_by_group(k1, k2, ["analysis_id"])
    err = e1.unionByName(e2)
    return ann, kw, err


# ------------------------------------------------------------------ statistics
def _work(spark, sf_dir):
    ann, _, _ = annotations(spark, sf_dir)
    src = sentiment_source(spark, sf_dir).select("review_id", "source_polarity")
    return ann.join(src, "review_id")


def model_comparison(work: DataFrame) -> DataFrame:
    match = (F.col("sentiment") == F.col("source_polarity")).cast("int")
    r4 = lambda c: F.round(c, 4)
    return work.groupBy("model_used").agg(
        F.count(F.lit(1)).alias("analyses"), F.count_distinct("review_id").alias("reviews"),
        ratio_round(F.sum(match) * 100, F.count(match), 2).alias("match_pct"),
        r4(F.avg("confidence")).alias("confidence_mean"), r4(F.stddev_samp("confidence")).alias("confidence_std"),
        r4(F.avg("criticite")).alias("criticite_mean"), r4(F.stddev_samp("criticite")).alias("criticite_std"),
        r4(F.avg("serieux")).alias("serieux_mean"), r4(F.stddev_samp("serieux")).alias("serieux_std"),
        r4(F.avg("noise_level")).alias("noise_level_mean"),
        ratio_round(F.sum(F.col("sarcasm_detected").cast("int")) * 100, F.count("sarcasm_detected"), 2).alias("sarcasm_pct"))


def majority_votes(work: DataFrame) -> DataFrame:
    """Per review the sentiment with most votes; ties go to the alphabetically first."""
    votes = work.groupBy("review_id", "sentiment").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("review_id").agg(
        F.min_by("sentiment", F.struct((-F.col("votes")).alias("v"), F.col("sentiment"))).alias("majority_sentiment"))
    return best


def majority_agreement(work: DataFrame) -> DataFrame:
    m = majority_votes(work)
    j = work.join(m, "review_id")
    return j.groupBy("model_used").agg(
        ratio_round(F.sum((F.col("sentiment") == F.col("majority_sentiment")).cast("int")) * 100, F.count(F.lit(1)), 2)
         .alias("agreement_pct"))


def inter_model_std(work: DataFrame) -> DataFrame:
    """Per review spread across models; a single annotation gives 0."""
    z = lambda c: F.round(F.coalesce(F.stddev_samp(c), F.lit(0.0)), 4).alias(f"{c}_std")
    return work.groupBy("review_id").agg(z("confidence"), z("criticite"), z("serieux"))


def review_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 + J16: models present/missing per review, error codes and last error."""
    ann, _, err = annotations(spark, sf_dir)
    src = sentiment_source(spark, sf_dir).select("review_id")
    present = ann.groupBy("review_id").agg(F.array_sort(F.collect_set("model_used")).alias("mp"))
    errs = err.groupBy("review_id").agg(
        F.array_sort(F.collect_set("code_error")).alias("codes"), F.count(F.lit(1)).alias("errors_count"),
        F.max("created_at").alias("last_error_at"),
        F.max_by("error_text", F.struct("created_at", "model_used")).alias("dernier_error_text"))
    all_models = F.array(*[F.lit(m) for m in MODELS])
    j = src.join(present, "review_id", "left").join(errs, "review_id", "left")
    mp = F.coalesce(F.col("mp"), F.array().cast("array<string>"))
    return j.select(
        "review_id", F.array_join(mp, ",").alias("models_present"), F.size(mp).alias("analyses_count"),
        F.array_join(F.filter(all_models, lambda m: ~F.array_contains(mp, m)), ",").alias("models_missing"),
        (F.size(mp) < REQUIRED_MODELS).alias("incomplete"),
        F.array_join(F.coalesce(F.col("codes").cast("array<string>"), F.array().cast("array<string>")), ", ")
         .alias("codes_erreur_txt"),
        F.coalesce(F.col("errors_count"), F.lit(0)).alias("errors_count"), "last_error_at",
        F.coalesce(F.col("dernier_error_text"), F.lit("")).alias("dernier_error_text"))


def annotations_detail(spark: SparkSession, sf_dir: str, models=None, sentiments=None,
                       keyword: str | None = "le") -> DataFrame:
    """J17 + P15 + J10: annotations (LEFT) joined to the reviews, filtered."""
    ann, _, _ = annotations(spark, sf_dir)
    src = sentiment_source(spark, sf_dir)
    df = src.join(ann, "review_id", "left")
    if models:
        df = df.filter(F.col("model_used").isin(*models))
    if sentiments:
        df = df.filter(F.col("sentiment").isin(*sentiments))
    if keyword:
        df = df.filter(F.coalesce(F.col("review_text"), F.lit("")).rlike("(?i)" + keyword))
    return df.select("review_id", "source_polarity", "analysis_id", "model_used", "sentiment", "confidence",
                     F.length("review_text").alias("text_length"))


# ------------------------------------------------------------------ registered queries
def _rev(spark, sf):
    return reviews_and_responses(spark, sf)[0]


def _resp(spark, sf):
    return reviews_and_responses(spark, sf)[1]


def _kpis(spark, sf):
    r, s = reviews_and_responses(spark, sf)
    return reviews_kpis(r, s)


def _pages(spark, sf):
    return read(spark, sf, "pages").select("page_id", "html")


QUERIES = {
    "reviews_extract": _rev,
    "reviews_responses": _resp,
    "reviews_dates": lambda s, d: reviews_with_dates(_rev(s, d)).select("review_uid", "review_date_raw",
                                                                       "review_date_parsed"),
    "reviews_kpis": _kpis,
    "reviews_weekly": lambda s, d: reviews_weekly(_rev(s, d)),
    "reviews_last7": lambda s, d: reviews_last7(_rev(s, d)),
    "reviews_search": lambda s, d: filter_reviews(_rev(s, d), keyword="le", ratings=[4, 5],
                                                  start="2023-03-01", end="2024-06-30").select(
        "review_uid", "rating", "review_date_parsed"),
    "pages_links": lambda s, d: extract_links(_pages(s, d)),
    "pages_titles": lambda s, d: page_title(_pages(s, d)),
    "sentiment_reviews": lambda s, d: sentiment_reviews(fx.sentiment_payloads(s, d)),
    "sentiment_kpis": lambda s, d: sentiment_kpis(sentiment_reviews(fx.sentiment_payloads(s, d))),
    "model_annotations": lambda s, d: annotations(s, d)[0],
    "model_keywords": lambda s, d: annotations(s, d)[1],
    "model_errors": lambda s, d: annotations(s, d)[2],
    "model_comparison": lambda s, d: model_comparison(_work(s, d)),
    "model_majority_agreement": lambda s, d: majority_agreement(_work(s, d)),
    "model_inter_std": lambda s, d: inter_model_std(_work(s, d)),
    "model_review_coverage": review_coverage,
    "model_annotations_detail": annotations_detail,
}
