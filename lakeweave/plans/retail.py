"""F1 — retail orders: cleaning, RFM scoring, star schema, dashboard frames.

One lazy plan from the raw lines to the scores.  The cleaned lines are the
only frame reused by several outputs (scores, dimensions, facts).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import days_between_floor, try_double, try_timestamp
from ..functions.labels import rfm_category, rfm_segment
from ..operators.dedupe import first_by_key
from ..operators.quality import ratio_round
from ..operators.ranking import (exact_quantiles, global_row_number, qcut_bin,
                                 qcut_edges, rank_first_bin)
from ..session import materialize
from ..sources.fixtures import retail_lines
from ..sources.tables import kept

RAW_COLUMNS = ["invoice", "stock_code", "description", "quantity",
               "invoice_date", "price", "customer_id", "country"]

# the column names of an exported workbook and ours
SOURCE_RENAMES = {
    "Invoice": "invoice", "StockCode": "stock_code", "Description": "description",
    "Quantity": "quantity", "InvoiceDate": "invoice_date", "Price": "price",
    "Customer ID": "customer_id", "Country": "country",
}


def normalize_raw(df: DataFrame) -> DataFrame:
    """Rename source headers and keep the expected columns."""
    df = df.withColumnsRenamed({k: v for k, v in SOURCE_RENAMES.items() if k in df.columns})
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df.select(*[F.col(c).cast("string") for c in RAW_COLUMNS])


# ------------------------------------------------------------------ cleaning
def cast_types(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "quantity": try_double("quantity"),
        "price": try_double("price"),
        "invoice_date": try_timestamp("invoice_date"),
    })


def clean_stages(df: DataFrame) -> dict:
    """Predicates of each cleaning step, in the fixed order."""
    return {
        "nulls": (F.col("customer_id").isNull() | F.col("quantity").isNull()
                  | F.col("price").isNull() | F.col("invoice_date").isNull()),
        "returns": F.col("invoice").isNull() | F.col("invoice").startswith("C"),
        "invalid": (F.col("quantity") <= 0) | (F.col("price") <= 0),
    }


def clean_orders(raw: DataFrame) -> DataFrame:
    """cast -> nulls -> returns -> invalid -> duplicates, then total_price."""
    typed = cast_types(raw)
    keep = None
    for pred in clean_stages(typed).values():
        keep = ~pred if keep is None else keep & ~pred
    return (typed.filter(keep).dropDuplicates()
                 .withColumn("total_price", F.col("quantity") * F.col("price")))


def cleaning_losses(raw: DataFrame) -> DataFrame:
    """Q10: rows removed by each step in one pass (+ duplicates by a distinct count)."""
    typed = cast_types(raw)
    st = clean_stages(typed)
    dropped_nulls = st["nulls"]
    dropped_returns = ~dropped_nulls & st["returns"]
    dropped_invalid = ~dropped_nulls & ~st["returns"] & st["invalid"]
    survivors = typed.filter(~st["nulls"] & ~st["returns"] & ~st["invalid"])
    counts = typed.agg(
        F.count(F.lit(1)).alias("rows_raw"),
        F.count_if(dropped_nulls).alias("removed_nulls"),
        F.count_if(dropped_returns).alias("removed_returns"),
        F.count_if(dropped_invalid).alias("removed_invalid"),
    )
    rows_clean = survivors.dropDuplicates().agg(F.count(F.lit(1))).scalar()
    return (counts.withColumn("rows_clean", rows_clean)
                  .withColumn("removed_duplicates",
                              F.col("rows_raw") - F.col("removed_nulls") - F.col("removed_returns")
                              - F.col("removed_invalid") - F.col("rows_clean")))


def quality_report(raw: DataFrame) -> DataFrame:
    """Q8: rows, missing customer, duplicate rows, countries, date span."""
    typed = cast_types(raw)
    base = typed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("customer_id").isNull()).alias("missing_customer"),
        F.count_distinct("country").alias("countries"),
        F.min("invoice_date").alias("first_invoice_date"),
        F.max("invoice_date").alias("last_invoice_date"),
    )
    distinct_rows = typed.dropDuplicates().agg(F.count(F.lit(1))).scalar()
    return base.withColumn("duplicate_rows", F.col("rows") - distinct_rows)


# ------------------------------------------------------------------ RFM
def compute_rfm(clean: DataFrame) -> DataFrame:
    """Recency (whole days to max date + 1 day), frequency, monetary."""
    per_customer = clean.groupBy("customer_id").agg(
        F.max("invoice_date").alias("_last"),
        F.count_distinct("invoice").alias("frequency"),
        # an exact sum: the order of addition can't move a customer over a quintile edge
        F.sum(F.col("total_price").cast("decimal(28,6)")).cast("double").alias("monetary"),
    )
    # scalar subquery over the same aggregate: its shuffle is reused, the lines are read once
    snapshot = per_customer.agg(F.max("_last") + F.expr("INTERVAL 1 DAY")).scalar()
    return per_customer.select("customer_id",
                               days_between_floor(snapshot, "_last").alias("recency"),
                               "frequency", "monetary")


def add_rfm_scores(rfm: DataFrame, q: int = 5) -> DataFrame:
    """Qcut recency (labels reversed), rank-first qcut frequency, qcut monetary."""
    rfm = materialize(rfm)   # reused by three rank passes
    n = rfm.count()
    # recency and monetary are never NULL (built from cleaned, non-null lines): share the count
    r_edges = qcut_edges(rfm, "recency", q, ["customer_id"], n=n)
    m_edges = qcut_edges(rfm, "monetary", q, ["customer_id"], n=n)
    ranked = global_row_number(rfm, ["frequency", "customer_id"], name="_frank")
    scored = ranked.select(
        "customer_id", "recency", "frequency", "monetary",
        (F.lit(q + 1) - qcut_bin("recency", r_edges)).cast("int").alias("r_score"),
        rank_first_bin("_frank", n, q).alias("f_score"),
        qcut_bin("monetary", m_edges).cast("int").alias("m_score"),
    )
    scored = scored.withColumns({
        "rfm_score": F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"),
                              F.col("m_score").cast("string")),
        "rfm_total": F.col("r_score") + F.col("f_score") + F.col("m_score"),
    })
    return scored.withColumns({"segment": rfm_segment(), "categorisation": rfm_category()})


def rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = clean_orders(retail_lines(spark, sf_dir))
    return add_rfm_scores(compute_rfm(clean))


def present_scores(scores: DataFrame) -> DataFrame:
    """Published form: money rounded to cents."""
    return scores.withColumn("monetary", F.round("monetary", 2))


def v_rfm_segmentation(scores: DataFrame) -> DataFrame:
    """The segmentation view: scores without categorisation, segment recomputed in SQL form."""
    return scores.select("customer_id", "recency", "frequency", "monetary", "r_score", "f_score",
                         "m_score", "rfm_score", "rfm_total", rfm_segment().alias("segment"))


# ------------------------------------------------------------------ star schema
LINE_ORDER = ["invoice_date", "invoice", "stock_code", "quantity", "price",
              "customer_id", "country", "description"]


def dim_client(clean: DataFrame) -> DataFrame:
    return first_by_key(clean, ["customer_id"], ["country"], LINE_ORDER)


def dim_produit(clean: DataFrame) -> DataFrame:
    return first_by_key(clean, ["stock_code"], ["description"], LINE_ORDER)


def dim_facture(clean: DataFrame) -> DataFrame:
    d = first_by_key(clean, ["invoice"], ["customer_id", "invoice_date"], LINE_ORDER)
    return d.withColumn("is_retour", F.col("invoice").startswith("C"))


def fact_lignes(clean: DataFrame) -> DataFrame:
    """Lines with a dense 0-based id in the line order (P25), no global window."""
    lines = clean.select("invoice", "stock_code", "quantity", "price",
                         (F.col("quantity") * F.col("price")).alias("total_line"),
                         *[c for c in LINE_ORDER if c not in ("invoice", "stock_code", "quantity", "price")])
    ranked = global_row_number(lines, LINE_ORDER, name="_rn")
    return ranked.select((F.col("_rn") - 1).alias("id"), "invoice", "stock_code", "quantity",
                         "price", F.round("total_line", 2).alias("total_line"))


def fact_orders(clean: DataFrame, scores: DataFrame) -> DataFrame:
    """Every clean line enriched with its customer's scores (many-to-one)."""
    cols = ["customer_id", "r_score", "f_score", "m_score", "rfm_score", "rfm_total",
            "segment", "categorisation"]
    return (clean.withColumn("total_line", F.round(F.col("quantity") * F.col("price"), 2))
                 .withColumn("total_price", F.round("total_price", 2))
                 .join(scores.select(*cols), "customer_id", "left"))


# ------------------------------------------------------------------ dashboard
def _cents(col: str):
    return F.round(F.col(col) * 100).cast("bigint")


def money_sum(col: str):
    """Sum of money on exact cents (engine-independent, no float-order drift)."""
    return F.sum(_cents(col)) / F.lit(100.0)


def money_avg(col: str):
    """Mean of money, exact half-up to the cent (sum of cents / count)."""
    return ratio_round(F.sum(_cents(col)), F.count(F.col(col)) * 100, 2)


def rfm_kpis(scores: DataFrame) -> DataFrame:
    median_m = exact_quantiles(scores, "monetary", [0.5], ["customer_id"])[0]
    return scores.agg(
        F.count(F.lit(1)).alias("nb_clients"),
        money_sum("monetary").alias("total_ca"),
        F.round(F.avg("recency"), 4).alias("avg_recency"),
        F.round(F.avg("frequency"), 4).alias("avg_frequency"),
        money_avg("monetary").alias("avg_monetary"),
        # the median of cent values is a multiple of half a cent: round it exactly
        ratio_round(F.round(F.lit(median_m).cast("double") * 200).cast("bigint"), F.lit(200), 2)
         .alias("median_monetary"),
        F.count_distinct("segment").alias("nb_segments"),
        F.count_if(F.col("segment") == "Champion").alias("champions"),
        F.round(F.count_if(F.col("segment") == "Champion") * 100.0 / F.count(F.lit(1)), 4)
         .alias("pct_champions"),
        F.count_if(F.col("categorisation") == "VIP").alias("vip"),
    )


def _with_share(df: DataFrame, scores: DataFrame) -> DataFrame:
    n = scores.agg(F.count(F.lit(1))).scalar()
    total = scores.agg(F.sum("monetary")).scalar()
    return (df.withColumn("pct_clients", F.round(F.col("nb_clients") * 100.0 / n, 4))
              .withColumn("pct_ca", F.round(F.col("_ca") * 100.0 / total, 4))
              .drop("_ca"))


def rfm_segment_stats(scores: DataFrame) -> DataFrame:
    seg = scores.groupBy("segment").agg(
        F.count(F.lit(1)).alias("nb_clients"),
        F.sum("monetary").alias("_ca"),
        F.round(F.avg("recency"), 4).alias("recency_moy"),
        F.round(F.avg("frequency"), 4).alias("freq_moy"),
        money_avg("monetary").alias("monetary_moy"),
        money_sum("monetary").alias("ca"),
    )
    return _with_share(seg, scores)


def rfm_category_stats(scores: DataFrame) -> DataFrame:
    cat = scores.groupBy("categorisation").agg(
        F.count(F.lit(1)).alias("nb_clients"), F.sum("monetary").alias("_ca"),
        money_sum("monetary").alias("ca"))
    return _with_share(cat, scores)


def rfm_rf_grid(scores: DataFrame) -> DataFrame:
    return scores.groupBy("r_score", "f_score").agg(
        F.count(F.lit(1)).alias("nb"), money_avg("monetary").alias("ca_moy"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the max value falls in the last bin."""
    lo = df.agg(F.min(F.col(col).cast("double"))).scalar()
    hi = df.agg(F.max(F.col(col).cast("double"))).scalar()
    x = F.col(col).cast("double")
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.lit(bins), F.floor((x - lo) * F.lit(bins) / (hi - lo)).cast("int") + 1))
    return (df.select(col).filter(F.col(col).isNotNull())
              .select(b.cast("int").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("nb"))
              .withColumn("metric", F.lit(col)))


def rfm_histograms(scores: DataFrame) -> DataFrame:
    return (histogram(scores, "recency", 40)
            .unionByName(histogram(scores, "frequency", 30))
            .unionByName(histogram(scores, "monetary", 35)))


def rfm_top_customers(scores: DataFrame, n: int = 25) -> DataFrame:
    """O2: nlargest by monetary; ties keep the customer order."""
    return (scores.orderBy(F.desc("monetary"), F.asc("customer_id")).limit(n)
                  .select("customer_id", "segment", "categorisation", "recency", "frequency",
                          F.round("monetary", 2).alias("monetary"), "rfm_score", "rfm_total"))


def rfm_sample(scores: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """Stable sample of at most n customers (hash order, same every run)."""
    return (scores.orderBy(F.md5(F.concat(F.col("customer_id"), F.lit(f"/{seed}"))), "customer_id").limit(n)
                  .select("customer_id", "segment", "recency", "frequency",
                          F.round("monetary", 2).alias("monetary"), "rfm_score"))


# ------------------------------------------------------------------ registered queries
def _clean(spark, sf):
    return clean_orders(retail_lines(spark, sf))


def _lines(spark, sf):
    """The clean lines as stored; only ``retail_clean_orders`` builds them."""
    return kept(spark, sf, "clean_orders", lambda: _clean(spark, sf))


def _scored(spark, sf):
    return add_rfm_scores(compute_rfm(_lines(spark, sf)))


def _scores(spark, sf):
    """The score table as stored: views and dashboards read it."""
    return kept(spark, sf, "rfm_scores", lambda: _scored(spark, sf))


QUERIES = {
    "retail_clean_orders": _clean,
    "rfm_scores": lambda s, d: present_scores(_scored(s, d)),
    "v_rfm_segmentation": lambda s, d: present_scores(v_rfm_segmentation(_scores(s, d))),
    "dim_client": lambda s, d: dim_client(_lines(s, d)),
    "dim_produit": lambda s, d: dim_produit(_lines(s, d)),
    "dim_facture": lambda s, d: dim_facture(_lines(s, d)),
    "fact_lignes": lambda s, d: fact_lignes(_lines(s, d)),
    "fact_orders": lambda s, d: _fact_orders(s, d),
    "rfm_kpis": lambda s, d: rfm_kpis(_scores(s, d)),
    "rfm_segment_stats": lambda s, d: rfm_segment_stats(_scores(s, d)),
    "rfm_category_stats": lambda s, d: rfm_category_stats(_scores(s, d)),
    "rfm_rf_grid": lambda s, d: rfm_rf_grid(_scores(s, d)),
    "rfm_histograms": lambda s, d: rfm_histograms(_scores(s, d)),
    "rfm_top_customers": lambda s, d: rfm_top_customers(_scores(s, d)),
    "rfm_sample": lambda s, d: rfm_sample(_scores(s, d)),
    "retail_cleaning_losses": lambda s, d: cleaning_losses(retail_lines(s, d)),
    "retail_quality_report": lambda s, d: quality_report(retail_lines(s, d)),
}


def _fact_orders(spark, sf):
    return fact_orders(_lines(spark, sf), _scores(spark, sf))
