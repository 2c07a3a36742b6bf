"""DuckDB oracles for the retail family (same names and columns as the Spark jobs)."""

from .sql_fixtures import RETAIL_LINES

W = "WITH " + RETAIL_LINES

LINE_ORDER_SQL = ("invoice_date NULLS FIRST, invoice NULLS FIRST, stock_code NULLS FIRST, "
                  "quantity NULLS FIRST, price NULLS FIRST, customer_id NULLS FIRST, "
                  "country NULLS FIRST, description NULLS FIRST")


def _first_by(key, values):
    cols = ", ".join(values)
    return (f"{W} SELECT {key}, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY {LINE_ORDER_SQL}) AS _rn FROM clean_orders) WHERE _rn = 1")


def _hist(col, bins):
    x = f"CAST({col} AS DOUBLE)"
    return f"""
    SELECT '{col}' AS metric, bin, CAST(count(*) AS BIGINT) AS nb FROM (
      SELECT CAST(CASE WHEN r.hi = r.lo THEN 1
                  ELSE least({bins}, CAST(floor(({x} - r.lo) * {bins} / (r.hi - r.lo)) AS INTEGER) + 1) END
                  AS INTEGER) AS bin
      FROM rfm_scores, (SELECT min({x}) AS lo, max({x}) AS hi FROM rfm_scores) r
      WHERE {col} IS NOT NULL) GROUP BY bin"""


ORACLES = {
    "retail_clean_orders": f"{W} SELECT * FROM clean_orders",
    "rfm_scores": f"{W} SELECT * REPLACE (round(monetary, 2) AS monetary) FROM rfm_scores",
    "v_rfm_segmentation": f"{W} SELECT * EXCLUDE (categorisation) REPLACE (round(monetary, 2) AS monetary) FROM rfm_scores",
    "dim_client": _first_by("customer_id", ["country"]),
    "dim_produit": _first_by("stock_code", ["description"]),
    "dim_facture": f"""{W} SELECT invoice, customer_id, invoice_date, starts_with(invoice, 'C') AS is_retour
        FROM (SELECT *, row_number() OVER (PARTITION BY invoice ORDER BY {LINE_ORDER_SQL}) AS _rn
              FROM clean_orders) WHERE _rn = 1""",
    "fact_lignes": f"""{W} SELECT CAST(row_number() OVER (ORDER BY {LINE_ORDER_SQL}) - 1 AS BIGINT) AS id,
        invoice, stock_code, quantity, price, round(quantity * price, 2) AS total_line FROM clean_orders""",
    "fact_orders": f"""{W} SELECT c.invoice, c.stock_code, c.description, c.quantity, c.invoice_date,
        c.price, c.customer_id, c.country, round(c.total_price, 2) AS total_price,
        round(c.quantity * c.price, 2) AS total_line,
        s.r_score, s.f_score, s.m_score, s.rfm_score, s.rfm_total, s.segment, s.categorisation
        FROM clean_orders c LEFT JOIN rfm_scores s ON c.customer_id = s.customer_id""",
    "rfm_kpis": f"""{W} SELECT CAST(count(*) AS BIGINT) AS nb_clients, (sum(CAST(round(monetary * 100) AS BIGINT)) / 100.0) AS total_ca,
        round(avg(recency), 4) AS avg_recency, round(avg(frequency), 4) AS avg_frequency,
        ((sum(CAST(round(monetary * 100) AS BIGINT)) * 200 + count(monetary) * 100) // (2 * count(monetary) * 100) / 100.0) AS avg_monetary, ((CAST(round(quantile_cont(monetary, 0.5) * 200) AS BIGINT) * 200 + 200) // 400 / 100.0) AS median_monetary,
        CAST(count(DISTINCT segment) AS BIGINT) AS nb_segments,
        CAST(count(*) FILTER (WHERE segment = 'Champion') AS BIGINT) AS champions,
        round(count(*) FILTER (WHERE segment = 'Champion') * 100.0::DOUBLE / count(*), 4) AS pct_champions,
        CAST(count(*) FILTER (WHERE categorisation = 'VIP') AS BIGINT) AS vip
        FROM rfm_scores""",
    "rfm_segment_stats": f"""{W} SELECT segment, CAST(count(*) AS BIGINT) AS nb_clients,
        round(avg(recency), 4) AS recency_moy, round(avg(frequency), 4) AS freq_moy,
        ((sum(CAST(round(monetary * 100) AS BIGINT)) * 200 + count(monetary) * 100) // (2 * count(monetary) * 100) / 100.0) AS monetary_moy, (sum(CAST(round(monetary * 100) AS BIGINT)) / 100.0) AS ca,
        round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM rfm_scores), 4) AS pct_clients,
        round(sum(monetary) * 100.0::DOUBLE / (SELECT sum(monetary) FROM rfm_scores), 4) AS pct_ca
        FROM rfm_scores GROUP BY segment""",
    "rfm_category_stats": f"""{W} SELECT categorisation, CAST(count(*) AS BIGINT) AS nb_clients,
        (sum(CAST(round(monetary * 100) AS BIGINT)) / 100.0) AS ca,
        round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM rfm_scores), 4) AS pct_clients,
        round(sum(monetary) * 100.0::DOUBLE / (SELECT sum(monetary) FROM rfm_scores), 4) AS pct_ca
        FROM rfm_scores GROUP BY categorisation""",
    "rfm_rf_grid": f"""{W} SELECT r_score, f_score, CAST(count(*) AS BIGINT) AS nb,
        ((sum(CAST(round(monetary * 100) AS BIGINT)) * 200 + count(monetary) * 100) // (2 * count(monetary) * 100) / 100.0) AS ca_moy FROM rfm_scores GROUP BY r_score, f_score""",
    "rfm_histograms": f"{W} {_hist('recency', 40)} UNION ALL {_hist('frequency', 30)} UNION ALL {_hist('monetary', 35)}",
    "rfm_top_customers": f"""{W} SELECT customer_id, segment, categorisation, recency, frequency,
        round(monetary, 2) AS monetary, rfm_score, rfm_total FROM rfm_scores
        ORDER BY monetary DESC, customer_id LIMIT 25""",
    "retail_cleaning_losses": f"""{W}, t AS (SELECT *,
            (customer_id IS NULL OR quantity IS NULL OR price IS NULL OR invoice_date IS NULL) AS s_null,
            (invoice IS NULL OR starts_with(invoice, 'C')) AS s_ret,
            (quantity <= 0 OR price <= 0) AS s_inv FROM retail_typed)
        SELECT CAST(count(*) AS BIGINT) AS rows_raw,
            CAST(count(*) FILTER (WHERE s_null) AS BIGINT) AS removed_nulls,
            CAST(count(*) FILTER (WHERE NOT s_null AND s_ret) AS BIGINT) AS removed_returns,
            CAST(count(*) FILTER (WHERE NOT s_null AND NOT s_ret AND s_inv) AS BIGINT) AS removed_invalid,
            (SELECT CAST(count(*) AS BIGINT) FROM clean_orders) AS rows_clean,
            CAST(count(*) - count(*) FILTER (WHERE s_null) - count(*) FILTER (WHERE NOT s_null AND s_ret)
                 - count(*) FILTER (WHERE NOT s_null AND NOT s_ret AND s_inv)
                 - (SELECT count(*) FROM clean_orders) AS BIGINT) AS removed_duplicates
        FROM t""",
    "rfm_sample": f"""{W} SELECT customer_id, segment, recency, frequency, round(monetary, 2) AS monetary, rfm_score
        FROM rfm_scores ORDER BY md5(customer_id || '/42'), customer_id LIMIT 5000""",
    "retail_quality_report": f"""{W} SELECT CAST(count(*) AS BIGINT) AS rows,
        CAST(count(*) FILTER (WHERE customer_id IS NULL) AS BIGINT) AS missing_customer,
        CAST(count(DISTINCT country) AS BIGINT) AS countries,
        min(invoice_date) AS first_invoice_date, max(invoice_date) AS last_invoice_date,
        CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM retail_typed)) AS BIGINT) AS duplicate_rows
        FROM retail_typed""",
}
