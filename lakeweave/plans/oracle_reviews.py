"""DuckDB oracles for the reviews family."""

from .sql_fixtures import REVIEWS

W = "WITH " + REVIEWS

_MODELS = ["llama-3.1-8b-instant", "llama-3.3-70b-versatile", "openai/gpt-oss-120b", "openai/gpt-oss-20b",
           "meta-llama/llama-4-scout-17b-16e-instruct", "qwen/qwen3-32b"]
_ML = "[" + ", ".join(f"'{m}'" for m in _MODELS) + "]"


def _rr(num, den, scale):
    f = 10 ** scale
    return f"(({num}) * {2 * f} + ({den})) // (2 * ({den})) / {float(f)}"


SCORING = f"""{W},
src AS (SELECT doc_id AS review_id, review_text, polarity AS source_polarity FROM sentiment),
units AS (SELECT s.review_id, s.review_text, s.source_polarity, m.i - 1 AS mi, {_ML}[m.i] AS model_used
          FROM src s, (SELECT unnest(generate_series(1, 6)) AS i) m),
run1 AS (SELECT *, 1 AS run FROM units WHERE review_id % 2 = 0 AND mi < 3),
ok1 AS (SELECT * FROM run1 WHERE (review_id * 31 + mi) % 17 != 0),
run2 AS (SELECT u.*, 2 AS run FROM units u ANTI JOIN ok1 o ON u.review_id = o.review_id AND u.mi = o.mi),
allruns AS (SELECT * FROM run1 UNION ALL SELECT * FROM run2),
ann AS (
    SELECT model_used || '__' || CAST(review_id AS VARCHAR) AS analysis_id, review_id, model_used,
           ['positive', 'negative', 'neutral'][(review_id + mi) % 3 + 1] AS sentiment,
           ((review_id * 7 + mi * 13) % 100) / 100.0::DOUBLE AS confidence,
           CAST((review_id + mi) % 5 + 1 AS INTEGER) AS criticite,
           CAST((review_id * 3 + mi) % 5 + 1 AS INTEGER) AS serieux,
           (review_id + mi) % 11 = 0 AS sarcasm_detected,
           CAST((length(review_text) + mi) % 4 AS INTEGER) AS noise_level,
           (review_id + mi) % 2 = 0 AS is_contructive, mi, run, source_polarity
    FROM allruns WHERE (review_id * 31 + mi) % 17 != 0),
err AS (
    SELECT review_id, model_used, CAST(CASE WHEN mi % 2 = 0 THEN 429 ELSE 500 END AS INTEGER) AS code_error,
           CASE WHEN mi % 2 = 0 THEN 'rate limited' ELSE 'server error' END AS error_text,
           (CASE WHEN run = 1 THEN TIMESTAMP '2024-06-01 00:00:00' ELSE TIMESTAMP '2024-06-02 00:00:00' END)
             + to_minutes(CAST(mi + 1 AS BIGINT)) AS created_at
    FROM allruns WHERE (review_id * 31 + mi) % 17 = 0)"""

_ANN_COLS = ("analysis_id, review_id, model_used, sentiment, confidence, criticite, serieux, sarcasm_detected, "
             "noise_level, is_contructive")

ORACLES = {
    "reviews_extract": f"{W} SELECT * FROM reviews",
    "reviews_responses": f"{W} SELECT * FROM responses",
    "reviews_dates": f"{W} SELECT review_uid, review_date_raw, review_date_parsed FROM reviews_dated",
    "reviews_kpis": f"""{W}, ans AS (SELECT * FROM responses WHERE review_uid IN (SELECT review_uid FROM reviews))
        SELECT CAST(count(*) AS BIGINT) AS total_reviews,
               (SELECT CAST(count(*) AS BIGINT) FROM ans) AS total_responses,
               round(avg(rating), 4) AS avg_rating,
               (SELECT CAST(count(DISTINCT review_uid) AS BIGINT) FROM ans) AS responded_reviews,
               {_rr("(SELECT count(DISTINCT review_uid) FROM ans) * 100", "count(*)", 2)} AS response_rate_pct
        FROM reviews""",
    "reviews_weekly": f"""{W},
        dated AS (SELECT *, review_date_parsed + CAST((8 - isodow(review_date_parsed)) % 7 AS INTEGER) AS semaine
                  FROM reviews_dated WHERE review_date_parsed IS NOT NULL AND rating IS NOT NULL),
        wk AS (SELECT semaine, round(avg(rating), 4) AS note_moyenne, CAST(count(*) AS BIGINT) AS nb_avis
               FROM dated GROUP BY semaine),
        cal AS (SELECT CAST(unnest(generate_series(CAST(min(semaine) AS TIMESTAMP), CAST(max(semaine) AS TIMESTAMP),
                                                   INTERVAL 7 DAY)) AS DATE) AS semaine FROM dated)
        SELECT cal.semaine, wk.note_moyenne, wk.nb_avis FROM cal LEFT JOIN wk ON cal.semaine = wk.semaine""",
    "reviews_last7": f"""{W},
        dated AS (SELECT * FROM reviews_dated WHERE review_date_parsed IS NOT NULL AND rating IS NOT NULL),
        l AS (SELECT max(review_date_parsed) AS d FROM dated)
        SELECT l.d AS derniere_date, round(avg(rating), 4) AS moyenne_7j, CAST(count(*) AS BIGINT) AS nb_avis
        FROM dated, l WHERE review_date_parsed >= l.d - INTERVAL 7 DAY GROUP BY l.d""",
    "reviews_search": f"""{W} SELECT review_uid, rating, review_date_parsed FROM reviews_dated
        WHERE rating IN (4, 5) AND regexp_matches(coalesce(review_text, ''), '(?i)le')
          AND review_date_parsed >= DATE '2023-03-01' AND review_date_parsed < DATE '2024-06-30' + INTERVAL 1 DAY""",
    # the four entities that page titles hold, with and without their semicolon
    "pages_titles": r"""SELECT page_id, nullif(regexp_replace(replace(replace(replace(replace(
            regexp_replace(regexp_replace(regexp_replace(t, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;', '&'), '&amp', '&'), '&copy;', '©'), '&middot;', '·'),
            '^\s+|\s+$', '', 'g'), '') AS title
        FROM (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS t FROM pages)""",
    "pages_links": """SELECT page_id, href, CAST(min(pos) AS INTEGER) AS first_pos,
            lower(regexp_replace(href, '^/+|/+$', '', 'g')) AS slug
        FROM (SELECT page_id, unnest(l) AS href, unnest(generate_series(0, len(l) - 1)) AS pos
              FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]+)"', 1) AS l FROM pages))
        GROUP BY page_id, href""",
    "sentiment_reviews": f"{W} SELECT review_id, review_text, polarity, created_at FROM sentiment",
    "sentiment_kpis": f"""{W} SELECT polarity, CAST(count(*) AS BIGINT) AS nb_reviews,
            {_rr("sum(length(review_text))", "count(*)", 2)} AS avg_length,
            {_rr("count(*) * 100", "(SELECT count(*) FROM sentiment)", 2)} AS pct_reviews
        FROM sentiment GROUP BY polarity""",
    "model_annotations": f"{SCORING} SELECT {_ANN_COLS} FROM ann",
    "model_keywords": f"""{SCORING} SELECT analysis_id, 'theme' AS category, kw AS keyword, CAST(r AS INTEGER) AS rank
        FROM ann, LATERAL (SELECT unnest(['kw' || CAST(review_id % 10 AS VARCHAR), 'kw' || CAST((review_id + mi) % 7 AS VARCHAR)]) AS kw,
                                  unnest([0, 1]) AS r)""",
    "model_errors": f"{SCORING} SELECT * FROM err",
    "model_comparison": f"""{SCORING} SELECT model_used, CAST(count(*) AS BIGINT) AS analyses,
            CAST(count(DISTINCT review_id) AS BIGINT) AS reviews,
            {_rr('sum(CAST(sentiment = source_polarity AS INTEGER)) * 100', 'count(*)', 2)} AS match_pct,
            round(avg(confidence), 4) AS confidence_mean, round(stddev_samp(confidence), 4) AS confidence_std,
            round(avg(criticite), 4) AS criticite_mean, round(stddev_samp(criticite), 4) AS criticite_std,
            round(avg(serieux), 4) AS serieux_mean, round(stddev_samp(serieux), 4) AS serieux_std,
            round(avg(noise_level), 4) AS noise_level_mean,
            {_rr('sum(CAST(sarcasm_detected AS INTEGER)) * 100', 'count(*)', 2)} AS sarcasm_pct
        FROM ann GROUP BY model_used""",
    "model_majority_agreement": f"""{SCORING},
        votes AS (SELECT review_id, sentiment, count(*) AS v FROM ann GROUP BY ALL),
        maj AS (SELECT review_id, sentiment AS majority_sentiment FROM (
                  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY v DESC, sentiment) AS rn FROM votes)
                WHERE rn = 1)
        SELECT model_used, {_rr('sum(CAST(a.sentiment = m.majority_sentiment AS INTEGER)) * 100', 'count(*)', 2)} AS agreement_pct
        FROM ann a JOIN maj m ON a.review_id = m.review_id GROUP BY model_used""",
    "model_inter_std": f"""{SCORING} SELECT review_id,
            round(coalesce(stddev_samp(confidence), 0.0), 4) AS confidence_std,
            round(coalesce(stddev_samp(criticite), 0.0), 4) AS criticite_std,
            round(coalesce(stddev_samp(serieux), 0.0), 4) AS serieux_std
        FROM ann GROUP BY review_id""",
    "model_review_coverage": f"""{SCORING},
        pres AS (SELECT review_id, list_sort(list_distinct(list(model_used))) AS mp FROM ann GROUP BY review_id),
        ers AS (SELECT review_id, list_sort(list_distinct(list(code_error))) AS codes, count(*) AS n,
                       max(created_at) AS last_error_at, arg_max(error_text, created_at) AS txt
                FROM err GROUP BY review_id)
        SELECT s.review_id, array_to_string(coalesce(p.mp, []), ',') AS models_present,
               CAST(len(coalesce(p.mp, [])) AS INTEGER) AS analyses_count,
               array_to_string(list_filter({_ML}, lambda m: NOT list_contains(coalesce(p.mp, []), m)), ',') AS models_missing,
               len(coalesce(p.mp, [])) < 6 AS incomplete,
               array_to_string(coalesce(list_transform(e.codes, lambda c: CAST(c AS VARCHAR)), []), ', ') AS codes_erreur_txt,
               CAST(coalesce(e.n, 0) AS BIGINT) AS errors_count, e.last_error_at,
               coalesce(e.txt, '') AS dernier_error_text
        FROM src s LEFT JOIN pres p ON s.review_id = p.review_id LEFT JOIN ers e ON s.review_id = e.review_id""",
    "model_annotations_detail": f"""{SCORING} SELECT s.review_id, s.source_polarity, a.analysis_id, a.model_used,
            a.sentiment, a.confidence, CAST(length(s.review_text) AS INTEGER) AS text_length
        FROM src s LEFT JOIN ann a ON s.review_id = a.review_id
        WHERE regexp_matches(coalesce(s.review_text, ''), '(?i)le')""",
}
