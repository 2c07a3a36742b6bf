"""DuckDB oracles of the scoring pass: the rule of the stand-in model, and which units fail in which run."""

from .reviews import MODELS

_UNITS = f"""WITH u AS (
    SELECT d.doc_id AS review_id, model_used, i - 1 AS place, string_split_regex(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+') AS raw
    FROM documents d JOIN labels l USING (doc_id), (SELECT unnest({list(MODELS)}) AS model_used, unnest(range(1, {len(MODELS) + 1})) AS i)),
w AS (SELECT *, list_filter(raw, lambda x: x <> '') AS words FROM u),
s AS (SELECT review_id, model_used, place, CASE WHEN len(words) < 5 THEN 422 WHEN (review_id * 3 + place) % 11 = 0 AND place = 0 THEN 503 END AS code,
    len(list_filter(words, lambda x: length(x) > 5)) / len(words) + place / 100 AS share FROM w)
"""

ORACLES = {
    "score_reviews": f"""{_UNITS} SELECT review_id, model_used, CASE WHEN share > 0.4 THEN 'positif' WHEN share < 0.25 THEN 'negatif' ELSE 'neutre' END AS sentiment,
        round(round(share, 6), 4) AS confidence, CASE WHEN review_id % 2 = 0 THEN 0 ELSE 1 END AS run FROM s WHERE code IS NULL""",
    "score_reviews_errors": f"""{_UNITS} SELECT model_used, run, code AS code_error, CASE WHEN code = 422 THEN 1 ELSE 3 END AS attempts, CAST(count(*) AS BIGINT) AS units
        FROM s, (SELECT unnest([0, 1]) AS run) WHERE code IS NOT NULL AND (run = 1 OR review_id % 2 = 0) GROUP BY ALL""",
}
