"""DuckDB oracles for reference records and the sales mart."""

from .sql_fixtures import REFERENCE, SALES

W = "WITH " + REFERENCE


def _rr(num, den, scale):
    f = 10 ** scale
    return f"(({num}) * {2 * f} + ({den})) // (2 * ({den})) / {float(f)}"


_STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _strip(x):
    return _STRIP.format(x=x)


def _collapse(x):
    return f"lower(array_to_string(string_split_regex({_strip(x)}, '\\s+'), ' '))"


_FAV = f"""{W},
favs AS (SELECT DISTINCT unnest(favorites) AS label FROM species),
c AS (
    SELECT label, {_strip('label')} AS s, lower({_strip('label')}) AS lo,
           regexp_extract({_strip('label')}, '(?i)^lots\\s+of\\s+(.+)$', 1) AS tail FROM favs),
cands AS (
    SELECT label, 1 AS prio, lo AS k FROM c
    UNION ALL SELECT label, 2, CASE WHEN tail != '' THEN lower({_strip('tail')}) END FROM c
    UNION ALL SELECT label, 3, CASE WHEN tail != '' THEN {_collapse('tail')} END FROM c
    UNION ALL SELECT label, 4, {_collapse('s')} FROM c
    UNION ALL SELECT label, 5, CASE WHEN suffix(lo, ' stuff') THEN {_strip('substr(lo, 1, length(lo) - 6)')} || ' stuff' END FROM c),
m AS (
    SELECT cands.label, cands.prio, g.valeur AS theme FROM cands JOIN gift_themes g ON lower(g.valeur) = cands.k
    WHERE cands.k IS NOT NULL AND cands.k != ''),
best AS (SELECT label, min(prio) AS match_rank, arg_min(theme, (prio, theme)) AS theme FROM m GROUP BY label)
SELECT f.label, b.match_rank, b.theme FROM favs f LEFT JOIN best b ON f.label = b.label"""

_ITEMS_OF_THEME = "SELECT gift_theme_valeur AS theme, " + ", ".join(
    f"arg_max(name, (row_no, name)) FILTER (type_valeur = '{kind}') AS {category}" for kind, category in (("chair", "relaxation"), ("medium", "decoration"), ("small", "tot"))) + " FROM items GROUP BY gift_theme_valeur"


def _text(x):
    """Character references of the pages, and outer white space gone."""
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{sign}')"
    return f"trim({x})"


ORACLES = {
    "reference_items": f"{W} SELECT * FROM items",
    "reference_gift_themes": f"{W} SELECT * FROM gift_themes",
    "reference_items_by_category": f"""{W} SELECT t.category_valeur, i.type_valeur, CAST(count(*) AS BIGINT) AS nb_items,
            CAST(count(DISTINCT i.name) AS BIGINT) AS nb_noms
        FROM items i JOIN (VALUES ('chair', 'relaxation'), ('medium', 'decoration'), ('small', 'tot'))
             AS t(valeur, category_valeur) ON i.type_valeur = t.valeur GROUP BY ALL""",
    "reference_items_by_theme": f"""{W} SELECT gift_theme_valeur, CAST(count(*) AS BIGINT) AS nb_items,
            array_to_string(list_sort(list_distinct(list(type_valeur))), ',') AS types
        FROM items GROUP BY gift_theme_valeur""",
    "reference_species": f"{W} SELECT nom, num, nullif(ideal_habitat, '') AS ideal_habitat_valeur FROM species",
    "reference_specialties": f"{W} SELECT DISTINCT unnest(specialties) AS valeur FROM species",
    "reference_ideal_habitats": f"{W} SELECT DISTINCT ideal_habitat AS valeur FROM species WHERE ideal_habitat <> ''",
    "reference_favorites": f"{W} SELECT DISTINCT unnest(favorites) AS valeur FROM species",
    "reference_species_specialties": f"""{W} SELECT nom AS species_nom, unnest(specialties) AS specialty_valeur,
            CAST(unnest(generate_series(1, len(specialties))) AS INTEGER) AS ordre FROM species""",
    "reference_species_favorites": f"""{W} SELECT nom AS species_nom, unnest(favorites) AS favorite_valeur,
            CAST(unnest(generate_series(1, len(favorites))) AS INTEGER) AS ordre FROM species""",
    "reference_favorite_themes": _FAV,
    "reference_theme_items": f"{W} {_ITEMS_OF_THEME}",
    "reference_favorites_matrix": f"""{W}, likes AS (SELECT nom, unnest(favorites) AS favorite, CAST(unnest(generate_series(1, len(favorites))) AS INTEGER) AS ordre FROM species)
        SELECT nom AS species_nom, ordre, favorite AS favorite_valeur, m.theme, relaxation, decoration, tot
        FROM likes LEFT JOIN ({_FAV}) m ON m.label = favorite LEFT JOIN ({W} {_ITEMS_OF_THEME}) t ON t.theme = m.theme""",
    "reference_detail_records": f"""{W} SELECT num AS page_id, CASE WHEN ok THEN nom END AS name, CASE WHEN ok THEN printf('%03d', num) END AS num,
        CASE WHEN ok THEN CASE WHEN bare THEN '' ELSE array_to_string(list_transform(list_filter(list_transform(specialties, lambda x, i: [x, CASE WHEN list_position(specialties, x) = i THEN '1' ELSE '' END]), lambda x: x[2] = '1'), lambda x: x[1]), '|') END END AS specialties,
        CASE WHEN ok AND NOT bare AND ideal_habitat <> '' THEN ideal_habitat END AS ideal_habitat,
        CASE WHEN ok THEN CASE WHEN bare THEN '' ELSE array_to_string(favorites, '|') END END AS favorites,
        CASE WHEN num % 47 = 0 THEN 'no page' WHEN num % 41 = 0 THEN 'unexpected heading' END AS problem
        FROM (SELECT *, num % 47 <> 0 AND num % 41 <> 0 AS ok, num % 43 = 0 AS bare FROM species)""",
    "reference_list_slugs": f"""{W} SELECT num // 50 AS page_id, coalesce(string_agg('s' || CAST(num AS VARCHAR), '|' ORDER BY num) FILTER (num % 6 <> 0), '') AS slugs, CAST(NULL AS VARCHAR) AS problem
        FROM species GROUP BY num // 50""",
    "pages_records": r"""WITH p AS (SELECT page_id, regexp_replace(regexp_replace(coalesce(html, ''), '(?s)<script>.*?</script>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS h FROM pages),
        x AS (SELECT *, regexp_extract(h, '(?s)<nav>.*?</nav>') AS nav FROM p)
        SELECT page_id, nullif(regexp_extract(h, '<html lang="([^"]*)"', 1), '') AS lang, """ + _text("nullif(regexp_extract(h, '<title>([^<]*)</title>', 1), '')") + r""" AS title,
            """ + _text("array_to_string(regexp_extract_all(h, '(?s)<h[123][^>]*>([^<]*)</h[123]>', 1), '|')") + r""" AS headings,
            """ + _text('''array_to_string(regexp_extract_all(nav, '<a href="([^"]*)"', 1), '|')''') + r""" AS nav_hrefs,
            """ + _text('''array_to_string(regexp_extract_all(nav, '<a href="[^"]*">([^<]*)</a>', 1), '|')''') + r""" AS nav_labels FROM x""",
    "sales_silver": f"WITH {SALES} SELECT * FROM sales_silver",
    "sales_daily_kpis": f"""WITH {SALES} SELECT event_date, region, CAST(count(*) AS BIGINT) AS nb_lignes,
            CAST(sum(quantity) AS BIGINT) AS total_quantity,
            {_rr("sum(CAST(quantity AS BIGINT) * CAST(round(unit_price * 100) AS BIGINT))", "100", 2)} AS total_revenue,
            {_rr("sum(CAST(round(unit_price * 100) AS BIGINT))", "count(*) * 100", 2)} AS avg_unit_price
        FROM sales_silver GROUP BY event_date, region""",
}
