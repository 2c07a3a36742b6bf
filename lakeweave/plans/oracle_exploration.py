"""DuckDB oracles of the first look at raw tables: one SELECT per column."""

from .sql_fixtures import RETAIL_LINES

W = "WITH " + RETAIL_LINES
RAW = ("invoice", "stock_code", "description", "quantity", "invoice_date", "price", "customer_id", "country")
LINEITEM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
NUMERIC = LINEITEM[:8]


def _each(columns, select):
    return " UNION ALL ".join(select(c) for c in columns)


def _described(c, table):
    x = f"CAST({c} AS DOUBLE)"
    return f"""count({c}) AS count, round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std, min({x}) AS min,
        quantile_cont({x}, 0.25) AS q25, quantile_cont({x}, 0.5) AS q50, quantile_cont({x}, 0.75) AS q75, max({x}) AS max FROM {table}"""


def _distinct_per(key, value, name):
    return f"""{W} SELECT {key}, CAST(count(DISTINCT {value}) AS BIGINT) AS {name} FROM retail_lines WHERE {key} IS NOT NULL AND {value} IS NOT NULL
        GROUP BY {key} ORDER BY {name} DESC, {key} LIMIT 10"""


_NONE = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in (("count", "BIGINT"), *((c, "DOUBLE") for c in ("mean", "std", "min", "q25", "q50", "q75", "max"))))


def _profiled(c):
    seen = f"""'{c}' AS column_name, count(*) AS rows, CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS missing, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values,
        round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 2) AS missing_pct, {LINEITEM.index(c) + 1} AS position"""
    return f"SELECT {seen}, {_described(c, 'lineitem')}" if c in NUMERIC else f"SELECT {seen}, {_NONE} FROM lineitem"


ORACLES = {
    "retail_profile": f"{W} " + _each(RAW, lambda c: f"SELECT '{c}' AS column_name, count(*) AS rows, CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS nulls, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values FROM retail_lines"),
    "retail_missing_values": f"{W} SELECT * FROM (" + _each(RAW, lambda c: f"""SELECT '{c}' AS column_name, CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS missing,
        floor((count(*) FILTER ({c} IS NULL) * 20000 + count(*)) / (2 * count(*))) / 100.0 AS missing_pct FROM retail_lines""") + ") WHERE missing > 0",
    "retail_duplicates": f"{W} SELECT (SELECT count(*) FROM retail_lines) AS rows, count(*) AS unique_rows, (SELECT count(*) FROM retail_lines) - count(*) AS duplicate_rows FROM (SELECT DISTINCT * FROM retail_lines)",
    "retail_cardinalities": f"{W} " + _each(RAW, lambda c: f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values FROM retail_lines"),
    "retail_top_values": f"{W}, seen AS (" + _each(RAW, lambda c: f"SELECT '{c}' AS column_name, {c} AS value, CAST(count(*) AS BIGINT) AS n FROM retail_lines WHERE {c} IS NOT NULL GROUP BY {c}") + """)
        SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INTEGER) AS rank FROM seen) WHERE rank <= 10""",
    "retail_describe": f"""{W}, numbers AS (SELECT TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(price AS DOUBLE) AS price FROM retail_lines),
        typed AS (SELECT *, quantity * price AS total_line FROM numbers) """ + _each(("quantity", "price", "total_line"), lambda c: f"SELECT '{c}' AS column_name, {_described(c, 'typed')}"),
    "retail_descriptions_per_product": _distinct_per("stock_code", "description", "descriptions"),
    "retail_countries_per_customer": _distinct_per("customer_id", "country", "countries"),
    "retail_invoices_per_country": _distinct_per("country", "invoice", "invoices"),
    "retail_customers_per_country": _distinct_per("country", "customer_id", "customers"),
    "lineitem_profile": _each(LINEITEM, _profiled),
}
