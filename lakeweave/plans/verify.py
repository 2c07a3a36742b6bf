"""Order-insensitive comparison of a Spark result with a DuckDB oracle result.

Used by the test-suite and ``tools/compare.py``: columns compared by name,
rows as sorted tuples, floats to 6 decimals, NULL/NaN/NaT unified.
"""

from __future__ import annotations

import datetime
import math

import pandas as pd

from ..sources.tables import DRIVER_TABLES, table_path


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_of(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in rec) for rec in df[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> str | None:
    """None when equal, else a short description of the first difference."""
    sc, sr = rows_of(spark_pdf)
    oc, orr = rows_of(oracle_pdf)
    if sc != oc:
        return f"columns differ: spark={sc} oracle={oc}"
    if len(sr) != len(orr):
        return f"row counts differ: spark={len(sr)} oracle={len(orr)}"
    for a, b in zip(sr, orr):
        if a != b:
            return f"first differing row: spark={a} oracle={b}"
    return None
