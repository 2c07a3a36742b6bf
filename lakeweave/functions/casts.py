"""Lenient and strict casts, rounding and date helpers (one place for engine semantics).

ANSI mode stays on: a plain ``cast`` raises on bad input (the strict contract),
the ``try_*`` helpers give NULL (the lenient contract used by raw layers).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


_NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def try_double(col) -> Column:
    """A plain decimal number, else NULL: ``NaN``, ``3d`` and ``inf`` are no numbers here."""
    c = _c(col)
    return F.when(c.cast("string").rlike(_NUMBER), c.try_cast("double"))


def try_long(col) -> Column:
    return _c(col).try_cast("bigint")


def try_int(col) -> Column:
    return _c(col).try_cast("int")


def try_timestamp(col, fmt: str | None = None) -> Column:
    c = _c(col)
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    return F.try_to_timestamp(c, F.lit(fmt))


def round_even(col, scale: int = 0) -> Column:
    """Half-to-even rounding (ClickHouse / Python float semantics)."""
    return F.bround(_c(col), scale)


def round_half_up(col, scale: int = 0) -> Column:
    """Half-away-from-zero rounding (PostgreSQL numeric semantics)."""
    return F.round(_c(col), scale)


def safe_div(num, den) -> Column:
    """x / nullif(y, 0): NULL instead of an ANSI divide-by-zero error."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def days_between_floor(later, earlier) -> Column:
    """Whole days of a timedelta (floor), like ``(a - b).days`` in pandas."""
    micros = (F.unix_micros(_c(later).cast("timestamp"))
              - F.unix_micros(_c(earlier).cast("timestamp")))
    return F.floor(micros / F.lit(86_400_000_000)).cast("int")


def week_ending_monday(date_col) -> Column:
    """Label of a pandas ``W-MON`` bucket: the Monday closing the week."""
    return F.next_day(F.date_sub(_c(date_col), 1), "Mon")
