"""Date expressions with the reference's day-level semantics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date(v: dt.date | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def day(c: Column | str) -> Column:
    """Drop the time of day (Oracle ``TRUNC(d)``). ``F.trunc(c, 'DD')`` would give NULL."""
    return F.to_date(_col(c))


def days_outstanding(as_on: dt.date | Column, c: Column | str) -> Column:
    """Whole days from ``c`` to the as-on day: ``CEIL(TRUNC(as_on) - c)``.

    For a day ``n`` days back at time of day ``f`` (0 <= f < 1) the ceiling of ``n - f``
    is ``n``, which is exactly the day difference of the two calendar days.
    """
    return F.datediff(day(_date(as_on)), _col(c))


def day_between(c: Column | str, lo: dt.date | Column, hi: dt.date | Column) -> Column:
    """Inclusive day-level period test (both sides truncated)."""
    return day(c).between(_date(lo), _date(hi))


def date_text(c: Column | str, mask: str = "yyyy-MM-dd") -> Column:
    """``TO_CHAR(d, mask)`` for masks ``YYYY-MM-DD`` / ``DD-MM-YYYY`` (Spark patterns)."""
    return F.date_format(_col(c), mask)
