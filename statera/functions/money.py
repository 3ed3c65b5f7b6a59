"""Exact money arithmetic (decimals only, never double)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output type of every money / rate column: wide enough for sums, scale 6 keeps
# amount (scale 2) x rate (scale 4) products exact.
MONEY = T.DecimalType(38, 6)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nvl(c: Column | str, default) -> Column:
    return F.coalesce(_col(c), default if isinstance(default, Column) else F.lit(default))


def exact(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def signed_balance(dr: Column | str, cr: Column | str) -> Column:
    """Liability balance from debit and credit: ``(nvl(dr,0) - nvl(cr,0)) * -1``."""
    return (nvl(dr, 0) - nvl(cr, 0)) * F.lit(-1)


def nonzero_open_amount(amount: Column | str, rate: Column | str) -> Column:
    """Open-item test ``nvl(amount,0) * nvl(rate,1) != 0`` (exact decimal compare)."""
    return (nvl(amount, 0) * nvl(rate, 1)) != 0
