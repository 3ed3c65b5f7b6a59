"""Conversion to the functional currency with daily rates.

The reference fetches the rate with a correlated scalar subquery per amount (up to
three per row). Here the rates are aggregated once per (from currency, day) - the
smallest rate and the number of rates - and joined once per document currency and
day. The rate table is bounded by currencies x calendar days; it is broadcast while
its estimated size is under the threshold and shuffled beyond it (AQE splits a hot
currency-day on the document side).

Two lookup modes: *strict* (a scalar subquery that must return at most one row -
more than one rate raises, but only where the rate is actually used) and *any* (the
``rownum = 1`` form: any one of the rates; we take the smallest so results are
deterministic).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day
from ..params import FxConfig
from ..sources.tables import FinanceTables
from .joins import broadcast_if_small


def rate_table(t: FinanceTables, fx: FxConfig) -> DataFrame:
    """(from_currency, conversion_date) -> smallest rate and number of rates, to the
    functional currency; built once per tables object and size-checked for broadcast."""
    def build() -> DataFrame:
        r = t.gl_daily_rates.filter(F.col("to_currency") == F.lit(fx.functional_currency))
        return broadcast_if_small(r.groupBy("from_currency", "conversion_date").agg(
            F.min("conversion_rate").alias("rate_any"), F.count(F.lit(1)).alias("rate_count")))
    return t.derived(("rates", fx.functional_currency), build)


def with_rate(df: DataFrame, rates: DataFrame, currency: str, doc_date: str, prefix: str) -> DataFrame:
    """Left-join the rate of ``currency`` on the day of ``doc_date``; adds
    ``<prefix>_rate_any`` and ``<prefix>_rate_count``. ``rates`` comes from
    :func:`rate_table` (already size-checked for broadcast)."""
    r = rates.select(
        F.col("from_currency").alias(f"{prefix}_from"), F.col("conversion_date").alias(f"{prefix}_day"),
        F.col("rate_any").alias(f"{prefix}_rate_any"), F.col("rate_count").alias(f"{prefix}_rate_count"))
    cond = (F.col(currency) == F.col(f"{prefix}_from")) & (day(doc_date) == F.col(f"{prefix}_day"))
    return df.join(r, cond, "left").drop(f"{prefix}_from", f"{prefix}_day")


def rate(prefix: str, mode: str) -> Column:
    """The looked-up rate; in strict mode a duplicated rate raises when evaluated."""
    any_rate = F.col(f"{prefix}_rate_any")
    if mode == "any":
        return any_rate
    msg = F.lit(f"more than one conversion rate for one currency and day ({prefix})")
    return F.when(F.col(f"{prefix}_rate_count") > 1, F.raise_error(msg)).otherwise(any_rate)


def exchange_rate(currency: str, prefix: str, fx: FxConfig, mode: str | None = None) -> Column:
    """Shown rate: NULL for the functional currency, else the day's rate."""
    return F.when(F.col(currency) == F.lit(fx.functional_currency), F.lit(None)) \
        .otherwise(rate(prefix, mode or fx.mode))


def to_functional(amount: Column | str, currency: str, prefix: str, fx: FxConfig,
                  mode: str | None = None) -> Column:
    """The amount as is in the functional currency, else amount x rate (NULL without rate)."""
    a = F.col(amount) if isinstance(amount, str) else amount
    return F.when(F.col(currency) == F.lit(fx.functional_currency), a) \
        .otherwise(a * rate(prefix, mode or fx.mode))


def applied_to_functional(amount: str, receipt_currency: str, invoice_currency: str, prefix: str,
                          fx: FxConfig, mode: str | None = None) -> Column:
    """Applied amount, three ways, no ELSE (NULL when no case holds):
    receipt in functional currency -> as is; receipt foreign, invoice functional -> as is;
    both foreign -> x the receipt-day rate of the receipt currency."""
    f = F.lit(fx.functional_currency)
    rc, ic, a = F.col(receipt_currency), F.col(invoice_currency), F.col(amount)
    return (F.when(rc == f, a)
            .when((ic == f) & (rc != f), a)
            .when((ic != f) & (rc != f), a * rate(prefix, mode or fx.mode)))
