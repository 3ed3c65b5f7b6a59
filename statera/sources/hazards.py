"""Variants of relations that reach rules which the derived relations don't: days with a time of day, suppliers without a
name or number, days with several rates. Each is a rule over the ids of the rows, so that it grows with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import FinanceTables

TIMED = {"ap_invoices_all": ("invoice_id", "invoice_date"), "iby_payments_all": ("payment_id", "payment_date"),
         "ra_customer_trx_all": ("customer_trx_id", "trx_date"), "ar_cash_receipts_all": ("cash_receipt_id", "receipt_date")}
DUPLICATED_DAY = 17  # of each month


def _at_hour(day: str, key: str) -> Column:
    """A day at the hour that its row's id has modulo 24."""
    return F.col(day).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col(key) % 24).cast("int"))


def times_of_day(t: FinanceTables) -> FinanceTables:
    """Documents dated to the hour; every tenth supplier has no name, another tenth no number."""
    timed = {name: t.table(name).withColumn(day, _at_hour(day, key)) for name, (key, day) in TIMED.items()}
    suppliers = t.poz_suppliers_v
    for column, last_digit in (("vendor_name", 3), ("segment1", 7)):
        suppliers = suppliers.withColumn(column, F.when(F.col("vendor_id") % 10 != last_digit, F.col(column)))
    return t.with_overrides(**timed, poz_suppliers_v=suppliers.select(*t.poz_suppliers_v.columns))


def duplicate_rates(t: FinanceTables) -> FinanceTables:
    """On one day of each month every currency has a second, higher rate, and the functional currency has two to itself."""
    rates = t.gl_daily_rates
    twice = rates.filter(F.dayofmonth("conversion_date") == DUPLICATED_DAY)
    higher = twice.withColumn("conversion_rate", (F.col("conversion_rate") + 1).cast("decimal(10,4)"))

    def own(rate: int) -> DataFrame:
        return twice.select("conversion_date").distinct().select(
            "conversion_date", F.lit("KES").alias("from_currency"), F.lit("KES").alias("to_currency"),
            F.lit(rate).cast("decimal(10,4)").alias("conversion_rate"))
    return t.with_overrides(gl_daily_rates=rates.unionByName(higher).unionByName(own(1)).unionByName(own(2)))
