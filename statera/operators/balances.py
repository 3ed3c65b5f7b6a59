"""Supplier opening balance at a date and its per-invoice building blocks.

All per-invoice aggregates are ``groupBy(invoice_id)`` with partial (map-side)
aggregation, computed once and left-joined - the decorrelated form of the
reference's correlated subqueries. When the statement is for one supplier and the
facts are large, the inputs are first cut to that supplier's invoices with a semi
join (``joins.restrict_to``: size-checked build side), so the aggregates never
shuffle the whole payment history of every supplier.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nvl
from ..params import INVOICE_TYPE_LOOKUP, StatementParams
from ..sources.tables import FinanceTables
from .joins import broadcast_if_small, restrict_to


def _restrict(df: DataFrame, keys: DataFrame | None, on: str) -> DataFrame:
    return df if keys is None else restrict_to(df, keys, on)


def paid_to_date(t: FinanceTables, cutoff: dt.date | Column, invoices: DataFrame | None = None) -> DataFrame:
    """A2: per invoice ``SUM(amount + NVL(discount_taken, 0))`` of payments accounted up
    to ``cutoff``; a payment with NULL amount contributes NULL, which SUM skips."""
    cut = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    p = t.ap_invoice_payments_all.filter(F.col("accounting_date") <= cut)
    p = _restrict(p, invoices, "invoice_id")
    return p.groupBy("invoice_id").agg(
        F.sum(F.col("amount") + nvl("discount_taken", 0)).alias("invoice_amt_paid"))


def distributed_to_date(t: FinanceTables, cutoff: dt.date | Column, invoices: DataFrame | None = None) -> DataFrame:
    """A3: per invoice sum of distribution amounts accounted up to ``cutoff``."""
    cut = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    d = t.ap_invoice_distributions_all.filter(F.col("accounting_date") <= cut)
    d = _restrict(d, invoices, "invoice_id")
    return d.groupBy("invoice_id").agg(F.sum("amount").alias("distributed_amount"))


def opening_invoice_rows(t: FinanceTables, p: StatementParams) -> DataFrame:
    """Invoices dated before the period with their net open amount (one row per
    installment, so the net repeats per installment as in the reference)."""
    cutoff = F.date_sub(F.lit(p.from_date), 1)
    vendors = t.poz_suppliers_v
    if p.supplier is not None:
        vendors = vendors.filter(F.col("vendor_name") == F.lit(p.supplier))
    vendors = broadcast_if_small(vendors.select("vendor_id"))
    inv = (t.in_months("ap_invoices_all", None, p.from_date - dt.timedelta(days=1))
           .filter(F.col("cancelled_date").isNull() & (F.col("invoice_date") <= cutoff))
           .select("invoice_id", "vendor_id", "invoice_type_lookup_code", "terms_id", "invoice_amount")
           .join(vendors, "vendor_id"))
    scope = inv if p.supplier is not None else None
    lookup = broadcast_if_small(
        t.ap_lookup_codes.filter(F.col("lookup_type") == INVOICE_TYPE_LOOKUP)
        .select(F.col("lookup_code").alias("invoice_type_lookup_code")))
    terms = broadcast_if_small(t.ap_terms_val_v.select("term_id"))
    j = (inv.join(t.ap_payment_schedules_all.select("invoice_id"), "invoice_id")
         .join(lookup, "invoice_type_lookup_code", "left")
         .join(terms, F.col("terms_id") == F.col("term_id"), "left")
         .join(paid_to_date(t, cutoff, scope), "invoice_id", "left")
         .join(distributed_to_date(t, cutoff, scope), "invoice_id", "left"))
    net = nvl("distributed_amount", F.col("invoice_amount")) - nvl("invoice_amt_paid", 0)
    return j.select("invoice_id", "vendor_id", net.alias("net_amount")).filter(F.col("net_amount") != 0)


def opening_balance(t: FinanceTables, p: StatementParams) -> DataFrame:
    """Opening balance per vendor the day before the period starts."""
    rows = opening_invoice_rows(t, p)
    return rows.groupBy("vendor_id").agg(nvl(F.sum("net_amount"), 0).alias("opening_balance"))
