"""Supplier account statement: invoices and payments as one ledger with a running balance.

Steps: invoice rows and payment rows of the period (with TAX and AWT totals), a
distinct union of both (equal rows collapse, also within a branch), a row number
over the date order, the opening balance added on the first row, and a running
total. The single-supplier statement numbers all rows in one sequence (as the
reference does); ``supplier_statement_by_vendor`` restarts numbering and balance
per vendor so that every supplier's statement comes out of one run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_text, day_between, exact, nvl
from ..params import APPROVED_STATUS, VOID_PAYMENT_STATUS, WF_APPROVED_STATUS, StatementParams
from ..sources.tables import FinanceTables
from .balances import opening_balance
from .joins import broadcast_if_small, per_document, restrict_to
from .running import sequence_and_running_total

LEDGER_COLUMNS = ("rec_type", "vendor_id", "sup_name", "sup_num", "trx_num", "patient_name", "trx_date",
                  "trx_cur", "trx_amt", "trx_unpaid", "trx_deduction", "trx_wht", "p_from_date", "p_to_date")
MONEY_COLUMNS = ("trx_amt", "trx_unpaid", "trx_deduction", "trx_wht")


def _suppliers(t: FinanceTables, p: StatementParams) -> DataFrame:
    parties = t.hz_parties
    if p.supplier is not None:
        parties = parties.filter(F.col("party_name") == F.lit(p.supplier))
    sup = t.poz_suppliers.select("vendor_id", "segment1", "party_id").join(
        broadcast_if_small(parties.select("party_id", "party_name")), "party_id")
    return broadcast_if_small(sup.select("vendor_id", "segment1", "party_name"))


def invoice_tax_total(t: FinanceTables, invoices: DataFrame | None = None) -> DataFrame:
    """Per invoice ``SUM(NVL(amount, 0))`` of its TAX lines."""
    def total(t: FinanceTables) -> DataFrame:
        lines = t.ap_invoice_lines_all.filter(F.col("line_type_lookup_code") == "TAX")
        if invoices is not None:
            lines = restrict_to(lines, invoices, "invoice_id")
        return lines.groupBy("invoice_id").agg(F.sum(nvl("amount", 0)).alias("tax_total"))
    return per_document(t, ["ap_invoice_lines_all"], "invoice_id", total)


def payment_wht_total(t: FinanceTables, checks: DataFrame | None = None) -> DataFrame:
    """Per check the AWT line amounts of every invoice the check pays; an invoice
    paid twice by the same check counts twice."""
    if checks is None:
        pays = t.ap_invoice_payments_all.select("invoice_id", "check_id")
    else:
        pays = t.by("ap_invoice_payments_all", "check_id").select("invoice_id", "check_id")
        pays = restrict_to(pays, checks, "check_id")
    awt = t.ap_invoice_lines_all.filter(F.col("line_type_lookup_code") == "AWT").select("invoice_id", "amount")
    return awt.join(pays, "invoice_id").groupBy("check_id").agg(F.sum("amount").alias("wht_total"))


def _period_params(p: StatementParams) -> list:
    return [F.lit(p.from_date).alias("p_from_date"), F.lit(p.to_date).alias("p_to_date")]


def statement_invoice_rows(t: FinanceTables, p: StatementParams) -> DataFrame:
    inv = (t.in_months("ap_invoices_all", p.from_date, p.to_date)
           .filter(F.col("approval_status").isin(*APPROVED_STATUS)
                   & F.col("wfapproval_status").isin(*WF_APPROVED_STATUS)
                   & day_between("invoice_date", p.from_date, p.to_date))
           .select("invoice_id", "vendor_id", "invoice_num", "description", "invoice_date",
                   "invoice_currency_code", "invoice_amount")
           .join(_suppliers(t, p), "vendor_id"))
    scope = inv if p.supplier is not None else None
    j = (inv.join(t.ap_payment_schedules_all.select("invoice_id", "amount_remaining"), "invoice_id")
         .join(invoice_tax_total(t, scope), "invoice_id", "left"))
    return j.select(
        F.lit("Invoice").alias("rec_type"), "vendor_id", F.col("party_name").alias("sup_name"),
        F.col("segment1").alias("sup_num"), F.col("invoice_num").cast("string").alias("trx_num"),
        F.col("description").alias("patient_name"), F.col("invoice_date").alias("trx_date"),
        F.col("invoice_currency_code").alias("trx_cur"), exact("invoice_amount").alias("trx_amt"),
        exact("amount_remaining").alias("trx_unpaid"), exact("tax_total").alias("trx_deduction"),
        exact(F.lit(0)).alias("trx_wht"), *_period_params(p))


def statement_payment_rows(t: FinanceTables, p: StatementParams) -> DataFrame:
    pays = (t.in_months("iby_payments_all", p.from_date, p.to_date)
            .filter(~F.col("payment_status").isin(*VOID_PAYMENT_STATUS)
                    & day_between("payment_date", p.from_date, p.to_date))
            .select("payment_id", "payment_reference_number", "payment_date", "payment_amount"))
    checks = (t.ap_checks_all.select("check_id", "payment_id", "vendor_id", "currency_code")
              .join(_suppliers(t, p), "vendor_id")
              .join(pays, "payment_id"))
    scope = checks if p.supplier is not None else None
    j = checks.join(payment_wht_total(t, scope), "check_id", "left")
    return j.select(
        F.lit("Payment").alias("rec_type"), "vendor_id", F.col("party_name").alias("sup_name"),
        F.col("segment1").alias("sup_num"), F.col("payment_reference_number").cast("string").alias("trx_num"),
        F.lit(None).cast("string").alias("patient_name"), F.col("payment_date").alias("trx_date"),
        F.col("currency_code").alias("trx_cur"), exact(F.col("payment_amount") * F.lit(-1)).alias("trx_amt"),
        exact(F.lit(0)).alias("trx_unpaid"), exact(F.lit(0)).alias("trx_deduction"),
        exact(nvl("wht_total", 0)).alias("trx_wht"), *_period_params(p))


def ledger_union(t: FinanceTables, p: StatementParams) -> DataFrame:
    """Distinct union of invoice and payment rows (positional, as SQL UNION)."""
    return statement_invoice_rows(t, p).union(statement_payment_rows(t, p)).distinct()


def ledger_order():
    """Date order, then a fixed tie-break over every column (rows are unique after the
    distinct union, so this is a total order)."""
    rest = ["rec_type", "trx_num", "vendor_id", "sup_name", "sup_num", "patient_name", "trx_cur", *MONEY_COLUMNS]
    return [F.col("trx_date").asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in rest]


def _numbered(t: FinanceTables, p: StatementParams, by_vendor: bool) -> DataFrame:
    led = ledger_union(t, p)
    opening = opening_balance(t, p)
    led = led.join(opening, "vendor_id", "left").select(
        *LEDGER_COLUMNS, exact(nvl("opening_balance", 0)).alias("opening_balance"),
        (nvl("trx_amt", 0) + nvl("trx_wht", 0)).alias("movement"))
    return sequence_and_running_total(
        led, ledger_order(), "movement", partition_by=["vendor_id"] if by_vendor else [],
        seed="opening_balance", row_id="row_id", running="totals", ordered=True)


def statement_row_ids(t: FinanceTables, p: StatementParams) -> DataFrame:
    """Ledger rows with their sequence number (one sequence over all rows)."""
    s = sequence_and_running_total(ledger_union(t, p), ledger_order())
    return s.select("row_id", *LEDGER_COLUMNS)


def _statement_projection(s: DataFrame) -> DataFrame:
    return s.select(
        "row_id", "vendor_id", "rec_type", "sup_name", "sup_num", "trx_num", "patient_name",
        date_text("trx_date", "dd-MM-yyyy").alias("trx_date"), "trx_cur",
        *[exact(nvl(c, 0)).alias(c) for c in ("trx_amt", "trx_unpaid", "trx_deduction", "trx_wht")],
        "p_from_date", "p_to_date", "opening_balance", exact("totals").alias("totals"))


def supplier_statement(t: FinanceTables, p: StatementParams) -> DataFrame:
    """R3 as the reference computes it for one supplier name: one row sequence over the
    whole ledger, the first row's vendor opening balance seeds the running total. In date order."""
    return _statement_projection(_numbered(t, p, by_vendor=False))


def supplier_statement_by_vendor(t: FinanceTables, p: StatementParams) -> DataFrame:
    """R3 for all suppliers at once (``p.supplier`` may be None): numbering and running
    balance restart per vendor, each seeded with that vendor's opening balance. By vendor, in date order."""
    return _statement_projection(_numbered(t, p, by_vendor=True))
