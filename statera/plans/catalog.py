"""Query catalog: every operator and report as ``(spark, sf_dir) -> DataFrame``.

Each entry reads the driver tables of ``sf_dir`` through the derived finance
relations and runs over the whole of them; the matching DuckDB query is in
``statera.plans.oracle`` under the same name, with the same column names and types.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (date_display, date_text, day_between, days_outstanding, exact, flexfield,
                         flexfield_or_sentinel, money_text, nonzero_open_amount, nvl, optional_match, receipt_class,
                         signed_balance)
from ..operators import aging, balances, fx, ledger, patient
from ..operators.joins import broadcast_if_small
from ..params import (APPROVED_STATUS, DEFAULT_BUCKETS, G1, G2, INVOICE_TYPE_LOOKUP, VOID_PAYMENT_STATUS,
                      WF_APPROVED_STATUS, AgingParams, FxConfig, PatientParams, SiteCodes, StatementParams)
from ..sources import derive_tables
from ..sources.hazards import DUPLICATED_DAY, duplicate_rates, times_of_day
from ..sources.tables import FinanceTables
from ..sources.sink import with_position
from . import reports

# Fixed test parameters (FIXTURES.md §1.4).
AS_ON = dt.date(1998, 6, 30)
AGING = AgingParams(as_on=AS_ON)
PERIOD = (dt.date(1998, 1, 1), dt.date(1998, 6, 30))
SUPPLIER = "Supplier#000000007"
STATEMENT = StatementParams(PERIOD[0], PERIOD[1], SUPPLIER)
ALL_SUPPLIERS = StatementParams(PERIOD[0], PERIOD[1], None)
PATIENT = "P7"
PATIENT_G1 = PatientParams(dt.date(1995, 1, 1), dt.date(2001, 12, 31), PATIENT, party_name="Customer#000000007",
                           options=G1)
PATIENT_G2 = PatientParams(PERIOD[0], PERIOD[1], PATIENT, options=G2)
ALL_PATIENTS_G2 = PatientParams(PERIOD[0], PERIOD[1], None, options=G2)
FX = FxConfig()

QueryFn = Callable[[SparkSession, str], DataFrame]
TableQueryFn = Callable[[FinanceTables], DataFrame]
QUERIES: dict[str, QueryFn] = {}
TABLE_QUERIES: dict[str, TableQueryFn] = {}


def register(name: str):
    """Register ``fn(tables)``; ``QUERIES[name](spark, sf_dir)`` runs it on the relations
    derived from the driver tables in ``sf_dir``."""
    def deco(fn: TableQueryFn) -> TableQueryFn:
        TABLE_QUERIES[name] = fn
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(derive_tables(spark, sf_dir))
        return fn
    return deco


# ---- AP aging --------------------------------------------------------------------------------

@register("nvl_defaults")
def q_nvl_defaults(t: FinanceTables) -> DataFrame:
    return t.ap_invoice_payments_all.select(
        "invoice_id", "check_id", "accounting_date", exact(nvl("discount_taken", 0)).alias("discount_taken"),
        exact(F.col("amount") + nvl("discount_taken", 0)).alias("paid_amount"))


@register("signed_balance")
def q_signed_balance(t: FinanceTables) -> DataFrame:
    return t.ap_trial_balances.select(
        "invoice_id", "vendor_id", exact(signed_balance("accounted_dr", "accounted_cr")).alias("amt_due_remaining"))


@register("days_outstanding")
def q_days_outstanding(t: FinanceTables) -> DataFrame:
    return t.ap_invoices_all.select(
        "invoice_id", "invoice_date", days_outstanding(AS_ON, "invoice_date").cast("bigint").alias("past_due_days"))


@register("aging_buckets")
def q_aging_buckets(t: FinanceTables) -> DataFrame:
    inv = t.ap_invoices_all.filter(F.col("invoice_date") < F.lit(AS_ON)).select(
        "invoice_id", "vendor_id", "invoice_date")
    rows = aging.with_trial_balance(inv, t).select(
        "invoice_id", days_outstanding(AS_ON, "invoice_date").cast("bigint").alias("past_due_days"),
        exact(signed_balance("accounted_dr", "accounted_cr")).alias("amt_due_remaining"))
    b = aging.aging_buckets(rows)
    return b.select("invoice_id", "past_due_days", "amt_due_remaining",
                    *[exact(x.name).alias(x.name) for x in DEFAULT_BUCKETS])


@register("optional_param_filter")
def q_optional_param_filter(t: FinanceTables) -> DataFrame:
    v = t.poz_suppliers_v.filter(optional_match("vendor_name", None) & optional_match("segment1", None))
    return t.ap_invoices_all.select("invoice_id", "vendor_id").join(
        broadcast_if_small(v.select("vendor_id", "vendor_name", F.col("segment1").alias("supp_no"))), "vendor_id"
    ).select("invoice_id", "vendor_id", "vendor_name", "supp_no")


@register("nonzero_balance")
def q_nonzero_balance(t: FinanceTables) -> DataFrame:
    j = t.ap_invoices_all.select("invoice_id", "exchange_rate").join(
        t.ap_payment_schedules_all.select("invoice_id", "due_date", "amount_remaining"), "invoice_id")
    return j.filter(nonzero_open_amount("amount_remaining", "exchange_rate")).select(
        "invoice_id", "due_date", exact("amount_remaining").alias("amount_remaining"),
        exact("exchange_rate").alias("exchange_rate"))


@register("join_site_existence")
def q_join_site_existence(t: FinanceTables) -> DataFrame:
    sites = broadcast_if_small(t.poz_supplier_sites_all_m.select("vendor_site_id"))
    return t.ap_invoices_all.select("invoice_id", "vendor_site_id").join(sites, "vendor_site_id").select(
        "invoice_id", "vendor_site_id")


@register("join_lookup_valid")
def q_join_lookup_valid(t: FinanceTables) -> DataFrame:
    lookup = broadcast_if_small(t.ap_lookup_codes.filter(F.col("lookup_type") == INVOICE_TYPE_LOOKUP).select(
        F.col("lookup_code").alias("invoice_type")))
    return t.ap_invoices_all.select("invoice_id", F.col("invoice_type_lookup_code").alias("invoice_type")).join(
        lookup, "invoice_type").select("invoice_id", "invoice_type")


@register("join_left_terms")
def q_join_left_terms(t: FinanceTables) -> DataFrame:
    terms = broadcast_if_small(t.ap_terms_val_v.select("term_id", F.col("name").alias("payment_terms")))
    return t.ap_invoices_all.select("invoice_id", "terms_id").join(
        terms, F.col("terms_id") == F.col("term_id"), "left").select("invoice_id", "terms_id", "payment_terms")


@register("ap_aging_detail")
def q_ap_aging_detail(t: FinanceTables) -> DataFrame:
    return reports.aging_detail(t, AGING)


@register("ap_aging_summary")
def q_ap_aging_summary(t: FinanceTables) -> DataFrame:
    return reports.aging_summary(t, AGING)


@register("ap_aging_detail_subtotals")
def q_ap_aging_detail_subtotals(t: FinanceTables) -> DataFrame:
    return reports.aging_detail_with_subtotals(t, AGING)


@register("ap_aging_detail_grand_total")
def q_ap_aging_detail_grand_total(t: FinanceTables) -> DataFrame:
    return reports.aging_detail_with_grand_total(t, AGING)


@register("ap_aging_summary_grand_total")
def q_ap_aging_summary_grand_total(t: FinanceTables) -> DataFrame:
    return reports.aging_summary_with_grand_total(t, AGING)


@register("statement_display")
def q_statement_display(t: FinanceTables) -> DataFrame:
    d = reports.aging_detail(t, AGING)
    return d.select(
        "vendor_name", "supp_no", "invoice_num", "invoice_type",
        date_display("_p_as_on_date", "yyyy-MM-dd").alias("as_on_text"),
        date_display("invoice_date", "d-MMM-yy").alias("invoice_date_text"),
        *[money_text(c).alias(f"{c}_text") for c in reports.DETAIL_MEASURES])


# ---- supplier statement ----------------------------------------------------------------------

@register("date_text")
def q_date_text(t: FinanceTables) -> DataFrame:
    return t.ra_customer_trx_all.select(
        "customer_trx_id", date_text("trx_date", "yyyy-MM-dd").alias("iso_date"),
        date_text("trx_date", "dd-MM-yyyy").alias("dmy_date"))


@register("status_in_list")
def q_status_in_list(t: FinanceTables) -> DataFrame:
    return t.ap_invoices_all.filter(
        F.col("approval_status").isin(*APPROVED_STATUS) & F.col("wfapproval_status").isin(*WF_APPROVED_STATUS)
    ).select("invoice_id", "approval_status", "wfapproval_status")


@register("status_not_in_list")
def q_status_not_in_list(t: FinanceTables) -> DataFrame:
    return t.iby_payments_all.filter(~F.col("payment_status").isin(*VOID_PAYMENT_STATUS)).select(
        "payment_id", "payment_status")


@register("period_filter_day")
def q_period_filter_day(t: FinanceTables) -> DataFrame:
    return t.ap_invoices_all.filter(day_between("invoice_date", PERIOD[0], PERIOD[1])).select(
        "invoice_id", "invoice_date")


@register("invoice_paid_to_date")
def q_invoice_paid_to_date(t: FinanceTables) -> DataFrame:
    p = balances.paid_to_date(t, F.date_sub(F.lit(PERIOD[0]), 1))
    return p.select("invoice_id", exact("invoice_amt_paid").alias("invoice_amt_paid"))


@register("invoice_distributed_to_date")
def q_invoice_distributed_to_date(t: FinanceTables) -> DataFrame:
    d = balances.distributed_to_date(t, F.date_sub(F.lit(PERIOD[0]), 1))
    return d.select("invoice_id", exact("distributed_amount").alias("distributed_amount"))


@register("join_left_const_pred")
def q_join_left_const_pred(t: FinanceTables) -> DataFrame:
    lookup = broadcast_if_small(t.ap_lookup_codes.filter(F.col("lookup_type") == INVOICE_TYPE_LOOKUP).select(
        "lookup_code"))
    return t.ap_invoices_all.select("invoice_id", "invoice_type_lookup_code").join(
        lookup, F.col("invoice_type_lookup_code") == F.col("lookup_code"), "left")


@register("ap_opening_balance")
def q_ap_opening_balance(t: FinanceTables) -> DataFrame:
    return balances.opening_balance(t, ALL_SUPPLIERS).select(
        "vendor_id", exact("opening_balance").alias("opening_balance"))


@register("invoice_tax_total")
def q_invoice_tax_total(t: FinanceTables) -> DataFrame:
    return ledger.invoice_tax_total(t).select("invoice_id", exact("tax_total").alias("tax_total"))


@register("payment_wht_total")
def q_payment_wht_total(t: FinanceTables) -> DataFrame:
    return ledger.payment_wht_total(t).select("check_id", exact("wht_total").alias("wht_total"))


@register("ap_ledger_union")
def q_ap_ledger_union(t: FinanceTables) -> DataFrame:
    return ledger.ledger_union(t, ALL_SUPPLIERS)


@register("statement_row_id")
def q_statement_row_id(t: FinanceTables) -> DataFrame:
    return ledger.statement_row_ids(t, ALL_SUPPLIERS)


@register("running_balance")
def q_running_balance(t: FinanceTables) -> DataFrame:
    return reports.supplier_account_statements(t, ALL_SUPPLIERS)


@register("supplier_statement")
def q_supplier_statement(t: FinanceTables) -> DataFrame:
    return reports.supplier_account_statement(t, STATEMENT)


# ---- patient statement -----------------------------------------------------------------------

@register("flexfield_extract")
def q_flexfield_extract(t: FinanceTables) -> DataFrame:
    return t.ra_customer_trx_all.select(
        "customer_trx_id", flexfield("attribute_category", "attribute1").alias("patient_id"),
        flexfield("attribute_category", "attribute2").alias("patient_name"),
        flexfield("attribute_category", "attribute12").alias("plan_name"))


@register("flexfield_filter")
def q_flexfield_filter(t: FinanceTables) -> DataFrame:
    return t.ra_customer_trx_all.filter(flexfield("attribute_category", "attribute1") == F.lit(PATIENT)).select(
        "customer_trx_id", "attribute_category", "attribute1")


@register("flexfield_filter_sentinel")
def q_flexfield_filter_sentinel(t: FinanceTables) -> DataFrame:
    return t.ra_customer_trx_all.filter(
        flexfield_or_sentinel("attribute_category", "attribute1") == F.lit("ZZZ")).select(
        "customer_trx_id", "attribute_category", "attribute1")


@register("receipt_classify")
def q_receipt_classify(t: FinanceTables) -> DataFrame:
    return t.ar_cash_receipts_all.select("cash_receipt_id", "receipt_number",
                                         receipt_class("receipt_number").alias("transaction_type"))


def _receipt_rates(t: FinanceTables, mode: str) -> DataFrame:
    r = t.ar_cash_receipts_all.select("cash_receipt_id", "currency_code", "receipt_date", "amount")
    r = fx.with_rate(r, fx.rate_table(t, FX), "currency_code", "receipt_date", "rct")
    return r.select("cash_receipt_id", "currency_code", "receipt_date",
                    exact(fx.exchange_rate("currency_code", "rct", FX, mode)).alias("exchange_rate"),
                    exact(fx.to_functional("amount", "currency_code", "rct", FX, mode)).alias("functional_amount"))


@register("fx_rate_lookup")
def q_fx_rate_lookup(t: FinanceTables) -> DataFrame:
    return _receipt_rates(t, "strict").drop("functional_amount")


@register("fx_rate_lookup_any")
def q_fx_rate_lookup_any(t: FinanceTables) -> DataFrame:
    return _receipt_rates(t, "any").drop("functional_amount")


@register("fx_convert")
def q_fx_convert(t: FinanceTables) -> DataFrame:
    lines = t.ra_customer_trx_lines_all.select("customer_trx_line_id", "customer_trx_id", "extended_amount")
    trx = t.ra_customer_trx_all.select("customer_trx_id", "invoice_currency_code", "trx_date")
    j = fx.with_rate(lines.join(trx, "customer_trx_id"), fx.rate_table(t, FX), "invoice_currency_code",
                     "trx_date", "inv")
    return j.select("customer_trx_line_id", "invoice_currency_code",
                    exact(fx.to_functional("extended_amount", "invoice_currency_code", "inv", FX))
                    .alias("functional_amount"))


@register("fx_applied_three_way")
def q_fx_applied_three_way(t: FinanceTables) -> DataFrame:
    app = t.ar_receivable_applications_all.filter(F.col("status") == "APP").select(
        "cash_receipt_id", "applied_customer_trx_id", "amount_applied")
    rc = t.ar_cash_receipts_all.select("cash_receipt_id", "currency_code", "receipt_date")
    trx = t.ra_customer_trx_all.select("customer_trx_id", "invoice_currency_code")
    j = app.join(rc, "cash_receipt_id").join(trx, F.col("applied_customer_trx_id") == F.col("customer_trx_id"))
    j = fx.with_rate(j, fx.rate_table(t, FX), "currency_code", "receipt_date", "rct")
    return j.select("cash_receipt_id", "applied_customer_trx_id", "currency_code", "invoice_currency_code",
                    exact(fx.applied_to_functional("amount_applied", "currency_code", "invoice_currency_code", "rct",
                                                   FX)).alias("functional_applied_amount"))


@register("trx_applied_total")
def q_trx_applied_total(t: FinanceTables) -> DataFrame:
    a = patient.trx_applied_total(t, PATIENT_G1)
    return a.select("bill_to_customer_id", "party_name", "customer_trx_id", "account_number",
                    exact("total_applied_amount").alias("total_applied_amount"))


@register("receipt_applied_total")
def q_receipt_applied_total(t: FinanceTables) -> DataFrame:
    a = patient.receipt_applied_total(t)
    return a.select("cash_receipt_id", exact("receipt_applied_total").alias("receipt_applied_total"))


@register("max_text_date")
def q_max_text_date(t: FinanceTables) -> DataFrame:
    return t.ar_receivable_applications_all.groupBy("cash_receipt_id").agg(
        F.max(date_text("gl_date", "yyyy-MM-dd")).alias("max_gl_iso"),
        F.max(date_text("gl_date", "dd-MM-yyyy")).alias("max_gl_dmy"))


@register("patient_invoice_branch")
def q_patient_invoice_branch(t: FinanceTables) -> DataFrame:
    return patient.invoice_branch(t, PATIENT_G1)


@register("patient_receipt_branch")
def q_patient_receipt_branch(t: FinanceTables) -> DataFrame:
    return patient.receipt_branch(t, PATIENT_G1)


@register("patient_unapplied_branch")
def q_patient_unapplied_branch(t: FinanceTables) -> DataFrame:
    return patient.unapplied_branch(t, PATIENT_G1)


@register("patient_ledger_union")
def q_patient_ledger_union(t: FinanceTables) -> DataFrame:
    return patient.ledger(t, PATIENT_G2)


@register("patient_statement_g1")
def q_patient_statement_g1(t: FinanceTables) -> DataFrame:
    return reports.patient_account_statement(t, PATIENT_G1)


@register("patient_statement_g2")
def q_patient_statement_g2(t: FinanceTables) -> DataFrame:
    return reports.patient_account_statement(t, PATIENT_G2)


@register("patient_statements_all_g2")
def q_patient_statements_all_g2(t: FinanceTables) -> DataFrame:
    """R5 for every patient in one run (``selector_id`` names the patient)."""
    return reports.patient_account_statement(t, ALL_PATIENTS_G2)


@register("patient_statements_all_g1")
def q_patient_statements_all_g1(t: FinanceTables) -> DataFrame:
    """R4 for every patient in one run; documents of no patient are under the sentinel."""
    return reports.patient_account_statement(t, PatientParams(PATIENT_G1.from_date, PATIENT_G1.to_date, None, options=G1))


@register("patient_statement_other_documents")
def q_patient_statement_other_documents(t: FinanceTables) -> DataFrame:
    """R5 for the sentinel: the documents of no patient, at a site with codes of its own."""
    site = SiteCodes(other_documents="NONE", deposit_prefix="RC1")
    return reports.patient_account_statement(t, PatientParams(*PERIOD, "NONE", options=G2, site=site))


# ---- positions: the order of the reports, as a column ------------------------------------------

def _positions(report: str, df: DataFrame, p) -> DataFrame:
    return with_position(df, reports.order_of(report, df, p))


@register("positions_statement_g1")
def q_positions_statement_g1(t: FinanceTables) -> DataFrame:
    """O2: statement by date."""
    return _positions("patient-statement", reports.patient_account_statement(t, PATIENT_G1), PATIENT_G1)


@register("positions_statements_all_g2")
def q_positions_statements_all_g2(t: FinanceTables) -> DataFrame:
    """O3: all patients' statements, each by the text of the GL date, descending, NULLs first."""
    return _positions("patient-statement", reports.patient_account_statement(t, ALL_PATIENTS_G2), ALL_PATIENTS_G2)


@register("positions_detail_subtotals")
def q_positions_detail_subtotals(t: FinanceTables) -> DataFrame:
    """Groups by supplier name, each followed by its subtotal."""
    return _positions("aging-detail-subtotals", reports.aging_detail_with_subtotals(t, AGING), AGING)


@register("positions_running_balance")
def q_positions_running_balance(t: FinanceTables) -> DataFrame:
    """O1: all suppliers' statements, each by date."""
    return _positions("supplier-statements", reports.supplier_account_statements(t, ALL_SUPPLIERS), ALL_SUPPLIERS)


# ---- times of day, suppliers without a name, days with two rates --------------------------------

@register("timed_periods")
def q_timed_periods(t: FinanceTables) -> DataFrame:
    """The same period by day and by time."""
    between = F.col("trx_date").between(F.lit(PERIOD[0]), F.lit(PERIOD[1]))
    return times_of_day(t).ra_customer_trx_all.select(
        "customer_trx_id", day_between("trx_date", *PERIOD).alias("by_day"), between.alias("exact"))


@register("timed_days_outstanding")
def q_timed_days_outstanding(t: FinanceTables) -> DataFrame:
    """P11, P15."""
    return times_of_day(t).ap_invoices_all.select(
        "invoice_id", days_outstanding(AS_ON, "invoice_date").cast("bigint").alias("past_due_days"),
        date_text("invoice_date").alias("day_text"))


@register("timed_optional_param_filter")
def q_timed_optional_param_filter(t: FinanceTables) -> DataFrame:
    """an optional parameter that isn't given drops suppliers whose name or number is NULL."""
    v = times_of_day(t).poz_suppliers_v.filter(optional_match("vendor_name", None) & optional_match("segment1", None))
    return v.select("vendor_id", "vendor_name", F.col("segment1").alias("supp_no"))


def _to_the_minute(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, date_text(column, "yyyy-MM-dd HH:mm"))


@register("timed_aging_detail")
def q_timed_aging_detail(t: FinanceTables) -> DataFrame:
    """An invoice of the as-on day itself, at midnight or later, is not yet old."""
    return _to_the_minute(aging.ap_aging_detail(times_of_day(t), AGING), "invoice_date")


@register("timed_ledger_union")
def q_timed_ledger_union(t: FinanceTables) -> DataFrame:
    """The last day of the period counts to its end."""
    return _to_the_minute(ledger.ledger_union(times_of_day(t), ALL_SUPPLIERS), "trx_date")


@register("timed_patient_statements_all")
def q_timed_patient_statements_all(t: FinanceTables) -> DataFrame:
    """Invoices of the period's last day after midnight are out; receipts and rates go by day."""
    p = PatientParams(PERIOD[0], PERIOD[1], None, options=G1)
    return reports.patient_account_statement(times_of_day(t), p)


@register("duplicate_rates_any")
def q_duplicate_rates_any(t: FinanceTables) -> DataFrame:
    """Any of several rates, the smallest."""
    return _receipt_rates(duplicate_rates(t), "any").select("cash_receipt_id", "exchange_rate", "functional_amount")


@register("duplicate_rates_strict")
def q_duplicate_rates_strict(t: FinanceTables) -> DataFrame:
    """Several rates are no error where none is looked up, in the functional currency."""
    d = duplicate_rates(t)
    looked_up = (F.col("currency_code") == "KES") | (F.dayofmonth("receipt_date") != DUPLICATED_DAY)
    return _receipt_rates(d.with_overrides(ar_cash_receipts_all=d.ar_cash_receipts_all.filter(looked_up)), "strict") \
        .select("cash_receipt_id", "exchange_rate", "functional_amount")
