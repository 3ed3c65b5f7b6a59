"""Explicit schema of every relation the reports read (only the columns they use)."""

from __future__ import annotations

from pyspark.sql import types as T


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


L, S, D, I = T.LongType(), T.StringType(), T.DateType(), T.IntegerType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "poz_suppliers_v": _struct(("vendor_id", L), ("vendor_name", S), ("segment1", S), ("party_id", L)),
    "poz_suppliers": _struct(("vendor_id", L), ("segment1", S), ("party_id", L)),
    "poz_supplier_sites_all_m": _struct(("vendor_site_id", L), ("vendor_id", L)),
    "hz_parties": _struct(("party_id", L), ("party_name", S)),
    "ap_lookup_codes": _struct(("lookup_type", S), ("lookup_code", S)),
    "ap_terms_val_v": _struct(("term_id", I), ("name", S)),
    "ap_invoices_all": _struct(
        ("invoice_id", L), ("vendor_id", L), ("vendor_site_id", L), ("invoice_num", S),
        ("invoice_type_lookup_code", S), ("description", S), ("invoice_date", D),
        ("invoice_currency_code", S), ("exchange_rate", _dec(10, 4)), ("invoice_amount", _dec(28, 2)),
        ("terms_id", L), ("payment_status_flag", S), ("cancelled_date", D),
        ("approval_status", S), ("wfapproval_status", S)),
    "ap_payment_schedules_all": _struct(("invoice_id", L), ("due_date", D), ("amount_remaining", _dec(18, 2))),
    "ap_trial_balances": _struct(("invoice_id", L), ("vendor_id", L), ("accounted_dr", _dec(33, 4)),
                                 ("accounted_cr", _dec(28, 2))),
    "ap_invoice_distributions_all": _struct(("invoice_id", L), ("amount", _dec(18, 2)), ("accounting_date", D)),
    "ap_invoice_payments_all": _struct(("invoice_id", L), ("check_id", L), ("amount", _dec(24, 4)),
                                       ("discount_taken", _dec(23, 4)), ("accounting_date", D)),
    "ap_invoice_lines_all": _struct(("invoice_id", L), ("line_type_lookup_code", S), ("amount", _dec(23, 4))),
    "ap_checks_all": _struct(("check_id", L), ("payment_id", L), ("vendor_id", L), ("currency_code", S)),
    "iby_payments_all": _struct(("payment_id", L), ("payment_reference_number", L), ("payment_date", D),
                                ("payment_amount", _dec(18, 2)), ("payment_status", S)),
    "hz_cust_accounts": _struct(("cust_account_id", L), ("party_id", L), ("account_number", S)),
    "ra_customer_trx_all": _struct(
        ("customer_trx_id", L), ("trx_number", S), ("trx_date", D), ("bill_to_customer_id", L),
        ("invoice_currency_code", S), ("attribute_category", S), ("attribute1", S), ("attribute2", S),
        ("attribute12", S)),
    "ra_customer_trx_lines_all": _struct(("customer_trx_line_id", L), ("customer_trx_id", L), ("line_type", S),
                                         ("extended_amount", _dec(18, 2))),
    "ra_cust_trx_line_gl_dist_all": _struct(("customer_trx_line_id", L), ("gl_date", D)),
    "ar_cash_receipts_all": _struct(
        ("cash_receipt_id", L), ("receipt_number", S), ("receipt_date", D), ("currency_code", S),
        ("amount", _dec(18, 2)), ("pay_from_customer", L), ("status", S), ("attribute1", S)),
    "ar_receivable_applications_all": _struct(
        ("cash_receipt_id", L), ("applied_customer_trx_id", L), ("status", S), ("amount_applied", _dec(18, 2)),
        ("gl_date", D)),
    "gl_daily_rates": _struct(("conversion_date", D), ("from_currency", S), ("to_currency", S),
                              ("conversion_rate", _dec(10, 4))),
}

RELATIONS: tuple[str, ...] = tuple(SCHEMAS)
