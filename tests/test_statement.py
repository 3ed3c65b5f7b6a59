"""Supplier statement hazards (FIXTURES.md §2, X8-X16)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql.types import TimestampNTZType

from conftest import dec, tables
from statera.operators.balances import opening_balance, opening_invoice_rows
from statera.operators.ledger import (payment_wht_total, statement_payment_rows, supplier_statement,
                                      supplier_statement_by_vendor)
from statera.params import StatementParams

P = StatementParams(dt.date(2024, 2, 1), dt.date(2024, 2, 29), "S")
SUPPLIER = dict(
    poz_suppliers_v=[dict(vendor_id=1, vendor_name="S", segment1="1", party_id=101)],
    poz_suppliers=[dict(vendor_id=1, segment1="1", party_id=101)],
    hz_parties=[dict(party_id=101, party_name="S")],
    ap_lookup_codes=[dict(lookup_type="INVOICE TYPE", lookup_code="STANDARD")],
    ap_terms_val_v=[dict(term_id=0, name="IMMEDIATE")],
)


def inv(invoice_id, date, amount, **kw):
    return dict(dict(invoice_id=invoice_id, vendor_id=1, invoice_num=f"I{invoice_id}", invoice_date=date,
                     invoice_amount=amount, invoice_currency_code="KES", invoice_type_lookup_code="STANDARD",
                     approval_status="APPROVED", wfapproval_status="WFAPPROVED", description="PATIENT 1"), **kw)


def world(spark, types=None, **rel):
    merged = dict(SUPPLIER)
    merged.update(rel)
    return tables(spark, types=types, **merged)


@pytest.mark.parametrize("installments,expected", [((40, 40), [dec(100)]), ((40, 60), [dec(100), dec(200)])])
def test_equal_installments_collapse(spark, installments, expected):  # X8 / H2
    t = world(spark, ap_invoices_all=[inv(1, "2024-02-10", 100)],
              ap_payment_schedules_all=[dict(invoice_id=1, amount_remaining=a) for a in installments])
    rows = supplier_statement(t, P).collect()
    assert [r.totals for r in rows] == expected
    assert [r.row_id for r in rows] == list(range(1, len(expected) + 1))


def test_opening_balance_from_distributions_and_payments(spark):  # X9
    t = world(spark, ap_invoices_all=[inv(1, "2024-01-10", 100)],
              ap_payment_schedules_all=[dict(invoice_id=1, amount_remaining=0)],
              ap_invoice_distributions_all=[dict(invoice_id=1, amount=90, accounting_date="2024-01-10"),
                                            dict(invoice_id=1, amount=20, accounting_date="2024-02-05")],
              ap_invoice_payments_all=[dict(invoice_id=1, check_id=5, amount=30, discount_taken=None,
                                            accounting_date="2024-01-20")])
    assert [(r.vendor_id, r.opening_balance) for r in opening_balance(t, P).collect()] == [(1, dec(60))]


def test_opening_without_distributions_skips_null_payment(spark):  # X10 / H17
    t = world(spark, ap_invoices_all=[inv(1, "2024-01-10", 100)],
              ap_payment_schedules_all=[dict(invoice_id=1, amount_remaining=0)],
              ap_invoice_payments_all=[dict(invoice_id=1, check_id=5, amount=None, discount_taken=5,
                                            accounting_date="2024-01-20")])
    assert opening_balance(t, P).collect()[0].opening_balance == dec(100)


def test_time_of_day_gap_before_period(spark):  # X11 / H4
    t = world(spark, types={"ap_invoices_all": {"invoice_date": TimestampNTZType()}},
              ap_invoices_all=[inv(1, "2024-01-31 10:00:00", 100)],
              ap_payment_schedules_all=[dict(invoice_id=1, amount_remaining=100)])
    assert opening_balance(t, P).count() == 0
    assert supplier_statement(t, P).count() == 0


def _running_world(spark, with_period_rows=True):
    invoices = [inv(1, "2024-01-05", 50)]
    schedules = [dict(invoice_id=1, amount_remaining=50)]
    rel = {}
    if with_period_rows:
        invoices.append(inv(2, "2024-02-01", 100))
        schedules.append(dict(invoice_id=2, amount_remaining=100))
        rel = dict(
            ap_checks_all=[dict(check_id=7, payment_id=7, vendor_id=1, currency_code="KES")],
            iby_payments_all=[dict(payment_id=7, payment_reference_number=500007, payment_date="2024-02-02",
                                   payment_amount=40, payment_status="ISSUED")],
            ap_invoice_lines_all=[dict(invoice_id=2, line_type_lookup_code="AWT", amount=-2)],
            ap_invoice_payments_all=[dict(invoice_id=2, check_id=7, amount=40, accounting_date="2024-02-02")])
    return world(spark, ap_invoices_all=invoices, ap_payment_schedules_all=schedules, **rel)


def test_running_balance_from_opening(spark):  # X12 / B6
    rows = supplier_statement(_running_world(spark), P).collect()
    assert [(r.rec_type, r.trx_amt, r.trx_wht, r.totals) for r in rows] == [
        ("Invoice", dec(100), dec(0), dec(150)), ("Payment", dec(-40), dec(-2), dec(108))]
    assert all(r.opening_balance == dec(50) for r in rows)
    assert rows[0].trx_date == "01-02-2024"


def test_empty_period_shows_nothing(spark):  # X13
    t = _running_world(spark, with_period_rows=False)
    assert opening_balance(t, P).collect()[0].opening_balance == dec(50)
    assert supplier_statement(t, P).count() == 0


def test_void_and_null_status_payments_dropped(spark):  # X14 / H14
    statuses = ["ISSUED", "VOID", "VOID_BY_OVERFLOW", None]
    t = world(spark,
              ap_checks_all=[dict(check_id=i, payment_id=i, vendor_id=1, currency_code="KES") for i in range(4)],
              iby_payments_all=[dict(payment_id=i, payment_reference_number=100 + i, payment_date="2024-02-02",
                                     payment_amount=10, payment_status=s) for i, s in enumerate(statuses)])
    assert [r.trx_num for r in statement_payment_rows(t, P).collect()] == ["100"]


def test_lookup_outer_join_keeps_unknown_types(spark):  # X15 / J7
    t = world(spark, ap_invoices_all=[inv(1, "2024-01-10", 100),
                                      inv(2, "2024-01-10", 100, invoice_type_lookup_code="UNKNOWN")],
              ap_payment_schedules_all=[dict(invoice_id=1, amount_remaining=0), dict(invoice_id=2, amount_remaining=0)])
    assert opening_invoice_rows(t, P).count() == 2


def test_wht_counts_each_payment_of_an_invoice(spark):  # X16 / H16
    t = world(spark, ap_invoice_lines_all=[dict(invoice_id=1, line_type_lookup_code="AWT", amount=-5)],
              ap_invoice_payments_all=[dict(invoice_id=1, check_id=7, amount=10, accounting_date="2024-02-02"),
                                       dict(invoice_id=1, check_id=7, amount=20, accounting_date="2024-02-03")])
    assert [(r.check_id, r.wht_total) for r in payment_wht_total(t).collect()] == [(7, dec(-10))]


def test_by_vendor_statement_restarts_per_vendor(spark):
    vendors = dict(
        poz_suppliers_v=[dict(vendor_id=v, vendor_name=f"S{v}", segment1=str(v), party_id=100 + v) for v in (1, 2)],
        poz_suppliers=[dict(vendor_id=v, segment1=str(v), party_id=100 + v) for v in (1, 2)],
        hz_parties=[dict(party_id=100 + v, party_name=f"S{v}") for v in (1, 2)])
    invoices = [inv(1, "2024-01-05", 50), inv(2, "2024-02-03", 100), inv(3, "2024-02-01", 7, vendor_id=2),
                inv(4, "2024-02-02", 3, vendor_id=2)]
    t = world(spark, ap_invoices_all=invoices,
              ap_payment_schedules_all=[dict(invoice_id=i, amount_remaining=1) for i in (1, 2, 3, 4)], **vendors)
    rows = supplier_statement_by_vendor(t, StatementParams(P.from_date, P.to_date, None)).collect()
    assert [(r.vendor_id, r.row_id, r.totals) for r in rows] == [
        (1, 1, dec(150)), (2, 1, dec(7)), (2, 2, dec(10))]


def test_equal_dates_are_numbered_in_a_fixed_order(spark):  # H9
    t = world(spark, ap_invoices_all=[inv(2, "2024-02-02", 100), inv(1, "2024-02-02", 50)],
              ap_payment_schedules_all=[dict(invoice_id=1, amount_remaining=1), dict(invoice_id=2, amount_remaining=1)],
              ap_checks_all=[dict(check_id=7, payment_id=7, vendor_id=1, currency_code="KES")],
              iby_payments_all=[dict(payment_id=7, payment_reference_number=500007, payment_date="2024-02-02",
                                     payment_amount=40, payment_status="ISSUED")])
    rows = supplier_statement(t, P).collect()
    assert [(r.row_id, r.rec_type, r.trx_num) for r in rows] == [
        (1, "Invoice", "I1"), (2, "Invoice", "I2"), (3, "Payment", "500007")]
    assert [r.totals for r in rows] == [dec(50), dec(150), dec(110)]
