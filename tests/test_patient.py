"""Patient statement and FX hazards (FIXTURES.md §2, X17-X28, X31)."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from conftest import dec, frame, tables
from statera.functions import flexfield_or_sentinel, receipt_class
from statera.operators import fx
from statera.operators.patient import (invoice_branch, ledger, patient_statement, receipt_branch, receipt_rows,
                                       unapplied_branch)
from statera.params import G1, G2, FxConfig, PatientParams

CTX = "PATIENT AND SPONSER DETAILS"
PARTY = dict(hz_parties=[dict(party_id=1, party_name="Cust")],
             hz_cust_accounts=[dict(cust_account_id=1, party_id=1, account_number="AC1")])


def params(options=G1, **kw):
    return PatientParams(dt.date(2024, 1, 1), dt.date(2024, 12, 31), "P7", options=options, **kw)


def trx(i, cur="KES", date="2024-03-01", category=CTX, **kw):
    return dict(dict(customer_trx_id=i, trx_number=f"T{i}", trx_date=date, bill_to_customer_id=1,
                     invoice_currency_code=cur, attribute_category=category, attribute1="P7", attribute2="Pat",
                     attribute12="PLAN"), **kw)


def receipt(i, cur="KES", number=None, amount=100, **kw):
    return dict(dict(cash_receipt_id=i, receipt_number=number or f"RC{i}", receipt_date="2024-03-05",
                     currency_code=cur, amount=amount, pay_from_customer=1, status="APP", attribute1="P7"), **kw)


def world(spark, types=None, **rel):
    merged = dict(PARTY)
    merged.update(rel)
    return tables(spark, types=types, **merged)


def rate(cur, day, value):
    return dict(conversion_date=day, from_currency=cur, to_currency="KES", conversion_rate=value)


# ---- FX ------------------------------------------------------------------------------------

def _docs(spark, rates, currencies):
    t = world(spark, gl_daily_rates=rates)
    docs = spark.createDataFrame([(i, c, dt.date(2024, 3, 1), dec(10)) for i, c in enumerate(currencies)],
                                 "id int, cur string, day date, amount decimal(18,2)")
    return t, fx.with_rate(docs, fx.rate_table(t, FxConfig()), "cur", "day", "r")


def test_strict_rate_raises_only_where_used(spark):  # X17 / H11
    rates = [rate("USD", "2024-03-01", 150), rate("EUR", "2024-03-01", 160), rate("EUR", "2024-03-01", 161),
             rate("KES", "2024-03-01", 1), rate("KES", "2024-03-01", 1)]
    _, j = _docs(spark, rates, ["USD", "KES"])
    got = {r.id: r.x for r in j.select("id", fx.exchange_rate("cur", "r", FxConfig()).alias("x")).collect()}
    assert got == {0: dec(150), 1: None}
    _, j = _docs(spark, rates, ["EUR"])
    with pytest.raises(Exception, match="more than one conversion rate"):
        j.select(fx.exchange_rate("cur", "r", FxConfig()).alias("x")).collect()


def test_any_rate_takes_the_smallest(spark):  # X18
    _, j = _docs(spark, [rate("USD", "2024-03-01", 151), rate("USD", "2024-03-01", 150)], ["USD"])
    assert j.select(fx.exchange_rate("cur", "r", FxConfig(), mode="any").alias("x")).first().x == dec(150)


def test_missing_rate(spark):  # X19 / H13 / F12
    _, j = _docs(spark, [], ["USD"])
    assert j.select(fx.to_functional("amount", "cur", "r", FxConfig()).alias("x")).first().x is None
    t = world(spark, ra_customer_trx_all=[trx(1, cur="USD")], ar_cash_receipts_all=[receipt(9, cur="USD")],
              ar_receivable_applications_all=[dict(cash_receipt_id=9, applied_customer_trx_id=1, status="APP",
                                                   amount_applied=10, gl_date="2024-03-06")])
    assert receipt_rows(t, params()).count() == 0


def test_applied_amount_three_ways(spark):  # X20 / B8
    pairs = [("KES", "USD"), ("USD", "KES"), ("USD", "USD"), ("USD", None)]
    t = world(spark, gl_daily_rates=[rate("USD", "2024-03-05", 150)])
    df = spark.createDataFrame([(i, r, c, dt.date(2024, 3, 5), dec(10)) for i, (r, c) in enumerate(pairs)],
                               "id int, rc string, ic string, day date, amount decimal(18,2)")
    j = fx.with_rate(df, fx.rate_table(t, FxConfig()), "rc", "day", "r")
    got = {r.id: r.x for r in j.select("id", fx.applied_to_functional("amount", "rc", "ic", "r", FxConfig())
                                       .alias("x")).collect()}
    assert got == {0: dec(10), 1: dec(10), 2: dec(1500), 3: None}


# ---- branches -------------------------------------------------------------------------------

def test_foreign_invoice_without_application(spark):  # X21 / H13
    t = world(spark, ra_customer_trx_all=[trx(1, cur="USD")],
              ra_customer_trx_lines_all=[dict(customer_trx_line_id=11, customer_trx_id=1, line_type="LINE",
                                              extended_amount=100)],
              ra_cust_trx_line_gl_dist_all=[dict(customer_trx_line_id=11, gl_date="2024-03-02")],
              gl_daily_rates=[rate("USD", "2024-03-01", 150)])
    r = invoice_branch(t, params()).collect()[0]
    assert (r.transaction_applied_amount, r.functional_original_amount) == (dec(0), dec(15000))
    assert r.transaction_remaining_amount is None and r.functional_remaining_amount is None
    assert (r.exchange_rate, r.patient_id, r.plan_name, r.gl_date) == (dec(150), "P7", "PLAN", "2024-03-02")


def test_receipt_class(spark):  # X22 / B9
    df = spark.createDataFrame([("DR1",), ("RC1",), (None,)], "n string")
    assert [r.c for r in df.select(receipt_class("n").alias("c")).collect()] == ["DEP", "RCPT", "RCPT"]


def test_sentinel_selects_non_patient_rows(spark):  # X23 / H6
    df = frame(spark, "ra_customer_trx_all", [trx(1), trx(2, category="OTHER"), trx(3, category=None)])
    got = df.filter(flexfield_or_sentinel("attribute_category", "attribute1") == "ZZZ").select("customer_trx_id")
    assert sorted(r.customer_trx_id for r in got.collect()) == [2, 3]


@pytest.mark.parametrize("unapplied,applied,kept", [(True, (), True), (True, (40,), False),
                                                     (True, (40, -40), True), (False, (100,), False)])
def test_wholly_unapplied_receipts(spark, unapplied, applied, kept):  # X24 / B10
    apps = [dict(cash_receipt_id=9, applied_customer_trx_id=None, status="UNAPP", amount_applied=100,
                 gl_date="2024-03-06")] if unapplied else []
    apps += [dict(cash_receipt_id=9, applied_customer_trx_id=1, status="APP", amount_applied=a, gl_date="2024-03-06")
             for a in applied]
    t = world(spark, ra_customer_trx_all=[trx(1)], ar_cash_receipts_all=[receipt(9)],
              ar_receivable_applications_all=apps)
    rows = unapplied_branch(t, params()).collect()
    assert (len(rows) == 1) == kept
    if kept:
        assert rows[0].functional_original_amount == rows[0].functional_remaining_amount == dec(-100)


@pytest.mark.parametrize("options,expected", [(G1, "2024-12-01"), (G2, "31-01-2024")])
def test_max_gl_date_is_text_max(spark, options, expected):  # X25 / H7
    apps = [dict(cash_receipt_id=9, applied_customer_trx_id=1, status="APP", amount_applied=10, gl_date=d)
            for d in ("2024-01-31", "2024-12-01")]
    t = world(spark, ra_customer_trx_all=[trx(1)], ar_cash_receipts_all=[receipt(9)],
              ar_receivable_applications_all=apps)
    assert receipt_branch(t, params(options)).first().gl_date == expected


@pytest.mark.parametrize("options", [G1, G2])
def test_distinct_after_formatting(spark, options):  # X26 / H23
    lines = [dict(customer_trx_line_id=i, customer_trx_id=1, line_type="LINE", extended_amount=100) for i in (1, 2)]
    gl = [dict(customer_trx_line_id=1, gl_date="2024-01-31 09:00:00"),
          dict(customer_trx_line_id=2, gl_date="2024-01-31 17:00:00")]
    t = world(spark, types={"ra_cust_trx_line_gl_dist_all": {"gl_date": TimestampNTZType()}},
              ra_customer_trx_all=[trx(1, date="2024-01-20")], ra_customer_trx_lines_all=lines,
              ra_cust_trx_line_gl_dist_all=gl)
    p = PatientParams(dt.date(2024, 1, 1), dt.date(2024, 1, 31), "P7", options=options)
    assert invoice_branch(t, p).count() == 2
    rows = ledger(t, p).collect()
    assert len(rows) == 1 and rows[0].transaction_original_amount == dec(100)


def test_g2_orders_by_gl_text_descending_nulls_first(spark):  # X27 / H8 / H10
    lines = [dict(customer_trx_line_id=i, customer_trx_id=i, line_type="LINE", extended_amount=10 * i)
             for i in (1, 2, 3)]
    gl = [dict(customer_trx_line_id=2, gl_date="2024-02-05"), dict(customer_trx_line_id=3, gl_date="2024-01-31")]
    t = world(spark, ra_customer_trx_all=[trx(i) for i in (1, 2, 3)], ra_customer_trx_lines_all=lines,
              ra_cust_trx_line_gl_dist_all=gl + [dict(customer_trx_line_id=1, gl_date=None)])
    got = [r.gl_date for r in patient_statement(t, params(G2)).collect()]
    assert got == [None, "31-01-2024", "05-02-2024"]


@pytest.mark.parametrize("dates,expected", [(("2024-03-02", "2024-03-02"), [dec(200)]),
                                            (("2024-03-02", "2024-03-03"), [dec(100), dec(100)])])
def test_gl_distributions_multiply_lines(spark, dates, expected):  # X28 / H15
    t = world(spark, ra_customer_trx_all=[trx(1)],
              ra_customer_trx_lines_all=[dict(customer_trx_line_id=1, customer_trx_id=1, line_type="LINE",
                                              extended_amount=100)],
              ra_cust_trx_line_gl_dist_all=[dict(customer_trx_line_id=1, gl_date=d) for d in dates])
    got = sorted(r.transaction_original_amount for r in invoice_branch(t, params()).collect())
    assert got == expected


def test_receipts_grouped_by_number(spark):  # X31 / H22
    t = world(spark, ra_customer_trx_all=[trx(1)], ar_cash_receipts_all=[receipt(8, number="RC1"),
                                                                         receipt(9, number="RC1")],
              ar_receivable_applications_all=[
                  dict(cash_receipt_id=8, applied_customer_trx_id=1, status="APP", amount_applied=30,
                       gl_date="2024-03-06"),
                  dict(cash_receipt_id=9, applied_customer_trx_id=1, status="APP", amount_applied=50,
                       gl_date="2024-03-06")])
    rows = receipt_branch(t, params()).collect()
    assert len(rows) == 1
    assert (rows[0].transaction_original_amount, rows[0].transaction_applied_amount) == (dec(-100), dec(80))


def test_g1_party_filter_and_date_order(spark):  # R4 outer filter and order
    lines = [dict(customer_trx_line_id=i, customer_trx_id=i, line_type="LINE", extended_amount=10) for i in (1, 2)]
    gl = [dict(customer_trx_line_id=i, gl_date="2024-03-02") for i in (1, 2)]
    t = world(spark, ra_customer_trx_all=[trx(1, date="2024-05-01"), trx(2, date="2024-02-01")],
              ra_customer_trx_lines_all=lines, ra_cust_trx_line_gl_dist_all=gl)
    rows = patient_statement(t, params(party_name="Cust")).collect()
    assert [r.invoice_number for r in rows] == ["T2", "T1"]
    assert patient_statement(t, params(party_name="Other")).count() == 0
    assert F is not None


# ---- T4: the differences between the two datasets -----------------------------

def _period(options, patient="P7"):
    return PatientParams(dt.date(2024, 1, 1), dt.date(2024, 12, 31), patient, options=options)


def _invoice_world(spark, trx_date):
    return world(spark, ra_customer_trx_all=[trx(1, date=trx_date)],
                 ra_customer_trx_lines_all=[dict(customer_trx_line_id=1, customer_trx_id=1, line_type="LINE",
                                                 extended_amount=100)],
                 ra_cust_trx_line_gl_dist_all=[dict(customer_trx_line_id=1, gl_date="2024-01-02")],
                 ar_cash_receipts_all=[receipt(9, receipt_date="2024-01-05")],
                 ar_receivable_applications_all=[dict(cash_receipt_id=9, applied_customer_trx_id=1, status="APP",
                                                      amount_applied=30, gl_date="2024-01-05")])


def test_invoice_period_only_in_g1_and_applied_total_period_only_in_g2(spark):
    t = _invoice_world(spark, "2023-12-01")            # invoice dated before the period
    assert invoice_branch(t, _period(G1)).count() == 0
    rows = invoice_branch(t, _period(G2)).collect()
    assert len(rows) == 1 and rows[0].transaction_applied_amount == dec(0)   # total counts in-period invoices only
    t = _invoice_world(spark, "2024-03-01")
    assert invoice_branch(t, _period(G1)).first().transaction_applied_amount == dec(30)
    assert invoice_branch(t, _period(G2)).first().transaction_applied_amount == dec(30)


def test_receipt_selector_sentinel_only_in_g2(spark):
    t = world(spark, ra_customer_trx_all=[trx(1, category="OTHER")], ar_cash_receipts_all=[receipt(9)],
              ar_receivable_applications_all=[dict(cash_receipt_id=9, applied_customer_trx_id=1, status="APP",
                                                   amount_applied=30, gl_date="2024-03-06")])
    assert receipt_branch(t, _period(G1, "ZZZ")).count() == 0
    assert receipt_branch(t, _period(G2, "ZZZ")).count() == 1


def test_receipt_period_only_in_g2(spark):
    t = world(spark, ra_customer_trx_all=[trx(1)], ar_cash_receipts_all=[receipt(9, receipt_date="2023-06-01")],
              ar_receivable_applications_all=[dict(cash_receipt_id=9, applied_customer_trx_id=1, status="APP",
                                                   amount_applied=30, gl_date="2024-03-06")])
    assert receipt_branch(t, _period(G1)).count() == 1
    assert receipt_branch(t, _period(G2)).count() == 0


def test_unapplied_selector_receipt_in_g1_invoice_in_g2(spark):  # J9, H24
    t = world(spark, ar_cash_receipts_all=[receipt(9)],
              ar_receivable_applications_all=[dict(cash_receipt_id=9, applied_customer_trx_id=None,
                                                   status="UNAPP", amount_applied=100, gl_date="2024-03-06")])
    assert unapplied_branch(t, _period(G1)).count() == 1
    assert unapplied_branch(t, _period(G2)).count() == 0          # no invoice: its selector reads 'ZZZ'
    assert unapplied_branch(t, _period(G2, "ZZZ")).count() == 1


def test_receipt_row_shows_receipt_patient_but_is_selected_by_invoice(spark):  # H24
    t = world(spark, ra_customer_trx_all=[trx(1)], ar_cash_receipts_all=[receipt(9, attribute1="P99")],
              ar_receivable_applications_all=[dict(cash_receipt_id=9, applied_customer_trx_id=1, status="APP",
                                                   amount_applied=30, gl_date="2024-03-06")])
    rows = receipt_branch(t, params()).collect()
    assert [r.patient_id for r in rows] == ["P99"]
    assert receipt_branch(t, PatientParams(dt.date(2024, 1, 1), dt.date(2024, 12, 31), "P99")).count() == 0


def test_patient_selection_is_pushed_into_the_scan(spark, tmp_path):
    from statera.sources import FinanceTables
    frame(spark, "ra_customer_trx_all", [trx(1), trx(2, category="OTHER")]).write.parquet(
        str(tmp_path / "ra_customer_trx_all"))
    t = FinanceTables.from_parquet(spark, str(tmp_path))
    from statera.operators.patient import _select
    q = _select(t.ra_customer_trx_all, params(), "attribute1", "attribute_category", sentinel=True)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")     # show the full pushed-filter list
    try:
        plan = q._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(attribute1,P7)" in plan and "EqualTo(attribute_category," in plan
    assert [r.customer_trx_id for r in q.collect()] == [1]
    zzz = PatientParams(dt.date(2024, 1, 1), dt.date(2024, 12, 31), "ZZZ")
    z = _select(t.ra_customer_trx_all, zzz, "attribute1", "attribute_category", sentinel=True)
    assert [r.customer_trx_id for r in z.collect()] == [2]


# ---- every patient in one run ---------------------------------------------------------------

def _repeated_world(spark):
    """Repeated transactions, receipts, accounts, parties and null keys."""
    def app(receipt_id, trx_id, amount, status="APP", day="2024-03-06"):
        return dict(cash_receipt_id=receipt_id, applied_customer_trx_id=trx_id, status=status, amount_applied=amount, gl_date=day)
    return world(
        spark,
        hz_parties=[dict(party_id=1, party_name="Cust"), dict(party_id=1, party_name="Cust"), dict(party_id=2, party_name=None)],
        hz_cust_accounts=[dict(cust_account_id=1, party_id=1, account_number="AC1"), dict(cust_account_id=1, party_id=1, account_number="AC9"),
                          dict(cust_account_id=2, party_id=2, account_number="AC2"), dict(cust_account_id=None, party_id=1, account_number="N")],
        ra_customer_trx_all=[trx(1), trx(1, date="2023-03-01"), trx(1, bill_to_customer_id=2), trx(2, "USD", attribute1="P8"),
                             trx(3, category="OTHER"), trx(4, bill_to_customer_id=None), trx(None), trx(5, attribute1=None)],
        ra_customer_trx_lines_all=[dict(customer_trx_line_id=10 * i + n, customer_trx_id=i, line_type="LINE", extended_amount=100 + n)
                                   for i in (1, 2, 3, 4, 5) for n in (0, 1)],
        ra_cust_trx_line_gl_dist_all=[dict(customer_trx_line_id=10 * i + n, gl_date="2024-03-02") for i in (1, 2, 3, 4, 5) for n in (0, 1, 1)],
        ar_cash_receipts_all=[receipt(9), receipt(9), receipt(8, "USD"), receipt(7, attribute1="P8"), receipt(6, attribute1=None),
                              receipt(5, pay_from_customer=2), receipt(None)],
        ar_receivable_applications_all=[app(9, 1, 30), app(9, 1, 5, day="2024-02-28"), app(9, 2, None), app(8, 2, 7), app(8, 1, 3), app(5, 3, 4),
                                        app(None, 1, 9), app(7, None, 50, "UNAPP"), app(7, None, 20, "UNAPP", "2024-02-29"),
                                        app(7, 1, 6, "UNAPP"), app(6, None, 2, "UNAPP"), app(5, None, 3, "UNAPP")],
        gl_daily_rates=[rate("USD", "2024-03-01", 150), rate("USD", "2024-03-05", 151)])


@pytest.mark.parametrize("options", [G1, G2])
def test_statements_of_all_patients_equal_each_patients_own_with_repeated_and_null_ids(spark, options):
    t = _repeated_world(spark)
    rows = patient_statement(t, _period(options, None)).collect()
    assert {"P7", "P8"} <= {r.selector_id for r in rows}
    for who in ("P7", "P8", "ZZZ"):
        own = patient_statement(t, _period(options, who))
        mine = [str(tuple(r[c] for c in own.columns)) for r in rows if r.selector_id == who]
        assert mine == [str(tuple(r)) for r in own.collect()]


@pytest.mark.parametrize("options", [G1, G2])
def test_rows_of_all_patients_travel_once_to_be_grouped_and_made_distinct(spark, options):
    spark.conf.set("spark.sql.maxToStringFields", "100")
    try:
        plan = patient_statement(_repeated_world(spark), _period(options, None))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxToStringFields")
    by_name = re.findall(r"Exchange hashpartitioning\(([^)]*party_name[^)]*)\)", plan)
    assert len(by_name) == 3 and all(len(keys.split(", ")) == 4 for keys in by_name)
    sort = re.search(r"Sort \[(.*)\], true", plan).group(1)
    assert "(" not in sort  # no date parsed anew in each comparison


def test_applications_without_a_transaction_are_spread_over_the_tasks_of_its_join(spark):
    plan = unapplied_branch(_repeated_world(spark), _period(G1, None))._jdf.queryExecution().executedPlan().toString()
    assert "_spread" in plan
