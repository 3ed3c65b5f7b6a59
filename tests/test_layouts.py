"""Landed tables: statistics that keep one-account statements from shuffling facts, second layouts that joins find in
place, months that a period reads alone; and sources that lack a column."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from statera.operators import balances, ledger, patient
from statera.operators.joins import estimated_bytes
from statera.plans.catalog import ALL_PATIENTS_G2, STATEMENT, TABLE_QUERIES
from statera.sources import FinanceTables, derive_tables
from statera.sources.landing import land_tables
from statera.sources.schema import SCHEMAS
from statera.sources.tables import conformed

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
FACT = re.compile(r"FileScan parquet \S*?\.(ap_invoice\w*|ap_payment_sched\w*|ap_trial_bal\w*|ra_cust\w*|ar_\w+|iby_pay\w*|ap_checks\w*)")


@pytest.fixture(scope="module")
def derived(spark):
    return derive_tables(spark, SF)


@pytest.fixture(scope="module")
def landed(spark, derived):
    return land_tables(spark, derived, "layouts", buckets=4)


@pytest.fixture
def small_broadcasts(spark):
    """A limit that dimensions and few documents are under, and the facts of the test data beyond."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32k")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def whole_facts_shuffled(df) -> list[str]:
    """Facts that an exchange takes as they are scanned, cut by no join before it."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(re.match(r"[\s:+\-]*", x)[0]) for x in lines]
    out = []
    for i, line in enumerate(lines):
        if re.match(r"[\s:+\-]*Exchange ", line):
            own, stop = [], None
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i] and lines[j].strip():
                    break
                if stop is not None and depth[j] > stop:
                    continue
                stop = depth[j] if re.match(r"[\s:+\-]*(Broadcast)?Exchange ", lines[j]) else None
                own.append(lines[j])
            facts = [m[1] for x in own if (m := FACT.search(x))]
            if facts and not any("Join" in x for x in own):
                out += facts
    return out


@pytest.mark.parametrize("name", ["supplier_statement", "patient_statement_g1", "patient_statement_g2"])
def test_a_statement_of_one_account_shuffles_no_whole_fact(landed, small_broadcasts, name):
    rows = ledger.ledger_union(landed, STATEMENT) if name == "supplier_statement" else TABLE_QUERIES[name](landed)
    assert whole_facts_shuffled(rows) == []
    if name == "supplier_statement":
        assert whole_facts_shuffled(balances.opening_balance(landed, STATEMENT)) == []


def test_the_documents_of_one_account_are_estimated_few(landed, derived):
    one = landed.ap_invoices_all.filter(F.col("vendor_id") == 3)
    assert estimated_bytes(one) * 5 < estimated_bytes(landed.ap_invoices_all)


def test_second_layouts_join_where_they_lie(spark, landed, derived, small_broadcasts):
    lines = landed.ra_customer_trx_lines_all.select("customer_trx_id", "customer_trx_line_id", "extended_amount")
    gl = landed.by("ra_cust_trx_line_gl_dist_all", "customer_trx_id")
    trx = landed.ra_customer_trx_all.select("customer_trx_id", "trx_number")
    applied = landed.by("ar_receivable_applications_all", "applied_customer_trx_id")
    j = trx.join(lines, "customer_trx_id").join(gl, ["customer_trx_id", "customer_trx_line_id"])
    j = j.join(applied, F.col("customer_trx_id") == F.col("applied_customer_trx_id"))
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan  # B13
    assert whole_facts_shuffled(patient.invoice_rows(landed, ALL_PATIENTS_G2)) == []
    plan = ledger.payment_wht_total(landed)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and re.findall(r"Exchange hashpartitioning\((\w+)#", plan) == ["check_id"]  # J13


def test_gl_distributions_by_transaction_keep_their_rows(landed, derived):
    owners = derived.ra_customer_trx_lines_all.select("customer_trx_line_id", "customer_trx_id").distinct()  # ids repeat
    base = derived.ra_cust_trx_line_gl_dist_all.join(owners, "customer_trx_line_id")
    base = base.select("customer_trx_line_id", "gl_date", "customer_trx_id")
    own = landed.by("ra_cust_trx_line_gl_dist_all", "customer_trx_id").select("customer_trx_line_id", "gl_date", "customer_trx_id")
    assert own.count() == base.count() and own.exceptAll(base).isEmpty()


@pytest.mark.parametrize("name", ["supplier_statement", "ap_aging_summary", "payment_wht_total", "patient_invoice_branch",
                                  "patient_receipt_branch", "trx_applied_total", "patient_statement_g2"])
def test_landed_tables_give_the_same_rows(landed, derived, name):
    a, b = (sorted(map(repr, TABLE_QUERIES[name](t).collect())) for t in (landed, derived))
    assert a == b and a


def test_a_statement_of_one_month_reads_one_month(landed):
    first, last = dt.date(1996, 3, 5), dt.date(1996, 3, 20)
    for name, column in (("ap_invoices_all", "invoice_date"), ("iby_payments_all", "payment_date")):
        month = landed.in_months(name, first, last)
        files = month.inputFiles()
        assert files and all("_month=1996-03-01" in f for f in files)
        assert month.columns == landed.table(name).columns and "_month" not in month.columns
        kept = F.col(column).between(first, last)
        assert month.filter(kept).count() == landed.table(name).filter(kept).count() > 0
    until = landed.in_months("ap_invoices_all", None, last)
    assert until.filter(F.col("invoice_date") <= last).count() == landed.ap_invoices_all.filter(F.col("invoice_date") <= last).count()
    assert len(until.inputFiles()) < len(landed.ap_invoices_all.inputFiles())


def test_days_without_a_month_are_kept(spark):
    rows = spark.createDataFrame([(1, None), (2, dt.date(2024, 1, 31)), (3, dt.date(2024, 2, 1))], "payment_id long, payment_date date")
    t = land_tables(spark, FinanceTables({"iby_payments_all": rows}), "layouts_null", relations=["iby_payments_all"])
    assert sorted(r.payment_id for r in t.iby_payments_all.collect()) == [1, 2, 3]
    assert [r.payment_id for r in t.in_months("iby_payments_all", dt.date(2024, 1, 5), dt.date(2024, 1, 31)).collect()] == [2]


def test_an_overridden_relation_has_no_former_layout(landed):
    other = landed.with_overrides(ar_receivable_applications_all=landed.ar_receivable_applications_all.limit(3))
    assert other.by("ar_receivable_applications_all", "applied_customer_trx_id").count() == 3
    assert "customer_trx_id" in other.by("ra_cust_trx_line_gl_dist_all", "customer_trx_id").columns


def test_a_missing_column_is_an_error_unless_optional(spark):
    df = spark.createDataFrame([(1, "S")], "vendor_id long, vendor_name string")
    with pytest.raises(ValueError, match="segment1, party_id"):
        conformed(df, SCHEMAS["poz_suppliers_v"])
    got = conformed(df, SCHEMAS["poz_suppliers_v"], optional=("segment1", "party_id"))
    assert [tuple(r) for r in got.collect()] == [(1, "S", None, None)]
