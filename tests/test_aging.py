"""Payables aging hazards (FIXTURES.md §2, X1-X7, X29, X30, X32)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from conftest import dec, frame, tables
from statera.functions import signed_balance
from statera.operators.aging import aging_detail_rows, ap_aging_detail, ap_aging_summary, ap_aging_summary_with_total
from statera.operators.totals import with_grand_total, with_group_totals
from statera.params import AgingParams
from statera.sources.tables import empty_strings_as_null

AS_ON = dt.date(2024, 6, 30)
P = AgingParams(as_on=AS_ON)
BUCKETS = ["current_month", "month_1", "month_2", "month_3", "month_abve_3"]


def world(spark, invoices, schedules=None, balances=None, vendors=None, types=None, **extra):
    """One supplier A (site 11) unless given; invoice rows are completed with defaults."""
    inv = [dict(dict(vendor_id=1, vendor_site_id=11, invoice_type_lookup_code="STANDARD", payment_status_flag="N",
                     invoice_num=f"I{r['invoice_id']}"), **r) for r in invoices]
    sch = schedules if schedules is not None else [dict(invoice_id=r["invoice_id"], amount_remaining=10) for r in inv]
    tb = balances if balances is not None else [
        dict(invoice_id=r["invoice_id"], vendor_id=r["vendor_id"], accounted_dr=0, accounted_cr=10) for r in inv]
    ven = vendors if vendors is not None else [dict(vendor_id=1, vendor_name="A", segment1="1", party_id=101)]
    return tables(
        spark, types=types, ap_invoices_all=inv, ap_payment_schedules_all=sch, ap_trial_balances=tb,
        poz_suppliers_v=ven, poz_supplier_sites_all_m=[dict(vendor_site_id=v["vendor_id"] * 10 + 1) for v in ven],
        ap_lookup_codes=[dict(lookup_type="INVOICE TYPE", lookup_code="STANDARD")],
        ap_terms_val_v=[dict(term_id=0, name="IMMEDIATE")], **extra)


def test_bucket_edges(spark):  # X1
    dates = ["2024-06-29", "2024-05-31", "2024-05-30", "2024-05-01", "2024-04-30", "2024-04-01", "2024-03-31",
             "2024-03-02", "2024-03-01"]
    expected = ["current_month", "current_month", "month_1", "month_1", "month_2", "month_2", "month_3", "month_3",
                "month_abve_3"]
    t = world(spark, [dict(invoice_id=i, invoice_date=d) for i, d in enumerate(dates)])
    rows = {r.invoice_num: r for r in ap_aging_detail(t, P).collect()}
    days = {r.invoice_num: r.past_due_days for r in aging_detail_rows(t, P).collect()}
    assert [days[f"I{i}"] for i in range(9)] == [1, 30, 31, 60, 61, 90, 91, 120, 121]
    for i, bucket in enumerate(expected):
        r = rows[f"I{i}"]
        assert r[bucket] == dec(10)
        assert sum(r[b] for b in BUCKETS) == r.amt_due_remaining == dec(10)


def test_as_on_day_is_excluded(spark):  # X2
    t = world(spark, [dict(invoice_id=1, invoice_date="2024-06-30 00:00:00"),
                      dict(invoice_id=2, invoice_date="2024-06-29 23:59:00")],
              types={"ap_invoices_all": {"invoice_date": TimestampNTZType()}})
    assert [r.invoice_num for r in ap_aging_detail(t, P).collect()] == ["I2"]


def test_time_of_day_counts_whole_days(spark):  # X3
    t = world(spark, [dict(invoice_id=1, invoice_date="2024-06-28 10:00:00")],
              types={"ap_invoices_all": {"invoice_date": TimestampNTZType()}})
    assert aging_detail_rows(t, P).collect()[0].past_due_days == 2


def test_signed_balance(spark):  # X4
    df = frame(spark, "ap_trial_balances", [dict(invoice_id=1, accounted_dr=30, accounted_cr=100),
                                            dict(invoice_id=2, accounted_dr=None, accounted_cr=100),
                                            dict(invoice_id=3, accounted_dr=30, accounted_cr=None)])
    got = {r.invoice_id: r.b for r in df.select("invoice_id", signed_balance("accounted_dr", "accounted_cr")
                                                .alias("b")).collect()}
    assert got == {1: dec(70), 2: dec(100), 3: dec(-30)}


def test_optional_name_drops_null_names(spark):  # X5 / H3
    vendors = [dict(vendor_id=1, vendor_name="A", segment1="1"), dict(vendor_id=2, vendor_name=None, segment1="2"),
               dict(vendor_id=3, vendor_name="B", segment1="3")]
    inv = [dict(invoice_id=i, vendor_id=i, vendor_site_id=i * 10 + 1, invoice_date="2024-06-01") for i in (1, 2, 3)]
    t = world(spark, inv, vendors=vendors)
    assert sorted(r.vendor_name for r in ap_aging_detail(t, P).collect()) == ["A", "B"]
    assert sorted(r.vendor_name for r in ap_aging_summary(t, P).collect()) == ["A", "B"]
    named = ap_aging_detail(t, AgingParams(as_on=AS_ON, vendor_name="B")).collect()
    assert [r.vendor_name for r in named] == ["B"]


def test_open_item_filter(spark):  # X6
    inv = [dict(invoice_id=1, invoice_date="2024-06-01", exchange_rate=None),
           dict(invoice_id=2, invoice_date="2024-06-01", exchange_rate=2),
           dict(invoice_id=3, invoice_date="2024-06-01", exchange_rate=None)]
    sch = [dict(invoice_id=1, amount_remaining=None), dict(invoice_id=2, amount_remaining=0),
           dict(invoice_id=3, amount_remaining=5)]
    t = world(spark, inv, schedules=sch)
    assert [r.invoice_num for r in ap_aging_detail(t, P).collect()] == ["I3"]


def test_installment_fan_out(spark):  # X7 / H1
    t = world(spark, [dict(invoice_id=1, invoice_date="2024-06-01")],
              schedules=[dict(invoice_id=1, amount_remaining=30), dict(invoice_id=1, amount_remaining=40)],
              balances=[dict(invoice_id=1, vendor_id=1, accounted_dr=0, accounted_cr=70)])
    detail = ap_aging_detail(t, P).collect()
    assert [r.amt_due_remaining for r in detail] == [dec(70), dec(70)]
    assert ap_aging_summary(t, P).collect()[0].total == dec(140)


def test_detail_and_summary_do_not_reconcile(spark):  # T4, SURVEY §3.1
    inv = [dict(invoice_id=1, invoice_date="2024-06-01", cancelled_date="2024-06-02"),  # cancelled
           dict(invoice_id=2, invoice_date="2024-06-01", invoice_type_lookup_code="UNLISTED"),  # not in lookup
           dict(invoice_id=3, invoice_date="2024-06-01", payment_status_flag="Y"),  # paid
           dict(invoice_id=4, invoice_date="2024-06-01", vendor_site_id=None)]  # no site
    t = world(spark, inv)
    assert sorted(r.invoice_num for r in ap_aging_detail(t, P).collect()) == ["I2"]
    # summary: cancelled, paid and site-less invoices count; the unlisted type does not
    assert ap_aging_summary(t, P).collect()[0].total == dec(30)


def test_group_and_grand_totals(spark):  # X29, A12, A13
    df = spark.createDataFrame([("A", 1, dec(10)), ("A", 2, dec(20)), ("B", 3, dec(5))],
                               "vendor_name string, n int, amt decimal(18,2)")
    g = with_group_totals(df, ["vendor_name"], ["amt"], sort=["n"]).collect()
    assert [(r.vendor_name, r.row_level, r.amt) for r in g] == [
        ("A", 0, dec(10)), ("A", 0, dec(20)), ("A", 1, dec(30)), ("B", 0, dec(5)), ("B", 1, dec(5))]
    total = [r for r in with_grand_total(df, ["amt"]).collect() if r.row_level == 2]
    assert len(total) == 1 and total[0].amt == dec(35) and total[0].vendor_name is None


def test_summary_with_its_total_in_one_aggregation(spark):  # R8, A13
    vendors = [dict(vendor_id=1, vendor_name="B", segment1="1"), dict(vendor_id=2, vendor_name="A", segment1="2")]
    inv = [dict(invoice_id=i, vendor_id=1 + i % 2, vendor_site_id=(1 + i % 2) * 10 + 1, invoice_date="2024-06-01") for i in (1, 2, 3)]
    rows = ap_aging_summary_with_total(world(spark, inv, vendors=vendors), P).collect()
    assert [(r.row_level, r.vendor_name, r.vendor_number, r.total, r.as_on_date) for r in rows] == [
        (0, "A", "2", dec(20), P.as_on), (0, "B", "1", dec(10), P.as_on), (2, None, None, dec(30), None)]
    none = ap_aging_summary_with_total(world(spark, []), P).collect()
    assert [(r.row_level, r.vendor_name, r.total, r.month_1) for r in none] == [(2, None, None, None)]


def test_duplicate_detail_rows_survive_totals(spark):  # X32 / H21
    t = world(spark, [dict(invoice_id=1, invoice_date="2024-06-01")],
              schedules=[dict(invoice_id=1, amount_remaining=30), dict(invoice_id=1, amount_remaining=40)],
              balances=[dict(invoice_id=1, vendor_id=1, accounted_dr=0, accounted_cr=70)])
    out = with_group_totals(ap_aging_detail(t, P), ["vendor_name"], ["amt_due_remaining"]).collect()
    assert [(r.row_level, r.amt_due_remaining) for r in out] == [(0, dec(70)), (0, dec(70)), (1, dec(140))]


def test_empty_string_is_null(spark):  # X30 / H12
    df = spark.createDataFrame([("",), ("A",)], "vendor_name string")
    assert [r.vendor_name for r in empty_strings_as_null(df).orderBy(F.col("vendor_name").asc_nulls_first())
            .collect()] == [None, "A"]


def test_summary_merges_vendors_sharing_name_and_number(spark):  # H20
    vendors = [dict(vendor_id=1, vendor_name="A", segment1="1"), dict(vendor_id=2, vendor_name="A", segment1="1")]
    inv = [dict(invoice_id=i, vendor_id=i, vendor_site_id=i * 10 + 1, invoice_date="2024-06-01") for i in (1, 2)]
    rows = ap_aging_summary(world(spark, inv, vendors=vendors), P).collect()
    assert [(r.vendor_name, r.vendor_number, r.total) for r in rows] == [("A", "1", dec(20))]
