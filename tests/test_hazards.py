"""The variants reach the rules that they are for: periods by day and by time differ, NULL names drop, two rates matter."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from statera.plans import catalog
from statera.sources import derive_tables
from statera.sources.hazards import DUPLICATED_DAY, duplicate_rates

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def derived(spark):
    return derive_tables(spark, SF)


def test_the_last_day_of_a_period_counts_by_day_alone(derived):
    got = catalog.TABLE_QUERIES["timed_periods"](derived)
    late = got.join(derived.ra_customer_trx_all.select("customer_trx_id", "trx_date"), "customer_trx_id").where("by_day <> exact")
    days = {(r.trx_date, r.by_day) for r in late.collect()}
    assert days == {(catalog.PERIOD[1], True)}


def test_invoices_of_the_last_day_are_out_of_the_untruncated_period(derived):
    timed = catalog.TABLE_QUERIES["timed_patient_statements_all"](derived).where("transaction_type = 'INV'")
    assert timed.agg(F.max("transaction_date")).first()[0] <= str(catalog.PERIOD[1])
    plain = derived.ra_customer_trx_all.where(F.col("trx_date") == F.lit(catalog.PERIOD[1])).where("customer_trx_id % 24 > 0")
    numbers = {r.trx_number for r in plain.collect()}
    assert numbers and not numbers & {r.invoice_number for r in timed.collect()}


def test_an_invoice_of_the_as_on_day_is_not_old(derived):
    got = catalog.TABLE_QUERIES["timed_aging_detail"](derived)
    assert got.agg(F.max("invoice_date")).first()[0] < f"{catalog.AS_ON} 00:00"
    assert got.where("hour(to_timestamp(invoice_date)) > 0").count() > 0


def test_suppliers_without_a_name_or_number_drop(derived):
    ids = {r.vendor_id % 10 for r in catalog.TABLE_QUERIES["timed_optional_param_filter"](derived).collect()}
    assert ids == {0, 1, 2, 4, 5, 6, 8, 9}


def test_a_second_rate_is_an_error_where_it_is_looked_up(derived):
    strict = catalog.TABLE_QUERIES["duplicate_rates_strict"](derived)
    own = strict.join(derived.ar_cash_receipts_all, "cash_receipt_id").where(F.dayofmonth("receipt_date") == DUPLICATED_DAY)
    assert {r.currency_code for r in own.select("currency_code").collect()} == {"KES"}
    with pytest.raises(SparkRuntimeException, match="more than one conversion rate"):
        catalog._receipt_rates(duplicate_rates(derived), "strict").collect()
    any_rate = {r.cash_receipt_id: r.exchange_rate for r in catalog.TABLE_QUERIES["duplicate_rates_any"](derived).collect()}
    once = {r.cash_receipt_id: r.exchange_rate for r in catalog.TABLE_QUERIES["fx_rate_lookup"](derived).collect()}
    assert any_rate == once  # the smaller of two rates is the one there was
