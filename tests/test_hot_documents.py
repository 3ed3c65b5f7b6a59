"""A document with a third of a fact's rows: apart from the buckets, joined by salts, summed where it lies."""

from __future__ import annotations

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import frame
from statera.operators import aging, ledger
from statera.operators.joins import salted_join
from statera.params import AgingParams
from statera.sources import FinanceTables
from statera.sources.landing import HOT_SHARE, land_tables
from statera.sources.schema import RELATIONS

N, HOT = 12_000, 7
P = AgingParams(dt.date(2024, 6, 30))


@pytest.fixture(scope="module")
def source(spark):
    """1000 invoices; invoice 7 has 30 % of the lines and of the installments."""
    ids = F.when(F.col("id") < N * 3 // 10, HOT).otherwise(F.col("id") % 1000).cast("bigint")
    rows = spark.range(N)
    given = {
        "ap_invoices_all": spark.range(1000).select(
            F.col("id").alias("invoice_id"), F.lit(1).cast("bigint").alias("vendor_id"), F.lit(11).cast("bigint").alias("vendor_site_id"),
            F.concat(F.lit("I"), F.col("id")).alias("invoice_num"), F.lit("STANDARD").alias("invoice_type_lookup_code"),
            F.lit(dt.date(2024, 3, 1)).alias("invoice_date"), F.lit(1).cast("decimal(10,4)").alias("exchange_rate"),
            F.lit("N").alias("payment_status_flag")),
        "ap_payment_schedules_all": rows.select(ids.alias("invoice_id"), (F.col("id") % 50 + 1).cast("decimal(18,2)").alias("amount_remaining")),
        "ap_trial_balances": spark.range(1000).select(
            F.col("id").alias("invoice_id"), F.lit(1).cast("bigint").alias("vendor_id"), F.lit(0).cast("decimal(33,4)").alias("accounted_dr"),
            F.col("id").cast("decimal(28,2)").alias("accounted_cr")),
        "ap_invoice_lines_all": rows.select(ids.alias("invoice_id"), F.lit("TAX").alias("line_type_lookup_code"),
                                            (F.col("id") % 50).cast("decimal(23,4)").alias("amount")),
        "poz_suppliers_v": frame(spark, "poz_suppliers_v", [dict(vendor_id=1, vendor_name="A", segment1="1")]),
        "poz_supplier_sites_all_m": frame(spark, "poz_supplier_sites_all_m", [dict(vendor_site_id=11, vendor_id=1)]),
        "ap_lookup_codes": frame(spark, "ap_lookup_codes", [dict(lookup_type="INVOICE TYPE", lookup_code="STANDARD")]),
    }
    whole = {}
    for name in RELATIONS:
        empty = frame(spark, name, [])
        df = given.get(name, empty)
        whole[name] = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in empty.dtypes])
    return FinanceTables(whole)


@pytest.fixture(scope="module")
def landed(spark, source):
    return land_tables(spark, source, "hot_documents", buckets=8, hot_share=HOT_SHARE)


def _dealt(df) -> list[int]:
    """Rows of each task that has rows."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_hot_rows_lie_apart_and_none_is_lost(landed, source):
    for name in ("ap_invoice_lines_all", "ap_payment_schedules_all"):
        assert landed.is_hot(name) and {r.invoice_id for r in landed.hot(name).select("invoice_id").distinct().collect()} == {HOT}
        assert landed.hot(name).count() == N * 3 // 10 + 8  # its share of the rest too
        assert landed.table(name).exceptAll(source.table(name)).isEmpty() and landed.table(name).count() == N
    assert not landed.is_hot("ap_trial_balances") and not landed.is_hot("ap_invoices_all")


def test_reports_are_the_same(landed, source):
    for report in (aging.ap_aging_detail, aging.ap_aging_summary):
        a, b = (sorted(map(repr, report(t, P).collect())) for t in (landed, source))
        assert a == b and a
    a, b = (sorted(map(repr, ledger.invoice_tax_total(t).collect())) for t in (landed, source))
    assert a == b and len(a) == 1000


def test_no_task_has_twice_the_median(spark, landed):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in zip(keys, ("-1", "false", "128m", "8"), strict=True):  # a task per file, no help at run time
        spark.conf.set(k, v)
    try:
        scans = _dealt(landed.cold("ap_invoice_lines_all")) + _dealt(landed.hot("ap_invoice_lines_all"))
        assert len(scans) >= 10 and max(scans) <= 2 * statistics.median(scans)
        headers = landed.ap_invoices_all.where(F.col("invoice_id") == HOT).select("invoice_id", "invoice_num")
        joined = salted_join(landed.hot("ap_invoice_lines_all"), headers, ["invoice_id"], 8)
        dealt = _dealt(joined)
        assert sum(dealt) == N * 3 // 10 + 8 and len(dealt) >= 3 and max(dealt) <= 2 * statistics.median(dealt)
        plan = aging.aging_detail_rows(landed, P)._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan and "Bucketed: true" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_left_salted_join_keeps_rows_without_a_partner(spark):
    a = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(5)
    b = spark.createDataFrame([(0, "x"), (1, "y")], "k long, v string")
    got = salted_join(a, b, ["k"], 4, how="left")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, a.join(b, "k", "left").collect()))
