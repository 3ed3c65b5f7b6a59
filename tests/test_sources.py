"""Sources, sinks and helpers: parquet loader, bucketed landing, size-checked broadcast,
checkpoint folder, cluster settings, display masks."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import dec, frame
from statera.functions import date_display, money_text
from statera.operators.joins import broadcast_if_small, estimated_bytes
from statera.session import cluster_conf, ensure_checkpoint_dir
from statera.sources import FinanceTables, derive, derive_tables
from statera.sources.landing import land_tables

SF = "/root/testdata/sf0.001"


def test_parquet_loader_applies_schema_and_nulls_empty_strings(spark, tmp_path):
    rows = [dict(vendor_id=1, vendor_name="", segment1="1", party_id=5),
            dict(vendor_id=2, vendor_name="B", segment1="2", party_id=6)]
    frame(spark, "poz_suppliers_v", rows).write.parquet(str(tmp_path / "poz_suppliers_v"))
    t = FinanceTables.from_parquet(spark, str(tmp_path), normalize=True)
    got = sorted((r.vendor_id, r.vendor_name) for r in t.poz_suppliers_v.collect())
    assert got == [(1, None), (2, "B")]
    assert dict(t.poz_suppliers_v.dtypes)["party_id"] == "bigint"


def test_plain_reads_push_string_filters_into_the_scan(spark, tmp_path):
    rows = [dict(vendor_id=1, vendor_name="A", segment1="1"), dict(vendor_id=2, vendor_name="B", segment1="2")]
    frame(spark, "poz_suppliers_v", rows).write.parquet(str(tmp_path / "poz_suppliers_v"))
    q = FinanceTables.from_parquet(spark, str(tmp_path)).poz_suppliers_v.filter(F.col("vendor_name") == "B")
    assert "EqualTo(vendor_name,B)" in q._jdf.queryExecution().executedPlan().toString()
    assert [r.vendor_id for r in q.collect()] == [2]


def test_landing_normalises_empty_strings_once(spark):
    src = FinanceTables({"hz_parties": spark.createDataFrame([(1, ""), (2, "P")], "party_id long, party_name string")})
    landed = land_tables(spark, src, "landing_norm", relations=["hz_parties"])
    assert sorted((r.party_id, r.party_name) for r in landed.hz_parties.collect()) == [(1, None), (2, "P")]


def test_landing_writes_bucketed_tables_with_same_rows(spark):
    src = derive_tables(spark, SF)
    names = ["ap_invoices_all", "ap_payment_schedules_all", "poz_suppliers_v"]
    landed = land_tables(spark, src, "landing_test", buckets=4, relations=names)
    for name in names:
        a = sorted(tuple(r) for r in src.table(name).collect())
        b = sorted(tuple(r) for r in landed.table(name).collect())
        assert a == b
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the sort-merge join
    try:
        j = landed.ap_invoices_all.join(landed.ap_payment_schedules_all, "invoice_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert "Exchange hashpartitioning" not in plan          # co-located: no shuffle for the join


def test_broadcast_only_under_the_size_limit(spark):
    small = spark.range(10)
    assert estimated_bytes(small) is not None and estimated_bytes(small) > 0
    hinted = broadcast_if_small(small)
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    same = broadcast_if_small(small, limit=1)
    assert "ResolvedHint" not in same._jdf.queryExecution().analyzed().toString()


def test_checkpoint_folder_is_set_in_local_mode(spark):
    assert ensure_checkpoint_dir(spark)
    df = spark.range(5).checkpoint(eager=True)
    assert df.count() == 5


def test_cluster_settings_scale_with_input():
    conf = cluster_conf(100, 1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024 * 1024 // 256
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(0.001, 10)["spark.sql.shuffle.partitions"]) == 120


def test_display_masks(spark):  # P18, P19
    df = spark.createDataFrame([(dec("1234567.125"), dt.date(2024, 2, 5)), (dec("-0.005"), dt.date(2024, 12, 25))],
                               "amt decimal(38,6), d date")
    got = [tuple(r) for r in df.select(money_text("amt"), date_display("d")).collect()]
    assert got == [("1,234,567.13", "5-Feb-24"), ("-0.01", "25-Dec-24")]
    assert F is not None


def test_grouped_facts_are_dealt_by_the_size_of_their_files(spark, tmp_path, monkeypatch):
    # tasks of the sums grow with the tables instead of the rows of a task; repeated and null orders count as before
    day = dt.datetime(1998, 1, 2)
    lines = [(k, k % 7, Decimal(k + n)) for k in range(200) for n in range(3)] + [(None, 1, Decimal(5))]
    orders = [(k, k % 11, day, "F") for k in range(200)] + [(7, 7, day, "F"), (8, 1, day, "O"), (None, 2, day, "F")]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_extendedprice decimal(18,2)").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderstatus string").write.parquet(
        str(tmp_path / "orders.parquet"))
    plain = sorted(map(str, derive.DriverTables(spark, str(tmp_path)).ap_invoices_all().collect()))
    monkeypatch.setattr(derive, "DEALT_FROM", 0)
    monkeypatch.setattr(derive, "PART_BYTES", 1 << 10)
    dealt = derive.DriverTables(spark, str(tmp_path)).ap_invoices_all()
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert int(re.search(r"hashpartitioning\(l_orderkey#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan).group(1)) > 4
    assert "ENSURE_REQUIREMENTS" not in plan  # the sums need no further exchange
    assert sorted(map(str, dealt.collect())) == plain and len(plain) == 201
