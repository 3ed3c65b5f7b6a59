"""Written reports keep their order: positions, files, and one folder per report date."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from statera import cli
from statera.operators.totals import total_order
from statera.sources import derive_tables
from statera.sources.schema import RELATIONS
from statera.sources.sink import with_position, write_report

SF = "/root/testdata/sf0.001"


def _rows(spark, n=4000):
    return spark.range(n).select((F.col("id") % 3).cast("int").alias("hot"), F.pmod(F.xxhash64("id"), F.lit(n)).alias("k"),
                                 F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("t")).repartition(7)


def test_positions_follow_the_order(spark):
    df = _rows(spark)
    order = [F.col("hot").desc(), F.col("t").asc_nulls_last(), F.col("k").asc_nulls_last()]
    got = [tuple(r) for r in with_position(df, order).collect()]
    want = [(*r, i + 1) for i, r in enumerate(df.orderBy(*order).collect())]
    assert got == want


def test_files_follow_the_positions(spark, tmp_path):
    df = _rows(spark)
    path = write_report(df, total_order(df, ["hot", "t"]), str(tmp_path / "out"))
    files = sorted(glob.glob(f"{path}/part-*.parquet"))
    assert len(files) > 1
    at = [r.position for f in files for r in spark.read.parquet(f).collect()]
    assert at == list(range(1, 4001))


def test_a_report_date_replaces_itself_alone(spark, tmp_path):
    df, out = _rows(spark, 50), str(tmp_path / "out")
    first, second = dt.date(2024, 1, 31), dt.date(2024, 2, 29)
    for date, n in ((first, 50), (second, 50), (first, 20)):
        write_report(df.where(F.col("k") >= 0).limit(n), total_order(df, ["k"]), out, report_date=date)
    counts = {r.report_date: r["count"] for r in spark.read.parquet(out).groupBy("report_date").count().collect()}
    assert counts == {first: 20, second: 50}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_cli_writes_in_order(spark, tmp_path):
    src = derive_tables(spark, SF)
    for name in RELATIONS:
        src.table(name).write.parquet(str(tmp_path / "finance" / name))
    out = str(tmp_path / "aging")
    assert cli.main(["aging-summary-total", "--tables", str(tmp_path / "finance"), "--as-on", "1998-06-30", "--out", out,
                     "--ordered", "--report-date", "1998-06-30"]) == 0
    rows = spark.read.parquet(out).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, len(rows) + 1)) and rows[-1].row_level == 2
    names = [r.vendor_name for r in rows[:-1]]
    assert names == sorted(names) and len(names) > 5 and str(rows[0].report_date) == "1998-06-30"
