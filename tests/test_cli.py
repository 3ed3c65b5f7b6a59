"""The command-line entry writes the same rows as the library call (parquet and csv sinks)."""

from __future__ import annotations

import datetime as dt

from statera import cli
from statera.params import AgingParams, PatientParams, G2
from statera.plans import reports
from statera.sources import FinanceTables, derive_tables
from statera.sources.schema import RELATIONS

SF = "/root/testdata/sf0.001"


def _export(spark, tmp_path):
    src = derive_tables(spark, SF)
    for name in RELATIONS:
        src.table(name).write.parquet(str(tmp_path / "finance" / name))
    return str(tmp_path / "finance")


def test_cli_reports_match_library(spark, tmp_path):
    root = _export(spark, tmp_path)
    out = str(tmp_path / "aging")
    assert cli.main(["aging-summary", "--tables", root, "--as-on", "1998-06-30", "--out", out]) == 0
    t = FinanceTables.from_parquet(spark, root)
    want = sorted(tuple(r) for r in reports.aging_summary(t, AgingParams(dt.date(1998, 6, 30))).collect())
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == want and len(got) > 0

    out = str(tmp_path / "patient")
    assert cli.main(["patient-statement", "--tables", root, "--from", "1998-01-01", "--to", "1998-06-30",
                     "--patient", "P7", "--variant", "G2", "--out", out, "--format", "csv"]) == 0
    p = PatientParams(dt.date(1998, 1, 1), dt.date(1998, 6, 30), "P7", options=G2)
    assert spark.read.option("header", True).csv(out).count() == reports.patient_account_statement(t, p).count()


def test_cli_arguments():
    args = cli.parser().parse_args(["supplier-statements", "--catalog", "fin", "--from", "2024-01-01",
                                    "--to", "2024-06-30", "--explain"])
    assert args.explain and args.supplier is None and args.from_date == dt.date(2024, 1, 1)
