"""Run a report on finance tables and write the result.

    python -m statera.cli aging-detail --tables /lake/finance --as-on 2024-06-30 --out /lake/out/aging
    python -m statera.cli supplier-statement --catalog fin --from 2024-01-01 --to 2024-06-30 \\
        --supplier "ACME" --out /lake/out/acme --format csv
    python -m statera.cli patient-statement --tables /lake/finance --from 2024-01-01 --to 2024-12-31 \\
        --patient P7 --variant G2 --out /lake/out/p7

Tables come from ``--tables`` (one parquet folder per relation) or ``--catalog``
(a database of tables). The result is written by Spark's writers (parquet, csv,
json or orc) to ``--out``; ``--ordered`` adds each row's position in the report and writes the files in that
order, ``--report-date`` replaces the folder of that date alone. With ``--show N`` the first rows are printed instead, with
``--explain`` the formatted physical plan.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from .params import G1, G2, AgingParams, FxConfig, PatientParams, SiteCodes, StatementParams
from .plans import reports

AGING = {
    "aging-detail": reports.aging_detail,
    "aging-summary": reports.aging_summary,
    "aging-detail-subtotals": reports.aging_detail_with_subtotals,
    "aging-detail-total": reports.aging_detail_with_grand_total,
    "aging-summary-total": reports.aging_summary_with_grand_total,
}
STATEMENTS = {
    "supplier-statement": reports.supplier_account_statement,
    "supplier-statements": reports.supplier_account_statements,
}


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="statera", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("report", choices=[*AGING, *STATEMENTS, "patient-statement"])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with one parquet folder per relation")
    src.add_argument("--catalog", help="database holding the relations as tables")
    ap.add_argument("--as-on", type=_date, help="aging: as-on date")
    ap.add_argument("--vendor-name")
    ap.add_argument("--vendor-num")
    ap.add_argument("--from", dest="from_date", type=_date)
    ap.add_argument("--to", dest="to_date", type=_date)
    ap.add_argument("--supplier", help="supplier statement: supplier name")
    ap.add_argument("--patient", help="patient statement: patient id (omit for every patient)")
    ap.add_argument("--party", help="patient statement G1: keep only this party name")
    ap.add_argument("--variant", choices=["G1", "G2"], default="G1")
    ap.add_argument("--functional-currency", default="KES")
    site = SiteCodes()
    ap.add_argument("--patient-context", default=site.patient_context, help="flexfield context of patient documents")
    ap.add_argument("--other-documents", default=site.other_documents, help="value that stands for other documents")
    ap.add_argument("--deposit-prefix", default=site.deposit_prefix, help="prefix of deposit receipts' numbers")
    ap.add_argument("--out")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    ap.add_argument("--ordered", action="store_true", help="add the column position, and write files in the report's order")
    ap.add_argument("--report-date", type=_date, help="write to <out>/report_date=<date>, replacing what is there")
    ap.add_argument("--show", type=int, default=0)
    ap.add_argument("--explain", action="store_true",
                    help="print the formatted physical plan (pushed filters, exchanges) instead of running")
    ap.add_argument("--master", default=None, help="Spark master (default: the environment's)")
    ap.add_argument("--executors", type=int, default=0, help="size shuffles for a cluster of so many executors")
    ap.add_argument("--executor-cores", type=int, default=4)
    ap.add_argument("--shuffled-tb", type=float, default=1.0,
                    help="TB that the report's largest shuffle moves, after pruning (not TB scanned)")
    ap.add_argument("--empty-strings-as-null", action="store_true",
                    help="read '' as NULL (for tables not normalised when landed; disables string pushdown)")
    return ap


def parameters(args) -> AgingParams | StatementParams | PatientParams:
    if args.report in AGING:
        if args.as_on is None:
            raise SystemExit("--as-on is required for aging reports")
        return AgingParams(args.as_on, args.vendor_name, args.vendor_num)
    if args.from_date is None or args.to_date is None:
        raise SystemExit("--from and --to are required for statements")
    if args.report in STATEMENTS:
        if args.report == "supplier-statement" and not args.supplier:
            raise SystemExit("--supplier is required (or use supplier-statements for all)")
        return StatementParams(args.from_date, args.to_date, args.supplier)
    return PatientParams(args.from_date, args.to_date, args.patient, party_name=args.party,
                         options=G1 if args.variant == "G1" else G2, fx=FxConfig(args.functional_currency),
                         site=SiteCodes(args.patient_context, args.other_documents, args.deposit_prefix))


def build(args, tables):
    report = {**AGING, **STATEMENTS}.get(args.report, reports.patient_account_statement)
    return report(tables, parameters(args))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from .session import DEFAULT_CONF, cluster_conf, ensure_checkpoint_dir
    from .sources import FinanceTables
    from .sources.sink import write_report

    builder = SparkSession.builder.appName(f"statera-{args.report}")
    if args.master:
        builder = builder.master(args.master)
    conf = dict(DEFAULT_CONF)
    if args.executors:
        conf.update(cluster_conf(args.shuffled_tb, args.executors, args.executor_cores))
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    norm = args.empty_strings_as_null
    tables = (FinanceTables.from_parquet(spark, args.tables, normalize=norm) if args.tables
              else FinanceTables.from_catalog(spark, args.catalog, normalize=norm))
    df = build(args, tables)
    if args.explain:
        df.explain("formatted")
        return 0
    if args.show:
        df.show(args.show, truncate=False)
        return 0
    if not args.out:
        raise SystemExit("--out or --show is required")
    if args.ordered:
        write_report(df, reports.order_of(args.report, df, parameters(args)), args.out, args.format, args.report_date)
        return 0
    out = args.out.rstrip("/") + (f"/report_date={args.report_date.isoformat()}" if args.report_date else "")
    writer = df.write.mode("overwrite").format(args.format)
    if args.format == "csv":
        writer = writer.option("header", "true")
    writer.save(out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
