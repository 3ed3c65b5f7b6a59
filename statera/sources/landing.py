"""Physical layout of the finance relations: bucketed parquet tables with statistics.

* **Buckets.** The facts are joined on their document id again and again (invoice x schedule x
  trial balance x distribution x payment on ``invoice_id``; receipt x application on
  ``cash_receipt_id``; transaction x line on ``customer_trx_id``). Writing them
  bucketed (and sorted) by that id with one bucket count lets Spark join them without
  a shuffle: both sides already hash-partitioned the same way. Dimension tables are
  written plainly; they are broadcast while small.
* **Second layouts.** Some facts are joined on two ids. They are written a second time, by the other one, and
  operators ask for the layout that their join needs (``FinanceTables.by``): applications also by
  transaction, invoice payments also by check, GL distributions by transaction (with its id, which they
  lack, taken from their lines).
* **Months.** Documents that statements select by a period are partitioned by the month of their day, which is a
  column of the files' folders only. ``FinanceTables.in_months`` reads the months of a period alone, so
  that a statement of one month lists and reads one month's files.
* **Hot documents.** A bucketed join is not split by AQE, so one document with a large part of a fact's rows would be one
  task. Landing counts the rows of each document; those with more than ``HOT_SHARE`` of a bucket's share are written
  beside the buckets, dealt evenly to files. ``operators.joins.per_document`` joins the other documents in place and
  these by a salted join.
* **Statistics.** Row counts and the distinct values, extremes and NULLs of the columns that jobs filter and join
  on, in the catalog. With them the optimizer (``spark.sql.cbo.enabled``, see ``session.DEFAULT_CONF``)
  estimates the documents of one supplier or patient as the few they are; they are broadcast to cut the facts in
  their scans, and no fact is shuffled for a statement of one account.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import RELATIONS
from .tables import MONTH, FinanceTables, empty_strings_as_null, hot_table, layout_table, month_of

BUCKET_KEYS: dict[str, str] = {
    "ap_invoices_all": "invoice_id",
    "ap_payment_schedules_all": "invoice_id",
    "ap_trial_balances": "invoice_id",
    "ap_invoice_distributions_all": "invoice_id",
    "ap_invoice_payments_all": "invoice_id",
    "ap_invoice_lines_all": "invoice_id",
    "ap_checks_all": "check_id",
    "ra_customer_trx_all": "customer_trx_id",
    "ra_customer_trx_lines_all": "customer_trx_id",
    "ar_cash_receipts_all": "cash_receipt_id",
    "ar_receivable_applications_all": "cash_receipt_id",
}

# second layouts: the other id that a relation is joined on
LAYOUT_KEYS: dict[str, str] = {
    "ar_receivable_applications_all": "applied_customer_trx_id",
    "ap_invoice_payments_all": "check_id",
    "ra_cust_trx_line_gl_dist_all": "customer_trx_id",
}

# relations partitioned by the month of a date
MONTH_OF: dict[str, str] = {
    "ap_invoices_all": "invoice_date",
    "iby_payments_all": "payment_date",
    "ra_customer_trx_all": "trx_date",
    "ar_cash_receipts_all": "receipt_date",
}

# a document is hot from this part of the rows that a bucket has on average; there are at most buckets / HOT_SHARE
HOT_SHARE = 0.5

# columns whose statistics decide plans: join keys, and what accounts, periods and states are selected by
STATISTICS = {
    "vendor_id", "vendor_site_id", "party_id", "party_name", "vendor_name", "segment1", "lookup_type", "lookup_code",
    "term_id", "terms_id", "invoice_id", "invoice_date", "payment_status_flag", "approval_status", "wfapproval_status",
    "cancelled_date", "check_id", "payment_id", "payment_date", "payment_status", "accounting_date", "line_type_lookup_code",
    "cust_account_id", "account_number", "customer_trx_id", "customer_trx_line_id", "trx_date", "bill_to_customer_id",
    "attribute_category", "attribute1", "line_type", "cash_receipt_id", "receipt_date", "pay_from_customer", "status",
    "applied_customer_trx_id", "from_currency", "to_currency", "conversion_date", "invoice_type_lookup_code",
}


def stage_driver_tables(spark: SparkSession, sf_dir: str, out_dir: str, files: int = 8,
                        names: Iterable[str] = ("supplier", "customer", "orders", "lineitem")) -> str:
    """Copy driver tables into ``files`` parquet files each, so that scans of a table
    stored as one row group run in parallel. Returns ``out_dir``."""
    import os
    for name in names:
        df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
        df.repartition(files).write.mode("overwrite").parquet(os.path.join(out_dir, f"{name}.parquet"))
    return out_dir


def _layout_rows(source: FinanceTables, name: str, key: str) -> DataFrame:
    """The rows of ``name`` with column ``key``, which GL distributions take from their lines."""
    df = source.table(name)
    if key in df.columns:
        return df
    owners = source.ra_customer_trx_lines_all.select("customer_trx_line_id", key).distinct()
    return df.join(owners, "customer_trx_line_id")


def _hot_ids(df: DataFrame, key: str, buckets: int, share: float) -> tuple[DataFrame | None, int]:
    """The documents of ``df`` that are hot, and in how many files their rows are half as many as a bucket's."""
    counts = df.groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.filter((F.col("count") > max(1.0, total * share / buckets)) & F.col(key).isNotNull()).collect()  # buckets / share at most
    if not hot:
        return None, 0
    ids = df.sparkSession.createDataFrame([(r[key],) for r in hot], T.StructType([T.StructField(key, df.schema[key].dataType)]))
    return ids, -(-2 * sum(r["count"] for r in hot) * buckets // total)


def land_tables(spark: SparkSession, source: FinanceTables, database: str = "default", buckets: int = 8,
                relations: Iterable[str] = RELATIONS, parallel: int = 4,
                location: str | None = None, normalize: bool = True,
                bucket_keys: Mapping[str, str | None] | None = None, layouts: bool = True,
                months: bool = True, statistics: bool = True, hot_share: float | None = None) -> FinanceTables:
    """Write every relation of ``source`` as a table of ``database`` (bucketed facts),
    and return FinanceTables reading them back from the catalog. With ``location`` the
    tables' files go to ``<location>/<relation>`` (e.g. a shared folder), otherwise to
    the catalog's warehouse. ``normalize`` writes '' as NULL (once, here), so readers
    need no per-read normalisation and keep their predicate pushdown. ``bucket_keys``
    overrides the bucketing keys (None: unbucketed, e.g. for a fact with a hot document).
    Rows are dealt to buckets before the write, so that each bucket is one sorted file (one per month).
    ``layouts``, ``months`` and ``statistics`` switch the second layouts, the partitions by month and the
    column statistics. With ``hot_share`` (e.g. ``HOT_SHARE``; costs a count per document) hot documents lie apart.

    Tables are independent, so up to ``parallel`` of them are written at the same
    time (Spark runs jobs submitted from several threads side by side and shares the
    executors between them).
    """
    from concurrent.futures import ThreadPoolExecutor

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = list(relations)
    # build the DataFrames on this thread (plan construction is not parallel)
    jobs = [(name, name, source.table(name), (bucket_keys or {}).get(name, BUCKET_KEYS.get(name))) for name in names]
    if layouts:
        jobs += [(layout_table(name, key), name, _layout_rows(source, name, key), key)
                 for name, key in LAYOUT_KEYS.items() if name in names]

    def write(job: tuple[str, str, DataFrame, str | None]) -> None:
        table, name, df, key = job
        df = empty_strings_as_null(df) if normalize else df
        by_month = months and name in MONTH_OF and table == name
        if by_month:
            df = df.withColumn(MONTH, month_of(F.col(MONTH_OF[name])))
        hot, files = _hot_ids(df, key, buckets, hot_share) if key and hot_share and table == name else (None, 0)
        if hot is not None:
            apart = df.join(F.broadcast(hot), key, "left_semi").repartition(files).write.mode("overwrite").format("parquet")
            if location:
                apart = apart.option("path", f"{location.rstrip('/')}/{hot_table(table)}")
            apart.saveAsTable(f"{database}.{hot_table(table)}")
            df = df.join(F.broadcast(hot), key, "left_anti")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{hot_table(table)}")
        if key:
            df = df.repartition(buckets, key)
        writer = df.write.mode("overwrite").format("parquet")
        if location:
            writer = writer.option("path", f"{location.rstrip('/')}/{table}")
        if by_month:
            writer = writer.partitionBy(MONTH)
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"{database}.{table}")
        if statistics:
            known = [c for c in df.columns if c in STATISTICS]
            spark.sql(f"ANALYZE TABLE {database}.{table} COMPUTE STATISTICS"
                      + (f" FOR COLUMNS {', '.join(known)}" if known else ""))

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for _ in pool.map(write, jobs):
            pass
    return FinanceTables.from_catalog(spark, database, normalize=False)
