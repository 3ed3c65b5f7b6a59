"""Finance relations derived from the driver's TPC-H-style tables.

The driver tables (supplier, customer, orders, lineitem) carry no payables or
receivables relations, so the test relations are derived from them deterministically
(specification in FIXTURES.md §1.2; the DuckDB oracle inlines the same derivation).
Every relation is a plain DataFrame plan over the driver parquet files, so its
work grows with the input and Catalyst prunes whatever a report does not read.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import FinanceTables


def _c(name: str) -> Column:
    return F.col(name)


def _money(name: str) -> Column:
    return _c(name).cast("decimal(18,2)")


def _frac(name: str) -> Column:
    return _c(name).cast("decimal(4,2)")


def _day(name: str) -> Column:
    return F.to_date(_c(name))


def _invoice_id() -> Column:
    return _c("l_orderkey") * F.lit(1000000) + _c("l_suppkey")


def _trx_line_id() -> Column:
    return ((_c("l_orderkey") * 10 + _c("l_linenumber")) * F.lit(100000) + _c("l_partkey")) * F.lit(10000) \
        + _c("l_suppkey")


def _case(key: Column, pairs: list[tuple[object, object]], default: object) -> Column:
    expr = None
    for k, v in pairs:
        v = v if isinstance(v, Column) else F.lit(v)
        expr = F.when(key == k, v) if expr is None else expr.when(key == k, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return expr.otherwise(d)


# Facts that are grouped by order are dealt to one task per this many bytes of their files, once these hold more than the second: about
# half a million lines a task, whatever the table's size. AQE would merge partitions up to its advisory size, which is of
# compressed bytes, and sorted keys compress to a few bytes a row while a row takes half a kilobyte in sorts and sums.
PART_BYTES, DEALT_FROM = 8 << 20, 64 << 20

_RAW_CACHE: dict[tuple[int, str], DataFrame] = {}


class DriverTables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        """Driver table as a lazy scan; the scan DataFrame (and its inferred schema) is
        reused within the session, so building a plan does not re-run schema inference."""
        path = os.path.join(self.sf_dir, f"{name}.parquet")
        key = (id(self.spark), os.path.abspath(path))
        df = _RAW_CACHE.get(key)
        if df is None or df.sparkSession is not self.spark:
            df = _RAW_CACHE[key] = self.spark.read.parquet(path)
        return df

    # ---- suppliers and parties -------------------------------------------------------
    def poz_suppliers_v(self) -> DataFrame:
        return self.raw("supplier").select(
            _c("s_suppkey").alias("vendor_id"), _c("s_name").alias("vendor_name"),
            _c("s_suppkey").cast("string").alias("segment1"),
            (F.lit(1000000000) + _c("s_suppkey")).alias("party_id"))

    def poz_suppliers(self) -> DataFrame:
        return self.poz_suppliers_v().select("vendor_id", "segment1", "party_id")

    def poz_supplier_sites_all_m(self) -> DataFrame:
        return self.raw("supplier").select((_c("s_suppkey") * 10 + 1).alias("vendor_site_id"),
                                           _c("s_suppkey").alias("vendor_id"))

    def hz_parties(self) -> DataFrame:
        sup = self.raw("supplier").select((F.lit(1000000000) + _c("s_suppkey")).alias("party_id"),
                                          _c("s_name").alias("party_name"))
        cus = self.raw("customer").select(_c("c_custkey").alias("party_id"), _c("c_name").alias("party_name"))
        return sup.unionAll(cus)

    # Fixed values of the test lookups (FIXTURES.md §1.2).
    def ap_lookup_codes(self) -> DataFrame:
        rows = [("INVOICE TYPE", "STANDARD"), ("INVOICE TYPE", "CREDIT"), ("INVOICE TYPE", "PREPAYMENT"),
                ("OTHER TYPE", "UNLISTED")]
        return self.spark.createDataFrame(rows, "lookup_type string, lookup_code string")

    def ap_terms_val_v(self) -> DataFrame:
        return self.spark.createDataFrame([(0, "IMMEDIATE"), (1, "NET30")], "term_id int, name string")

    # ---- payables ---------------------------------------------------------------------
    def _lines_orders(self) -> DataFrame:
        return self.raw("lineitem").join(self.raw("orders"), _c("l_orderkey") == _c("o_orderkey"))

    def _dealt_lines_orders(self) -> DataFrame:
        """``_lines_orders`` for sums by order: large tables in as many tasks as their size asks for."""
        from ..operators.joins import estimated_bytes  # which imports this package

        lines, orders = self.raw("lineitem"), self.raw("orders")
        sizes = [estimated_bytes(lines), estimated_bytes(orders)]
        if None in sizes or sum(sizes) <= DEALT_FROM:
            return self._lines_orders()
        parts = math.ceil(sum(sizes) / PART_BYTES)
        return lines.repartition(parts, "l_orderkey").join(
            orders.repartition(parts, "o_orderkey"), _c("l_orderkey") == _c("o_orderkey"))

    def ap_invoices_all(self) -> DataFrame:
        k = _c("l_orderkey")
        g = self._dealt_lines_orders().groupBy("l_orderkey", "l_suppkey", "o_custkey", "o_orderdate", "o_orderstatus")
        agg = g.agg(F.sum(_money("l_extendedprice")).alias("invoice_amount"))
        return agg.select(
            _invoice_id().alias("invoice_id"),
            _c("l_suppkey").alias("vendor_id"),
            F.when(k % 97 == 0, F.lit(None)).otherwise(_c("l_suppkey") * 10 + 1).alias("vendor_site_id"),
            F.concat(F.lit("INV-"), _invoice_id().cast("string")).alias("invoice_num"),
            _case(k % 5, [(0, "CREDIT"), (1, "PREPAYMENT"), (2, "UNLISTED")], "STANDARD")
            .alias("invoice_type_lookup_code"),
            F.concat(F.lit("PATIENT "), _c("o_custkey").cast("string")).alias("description"),
            _day("o_orderdate").alias("invoice_date"),
            F.lit("KES").alias("invoice_currency_code"),
            F.when(k % 3 == 0, F.lit(None)).otherwise(F.lit(1.25).cast("decimal(10,4)")).alias("exchange_rate"),
            _c("invoice_amount"),
            F.when(k % 4 == 0, F.lit(None)).otherwise(k % 3).alias("terms_id"),
            _case(_c("o_orderstatus"), [("O", "N"), ("P", "P")], "Y").alias("payment_status_flag"),
            F.when(k % 50 == 0, _day("o_orderdate")).alias("cancelled_date"),
            _case(k % 10, [(0, "NEEDS REAPPROVAL"), (1, "AVAILABLE")], "APPROVED").alias("approval_status"),
            _case(k % 7, [(0, "REJECTED"), (1, "NOT REQUIRED"), (2, "MANUALLY APPROVED")], "WFAPPROVED")
            .alias("wfapproval_status"))

    def ap_payment_schedules_all(self) -> DataFrame:
        return self._lines_orders().select(
            _invoice_id().alias("invoice_id"),
            F.date_add(_day("o_orderdate"), 30).alias("due_date"),
            F.when(_c("l_linestatus") == "F", F.lit(0).cast("decimal(18,2)"))
            .otherwise(_money("l_extendedprice")).alias("amount_remaining"))

    def ap_trial_balances(self) -> DataFrame:
        agg = self.raw("lineitem").groupBy("l_orderkey", "l_suppkey").agg(
            F.sum(_money("l_extendedprice") * _frac("l_discount")).alias("dr"),
            F.sum(_money("l_extendedprice")).alias("accounted_cr"))
        return agg.select(
            _invoice_id().alias("invoice_id"), _c("l_suppkey").alias("vendor_id"),
            F.when(_c("l_orderkey") % 11 == 0, F.lit(None)).otherwise(_c("dr")).alias("accounted_dr"),
            "accounted_cr")

    def ap_invoice_distributions_all(self) -> DataFrame:
        return self.raw("lineitem").select(
            _invoice_id().alias("invoice_id"), _money("l_extendedprice").alias("amount"),
            _day("l_shipdate").alias("accounting_date"))

    def ap_invoice_payments_all(self) -> DataFrame:
        li = self.raw("lineitem").filter(_c("l_returnflag") != "N")
        return li.select(
            _invoice_id().alias("invoice_id"), _c("l_orderkey").alias("check_id"),
            (_money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - _frac("l_discount"))).alias("amount"),
            F.when(_c("l_discount") == 0, F.lit(None))
            .otherwise(_money("l_extendedprice") * _frac("l_discount")).alias("discount_taken"),
            F.date_add(_day("l_shipdate"), 15).alias("accounting_date"))

    def ap_invoice_lines_all(self) -> DataFrame:
        n = _c("l_linenumber") % 3
        tax = _money("l_extendedprice") * _frac("l_tax")
        return self.raw("lineitem").select(
            _invoice_id().alias("invoice_id"),
            _case(n, [(0, "TAX"), (1, "AWT")], "ITEM").alias("line_type_lookup_code"),
            F.when(n == 1, -tax).otherwise(tax).alias("amount"))

    def ap_checks_all(self) -> DataFrame:
        lo = self._dealt_lines_orders().filter(_c("o_orderstatus") != "O")
        return lo.groupBy("o_orderkey").agg(F.min("l_suppkey").alias("vendor_id")).select(
            _c("o_orderkey").alias("check_id"), _c("o_orderkey").alias("payment_id"), "vendor_id",
            F.lit("KES").alias("currency_code"))

    def iby_payments_all(self) -> DataFrame:
        o = self.raw("orders").filter(_c("o_orderstatus") != "O")
        k = _c("o_orderkey")
        return o.select(
            k.alias("payment_id"), (F.lit(500000) + k).alias("payment_reference_number"),
            F.date_add(_day("o_orderdate"), 20).alias("payment_date"),
            _money("o_totalprice").alias("payment_amount"),
            _case(k % 13, [(0, "VOID"), (1, "VOID_BY_OVERFLOW"), (2, None)], "ISSUED").alias("payment_status"))

    # ---- receivables ------------------------------------------------------------------
    def hz_cust_accounts(self) -> DataFrame:
        return self.raw("customer").select(
            _c("c_custkey").alias("cust_account_id"), _c("c_custkey").alias("party_id"),
            F.concat(F.lit("AC"), _c("c_custkey").cast("string")).alias("account_number"))

    def ra_customer_trx_all(self) -> DataFrame:
        k = _c("o_orderkey")
        patient = (_c("o_custkey") % 20).cast("string")
        return self.raw("orders").select(
            k.alias("customer_trx_id"), F.concat(F.lit("TRX"), k.cast("string")).alias("trx_number"),
            _day("o_orderdate").alias("trx_date"), _c("o_custkey").alias("bill_to_customer_id"),
            _case(k % 4, [(0, "USD"), (1, "EUR")], "KES").alias("invoice_currency_code"),
            _case(k % 5, [(0, "OTHER"), (1, None)], "PATIENT AND SPONSER DETAILS").alias("attribute_category"),
            F.concat(F.lit("P"), patient).alias("attribute1"),
            F.concat(F.lit("PATIENT "), patient).alias("attribute2"),
            _c("o_orderpriority").alias("attribute12"))

    def ra_customer_trx_lines_all(self) -> DataFrame:
        return self.raw("lineitem").select(
            _trx_line_id().alias("customer_trx_line_id"), _c("l_orderkey").alias("customer_trx_id"),
            F.when(_c("l_linestatus") == "O", "LINE").otherwise("TAX").alias("line_type"),
            _money("l_extendedprice").alias("extended_amount"))

    def ra_cust_trx_line_gl_dist_all(self) -> DataFrame:
        li = self.raw("lineitem")
        one = li.select(_trx_line_id().alias("customer_trx_line_id"), _day("l_shipdate").alias("gl_date"))
        two = li.filter(_c("l_linenumber") == 7).select(
            _trx_line_id().alias("customer_trx_line_id"), _day("l_shipdate").alias("gl_date"))
        return one.unionAll(two)

    def ar_cash_receipts_all(self) -> DataFrame:
        o = self.raw("orders").filter(_c("o_orderstatus") != "O")
        k = _c("o_orderkey")
        return o.select(
            k.alias("cash_receipt_id"),
            F.concat(F.when(k % 3 == 0, "DR").otherwise("RC"), k.cast("string")).alias("receipt_number"),
            F.date_add(_day("o_orderdate"), 10).alias("receipt_date"),
            _case(k % 6, [(0, "USD"), (1, "EUR")], "KES").alias("currency_code"),
            F.when(k % 29 == 0, F.lit(0).cast("decimal(18,2)")).otherwise(_money("o_totalprice")).alias("amount"),
            F.when(k % 31 == 0, F.lit(None)).otherwise(_c("o_custkey")).alias("pay_from_customer"),
            F.when(k % 17 == 0, "REV").when(k % 19 == 0, F.lit(None)).otherwise("APP").alias("status"),
            F.concat(F.lit("P"), (_c("o_custkey") % 20).cast("string")).alias("attribute1"))

    def ar_receivable_applications_all(self) -> DataFrame:
        lo = self._dealt_lines_orders().filter(_c("o_orderstatus") != "O")
        unapplied = _c("l_returnflag") == "N"
        return lo.select(
            _c("l_orderkey").alias("cash_receipt_id"),
            F.when(unapplied, F.lit(None)).otherwise(_c("l_orderkey")).alias("applied_customer_trx_id"),
            F.when(unapplied, "UNAPP").otherwise("APP").alias("status"),
            _money("l_extendedprice").alias("amount_applied"),
            _day("l_shipdate").alias("gl_date"))

    def gl_daily_rates(self) -> DataFrame:
        o = self.raw("orders")
        days = o.select(_day("o_orderdate").alias("conversion_date")).unionAll(
            o.select(F.date_add(_day("o_orderdate"), 10).alias("conversion_date"))).distinct()
        days = days.filter(F.dayofmonth("conversion_date") != 13)
        # Fixed values of the test rates: base per currency, plus month, plus a quarter per day.
        per_currency = []
        for currency, base in (("USD", 100), ("EUR", 120)):
            rate = (F.lit(base) + F.month("conversion_date")
                    + F.dayofmonth("conversion_date") * F.lit(0.25).cast("decimal(4,2)")).cast("decimal(10,4)")
            per_currency.append(days.select("conversion_date", F.lit(currency).alias("from_currency"),
                                            F.lit("KES").alias("to_currency"), rate.alias("conversion_rate")))
        return per_currency[0].unionAll(per_currency[1])

    def relation(self, name: str) -> DataFrame:
        return getattr(self, name)()


_TABLES_CACHE: dict[tuple[int, str], tuple[SparkSession, FinanceTables]] = {}


def derive_tables(spark: SparkSession, sf_dir: str) -> FinanceTables:
    """FinanceTables whose relations are derived from the driver tables in ``sf_dir``.

    The relations are lazy plans, so one FinanceTables per session and folder is shared
    by every query (each relation's plan is built once)."""
    key = (id(spark), os.path.abspath(sf_dir))
    hit = _TABLES_CACHE.get(key)
    if hit is None or hit[0] is not spark:
        hit = _TABLES_CACHE[key] = (spark, FinanceTables(DriverTables(spark, sf_dir).relation))
    return hit[1]
