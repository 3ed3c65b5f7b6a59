"""Payables aging: open invoice rows bucketed by age, in detail and per supplier.

The detail and the summary deliberately apply different rules (they do not reconcile):

=================================  ======  =======
rule                               detail  summary
=================================  ======  =======
payment status N or P              yes     no
open schedule amount <> 0          yes     no
cancelled invoices excluded        yes     no
supplier site must exist           yes     no
invoice type must be in lookup     no      yes
payment terms left-joined          no      yes
=================================  ======  =======

Plan shape: invoices, payment schedules and trial balances are all keyed by
``invoice_id``; they are joined on that key alone (the vendor equality of the trial
balance is a residual join condition), so the three large inputs share one hash
partitioning - or their common bucketing - and no second exchange is needed. Suppliers, sites, lookups and terms are
dimension tables: broadcast while their estimated size is under the threshold,
otherwise shuffled (AQE splits skewed supplier partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import days_outstanding, exact, nonzero_open_amount, nvl, optional_match, signed_balance
from ..params import DEFAULT_BUCKETS, INVOICE_TYPE_LOOKUP, OPEN_PAYMENT_STATUS, AgingParams, Bucket
from ..sources.tables import FinanceTables
from .joins import broadcast_if_small, join_fact, per_document
from .totals import LEVEL


def bucket_condition(days: Column, bucket: Bucket) -> Column:
    cond = F.lit(True)
    if bucket.lo is not None:
        cond = days > F.lit(bucket.lo)
    if bucket.hi is not None:
        upper = days <= F.lit(bucket.hi)
        cond = upper if bucket.lo is None else cond & upper
    return cond


def aging_buckets(df: DataFrame, days: str = "past_due_days", amount: str = "amt_due_remaining",
                  buckets: Sequence[Bucket] = DEFAULT_BUCKETS) -> DataFrame:
    """One column per bucket: the amount when the age falls in the bucket, else NULL.

    Buckets are half-open ``(lo, hi]`` ranges; with the default edges they are exclusive
    and exhaustive, so for a non-NULL age exactly one bucket carries the amount.
    """
    d = F.col(days)
    return df.select("*", *[F.when(bucket_condition(d, b), F.col(amount)).alias(b.name) for b in buckets])


def _vendors(t: FinanceTables, p: AgingParams) -> DataFrame:
    v = t.poz_suppliers_v.filter(optional_match("vendor_name", p.vendor_name)
                                 & optional_match("segment1", p.vendor_num))
    return broadcast_if_small(v.select("vendor_id", "vendor_name", "segment1"))


def with_trial_balance(df: DataFrame, t: FinanceTables) -> DataFrame:
    """Inner join on invoice and vendor."""
    return join_fact(t, df, "ap_trial_balances", t.ap_trial_balances.select(
        "invoice_id", "vendor_id", "accounted_dr", "accounted_cr"), ["invoice_id", "vendor_id"])


INVOICE_FACTS = ("ap_invoices_all", "ap_payment_schedules_all", "ap_trial_balances")


def aging_detail_rows(t: FinanceTables, p: AgingParams) -> DataFrame:
    """Open invoice x installment x trial-balance rows with age and signed balance."""
    return per_document(t, INVOICE_FACTS, "invoice_id", lambda part: _detail_rows(part, p))


def _detail_rows(t: FinanceTables, p: AgingParams) -> DataFrame:
    inv = t.in_months("ap_invoices_all", None, p.as_on).filter(
        F.col("payment_status_flag").isin(*OPEN_PAYMENT_STATUS)
        & (F.col("invoice_date") < F.lit(p.as_on))
        & F.col("cancelled_date").isNull()
    ).select("invoice_id", "vendor_id", "vendor_site_id", "invoice_num", "invoice_type_lookup_code",
             "invoice_date", "exchange_rate")
    ps = t.ap_payment_schedules_all.select("invoice_id", "amount_remaining")
    sites = broadcast_if_small(t.poz_supplier_sites_all_m.select("vendor_site_id"))
    # suppliers and sites first: with a supplier given, its few invoices meet the other facts
    j = (join_fact(t, inv.join(_vendors(t, p), "vendor_id").join(sites, "vendor_site_id"),
                   "ap_payment_schedules_all", ps, ["invoice_id"])
         .filter(nonzero_open_amount("amount_remaining", "exchange_rate")))
    j = with_trial_balance(j, t)
    return j.select(
        "vendor_name", F.col("segment1").alias("supp_no"), "invoice_num",
        F.col("invoice_type_lookup_code").alias("invoice_type"), "invoice_date",
        days_outstanding(p.as_on, "invoice_date").alias("past_due_days"),
        signed_balance("accounted_dr", "accounted_cr").alias("amt_due_remaining"))


def ap_aging_detail(t: FinanceTables, p: AgingParams) -> DataFrame:
    """One row per open invoice x installment x trial-balance row, with five buckets."""
    b = aging_buckets(aging_detail_rows(t, p), buckets=p.buckets)
    return b.select(
        "vendor_name", "supp_no", "invoice_num", F.lit(p.as_on).alias("_p_as_on_date"), "invoice_type",
        "invoice_date", exact(nvl("amt_due_remaining", 0)).alias("amt_due_remaining"),
        *[exact(nvl(x.name, 0)).alias(x.name) for x in p.buckets])


def aging_summary_rows(t: FinanceTables, p: AgingParams) -> DataFrame:
    return per_document(t, INVOICE_FACTS, "invoice_id", lambda part: _summary_rows(part, p))


def _summary_rows(t: FinanceTables, p: AgingParams) -> DataFrame:
    inv = t.in_months("ap_invoices_all", None, p.as_on).filter(F.col("invoice_date") < F.lit(p.as_on)).select(
        "invoice_id", "vendor_id", "invoice_type_lookup_code", "invoice_date", "terms_id")
    ps = t.ap_payment_schedules_all.select("invoice_id")
    lookup = broadcast_if_small(
        t.ap_lookup_codes.filter(F.col("lookup_type") == INVOICE_TYPE_LOOKUP)
        .select(F.col("lookup_code").alias("invoice_type_lookup_code")))
    terms = broadcast_if_small(t.ap_terms_val_v.select(F.col("term_id")))
    j = with_trial_balance(join_fact(t, inv.join(_vendors(t, p), "vendor_id"), "ap_payment_schedules_all", ps, ["invoice_id"]), t)
    j = j.join(lookup, "invoice_type_lookup_code").join(terms, F.col("terms_id") == F.col("term_id"), "left")
    return j.select(
        "vendor_name", F.col("segment1").alias("vendor_number"),
        days_outstanding(p.as_on, "invoice_date").alias("past_due_days"),
        signed_balance("accounted_dr", "accounted_cr").alias("amt_due_remaining"))


def _summary_sums(p: AgingParams) -> list[Column]:
    return [exact(nvl(F.sum("amt_due_remaining"), 0)).alias("total"),
            *[exact(nvl(F.sum(x.name), 0)).alias(x.name) for x in p.buckets]]


def ap_aging_summary(t: FinanceTables, p: AgingParams) -> DataFrame:
    """R2: aging per supplier name + number (not per vendor id), NULL sums shown as 0."""
    b = aging_buckets(aging_summary_rows(t, p), buckets=p.buckets)
    g = b.groupBy("vendor_name", "vendor_number").agg(*_summary_sums(p))
    return g.select("vendor_name", "vendor_number", F.lit(p.as_on).alias("as_on_date"), "total",
                    *[x.name for x in p.buckets])


def ap_aging_summary_with_total(t: FinanceTables, p: AgingParams) -> DataFrame:
    """R2 and one grand total (``row_level`` 2) in one aggregation over the grouping sets (name, number) and (),
    by level, name and number. The total of no rows is one row of NULL amounts."""
    b = aging_buckets(aging_summary_rows(t, p), buckets=p.buckets).withColumn("_row", F.lit(1))
    # a row that is in no sum: without it there would be no group for the total of no rows
    none = t.poz_suppliers_v.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in b.schema.fields])
    keys = [F.col("vendor_name"), F.col("vendor_number")]
    g = b.unionByName(none).groupingSets([keys, []], *keys).agg(
        F.when(F.grouping_id() == 0, 0).otherwise(2).alias(LEVEL), F.count("_row").alias("_rows"), *_summary_sums(p))
    g = g.filter((F.col("_rows") > 0) | (F.col(LEVEL) == 2))
    measures = [F.when(F.col("_rows") > 0, F.col(c)).alias(c) for c in ("total", *[x.name for x in p.buckets])]
    as_on = F.when(F.col(LEVEL) == 0, F.lit(p.as_on)).alias("as_on_date")
    return g.select("vendor_name", "vendor_number", as_on, *measures, LEVEL) \
        .orderBy(LEVEL, F.col("vendor_name").asc_nulls_last(), F.col("vendor_number").asc_nulls_last())
