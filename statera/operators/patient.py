"""Patient (customer) account statement: invoices, applied receipts and wholly
unapplied receipts in one ledger, converted to the functional currency.

The two datasets of the reference (``G1``/``G2``) differ only in filters, the date
mask and the order; ``PatientOptions`` carries those differences.

Plan shape: each branch starts from the rows selected by the patient (the
transaction flexfield or the receipt attribute), so the selective filter sits at
the first scan and the large fact joins (lines, distributions, applications) only
carry that patient's rows. Per-invoice and per-receipt applied totals are grouped
once and left-joined (the reference's correlated subqueries), restricted with a
size-checked semi join to the documents in scope. Branch rows are grouped by
document *number* and attributes, never by id, exactly as the reference groups.

Statements of every patient have nothing selective to start from: there the facts meet in narrow rows, each
document's are summed where they lie, and accounts and parties, joined to each other, come last. The
rows then travel once, by payer and document number, to be grouped and made distinct.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (date_text, day_between, exact, flexfield, flexfield_matches, flexfield_or_sentinel, nvl,
                         receipt_class)
from ..params import STATUS_APPLIED, STATUS_REVERSED, STATUS_UNAPPLIED, PatientParams
from ..sources.tables import FinanceTables
from .fx import applied_to_functional, exchange_rate, rate, rate_table, to_functional, with_rate
from .joins import estimated_bytes, restrict_to
from .totals import total_order

OUTPUT_COLUMNS = ("party_name", "customer_number", "invoice_number", "transaction_date", "gl_date",
                  "transaction_currency", "transaction_type", "transaction_original_amount", "functional_currency",
                  "transaction_applied_amount", "functional_original_amount", "transaction_remaining_amount",
                  "functional_remaining_amount", "exchange_rate", "patient_id", "patient_name", "plan_name")
MONEY_OUTPUT = ("transaction_original_amount", "transaction_applied_amount", "functional_original_amount",
                "transaction_remaining_amount", "functional_remaining_amount", "exchange_rate")


def _accounts_parties(t: FinanceTables) -> tuple[DataFrame, DataFrame]:
    acc = t.hz_cust_accounts.select("cust_account_id", "party_id", "account_number")
    par = t.hz_parties.select("party_id", "party_name")
    return acc, par


def _semi(df: DataFrame, keys: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return restrict_to(df, keys, left_key, right_key)


SELECTOR = "selector_id"


def _select(df: DataFrame, p: PatientParams, attribute: str, category: str | None = None,
            sentinel: bool = False) -> DataFrame:
    """Keep the rows the patient selects and carry the selecting value as ``selector_id``.

    The selecting value is ``attribute`` itself (receipts) or the flexfield
    ``CASE WHEN category = context THEN attribute [ELSE sentinel] END`` (transactions).
    One patient: the test is written as plain column predicates
    (``functions.flexfield_matches``) so it is pushed into the scan. With
    ``p.patient_id`` None every patient is reported in one run: rows are kept when their
    selecting value exists, and ``selector_id`` (which can differ from the shown
    ``patient_id``: receipts are selected by their invoice) tells the statements apart;
    filtering that result by one ``selector_id`` gives exactly the one-patient run.
    """
    if category is None:
        selector = F.col(attribute)
    else:
        context, other = p.site.patient_context, p.site.other_documents
        selector = flexfield_or_sentinel(category, attribute, context, other) if sentinel else flexfield(category, attribute, context)
    if p.patient_id is None:
        return df.withColumn(SELECTOR, selector).filter(F.col(SELECTOR).isNotNull())
    if category is None:
        test = F.col(attribute) == F.lit(p.patient_id)
    else:
        test = flexfield_matches(category, attribute, p.patient_id, p.site.patient_context,
                                 p.site.other_documents if sentinel else None)
    return df.filter(test).withColumn(SELECTOR, F.lit(p.patient_id))


def _single(p: PatientParams) -> bool:
    return p.patient_id is not None


def _with_payer(df: DataFrame, t: FinanceTables, account: str) -> DataFrame:
    """Statements of every patient: ``df`` with the accounts ``account`` and their parties; ``_copies`` is the number of
    payers of an account that are equal (more than one if ids repeat)."""
    acc, par = _accounts_parties(t)
    equal = Window.partitionBy("cust_account_id").orderBy("account_number", "party_name").rangeBetween(
        Window.currentRow, Window.currentRow)
    payers = acc.join(par, "party_id").select("cust_account_id", "account_number", "party_name",
                                              F.count(F.lit(1)).over(equal).alias("_copies"))
    return df.join(payers, F.col(account) == F.col("cust_account_id"))


GROUPED_BYTES = 2 << 20  # of transaction lines, about 150,000, to a task that groups documents
MAX_GROUPS = 20_000  # tasks
UNKNOWN_BYTES = 1 << 50  # the planner takes tables without statistics to be larger


def _by_document(df: DataFrame, t: FinanceTables, p: PatientParams, number: str) -> DataFrame:
    """Statements of every patient: rows dealt by payer and document number, which all branches and the distinct union
    group by, so that none of them needs an exchange of its own."""
    if _single(p):
        return df
    size = estimated_bytes(t.ra_customer_trx_lines_all)
    if size is None or size >= UNKNOWN_BYTES:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    else:
        parts = min(max(math.ceil(size / GROUPED_BYTES), 1), MAX_GROUPS)
    return df.repartition(parts, "party_name", "customer_number", number)


def _finish(df: DataFrame, p: PatientParams) -> DataFrame:
    extra = [] if _single(p) else [F.col(SELECTOR)]
    return df.select(*[exact(c).alias(c) if c in MONEY_OUTPUT else F.col(c) for c in OUTPUT_COLUMNS], *extra)


# ---- invoices ------------------------------------------------------------------------------

def trx_applied_total(t: FinanceTables, p: PatientParams, invoices: DataFrame | None = None) -> DataFrame:
    """A5: applied receipt amount per invoice (keys bill-to, party name, trx, account).
    G2 counts only invoices dated in the period."""
    app = t.by("ar_receivable_applications_all", "applied_customer_trx_id").filter(F.col("status") == STATUS_APPLIED).select(
        "cash_receipt_id", "applied_customer_trx_id", "amount_applied")
    if invoices is not None:
        app = _semi(app, invoices, "applied_customer_trx_id", "customer_trx_id")
    in_period = p.options.applied_total_in_period
    trx1 = t.in_months("ra_customer_trx_all", p.from_date, p.to_date) if in_period else t.ra_customer_trx_all
    trx1 = trx1.select("customer_trx_id", "bill_to_customer_id", "trx_date")
    if in_period:
        trx1 = trx1.filter(day_between("trx_date", p.from_date, p.to_date))
    acc, par = _accounts_parties(t)
    j = (app.join(t.ar_cash_receipts_all.select("cash_receipt_id"), "cash_receipt_id")
         .join(trx1, F.col("applied_customer_trx_id") == F.col("customer_trx_id"))
         .join(acc, F.col("bill_to_customer_id") == F.col("cust_account_id"))
         .join(par, "party_id"))
    return j.groupBy("bill_to_customer_id", "party_name", "customer_trx_id", "account_number").agg(
        F.sum("amount_applied").alias("total_applied_amount"))


def invoice_rows(t: FinanceTables, p: PatientParams) -> DataFrame:
    """Invoice lines x GL distributions of the patient's invoices with applied totals and
    functional amounts, before grouping."""
    fx = p.fx
    j = _patient_invoice_lines(t, p) if _single(p) else _all_invoice_lines(t, p)
    j = with_rate(j, rate_table(t, fx), "invoice_currency_code", "trx_date", "inv")
    return j.select(
        "party_name", F.col("account_number").alias("customer_number"),
        F.col("trx_number").alias("invoice_number"), F.col("trx_date").alias("transaction_date"), "gl_date",
        F.col("invoice_currency_code").alias("currency"), F.lit("INV").alias("transaction_type"),
        F.col("extended_amount").alias("transaction_original_amount"),
        F.lit(fx.functional_currency).alias("functional_currency"),
        nvl("total_applied_amount", 0).alias("applied_amount"),
        exchange_rate("invoice_currency_code", "inv", fx).alias("exchange_rate"),
        F.when(F.col("invoice_currency_code") == F.lit(fx.functional_currency), nvl("total_applied_amount", 0))
        .otherwise(F.col("total_applied_amount") * rate("inv", fx.mode)).alias("functional_applied_amount"),
        to_functional("extended_amount", "invoice_currency_code", "inv", fx).alias("functional_original_amount"),
        flexfield("attribute_category", "attribute1", p.site.patient_context).alias("patient_id"),
        flexfield("attribute_category", "attribute2", p.site.patient_context).alias("patient_name"),
        flexfield("attribute_category", "attribute12", p.site.patient_context).alias("plan_name"), SELECTOR)


def _invoice_facts(t: FinanceTables) -> tuple[DataFrame, DataFrame, list[str]]:
    """Lines, GL distributions, and the columns they are joined on."""
    lines = t.ra_customer_trx_lines_all.filter(F.col("line_type") == "LINE").select(
        "customer_trx_line_id", "customer_trx_id", "extended_amount")
    # with the transaction's id, all three are joined on it where they lie
    gl = t.by("ra_cust_trx_line_gl_dist_all", "customer_trx_id")
    on_line = [c for c in ("customer_trx_id", "customer_trx_line_id") if c in gl.columns]
    return lines, gl.select(*on_line, "gl_date"), on_line


TRX_COLUMNS = ("customer_trx_id", "trx_number", "trx_date", "bill_to_customer_id", "invoice_currency_code",
               "attribute_category", "attribute1", "attribute2", "attribute12", SELECTOR)


def _patient_invoice_lines(t: FinanceTables, p: PatientParams) -> DataFrame:
    in_period = p.options.invoice_period_on_trx_date
    trx = t.in_months("ra_customer_trx_all", p.from_date, p.to_date) if in_period else t.ra_customer_trx_all
    trx = _select(trx, p, "attribute1", "attribute_category", sentinel=True)
    if in_period:
        trx = trx.filter(F.col("trx_date").between(F.lit(p.from_date), F.lit(p.to_date)))
    trx = trx.select(*TRX_COLUMNS)
    acc, par = _accounts_parties(t)
    lines, gl, on_line = _invoice_facts(t)
    return (trx.join(lines, "customer_trx_id").join(gl, on_line)
            .join(acc, F.col("bill_to_customer_id") == F.col("cust_account_id"))
            .join(par, "party_id")
            .join(trx_applied_total(t, p, trx),
                  ["account_number", "customer_trx_id", "bill_to_customer_id", "party_name"], "left"))


def _all_invoice_lines(t: FinanceTables, p: PatientParams) -> DataFrame:
    """The lines of every patient's invoices with their applied totals (``trx_applied_total``). The total of a
    transaction, account and party is that of the transaction's applications, times the transactions of that id and
    account, times the equal payers: all known without bringing the names to the applications."""
    in_total = day_between("trx_date", p.from_date, p.to_date) if p.options.applied_total_in_period else F.lit(True)
    same_bill = Window.partitionBy("customer_trx_id").orderBy("bill_to_customer_id").rangeBetween(
        Window.currentRow, Window.currentRow)
    trx = t.ra_customer_trx_all.filter(F.col("customer_trx_id").isNotNull()).withColumn(
        "_bills", F.count(F.when(in_total, 1)).over(same_bill))
    trx = _select(trx, p, "attribute1", "attribute_category", sentinel=True)
    if p.options.invoice_period_on_trx_date:
        trx = trx.filter(F.col("trx_date").between(F.lit(p.from_date), F.lit(p.to_date)))
    per_receipt = t.ar_receivable_applications_all.filter(F.col("status") == STATUS_APPLIED).groupBy(
        "cash_receipt_id", "applied_customer_trx_id").agg(F.sum("amount_applied").alias("_applied"))
    applied = per_receipt.join(t.ar_cash_receipts_all.select("cash_receipt_id"), "cash_receipt_id").groupBy(
        F.col("applied_customer_trx_id").alias("customer_trx_id")).agg(F.sum("_applied").alias("_applied"))
    kind = per_receipt.schema["_applied"].dataType
    lines, gl, on_line = _invoice_facts(t)
    j = trx.select(*TRX_COLUMNS, "_bills").join(applied, "customer_trx_id", "left").join(lines.join(gl, on_line), "customer_trx_id")
    known = (F.col("_bills") > 0) & F.col("account_number").isNotNull() & F.col("party_name").isNotNull()
    return _with_payer(j, t, "bill_to_customer_id").withColumn(
        "total_applied_amount", F.when(known, (F.col("_applied") * (F.col("_bills") * F.col("_copies"))).cast(kind)))


def invoice_branch(t: FinanceTables, p: PatientParams) -> DataFrame:
    """Invoice rows grouped by the 14 keys (number, dates, currency, rate, patient
    attributes, applied amounts); original amounts summed."""
    keys = ["party_name", "customer_number", "invoice_number", "transaction_date", "gl_date", "currency",
            "transaction_type", "functional_currency", "exchange_rate", "patient_id", "patient_name", "plan_name",
            "applied_amount", "functional_applied_amount", SELECTOR]
    g = _by_document(invoice_rows(t, p), t, p, "invoice_number").groupBy(*keys).agg(
        F.sum("transaction_original_amount").alias("toa"), F.sum("functional_original_amount").alias("foa"))
    mask = p.options.date_mask
    return _finish(g.select(
        "party_name", "customer_number", "invoice_number",
        date_text("transaction_date", mask).alias("transaction_date"), date_text("gl_date", mask).alias("gl_date"),
        F.col("currency").alias("transaction_currency"), "transaction_type",
        F.col("toa").alias("transaction_original_amount"), "functional_currency",
        F.col("applied_amount").alias("transaction_applied_amount"),
        F.col("foa").alias("functional_original_amount"),
        F.col("functional_applied_amount").alias("transaction_remaining_amount"),
        (F.col("foa") - F.col("functional_applied_amount")).alias("functional_remaining_amount"),
        "exchange_rate", "patient_id", "patient_name", "plan_name", SELECTOR), p)


# ---- receipts -----------------------------------------------------------------------------

RECEIPT_KEYS = ["party_name", "customer_number", "receipt_number", "receipt_date", "currency", "transaction_type",
                "transaction_amount", "functional_currency", "functional_original_amount", "exchange_rate",
                "patient_id", "patient_name", "plan_name", SELECTOR]


def _receipts(t: FinanceTables, p: PatientParams, in_period: bool) -> DataFrame:
    rc = t.in_months("ar_cash_receipts_all", p.from_date, p.to_date) if in_period else t.ar_cash_receipts_all
    rc = rc.filter(F.col("status") != STATUS_REVERSED)
    if in_period:
        rc = rc.filter(day_between("receipt_date", p.from_date, p.to_date))
    rc = rc.select("cash_receipt_id", "receipt_number", "receipt_date", "currency_code", "amount",
                   "pay_from_customer", F.col("attribute1").alias("receipt_attribute1"))
    if not _single(p):
        return rc  # the payer comes last
    acc, par = _accounts_parties(t)
    # The outer join to the account is cancelled by the inner join to its party.
    return (rc.join(acc, F.col("pay_from_customer") == F.col("cust_account_id"))
            .join(par, "party_id"))


def _receipt_columns(p: PatientParams, functional_applied: Column, functional_original: Column, rate_col: Column) -> list:
    return [
        "party_name", F.col("account_number").alias("customer_number"), "receipt_number", "receipt_date", "gl_date",
        F.col("currency_code").alias("currency"), F.col("amount").alias("transaction_amount"),
        F.lit(p.fx.functional_currency).alias("functional_currency"), rate_col.alias("exchange_rate"),
        receipt_class("receipt_number", p.site.deposit_prefix).alias("transaction_type"),
        F.col("amount_applied").alias("transaction_applied_amount"),
        functional_applied.alias("functional_applied_amount"),
        functional_original.alias("functional_original_amount"),
        F.col("receipt_attribute1").alias("patient_id"),
        F.lit(None).cast("string").alias("patient_name"), F.lit(None).cast("string").alias("plan_name"), SELECTOR]


def _application_sums(t: FinanceTables, p: PatientParams, status: str) -> DataFrame:
    """Statements of every patient: applications summed per receipt and transaction, with their number and, as text, the
    latest GL date; conversion is by receipt and transaction, so that it can follow the sum."""
    return t.ar_receivable_applications_all.filter(F.col("status") == status).groupBy(
        "cash_receipt_id", "applied_customer_trx_id").agg(
        F.sum("amount_applied").alias("amount_applied"), F.count(F.lit(1)).alias("_applications"),
        F.max(date_text("gl_date", p.options.date_mask)).alias("gl_date"))


def _gl_text(p: PatientParams) -> Column:
    return date_text("gl_date", p.options.date_mask) if _single(p) else F.col("gl_date")


def receipt_rows(t: FinanceTables, p: PatientParams) -> DataFrame:
    """Applied receipts whose *invoice* belongs to the patient (rows before grouping; of every patient: a row per receipt
    and transaction, the GL date as text)."""
    fx = p.fx
    trx = _select(t.ra_customer_trx_all, p, "attribute1", "attribute_category",
                  sentinel=p.options.receipt_selector_sentinel).select(
        "customer_trx_id", "invoice_currency_code", SELECTOR)
    rc = _receipts(t, p, p.options.receipt_in_period)
    if _single(p):
        app = t.by("ar_receivable_applications_all", "applied_customer_trx_id").filter(F.col("status") == STATUS_APPLIED).select(
            "cash_receipt_id", "applied_customer_trx_id", "amount_applied", "gl_date")
        j = (trx.join(app, F.col("customer_trx_id") == F.col("applied_customer_trx_id"))
             .join(rc, "cash_receipt_id"))
    else:
        j = rc.join(_application_sums(t, p, STATUS_APPLIED), "cash_receipt_id").join(
            trx, F.col("customer_trx_id") == F.col("applied_customer_trx_id"))
    j = with_rate(j, rate_table(t, fx), "currency_code", "receipt_date", "rct")
    cols = _receipt_columns(
        p, applied_to_functional("amount_applied", "currency_code", "invoice_currency_code", "rct", fx),
        to_functional("amount", "currency_code", "rct", fx), exchange_rate("currency_code", "rct", fx))
    if not _single(p):
        j = _with_payer(j.filter(to_functional("amount", "currency_code", "rct", fx) != 0), t, "pay_from_customer")
    return j.select(*cols).filter(F.col("functional_original_amount") != 0)


def receipt_branch(t: FinanceTables, p: PatientParams) -> DataFrame:
    """Applied receipts grouped per receipt number etc.; applied amounts summed,
    the latest GL date taken as text."""
    mask = p.options.date_mask
    g = _by_document(receipt_rows(t, p), t, p, "receipt_number").groupBy(*RECEIPT_KEYS).agg(
        F.max(_gl_text(p)).alias("gl_date"),
        F.sum("transaction_applied_amount").alias("taa"),
        F.sum("functional_applied_amount").alias("faa"))
    return _finish(_receipt_output(g, mask), p)


def _receipt_output(g: DataFrame, mask: str) -> DataFrame:
    return g.select(
        "party_name", "customer_number", F.col("receipt_number").alias("invoice_number"),
        date_text("receipt_date", mask).alias("transaction_date"), "gl_date",
        F.col("currency").alias("transaction_currency"), "transaction_type",
        (F.lit(-1) * F.col("transaction_amount")).alias("transaction_original_amount"), "functional_currency",
        F.col("taa").alias("transaction_applied_amount"),
        (F.lit(-1) * F.col("functional_original_amount")).alias("functional_original_amount"),
        (F.lit(-1) * F.col("faa")).alias("transaction_remaining_amount"),
        (F.lit(-1) * (F.col("functional_original_amount") - F.col("faa"))).alias("functional_remaining_amount"),
        "exchange_rate", "patient_id", "patient_name", "plan_name", SELECTOR)


def receipt_applied_total(t: FinanceTables, receipts: DataFrame | None = None) -> DataFrame:
    """Total applied (status APP) per receipt, all dates."""
    app = t.ar_receivable_applications_all.filter(F.col("status") == STATUS_APPLIED).select(
        "cash_receipt_id", "amount_applied")
    if receipts is not None:
        app = _semi(app, receipts, "cash_receipt_id", "cash_receipt_id")
    return app.groupBy("cash_receipt_id").agg(F.sum("amount_applied").alias("receipt_applied_total"))


def unapplied_rows(t: FinanceTables, p: PatientParams) -> DataFrame:
    """UNAPP application rows of the patient's receipts in the period, before grouping (of every patient: as in
    ``receipt_rows``)."""
    fx = p.fx
    rc = _receipts(t, p, in_period=True)
    if p.options.unapplied_selector == "receipt":
        rc = _select(rc, p, "receipt_attribute1")
    app = t.ar_receivable_applications_all.filter(F.col("status") == STATUS_UNAPPLIED).select(
        "cash_receipt_id", "applied_customer_trx_id", "amount_applied", "gl_date")
    trx = t.ra_customer_trx_all.select("customer_trx_id", "attribute_category", "attribute1")
    if _single(p):
        j = (rc.join(app, "cash_receipt_id")
             .join(trx, F.col("applied_customer_trx_id") == F.col("customer_trx_id"), "left"))
    else:
        # most have no transaction: spread over the tasks of the join, as no key but null would take them to one
        j = (rc.join(_application_sums(t, p, STATUS_UNAPPLIED), "cash_receipt_id")
             .join(receipt_applied_total(t), "cash_receipt_id", "left")
             .withColumn("_spread", F.when(F.col("applied_customer_trx_id").isNull(), F.col("cash_receipt_id")))
             .withColumn("_spread", nvl("_spread", 0)))
        trx = trx.withColumn("_no_spread", F.lit(0).cast("bigint"))
        j = j.join(trx, (F.col("applied_customer_trx_id") == F.col("customer_trx_id")) & (F.col("_spread") == F.col("_no_spread")), "left")
    if p.options.unapplied_selector == "invoice":
        j = _select(j, p, "attribute1", "attribute_category", sentinel=True)
    if _single(p):
        j = j.join(receipt_applied_total(t, rc), "cash_receipt_id", "left")
    else:
        j = _with_payer(j, t, "pay_from_customer")
    j = with_rate(j, rate_table(t, fx), "currency_code", "receipt_date", "rct")
    cols = _receipt_columns(
        p, to_functional("receipt_applied_total", "currency_code", "rct", fx, mode="any"),
        to_functional("amount", "currency_code", "rct", fx, mode="any"),
        exchange_rate("currency_code", "rct", fx, mode="any"))
    return j.select(*cols, *([] if _single(p) else ["_applications"]))


def unapplied_branch(t: FinanceTables, p: PatientParams) -> DataFrame:
    """Receipts with UNAPP rows whose total APP amount is exactly zero
    (functional original = functional remaining), original amount not NULL."""
    mask = p.options.date_mask
    applied = nvl("functional_applied_amount", 0)
    g = _by_document(unapplied_rows(t, p), t, p, "receipt_number").groupBy(*RECEIPT_KEYS).agg(
        F.max(_gl_text(p)).alias("gl_date"),
        F.sum("transaction_applied_amount").alias("taa"),
        F.sum(applied if _single(p) else applied * F.col("_applications")).alias("faa"))
    y = _receipt_output(g, mask)
    return _finish(y.filter(F.col("functional_original_amount") == F.col("functional_remaining_amount")), p)


# ---- statement ----------------------------------------------------------------------------

def ledger(t: FinanceTables, p: PatientParams) -> DataFrame:
    """Invoices, receipts and unapplied receipts, one distinct union (equal rows
    after formatting collapse, whether within or across branches)."""
    return invoice_branch(t, p).union(receipt_branch(t, p)).union(unapplied_branch(t, p)).distinct()


def _transaction_day(p: PatientParams) -> Column:
    return F.to_date("transaction_date", p.options.date_mask)


def statement_order(df: DataFrame, p: PatientParams, day: Column | None = None) -> list[Column]:
    """O2 / O3: by date (G1) or by the text of the GL date, descending and NULLs first (G2), then by the other columns.
    ``day``: the transaction's date where it is at hand."""
    first = [] if _single(p) else [SELECTOR]
    if p.options.order == "date_asc":
        return total_order(df, [*first, (_transaction_day(p) if day is None else day).asc_nulls_last()])
    return total_order(df, [*first, F.col("gl_date").desc_nulls_first()], skip=["gl_date"])


def patient_statement(t: FinanceTables, p: PatientParams) -> DataFrame:
    """R4 (options G1) / R5 (options G2). With ``p.patient_id`` None: every patient's
    statement in one run, with the selecting id in ``selector_id``."""
    out = ledger(t, p)
    if p.party_name is not None:
        out = out.filter(F.col("party_name") == F.lit(p.party_name))
    # a sort works an expression out anew in every comparison, so the date is read from its text before
    return out.withColumn("_day", _transaction_day(p)).orderBy(*statement_order(out, p, F.col("_day"))).drop("_day")
