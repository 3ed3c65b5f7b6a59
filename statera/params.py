"""Typed report parameters (the bind variables of the reports)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Bucket:
    """One aging bucket: ``lo < days <= hi``; ``None`` leaves a side open."""
    name: str
    lo: int | None
    hi: int | None


# Fixed values of the aging report: bucket edges in days and the output column names.
DEFAULT_BUCKETS: tuple[Bucket, ...] = (
    Bucket("current_month", None, 30),
    Bucket("month_1", 30, 60),
    Bucket("month_2", 60, 90),
    Bucket("month_3", 90, 120),
    Bucket("month_abve_3", 120, None),
)

# Payment status flags of open invoices, invoice-type lookup, void statuses,
# approval statuses accepted on statement invoices.
OPEN_PAYMENT_STATUS = ("N", "P")
INVOICE_TYPE_LOOKUP = "INVOICE TYPE"
VOID_PAYMENT_STATUS = ("VOID", "VOID_BY_OVERFLOW")
APPROVED_STATUS = ("APPROVED", "AVAILABLE")
WF_APPROVED_STATUS = ("WFAPPROVED", "NOT REQUIRED", "MANUALLY APPROVED")


@dataclass(frozen=True)
class AgingParams:
    as_on: dt.date
    vendor_name: str | None = None
    vendor_num: str | None = None
    buckets: tuple[Bucket, ...] = DEFAULT_BUCKETS


@dataclass(frozen=True)
class StatementParams:
    """Supplier statement: period and supplier *name* (the reference's ``p_sup_id``)."""
    from_date: dt.date
    to_date: dt.date
    supplier: str | None


@dataclass(frozen=True)
class FxConfig:
    functional_currency: str = "KES"
    # "strict": more than one rate for a (currency, day) raises when the rate is used;
    # "any": the smallest of them is taken.
    mode: str = "strict"


# Fixed values of the patient statement: flexfield context, sentinel that stands for
# "not a patient document", applied / unapplied / reversed status codes, deposit prefix.
PATIENT_CONTEXT = "PATIENT AND SPONSER DETAILS"
NON_PATIENT_SENTINEL = "ZZZ"
STATUS_APPLIED = "APP"
STATUS_UNAPPLIED = "UNAPP"
STATUS_REVERSED = "REV"
DEPOSIT_PREFIX = "DR"


@dataclass(frozen=True)
class SiteCodes:
    """What a site calls things: the flexfield context of patient documents, the value that stands for other
    documents, and the prefix of deposit receipts' numbers."""
    patient_context: str = PATIENT_CONTEXT
    other_documents: str = NON_PATIENT_SENTINEL
    deposit_prefix: str = DEPOSIT_PREFIX


@dataclass(frozen=True)
class PatientOptions:
    """The two datasets of the patient statement are two settings of this object."""
    date_mask: str                      # text form of dates in the output
    invoice_period_on_trx_date: bool    # invoice rows: untruncated trx_date BETWEEN from AND to
    applied_total_in_period: bool       # applied total counts only invoices dated in the period
    receipt_selector_sentinel: bool     # receipt rows: CASE ... ELSE sentinel (else: no ELSE)
    receipt_in_period: bool             # receipt rows: receipt day BETWEEN from AND to
    unapplied_selector: str             # "receipt" (receipt attribute1) or "invoice" (invoice flexfield)
    order: str                          # "date_asc" or "gl_text_desc"


G1 = PatientOptions(date_mask="yyyy-MM-dd", invoice_period_on_trx_date=True,
                    applied_total_in_period=False, receipt_selector_sentinel=False,
                    receipt_in_period=False, unapplied_selector="receipt", order="date_asc")
G2 = PatientOptions(date_mask="dd-MM-yyyy", invoice_period_on_trx_date=False,
                    applied_total_in_period=True, receipt_selector_sentinel=True,
                    receipt_in_period=True, unapplied_selector="invoice", order="gl_text_desc")


@dataclass(frozen=True)
class PatientParams:
    from_date: dt.date
    to_date: dt.date
    patient_id: str | None              # None: every patient in one run (adds ``selector_id``)
    party_name: str | None = None       # G1 keeps only this party (the reference hard-codes a cashier)
    options: PatientOptions = G1
    fx: FxConfig = field(default_factory=FxConfig)
    site: SiteCodes = field(default_factory=SiteCodes)
