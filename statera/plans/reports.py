"""User-level report jobs R1-R8: ``tables + parameters -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..operators.aging import ap_aging_detail, ap_aging_summary, ap_aging_summary_with_total
from ..operators.ledger import supplier_statement, supplier_statement_by_vendor
from ..operators.patient import patient_statement, statement_order
from ..operators.totals import LEVEL, total_order, with_grand_total, with_group_totals
from ..params import AgingParams, PatientParams, StatementParams
from ..sources.tables import FinanceTables

DETAIL_MEASURES = ("amt_due_remaining", "current_month", "month_1", "month_2", "month_3", "month_abve_3")

aging_detail = ap_aging_detail                                  # R1
aging_summary = ap_aging_summary                                # R2
supplier_account_statement = supplier_statement                 # R3
supplier_account_statements = supplier_statement_by_vendor      # R3 for every supplier in one run
patient_account_statement = patient_statement                   # R4 / R5
aging_summary_with_grand_total = ap_aging_summary_with_total    # R8


def aging_detail_with_subtotals(t: FinanceTables, p: AgingParams) -> DataFrame:
    """Detail rows grouped by supplier name (ascending) with a subtotal per supplier."""
    return with_group_totals(ap_aging_detail(t, p), ["vendor_name"], DETAIL_MEASURES,
                             sort=["invoice_date", "invoice_num"])


def aging_detail_with_grand_total(t: FinanceTables, p: AgingParams) -> DataFrame:
    """Flat detail rows and one grand total."""
    return with_grand_total(ap_aging_detail(t, p), DETAIL_MEASURES)


# what each report is ordered by; the other columns follow
LEADING = {
    "aging-detail": ("vendor_name", "invoice_date", "invoice_num"),
    "aging-summary": ("vendor_name", "vendor_number"),
    "aging-detail-subtotals": ("vendor_name", LEVEL, "invoice_date", "invoice_num"),
    "aging-detail-total": (LEVEL, "vendor_name", "invoice_date", "invoice_num"),
    "aging-summary-total": (LEVEL, "vendor_name", "vendor_number"),
    "supplier-statement": ("row_id",),
    "supplier-statements": ("vendor_id", "row_id"),
}


def order_of(report: str, df: DataFrame, p: AgingParams | StatementParams | PatientParams) -> list[Column]:
    """The total order of the rows of a report, by its name on the command line."""
    return statement_order(df, p) if isinstance(p, PatientParams) else total_order(df, LEADING[report])
