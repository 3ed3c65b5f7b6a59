"""Display text of the report layouts (number and date masks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_text(c: Column | str) -> Column:
    """Mask ``#,##0.00``: round half away from zero first, then group thousands."""
    return F.format_number(F.round(_col(c), 2), 2)


def date_display(c: Column | str, mask: str = "d-MMM-yy") -> Column:
    """Layout date masks (``d-MMM-yy`` gives ``5-Feb-24``; ``yyyy-MM-dd`` ISO)."""
    return F.date_format(_col(c), mask)
