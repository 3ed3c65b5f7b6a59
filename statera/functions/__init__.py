"""Column expressions (all built-in Spark functions; nothing runs in Python per row)."""

from .codes import (flexfield, flexfield_matches, flexfield_or_sentinel, optional_match, receipt_class)
from .dates import date_text, day, days_outstanding, day_between
from .display import date_display, money_text
from .money import MONEY, exact, nonzero_open_amount, nvl, signed_balance

__all__ = ["flexfield", "flexfield_matches", "flexfield_or_sentinel", "optional_match", "receipt_class",
           "date_text", "day", "days_outstanding", "day_between", "date_display", "money_text", "MONEY", "exact",
           "nonzero_open_amount", "nvl", "signed_balance"]
