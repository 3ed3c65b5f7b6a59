"""Code-column expressions: optional parameters, flexfields, receipt class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DEPOSIT_PREFIX, NON_PATIENT_SENTINEL, PATIENT_CONTEXT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def optional_match(c: Column | str, param: str | None) -> Column:
    """``col = NVL(:p, col)``: with no parameter this is ``col = col``, which drops NULLs."""
    c = _col(c)
    return c == F.coalesce(F.lit(param).cast("string"), c)


def flexfield(category: Column | str, attribute: Column | str, context: str = PATIENT_CONTEXT) -> Column:
    """Attribute value only when the row's context (category) matches; NULL otherwise."""
    return F.when(_col(category) == F.lit(context), _col(attribute))


def flexfield_or_sentinel(category: Column | str, attribute: Column | str, context: str = PATIENT_CONTEXT,
                          sentinel: str = NON_PATIENT_SENTINEL) -> Column:
    """As :func:`flexfield` but other contexts (and NULL) read as the sentinel value."""
    return F.when(_col(category) == F.lit(context), _col(attribute)).otherwise(F.lit(sentinel))


def flexfield_matches(category: Column | str, attribute: Column | str, value: str,
                      context: str = PATIENT_CONTEXT, sentinel: str | None = None) -> Column:
    """Filter form of ``flexfield(...) == value`` (with ``sentinel``: of
    ``flexfield_or_sentinel(...) == value``) as plain column predicates.

    In a filter a NULL result drops the row like false, so the CASE reduces to
    ``category = context AND attribute = value`` - plus, only when ``value`` is the
    sentinel itself, every row outside the context. Plain comparisons reach the parquet
    scan as pushed filters; the CASE form does not.
    """
    in_context = _col(category) == F.lit(context)
    match = in_context & (_col(attribute) == F.lit(value))
    if sentinel is not None and value == sentinel:
        return match | ~F.coalesce(in_context, F.lit(False))
    return match


def receipt_class(number: Column | str, prefix: str = DEPOSIT_PREFIX) -> Column:
    """Receipts numbered with the deposit prefix are deposits, all others (NULL too) receipts."""
    return F.when(F.substring(_col(number), 1, len(prefix)) == F.lit(prefix), F.lit("DEP")).otherwise(F.lit("RCPT"))
