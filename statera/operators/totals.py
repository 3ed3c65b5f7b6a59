"""Report totals: group subtotals and grand totals unioned with the rows.

Detail rows can be exact duplicates (installment fan-out), so totals are *added*
below the untouched rows instead of grouping over the row columns, which would merge
duplicates. ``row_level`` tells rows (0), group subtotals (1) and the grand total (2)
apart. The rows are written once and both outputs read them: they are computed one time, not
re-grouped, and a total reads only its keys and measures, summed map-side, so that a hot
group is one partial row per task. A total over rows that are an aggregate themselves (R8) needs no second
pass at all; ``aging.ap_aging_summary_with_total`` is one aggregation over grouping sets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import MONEY
from ..session import scratch_table

LEVEL = "row_level"


def _with_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str], level: int) -> DataFrame:
    """Rows (level 0) and their sums per ``keys`` (``level``); a grand total is one row even without rows."""
    rows = scratch_table(df.select(*[F.col(c).cast(MONEY).alias(c) if c in measures else F.col(c) for c in df.columns]), "detail")
    sums = rows.groupBy(*keys).agg(*[F.sum(m).cast(MONEY).alias(m) for m in measures])
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    total = sums.select(*[F.col(c) if c in keys or c in measures else F.lit(None).cast(kinds[c]).alias(c) for c in df.columns],
                        F.lit(level).alias(LEVEL))
    return rows.withColumn(LEVEL, F.lit(0)).union(total)


def total_order(df: DataFrame, leading: Sequence, skip: Sequence[str] = ()) -> list[Column]:
    """``leading`` (NULLs last) and then every other column but ``skip``: only equal rows tie."""
    named = {c.lower() for c in [*leading, *skip] if isinstance(c, str)}
    lead = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in leading]
    return lead + [F.col(c).asc_nulls_last() for c in df.columns if c.lower() not in named]


def report_order(df: DataFrame, leading: Sequence, skip: Sequence[str] = ()) -> DataFrame:
    """Sort by ``total_order``: the report order only fixes the leading
    keys, the rest makes the range partitions of the global sort fine-grained, so that a hot
    supplier or day spreads over many tasks."""
    return df.orderBy(*total_order(df, leading, skip))


def with_group_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
                      sort: Sequence[str] = ()) -> DataFrame:
    """Rows followed by one subtotal per group, groups ascending by key (NULLs last). ``sort``: the order within a group;
    it should tell the rows of a large group apart, which are dealt to the ranges of the sort by it."""
    return _with_totals(df, keys, measures, 1).orderBy(*[F.col(c).asc_nulls_last() for c in (*keys, LEVEL, *sort)])


def with_grand_total(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Rows and one grand-total row (every non-measure column NULL), unsorted."""
    return _with_totals(df, [], measures, 2)
