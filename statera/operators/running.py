"""Row numbers and running totals over a total order, without a single-task window.

A plain ``row_number() / sum() OVER (ORDER BY ...)`` without ``PARTITION BY`` moves every
row into one task, and with ``PARTITION BY account`` a hot account (a third of all
rows) still lands in one task; so does a hot day where the order is cut by days. Here the total
order itself - groups, then every order column - is cut into balanced slices:

1. the rows are dealt to ranges of the total order. Spark samples the order keys for the bounds, so a
   range holds about as many rows as any other, and the rows of one day, account or both go to as many
   ranges as they need. The rows are written once, sorted, with their place in the order: this pins the
   slices (a lost task can't meet other bounds), and nothing that made the rows runs a second time;
2. counts, sums and first places per (group, slice), aggregated before they are shuffled, are prefix-summed
   over the slices of each group: a row per slice, and one more per group;
3. a row's number follows from its place and that of the first row of its group in the slice, without a window.
   The running sum is a window within each (group, slice), to which what lies before the slice is added.

The last step keeps the ranges together, so that rows in the order asked for (``ordered``) need no further
exchange: a slice is sorted where it is summed.

``seed`` (e.g. an opening balance) is taken from the group's first row and added from there
on. As with the plain window, the running total is NULL where the seed is NULL and as long as
all amounts so far are NULL; NULL amounts add nothing after that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table
from .joins import broadcast_if_small

PLACE, SLICE = "_place", "_slice"
SLICE_BITS = 33  # of monotonically_increasing_id, below the number of the partition


def _total(a: Column, b: Column) -> Column:
    """Sum of two sums, NULL only if both are."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def in_slices(df: DataFrame, order: Sequence[Column], slices: int) -> DataFrame:
    """``df`` as a written table with ``PLACE``, which rises along ``order``, and ``SLICE``, the number of the row's
    range: contiguous ranges of about equal size."""
    dealt = df.repartitionByRange(slices, *order).sortWithinPartitions(*order).withColumn(PLACE, F.monotonically_increasing_id())
    return scratch_table(dealt, "slices").withColumn(SLICE, F.shiftright(PLACE, SLICE_BITS))


def sequence_and_running_total(df: DataFrame, order: Sequence[Column], amount: str | None = None,
                               partition_by: Sequence[str] = (), seed: str | None = None,
                               row_id: str = "row_id", running: str = "running_total",
                               slices: int | None = None, ordered: bool = False) -> DataFrame:
    """Row number and, with ``amount``, its running sum over ``order`` (per ``partition_by``, NULL being a
    group too).

    ``order`` must be total within a group, for the numbers to be the same in every run. ``slices`` is
    the number of ranges (the session's shuffle partitions by default). ``ordered`` sorts the result by
    group and row number. Writes the rows of ``df`` once, and a row per slice and group, when it is called.
    """
    groups = list(partition_by)
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = in_slices(df, [*[F.col(g).asc_nulls_last() for g in groups], *order], slices)
    sums = [F.count(F.lit(1)).alias("_n"), F.min(PLACE).alias("_first_place")]
    if amount:
        sums += [F.sum(amount).alias("_s"), F.min_by(F.struct((F.col(seed) if seed else F.lit(0)).alias("v")), F.col(PLACE)).alias("_seed")]
    ws = Window.partitionBy(*groups).orderBy(SLICE)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_key_{i}" for i in range(len(groups) + 1)]
    carried = [F.col(c).alias(n) for c, n in zip([*groups, SLICE], names, strict=True)]
    carried += ["_first_place", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_prior_n")]
    if amount:
        carried += [F.sum("_s").over(before).alias("_prior_s"),
                    F.first("_seed").over(ws.rowsBetween(Window.unboundedPreceding, Window.currentRow))["v"].alias("_start")]
    per = scratch_table(rows.groupBy(*groups, SLICE).agg(*sums).select(*carried), "carried")
    if ordered:
        rows = rows.repartitionByRange(slices, SLICE)
    out = rows.join(broadcast_if_small(per), [F.col(c).eqNullSafe(F.col(n)) for c, n in zip([*groups, SLICE], names, strict=True)])
    columns = [*[F.col(c) for c in df.columns], (F.col("_prior_n") + F.col(PLACE) - F.col("_first_place") + 1).alias(row_id)]
    if amount:
        upto = Window.partitionBy(*groups, SLICE).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        columns.append((F.col("_start") + _total(F.col("_prior_s"), F.sum(amount).over(upto))).alias(running))
    if ordered:
        out = out.select(*columns, SLICE, PLACE).orderBy(SLICE, PLACE)
        return out.select(*df.columns, row_id, *([running] if amount else []))
    return out.select(*columns)
