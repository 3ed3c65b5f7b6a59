"""Reports as files that keep their order.

Spark's writers keep no order across files, and a reader none across splits. A written report therefore carries its
order in a column: ``position`` from 1, told by the sizes of contiguous ranges of the order
(``operators.running``), not by a window over all rows. The files follow it too: each holds one range, sorted, and their
names rise with the ranges. The rows of one report date lie in a folder of their own, which a later run
of that date replaces and no other run touches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..operators.running import sequence_and_running_total

POSITION = "position"


def with_position(df: DataFrame, order: Sequence[Column], name: str = POSITION) -> DataFrame:
    """``df`` sorted by ``order`` with each row's position in it. Rows that tie on all of ``order`` are numbered in some
    order; it should name every column, so that only equal rows tie."""
    return sequence_and_running_total(df, order, row_id=name, ordered=True)


def write_report(df: DataFrame, order: Sequence[Column], folder: str, format: str = "parquet",
                 report_date: dt.date | None = None) -> str:
    """Writes ``df`` in ``order`` with its positions; returns the folder written, ``folder`` or, with a
    ``report_date``, ``folder/report_date=<date>``, which is replaced."""
    path = folder.rstrip("/") + (f"/report_date={report_date.isoformat()}" if report_date else "")
    writer = with_position(df, order).write.mode("overwrite").format(format)
    (writer.option("header", "true") if format == "csv" else writer).save(path)
    return path
