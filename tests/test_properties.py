"""Property tests (hypothesis): bucket exclusivity and the sliced running total."""

from __future__ import annotations

import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from statera.operators.aging import aging_buckets
from statera.operators.running import sequence_and_running_total
from statera.params import DEFAULT_BUCKETS

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
amounts = st.decimals(min_value=-10**6, max_value=10**6, places=2, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(st.tuples(st.integers(-400, 400), amounts), min_size=1, max_size=40))
def test_exactly_one_bucket_carries_the_amount(spark, rows):
    df = spark.createDataFrame(rows, "past_due_days int, amt_due_remaining decimal(18,2)")
    names = [b.name for b in DEFAULT_BUCKETS]
    for r in aging_buckets(df).collect():
        hits = [r[n] for n in names if r[n] is not None]
        assert hits == [r.amt_due_remaining]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 6), amounts), min_size=1, max_size=60),
       st.integers(1, 9), st.booleans())
def test_sliced_running_total_equals_window(spark, rows, slices, grouped):
    data = [(g, d, i, a) for i, (g, d, a) in enumerate(rows)]
    df = spark.createDataFrame(data, "g int, d int, k int, amt decimal(18,2)")
    order = [F.col("d").asc_nulls_last(), F.col("k").asc_nulls_last()]
    groups = ["g"] if grouped else []
    got = sequence_and_running_total(df, order, amount="amt", partition_by=groups, slices=slices)
    w = (Window.partitionBy(*groups) if groups else Window.partitionBy()).orderBy(*order)
    want = df.select("k", F.row_number().over(w).alias("row_id"),
                     F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_total"))
    a = {r.k: (r.row_id, decimal.Decimal(r.running_total)) for r in got.collect()}
    b = {r.k: (r.row_id, decimal.Decimal(r.running_total)) for r in want.collect()}
    assert a == b
