"""The sliced row-number / running-total operator equals a single-partition window."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import dec
from statera.operators import running
from statera.operators.running import sequence_and_running_total


def _data(spark, n=3000, hot_share=0.4, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = 0 if rnd.random() < hot_share else rnd.randint(1, 40)   # group 0 is hot
        day = rnd.randint(1, 5)                                        # many ties on the day
        rows.append((g, day, i, dec(rnd.randint(-500, 500)) / 4, dec(rnd.randint(0, 9))))
    return spark.createDataFrame(rows, "g int, day int, k int, amt decimal(18,2), seed decimal(18,2)")


@pytest.mark.parametrize("groups,slices", [((), 7), ((), 4), (("g",), 5), (("g",), 1)])
def test_matches_plain_window(spark, groups, slices):
    df = _data(spark)
    order = [F.col("day").asc_nulls_last(), F.col("k").asc_nulls_last()]
    got = sequence_and_running_total(df, order, amount="amt", partition_by=groups, seed="seed", slices=slices)
    w = (Window.partitionBy(*groups) if groups else Window.partitionBy()).orderBy(*order)
    first_seed = F.first("seed").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    want = df.select("*", F.row_number().over(w).cast("bigint").alias("row_id"),
                     (F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)) + first_seed)
                     .alias("running_total"))
    cols = ["g", "day", "k", "row_id", "running_total"]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in want.select(*cols).collect())
    assert a == b


def test_hot_group_spans_slices(spark):
    df = _data(spark, hot_share=0.9)
    got = sequence_and_running_total(df, [F.col("day"), F.col("k")], amount="amt", partition_by=["g"], slices=6)
    per_slice = got.filter(F.col("g") == 0).select("row_id").collect()
    assert len(per_slice) == df.filter(F.col("g") == 0).count()
    assert sorted(r.row_id for r in per_slice) == list(range(1, len(per_slice) + 1))


@pytest.mark.parametrize("slices", [1, 4, 7])
@pytest.mark.parametrize("groups", [(), ("g",)])
def test_null_amounts_and_seeds(spark, slices, groups):
    rows = [(g, d, d * 10 + i, None if (d + i) % 3 else dec(i + 1), None if g == 1 else dec(5 if d == 1 and i == 0 else 9))
            for g in (1, 2) for d in range(1, 6) for i in range(3)]
    df = spark.createDataFrame(rows, "g int, day int, k int, amt decimal(18,2), seed decimal(18,2)")
    order = [F.col("day"), F.col("k"), F.col("g")]
    got = sequence_and_running_total(df, order, "amt", groups, "seed", slices=slices)
    w = Window.partitionBy(*groups).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.row_number().over(w).cast("bigint").alias("row_id"),
                     (F.first("seed").over(upto) + F.sum("amt").over(upto)).alias("running_total"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_hot_day_is_cut_into_several_windows(spark):
    """A third of all rows on one day: no slice holds more than twice its share."""
    df = spark.range(30_000).select(F.when(F.col("id") < 10_000, 3).otherwise(F.col("id") % 7).cast("int").alias("day"),
                                    F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("k"),
                                    (F.col("id") % 13 - 6).cast("decimal(18,2)").alias("amt"))
    order = [F.col("day").asc_nulls_last(), F.col("k").asc_nulls_last()]
    sizes = running.in_slices(df, order, 12).groupBy(running.SLICE).agg(
        F.count("*").alias("n"), F.sum((F.col("day") == 3).cast("int")).alias("hot")).collect()
    assert len(sizes) == 12 and max(r.n for r in sizes) <= 2 * 30_000 / 12
    assert sum(r.hot > 0 for r in sizes) >= 4
    got = sequence_and_running_total(df, order, amount="amt", slices=12, ordered=True).collect()
    w = Window.orderBy(*order)
    want = df.select("*", F.row_number().over(w).cast("bigint").alias("row_id"),
                     F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_total")).orderBy("row_id").collect()
    assert got == want


def test_ordered_rows_are_exchanged_once_after_they_are_written(spark):
    df = _data(spark)
    got = sequence_and_running_total(df, [F.col("day"), F.col("k")], "amt", ["g"], "seed", slices=4, ordered=True)
    rows = got.collect()
    assert [(r.g, r.row_id) for r in rows] == sorted((r.g, r.row_id) for r in rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in final


def test_no_rows(spark):
    df = _data(spark, n=5).limit(0)
    assert sequence_and_running_total(df, [F.col("k")], "amt", ["g"], "seed", ordered=True).collect() == []
