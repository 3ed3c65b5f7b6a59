"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import FinanceTables

_DEFAULT_LIMIT = 10 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of ``df`` (no job runs). ``None`` if unavailable."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # e.g. Spark Connect sessions expose no JVM plan
        return None


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30}


def _parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", str(text).lower())
    if not m or m.group(2) not in _UNITS:
        return _DEFAULT_LIMIT
    return int(m.group(1)) * _UNITS[m.group(2)]


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (0 when broadcasting is switched off)."""
    try:
        raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", str(_DEFAULT_LIMIT))
    except Exception:
        return _DEFAULT_LIMIT
    return max(_parse_bytes(raw), 0)


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Hint a broadcast when the estimated size is at most ``limit`` bytes.

    Beyond the limit (or without an estimate) the side is left to the planner, which
    shuffles it (sort-merge join) or, with AQE, re-plans from runtime sizes.
    """
    limit = broadcast_limit(df) if limit is None else limit
    size = estimated_bytes(df)
    if size is not None and 0 < limit and size <= limit:
        return F.broadcast(df)
    return df


def restrict_to(df: DataFrame, keys: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Cut ``df`` to the rows whose ``left_key`` occurs in ``keys`` (a semi join).

    A statement for one account only needs that account's facts; cutting a fact table before
    it is aggregated avoids aggregating every account's. The key set is broadcast behind the
    usual size check; beyond it both sides are shuffled, and the runtime size can still turn
    the join into a broadcast.
    """
    k = broadcast_if_small(keys.select(F.col(right_key or left_key).alias("_restrict_key")).distinct())
    return df.join(k, F.col(left_key) == F.col("_restrict_key"), "left_semi")


def salted_join(salted: DataFrame, other: DataFrame, on: list[str], salts: int, how: str = "inner") -> DataFrame:
    """A join on ``on`` in which the rows of a key of ``salted`` go to up to ``salts`` tasks and those of ``other``, which
    should be few, to all of them. ``how``: inner or left. The salt is the number of a row's partition: the same when a
    lost task runs again, and as even as the rows are dealt to partitions. The other side is dealt by key and salt
    here; if it lay in buckets of the key, the join would bring the salted side there."""
    left = salted.withColumn("_salt", F.spark_partition_id() % salts)
    right = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).repartition(*on, "_salt")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def join_fact(t: FinanceTables, df: DataFrame, name: str, fact: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of ``df`` with ``fact``, columns of relation ``name``, on a document's columns; where all documents are
    hot (``per_document``), salted by the side that has many rows of each."""
    if t.salts == 1:
        return df.join(fact, on)
    columns = [*on, *[c for c in df.columns if c not in on], *[c for c in fact.columns if c not in on]]
    joined = salted_join(fact, df, on, t.salts) if name in t.heavy else salted_join(df, fact, on, t.salts)
    return joined.select(*columns)


def per_document(t: FinanceTables, names: Sequence[str], key: str, build: Callable[[FinanceTables], DataFrame]) -> DataFrame:
    """``build(t)``, which treats the documents ``key`` of the facts ``names`` one by one (joins on them, sums of
    them): documents that are hot in any of them apart from the others, whose joins stay in their buckets. The hot ids
    are few by construction (``landing.HOT_SHARE``)."""
    hot_names = [n for n in names if t.is_hot(n)]
    if not hot_names:
        return build(t)
    ids = functools.reduce(DataFrame.union, [t.hot(n).select(key) for n in hot_names]).distinct()
    cold = t.with_overrides(**{n: t.cold(n).join(F.broadcast(ids), key, "left_anti") for n in names})
    hot = t.with_overrides(**{n: t.table(n).join(F.broadcast(ids), key, "left_semi") for n in names})
    hot.salts, hot.heavy = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")), frozenset(hot_names)
    return build(cold).unionByName(build(hot))
