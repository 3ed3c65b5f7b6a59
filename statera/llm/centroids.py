"""Centroid clustering of integer vectors with a LAESA pivot table.

Components are quantised to integers (``floor(scale * x)``), so that distances, sums and centroids are
exact and the result is the same on every cluster and partitioning.

* The table: each vector's integers and its distances to fixed pivots, the ``PIVOTS`` vectors whose seeded
  ids have the smallest digests, written once. The first ``k`` of them are also the first centroids.
* A round: the distances of the k centroids to the pivots are known on the driver. For a vector and a
  centroid, no pivot's two distances can differ by more than the two are apart, so the largest difference
  is a lower bound. The centroid with the smallest bound is measured first, in exact integers, then each
  other one whose bound doesn't exceed the best so far. Tasks add up their vectors by cluster before the
  shuffle; k sums of d components come to the driver, whatever the number of vectors.

A round shuffles ``k * d`` partial sums per task and no vectors, so copies of one vector cost nothing
more. Empty clusters keep their centroid. Ties go to the smaller number.

Vectors that are null, of another length, or that hold null or non-finite components, or components
beyond +-2^27 after quantising (their squares would not fit in a long), take no part. Vectors without an
id take part with a null id, but are not chosen as pivots. Repeated rows are rows of their own. With fewer than k vectors there are
fewer clusters; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, landed, scratch, table
from .vectors import dense

PIVOTS = 16
LARGEST = 1 << 27
SLACK = 1e-5  # on a distance of 2^31 at most, the error of its square root is under 1e-6


def _tabled(batches: Iterator[pa.RecordBatch], dims: int, scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, matrix = dense(batch.column("embedding"), dims)
        with np.errstate(over="ignore"):
            whole = np.floor(scale * matrix)
        fits = (np.abs(whole) < LARGEST).all(axis=1)
        ids = batch.column("vec_id").take(pa.array(kept[fits]))
        ints = whole[fits].astype(np.int32)
        yield pa.RecordBatch.from_arrays([ids, _packed(ints)], ["vec_id", "ints"])


def _packed(matrix: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in matrix], pa.binary())


def _unpacked(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to one vector, or row by row."""
    d = a.astype(np.int64) - b
    return (d * d).sum(axis=1)


def _to_pivots(ints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([_distances(ints, p) for p in pivots], axis=1).astype(np.float64))


def _with_pivots(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ints = _unpacked(batch.column("ints"), np.int32, pivots.shape[1])
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("ints"), _packed(_to_pivots(ints, pivots))],
                                         ["vec_id", "ints", "apart"])


def nearest_centroid(ints: np.ndarray, apart: np.ndarray, pivots: np.ndarray,
                     centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of the nearest centroid of each row, and how many exact distances
    it took. ``apart``: the rows' distances to the pivots."""
    bounds = np.stack([np.abs(apart - c).max(axis=1) for c in _to_pivots(centroids, pivots)], axis=1)
    bounds = np.maximum(bounds - SLACK, 0) ** 2
    chosen = bounds.argmin(axis=1)
    best = _distances(ints, centroids[chosen])
    first, measured = chosen.copy(), len(ints)
    for c, centroid in enumerate(centroids):
        alive = np.flatnonzero((bounds[:, c] <= best) & (first != c))
        d = _distances(ints[alive], centroid)
        nearer = (d < best[alive]) | ((d == best[alive]) & (c < chosen[alive]))
        best[alive[nearer]], chosen[alive[nearer]] = d[nearer], c
        measured += len(alive)
    return chosen, best, measured


def _summed(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's sums: cluster, position of the component (-1: the number of vectors), total."""
    k, dims = centroids.shape
    sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    for batch in batches:
        ints = _unpacked(batch.column("ints"), np.int32, dims)
        apart = _unpacked(batch.column("apart"), np.float64, len(pivots))
        chosen, _, _ = nearest_centroid(ints, apart, pivots, centroids)
        np.add.at(sums, chosen, ints)
        counts += np.bincount(chosen, minlength=k)
    totals = np.concatenate([counts[:, None], sums], axis=1)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.repeat(np.arange(k), dims + 1), pa.int32()), pa.array(np.tile(np.arange(-1, dims), k), pa.int32()),
        pa.array(totals.ravel(), pa.int64())], ["cluster", "at", "total"])


def _assigned(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ints = _unpacked(batch.column("ints"), np.int32, centroids.shape[1])
        apart = _unpacked(batch.column("apart"), np.float64, len(pivots))
        chosen, best, _ = nearest_centroid(ints, apart, pivots, centroids)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(chosen, pa.int32()), pa.array(best, pa.int64())],
                                         ["vec_id", "cluster", "distance"])


def clustered(vectors: DataFrame, k: int, rounds: int, dims: int, scale: float = 1024.0, seed: int = 3,
              pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of the vectors (``vec_id``, ``embedding``) after ``rounds`` rounds, and the
    centroids. The first centroids are the k vectors with the smallest sha256 of ``seed:vec_id``."""
    spark, work = vectors.sparkSession, scratch(vectors.sparkSession, "centroids")
    bounded_batches(spark)
    own = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), "embedding")
    ints = landed(own.mapInArrow(partial(_tabled, dims=dims, scale=scale), "vec_id long, ints binary"), f"{work}/ints")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = ints.where("vec_id IS NOT NULL").orderBy(order, "vec_id", "ints").limit(max(k, pivots)).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.empty((0, dims), np.int64)
    fixed = np.stack([np.frombuffer(r["ints"], np.int32) for r in first]).astype(np.int64)
    laesa = landed(ints.mapInArrow(partial(_with_pivots, pivots=fixed), "vec_id long, ints binary, apart binary"), f"{work}/laesa")
    centroids = fixed[:k].copy()
    for _ in range(rounds):
        totals = laesa.mapInArrow(partial(_summed, pivots=fixed, centroids=centroids), "cluster int, at int, total long") \
            .groupBy("cluster", "at").agg(F.sum("total").alias("total")).collect()  # k * (dims + 1) rows
        sums = np.zeros((len(centroids), dims + 1), np.int64)
        for r in totals:
            sums[r["cluster"], r["at"] + 1] = r["total"]
        filled = sums[:, 0] > 0
        centroids[filled] = sums[filled, 1:] // sums[filled, :1]  # numpy's // is floor
    return landed(laesa.mapInArrow(partial(_assigned, pivots=fixed, centroids=centroids),
                                   "vec_id long, cluster int, distance long"), f"{work}/assigned"), centroids


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustered(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # 8 at most
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    of_cluster = spark.createDataFrame(
        [(r["cluster"], int(r["s"]), int(sum(x["s"] for x in sums)), digests[r["cluster"]]) for r in sums],
        T.StructType.fromDDL("cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))
    return found.join(F.broadcast(of_cluster), "cluster") \
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op13_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Lloyd's rounds as one common table each, in exact integers."""
    start = f"""
WITH kept AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM kept),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, vec_id, r) - 1 AS c, e FROM (
  SELECT *, sha256('3:' || CAST(vec_id AS VARCHAR)) AS h FROM v WHERE vec_id IS NOT NULL ORDER BY h, vec_id, r LIMIT {k}))"""
    apart = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for n in range(rounds + 1):
        start += f""",
a{n} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT v.r, c.c, {apart} AS d FROM v, c{n} c) GROUP BY r)"""
        if n < rounds:
            start += f""",
m{n + 1} AS (SELECT c, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS w FROM (
  SELECT a.c, unnest(v.e) AS x, unnest(range({dims})) AS i FROM a{n} a JOIN v USING (r)) GROUP BY c, i),
n{n + 1} AS (SELECT c, list(CAST((s - ((s % w) + w) % w) // w AS BIGINT) ORDER BY i) AS e FROM m{n + 1} GROUP BY c),
c{n + 1} AS MATERIALIZED (SELECT c, coalesce(n.e, o.e) AS e FROM c{n} o LEFT JOIN n{n + 1} n USING (c))"""
    return start + f"""
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} c ON c.c = a.c"""


OP13_SQL = _op13_sql()
