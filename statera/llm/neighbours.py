"""Approximate nearest neighbours by inner product: stable projections, kd-trees, a chi-square stopping test.

Vectors are scaled by the largest norm M and given one more component that makes their norm 1, queries
are scaled to norm 1 (their own further component is 0). Then the squared distance of a query and a vector is
2 - 2 <q, x> / (|q| M): the largest inner product is the smallest distance. Projected to ``DIMS`` dimensions
by Gaussian (2-stable) vectors, a squared distance d becomes d times a chi-square variable of ``DIMS`` degrees of
freedom.

* Index: equal vectors become one, with its ``k + 1`` smallest ids (no answer can need more). The splits of
  the top of the tree are fitted on about ``SAMPLE`` projected vectors; every vector is indexed. The cells
  at its ends, ``CELLS`` at most, are dealt by hash into blocks of about ``BLOCK_BYTES`` of vectors, and each block is a
  kd-tree with leaves of ``LEAF`` vectors, written as one row. A cell with a third of all rows is only more blocks.
* Search in a block: leaves are opened in the order of their boxes' distances, and projected neighbours verified
  on the original vectors, shell by shell from the query on, until the chi-square test holds: the next projected
  distance exceeds ``quantile(CERTAINTY) * d``, d being the k-th smallest true distance so far. A vector nearer than d is then
  passed over with a probability of at most 1 - ``CERTAINTY``.
* Every query first searches one block of its own cell, which bounds its k-th distance. It then goes to the
  blocks of all cells that the ball of the test's radius meets, with that bound; what the blocks return is merged.
  Queries travel to the blocks by a join, in groups of about ``GROUP``; no vector is broadcast.

Answers are ranked by the inner product in double precision, added up from the first component to the last,
ties by the smaller id. Equal queries are searched once. Vectors that are null, empty, zero or hold null or
non-finite components take no part, nor do those with a null id; shorter vectors count as filled up with zeros. Rows with the
query's id are not its answers, whatever their vector; repeated rows of an id and vector are one. An empty
table, or one without a query, gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, landed, scratch, table
from .vectors import dense

DIMS = 10  # even, for the closed form of the chi-square distribution
CERTAINTY = 0.9
SAMPLE, CELLS = 16384, 1024
BLOCK_BYTES, LEAF = 4 << 20, 64
GROUP = 256
SEED = 11
SALTS = 16
NEAR = 1e-9  # what a projected distance may be off by
FOUND = "qid long, score double, vec_id long"
ASKED = "qid long, vector binary, bound double, cell int, block int"


def quantile(certainty: float, dims: int) -> float:
    """Of the chi-square distribution with an even number of degrees of freedom."""
    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
    low, high = 0.0, 1.0
    while below(high) < certainty:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < certainty else (low, middle)
    return high


@dataclass
class Space:
    """The scaled space and its projection, with the splits of the top of the tree."""
    width: int  # components of the longest vector
    longest: float  # the largest norm
    dims: int = DIMS
    kind: type = np.float64  # of the indexed vectors' components; all sums are of doubles
    axes: np.ndarray | None = None  # a complete binary tree of splits, the root first
    cuts: np.ndarray | None = None

    def __post_init__(self):
        self.gauss = np.random.default_rng(SEED).standard_normal((self.width + 1, self.dims))

    def filled(self, matrix: np.ndarray) -> np.ndarray:
        if matrix.shape[1] == self.width:
            return matrix
        out = np.zeros((len(matrix), self.width))
        out[:, :min(self.width, matrix.shape[1])] = matrix[:, :self.width]
        return out

    def rows(self, matrix: np.ndarray) -> np.ndarray:
        scaled = matrix / self.longest
        more = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))
        return scaled @ self.gauss[:-1] + more[:, None] * self.gauss[-1]

    def queries(self, matrix: np.ndarray) -> np.ndarray:
        return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300) @ self.gauss[:-1]

    def split(self, sample: np.ndarray, levels: int) -> None:
        """Cuts the widest axis of each node's sample in the middle."""
        self.axes, self.cuts = np.zeros(2 ** levels - 1, np.int64), np.zeros(2 ** levels - 1)
        parts = [sample]
        for node in range(2 ** levels - 1):
            part = parts[node]
            if len(part):
                self.axes[node] = axis = int(np.ptp(part, axis=0).argmax())
                self.cuts[node] = cut = float(np.median(part[:, axis]))
                above = part[:, axis] > cut
                parts += [part[~above], part[above]]
            else:
                parts += [part, part]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while len(self.axes) and len(node) and node[0] < len(self.axes):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axes[node]] > self.cuts[node])
        return node - len(self.axes)


def _floats(matrix: np.ndarray) -> pa.Array:
    matrix = np.ascontiguousarray(matrix)
    return pa.array([row.tobytes() for row in matrix], pa.binary())


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def _projected(batches: Iterator[pa.RecordBatch], space: Space) -> Iterator[pa.RecordBatch]:
    """The rows with their projection and cell, the vectors as bytes."""
    for batch in batches:
        _, matrix = dense(batch.column("embedding"))  # all are usable
        matrix = space.filled(matrix)
        points = space.rows(matrix)
        cells = np.zeros(len(points), np.int64) if space.axes is None else space.cells(points)
        yield pa.RecordBatch.from_arrays([batch.column("ids"), _floats(matrix), _floats(points), pa.array(cells, pa.int32())],
                                         ["ids", "vector", "point", "cell"])


def _boxes(batches: Iterator[pa.RecordBatch], space: Space) -> Iterator[pa.RecordBatch]:
    """A task's box and number of rows per cell."""
    total = len(space.axes) + 1
    low, high = np.full((total, space.dims), np.inf), np.full((total, space.dims), -np.inf)
    count = np.zeros(total, np.int64)
    for batch in batches:
        points, cells = _rows(batch.column("point"), space.dims), batch.column("cell").to_numpy()
        np.minimum.at(low, cells, points)
        np.maximum.at(high, cells, points)
        count += np.bincount(cells, minlength=total)
    some = np.flatnonzero(count)
    at = np.tile(np.arange(space.dims), len(some))
    yield pa.RecordBatch.from_arrays([
        pa.array(np.repeat(some, space.dims), pa.int32()), pa.array(at, pa.int32()), pa.array(low[some].ravel()),
        pa.array(high[some].ravel()), pa.array(np.repeat(count[some], space.dims))], ["cell", "axis", "low", "high", "n"])


def _leaves(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of a kd-tree's rows, and where its leaves begin."""
    order, starts, todo = [], [0], [np.arange(len(points))]
    while todo:
        part = todo.pop()
        if len(part) <= LEAF:
            order.append(part)
            starts.append(starts[-1] + len(part))
        else:
            axis = int(np.ptp(points[part], axis=0).argmax())
            part = part[np.argpartition(points[part, axis], len(part) // 2)]
            todo += [part[len(part) // 2:], part[:len(part) // 2]]
    return np.concatenate(order), np.array(starts, np.int64)


def _tree(rows: pa.Table, space: Space) -> pa.Table:
    """One row with the kd-tree of a block."""
    rows = rows.combine_chunks()
    points = _rows(rows.column("point"), space.dims)
    order, starts = _leaves(points)
    vectors, points = _rows(rows.column("vector"), space.width)[order], points[order]
    ids = rows.column("ids").combine_chunks().take(pa.array(order))
    sizes = np.diff(np.asarray(ids.offsets))
    low, high = (f.reduceat(points, starts[:-1], axis=0) for f in (np.minimum, np.maximum))
    packed = [x.tobytes() for x in (starts, low, high, points, vectors.astype(space.kind), np.concatenate([[0], np.cumsum(sizes)]),
                                    ids.flatten().to_numpy().astype(np.int64))]
    return pa.table({"cell": rows.column("cell").slice(0, 1), "block": rows.column("block").slice(0, 1),
                     **{name: pa.array([x], pa.binary()) for name, x in zip(PACKED, packed, strict=True)}})


PACKED = ("starts", "low", "high", "points", "vectors", "offsets", "ids")
TREE = "cell int, block int, " + ", ".join(f"{c} binary" for c in PACKED)


class Block:
    def __init__(self, row: dict, space: Space, certainty: float):
        part = {c: np.frombuffer(row[c], np.int64 if c in ("starts", "offsets", "ids") else np.float64)
                for c in PACKED if c != "vectors"}
        self.starts, self.offsets, self.ids = part["starts"], part["offsets"], part["ids"]
        self.low, self.high, self.points = (part[c].reshape(-1, space.dims) for c in ("low", "high", "points"))
        self.vectors = np.frombuffer(row["vectors"], space.kind).reshape(-1, space.width)
        self.near = NEAR if space.kind == np.float64 else 1e-5  # what a verified distance may be off by
        self.places, self.lengths = np.arange(len(self.points)), (self.points * self.points).sum(axis=1)
        self.copies = np.diff(self.offsets)
        self.reach, self.longest = quantile(certainty, space.dims), space.longest

    @staticmethod
    def _products(matrix: np.ndarray, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Of some rows with a vector; of very many it is cheaper to leave them where they are."""
        return (matrix @ vector)[rows] if 4 * len(rows) > len(matrix) else matrix[rows] @ vector

    def nearest(self, query: np.ndarray, point: np.ndarray, bound: float, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores and ids of the k nearest rows, as far as they aren't beyond the squared distance ``bound``, and how
        many vectors were verified."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        gap = (gap * gap).sum(axis=1)
        order = np.argsort(gap, kind="stable")
        gap = gap[order]
        scale = 2 / (max(np.linalg.norm(query), 1e-300) * self.longest)
        opened, verified, length, query = 0, 0, point @ point, query.astype(self.vectors.dtype)
        waiting, waiting_at = np.empty(0), np.empty(0, np.int64)  # projected neighbours in opened leaves
        best, best_at = np.empty(0), np.empty(0, np.int64)
        while True:
            radius = self.reach * bound + NEAR
            upto = int(np.searchsorted(gap, radius, side="right"))
            leaves = order[opened:max(opened, min(opened + max(2, opened), upto))]
            opened += len(leaves)
            if len(leaves):
                rows = np.concatenate([self.places[self.starts[x]:self.starts[x + 1]] for x in leaves])
                waiting, waiting_at = np.append(waiting, self._products(self.points, rows, -2 * point) + self.lengths[rows] + length), \
                    np.append(waiting_at, rows)
            # these are the next projected neighbours: no leaf that isn't open has a nearer one. Those beyond the
            # radius are passed over by the test
            frontier = gap[opened] if opened < upto else np.inf
            rows = waiting_at[waiting <= min(frontier, radius)]
            later = (waiting > frontier) & (waiting <= radius)
            waiting, waiting_at = waiting[later], waiting_at[later]
            if len(rows):
                verified += len(rows)
                d = 2 - scale * self._products(self.vectors, rows, query).astype(np.float64)
                near = d <= bound + self.near
                best, best_at = np.append(best, d[near]), np.append(best_at, rows[near])
                by = np.argsort(best)
                best, best_at = best[by], best_at[by]
                reached = int(np.searchsorted(np.cumsum(self.copies[best_at]), k))
                if reached < len(best):
                    bound = min(bound, max(float(best[reached]), 0.0))
                    left = int(np.searchsorted(best, bound + self.near, side="right"))
                    best, best_at = best[:left], best_at[:left]
            if opened >= upto:
                break
        if not len(best_at):
            return np.empty(0), np.empty(0, np.int64), verified
        scores = np.repeat(np.cumsum(self.vectors[best_at].astype(np.float64) * query, axis=1)[:, -1], self.copies[best_at])
        ids = np.concatenate([self.ids[self.offsets[i]:self.offsets[i + 1]] for i in best_at])
        by = np.lexsort((ids, -scores))[:k]
        return scores[by], ids[by], verified


def _searched(batches: Iterator[pa.RecordBatch], space: Space, certainty: float, k: int) -> Iterator[pa.RecordBatch]:
    """Rows of a block's tree and a group of queries -> qid, score, vec_id."""
    for batch in batches:
        for row in batch.to_pylist():
            block, asked = Block(row, space, certainty), row["asked"]
            vectors = np.frombuffer(b"".join(x["vector"] for x in asked), np.float64).reshape(-1, space.width)
            found = [block.nearest(query, point, one["bound"], k)
                     for one, query, point in zip(asked, vectors, space.queries(vectors), strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([x["qid"] for x in asked], [len(s) for s, _, _ in found]), pa.int64()),
                pa.array(np.concatenate([s for s, _, _ in found])), pa.array(np.concatenate([v for _, v, _ in found]))],
                ["qid", "score", "vec_id"])


@dataclass
class Cells:
    """The cells that hold vectors: number, box, number of blocks."""
    number: np.ndarray
    low: np.ndarray
    high: np.ndarray
    blocks: np.ndarray

    def gaps(self, point: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (gap * gap).sum(axis=1)

    def first(self, qid: int, point: np.ndarray) -> tuple[int, int]:
        """Place of the cell, and block, that a query searches first."""
        cell = int(self.gaps(point).argmin())
        return cell, qid % int(self.blocks[cell])


def _visits(batches: Iterator[pa.RecordBatch], space: Space, cells: Cells, reach: float) -> Iterator[pa.RecordBatch]:
    """The blocks where queries (qid, vector, worst) go: with no ``worst`` the first one, with the worst score
    of a full answer (or nan) the others in the reach of its distance."""
    again = reach > 0
    for batch in batches:
        vectors = _rows(batch.column("vector"), space.width)
        qids, worst = batch.column("qid").to_pylist(), batch.column("worst").to_numpy(zero_copy_only=False)
        bounds = 2 - 2 * worst / (np.maximum(np.linalg.norm(vectors, axis=1), 1e-300) * space.longest)
        bounds = np.where(np.isnan(bounds), 4.0, np.maximum(bounds, 0))
        at, cell, block = [], [], []
        for i, (qid, point) in enumerate(zip(qids, space.queries(vectors), strict=True)):
            home, home_block = cells.first(qid, point)
            if not again:
                here, which = [home], [home_block]
            else:
                near = np.flatnonzero(cells.gaps(point) <= reach * bounds[i] + NEAR)
                here = np.repeat(near, cells.blocks[near])
                which = np.concatenate([np.arange(n) for n in cells.blocks[near]]) if len(near) else np.empty(0, np.int64)
                other = (here != home) | (which != home_block)
                here, which = here[other], which[other]
            at.append(np.full(len(here), i))
            cell.append(cells.number[here])
            block.append(which)
        at, cell, block = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (at, cell, block))
        for start in range(0, len(at), 1000):
            some = slice(start, start + 1000)
            yield pa.RecordBatch.from_arrays([
                batch.column("qid").take(pa.array(at[some])), batch.column("vector").take(pa.array(at[some])),
                pa.array(bounds[at[some]]), pa.array(cell[some], pa.int32()), pa.array(block[some], pa.int32())],
                ["qid", "vector", "bound", "cell", "block"])


def _asked(batches: Iterator[pa.RecordBatch], space: Space) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, matrix = dense(batch.column("embedding"))
        yield pa.RecordBatch.from_arrays([batch.column("qid"), _floats(space.filled(matrix))], ["qid", "vector"])


def usable(vectors: DataFrame, key: str) -> DataFrame:
    e = F.col("embedding")
    return vectors.select(F.col(key).cast("long").alias(key), "embedding").where(
        F.col(key).isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(e, lambda x: x != 0))


class Index:
    """An index over vectors (``vec_id``, ``embedding``), for answers of up to ``k`` neighbours."""

    def __init__(self, vectors: DataFrame, k: int, dims: int = DIMS, certainty: float = CERTAINTY,
                 block_bytes: int = BLOCK_BYTES):
        self.spark, self.k, self.certainty = vectors.sparkSession, k, certainty
        self.reach, self.work = quantile(certainty, dims), scratch(self.spark, "neighbours")
        bounded_batches(self.spark)
        # the smallest ids of each vector, in two steps, as one vector may be that of a third of all rows
        salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))
        rank = F.dense_rank().over(Window.partitionBy("embedding", salt).orderBy("vec_id"))
        distinct = usable(vectors, "vec_id").withColumn("rank", rank).where(f"rank <= {k + 1}").groupBy("embedding") \
            .agg(F.slice(F.sort_array(F.collect_set("vec_id")), 1, k + 1).alias("ids"))
        distinct = landed(distinct, f"{self.work}/distinct")
        e = F.col("embedding")
        n, width, longest = distinct.agg(F.count("*"), F.max(F.size(e)), F.max(F.sqrt(F.aggregate(
            e, F.lit(0.0), lambda s, x: s + x.cast("double") * x)))).first()
        self.empty = not n
        if self.empty:
            return
        kind = np.float32 if "array<float>" in dict(distinct.dtypes).values() else np.float64
        self.space = space = Space(width, longest, dims, kind)
        block = max(LEAF, block_bytes // (8 * width))
        levels = max(0, min(int(math.log2(CELLS)), math.ceil(math.log2(n / block))))
        shape = "ids array<long>, vector binary, point binary, cell int"
        part = F.pmod(F.xxhash64(F.lit(SEED), F.col("ids")[0]), F.lit(1 << 40)) < int(min(1, SAMPLE / n) * (1 << 40))
        sample = distinct.where(part).mapInArrow(partial(_projected, space=space), shape).select("point").collect()  # about SAMPLE rows
        space.split(np.frombuffer(b"".join(r["point"] for r in sample), np.float64).reshape(-1, dims), levels)
        points = landed(distinct.mapInArrow(partial(_projected, space=space), shape), f"{self.work}/points")
        boxes = points.select("point", "cell").mapInArrow(
            partial(_boxes, space=space), "cell int, axis int, low double, high double, n long").groupBy("cell", "axis") \
            .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")) \
            .sort("cell", "axis").collect()  # CELLS * dims rows at most
        low, high = (np.array([r[c] for r in boxes]).reshape(-1, dims) for c in ("low", "high"))
        number, rows = (np.array([r[c] for r in boxes[::dims]], np.int64) for c in ("cell", "n"))
        self.cells = Cells(number, low, high, -(-rows // block))
        blocks = np.ones(2 ** levels, np.int64)
        blocks[number] = self.cells.blocks
        points = points.withColumn("block", F.pmod(F.xxhash64(F.col("ids")[0]), F.get(F.lit(blocks.tolist()), F.col("cell"))).cast("int"))

        def tree(rows: pa.Table) -> pa.Table:
            return _tree(rows, space)

        self.trees = landed(points.groupBy("cell", "block").applyInArrow(tree, TREE), f"{self.work}/trees")

    def _found(self, asked: DataFrame, again: bool, parts: int) -> DataFrame:
        """qid, score, vec_id of the first (or the other) blocks that queries (qid, vector, worst) visit."""
        visits = asked.mapInArrow(partial(_visits, space=self.space, cells=self.cells, reach=self.reach if again else 0), ASKED)
        grouped = visits.groupBy("cell", "block", F.pmod(F.xxhash64("qid"), F.lit(parts))) \
            .agg(F.collect_list(F.struct("qid", "vector", "bound")).alias("asked")).select("cell", "block", "asked")
        found = self.trees.join(grouped, ["cell", "block"]) \
            .mapInArrow(partial(_searched, space=self.space, certainty=self.certainty, k=self.k + 1), FOUND)
        return landed(found, f"{self.work}/found{int(again)}")

    def nearest(self, queries: DataFrame) -> DataFrame:
        """query_id, rank, vec_id, score of the queries (``query_id``, ``embedding``); once for an index."""
        if self.empty:
            return self.spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        queries = usable(queries, "query_id").distinct()
        vectors = landed(queries.select("embedding").distinct().withColumn("qid", F.monotonically_increasing_id()), f"{self.work}/queries")
        asked = landed(vectors.mapInArrow(partial(_asked, space=self.space), "qid long, vector binary"), f"{self.work}/asked")
        parts = max(1, -(-asked.count() // GROUP))
        first = self._found(asked.withColumn("worst", F.lit(None).cast("double")), False, parts)
        worst = first.groupBy("qid").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(f"n > {self.k}")
        other = self._found(asked.join(worst.drop("n"), "qid", "left"), True, parts)
        best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
        answers = first.unionByName(other).withColumn("r", F.row_number().over(best)).where(f"r <= {self.k + 1}").groupBy("qid") \
            .agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("answers"))
        answers = vectors.join(answers, "qid").select("embedding", "answers")
        own = queries.join(answers, "embedding").select("query_id", F.posexplode(
            F.slice(F.filter("answers", lambda a: a["vec_id"] != F.col("query_id")), 1, self.k)))
        return own.select("query_id", (F.col("pos") + 1).alias("rank"), "col.vec_id", "col.score")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return Index(vectors.select("vec_id", "embedding"), k=20).nearest(queries)
