r"""Periodic runs of words, by suffix trees and Lyndon roots.

Words are ``[^\x20\x09-\x0D]+`` of the whole text, numbered from 0. A run is a stretch of consecutive words
with smallest period q (words q apart are identical) that no neighbouring word extends keeping it; reported
are runs of at least ``MIN_WORDS`` words and ``MIN_POWER`` periods.

For one document:

1. Every three consecutive words inside such a run occur three times in it, so only stretches where each
   three words occur at least three times in the document can hold one. This rules out plain prose in a few
   vectorised steps; no run is lost, as a stretch holds the run as a whole with its neighbours' words.
2. Of each stretch, Ukkonen's suffix tree is built, and that of its reversal. An Euler tour of a tree lists
   the string depth of each node visited; the smallest value between the first visits of two leaves is the
   depth of their lowest common ancestor, the length of the longest common extension of two places. A sparse
   table over blocks of the tour answers this in constant time.
3. At each word starts a longest Lyndon word, for the order of the words and for its opposite: up to the next
   smaller suffix, told from the order of the tree's leaves. Each run has such a word as its root. Each
   candidate root (2n of them) is extended to both sides by the trees; what reaches the least length is a run,
   and its root being primitive, its period is the smallest.

All steps are linear in the words of a document but for the sort in step 1 and the sparse table. Documents
are worked on where they are read; nothing is shuffled, so neither copies nor hot sources gather anywhere.
A task holds the trees of one stretch of one document at a time.

A null, empty or white text has no words and no runs. Rows with a null id and repeated rows are treated as
any other. Columns but ``doc_id`` and ``text`` are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, table

MIN_WORDS, MIN_POWER = 6, 4
BLOCK = 16  # of the Euler tour
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class SuffixTree:
    """Ukkonen's suffix tree of ``word`` (integers from 1 to ``sigma`` - 1) and an end mark 0."""

    def __init__(self, word: list[int], sigma: int):
        self.sigma, self.size = sigma, len(word) + 1
        self.start, self.end, self.child = [0], [0], {}
        self._build([*word, 0])

    def _build(self, s: list[int]) -> None:
        start, end, child, sigma, size = self.start, self.end, self.child, self.sigma, self.size
        link = [0]
        node = edge = length = waiting = 0  # the active point: a node, the edge by a place in s, and how far along
        for i, c in enumerate(s):
            waiting, unlinked = waiting + 1, 0
            while waiting:
                if not length:
                    edge = i
                key = node * sigma + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(i)
                    end.append(size)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    at = start[below]
                    span = end[below] - at
                    if length >= span:  # walk down
                        node, edge, length = below, edge + span, length - span
                        continue
                    if s[at + length] == c:
                        if unlinked:
                            link[unlinked] = node
                        length += 1
                        break
                    middle = len(start)
                    child[key] = middle
                    start += (at, i)
                    end += (at + length, size)
                    link += (0, 0)
                    child[middle * sigma + c] = middle + 1
                    start[below] = at + length
                    child[middle * sigma + s[at + length]] = below
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1

    def _children(self, opposite: bool = False) -> tuple[list[int], list[int]]:
        """All nodes by parent and first word, the end mark first, and where each parent's begin."""
        keys = np.fromiter(self.child.keys(), np.int64, len(self.child))
        nodes = np.fromiter(self.child.values(), np.int64, len(self.child))
        parents, symbols = np.divmod(keys, self.sigma)
        if opposite:
            symbols = np.where(symbols > 0, self.sigma - symbols, 0)
        order = np.lexsort((symbols, parents))
        return nodes[order].tolist(), np.searchsorted(parents[order], np.arange(len(self.start) + 1)).tolist()

    def ranks(self, opposite: bool = False) -> list[int]:
        """The rank of each suffix, for the order of the words or for its opposite."""
        nodes, begin = self._children(opposite)
        start, end, size = self.start, self.end, self.size
        rank, count, stack = [0] * size, 0, [(0, 0)]
        while stack:
            node, depth = stack.pop()
            depth += end[node] - start[node]
            first, last = begin[node], begin[node + 1]
            if first == last and node:
                rank[size - depth] = count
                count += 1
            else:
                stack.extend([(child, depth) for child in nodes[last - 1:first - 1 if first else None:-1]])
        return rank

    def common_extensions(self) -> CommonExtensions:
        nodes, begin = self._children()
        start, end, size = self.start, self.end, self.size
        first, tour = np.zeros(size, np.int64), []
        upcoming = begin[:-1]  # of each node, the child that comes next
        path, depths = [0], [0]
        tour.append(0)
        while path:
            node = path[-1]
            at = upcoming[node]
            if at < begin[node + 1]:
                upcoming[node] = at + 1
                child = nodes[at]
                depth = depths[-1] + end[child] - start[child]
                if begin[child] == begin[child + 1]:
                    first[size - depth] = len(tour)
                    tour += (depth, depths[-1])  # a leaf, and back
                else:
                    path.append(child)
                    depths.append(depth)
                    tour.append(depth)
            else:
                path.pop()
                depths.pop()
                if depths:
                    tour.append(depths[-1])
        return CommonExtensions(first, np.array(tour, np.int32))


class CommonExtensions:
    """Longest common extensions of pairs of places, from the first visits of their leaves in an Euler tour
    of string depths."""

    def __init__(self, first: np.ndarray, tour: np.ndarray):
        self.first = first
        blocks = -(-len(tour) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[:len(tour)] = tour
        grid = padded.reshape(blocks, BLOCK)
        self.tour = padded
        self.up_to = np.minimum.accumulate(grid, axis=1).ravel()
        self.onward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.powers = [grid.min(axis=1)]
        while (step := 1 << (len(self.powers) - 1)) * 2 <= blocks:
            last = self.powers[-1]
            self.powers.append(np.minimum(last[:-step], last[step:]))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(a):
            return np.empty(0, np.int64)
        x, y = self.first[a], self.first[b]
        left, right = np.minimum(x, y), np.maximum(x, y)
        bl, br = left // BLOCK, right // BLOCK
        out = np.minimum(self.onward[left], self.up_to[right])
        between = br - bl - 1
        level = np.frexp(np.maximum(between, 1).astype(np.float64))[1] - 1
        for power in np.unique(level[between > 0]):
            some = np.flatnonzero((level == power) & (between > 0))
            table = self.powers[power]
            out[some] = np.minimum(out[some], np.minimum(table[bl[some] + 1], table[br[some] - (1 << int(power))]))
        same = np.flatnonzero(bl == br)
        if len(same):
            low = np.full(len(same), np.iinfo(np.int32).max, np.int32)
            for step in range(BLOCK):
                at = left[same] + step
                inside = at <= right[same]
                low[inside] = np.minimum(low[inside], self.tour[at[inside]])
            out[same] = low
        return out.astype(np.int64)


def _next_smaller(rank: list[int]) -> list[int]:
    """For each suffix the next one that is smaller; the empty one at last."""
    after = [len(rank)] * len(rank)
    for i in range(len(rank) - 2, -1, -1):
        j, own = i + 1, rank[i]
        while j < len(rank) and rank[j] > own:
            j = after[j]
        after[i] = j
    return after


def runs_of_stretch(word: np.ndarray) -> list[tuple[int, int, int]]:
    """start, length, period of the runs of a sequence of integers."""
    n = len(word)
    values, word = np.unique(word, return_inverse=True)
    symbols, sigma = (word + 1).tolist(), len(values) + 1
    tree = SuffixTree(symbols, sigma)
    # the last suffix is the end mark alone, the empty one of the sequence: smaller than all, at n
    roots = np.concatenate([np.array(_next_smaller(tree.ranks(opposite))[:n], np.int64) for opposite in (False, True)])
    begin = np.tile(np.arange(n), 2)
    period = roots - begin
    candidates = np.unique(begin * (n + 1) + period)
    begin, period = np.divmod(candidates, n + 1)
    after = tree.common_extensions().of(begin, begin + period)
    del tree
    back = SuffixTree(symbols[::-1], sigma).common_extensions()
    before = back.of(n - begin, n - begin - period)
    start, stop = begin - before, begin + period + after
    found = stop - start >= np.maximum(MIN_WORDS, MIN_POWER * period)
    return sorted({(int(a), int(b - a), int(p)) for a, b, p in zip(start[found], stop[found], period[found], strict=True)})


def periodic_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """start, length, period of all runs of a document's words, given as integers from 0, by start and period."""
    n = len(ids)
    if n < MIN_WORDS:
        return []
    pairs = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)[1]
    threes = pairs[:-1] * (int(pairs.max()) + 1) + pairs[1:]
    _, place, count = np.unique(threes, return_inverse=True, return_counts=True)
    often = np.concatenate([[False], count[place] >= 3, [False]])
    edges = np.flatnonzero(often[1:] != often[:-1])
    out = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):  # starts of such threes
        if b - a + 2 >= MIN_WORDS:
            out += [(start + a, length, period) for start, length, period in runs_of_stretch(ids[a:b + 2])]
    return sorted(out, key=lambda run: (run[0], run[2]))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, found, collapsed = [], [], []
        for text in batch.column("text"):
            words = (text.as_py() or b"").split()  # bytes split on the white space wanted here
            known: dict[bytes, int] = {}
            ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
            runs = periodic_runs(ids)
            counts.append(len(words))
            found.append([{"start": a, "length": b, "period": p} for a, b, p in runs])
            if runs:
                dropped = np.zeros(len(words) + 1, np.int64)
                for a, b, p in runs:
                    dropped[a + p] += 1
                    dropped[a + b] -= 1
                words = [words[i] for i in np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()]
            collapsed.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(counts, pa.int64()),
            pa.array(found, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
            pa.array(collapsed, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])


def with_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed: the words, joined by one space, without
    those that a run contains after its first period."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text")) \
        .mapInArrow(_read, f"doc_id long, n_words long, runs {RUNS}, collapsed binary") \
        .withColumn("collapsed", F.col("collapsed").cast("string"))


def _made_periodic(doc_id: Column, text: Column) -> Column:
    """Of every tenth document by crc32 of the id, the words from some place on repeated periodically, as
    op12's contract has it; other texts as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def repeated(words: Column) -> Column:
        n = F.nullif(F.size(words), F.lit(0)).cast("long")
        a = F.floor(h / 10) % n
        period = 1 + F.floor((n - a) / (3 + F.floor(h / 10) % 8))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), F.transform(
            F.sequence(F.lit(0), (n - a - 1).cast("int")),
            lambda i: F.get(words, (a + i % period).cast("int")))), " ")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # a lambda's argument is evaluated once, not for each word
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.transform(F.array(words), repeated)[0]).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = with_runs(docs.select("doc_id", _made_periodic(docs["doc_id"], docs["text"]).alias("text")))
    # the longest; of these the first; of these that with the smallest period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                                 (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
