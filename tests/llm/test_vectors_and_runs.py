"""Neighbours, periodic runs and centroids against brute force and SQL, with nulls, empty and long values, ties,
repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from statera.llm import centroids, neighbours, periodic
from statera.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
rnd = random.Random(7)


# ---- periodic runs ------------------------------------------------------------------------------

def runs_by_definition(words: list) -> list[tuple[int, int, int]]:
    ids = np.array([hash(w) for w in words], np.int64)
    out, n = [], len(ids)
    for p in range(1, n // 4 + 1):
        same = np.concatenate([[False], ids[:-p] == ids[p:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            smaller = any((ids[a:b + p - q] == ids[a + q:b + p]).all() for q in range(1, p))
            if b + p - a >= max(6, 4 * p) and not smaller:
                out.append((a, b + p - a, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words() -> list[int]:
    k = rnd.randint(1, 4)
    words = [rnd.randrange(k) for _ in range(rnd.randint(0, 50))]
    if rnd.random() < 0.7:
        base, at = [rnd.randrange(k) for _ in range(rnd.randint(1, 9))], rnd.randint(0, len(words))
        words[at:at] = [base[i % len(base)] for i in range(rnd.randint(1, 45))]
    return words


def test_runs_equal_their_definition():
    for _ in range(1500):
        words = some_words()
        want = runs_by_definition(words)
        assert periodic.periodic_runs(np.array(words, np.int64)) == want, words
        if len(words) > 2:  # the trees alone, without the stretches cut before
            assert sorted(periodic.runs_of_stretch(np.array(words)), key=lambda r: (r[0], r[2])) == want, words


def test_common_extensions_equal_their_definition():
    word = [rnd.randint(1, 2) for _ in range(300)]
    found = periodic.SuffixTree(word, 3).common_extensions()
    a, b = np.array([(x, y) for x in range(0, 300, 7) for y in range(300) if x != y]).T
    want = [next((i for i in range(301) if x + i == 300 or y + i == 300 or word[x + i] != word[y + i])) for x, y in zip(a, b, strict=True)]
    assert found.of(a, b).tolist() == want


def test_long_runs_take_linear_time():
    words = [rnd.randrange(2000) for _ in range(20_000)]
    assert periodic.periodic_runs(np.array(words * 5)) == [(0, 100_000, 20_000)]
    assert periodic.periodic_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]


def op12_by_definition(doc_id, text) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_definition(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def test_op12_equals_brute_force(spark, tmp_path):
    rows = [(i, " ".join(f"w{w}" for w in some_words())) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "a " * 9), (None, "b " * 9), (None, None), (204, "x y " * 8), (204, "x y " * 8),
             (205, "a\x0bb\x0ca\rb\ta\nb a b a b"), (206, " ".join(f"v{rnd.randrange(900)}" for _ in range(8000)))]
    spark.createDataFrame([(*r, 1, [1], "c", 3) for r in rows], "doc_id long, text string, n_words long, runs array<int>, collapsed string, h int") \
        .repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = collections.Counter(tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect())
    assert got == collections.Counter(op12_by_definition(*r) for r in rows)


@needs_data
def test_op12_on_documents(spark):
    import pyarrow.parquet as pq
    got = {tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    docs = pq.read_table(f"{SF}/documents.parquet")
    assert got == {op12_by_definition(i, t) for i, t in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist(), strict=True)}


# ---- vectors ------------------------------------------------------------------------------------

SHAPE = "vec_id long, embedding array<float>, label int, ids string, cell int, rank long, cluster int"


def some_vectors(n: int = 400, width: int = 64) -> list[tuple]:
    rng = np.random.default_rng(3)
    middle = rng.standard_normal((6, width))
    points = (middle[rng.integers(6, size=n)] + 0.6 * rng.standard_normal((n, width))) * rng.uniform(0.2, 3, (n, 1))
    rows = [(i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points.tolist())]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # one vector many times
    odd = [None, [], [0.0] * width, [None] + [1.0] * (width - 1), [float("nan")] + [1.0] * (width - 1), [float("inf")] * width]
    return rows + [(2000 + 20 * i, v) for i, v in enumerate(odd)] + [(None, [1.0] * width), (3000, rows[9][1]), (3000, rows[9][1])]


def written(spark, folder, rows) -> str:
    spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SHAPE).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def answers_by_definition(rows: list[tuple], k: int) -> dict[int, list[tuple[float, int]]]:
    kept = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q, a in kept:
        if q % 20 == 0:
            scored = []
            for i, b in kept:
                if i != q:
                    total = 0.0
                    for x, y in zip(a, b, strict=False):
                        total += x * y
                    scored.append((-total, i))
            out[q] = [(-s, i) for s, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("block_bytes", [neighbours.BLOCK_BYTES, 64 * 8 * 64])
def test_neighbours_of_a_sure_test_are_exact(spark, tmp_path, block_bytes):
    """With a certainty near 1 nothing is passed over: answers, scores, order and ties equal brute force."""
    rows = [*some_vectors(), (5000, [0.5] * 40), (5020, [0.25] * 80)]  # shorter and longer ones too
    vectors = spark.read.parquet(f"{written(spark, tmp_path, rows)}/embeddings.parquet")
    index = neighbours.Index(vectors, 20, certainty=1 - 1e-12, block_bytes=block_bytes)
    assert (len(index.cells.number) > 1) == (block_bytes < neighbours.BLOCK_BYTES)
    got = collections.defaultdict(list)
    for r in index.nearest(vectors.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding", "label")).collect():
        got[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    want = answers_by_definition(rows, 20)
    assert {q: [x[1:] for x in sorted(found)] for q, found in got.items()} == want
    assert all([x[0] for x in sorted(found)] == list(range(1, 21)) for found in got.values())


def test_op11_recall_and_few_candidates(spark, tmp_path):
    rows = some_vectors()
    got = collections.defaultdict(set)
    for r in QUERIES["op11_neighbours"](spark, written(spark, tmp_path / "a", rows)).collect():
        got[r["query_id"]].add(r["vec_id"])
    want = answers_by_definition(rows, 20)
    assert got.keys() == want.keys()
    hits = [len(got[q] & {i for _, i in found}) / len(found) for q, found in want.items()]
    assert np.mean(hits) >= 0.95
    few = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (21, [2.0, 1.0])]
    got = {tuple(r) for r in QUERIES["op11_neighbours"](spark, written(spark, tmp_path / "b", few)).collect()}
    assert got == {(0, 1, 20, 4.0), (0, 2, 21, 4.0), (20, 1, 21, 5.0), (20, 2, 0, 4.0)}


def test_chi_square_quantiles():
    # fixed values of the distribution
    assert [round(neighbours.quantile(p, m), 3) for p, m in ((0.95, 2), (0.95, 8), (0.9, 10))] == [5.991, 15.507, 15.987]


def sql_rows(folder: str, name: str) -> collections.Counter:
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet/*.parquet')")
    return collections.Counter(con.sql(SQL[name]).fetchall())


def test_op13_equals_its_sql(spark, tmp_path):
    folder = written(spark, tmp_path, some_vectors() + [(4000, [0.5] * 63)])
    got = collections.Counter(tuple(r) for r in QUERIES["op13_centroids"](spark, folder).collect())
    assert got == sql_rows(folder, "op13_centroids")
    assert sum(got.values()) == 400 + 150 + 1 + 1 + 2  # with the zero vector and that without an id


def test_pivots_spare_distances_and_lose_none():
    rng = np.random.default_rng(5)
    rows = (rng.integers(-9000, 9000, (9, 16))[rng.integers(9, size=3000)] + rng.integers(-700, 700, (3000, 16))).astype(np.int64)
    pivots, middle = rows[:12], np.concatenate([rows[20:27], rows[20:21]])  # two equal centroids: a tie
    chosen, best, measured = centroids.nearest_centroid(rows, centroids._to_pivots(rows, pivots), pivots, middle)
    exact = np.stack([((rows - c) ** 2).sum(axis=1) for c in middle], axis=1)
    assert (chosen == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert measured < 0.5 * exact.size


@pytest.mark.parametrize("name", ["op11_neighbours", "op13_centroids"])
def test_without_usable_vectors(spark, tmp_path, name):
    some = QUERIES[name](spark, written(spark, tmp_path / "c", some_vectors(30)))
    for i, rows in enumerate(([], [(1, None), (20, [])])):
        none = QUERIES[name](spark, written(spark, tmp_path / str(i), rows))
        assert none.collect() == [] and none.dtypes == some.dtypes


def test_periodic_runs_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect() == []
