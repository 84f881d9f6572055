"""Adaptive scan against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from postloom.llm.adaptive_scan import neighbours, sound
from postloom.llm.storage import table

SCHEMA = "vec_id long, embedding array<float>"


def _brute(rows, queries, nearest=10):
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for q, v in queries:
        far = np.sqrt(((matrix - np.array(v, np.float32).astype(np.float64)) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        best = np.lexsort((ids, far))[:nearest]
        out[q] = [(int(ids[i]), float(far[i])) for i in best if np.isfinite(far[i])]
    return out


def _found(frame):
    out: dict = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_on_whole_table(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    truth = _brute(rows, [r for r in rows if r[0] % 100 == 0])
    found = _found(neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0)))
    assert set(found) == set(truth)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in truth[q]}) for q in truth)
    assert all(len(f) == 10 for f in found.values())
    assert hits / (10 * len(truth)) >= 0.95
    exact = {q: dict(_brute(rows, [(q, dict(rows)[q])], len(rows))[q]) for q in list(truth)[:5]}
    for q, own in exact.items():
        assert all(abs(own[i] - s) < 1e-12 for i, s in found[q])


def test_ties_and_a_crowd_of_equal_vectors(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=20).tolist()) for i in range(600)]
    rows += [(1_000 + i, rows[0][1]) for i in range(1_500)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    queries = [r for r in rows if r[0] in (0, 5, 1_000, 1_007)]
    found = _found(neighbours(vectors, vectors.where(F.col("vec_id").isin(0, 5, 1_000, 1_007))))
    truth = _brute(rows, queries)
    for q in (0, 1_000, 1_007):
        assert [i for i, _ in found[q]] == [i for i, _ in truth[q]]
    assert len({i for i, _ in found[5]} & {i for i, _ in truth[5]}) >= 9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (2, [0.0, 1.0]),
        (100, [1.0, 1.0]),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "2 AS list")
    assert {r.vec_id for r in sound(vectors).collect()} == {1, 2, 100}
    found = _found(neighbours(vectors, vectors))
    assert found == {1: [(100, 1.0), (2, 2**0.5)], 2: [(100, 1.0), (1, 2**0.5)], 100: [(1, 1.0), (2, 1.0)]}
    empty = spark.createDataFrame([], SCHEMA)
    assert neighbours(empty, vectors).collect() == [] and neighbours(vectors, empty).collect() == []
