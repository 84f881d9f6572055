"""Vertical scan against plain loops over all rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postloom.llm import vertical_scan
from postloom.llm.vertical_scan import hard_negatives, usable

SCHEMA = "vec_id long, embedding array<double>, label int"


def _brute(rows, anchors):
    whole = {i: (l, [math.floor(256 * x) for x in v]) for i, v, l in rows}
    out = []
    for a in sorted(anchors):
        label, vector = whole[a]
        scored = sorted(
            (-sum(p * q for p, q in zip(vector, v)), i, l) for i, (l, v) in whole.items() if i != a
        )
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, p, r, i, -s, -n) for r, (n, i, _) in enumerate(fits, 1)]
    return sorted(out)


def _found(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("block, slab", [(4_096, 1_024), (60, 7)])
def test_equals_all_pairs(spark, monkeypatch, block, slab):
    monkeypatch.setattr(vertical_scan, "BLOCK", block)
    monkeypatch.setattr(vertical_scan, "SLAB", slab)
    draw = np.random.default_rng(3)
    middle = draw.normal(size=(4, 20))
    rows = [
        (i, (middle[i % 4] + draw.normal(size=20) * (1 + i % 3)).tolist(), int(i % 5 == 0))
        for i in range(400)
    ]
    # A label with a third of all rows, equal vectors, and scores that tie.
    rows += [(1_000 + i, rows[0][1], 7) for i in range(200)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = _found(hard_negatives(vectors, vectors.where("vec_id % 50 = 0")))
    assert found == _brute(rows, [r[0] for r in rows if r[0] % 50 == 0])
    assert len({r[0] for r in found}) > 5


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.6, 0.1], 2), (2, [0.6, 0.1], 2),
        (3, None, 1), (4, [], 1), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (7, [None, 1.0], 2),
        (8, [0.7, 0.1], None), (9, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (10, [0.0, 0.0], 2),
        (11, [1e30, 1.0], 2), (50, [-1.0, 0.0], 3),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "2 AS score", "3 AS slab")
    assert sorted(r.vec_id for r in usable(vectors).collect()) == [0, 1, 2, 10, 50]
    # 0 and 1 are each other's only positive; 50 is alone in its label.
    kept = [(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.6, 0.1], 2), (10, [0.0, 0.0], 2), (50, [-1.0, 0.0], 3)]
    assert _found(hard_negatives(vectors, vectors)) == _brute(kept, [r[0] for r in kept])
    empty = spark.createDataFrame([], SCHEMA)
    assert _found(hard_negatives(empty, vectors)) == [] == _found(hard_negatives(vectors, empty))


def test_zero_and_negative_scores(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 2.0], 2), (3, [-1.0, 0.0], 1), (4, [-0.7, 0.0], 2)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = _found(hard_negatives(vectors, vectors.where(F.col("vec_id") == 0)))
    assert found == _brute(rows, [0]) == [(0, 1, 1, 2, 0, 0)]
