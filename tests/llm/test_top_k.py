"""Exact search against scoring every pair."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelmart.llm import top_k as module
from parcelmart.llm.top_k import Search, top_k

SCHEMA = "vec_id long, embedding array<double>, score string, rank string, cell string, row string, number string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *["clash"] * 5) for i, v in rows], SCHEMA)


def brute(rows, k):
    valid = [(n, i, [math.floor(64 * x) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for n, i, q in valid:
        if i is None or i % 20:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for m, j, v in valid if m != n]
        for rank, (s, none, j) in enumerate(sorted(scores)[:k], 1):
            out[i, rank, None if none else j, -s] += 1
    return out


def search(spark, rows, k=20, parts=3):
    got = top_k(frame(spark, rows).repartition(parts), F.col("vec_id") % 20 == 0, k)
    return Counter(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())


@pytest.fixture
def small_cells(monkeypatch):
    """Many cells, blocks and batches."""
    for name, value in {"QUERY_ROWS": 7, "QUERY_BATCH": 3, "LEAST_ROWS": 50, "FIRST_BLOCK": 16, "BLOCK_ROWS": 64}.items():
        monkeypatch.setattr(module, name, value)


def test_dense_sparse_and_equal_vectors(spark, small_cells):
    rng = np.random.default_rng(3)
    dense = rng.normal(size=(300, 12)) * 0.3
    sparse = np.where(rng.random((200, 12)) < 0.2, rng.random((200, 12)), 0)
    same = np.tile(dense[5], (150, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([dense, sparse, same]))]
    random.Random(2).shuffle(rows)
    assert search(spark, rows) == brute(rows, 20)


def test_messy_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.5]), (0, [1.0, -0.5]), (20, [0.3]), (40, []), (60, None), (80, [1.0, None]), (100, [nan, 1.0]), (120, [inf]),
            (None, [2.0, 2.0]), (None, [2.0, 2.0]), (1, [-0.01, 0.0]), (2, [1e9, 1.0]), (-20, [0.2, 0.2, 0.2])]
    assert search(spark, rows) == brute(rows, 20)
    assert search(spark, rows, 2) == brute(rows, 2)
    assert not search(spark, []) and not search(spark, [(0, [1.0])]) and not search(spark, [(1, [1.0]), (2, [1.0])])


def test_scores_beyond_exact_doubles(spark):
    rows = [(20 * i, [1e7 + i, 3e6 + 7 * i]) for i in range(30)] + [(1, [1e12, 1e12])]
    capped = Counter()
    for (i, rank, j, s), n in brute(rows, 5).items():
        capped[i, rank, j, min(s, 2**63 - 1)] += n
    assert search(spark, rows, 5) == capped


def test_bounds_save_probes():
    """Most rows are settled by the essential terms alone."""
    rng = np.random.default_rng(1)
    vectors = np.floor(64 * rng.normal(size=(4000, 32)) / 6)
    found = Search(range(4000, 4020), list(range(20)), np.floor(64 * rng.normal(size=(20, 32)) / 6), 10)
    for start in range(0, 4000, 500):
        found.add(list(range(start, start + 500)), np.arange(start, start + 500), vectors[start : start + 500])
    assert found.probed < 0.5 * 3 * 20 * 4000
    scores = found.vectors @ vectors.T
    want = [sorted((-s, r) for r, s in enumerate(row))[:10] for row in scores]
    got = [[(-s, r) for s, r in zip(found.scores[i], found.rows[i])] for i in range(20)]
    assert got == want
