"""Exact top-k search against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from placeflow.llm import vector_topk as V


def brute(rows, k, every, scale):
    """Rows are (id, vector); a query row is left out once, by its place."""
    fine = []
    for i, v in rows:
        if v is None or any(x is None or not math.isfinite(x) or not math.isfinite(x * scale) for x in v):
            continue
        fine.append((i, [int(math.floor(x * scale)) for x in v]))
    out = []
    for a, (q, u) in enumerate(fine):
        if q is None or q % every:
            continue
        scores = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(u, v)))), i is None, i or 0)
                        for b, (i, v) in enumerate(fine) if b != a)
        out += [(q, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("uid", "id", "cell", "vec", "rank")})
    return sorted(map(tuple, V.top_k(df, **how).collect()), key=repr)


@pytest.mark.parametrize("sample, block", [(4096, 8192), (40, 16), (3, 1)])
def test_equals_brute_force(spark, sample, block):
    rng = random.Random(sample)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, .1) for c in centres[i % 5]]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(80)] + [(10, rows[3][1])] * 3  # copies and a repeated id
    assert run(spark, rows, k=5, every=10, scale=256, sample=sample, block=block) == brute(rows, 5, 10, 256)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, None), (100, [None, 1.0]), (150, [nan, 1.0]), (200, [inf, 0.0]), (250, []), (300, [0.5]),
            (None, [3.0, 3.0]), (1, [-1e30, 2.0]), (2, [1e17, -1e17]), (350, [1e17, 1e17, 5.0]), (3, [1e308, 1.0]), (4, [1e300, 1.0]), (400, [1e300, 1.0])]
    assert run(spark, rows, k=5, every=50, scale=256) == brute(rows, 5, 50, 256)
    assert run(spark, rows[:1], k=5, every=50, scale=256) == []
    assert run(spark, [(0, [1.0]), (50, [2.0])], k=5, every=50, scale=256) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
    assert V.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_bounds_leave_cells_out():
    """Far cells are not needed; a cell that may hold a better score is."""
    import numpy as np
    rng = np.random.default_rng(0)
    pivots = np.eye(6) * 1000
    data = np.repeat(pivots, 50, axis=0) + rng.normal(0, 5, (300, 6)).round()
    cell = np.repeat(np.arange(6), 50)
    radius = np.array([V.norms(data[cell == j] - pivots[j]).max() for j in range(6)])
    q = data[::25]
    low = V.lower_bounds(q, np.arange(300)[::25], data[::7], np.arange(300)[::7], 5)
    to = V.needed(q, low, pivots, radius)
    assert to.sum() < to.size / 3
    best = np.argsort(-(q @ data.T), axis=1)[:, :6]
    assert all(to[i, cell[b]] for i in range(len(q)) for b in best[i])
