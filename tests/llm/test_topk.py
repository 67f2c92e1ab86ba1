from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feira.llm import topk

SCHEMA = "vec_id long, embedding array<double>, score string, ids string"


def brute(rows, k=10):
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in whole:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, a in queries.items():
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)
    found = topk.top_k(df, F.col("q_id") % 100 == 0, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_random_vectors_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "SUMMARIES", 8)
    draw = np.random.default_rng(1)
    # Neighbouring ids are alike, so whole blocks can be left out.
    centres = draw.normal(size=(70, 12))
    check(spark, [(i, (centres[i // 10] + draw.normal(size=12) * 0.1).tolist()) for i in range(700)])


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, -2.0, 0.5]), (100, [0.0, 0.0, 0.0]), (1, None), (2, [1.0, None, 1.0]), (3, [float("nan"), 1.0, 1.0]),
        (4, [float("inf"), 0.0, 0.0]), (5, [1.0, 1.0]), (6, []), (None, [1.0, 1.0, 1.0]), (7, [1e9, -1e9, 3e8]),
        (8, [0.3, 0.3, 0.3]), (8, [0.3, 0.3, 0.3]), (200, [1.0, 1.0, 1.0]), (200, [0.5, 1.0, 1.0]), (-100, [9.0, 1.0, 0.1]),
    ]
    check(spark, rows)
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("q_id") % 100 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame([(1, [1.0], "", "")], SCHEMA), F.col("q_id") % 100 == 0).count() == 0


def test_common_vector(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 32)
    draw = np.random.default_rng(2)
    same = draw.normal(size=8).tolist()
    check(spark, [(i, same if i % 3 else draw.normal(size=8).tolist()) for i in range(400)])


def test_large_components_stay_exact():
    a = np.array([[2**40, 1], [3, -(2**45)]], np.int64)
    assert topk._product(a, a[:1] // 2**30).tolist() == [[2**50], [3 * 2**10]]
    with pytest.raises(OverflowError):
        topk._product(a, a)


def test_bounds_hold():
    draw = np.random.default_rng(3)
    q, v = draw.integers(-900, 900, (20, 16)), draw.integers(-900, 900, (60, 16))
    most = topk.bounds(q, v.max(axis=0)[None], v.min(axis=0)[None])[:, 0]
    assert (most >= (q @ v.T).max(axis=1)).all()


@pytest.mark.parametrize("alike, least, most", [(True, 0.02, 0.35), (False, 0.99, 1.0)])
def test_blocks_are_left_out_where_neighbours_are_alike(spark, monkeypatch, alike, least, most):
    """The share of (query, block) pairs that are scored: few for clustered ids, all for unordered vectors."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(100, 48))
    near = [centres[i // 16] + draw.normal(size=48) * 0.05 for i in range(1600)]
    rows = [(i, near[i if alike else (i * 611) % 1600].tolist()) for i in range(1600)]
    taken, real = [], topk.wanted

    def counted(*args):
        wants = real(*args).cache()
        taken.append(wants.selectExpr("sum(size(rows))").first()[0] or 0)
        return wants

    monkeypatch.setattr(topk, "wanted", counted)
    check(spark, rows)
    assert least <= sum(taken) / (16 * 100) <= most
