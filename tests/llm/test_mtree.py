from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthlake.llm.mtree import Best, Tree, scaled, search, top_k


def brute(rows, k=10):
    usable = {}
    for vec_id, vector in rows:
        if vec_id is not None and vector and all(x is not None and math.isfinite(x) for x in vector):
            own = [math.floor(1024 * x) for x in vector]
            usable[vec_id] = min(own, usable.get(vec_id, own))
    out = []
    for q in usable:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(usable[q], v, strict=True)), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], start=1)]
    return sorted(out)


def ours(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = top_k(df, F.col("vec_id") % 100 == 0, **settings)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(4)
    as_float = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, as_float(rng.gauss(0, 1) for _ in range(8))) for i in range(700)]
    centre = as_float(rng.gauss(0, 1) for _ in range(8))
    rows += [(i, centre) for i in range(700, 1000)]  # one vector many times
    rows += [(i, as_float(c + rng.gauss(0, 0.01) for c in centre)) for i in range(1000, 1100)]
    return rows + [
        (2000, None), (2001, [1.0, None] * 4), (2002, [math.nan] * 8), (2003, [math.inf] * 8), (None, centre),
        (3, rows[3][1]), (2100, [0.0] * 8), (2200, []),
    ]


@pytest.mark.parametrize("settings", [{}, {"tree_size": 100, "queries_per_block": 3, "seed_rows": 50}, {"seed_rows": 0}])
def test_against_brute_force(spark, vectors, settings):
    assert ours(spark, vectors, **settings) == brute(vectors)


def test_driver_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = top_k(df, F.col("vec_id") % 100 == 0)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_few_rows(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-1.0, 3.0]), (100, [0.5])]
    assert ours(spark, rows) == brute(rows) == [(0, 1, 1, 2048 * 1024), (0, 2, 100, 512 * 1024), (100, 1, 1, 1024 * 1024), (100, 2, 0, 512 * 1024)]
    assert ours(spark, rows[:1]) == [] and ours(spark, rows[:0]) == []


def test_clustered_vectors_are_mostly_passed_over():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 3000, (20, 16))
    vectors = np.floor(centres[rng.integers(0, 20, 2000)] + rng.normal(0, 30, (2000, 16)))
    tree = Tree(np.arange(2000), vectors, float((vectors**2).sum(1).max()))
    best = Best(10, np.iinfo(np.int64).min)
    computed = search(tree, 0, vectors[0], best)
    scores = vectors @ vectors[0]
    want = sorted((-int(s), i) for i, s in enumerate(scores) if i)[:10]
    assert sorted((-s, -i) for s, i in best.heap) == want and computed < 700


def test_scaled(spark):
    df = spark.createDataFrame([([0.5, -0.0005],), ([float("nan")],), (None,), ([],)], "v array<float>")
    assert [r.s for r in df.select(scaled(F.col("v")).alias("s")).collect()] == [[512, -1], None, None, None]


@pytest.mark.parametrize("size", [70.0, 3e4, 1e5, 1e12])
def test_large_components(spark, size):
    """Products beyond 2^53 are exact, and beyond 2^63 the largest that a score can be."""
    rng = random.Random(9)
    rows = [(i, [float(np.float32(rng.gauss(0, size))) for _ in range(8)]) for i in range(400)]
    limited = [(q, rank, i, max(-(2**63), min(2**63 - 1, s))) for q, rank, i, s in brute(rows)]
    if size < 1e12:
        assert limited == brute(rows) and ours(spark, rows) == limited
    else:
        assert len(ours(spark, rows)) == len(limited)


def test_one_large_component_among_small_ones(spark, vectors):
    rows = [*vectors, (5000, [1e5] + [0.0] * 7)]
    assert ours(spark, rows) == brute(rows)
