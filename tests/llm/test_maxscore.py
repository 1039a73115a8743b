"""Exact top-k against scoring every pair."""

import math
import random

import numpy as np

from sitewright.llm import maxscore


def test_shards_and_blocks_against_all_pairs(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) * (3 if t == 0 else 1) for t in range(6)] if i % 7 else [0.5] * 6) for i in range(400)]
    vectors = maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    asked = vectors.where("vec_id % 50 = 0")
    q = {i: np.floor(np.array(x, np.float32).astype(float) * 256).astype(int) for i, x in rows}
    want = [(a, n, b, s) for a in range(0, 400, 50) for n, (s, b) in enumerate(sorted(((int(q[a] @ q[b]), b) for b in q if b != a), key=lambda x: (-x[0], x[1]))[:5], 1)]
    for shard, block in ((50, 3), (8192, 4096)):
        got = sorted(tuple(r) for r in maxscore.top_k(vectors, asked, shard=shard, block=block).select("query_id", "rank", "vec_id", "score").collect())
        assert got == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, []), (6, [1.0]), (7, [1.0, -0.001]), (8, [1.0, 5.0])]
    vectors = maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS q", "2 AS shard"))
    got = sorted(tuple(r) for r in maxscore.top_k(vectors, vectors.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 6, 65536), (0, 2, 7, 65536), (0, 3, 8, 65536), (0, 4, 5, 0)]
    assert maxscore.top_k(vectors.where("false"), vectors.where("false")).count() == 0
    assert maxscore.top_k(vectors.where("vec_id = 0"), vectors.where("vec_id = 0")).count() == 0


def test_large_components(spark):
    rng = random.Random(3)
    sizes = [1.0, 1e6, 3e7, 1e9, 1e15, 1e300, -1e300]
    rows = [(i, [rng.choice(sizes) * rng.choice([-1, 1, 0.5]) for _ in range(3)] if i % 3 else [rng.gauss(0, 9) for _ in range(3)]) for i in range(120)]
    vectors = maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    top = 2**63 - 1
    held = lambda x: min(max(x, -top - 1), top)
    q = {i: [held(math.floor(c * 256)) if abs(c) < 1e20 else held(int(c)) for c in x] for i, x in rows}
    score = {(a, b): held(sum(x * y for x, y in zip(q[a], q[b]))) for a in (0, 50, 100) for b in q if a != b}
    want = [(a, n, b, s) for a in (0, 50, 100) for n, (s, b) in enumerate(sorted(((s, b) for (x, b), s in score.items() if x == a), key=lambda x: (-x[0], x[1]))[:5], 1)]
    for shard in (30, 8192):
        assert sorted(tuple(r) for r in maxscore.top_k(vectors, vectors.where("vec_id % 50 = 0"), shard=shard).collect()) == want
