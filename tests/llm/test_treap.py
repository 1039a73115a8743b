"""Ranked search over the K2-treap against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np

from sitewright.llm import treap

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_rank(docs, items, k=10):
    """(item_id, rank, doc_id, score) of rows (id, text)."""
    counted = [(d, Counter(x.translate(LOWER) for x in TERM.findall(t or ""))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(x for _, c in counted for x in c)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, set()).update(x.translate(LOWER) for x in TERM.findall(t or ""))
    out = []
    for i, terms in asked.items():
        scored = []
        for d, c in counted:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * c[x] // (1000 * c[x] + 8 * m)) for x in terms if c[x])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(i, r, None if no else d, -s) for r, (s, no, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def key(rows):
    return sorted(map(tuple, rows), key=str)


def test_cells_and_quarters():
    rng = np.random.default_rng(1)
    points = np.unique(rng.integers(0, 50, (300, 2)), axis=0)
    impacts = rng.integers(1, 99, len(points))
    grid = np.zeros((64, 64), np.int64)
    grid[points[:, 0], points[:, 1]] = impacts
    t = treap.Treap(points[:, 0], points[:, 1], impacts)
    cells = {(0, 0): 0}
    assert t.levels == 6 and t.top[0] == grid.max()
    for level in range(t.levels):
        side = 64 >> (level + 1)
        below = {}
        for (r, c), cell in cells.items():
            for which in range(4):
                at = (2 * r + which // 2, 2 * c + which % 2)
                child = int(t.quarter(np.array([cell]), np.array([which]))[0])
                top = grid[at[0] * side : (at[0] + 1) * side, at[1] * side : (at[1] + 1) * side].max()
                assert (child >= 0) == (top > 0) and (child < 0 or t.top[child] == top)
                if child >= 0:
                    below[at] = child
        cells = below
    assert len(cells) == len(points)


def test_random_documents_in_small_grids(spark, monkeypatch):
    rng = random.Random(13)
    words = [w for i in range(40) for w in [f"w{i}"] * (40 // (i + 1))] + ["Straße", "É", "éa", "B4"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(700)] + [(700 + i, "w1 w2 w30 w31") for i in range(30)]
    items = [(i, ", ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(90)]
    a, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    want = key(slow_rank(docs, items))
    assert key(treap.rank(a, b).collect()) == want
    assert key(treap.rank(a, b, terms_a_pass=10).collect()) == want
    asked = [(np.arange(5), np.array([5, 4, 3, 2, 1]))]
    rows, columns = rng.choices(range(5), k=400), rng.choices(range(64), k=400)
    points = np.unique(np.stack([rows, columns]), axis=1)
    cells = treap.Treap(points[0], points[1], points.sum(0) % 7 + 1)
    full = np.zeros(64, np.int64)
    np.add.at(full, points[1], (5 - points[0]) * (points.sum(0) % 7 + 1))
    monkeypatch.setattr(treap, "OPENED", 1)
    ((found, scores),) = treap.best_first(cells, asked, np.zeros(1, np.int64), 3)
    order = np.lexsort((found, -scores))[:3]
    assert found[order].tolist() == np.lexsort((np.arange(64), -full))[:3].tolist() and all(full[found] == scores) and len(found) < 40


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "?!"), (None, "red fox"), (None, "red fox"), (5, "Red FOX"), (5, "red fox"), (6, "fox " * 100_000), (7, "blue"), (8, "x" * 300_000)] + [(i, "grass") for i in range(20, 60)]
    items = [(1, "the red-fox"), (2, None), (3, ""), (None, "blue"), (4, "nothing known"), (5, "grass"), (5, "blue"), (5, "blue")]
    a = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'t' AS terms", "1 AS rank", "2 AS item_id")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'d' AS doc_id", "3 AS score")
    assert key(treap.rank(a, b).collect()) == key(slow_rank(docs, items))
    for x, y in ((a.where("false"), b), (a, b.where("false")), (a, b.where("item_id = 2"))):
        assert treap.rank(x, y).count() == 0
    assert treap.rank(a, b).dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
