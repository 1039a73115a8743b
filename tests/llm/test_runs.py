"""Runs of words against a comparison of all lags."""

import hashlib
import random
import zlib

import numpy as np

from sitewright.llm import runs
from sitewright.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def slow_runs(words):
    """Every stretch with smallest period q, at least max(6, 4 q) long, that cannot grow."""
    out = {}
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i - q, j), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def slow_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = slow_runs(words)
    best = sorted(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))[0] if found else (None,) * 3
    gone = {i for s, n_, q in found for i in range(s + q, s + n_)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n_},{q}\n" for s, n_, q in found)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def rows(df):
    return [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in df.collect()]


def test_query_against_all_lags(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = rows(QUERIES["op12_run_detection"](spark, "/root/testdata/sf0.001"))
    assert sorted(got) == sorted(slow_row(r.doc_id, r.text) for r in docs)
    assert sum(r[1] > 0 for r in got) > 10


def test_random_words(spark):
    """Few words and short units give runs that nest, overlap, touch and have multiples of their period."""
    rng = random.Random(12)
    texts = []
    for _ in range(500):
        words = []
        while len(words) < rng.randint(0, 90):
            unit = rng.choices("abc", k=rng.randint(1, 7))
            words += unit * rng.randint(1, 7) + unit[: rng.randint(0, 3)]
        if rng.random() < 0.3:
            words = words * 4
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r.doc_id: list(zip(r.starts, r.lengths, r.periods)) for r in runs.find_runs(docs).collect()}
    assert got == {i: slow_runs(t.split()) for i, t in enumerate(texts)}
    assert sum(len(x) for x in got.values()) > 1000 and max(q for x in got.values() for _, _, q in x) > 15


def test_hot_words_stay_cheap():
    """A word that fills a long text, and runs within runs: no pair of occurrences is written out."""
    n = 1_000_000
    assert runs.runs_of(np.zeros(n, np.int64), np.array([0, n])) == [[(0, n, 1)]]
    unit = np.r_[np.zeros(6, np.int64), 1]
    found = runs.runs_of(np.tile(unit, 20_000), np.array([0, 140_000]))[0]
    assert found[0] == (0, 6, 1) and found[1] == (0, 140_000, 7) and len(found) == 20_001
    noise = np.random.default_rng(3).integers(0, 2, 300_000)
    assert all(length >= max(6, 4 * q) for _, length, q in runs.runs_of(noise, np.array([0, len(noise)]))[0])


def test_odd_rows(spark):
    long = "x " * 200_000 + "y"
    odd = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (None, "a a a a a a"), (None, "a a a a a a"), (5, "a a a a a"), (5, "a a a a a a a a"), (6, long), (7, "a b a b a b a b"), (7, "ß " * 6 + "z z z z z z")]
    docs = spark.createDataFrame(odd, SCHEMA).selectExpr("*", "'q' AS start", "1 AS n_runs", "2 AS collapsed")
    got = runs.find_runs(docs)
    by = sorted(((r.doc_id or 0, r.n_words, r.n_runs, r.start, r.period, r.collapsed) for r in got.collect()), key=str)
    want = [(1, 0, 0, None, None, ""), (2, 0, 0, None, None, ""), (3, 0, 0, None, None, ""), (0, 6, 1, 0, 1, "a"), (0, 6, 1, 0, 1, "a"), (5, 5, 0, None, None, "a a a a a"), (5, 7, 1, 1, 1, "a a a"), (6, 200_001, 1, 0, 1, "x y"), (7, 8, 1, 0, 2, "a b"), (7, 12, 2, 0, 1, "ß z")]
    assert by == sorted(want, key=str)
    assert runs.find_runs(docs.where("false")).count() == 0 and runs.find_runs(docs, keep_text=False).columns[:3] == ["doc_id", "n_words", "n_runs"]
