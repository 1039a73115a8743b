"""Repeat removal against counting every string."""

import hashlib
import random
from collections import Counter

import numpy as np

from sitewright.llm import repeats
from sitewright.llm.queries import QUERIES


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(t) else 0
        out.append((len(t), int(gone.sum()), runs, np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return out


def test_query_against_every_string(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = brute([(r.text or "").encode() for r in docs], 200)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op5_suffix_array_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {r.doc_id: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for r, w in zip(docs, want)}


def test_random_texts_of_few_letters(spark):
    """Short lengths and few letters give repeats that overlap, nest, and end anywhere in a phrase."""
    rng = random.Random(4)
    base = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 90))) for _ in range(40)]
    texts = base + [a[rng.randint(0, 30) :] + b[: rng.randint(0, 60)] for a, b in zip(base, base[1:])] + ["ab" * 40, "a" * 70, "a" * 30, "ab" * 15 + "c" + "ba" * 15]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for length in (20, 33):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(docs, length=length).collect()}
        assert got == dict(enumerate(brute([t.encode() for t in texts], length)))


def test_long_repeats_with_edits(spark):
    rng = random.Random(6)
    page = [" ".join("".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randint(1, 9))) for _ in range(900)) for _ in range(3)]
    texts = [page[0], page[0], page[1], page[1][:2000] + "X" + page[1][2000:3000] + "Y" + page[1][3150:], page[2], "z" + page[2][500:900] + page[0][100:280], page[2][901:1101]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(docs).collect()}
    assert got == dict(enumerate(brute([t.encode() for t in texts], 200)))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "x" * 199), (4, "x" * 199), (5, "y" * 200), (None, "w" * 300_000), (7, "same row " * 30), (7, "same row " * 30), (8, "unlike any other " + "".join(map(chr, range(300, 600))))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS kind", "'' AS keys")
    got = sorted(((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(docs).collect()))
    n8 = len(rows[-1][1].encode())
    assert got == [(0, 300_000, 300_000, 1), (1, 0, 0, 0), (2, 0, 0, 0), (3, 199, 0, 0), (4, 199, 0, 0), (5, 200, 0, 0), (7, 270, 270, 1), (7, 270, 270, 1), (8, n8, 0, 0)]
    assert repeats.remove_repeats(docs.where("false")).count() == 0
