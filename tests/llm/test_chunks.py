"""Chunk fingerprints against a plain reading of their rules."""

import hashlib
import random

import numpy as np

from sitewright.llm import chunks
from sitewright.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def slow_chunks(data):
    """{(digest, length)} by one byte at a time."""
    out, start, h = set(), 0, 0
    for i, b in enumerate(data):
        h = (h * 2 + int(chunks.GEAR[b])) & 0xFFFF
        size = i + 1 - start
        mask = int(chunks.RARE if size < chunks.NORMAL else chunks.COMMON)
        rare_edge = size == chunks.NORMAL and h & int(chunks.RARE) == 0
        if i + 1 == len(data) or size >= chunks.LEAST and (h & mask == 0 or rare_edge) or size == chunks.MOST:
            out.add((chunks.xxhash.xxh64_intdigest(bytes(data[start : i + 1])) >> 16, size))
            start = i + 1
    return out


def as_set(fingerprint):
    return {(int(x) >> 8, int(x) & 255) for x in chunks.chunks_of(fingerprint)}


def test_query_against_one_byte_at_a_time(spark):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    got = {r.doc_id: r for r in QUERIES["op9_document_fingerprints"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    near = lambda a, b: sum(n for _, n in a & b) / sum(n for _, n in a)
    for (d, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        own, other, following = (slow_chunks(x.encode()) for x in (text, edited, after))
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert as_set(r.fingerprint) == own and as_set(r.edited_fingerprint) == other
        assert abs(r.near_edited - near(own, other)) < 1e-12 and abs(r.near_next - near(own, following)) < 1e-12


def test_a_shift_moves_few_chunks():
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh ") for _ in range(20_000)).encode()
    a, b = chunks.chunk_sets([text, b"new start " + text])
    assert chunks.containment(a, b) > 0.99 and np.array_equal(a, chunks.chunks_of(chunks.fingerprint_of(a)))
    sizes = a & np.uint64(255)
    assert sizes.max() <= chunks.MOST and np.sort(sizes)[1] >= chunks.LEAST


def test_odd_rows(spark):
    rows = [(5, "x" * 400_000), (1, None), (2, ""), (2, ""), (9, "one two three four"), (None, "first of all"), (7, "é" * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS bucket", "true AS guest", "'' AS fingerprint")
    got = {(r.doc_id, r.n_chars): r for r in chunks.fingerprints(docs).collect()}
    assert chunks.fingerprints(docs).count() == 7
    assert got[1, 0].fingerprint == "" and got[1, 0].near_next == 1.0 and got[2, 0].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[7, 9].edited_sha256 == hashlib.sha256(("é" * 7 + "on").encode()).hexdigest()
    assert got[9, 18].edited_sha256 == hashlib.sha256(b"one two three " + b"firs").hexdigest()
    assert got[None, 12].edited_sha256 == hashlib.sha256(b"first of ").hexdigest()
    assert chunks.fingerprints(docs.where("false")).count() == 0
    assert chunks.fingerprints(docs.where("doc_id = 9")).first().near_next == 1.0
