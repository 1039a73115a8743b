"""Katz scoring against a plain model over whole dictionaries."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from sitewright.llm import katz
from sitewright.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
END = "</s>"


class Plain:
    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for t in texts:
            self.words.update(t)
            self.pairs.update(zip([None, *t], t))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.off1, self.off2 = self.discounts(self.words), self.discounts(self.pairs)
        left = sum(c * (1 - self.off1(c)) for c in self.words.values())
        self.unknown, self.scale = (left / self.n, 1) if left else (1 / (self.n + 1), self.n / (self.n + 1))
        self.after = {}
        for (a, b), c in self.pairs.items():
            self.after.setdefault(a, {})[b] = c

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())

        def off(r):
            if r > 5:
                return 1.0
            try:
                rest = 6 * n[6] / n[1]
                d = ((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest)
            except ZeroDivisionError:
                d = 0
            return d if 0 < d < 1 else (r - 0.5) / r

        return off

    def word(self, w):
        c = self.words[w]
        return self.scale * c * self.off1(c) / self.n if c else self.unknown

    def chance(self, a, w):
        seen = self.after.get(a)
        if not seen:
            return self.word(w)
        total = sum(seen.values())
        freed = sum(c * (1 - self.off2(c)) for c in seen.values())
        keep, left = (1, freed / total) if freed else (total / (total + 1), 1 / (total + 1))
        if w in seen:
            return keep * seen[w] * self.off2(seen[w]) / total
        return left / (1 - sum(map(self.word, seen))) * self.word(w)


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return ["".join(x.lower() if "A" <= x <= "Z" else x for x in w) for w in text.split(" ") if w] + [END]


def expect(rows, held):
    texts = [(split(t or ""), held(d)) for d, t in rows]
    m = Plain([t for t, h in texts if not h])
    return sorted(
        (str(d), h, len(t), sum(m.words[w] > 0 for w in t), m.n, round(sum(math.log10((m.words[w] + 1) / (m.n + m.v + 1)) for w in t), 6), round(sum(math.log10(m.chance(a, w)) for a, w in zip([None, *t], t)), 6))
        for (d, _), (t, h) in zip(rows, texts)
    ), m


def got(frame):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6) + 0.0, round(r.score, 6) + 0.0) for r in frame.collect())


def is_held(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2


@pytest.mark.parametrize("slot", [katz.SLOT, 20])
def test_query_against_plain_model(spark, monkeypatch, slot):
    monkeypatch.setattr(katz, "SLOT", slot)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert got(QUERIES["op4_katz_scoring"](spark, SF_DIR)) == expect(rows, is_held)[0]


def test_random_words_and_normalisation(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices("abcdefghij", range(1, 11), k=rng.randint(0, 30)))) for i in range(120)] + [(200, "Z new\x0bword"), (201, None), (None, "a b"), (202, "a b"), (202, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "true AS train", "2 AS keys")
    want, model = expect(rows, is_held)
    assert got(katz.score(docs, katz.every_seventh())) == want
    for a in (None, "a", "j", "never seen"):
        assert abs(sum(model.chance(a, w) for w in [*model.words, "unknown"]) - 1) < 1e-9


def test_small_corpora(spark):
    schema = "doc_id long, text string"
    for rows in ([(9, "x y")], [(0, "x " * 500)], [(0, "x " * 500), (1, None)]):
        for held in (True, False):
            docs = spark.createDataFrame(rows, schema)
            out = katz.score(docs, katz.F.lit(held)).collect()
            assert len(out) == len(rows) and all(math.isfinite(r.score) and r.held_out == held for r in out)
            if not held:
                assert got(katz.score(docs, katz.F.lit(held))) == expect(rows, lambda d: False)[0]
    assert katz.score(spark.createDataFrame([], schema), katz.every_seventh()).count() == 0


def test_discounts_fall_back():
    assert np.allclose(katz.discounts(np.zeros(6)), [0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9])
