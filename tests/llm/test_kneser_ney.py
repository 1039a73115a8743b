"""Kneser-Ney perplexities against a plain recursive model, and held-out accuracy of the classifier."""

import math
import random
import zlib
from collections import Counter

from sitewright.llm import kneser_ney
from sitewright.llm.common import table
from sitewright.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
PAD, END = -1, 256


def symbols(text):
    return [PAD] * 4 + list((text or "").encode()) + [END]


class Plain:
    def __init__(self, texts):
        self.c = {5: Counter(tuple(s[i - 4 : i + 1]) for s in map(symbols, texts) for i in range(4, len(s)))}
        for k in (4, 3, 2, 1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.off, self.after = {}, {}
        for k, counts in self.c.items():
            n = Counter(counts.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
            self.off[k] = [0]
            for r in (1, 2, 3):
                d = r - (r + 1) * y * n[r + 1] / n[r] if y is not None and n[r] else 0
                self.off[k].append(d if 0 < d < r else r / 2)
            for g, c in counts.items():
                self.after.setdefault(g[:-1], {})[g[-1]] = c

    def chance(self, gram):
        if not gram:
            return 1 / 257
        seen, off = self.after.get(gram[:-1]), self.off[len(gram)]
        lower = self.chance(gram[1:])
        if not seen or len(gram) == 1 and not self.c[1]:
            return lower
        c, total = seen.get(gram[-1], 0), sum(seen.values())
        return (max(c - off[min(c, 3)], 0) + sum(off[min(x, 3)] for x in seen.values()) * lower) / total


def test_against_plain_model(spark):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choices("abcde é\n", range(8, 0, -1), k=rng.randint(0, 60))), rng.choice(["en", "de"])) for i in range(90)]
    rows += [(500, None, None), (500, None, None), (None, "abc", "en"), (501, "zzz", "xx"), (502, "", "en"), (2**60 + 1, "bead", "en"), (2**60 + 2, "cafe", "en"), (2**60 + 3, "dace", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS gram", "2 AS c", "true AS train", "3 AS block")
    trusted = spark.createDataFrame([(i,) for i in [*range(0, 60), 77, 77, None, 2**60 + 1, 2**60 + 2]], "doc_id long")
    learns = lambda d: d is not None and (d < 60 or d in (77, 2**60 + 1, 2**60 + 2)) and zlib.crc32(str(d).encode()) % 5 > 0
    model = Plain([t for d, t, _ in rows if learns(d)])
    want = sorted((str(d), str(lang), len(symbols(t)) - 4, round(sum(math.log10(model.chance(tuple(s[i - 4 : i + 1]))) for s in [symbols(t)] for i in range(4, len(s))), 3)) for d, t, lang in rows)
    out = kneser_ney.perplexities(docs, trusted, kneser_ney.fold() > 0).collect()
    assert sorted((str(r.doc_id), str(r.lang), r.n_symbols, round(r.log10_p, 3) + 0.0) for r in out) == want
    for context in ((), (97,), (PAD, PAD, PAD, PAD), (97, 98, 99, 97), (1, 2, 3, 4)):
        assert abs(sum(model.chance(context + (w,)) for w in [PAD, *range(257)]) - 1) < 1e-9 + model.chance(context + (PAD,))


def test_trusted_text_is_kept_and_noise_goes(spark):
    """Documents whose labels the model and the bounds have not seen."""
    labels = {r.doc_id: (r.quality, r.toxic) for r in table(spark, SF_DIR, "labels").collect()}
    hidden = lambda d: zlib.crc32(f"x{d}".encode()) % 3 == 0
    shown = spark.createDataFrame([(d,) for d, x in labels.items() if x == (1, 0) and not hidden(d)], "doc_id long")
    keep = {r.doc_id: r.keep for r in kneser_ney.classify(table(spark, SF_DIR, "documents"), shown).collect()}
    good, bad = ([keep[d] for d, x in labels.items() if hidden(d) and x[0] == q] for q in (1, 0))
    assert len(keep) == table(spark, SF_DIR, "documents").count() and sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "one", "en"), (2, None, None), (2, None, None), (3, "x" * 300_000, "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long")
    out = kneser_ney.classify(docs, none).collect()
    assert len(out) == 4 and all(r.keep and r.lower is None and abs(r.perplexity - 257) < 1e-2 for r in out)
    assert kneser_ney.classify(docs.where("false"), none).count() == 0
    assert len(kneser_ney.classify(docs, spark.createDataFrame([(i,) for i in range(9)], "doc_id long")).collect()) == 4


def test_query_has_every_document(spark):
    assert QUERIES["op2_quality_classifier"](spark, "/root/testdata/sf0.001").count() == 200


def test_plan_is_made_once(spark, monkeypatch):
    """The plan of all orders is not planned and described anew after each of its stages; other plans are."""
    plans, keep = [], kneser_ney.materialise
    monkeypatch.setattr(kneser_ney, "materialise", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    docs = spark.createDataFrame([(i, f"text {i}", "en") for i in range(9)], "doc_id long, text string, lang string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    assert kneser_ney.classify(docs, docs.select("doc_id")).count() == 9
    assert len(plans) == 1 and "AdaptiveSparkPlan" not in plans[0] and spark.conf.get("spark.sql.adaptive.enabled") == before == "true"
