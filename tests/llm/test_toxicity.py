"""Spelling models against a plain version, and accuracy on labels the models have not seen."""

import math
import random
import zlib
from collections import Counter

from pyspark.sql.classic.dataframe import DataFrame

from sitewright.llm import toxicity
from sitewright.llm.common import table
from sitewright.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def nodes(word):
    spelt = word + b"\x00" if len(word) < 16 else word[:16]
    return [(spelt[:i], spelt[i : i + 1]) for i in range(len(spelt))]


class Plain:
    """The same chances from counters, one word at a time."""

    def __init__(self, texts, shared=10.0):
        self.shared = shared
        self.c = [Counter(e for t, x in texts if x == k for w in toxicity.words_of(t) for e in nodes(w)) for k in (0, 1)]
        self.c.append(self.c[0] + self.c[1])
        self.low = Counter(((b" " + h if len(h) < 3 else h[-3:]), a) for h, a in self.c[2])
        self.d = [self.discount(c) for c in (*self.c, self.low)]

    @staticmethod
    def discount(c):
        n = Counter(c.values())
        return n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5

    def chance(self, k, h, a):
        """Class 0 or 1, both (2), or the last bytes (3)."""
        c = (*self.c, self.low)[k]
        seen = {y: n for (g, y), n in c.items() if g == h}
        s = self.shared if k < 2 else 0.0
        below = 1 / 257 if k == 3 else self.chance(2, h, a) if k < 2 else self.chance(3, b" " + h if len(h) < 3 else h[-3:], a)
        if not seen:
            return below
        return (max(seen.get(a, 0) - self.d[k], 0) + (self.d[k] * len(seen) + s) * below) / (sum(seen.values()) + s)

    def ratio(self, word):
        known = [(h, a) for h, a in nodes(word)]
        total = 0.0
        for h, a in known:
            total += math.log(self.chance(1, h, a) / self.chance(0, h, a))
            if (h, a) not in self.c[2]:
                break
        return total


def test_against_plain_model(spark):
    rng = random.Random(11)
    make = lambda x: " ".join(rng.choice(["ab", "abc", "bad", "base", "Élan", "x" * 30, "b"] + ["vile", "vilest"] * x) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(0, 25)))
    texts = [(make(x), x) for x in (0, 1) for _ in range(40)]
    docs = spark.createDataFrame([(t, x) for t, x in texts], "text string, toxic int")
    model = toxicity.spelling_model(toxicity.word_counts(docs)).toArrow()
    plain, spelling = Plain(texts), toxicity.Spelling(model)
    for word in (b"ab", b"vilest", b"vilesty", b"vi", b"zzz", b"base", "élan".encode(), b"x" * 30, b"x" * 12, b"", b"vile"):
        assert abs(spelling.ratio(word) - plain.ratio(word)) < 1e-9, word
    asked = ["", "vile vile base", "ab zzz", "x" * 200_000]
    got = toxicity.scores_of(spark.createDataFrame(list(enumerate(asked)), SCHEMA), model).collect()
    for r in got:
        words = toxicity.words_of(asked[r.doc_id])
        want = sum(math.log1p(0.02 * math.expm1(plain.ratio(w))) for w in words) / math.sqrt(max(1, len(words)))
        assert r.n_words == len(words) and abs(r.evidence - want) < 1e-9


def test_ranges_of_words_give_one_model(spark):
    """Cuts in the midst of what words share, words of a range without learnt ones, and a cut that is a whole word."""
    rng = random.Random(12)
    made = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(120)] + ["a" * 15, "a" * 16, "a" * 17, "a" * 30]
    texts = [(" ".join(rng.choice(made) for _ in range(60)), i % 2) for i in range(30)]
    words = toxicity.word_counts(spark.createDataFrame(texts, "text string, toxic int"))
    plain, one = Plain(texts), toxicity.Spelling(toxicity.spelling_model(words, []).toArrow())
    asked = [*made, "abcabcabc", "zz", "ab1", "", "c" * 20, "b"]
    for cuts in ([b"b\x00"], [b"aa\x00", b"aaaa", b"ab", b"abca\x00", b"b", b"cccc\x00", b"d", b"zzz"], toxicity.cuts_of(words, 9)):
        whole = toxicity.spelling_model(words, cuts)
        spelling = toxicity.Spelling(whole.toArrow())
        assert spelling.at.keys() == one.at.keys()
        for word in asked:
            assert abs(spelling.ratio(word.encode()) - plain.ratio(word.encode())) < 1e-9, (cuts, word)
        got = toxicity.scores_of(spark.createDataFrame(list(enumerate(asked)), SCHEMA), whole, cuts).collect()
        want = [math.log1p(0.02 * math.expm1(plain.ratio(w.encode()))) if w else 0.0 for w in asked]
        assert len(got) == len(asked) and all(abs(r.evidence - want[r.doc_id]) < 1e-9 for r in got)


def test_model_stays_in_the_tasks(spark, monkeypatch):
    """What reaches the driver does not grow with the vocabulary."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(200))) for i in range(200)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    sizes, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: 1 / 0)
    monkeypatch.setattr(DataFrame, "collect", lambda self: sizes.append(collect(self)) or sizes[-1])
    assert toxicity.score(docs, labels).count() == 200
    assert sizes and max(map(len, sizes)) < 200 < 40_000


def test_words_count_whole(spark):
    """Words that differ after their sixteenth byte only, in ranges cut there too, against the chances of whole words."""
    rng = random.Random(13)
    made = ["unmistakably" + "".join(rng.choice("ab") for _ in range(rng.randint(0, 14))) for _ in range(60)] + ["é" * 9, "é" * 10 + "a", "a" * 40, "a" * 17, "b" * 300]
    texts = [(" ".join(rng.choice(made) for _ in range(40)) + f" grandmotherly{'vile' if i % 2 else 'kind'}word", i % 2) for i in range(30)]
    words = toxicity.word_counts(spark.createDataFrame(texts, "text string, toxic int"))
    assert {r.word for r in words.collect()} == {w for t, _ in texts for w in toxicity.words_of(t)}

    class Whole(Plain):
        def __init__(self, texts):
            whole = lambda w: [((w + b"\x00")[:i], (w + b"\x00")[i : i + 1]) for i in range(len(w) + 1)]
            self.shared, self.whole = 10.0, whole
            self.c = [Counter(e for t, x in texts if x == k for w in toxicity.words_of(t) for e in whole(w)) for k in (0, 1)]
            self.c.append(self.c[0] + self.c[1])
            self.low = Counter(((b" " + h if len(h) < 3 else h[-3:]), a) for h, a in self.c[2])
            self.d = [self.discount(c) for c in (*self.c, self.low)]

        def ratio(self, word):
            total = 0.0
            for h, a in self.whole(word):
                total += math.log(self.chance(1, h, a) / self.chance(0, h, a))
                if (h, a) not in self.c[2]:
                    break
            return total

    plain = Whole(texts)
    asked = [*made, "grandmotherlyvileword", "grandmotherlykindword", "grandmotherlyvil", "unmistakablyababc", "é" * 11, "a" * 41, "a" * 16, "a" * 25, "unmistakablyb" + "a" * 30, "b" * 5000]
    ratios = [plain.ratio(w.encode()) for w in asked]
    for cuts in ([], [b"a" * 20, b"grandmotherlyvilex", b"unmistakablyabab", b"unmistakablyababab", b"unmistakablybbbabaaaaaa", "é".encode() * 9 + b"\x00"], toxicity.cuts_of(words, 9)):
        model = toxicity.spelling_model(words, cuts, width=None)
        spelling = toxicity.Spelling(model.toArrow(), None)
        assert all(abs(spelling.ratio(w.encode()) - x) < 1e-9 for w, x in zip(asked, ratios))
        got = toxicity.scores_of(spark.createDataFrame(list(enumerate(asked)), SCHEMA), model, cuts, width=None).collect()
        assert len(got) == len(asked) and all(abs(r.evidence - math.log1p(0.02 * math.expm1(ratios[r.doc_id]))) < 1e-9 for r in got)


def test_score_tells_words_by_their_ends(spark):
    docs = spark.createDataFrame([(i, "grandmotherly" + ("vileword" if i % 2 else "kindword") + " and then") for i in range(200)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    longer = docs.selectExpr("doc_id", "replace(text, 'grandmotherly', 'greatgrandmotherly') AS text")
    for texts in (docs, longer):
        assert all(r.predicted == r.doc_id % 2 for r in toxicity.score(texts, labels).collect())


def test_sample_is_bounded(spark):
    rows = [(i, "w" * (i % 50)) for i in range(4000)] + [(5000, "z" * 90_000)] + [(5001, "again")] * 900
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame([(i, i % 2) for i in [*range(4000), 5000, 5001]], "doc_id long, toxic int")
    drawn = {r.doc_id: r.toxic for r in toxicity.sample_ids(docs, marks, 100_000).collect()}
    assert 5000 not in drawn and 5001 not in drawn and all(x == d % 2 for d, x in drawn.items())
    for x in (0, 1):
        size = sum(64 + d % 50 for d in drawn if d % 2 == x)
        assert 90_000 <= size <= 100_000


def test_every_learnable_text_counts(spark, monkeypatch):
    """More bytes than a sample held, and a text of a hash bucket too large for one."""
    docs = spark.createDataFrame([(i, "kind " * 12_000 + f"only{i}") for i in range(200)] + [(1001, "vast " * 200_000)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(200), 1001]], "doc_id long, toxic int")
    seen, counts = [], toxicity.word_counts
    monkeypatch.setattr(toxicity, "word_counts", lambda texts: seen.append(counts(texts)) or seen[0])
    toxicity.score(docs, labels).count()
    learnt = [i for i in [*range(200), 1001] if zlib.crc32(str(i).encode()) % 5 > 1]
    words = {r.word.decode(): r.t + r.o for r in seen[0].collect()}
    assert 1001 in learnt and words == {f"only{i}": 1 for i in learnt if i < 1001} | {"kind": 12_000 * (len(learnt) - 1), "vast": 200_000}


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, sf_dir, "labels").collect()}
    got = QUERIES["op11_toxicity"](spark, sf_dir).collect()
    assert len(got) == 10_000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    seen = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    hit, false, missed = (sum(x == want for x in seen) for want in ((1, 1), (0, 1), (1, 0)))
    assert 2 * hit / (2 * hit + false + missed) > 0.88 and false / len(seen) < 0.015


def test_rows_do_not_sway_their_own_score(spark):
    """Labels of held-out rows, and other columns, change nothing."""
    docs, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    turned = labels.withColumn("toxic", (1 - labels.toxic)).where("crc32(cast(doc_id AS string)) % 5 = 0").unionByName(labels.where("crc32(cast(doc_id AS string)) % 5 <> 0"))
    bare = docs.select("doc_id", "text").selectExpr("*", "'x' AS lang", "1 AS toxic", "2 AS score", "3 AS evidence", "4 AS size")
    a, b = ({r.doc_id: (round(r.score, 9), r.predicted) for r in toxicity.score(d, l).collect()} for d, l in ((docs, labels), (bare, turned)))
    assert a == b


def test_odd_rows(spark):
    rows = [(1, "nice words"), (2, None), (2, ""), (None, "foul"), (None, "foul"), (3, "foul foul"), (3, "foul foul"), (4, "!?"), (5, "q" * 200_000)] + [(i, "foul thing" if i % 2 else "kind thing") for i in range(10, 90)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(10, 90)] + [(10, None), (11, 0), (None, 1), (2, 0)], "doc_id long, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(rows) and sum(r.held_out for r in got if r.doc_id is None) == 2
    assert all(r.predicted == 1 for r in got if r.doc_id in (None, 3)) and all(r.predicted == 0 for r in got if r.doc_id in (1, 2, 4))
    for none in (labels.where("false"), labels.where("toxic = 0")):
        assert {(r.score, r.predicted) for r in toxicity.score(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.score(docs.where("false"), labels).count() == 0
