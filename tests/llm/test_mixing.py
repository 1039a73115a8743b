"""Mixing against a plain dealing of tokens; the registered query has SQL of its own."""

import hashlib
import random

from sitewright.llm import mixing

LEVELS = ("domain", "lang", "source")


def fill(budget, nodes):
    """{name: tokens} by dealing until nobody is full; nodes: name -> (weight, cap)."""
    open_, out, left = dict(nodes), {}, budget
    while open_:
        total = sum(w for w, _ in open_.values())
        full = {k: c for k, (w, c) in open_.items() if c * total <= w * left}
        if not full:
            break
        out |= full
        left -= sum(full.values())
        open_ = {k: v for k, v in open_.items() if k not in full}
    total = sum(w for w, _ in open_.values())
    base = {k: w * left // total for k, (w, _) in open_.items()}
    for k in sorted(open_, key=lambda k: (-(open_[k][0] * left % total), k))[: left - sum(base.values())]:
        base[k] += 1
    return out | base


def plain(rows, weights, budget, epochs, seed=7):
    """(doc_id, epoch, take) for rows (doc_id, domain, lang, source, tokens)."""
    sizes = {}
    for _, *path, n in rows:
        sizes[tuple(path)] = sizes.get(tuple(path), 0) + n

    def cap(path):
        if path and not weights.get(path, 1):
            return 0
        below = {p[: len(path) + 1] for p in sizes if p[: len(path)] == path}
        return sizes[path] * epochs if len(path) == 3 else sum(map(cap, below))

    given = {(): min(budget, cap(()))}
    for depth in range(3):
        for path in [p for p in given if len(p) == depth]:
            below = {p[: depth + 1] for p in sizes if p[:depth] == path}
            given |= fill(given[path], {p: (weights.get(p, 1), cap(p)) for p in below if weights.get(p, 1)})
    out = []
    for path, size in sizes.items():
        left, epoch = given.get(path, 0), 0
        while size and left > 0:
            order = sorted((r for r in rows if tuple(r[1:4]) == path), key=lambda r: (hashlib.md5(f"{seed}:{epoch}:{r[0]}".encode()).hexdigest(), r[0]))
            whole = left >= size
            for r in order:
                if whole or left > 0:
                    out.append((r[0], epoch, min(r[4], left) if not whole else r[4]))
                    left -= r[4]
            epoch += 1
    return sorted(out)


def test_repeated_rows_and_rows_without_id(spark):
    rows = [(None, f"w{i} " * (i % 5)) for i in range(50)] + [(None, "a b c")] * 2500 + [(7, "d e")] * 1500 + [(None, None)] * 9
    docs = spark.createDataFrame([(i, "d", "en", "s", x) for i, x in rows], "doc_id long, domain string, lang string, source string, text string")
    total = sum(len((x or "").split()) for _, x in rows)
    for budget in (1, total // 3, total // 2, total - 1, total + 5):
        name = lambda r: str(r[0]) if r[0] is not None else "text:" + hashlib.md5((r[1] or "").encode()).hexdigest()
        left, want = budget % total if budget != total else 0, []
        whole = budget // total
        want = [(r[0], 0, len((r[1] or "").split())) for r in rows] * whole
        for r in sorted(rows, key=lambda r: hashlib.md5(f"7:{whole}:{name(r)}".encode()).hexdigest()):
            n = len((r[1] or "").split())
            if left > 0:
                want.append((r[0], whole, min(n, left)))
                left -= n
        out = [(r.doc_id, r.epoch, r.take_tokens) for r in mixing.mix(docs, LEVELS, {}, budget, 2).collect()]
        assert sorted(out, key=str) == sorted(want, key=str)


def got(frame):
    return sorted((r.doc_id, r.epoch, r.take_tokens) for r in frame.collect())


def test_against_plain_dealing(spark):
    rng = random.Random(2)
    rows = [(i, f"d{rng.randint(0, 2)}", rng.choice(["en", "de"]), f"s{min(rng.randint(0, 3), rng.randint(0, 3))}", rng.randint(0, 9)) for i in range(240)]
    docs = spark.createDataFrame([(i, *p, " ".join(["w"] * n)) for i, *p, n in rows], "doc_id long, domain string, lang string, source string, text string")
    weights = {("d0",): 5, ("d1",): 2, ("d0", "en"): 3, ("d2", "de"): 0, ("d1", "en", "s0"): 4}
    total = sum(r[-1] for r in rows)
    for budget, epochs in ((total // 3, 1), (total, 2), (10 * total, 3), (7, 1), (0, 1)):
        assert got(mixing.mix(docs, LEVELS, weights, budget, epochs)) == plain(rows, weights, budget, epochs)


def test_odd_rows(spark):
    rows = [(1, None, None, None, "a b"), (1, None, None, None, "a b"), (None, None, None, None, "c"), (2, None, None, None, None), (3, "x", "en", "s", ""), (4, "y", "en", "s", "w " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, text string").selectExpr("*", "1 AS n_tokens", "2 AS given", "3 AS epoch", "4 AS cap")
    out = mixing.mix(docs, LEVELS, {}, 30, 2).collect()
    assert sum(r.take_tokens for r in out) == 30 and sum(r.take_tokens for r in out if r.domain == "") == 10
    assert sorted((str(r.doc_id), r.epoch) for r in out if r.domain == "") == sorted([("1", e) for e in (0, 0, 1, 1)] + [("None", 0), ("None", 1), ("2", 0), ("2", 1)])
    assert {r.domain for r in out} == {"", "y"}
    assert mixing.mix(docs.where("false"), LEVELS, {}, 5, 1).count() == mixing.mix(docs.where("doc_id = 3"), LEVELS, {}).count() == 0
