"""SimHash near-duplicates against comparisons of all pairs."""

import random

import xxhash
from pyspark.sql import Row

from sitewright.llm import simhash
from sitewright.llm.components import components
from sitewright.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits=3):
    """{doc_id: smallest reachable}, by flooding."""
    left, out = dict(prints), {}
    while left:
        start = min(left)
        todo, seen = [(start, left.pop(start))], []
        while todo:
            d, p = todo.pop()
            seen.append(d)
            for o in [o for o, q in left.items() if (p ^ q).bit_count() <= bits]:
                todo.append((o, left.pop(o)))
        out |= {d: start for d in seen}
    return out


def got(frame):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in frame.collect()}


def test_query_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    prints = {d: slow_fingerprint(t) for d, t in docs.items()}
    roots = slow_components(prints)
    assert got(QUERIES["op10_simhash_near_dedup"](spark, SF_DIR)) == {d: (f"{prints[d]:016x}", roots[d]) for d in docs}


def test_links_of_random_fingerprints(spark, monkeypatch):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = list({p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for p in base for _ in range(8)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    points = spark.createDataFrame(list(enumerate(signed)), "rep long, fp long")
    want = slow_components(dict(enumerate(prints)))
    for block in (simhash.BLOCK, 3):
        monkeypatch.setattr(simhash, "BLOCK", block)
        roots = {r.node: r.root for r in components(simhash.fingerprint_links(points)).collect()}
        assert {d: roots.get(d, d) for d in want} == want


def test_hot_cell_is_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    points = spark.createDataFrame([(i, (1 << a) | (1 << b)) for i, (a, b) in enumerate((a, b) for a in range(32, 50) for b in range(32, 50))], "rep long, fp long")
    roots = components(simhash.fingerprint_links(points)).collect()
    assert len(roots) == 18 * 18 and {r.root for r in roots} == {0}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One  two"), (5, "one\ttwo"), (None, "one two"), (None, "alone here"), (7, "a b c d"), (7, "a b c d"), (8, "x" * 300_000), (9, "é É"), (10, "É É")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS fp", "2 AS cell", "3 AS rep", "4 AS node")
    out = sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    by_id = {r[1]: r for r in out if not r[0]}
    assert len(out) == 12 and {by_id[i][2] for i in (1, 2, 3)} == {"0" * 16} and {by_id[i][3] for i in (1, 2, 3)} == {1}
    assert by_id[4][3] == by_id[5][3] == 4 and by_id[9][3] == 9 and by_id[10][3] == 10
    assert sorted(str(r[3]) for r in out if r[0]) == ["4", "None"]
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_same_id_joins_its_texts(spark):
    rows = [(1, "p q r s t"), (3, "p q r s t"), (3, "u v w x y"), (5, "u v w x y"), (6, "k l m n o")]
    out = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {(1, 1), (3, 1), (5, 1), (6, 6)}


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([Row(u=i, v=i + 1) for i in range(200)] + [Row(u=900, v=901), Row(u=5, v=5)])
    roots = {r.node: r.root for r in components(chain).collect()}
    assert roots == {i: 0 for i in range(201)} | {900: 900, 901: 900}
