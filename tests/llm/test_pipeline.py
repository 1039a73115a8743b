"""Each stage of the pipeline on all that the stage before kept, against plain versions."""

import sentencepiece
from test_mixing import plain
from test_repeats import brute
from test_shingles import slow_roots

import corpus_pipeline
from sitewright.llm import kneser_ney, pieces
from sitewright.llm.common import stored, table
from sitewright.llm.queries import WEIGHTS, with_domain

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF_DIR)))
        assert name == corpus_pipeline.STAGES[-1][0] or kept[-1].schema == kept[-2].schema
    texts = [{r.doc_id: r.text for r in k.collect()} for k in kept[:-1]]

    keep = {r.doc_id for r in kneser_ney.classify(docs, kneser_ney.trusted_labels(table(spark, SF_DIR, "labels"))).collect() if r.keep}
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    assert texts[1] == {d: t for d, t in texts[0].items() if d in keep}
    bad = [d for d, q in labels.items() if q == 0]
    assert all(d in keep for d, q in labels.items() if q == 1) and 2 * sum(d in keep for d in bad) < len(bad)

    roots = slow_roots(texts[1])
    assert texts[2] == {d: t for d, t in texts[1].items() if roots[d] == d}

    cut = brute([t.encode() for t in texts[2].values()], 200)
    assert texts[3] == {d: c[3].decode("utf-8", "ignore") for d, c in zip(texts[2], cut)}
    assert all(r.n_chars == len(r.text) for r in kept[3].collect())

    rows = [(r.doc_id, r.domain, r.lang, r.source, len(r.text.encode().split())) for r in with_domain(kept[3]).collect()]
    want = sorted(d for d, _, _ in plain(rows, WEIGHTS, sum(r[-1] for r in rows), 2))
    assert sorted(r.doc_id for r in kept[4].collect()) == want and all(texts[4][d] == texts[3][d] for d in texts[4])

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    out = kept[5].collect()
    assert sorted(r.doc_id for r in out) == want and all(r.round_trip and r.ids == library.encode(texts[4][r.doc_id]) for r in out)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_odd_rows(spark):
    """Rows without an id, repeated and empty ones, and columns whose names the stages use themselves."""
    docs = table(spark, SF_DIR, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "no id at all", "en", "src1", 12), (900, "same row here", "en", "src1", 13), (900, "same row here", "en", "src1", 13), (901, "", None, "src2", 0)], docs.schema)
    names = ("key", "times", "held", "time", "domain", "row", "component", "count", "first", "kept", "block")
    extra = docs.limit(20).union(odd).selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    frame, seen = extra, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stored(stage(spark, frame, SF_DIR))
        assert frame.columns == extra.columns and set(frame.dtypes) == set(extra.dtypes)
        seen.append(rows_of(frame))
    plain = lambda rows: [r for r in rows if r[0] in (None, 900, 901)]
    assert plain(seen[0]) == plain(rows_of(extra))  # too few trusted texts for bounds: all stay
    kept = [r for r in plain(seen[0]) if r[0] == 900][:1] + [r for r in plain(seen[0]) if r[1] and r[0] is None]
    empty = [r for r in plain(seen[0]) if not r[1]]
    assert sorted(plain(seen[1]), key=str) == sorted(kept + [r for r in empty if r[0] == 901], key=str)
    assert plain(seen[2]) == plain(seen[1])
    assert all(r in seen[2] for r in seen[3])
    out = corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR).collect()
    assert len(out) == len(seen[3]) and all(r.round_trip for r in out)
    none = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        before, none = none, stored(stage(spark, none, SF_DIR))
    assert none.count() == 0 and before.columns == docs.columns


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).where("not round_trip").count() == 0
