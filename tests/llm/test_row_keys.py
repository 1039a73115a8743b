"""Rows without an id in the pipeline: decisions are joined on a key of the row."""

import random

from test_mixing import plain
from test_shingles import SCHEMA, SF_DIR, near, slow_set

import corpus_pipeline
from sitewright.llm import shingles
from sitewright.llm.common import stored, table
from sitewright.llm.queries import WEIGHTS, with_domain


def test_rows_without_id(spark):
    """Near copies and repeated rows without an id go, other rows without one stay; the mixture draws them too."""
    rng = random.Random(7)
    one, two = (" ".join(f"{k}{rng.randrange(900)}" for _ in range(120)) for k in "ab")
    rows = [(4, one), (None, near(one, rng, 1)), (None, two), (None, two), (None, near(two, rng, 1)), (None, "short one here"), (9, "short one here"), (None, None), (None, "")]
    docs = spark.createDataFrame([(d, t, "en", "src1", len(t or "")) for d, t in rows], SCHEMA)
    left = stored(corpus_pipeline.near_dedup(spark, docs, SF_DIR))
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert len(got) == 4 and (4, one) in got and (9, "short one here") in got
    rest = [t for d, t in got if d is None]
    assert sum(t in (None, "") for t in rest) == 1 and sum(t == two or shingles.similar(len(slow_set(t) & slow_set(two)), len(slow_set(t)), len(slow_set(two))) for t in rest if t) == 1
    drawn = corpus_pipeline.mixture(spark, left, SF_DIR)
    assert sorted(((r.doc_id, r.text) for r in drawn.collect()), key=str) == got


def test_mixture_draws_every_row_of_an_epoch(spark):
    rows = [(None, "p q r"), (None, "p q r"), (None, "s t"), (5, "u v w")]
    docs = spark.createDataFrame([(d, t, "en", "src1", len(t)) for d, t in rows], SCHEMA)
    assert sorted(((r.doc_id, r.text) for r in corpus_pipeline.mixture(spark, docs, SF_DIR).collect()), key=str) == sorted(rows, key=str)


def test_rejected_rows_without_id_go(spark):
    """A document's fate does not hang on its having an id."""
    docs = table(spark, SF_DIR, "documents")
    bad = sorted({r.doc_id for r in docs.collect()} - {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF_DIR).collect()})
    labels = {r.doc_id for r in table(spark, SF_DIR, "labels").where("quality = 1 and toxic = 0").collect()}
    lost = [d for d in bad if d not in labels][:3]
    assert lost
    bare = docs.selectExpr(f"if(doc_id in ({','.join(map(str, lost))}), null, doc_id) AS doc_id", "text", "lang", "source", "n_chars")
    assert corpus_pipeline.quality(spark, bare, SF_DIR).where("doc_id is null").count() == 0


def test_mixture_of_the_given_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.domain, r.lang, r.source, len(r.text.encode().split())) for r in with_domain(docs).collect()]
    want = sorted(d for d, _, _ in plain(rows, WEIGHTS, sum(r[-1] for r in rows), 2))
    assert sorted(r.doc_id for r in corpus_pipeline.mixture(spark, docs, SF_DIR).collect()) == want
