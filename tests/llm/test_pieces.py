"""Pieces against the model's own library, and round trips."""

import random

import pytest
import sentencepiece

from sitewright.llm import pieces

ODD = [None, "", " ", "  a", "a  ", "▁x", "a▁▁ b", "\n\n", "x\0y", "😀 ok", "ｆｕｌｌ ﬁ", "\r\n\t tab", " " * 60, "a" * 200, "Und " * 50]


@pytest.fixture(scope="module")
def model():
    return pieces.load()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def ids_of(model, texts):
    ids, count = pieces.encode_batch(model, texts)
    ends = count.cumsum()
    return [ids[e - c : e].tolist() for e, c in zip(ends, count)]


def test_as_the_library(model, library, monkeypatch):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(" abtheréß漢\n.") for _ in range(rng.randint(1, 150))) for _ in range(400)]
    want = [library.encode(t or "") for t in texts]
    for indexed, in_step in ((pieces.INDEXED, pieces.IN_STEP), (40, 6)):
        monkeypatch.setattr(pieces, "INDEXED", indexed)
        monkeypatch.setattr(pieces, "IN_STEP", in_step)
        assert ids_of(model, texts) == want
    assert [pieces.decode_ids(model, x) for x in want] == [library.decode(x) for x in want]
    assert pieces.decode_ids(model, [258, 3 + 65]) == "�A"


def test_documents_and_odd_rows(spark, model, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(ODD, 9_000_000)] + [(None, "null id"), (9_000_001, "")], docs.schema)
    out = pieces.round_trip(docs.union(odd).selectExpr("*", "1 AS ids", "2 AS decoded"), model).collect()
    assert len(out) == docs.count() + len(ODD) + 2 and all(r.round_trip for r in out) and all(r.n_ids == len(r.ids) for r in out)
    texts = {r.doc_id: r.text for r in docs.union(odd).collect()}
    assert all(r.ids == library.encode(texts[r.doc_id] or "") for r in out)
    assert pieces.round_trip(docs.where("false"), model).count() == 0
    encoded = pieces.encode(odd, model)
    assert {r.doc_id: r.text for r in pieces.decode(encoded, model).collect()} == {r.doc_id: (r.text or "").replace("▁", " ") for r in odd.collect()}
    assert pieces.decode(encoded.selectExpr("doc_id", "cast(null as array<int>) AS ids"), model).where("text is not null").count() == 0


def test_a_task_forgets_and_goes_on(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    encoder = pieces.Encoder(model)
    for text in ("one two three four", "one two five", "six", None, "one six"):
        assert encoder([text])[0].tolist() == library.encode(text or "")


def test_very_long_text(model, library):
    text = "word wörd\n" * 30_000 + "z" * 5_000
    assert ids_of(model, [text]) == [library.encode(text)]
