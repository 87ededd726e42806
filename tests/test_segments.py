"""An index that follows its documents: equal to one built anew, with few segments."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from martlet.operators import search
from martlet.operators.files import folders
from martlet.operators.segments import LiveIndex

SCHEMA = "id long, lang string, body string"
WORDS = "alpha beta gamma delta eps zeta eta theta".split()


def frame(spark, docs):
    return spark.createDataFrame([(i, *d) for i, d in docs.items()], SCHEMA)


@pytest.fixture
def index(spark, tmp_path):
    return LiveIndex(spark, str(tmp_path / "live"), frame(spark, {1: ("x", "y")}).schema, "id", ["lang"], fan=3)


def same_as_anew(spark, index, docs, question="alpha gamma zeta"):
    whole = frame(spark, docs)
    terms = index.terms(question)
    want = search.bm25(search.postings(whole, "id", "body", ["lang"]), search.statistics(whole, "body"), terms, "id")
    assert rows(index.keyword_scores(question)) == rows(want)
    assert rows(index.postings) == rows(search.postings(whole, "id", "body", ["lang"]))
    assert rows(index.statistics) == [(len(docs), whole.select(F.sum(F.size(search.tokens(F.col("body"))))).first()[0] or 0)]


def test_replaced_and_deleted_documents_are_forgotten(spark, index):
    assert index.refresh(1, frame(spark, {1: ("en", "alpha beta"), 2: ("en", "alpha"), 3: (None, "")}), "body")
    assert index.refresh(2, frame(spark, {1: ("fr", "gamma gamma")}), "body", frame(spark, {2: ("", "")}))
    docs = {1: ("fr", "gamma gamma"), 3: (None, "")}
    same_as_anew(spark, index, docs)
    assert not index.refresh(2, frame(spark, {9: ("en", "alpha")}), "body")  # a replay
    assert index.refresh(5, frame(spark, {2: ("de", "alpha again")}), "body", frame(spark, {77: ("", "")}))
    same_as_anew(spark, index, {**docs, 2: ("de", "alpha again")})
    assert rows(index.keyword_scores("alpha", {"lang": "en"})) == []


def test_any_changes_with_merges(spark, index):
    r = random.Random(4)
    docs, most = {}, 0
    for batch in range(1, 13):
        text = lambda: (r.choice(["en", "fr"]), " ".join(r.choices(WORDS, k=r.randrange(1, 6))))
        new = {r.randrange(30): text() for _ in range(r.randrange(1, 6))}
        gone = [k for k in r.sample(range(30), 3) if k not in new]
        index.refresh(batch, frame(spark, new), "body", spark.createDataFrame([(k,) for k in gone] or [(-1,)], "id long"))
        docs = {k: v for k, v in {**docs, **new}.items() if k not in gone}
        index.merge()
        if batch % 4 == 0:
            same_as_anew(spark, index, docs)
            index.vacuum()
            same_as_anew(spark, index, docs)
        most = max(most, len(index.segments()))
    assert most <= 2 * (math.log(30, 3) + 1)  # fan - 1 of each size
    assert len(folders(spark, f"{index.path}/segments")) == len(index.segments())


def test_an_interrupted_batch_is_not_seen_and_can_be_repeated(spark, index, monkeypatch):
    index.refresh(1, frame(spark, {1: ("en", "alpha"), 2: ("en", "beta")}), "body")
    real = index._write

    def breaks(*args):
        real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(index, "_write", breaks)
    with pytest.raises(RuntimeError):
        index.refresh(2, frame(spark, {1: ("en", "gamma"), 3: ("en", "zeta")}), "body")
    same_as_anew(spark, index, {1: ("en", "alpha"), 2: ("en", "beta")})
    monkeypatch.setattr(index, "_write", real)
    index.refresh(2, frame(spark, {1: ("en", "gamma")}), "body")
    same_as_anew(spark, index, {1: ("en", "gamma"), 2: ("en", "beta")})


def test_empty_index(spark, index):
    assert index.keyword_scores("alpha").count() == 0 and index.merge() == [] and index.segments() == []
    index.refresh(1, None, "body", spark.createDataFrame([(1,)], "id long"))
    assert index.last_batch() == 1 and index.keyword_scores("alpha").count() == 0
