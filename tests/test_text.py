"""Tokens, extraction, summaries, classification and search."""

import math
import re

import pytest
from pyspark.sql import functions as F

import golden
from conftest import rows
from martlet.operators import layout, search, text


def tokens_of(spark, value):
    return spark.range(1).select(text.tokens(F.lit(value))).first()[0]


def test_tokens(spark):
    assert tokens_of(spark, "Fast delivery, v2.0 – très bien!") == [
        "fast", "delivery", "v2", "0", "très", "bien"]
    assert tokens_of(spark, "快適なシューズ") == ["快適", "適な", "なシ", "シュ", "ュー", "ーズ"]
    assert tokens_of(spark, "USB ハブ x 茶") == ["usb", "ハブ", "x", "茶"]
    assert tokens_of(spark, "") == []


def test_sentences_and_fields(spark):
    got = spark.range(1).select(
        text.sentences(F.lit("One. Two!  とても速い。良い\n\n...")),
        text.extract_fields(F.lit("mail a.b@c.org or x@y.jp, tel 555-1234"),
                            {"mail": r"[a-z.]+@[a-z.]+[a-z]", "tel": r"[0-9]+-[0-9]+", "none": "zzz"}),
    ).first()
    assert got[0] == ["One.", "Two!", "とても速い。", "良い"]
    assert got[1].asDict() == {"mail": ["a.b@c.org", "x@y.jp"], "tel": ["555-1234"], "none": []}


def test_summary_prefers_rare_terms(spark):
    docs = spark.createDataFrame(
        [(1, "common words here. a peculiar zebra appears."), (2, "common words here."),
         (3, "common words here. common words."), (4, "...")], "id long, body string")
    found = dict(rows(text.summarise(docs, "id", "body")))
    assert found[1] == "a peculiar zebra appears." and found[2] == "common words here."
    assert found[4] is None and len(found) == 4


def test_classifier_beats_the_majority(spark):
    words = {0: ["slow", "broken", "late", "poor"], 1: ["quick", "great", "solid", "happy"]}
    data = [(i, " ".join(["the", "parcel", "was", words[int(i % 10 < 4)][i % 4], words[int(i % 10 < 4)][(i // 3) % 4]]),
             int(i % 10 < 4)) for i in range(200)]
    df = spark.createDataFrame(data, "id long, body string, y int")
    model = text.TextClassifier(["negative", "positive"]).fit(df.where("id < 150"), "body", "y")
    held_out = model.classify(df.where("id >= 150"), "body")
    right = held_out.where((F.col("class.label") == "positive") == (F.col("y") == 1)).count() / 50
    assert right > 0.9
    assert held_out.where(~F.col("class.score").between(0.5, 1)).count() == 0


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(golden.REVIEWS, "review_id string, user_id string, review_text string")


@pytest.fixture
def index(spark, reviews, tmp_path):
    made = search.SearchIndex(spark, str(tmp_path / "index"), "review_id", ["user_id"])
    made.add(reviews, "review_text", 0)
    return made


def test_japanese_keyword_search(index):
    best = search.top(index.keyword_scores("快適なシューズ"), "review_id", 3).collect()
    assert best[0].review_id == "r001"
    only = index.keyword_scores("配送の問題", {"user_id": "u003"}).collect()
    assert [r.review_id for r in only] == ["r003"]


def test_index_in_parts_equals_one_build(spark, reviews, index, tmp_path):
    parts = search.SearchIndex(spark, str(tmp_path / "parts"), "review_id", ["user_id"])
    for n, user in enumerate(["u001", "u002", "u003"]):
        parts.add(reviews.where(F.col("user_id") == user), "review_text", n)
    parts.add(reviews.where(F.col("user_id") == "u002"), "review_text", 1)  # again: replaces
    assert rows(parts.postings) == rows(index.postings)
    question = "品質 が 問題"
    assert rows(parts.keyword_scores(question)) == rows(index.keyword_scores(question))


def test_bm25_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "c c c c")], "id long, body string")
    found = dict(rows(search.bm25(
        search.postings(docs, "id", "body"), search.statistics(docs, "body"), ["a", "c"], "id")))

    def part(tf, length, df):
        idf = math.log(1 + (3 - df + 0.5) / (df + 0.5))
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / 3))

    assert found == {1: round(part(2, 3, 1), 6), 2: round(part(1, 2, 2), 6), 3: round(part(4, 4, 2), 6)}


def test_vectors_and_fusion(spark):
    vectors = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, -2.0]), (4, [0.0, 0.0])], "id long, v array<float>")
    by_vector = search.vector_scores(vectors, "id", "v", [2.0, 0.0])
    assert rows(by_vector) == [(1, 1.0), (2, 0.707107), (3, 0.0)]
    by_keyword = spark.createDataFrame([(3, 5.0), (9, 1.0)], "id long, score double")
    fused = dict(rows(search.fuse(by_keyword, by_vector, "id")))
    assert fused == {1: round(1 / 61, 6), 2: round(1 / 62, 6), 3: round(1 / 61 + 1 / 63, 6),
                     9: round(1 / 62, 6)}


def test_hybrid_search_with_filter(spark, reviews, index):
    vectors = spark.createDataFrame(
        [("r001", "u001", [1.0, 0.0]), ("r002", "u002", [0.6, 0.8]), ("r003", "u003", [0.0, 1.0])],
        "review_id string, user_id string, v array<float>")
    found = search.search(index, vectors, "v", reviews, "快適なシューズ", [1.0, 0.0],
                          ["review_id", "user_id", "review_text"], 2)
    assert found.orderBy(F.desc("score")).first().review_id == "r001" and found.count() == 2
    only = search.search(index, vectors, "v", reviews, "配送の問題", [1.0, 0.0],
                         ["review_id", "review_text"], 5, {"@eq": {"user_id": "u002"}})
    assert [r.review_id for r in only.collect()] == ["r002"]
    with pytest.raises(ValueError):
        search.equality_filter({"@gt": {"x": 1}})


def test_bayes_by_hand(spark):
    docs = spark.createDataFrame([(1, "good good day"), (2, "bad day"), (3, "good"), (4, "unseen"), (5, None)], "id long, body string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (9, 1), (3, None)], "id long, label int")
    terms = text.term_counts(docs, "id", "body")
    model = text.BayesClassifier(["no", "yes"]).fit(terms, "id", labels, "label")
    found = {r.id: (r.label, r.score) for r in model.classify(terms, "id", docs).collect()}
    prior = [math.log(2 / 5), math.log(3 / 5)]  # two labelled yes, one no; three terms
    likely = lambda words: [p + sum(math.log(n) for n in ns) for p, ns in zip(prior, zip(*words))]
    good, day = (1 / 5, 3 / 6), (2 / 5, 2 / 6)
    for key, words in ((1, [good, good, day]), (3, [good]), (4, [(1, 1)]), (5, [(1, 1)])):
        logs = likely(words)
        assert found[key] == ("yes" if logs[1] > logs[0] else "no", round(1 / (1 + math.exp(min(logs) - max(logs))), 6))


def test_stored_term_vectors_serve_two_label_sets(spark):
    docs = spark.createDataFrame([(i, "up high" if i % 2 else "down low") for i in range(40)], "id long, body string")
    labels = docs.withColumn("odd", F.col("id") % 2).withColumn("even", 1 - F.col("id") % 2)
    vectors = text.term_vectors(docs, "body")
    for label in ("odd", "even"):
        with_label = vectors.join(labels.select("id", label), "id")
        one = text.TextClassifier(["a", "b"]).fit(with_label, "body", label).classify(vectors, "body")
        two = text.TextClassifier(["a", "b"]).fit(labels, "body", label).classify(docs, "body")
        assert one.columns == ["id", "body", "class"] and rows(one) == rows(two)
        assert all((r["class"].label == "b") == ((r.id % 2 == 1) == (label == "odd")) for r in one.collect())


def test_rules_are_learned_from_examples():
    assert text.learned_rule(["12-3456", "1-23"]) == r"\b[0-9]{1,2}\-[0-9]{2,4}\b"
    assert text.learned_rule(["AB1C"]) == r"\b[0-9A-Z]{4}\b"
    rule = text.learned_rule(["+1 (743) 555-3824", "555-1234", "030 1234567"])
    found = lambda t: re.findall(rule, t)
    assert found("call +4 (100) 200-3000, 555-9999 or 040 7654321; not 1555-1234 nor 55-1234") == [
        "+4 (100) 200-3000", "555-9999", "040 7654321"]
    for example in ("a.b@c.org", "2026-01-02", "1,234.50", "É1"):
        assert re.fullmatch(text.learned_rule([example]), example)
    with pytest.raises(ValueError):
        text.learned_rule([""])


def test_terms_are_counted_inside_their_row(spark):
    """Rows of one key are counted together; a text alone needs no shuffle for its terms."""
    docs = spark.createDataFrame([(1, "b a b"), (2, ""), (3, None), (4, "a a"), (5, "c")], "id long, body string")
    found = text.term_counts(docs, "id", "body")
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == [(1, "a", 1), (1, "b", 2), (4, "a", 2), (5, "c", 1)]
    twice = docs.unionByName(spark.createDataFrame([(4, "a d"), (None, "e"), (None, "e")], docs.schema))
    assert rows(text.term_counts(twice, "id", "body")) == [
        (1, "a", 1), (1, "b", 2), (4, "a", 3), (4, "d", 1), (5, "c", 1), (None, "e", 2)]
    assert rows(search.postings(twice.where("id = 4"), "id", "body")) == [(4, 2, "a", 3), (4, 2, "d", 1)]


def test_quantile_ranks_compare_by_halving(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("v"), "id")
    rank = layout.quantile_rank(df, F.col("v"), F.col("id"), 64, 1000)
    values = sorted(r[0] for r in df.where("v IS NOT NULL").collect())
    cuts = [values[i * len(values) // 64] for i in range(1, 64)]
    assert all(r[1] == (0 if r[0] is None else sum(c <= r[0] for c in cuts)) for r in df.select("v", rank).collect())
    assert "filter(" not in df.select(rank)._jdf.queryExecution().optimizedPlan().toString()  # before, all cuts for each row
