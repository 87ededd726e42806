import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martlet.llm import ball_tree
from martlet.llm.ball_tree import Tree

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    """The contract, document by document."""
    split = [(i, terms(t)) for i, t in docs]
    n_docs, length = sum(1 for _, w in split if w), sum(len(w) for _, w in split)
    df = Counter(t for _, w in split for t in set(w))
    out = []
    for item, text in items:
        found = []
        for doc, words in split:
            tf, score = Counter(words), 0
            for t in set(terms(text)) & tf.keys():
                m = 10 + 90 * len(words) * n_docs // length
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if none else doc, -score))
    return sorted(out, key=repr)


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "ß", "É", "中文", "x1", "İ", "Σ"]
    text = lambda: r.choice([" ", ", ", "\n"]).join(r.choices(words, [1 / (1 + i) for i in range(len(words))], k=r.randrange(1, 40)))
    docs = [(i, text()) for i in range(n)]
    passage = "w40 w41 w42 w43 w44 w45"
    docs += [(n + i, f"{passage} {text() if i % 3 else ''}") for i in range(30)]  # near and exact copies
    docs += [(5000, None), (5001, ""), (5002, " .,\x00 "), (5003, "w1 " * 20_000), (5004, "y" * 5000), (None, passage), (3, docs[3][1])]
    items = [(i, text()) for i in range(12)] + [(50, passage), (51, None), (52, "..."), (53, "never seen"), (50, passage), (None, "w2 W2 w2")]
    return docs, items


def found(spark, docs, items, **how):
    frames = (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
              spark.createDataFrame(items, "item_id long, text string"))
    return sorted((tuple(r) for r in ball_tree.top_documents(*frames, **how).collect()), key=repr)


def test_equals_plain_scores(spark):
    docs, items = corpus(1, 250)
    want = plain(docs, items)
    assert found(spark, docs, items, documents=40) == want
    assert found(spark, docs, items, documents=7, terms=25) == want  # many trees, several blocks of items


def test_ties_and_few_documents(spark):
    docs = [(i, "same text here") for i in range(60, 0, -1)] + [(100, "other")]
    items = [(1, "text"), (2, "other here")]
    assert found(spark, docs, items, documents=16) == plain(docs, items)
    assert found(spark, docs[:1], items) == plain(docs[:1], items)


def test_empty_tables_and_other_columns(spark):
    docs, items = corpus(2, 5)
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, docs, [(1, None)]) == []
    frame = spark.createDataFrame([(1, "a b", 2, "x", 9)], "doc_id long, text string, `row` int, `a.b` string, n int")
    query = spark.createDataFrame([(7, "b", 1, 2)], "item_id long, text string, item int, `c.d` int")
    assert [tuple(r)[:3] for r in ball_tree.top_documents(frame, query).collect()] == [(7, 1, 1)]


def test_terms_do_not_depend_on_pieces(monkeypatch):
    text = " a1,b  Cd\n" * 30 + "x" * 50 + " é" * 20 + "z"
    whole = [t.encode() for t in terms(text)]
    for size in (1, 3, 7, 64):
        monkeypatch.setattr(ball_tree, "_PIECE", size)
        assert [t for part in ball_tree.terms_of(text.encode()) for t in part] == whole


def random_tree(seed, n, width, leaf=4, group=3):
    r = np.random.default_rng(seed)
    vectors = []
    for _ in range(n):
        t = np.sort(r.choice(width, r.integers(1, width // 2 + 1), replace=False))
        vectors.append((t, r.integers(1, 10**6, len(t))))
    vectors += vectors[: n // 3]  # copies
    weights = r.integers(0, 20_000, width)
    tree = Tree.build(
        np.arange(len(vectors)), r.permutation(len(vectors)), np.array([len(t) for t, _ in vectors]),
        np.concatenate([t for t, _ in vectors]), np.concatenate([x for _, x in vectors]), weights, leaf, group)
    return tree, weights


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(2, 30), st.integers(1, 9))
def test_bounds_hold_and_searches_are_exact(seed, n, width, group):
    tree, weights = random_tree(seed, n, width, 4, group)
    tree = Tree.load(tree.dump())
    r = np.random.default_rng(seed)
    terms_ = np.sort(r.choice(width, r.integers(1, width + 1), replace=False))
    query = np.zeros(width, np.int64)
    query[terms_] = weights[terms_]
    scores = np.array([
        int((query[tree.local[tree.term[a:b]]] * tree.impact[a:b]).sum()) for a, b in zip(tree.ptr, tree.ptr[1:])])
    known = np.flatnonzero(np.isin(tree.local, terms_))
    if len(known):
        bounds = tree.bounds(known, weights[tree.local[known]])
        for node, (low, high) in enumerate(zip(tree.lo, tree.hi)):
            assert scores[low:high].max() <= bounds[node]
    rows, ids, values, _ = tree.search(terms_, weights[terms_], 5, 1)
    best = [i for i in np.lexsort((tree.ids, -scores)) if scores[i] > 0][:5]
    assert sorted(zip(-values, ids, rows)) == [(-scores[i], tree.ids[i], tree.rows[i]) for i in best]


def test_subtrees_are_left_out():
    r = np.random.default_rng(3)
    lists = [np.sort(np.concatenate((np.arange(20) + 20 * (i % 16), r.choice(320, 3)))) for i in range(800)]
    lists = [np.unique(x) for x in lists]
    weights = r.integers(500, 9000, 320)
    tree = Tree.build(
        np.arange(800), np.arange(800), np.array([len(x) for x in lists]), np.concatenate(lists),
        np.concatenate([r.integers(4 * 10**5, 6 * 10**5, len(x)) for x in lists]), weights)
    leaves = int((tree.child[:, 0] < 0).sum())
    scored = [tree.search(np.arange(20) + 20 * c, weights[np.arange(20) + 20 * c], 10, 1)[3] for c in range(16)]
    assert leaves >= 25 and sum(scored) <= 16 * leaves // 3
