import random
import re

import numpy as np
import pyarrow as pa

from martlet.llm.components import components
from martlet.llm import ngram_join
from martlet.llm.ngram_join import Order, similar_classes, tree_overlaps
from martlet.llm.shingles import shingle_set, word_hashes

SCHEMA = "doc_id long, text string, size int"


def sets_of(text, words):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x20\x09-\x0d]+", lower)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1)))


def brute(rows, words, num, den):
    sets = [sets_of(t, words) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((r[0], len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets)))


def make(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choices("abcÉdeF", k=r.randint(1, 6))) for _ in range(400)]
    line = " ".join(r.choices(words, k=14))
    rows = []
    for i in range(n):
        kind = r.random()
        if kind < 0.5 and rows:
            t = (r.choice(rows[:1 + len(rows) // 8])[1]).split(" ")
            for _ in range(r.randint(0, 3)):
                t[r.randrange(len(t))] = r.choice(words)
            t = " ".join(t) + " " * r.randint(0, 2)
            t = t.upper() if kind < 0.05 else t
        else:
            t = " ".join(r.choices(words, k=r.randint(1, 120))) + (" " + line if kind < 0.8 else "")
        rows.append((i * 3 % 1000, t, None))
    return rows + [(2001, None, 1), (2002, "", 1), (2003, " \t\n", 1), (2004, "one", 1), (2005, "ONE", 1),
                   (2004, "one", 1), (2006, " one two", 1)]


def test_equals_brute_force(spark):
    for seed, words, num in ((1, 4, 85), (3, 2, 60)):
        rows = make(seed, 220)
        got = similar_classes(spark.createDataFrame(rows, SCHEMA), words, num, 100).collect()
        assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == brute(rows, words, num, 100)
        leaders = {}
        for x in got:
            if x.n_shingles:
                leaders[x.component_id] = leaders.get(x.component_id, 0) + x.leader
        assert set(leaders.values()) == {1}


def test_empty_and_null_ids(spark):
    assert similar_classes(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c d e f", 1), (5, "a b c d e f", 1), (None, "x y", 1)]
    got = sorted(((x.doc_id, x.component_id, x.leader) for x in
                  similar_classes(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == [(5, 5, True), (None, 5, False), (None, None, True)]


def test_tree_walk_equals_plain_overlap():
    r = np.random.default_rng(3)
    for _ in range(60):
        probe = np.unique(r.integers(0, 60, 30)).astype(np.uint64)
        sets = {tuple(np.unique(r.integers(0, 60, r.integers(1, 40)))) for _ in range(20)}
        sets = [np.array(s, np.uint64) for s in sets]
        needed = [int(r.integers(1, 25)) for _ in sets]
        got = tree_overlaps(sets, probe, lambda g: int(np.searchsorted(probe, g, "right")), needed)
        assert got == [len(set(s.tolist()) & set(probe.tolist())) >= n for s, n in zip(sets, needed)]


def test_words_and_shingles():
    assert len(word_hashes("a  b\tA\x0bc ".encode())) == 4
    assert len(set(word_hashes(b"abc acb bac aabc abca ab c").tolist())) == 7
    assert word_hashes(b"Abc")[0] == word_hashes(b"x aBC")[1]
    assert len(shingle_set(b"a b c a b c", 3)) == 3 and len(shingle_set(b"a b", 5)) == 1
    assert len(shingle_set(b"w " * 10, 4)) == 1 and len(shingle_set(b"", 4)) == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(tuple(x) for x in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_first_grams_from_stored_heads():
    """From the smallest n-grams of a set, those that come first in the order, or the word that they do not do."""
    r = np.random.default_rng(9)
    shorts = 0
    for density in (0.0, 0.1, 0.5, 0.9, 1.0):
        order = Order(np.packbits(r.random(1 << 12) < density).astype(np.uint8))
        sets = [np.unique(r.integers(0, 2**63, r.integers(1, 300)).astype(np.uint64)) for _ in range(60)]
        sizes = [len(x) for x in sets]
        heads = [x[:ngram_join._stored_of(len(x), 85, 100)].tobytes() for x in sets]
        batch = pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(heads, pa.binary())], ["size", "head"])
        grams, of, place, short = ngram_join._places(batch, 85, 100, order)
        shorts += len(short)
        for i, whole in enumerate(sets):
            want = order.sort(whole)[:ngram_join._first(len(whole), 85, 100)].view(np.int64).tolist()
            own = sorted(zip(place[of == i].tolist(), grams[of == i].tolist()))
            assert own == ([] if i in short else list(enumerate(want)))
    assert shorts > 20


def test_sets_that_stored_heads_do_not_reach(spark):
    """Many near copies of long texts: their n-grams are frequent, so whole sets are read again."""
    r = random.Random(11)
    words = [f"v{i}" for i in range(300)]
    texts = [" ".join(words[:i] + [f"x{i}"] + words[i + 1:]) for i in r.sample(range(300), 14)]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(50 + i, " ".join(r.choices(words, k=200)), 0) for i in range(5)]
    got = similar_classes(spark.createDataFrame(rows, SCHEMA), 4, 85, 100).collect()
    assert sorted((g.doc_id, g.n_shingles, g.component_id) for g in got) == brute(rows, 4, 85, 100)
