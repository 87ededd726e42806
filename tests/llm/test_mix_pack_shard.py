import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from martlet.llm import packing, poisson_mix, ring_shards
from martlet.llm.queries import QUERIES
from martlet.llm.tokens import VOCABULARY, token_ids

SCHEMA = "doc_id long, text string, source string, copy int"


def rows_of(n=300):
    return [(i, f"word{i} été " * (i % 37) + "x" * (i % 5), ["a", "a", "a", "b", None][i % 5], 7) for i in range(n)] + [
        (None, None, "c", 1), (500, "", "c", 1), (3, "same", "b", 1), (3, "same", "b", 1),
        (501, "long " * 30_000, "b", 1), (502, "<|endoftext|> z", "a", 1)]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# Poisson replication

def test_poisson_steps_invert_the_distribution():
    for mean in (0.01, 0.7, 3.0, 40.0, 2_000.0):
        steps = poisson_mix.poisson_steps(mean)
        u = (np.arange(20_000) + 0.5) / 20_000
        counts = np.searchsorted(steps, u, "left")
        assert abs(counts.mean() - mean) < 0.02 * max(mean, 0.05)
        assert abs(counts.var() - mean) < 0.05 * max(mean, 0.05)
        assert steps[-1] > 1 - 1e-9
    assert poisson_mix.poisson_steps(0.0).tolist() == [1.0]


def test_mix_reaches_weights_and_keeps_columns(spark):
    docs = spark.createDataFrame([(i, "t" * 100, "big" if i % 10 else "small", 0) for i in range(4000)], SCHEMA)
    out = poisson_mix.mix(docs, {"big": 0.5, "small": 0.5}, epochs=2.0, seed=3)
    assert out.columns == ["doc_id", "text", "source", "copy", "copies", "rate"]
    got = out.collect()
    assert got == poisson_mix.mix(docs, {"big": 0.5, "small": 0.5}, epochs=2.0, seed=3).collect()
    by = Counter(r.source for r in got)
    assert abs(by["big"] - 4000) < 300 and abs(by["small"] - 4000) < 300
    copies = defaultdict(list)
    for r in got:
        copies[r.doc_id].append((r.copy, r.copies))
    assert all(sorted(c) == [(k + 1, c[0][1]) for k in range(c[0][1])] for c in copies.values())
    only = poisson_mix.mix(docs, {"small": 1.0}, seed=3)
    assert {r.source for r in only.select("source").distinct().collect()} == {"small"}
    assert poisson_mix.mix(empty(spark)).count() == 0
    assert poisson_mix.mix(spark.createDataFrame(rows_of(), SCHEMA)).count() > 100


def test_mix_with_any_column_names(spark):
    names = ["doc_id", "text", "source", "a.b", "_source", "_u", "_rate", "_steps", "_order", "u", "of", "c0"]
    docs = spark.createDataFrame([(i, f"t{i}", "s", *range(9)) for i in range(50)], ", ".join(
        f"`{n}` {'string' if n in ('text', 'source') else 'long'}" for n in names))
    out = poisson_mix.mix(docs, seed=2)
    assert out.columns == [*names, "copy", "copies", "rate"]
    assert out.count() > 20 and all(tuple(r)[3:12] == tuple(range(9)) for r in out.collect())


def test_mix_equals_its_sql(spark, tmp_path):
    docs = spark.createDataFrame(rows_of(), SCHEMA).select("doc_id", "text", "source")
    docs.write.parquet(f"{tmp_path}/d")
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    names = ["doc_id", "source", "copy", "copies"]
    got = poisson_mix.mix(docs).select(*names).collect()
    want = sql.execute(f"SELECT {', '.join(names)} FROM ({poisson_mix.ORACLE})").fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


# Packing

def check_packing(rows, out, length):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    want = Counter()
    for doc_id, text, *_ in rows:
        want[(doc_id, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (1,))] += 1
    windows, ids = defaultdict(list), defaultdict(list)
    for r in out:
        piece = np.frombuffer(r.ids, "<u4")
        assert len(piece) == r.length > 0
        windows[r.sequence_id].append((r.offset, r.length, r.queue))
        ids[r.doc_id].append((r.start, tuple(piece.tolist()), r.doc_tokens))
    for number, parts in windows.items():
        at = 0
        for offset, size, _ in sorted(parts):
            assert offset == at
            at += size
        assert at == length or number == max(windows)
    assert sorted(windows) == list(range(len(windows)))
    for doc_id, parts in ids.items():
        texts = [list(k[1]) for k, n in want.items() for _ in range(n) if k[0] == doc_id]
        assert sum(len(p) for _, p, _ in parts) == sum(map(len, texts))
        if len(texts) == 1:
            assert [t for _, p, _ in sorted(parts) for t in p] == texts[0]
            assert {n for _, _, n in parts} == {len(texts[0])}
    assert {k[0] for k in want} == set(ids)
    return windows


def test_packing_keeps_every_id_once_and_its_shares(spark):
    rows = rows_of()
    out = packing.pack(spark.createDataFrame(rows, SCHEMA), length=256, quantum=16).collect()
    windows = check_packing(rows, out, 256)
    total = Counter()
    for parts in windows.values():
        for _, size, queue in parts:
            total[queue] += size
    everything = sum(total.values())
    for number in range(len(windows) - 2):  # every window has the target shares but for a quantum
        own = Counter()
        for _, size, queue in windows[number]:
            own[queue] += size
        assert all(abs(own[q] - 256 * n / everything) <= 2 * 16 + 1 for q, n in total.items())
    digest = packing.digest(spark.createDataFrame(out)).collect()
    assert sorted(r.ids_crc32 for r in digest) == sorted(zlib.crc32(r.ids) for r in out)


def test_places_equal_a_round_robin_done_step_by_step():
    """Queues earn credit with every token packed; the one whose next quantum is due first is served."""
    draw = np.random.default_rng(7)
    for _ in range(40):
        n, quantum = int(draw.integers(1, 5)), int(draw.integers(1, 9))
        lengths, weights = draw.integers(1, 120, n), draw.integers(1, 30, n)
        order, served = [], [0] * n
        while sum(len(range(0, int(x), quantum)) for x in lengths) > sum(served):
            open_ = [q for q in range(n) if served[q] * quantum < lengths[q]]
            due = lambda q: Fraction(served[q] + 1, int(weights[q]))
            q = min(open_, key=lambda q: (due(q), q))
            order += [(q, t) for t in range(served[q] * quantum, min((served[q] + 1) * quantum, int(lengths[q])))]
            served[q] += 1
        at = {token: place for place, token in enumerate(order)}
        for q in range(n):
            begin = 0
            while begin < lengths[q]:  # documents of the queue
                size = int(min(draw.integers(1, 40), lengths[q] - begin))
                cut = packing.pieces(q, begin, size, lengths, weights, quantum, 16)
                tokens = [(begin + a + i, place + i) for a, b, place in cut.tolist() for i in range(b)]
                assert tokens == [(t, at[q, t]) for t in range(begin, begin + size)]
                assert all(place // 16 == (place + b - 1) // 16 for _, b, place in cut.tolist())
                begin += size


def test_packing_to_given_weights(spark):
    rows = [(i, "alpha beta " * 40, "x" if i % 4 else "y", 0) for i in range(80)]
    out = packing.pack(spark.createDataFrame(rows, SCHEMA), {"x": 0.5, "y": 0.5}, length=128, quantum=8).collect()
    windows = check_packing(rows, out, 128)
    early = [w for w in range(len(windows) // 3)]
    share = [sum(s for _, s, q in windows[w] if q == "y") for w in early]
    assert all(abs(s - 64) <= 16 for s in share)
    assert packing.pack(empty(spark)).count() == 0


def test_ids_are_those_of_the_vocabulary_file():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    for text in ("", "Hello  world\n\n x", "été ñandú 12345 don't", "\u0000​🙂 日本語", "<|endoftext|> a", " " * 50):
        assert token_ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_the_ids_of_the_library(spark, tmp_path):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    draw = np.random.default_rng(5)
    parts = ["<|endoftext|>", "<|endoftext|", ">", " ", "  \n", "a", " b", "été", "🙂", "12"]
    texts = ["a<|endoftext|>b", *("".join(draw.choice(parts, 8)) for _ in range(300))]
    want = {t: tokenizer.encode(t, add_special_tokens=False).ids for t in texts}
    assert want[texts[0]] == [64, 50256, 65]
    assert all(token_ids(t, added=True).tolist() == ids for t, ids in want.items())
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for out in (QUERIES["op6_packing"](spark, str(tmp_path)), corpus_pipeline.packed(spark, docs, "")):
        got = {r.doc_id: r.doc_tokens for r in out.select("doc_id", "doc_tokens").collect()}
        assert got == {i: len(want[t]) + 1 for i, t in enumerate(texts)}


# Ring with bounded loads

def test_ring_balances_and_numbers(spark):
    rows = rows_of()
    got = ring_shards.assign(spark.createDataFrame(rows, SCHEMA), shards=7).collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=repr)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert ring_shards.assign(empty(spark)).count() == 0
    alike = spark.createDataFrame([(1, "t", "s", 1)] * 100, SCHEMA)
    assert Counter(r.shard for r in ring_shards.assign(alike, shards=5).collect()) == {s: 20 for s in range(5)}


def test_loads_equal_a_ring_that_places_keys_one_by_one(spark):
    docs = [(i, "t", "s", 1) for i in range(500)] + [(7, "t", "s", 1)] * 150  # one key has nearly a quarter
    got = ring_shards.assign(spark.createDataFrame(docs, SCHEMA).repartition(3), shards=9, nodes=5, slack=0.2, seed=4)
    shards = defaultdict(Counter)
    for r in got.collect():
        shards[r.shard][r.doc_id] += 1
    points = ring_shards.ring(9, 5, 4)
    key = {r.doc_id: r.k for r in spark.range(500).select(
        F.col("id").alias("doc_id"), F.xxhash64(F.lit(4), F.col("id").cast("string")).alias("k")).collect()}
    room = ring_shards.capacities(len(docs), 9, 0.2)[0]
    arc = lambda doc: bisect_left([p for p, _ in points], key[doc]) % len(points)
    # One by one in the order of arcs: first those that find room on their own shard, then the others.
    load, waiting = Counter(), []
    for doc in sorted((d[0] for d in docs), key=lambda d: (arc(d), key[d])):
        own = points[arc(doc)][1]
        if load[own] < room:
            load[own] += 1
        else:
            waiting.append(arc(doc))
    for at in waiting:
        while load[points[at % len(points)][1]] >= room:
            at += 1
        load[points[at % len(points)][1]] += 1
    assert waiting and {s: n for s, n in load.items() if n} == {s: sum(c.values()) for s, c in shards.items()}
    # Whatever the order: all shards that a key passed on its way are full.
    for shard, ids in shards.items():
        for doc in ids:
            at = arc(doc)
            while points[at % len(points)][1] != shard:
                assert load[points[at % len(points)][1]] == room
                at += 1


def test_overflow_goes_clockwise_and_few_rows_move(spark):
    points = [(0, 0), (10, 1), (20, 2), (30, 0)]
    plan = ring_shards.walk(points, {0: 5, 1: 1, 2: 0, 3: 2}, [3, 3, 3])
    assert sum(end - first for _, first, end, _, _ in plan) == 8
    assert [(a, f, e, s) for a, f, e, s, _ in plan] == [
        (0, 0, 3, 0), (1, 0, 1, 1), (0, 3, 5, 1), (3, 0, 2, 2)]
    docs = spark.createDataFrame([(i, "t", "s", 1) for i in range(3000)], SCHEMA)
    old, new = ({r.doc_id: r.shard for r in ring_shards.assign(docs, shards=n, slack=0.25).collect()} for n in (10, 11))
    assert sum(old[i] != new[i] for i in old) < 3000 * 0.35
    assert max(Counter(new.values()).values()) <= 3000 / 11 * 1.25 + 1


def test_ids_do_not_return_to_python(spark):
    rows = [(1, "one two three four", "x"), (2, None, "y"), (3, "five " * 50, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = packing.pack(docs, length=16, quantum=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    ids = {}
    for r in sorted(out.collect(), key=lambda r: r.start):
        assert len(r.ids) == 4 * r.length and 0 <= r.offset and r.offset + r.length <= 16
        ids[r.doc_id] = ids.get(r.doc_id, b"") + bytes(r.ids)
    assert all(len(x) == 4 * {r.doc_id: r.doc_tokens for r in out.collect()}[i] for i, x in ids.items()) and len(ids) == 3
