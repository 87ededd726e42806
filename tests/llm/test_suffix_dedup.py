import hashlib
import random

from martlet.llm.suffix_dedup import digest, remove_repeats

SCHEMA = "doc_id long, text string, source string"


def brute(rows, window):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    seen = {}
    for _, data in texts:
        for p in range(len(data) - window + 1):
            seen[data[p:p + window]] = seen.get(data[p:p + window], 0) + 1
    out = []
    for doc_id, data in texts:
        gone = bytearray(len(data))
        for p in range(len(data) - window + 1):
            if seen[data[p:p + window]] > 1:
                gone[p:p + window] = b"\1" * window
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def make(seed, n=60):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdéñ", k=r.randint(2, 7))) for _ in range(300)]
    text = lambda k: " ".join(r.choices(words, k=k))
    passages = [text(r.randint(20, 90)) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = r.random()
        if kind < 0.3 and rows:
            t = r.choice(rows)[1] or ""
            if kind < 0.2 and t:
                at = r.randrange(len(t))
                t = t[:at] + r.choice(["X", "", "YY"]) + t[at + r.randint(0, 2):]
        elif kind < 0.6:
            t = text(r.randint(0, 60)) + r.choice(passages) + text(r.randint(0, 60))
        else:
            t = text(r.randint(0, 250))
        rows.append((i, t, "s"))
    return rows + [(900, None, None), (901, "", "s"), (902, "a" * 700, "s"), (None, "xy" * 500, "s"),
                   (903, rows[0][1], "s"), (903, rows[0][1], "s")]


def test_equals_brute_force(spark):
    for seed, window in ((1, 200), (2, 200), (3, 40)):
        rows = make(seed)
        got = digest(remove_repeats(spark.createDataFrame(rows, SCHEMA), window)).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows, window)


def test_empty_and_long(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    r = random.Random(5)
    long = "".join(r.choices("abcdefgh ", k=1_300_000))
    rows = [(1, long, None), (2, "zz" + long[1_000_000:1_100_000] + "qq", None)]
    got = {x.doc_id: x for x in remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [tuple(s) for s in got[1].spans] == [(1_000_000, 1_100_000)]
    assert [tuple(s) for s in got[2].spans] == [(2, 100_002)]
