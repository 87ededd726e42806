import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from martlet.llm import cross_entropy, language_mix, surrogates

SCHEMA = "doc_id long, text string, lang string, source string, score int, entities string"
TEXTS = {
    "en": "the house by the river was quiet and the people there would often walk along it together",
    "de": "das haus am fluss war ruhig und die menschen gingen dort oft gemeinsam spazieren weil es schön ist",
    "fr": "la maison près de la rivière était calme et les gens y marchaient souvent ensemble après le dîner",
}


def table(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in rows], SCHEMA)


# Language mixtures

def language_rows():
    r = np.random.default_rng(1)
    rows = []
    for i in range(240):
        lang = ["en", "de", "fr"][i % 3]
        words = TEXTS[lang].split()
        rows.append((i, " ".join(r.choice(words, r.integers(5, 40))).capitalize() + ".", lang))
    return rows + [(300, None, "en"), (301, "", None), (302, "12 34 !!", "de"), (303, "Straße", None), (None, "the", "en")]


def test_languages_of_held_out_documents(spark):
    got = {r.doc_id: r for r in language_mix.identify(table(spark, language_rows())).collect()}
    assert len(got) == 245
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [r for i, r in got.items() if i is not None and i < 240 and r.held_out]
    assert len(held) > 50 and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert {got[i].lang_pred for i in (300, 301, 302)} == {"und"} and got[302].score == 0 and got[302].shares == []
    assert all(0 <= r.score <= 1 and abs(sum(s.share for s in r.shares) - 1) < 1e-6 for r in got.values() if r.shares)
    assert "entities" in got[0].__fields__ and got[0].lang == "en"


def test_mixed_document_has_both_shares(spark):
    words = {k: v.split() for k, v in TEXTS.items()}
    mixed = " ".join(words["de"] * 3 + words["fr"] * 1)
    rows = [r for r in language_rows() if r[0] is not None and r[0] < 240] + [(900, mixed, None)]
    got = [r for r in language_mix.identify(table(spark, rows)).collect() if r.doc_id == 900][0]
    shares = {s.lang: s.share for s in got.shares}
    assert set(shares) == {"de", "fr"} and abs(shares["de"] - 0.75) < 0.1 and got.lang_pred == "de"


def test_prediction_ignores_other_columns_and_empty_tables(spark):
    rows = language_rows()
    swapped = [(i, t, {"en": "fr"}.get(x, x) if i is not None and zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, t, x in rows]
    a, b = ({r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language_mix.identify(table(spark, x)).collect()}
            for x in (rows, swapped))
    assert a == b
    assert language_mix.identify(table(spark, [])).count() == 0
    assert language_mix.identify(table(spark, [(1, "abc", None)])).first().lang_pred == "und"


def test_expectation_maximisation_never_lowers_the_likelihood():
    scores = np.log(np.random.default_rng(2).uniform(0.01, 1, (50, 3)))
    shares, value = language_mix.shares_of(scores, [0, 1, 2])
    grid = [(a, b, 1 - a - b) for a in np.linspace(0, 1, 21) for b in np.linspace(0, 1 - a, 21)]
    assert value >= max(float(np.log(np.exp(scores) @ np.array(g) + 1e-300).sum()) for g in grid) - 0.5


def plain_languages(rows):
    """Models, mixtures and selection with dictionaries and loops; (lang_pred, share) of each text."""
    def words(text):
        return re.findall("[a-z\\x80-\\U0010ffff]+", (text or "").lower())

    def steps(text):
        data = b"   " + b"".join(w.encode() + b" " for w in words(text))
        return [(data[i - 3:i + 1], data[i - 3:i], i) for i in range(3, len(data))]

    four, three = {}, {}
    for doc_id, text, lang, *_ in rows:
        if lang is not None and not (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1):
            for g, c, _ in steps(text):
                four.setdefault(lang, Counter())[g] += 1
                three.setdefault(lang, Counter())[c] += 1
    names, out = sorted(four), {}
    for doc_id, text, *_ in rows:
        likely, own = [], [0.0] * len(names)
        for g, c, i in steps(text):
            own = [s + math.log(four[n][g] + 0.5 / 64) - math.log(three[n][c] + 0.5) for s, n in zip(own, names)]
            if g.endswith(b" "):
                likely.append(own)
                own = [0.0] * len(names)
        if not words(text):
            out[doc_id] = ("und", 0.0)
            continue

        def fit(members):
            shares = [1 / len(members)] * len(members)
            for _ in range(500):
                new = [0.0] * len(members)
                for w in likely:
                    top = max(w[m] for m in members)
                    joint = [math.exp(w[m] - top) * s for m, s in zip(members, shares)]
                    new = [n + j / sum(joint) / len(likely) for n, j in zip(new, joint)]
                shares, old = new, shares
                if max(abs(a - b) for a, b in zip(shares, old)) < 1e-4:
                    break
            value = 0.0
            for w in likely:
                top = max(w[m] for m in members)
                value += top + math.log(sum(math.exp(w[m] - top) * s for m, s in zip(members, shares)))
            return shares, value

        single = [sum(w[m] for w in likely) for m in range(len(names))]
        first = single.index(max(single))
        shares, _ = fit(range(len(names)))
        order = [first] + [m for m in sorted(range(len(names)), key=lambda m: -shares[m]) if m != first]
        chosen, best = [(first, 1.0)], max(single)
        for size in range(2, len(names) + 1):
            shares, value = fit(order[:size])
            if value - best <= 0.5 * math.log(max(len(likely), 2)) + 1:
                break
            chosen, best = list(zip(order[:size], shares)), value
        member, share = min(chosen, key=lambda c: (-c[1], c[0]))
        out[doc_id] = (names[member], share)
    return out


def test_languages_equal_plain_models(spark):
    words = {k: v.split() for k, v in TEXTS.items()}
    rows = language_rows()[:60] + [
        (900, " ".join(words["de"] * 3 + words["fr"]) + ".", None), (901, " ".join(words["de"] + words["fr"] + words["en"]) + ".", None),
        (902, None, "en"), (903, "12 !", None), (904, "über Ärger!", "de")]
    want = plain_languages(rows)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_mix.identify(table(spark, rows)).collect()}
    assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-3 for i in want)


def test_documents_in_several_known_languages_are_accepted(spark):
    words = {k: v.split() for k, v in TEXTS.items()}
    mixed = " ".join(words["de"] * 2 + words["fr"] * 2 + words["en"] * 2)
    rows = [r for r in language_rows() if r[0] is not None and r[0] < 240] + [(900, mixed, None), (901, None, None), (902, "1 2", None),
        (903, "xqzjk vwqxz qqkjx zxvwq jjqzx wvkqz xxjqk", None), (904, "这是一个完全不同的语言的句子", None)]
    found = language_mix.identify(table(spark, rows))
    assert found.where("doc_id = 900").first().score < 0.5
    assert {r.doc_id for r in language_mix.accepted(found).collect()} == {*range(240), 900}


def test_cells_grow_with_the_corpus():
    assert [language_mix.bits_for(1 << n) for n in (0, 20, 29, 30, 33, 60)] == [17, 17, 17, 18, 21, 22]
    four, three, word = language_mix.grams("ab cd.", 20)
    assert len(four) == 6 and max(four.max(), three.max()) < 1 << 20 and word.tolist() == [0, 0, 0, 1, 1, 1]


def test_languages_with_any_column_names(spark):
    docs = spark.createDataFrame([(1, "the house", "en", 5, 6)], "doc_id long, text string, lang string, `a.b` int, held_out int")
    got = language_mix.identify(docs)
    assert got.columns == ["doc_id", "text", "lang", "a.b", "lang_pred", "score", "shares", "fit", "held_out"]
    assert got.first()["a.b"] == 5


# Surrogates

def test_surrogates_keep_type_and_format():
    key = b"k"
    text = ("Mail Ann.b7@mail.example.com, +1 (743) 555-3824, 4111111111111111, 70.23.22.57, 123-45-6789, "
            "DE89 3704 0044 0532 0130 00, token = \"24be64439e3e49cf\", Frau Anna Schmidt, Анна Каренина.")
    found = surrogates.entities(text)
    assert [k for *_, k, _ in found] == [
        "email", "phone", "card", "ip", "ssn", "iban", "secret", "first.f.latin", "last.latin", "first.f.cyrillic",
        "last.cyrillic"]
    new = {}
    for start, end, kind, normal in found:
        new[kind] = surrogates.dressed(kind, text[start:end], surrogates.surrogate(key, kind, normal, 0))
        assert new[kind] != text[start:end]
    assert re.fullmatch(r"[a-z]{3}\.[a-z]\d@[a-z]{4}\.[a-z]{7}\.com", new["email"])
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new["phone"])
    assert new["card"][0] == "4" and len(new["card"]) == 16 and surrogates.luhn(new["card"]) == 0
    assert re.fullmatch(r"[0-9a-f]{16}", new["secret"]) and re.fullmatch(r"\d{3}-\d\d-\d{4}", new["ssn"])
    iban = new["iban"].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and iban[:2] == "DE"
    assert new["first.f.latin"].endswith("ina") and surrogates.script_of(new["last.cyrillic"]) == "cyrillic"


def test_distinct_and_coreferent(spark):
    numbers = [f"{a}.{b}.1.{c}" for a in range(1, 5) for b in range(4) for c in range(20)]
    rows = [(i, f"from {n} to {numbers[0]}!!") for i, n in enumerate(numbers)] + [
        (400, None), (401, ""), (402, "nothing here 12"), (403, "Mr. Smith wrote, and John Smith too"), (None, "a@b.org")]
    docs = table(spark, rows)
    got = {r.doc_id: r for r in surrogates.pseudonymise(docs, b"one").collect()}
    assert len(got) == len(rows) and got[400].text is None and got[401].text == "" and got[402].text == rows[322][1]
    firsts = [got[i].entities[0].surrogate for i in range(len(numbers))]
    assert len(set(firsts)) == len(numbers) and not set(firsts) & set(numbers)
    assert {got[i].entities[1].surrogate for i in range(len(numbers))} == {firsts[0]}
    assert all(got[i].text == f"from {firsts[i]} to {firsts[0]}!!" for i in range(len(numbers)))
    assert all(got[i].text[e.start:].startswith(e.surrogate) for i in range(320) for e in got[i].entities)
    smith = [e.surrogate for e in got[403].entities if e.kind == "last.latin"]
    assert len(smith) == 2 and len(set(smith)) == 1
    assert surrogates.pseudonymise(table(spark, []), b"one").count() == 0


def test_collisions_are_drawn_again(spark):
    names = [("card", f"4{i:02d}") for i in range(0, 80, 2)]  # their surrogates are among 100 numbers
    found = spark.createDataFrame(names, "kind string, normal string")
    retried = {r.normal: r.attempt for r in surrogates.attempts(found, b"k").collect()}
    drawn = [surrogates.surrogate(b"k", k, n, retried.get(n, 0)) for k, n in names]
    assert retried and len(set(drawn)) == 40 and not set(drawn) & {n for _, n in names}


# Cross-entropy difference

def test_scores_equal_plain_models(spark):
    rows = [(i, t) for i, t in enumerate(["a b a c", "a b b", "c c A d", "", None, "zz a b", "a b a c"])]
    targets = spark.createDataFrame([(0,), (1,), (1,), (None,)], "doc_id long")
    got = {r.doc_id: r for r in cross_entropy.score(table(spark, rows), targets, words=3).collect()}
    words = Counter(w for _, t in rows for w in (t or "").lower().split())
    known = [w for w, _ in sorted(words.items(), key=lambda x: -x[1])[:3]]
    assert sorted(known) == ["a", "b", "c"]
    ids = lambda t: ["^"] + [w if w in known else f"len{len(w)}" for w in (t or "").lower().split()]
    size = 3 + 15 + 1

    def loss(texts, text):
        pairs = Counter((a, b) for t in texts for a, b in zip(ids(t), ids(t)[1:]))
        single = Counter(b for t in texts for b in ids(t)[1:])
        total = sum(single.values())
        seq, out = ids(text), 0.0
        for a, b in zip(seq, seq[1:]):
            kinds = max(1, sum(1 for x in pairs if x[0] == a))
            n = sum(c for x, c in pairs.items() if x[0] == a)
            out -= math.log((pairs[(a, b)] + kinds * (single[b] + 1) / (total + size)) / (n + kinds))
        return out / (len(seq) - 1) if len(seq) > 1 else 0.0

    for i, t in rows:
        a, b = loss([rows[0][1], rows[1][1]], t), loss([x for _, x in rows], t)
        assert abs(got[i].target_loss - a) < 1e-5 and abs(got[i].background_loss - b) < 1e-5
        assert abs(got[i].score - (a - b)) < 1e-5 and got[i].n_words == len((t or "").split())
    assert cross_entropy.score(table(spark, []), targets).count() == 0


def test_all_words_are_known(spark):
    r = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in r.permutation(2100))) for i in range(3)]
    rows += [(10, "rosy fern"), (11, "rosy  FERN"), (12, "drab clay"), (13, "\u2003 x"), (14, " \n"), (10, "rosy fern")]
    got = cross_entropy.score(table(spark, rows), spark.createDataFrame([(10,)], "doc_id long")).collect()
    assert sorted(x.doc_id for x in got) == sorted(i for i, _ in rows)
    texts = [["^", *(w for w in t.lower().replace("\n", " ").split(" ") if w)] for _, t in rows]
    good = [t for (i, _), t in zip(rows, texts) if i == 10]
    size = len({w for t in texts for w in t[1:]}) + 15 + 1

    def loss(model, text):
        pairs, single = Counter(p for t in model for p in zip(t, t[1:])), Counter(w for t in model for w in t[1:])
        after, kinds = Counter(w for t in model for w in t[:-1]), Counter(a for a, _ in pairs)
        return -sum(
            math.log((pairs[a, b] + max(1, kinds[a]) * (single[b] + 1) / (single.total() + size)) / (after[a] + max(1, kinds[a])))
            for a, b in zip(text, text[1:])) / max(1, len(text) - 1)

    want = {i: (loss(good, t), loss(texts, t), len(t) - 1) for (i, _), t in zip(rows, texts)}
    for x in got:
        assert abs(x.target_loss - want[x.doc_id][0]) < 1e-5 and abs(x.background_loss - want[x.doc_id][1]) < 1e-5
        assert x.n_words == want[x.doc_id][2]
    scores = {x.doc_id: x.score for x in got}
    assert scores[10] == scores[11] < scores[12] - 1  # they differ in rare words of equal lengths only


def test_bigrams_travel_as_arrays_in_many_buckets(spark, monkeypatch):
    r = np.random.default_rng(6)
    rows = [(int(i % 50) or None, " ".join(f"w{int(x)}" for x in r.zipf(1.4, 40))) for i in range(120)] + [(7, None), (7, " "), (7, None)]
    targets = spark.createDataFrame([(i,) for i in range(1, 50, 3)], "doc_id long")
    key = lambda x: (x.doc_id or 0, x.n_words, x.score)
    want = sorted(cross_entropy.score(table(spark, rows), targets).collect(), key=key)
    monkeypatch.setattr(cross_entropy, "_TEXT", 2000)
    monkeypatch.setattr(cross_entropy, "_BUCKET", 3000)
    monkeypatch.setattr(cross_entropy, "_SAMPLE", 1.0)
    assert sorted(cross_entropy.score(table(spark, rows), targets, slices=2).collect(), key=key) == want
    plan = cross_entropy.score(table(spark, rows), targets)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan.replace("BroadcastHashJoin", "")
    chunk = cross_entropy._send(None, np.zeros(1, np.uint64), 5, 0, 1)
    texts = [t.encode() for _, t in rows[:120]]
    sent = chunk([pa.scalar(3)], pa.table({
        "data": texts, "d1": list(range(120)), "d2": [0] * 120, "copies": [1] * 120, "target": [True] * 120}))
    assert sent.num_rows <= 5  # a row for a bucket, not for a bigram


def test_scores_tell_good_documents_apart(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    learn = labels.where("quality = 1 AND doc_id % 2 = 0")
    rows = cross_entropy.score(docs, learn).join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "score").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g < b for g in good for b in bad]) > 0.75
