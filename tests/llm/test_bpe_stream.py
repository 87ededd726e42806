import hashlib
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martlet.llm import bpe_stream, queries
from martlet.llm.bpe_stream import Decoder, Merges, Transducer, encoded, text_of, token_ids, vocabulary


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe_stream.VOCABULARY)


def merge_list(r, letters="abc", n=12):
    """A random proper merge list: each merge joins two symbols that are already there, in a new one."""
    symbols, pairs = list(letters), []
    while len(pairs) < n:
        a, b = r.choice(symbols), r.choice(symbols)
        if a + b not in symbols and len(a + b) <= 7:
            symbols.append(a + b)
            pairs.append((a, b))
    return Merges({s: i for i, s in enumerate(symbols)}, pairs), symbols


def naive(merges, symbols):
    """All places of one merge from left to right, then the next merge."""
    out = list(symbols)
    for pair, (_, new) in sorted(merges.rule.items(), key=lambda x: x[1]):
        i = 0
        while i < len(out) - 1:
            if out[i] * merges.size + out[i + 1] == pair:
                out[i:i + 2] = [new]
            i += 1
    return out


def test_merges_equal_naive_ones():
    r = random.Random(1)
    for _ in range(150):
        merges, _ = merge_list(r)
        text = [r.randrange(3) for _ in range(r.randrange(1, 90))]
        assert merges.apply(text) == merges._apply_long(text) == naive(merges, text)


def test_lookahead_is_sufficient_for_every_continuation():
    """Tokens that end ``lookahead`` before the end of a prefix are those of every longer text."""
    r = random.Random(2)
    reached = 0
    for _ in range(60):
        merges, _ = merge_list(r, "ab", 7)
        for word in itertools.product(range(2), repeat=9):
            whole = merges.apply(list(word))
            ends = list(itertools.accumulate(merges.width[t] for t in whole))
            for cut in range(1, 9):
                part = merges.apply(list(word[:cut]))
                own = list(itertools.accumulate(merges.width[t] for t in part))
                same = 0
                while same < min(len(own), len(ends)) and part[same] == whole[same]:
                    same += 1
                agreed = own[same - 1] if same else 0
                reached = max(reached, cut - agreed)
                # The first token that differs ends behind cut - lookahead, or begins there.
                assert agreed >= cut - merges.lookahead or own[same] > cut - merges.lookahead
                stable = [t for t, e in zip(part, own) if e <= cut - merges.lookahead]
                assert whole[:len(stable)] == stable
    assert reached >= 3


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 5), st.lists(st.integers(0, 2), min_size=1, max_size=300))
def test_transducer_with_small_windows(seed, window, text):
    merges, _ = merge_list(random.Random(seed))
    transducer, out, at = Transducer(merges, window), [], 0
    r = random.Random(seed)
    while at < len(text) - 1:
        step = r.randrange(1, 9)
        out += transducer.feed(text[at:min(at + step, len(text) - 1)])
        at = min(at + step, len(text) - 1)
        assert len(transducer.held) <= merges.lookahead + 8 * window + 16
    assert out + transducer.finish(text[-1:]) == merges.apply(text)


def test_improper_merge_lists_are_refused():
    with pytest.raises(ValueError):
        Merges({"a": 0, "b": 1, "ab": 2, "aba": 3}, [("ab", "a"), ("a", "b")])


ODD = [
    "", " ", "\n\t ", "Hello World, it's  me", "<|endoftext|>", "a<|startoftext|>b<|endoftext|> c<|endoftext", "<|<|endoftext|>|>",
    "É́á é ΑΣ ΟΔΟΣ. İstanbul ǅ", "12½ Ⅷ 中文字符 한국어 각", "x" * 5000, "'" * 700 + "re", "!'s 're''ll 'S 'T i'M",
    "\x1c\x1d a\x1eb\x1f", "​  x　y z", "à̖́" * 200, "😀😀👍🏽" * 300, "͸ᲉꟋ", "́́x",
    "aᄀ" + "ᅡ" * 30 + "ᆨ", "ab\0c", "ﬁ ﬂ ﷺ ㎒",
]


@pytest.mark.parametrize("text", ODD)
def test_ids_and_text_equal_the_library(library, text):
    own = vocabulary()
    want = library.encode(text, add_special_tokens=False).ids
    assert token_ids(text, own).tolist() == want
    for size in (1, 2, 7, 1000):
        pieces = [text[i:i + size] for i in range(0, len(text), size)]
        assert [i for x in encoded(pieces, own, 16) for i in x] == want
    assert text_of(np.array(want, "<i4"), own) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aeT'sre !?<|>1é́Σ \n")), max_size=60),
       st.integers(1, 9))
def test_random_texts_equal_the_library(text, size):
    own, library = vocabulary(), Tokenizer.from_file(bpe_stream.VOCABULARY)
    want = library.encode(text, add_special_tokens=False).ids
    assert token_ids(text, own).tolist() == want
    assert [i for x in encoded([text[i:i + size] for i in range(0, len(text), size)], own, 4) for i in x] == want


def test_long_word_with_a_small_state(library):
    """A word of 300,000 letters: the state stays small, the ids are the library's."""
    r = random.Random(5)
    text = "".join(r.choices("etaoinshrdlu", k=300_000))
    own = vocabulary()
    encoder, ids = bpe_stream.Encoder(own, 512), []
    for i in range(0, len(text), 1000):
        ids += encoder.feed(text[i:i + 1000])
        assert len(encoder.word.held) < own.merges.lookahead + 2000 and len(encoder.text) + len(encoder.raw) < 20
    assert ids + encoder.finish() == library.encode(text, add_special_tokens=False).ids


def test_plain_decoder_waits_for_cut_characters():
    own = vocabulary()
    ids = token_ids("naïve 😀 中文 end", own).tolist()
    whole = text_of(np.array(ids, "<i4"), own, plain=True)
    assert whole == "naïve 😀 中文 end "
    decoder = Decoder(own, plain=True)
    parts = [decoder.feed([i]) for i in ids]
    assert "".join([*parts, decoder.finish()]) == whole and "" in parts and all("�" not in p for p in parts)
    cut = Decoder(own, plain=True)
    assert (cut.feed([own.inner[0xF0]]), cut.finish()) == ("", "�")


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op13_bpe_stream(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r.doc_id: digests(library, r.text) for r in docs}


def test_odd_tables(spark, library):
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)] + [(99, None, "y", 1), (99, None, "y", 1), (None, ODD[3], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `ids` string, `a.b` int")
    got = bpe_stream.decode(bpe_stream.encode(docs))
    assert got.columns == ["doc_id", "text", "a.b", "ids", "decoded"]
    found = sorted(((r.doc_id, r.text, list(r.ids), r.decoded) for r in got.collect()), key=repr)
    want = []
    for i, text, _, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, text, ids, library.decode(ids, skip_special_tokens=False)))
    assert found == sorted(want, key=repr)
    assert bpe_stream.encode(docs.limit(0)).count() == 0
