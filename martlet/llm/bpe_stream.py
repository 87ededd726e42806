"""BPE encoding as a streaming transducer with a bounded lookahead, and decoding as a state machine.

Merges run from the lowest rank up, of one rank from left to right. What follows a text can change the tokens
at its end only through a chain of merges across ever earlier borders: each has a later rank than the one before
it, and its right part begins with the left part of that one. ``Merges.lookahead`` is the longest distance such a
chain reaches, found from the merge list alone. A token that ends that many symbols before the end of what
has been read is therefore final, whatever follows; ``Transducer`` emits it and keeps only the rest, so its memory
does not depend on the length of a word. Words that are short enough to be read whole are kept in a table
of bounded size.

Vocabulary files are those of the ``tokenizers`` library with a BPE model over bytes and a mark at word ends. The
library's own normaliser and character classes are asked for what a character is; splitting, merging and
decoding are done here.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from martlet.llm.common import spread, with_columns_mapped

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WINDOW = 4096  # symbols a transducer reads at a time beyond its lookahead
_KEPT = 1 << 17  # words kept with their ids, and as many parts of words
_LONG = 256  # letters from which on a word is read as a stream
_CHUNK = 1 << 16  # letters of a text split at a time
_NONE = (1 << 62, -1)  # no merge
_BATCH = 1 << 22  # bytes of texts whose ids are returned together
# The contractions that the file's splitting pattern lists, and white space as it sees it.
_SHORTS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_BLANKS = "\t\n\v\f\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
_BLANK = re.compile(f"[{_BLANKS}]+")
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")  # of a word without white space
_RUNS = re.compile("L+|N|O+")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: a fixed rule."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


class Merges:
    """A merge list: (left, right) symbols in order of rank, each making one symbol of ``ids``."""

    def __init__(self, ids: dict[str, int], pairs: list[tuple[str, str]], width=len):
        self.size = max(ids.values(), default=0) + 1
        self.rule: dict[int, tuple[int, int]] = {}
        self.width = {ids[s]: width(s) for s in ids}
        lefts: dict[int, set[int]] = {}
        made: set[int] = set()
        parts = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        results = {c for _, _, c in parts}
        for rank, (a, b, c) in enumerate(parts):
            if any(x in results and x not in made for x in (a, b)):
                raise ValueError("a merge list uses a symbol before it is made")
            made.add(c)
            self.rule.setdefault(a * self.size + b, (rank, c))
            lefts.setdefault(c, set()).add(a)
        self.lookahead = self._lookahead(parts, lefts)

    def _lookahead(self, parts: list[tuple[int, int, int]], lefts: dict[int, set[int]]) -> int:
        """The longest reach of a chain of merges, each across the border that the one before it moved left.

        A merge across a border moves it left by the width of its left part. A later merge across the new border
        needs a right part that can begin with that left part, and a later rank.
        """
        reach: dict[int, int] = {}  # of chains of later ranks, by what stands right of the border
        longest = 0
        for a, b, _ in reversed(parts):
            own = self.width[a] + reach.get(a, 0)
            longest = max(longest, own)
            todo, seen = [b], set()
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    reach[x] = max(reach.get(x, 0), own)
                    todo.extend(lefts.get(x, ()))
        return longest

    def apply(self, symbols: list[int]) -> list[int]:
        """Tokens of a sequence of symbols."""
        if len(symbols) > 48:
            return self._apply_long(symbols)
        out, rule, size = list(symbols), self.rule.get, self.size
        found = [rule(a * size + b, _NONE) for a, b in zip(out, out[1:])]  # the merge of each neighbouring pair
        while found:
            best = min(found)
            if best is _NONE:
                break
            at = found.index(best)
            out[at:at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = rule(out[at - 1] * size + best[1], _NONE)
            if at < len(found):
                found[at] = rule(best[1] * size + out[at + 1], _NONE)
        return out

    def _apply_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap of pairs and links to neighbours, for long sequences."""
        rule, size, n = self.rule, self.size, len(symbols)
        out, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def look(i: int) -> None:
            j = after[i]
            if j < n and (found := rule.get(out[i] * size + out[j])):
                heapq.heappush(heap, (found[0], i, out[i], out[j], found[1]))

        for i in range(n):
            look(i)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if out[i] != left or j >= n or out[j] != right:
                continue
            out[i], out[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        return [x for x in out if x >= 0]


class Transducer:
    """Tokens of one word read piece by piece; holds at most lookahead + window symbols and one piece."""

    def __init__(self, merges: Merges, window: int = WINDOW):
        self.merges, self.window, self.held = merges, window, []

    def feed(self, symbols: Iterable[int]) -> list[int]:
        """Tokens that are final after ``symbols``, which are not the last of the word."""
        self.held.extend(symbols)
        out: list[int] = []
        most = self.merges.lookahead + self.window
        while len(self.held) >= most:
            part, end = self.held[:most], 0
            for token in self.merges.apply(part):
                if end + self.merges.width[token] > most - self.merges.lookahead:
                    break
                out.append(token)
                end += self.merges.width[token]
            if not end:  # one token is wider than the window
                most += self.window
                continue
            del self.held[:end]
        return out

    def finish(self, last: Iterable[int] = ()) -> list[int]:
        """The tokens left, with the word's ``last`` symbols."""
        out = self.merges.apply([*self.held, *last])
        self.held = []
        return out


@lru_cache(maxsize=1)
def _joining() -> frozenset[str]:
    """Characters that a normaliser may join to the one before them."""
    found = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for c in map(chr, range(0x300, 0x110000)):
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


def _starts(c: str) -> bool:
    """Whether text can be normalised apart before ``c``."""
    if c < "̀":
        return True
    if unicodedata.category(c) == "Cn":  # newer than the table here
        return False
    first = unicodedata.normalize("NFD", c)[0]
    return not unicodedata.combining(first) and first not in _joining()


class _Kinds(dict):
    """Character to L (letter), N (number), S (white space) or O (other), as the file's splitter sees it."""

    def __init__(self, splitter):
        self.splitter = splitter

    def __missing__(self, c: str) -> str:
        spans = [span for _, span in self.splitter.pre_tokenize_str(f"a{c}1{c}{c}")]
        self[c] = "L" if (0, 2) in spans else "S" if len(spans) == 2 else "N" if (3, 4) in spans else "O"
        return self[c]


class Vocabulary:
    """What a vocabulary file says: symbols, merges, added tokens, normaliser and classes of characters."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        model = read["model"]
        self.end = model["end_of_word_suffix"] or ""
        if model["type"] != "BPE" or not self.end or model["continuing_subword_prefix"] or read["decoder"]:
            raise ValueError("not a vocabulary over bytes with a mark at word ends")
        ids, letters = model["vocab"], byte_letters()
        self.inner = [ids[letters[b]] for b in range(256)]
        self.last = [ids[letters[b] + self.end] for b in range(256)]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # A merge's left part has no end mark, so joining the two strings is the new symbol's.
        self.merges = Merges(ids, pairs, lambda s: len(s.removesuffix(self.end)))
        self.added = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.names = {i: s for s, i in (*ids.items(), *self.added.items())}
        values = {c: b for b, c in letters.items()}
        self.bytes = {
            i: s.encode() if s in self.added else
            bytes(values[c] for c in s.removesuffix(self.end)) + (b" " if s.endswith(self.end) else b"")
            for i, s in self.names.items()}
        library = Tokenizer.from_file(path)
        self.normal = library.normalizer.normalize_str
        self.kinds = _Kinds(library.pre_tokenizer)
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.parts = _Parts(self)
        self.words = _Words(self)

    def symbols(self, part: str) -> list[int]:
        """A symbol for each byte of a whole part of a word, the last one with the mark."""
        data = part.encode()
        out = list(map(self.inner.__getitem__, data))
        out[-1] = self.last[data[-1]]
        return out


class _Recent(dict):
    """Results by word: the latest ``_KEPT`` ones, and those used among as many before them."""

    def __init__(self, vocabulary: Vocabulary):
        self.own, self.older = vocabulary, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > _LONG:
                return value
        if len(self) >= _KEPT:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class _Parts(_Recent):
    """Part of a word (letters, a number or other marks) to its ids."""

    def compute(self, part: str) -> list[int]:
        return self.own.merges.apply(self.own.symbols(part))


class _Words(_Recent):
    """What stands between white space to its ids as little-endian bytes."""

    def compute(self, word: str) -> bytes:
        if len(word) > _LONG or "<|" in word or ("'" in word and not word.isascii()):
            return b"".join(_bytes(x) for x in encoded((word,), self.own))
        if word.isascii():
            low = word.lower()
            if low.isalpha():
                return _bytes(self.own.merges.apply(self.own.symbols(low)))
            parts = _ASCII.findall(low)
        else:
            low = self.own.normal(word)
            kinds = "".join(map(self.own.kinds.__getitem__, low))
            parts = [low[m.start():m.end()] for m in _RUNS.finditer(kinds)]
        return _bytes([i for part in parts for i in self.own.parts[part]])


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


@lru_cache(maxsize=4)
def vocabulary(path: str = VOCABULARY) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Ids of a text that arrives in pieces, cut anywhere."""

    def __init__(self, own: Vocabulary, window: int = WINDOW):
        self.own, self.window = own, window
        self.raw = ""  # not yet normalised
        self.text = ""  # normalised, not yet split
        self.kind = None  # of the open run
        self.word = Transducer(own.merges, window)
        self.byte = None  # last byte of the open run: the word may end with it

    def feed(self, piece: str) -> list[int]:
        """Ids that are final after this piece."""
        out: list[int] = []
        parts = self.own.split_added.split(self.raw + piece)
        for text, token in zip(parts[::2], parts[1::2]):
            out += self._normalised(text, True) + [self.own.added[token]]
        rest = parts[-1]
        cut = len(rest)  # keep what an added token may begin with
        for token in self.own.added:
            for n in range(min(len(token) - 1, len(rest)), 0, -1):
                if rest.endswith(token[:n]):
                    cut = min(cut, len(rest) - n)
                    break
        # Normalise up to the last place before which nothing can join.
        at = min(cut, len(rest) - 1)
        while at > 0 and not _starts(rest[at]):
            at -= 1
        self.raw = rest[max(at, 0):]
        return out + self._normalised(rest[:max(at, 0)], False)

    def finish(self) -> list[int]:
        raw, self.raw = self.raw, ""
        return self._normalised(raw, True)

    def _normalised(self, raw: str, final: bool) -> list[int]:
        out: list[int] = []
        text = self.text + (self.own.normal(raw) if raw else "")
        at, kinds = 0, self.own.kinds
        while at < len(text):
            kind = kinds[text[at]]
            if self.kind is not None and kind == self.kind:
                end = at + 1
                while end < len(text) and kinds[text[end]] == kind:
                    end += 1
                out += self._run(text[at:end])
                at = end
                continue
            out += self._end()
            if kind == "S":
                at += 1
                continue
            if text[at] == "'":
                if len(text) - at < 3 and not final:
                    break
                short = next((s for s in _SHORTS if text.startswith(s, at)), None)
                if short:
                    out += self._run(short) + self._end()
                    at += len(short)
                    continue
            out += self._run(text[at])
            at += 1
            if kind == "N":
                out += self._end()
            else:
                self.kind = kind
        self.text = text[at:]
        return out + self._end() if final else out

    def _run(self, text: str) -> list[int]:
        data = text.encode()
        before = [] if self.byte is None else [self.own.inner[self.byte]]
        self.byte = data[-1]
        return self.word.feed([*before, *(self.own.inner[b] for b in data[:-1])])

    def _end(self) -> list[int]:
        self.kind = None
        if self.byte is None:
            return []
        last, self.byte = self.own.last[self.byte], None
        return self.word.finish([last])


def encoded(pieces: Iterable[str], own: Vocabulary, window: int = WINDOW) -> Iterator[list[int]]:
    """Ids of a text given in pieces, as they become final; memory does not grow with the text."""
    encoder = Encoder(own, window)
    for piece in pieces:
        for begin in range(0, len(piece), _CHUNK):
            yield encoder.feed(piece[begin:begin + _CHUNK])
    yield encoder.finish()


def token_ids(text: str, own: Vocabulary) -> np.ndarray:
    """Ids of a whole text, as the ``tokenizers`` library gives them with add_special_tokens=False."""
    out, begin = [], 0
    while begin < len(text):
        end = begin + _CHUNK
        blank = _BLANK.search(text, end) if end < len(text) else None
        end = blank.start() if blank else len(text)
        part = text[begin:end]
        # str.split also splits at four control characters that the file's pattern takes as marks.
        odd = any(c in part for c in "\x1c\x1d\x1e\x1f")
        words = [w for w in _BLANK.split(part) if w] if odd else part.split()
        out.append(b"".join(map(own.words.__getitem__, words)))
        begin = end
    return np.frombuffer(b"".join(out), "<i4")


class Decoder:
    """Text of ids that arrive in pieces.

    As the library does for a file without a decoder, the tokens' own strings are joined by spaces. With
    ``plain`` the bytes that they stand for are read as UTF-8, a word's end as a space; a character that
    is cut between two ids waits for its other bytes, and bytes that are no character become U+FFFD.
    """

    def __init__(self, own: Vocabulary, plain: bool = False):
        self.own, self.started = own, False
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace") if plain else None

    def feed(self, ids: list[int]) -> str:
        if self.bytes is not None:
            return self.bytes.decode(b"".join(map(self.own.bytes.__getitem__, ids)))
        if not ids:
            return ""
        between, self.started = " " if self.started else "", True
        return between + " ".join(map(self.own.names.__getitem__, ids))

    def finish(self) -> str:
        return "" if self.bytes is None else self.bytes.decode(b"", final=True)


def text_of(ids: np.ndarray, own: Vocabulary, plain: bool = False) -> str:
    decoder = Decoder(own, plain)
    parts = [decoder.feed(ids[i:i + _CHUNK].tolist()) for i in range(0, len(ids), _CHUNK)]
    return "".join([*parts, decoder.finish()])


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if sizes:
        yield begin, len(sizes)


def _encode(path: str, names: list[str], at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            column = batch.column(at)
            for begin, end in _slices(pc.binary_length(column).fill_null(0).to_pylist(), _BATCH):
                ids = [token_ids(x or "", own) for x in column.slice(begin, end - begin).to_pylist()]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.slice(begin, end - begin).columns, lists], names)
    return run


def _decode(path: str, names: list[str], at: int, plain: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            sizes = batch.column(at).value_lengths().fill_null(0).to_pylist()
            for begin, end in _slices(sizes, _BATCH // 4):
                part = batch.slice(begin, end - begin)
                column = part.column(at)
                texts = [
                    text_of(column[i].values.to_numpy(zero_copy_only=False), own, plain) if column[i].is_valid else None
                    for i in range(len(column))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names)
    return run


def encode(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Rows of ``docs`` with the ids of their whole text, ``ids`` array<int>.

    The ids are those of the ``tokenizers`` library with add_special_tokens=False, added tokens in a text
    included. A null or empty text, or one of white space, has no ids. Equal rows get equal ids; all other
    columns are kept, one named ids is replaced. An empty table gives an empty result.
    """
    ids = T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)
    return with_columns_mapped(spread(docs), lambda names, at: _encode(path, names, at("text")), [ids])


def decode(encoded_rows: DataFrame, path: str = VOCABULARY, plain: bool = False) -> DataFrame:
    """Rows with the text of their ``ids``, ``decoded``: as the library's decode, special tokens kept.

    With ``plain`` it is readable text, a space behind each word. No ids give an empty text, null ids null. All
    other columns are kept, one named decoded is replaced.
    """
    text = T.StructField("decoded", T.StringType(), True)
    return with_columns_mapped(encoded_rows, lambda names, at: _decode(path, names, at("ids"), plain), [text])
