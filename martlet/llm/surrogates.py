"""Replace personal data by keyed surrogates of the same type.

Detected: e-mail, IPv4 and IPv6 addresses, telephone, card, account (IBAN) and social security numbers, secrets
after a name such as ``access_token =`` or ``"password":``, keys of known forms, and personal names after a title,
with a known first name, or after a known family name that comes first. A name's parts are looked for once more
alone in the same text. An entity is a type and a normal form, so its spellings in all documents get one surrogate
(coreference); first and last names are entities of their own, so a person keeps the same parts everywhere.

A surrogate is drawn from a keyed hash of the entity and an attempt number. It keeps what its type
shows: lengths, separators, letter case, script, gender of a first name, top-level domain, country and check
digits. Collisions are looked for among all entities of the corpus: a surrogate that is itself an entity,
or that another entity has taken, is drawn again with the next attempt, so that distinct entities stay
distinct. From the fourth attempt on surrogates grow by a sign every four attempts, so each type's space becomes
larger than any corpus and the drawing ends; an entity without a letter or digit, which could not change, is none.
Attempts above 0 are few; they are kept as exceptions and joined to the texts that hold them. Texts
are otherwise read twice and never moved.
"""

from __future__ import annotations

import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.common import column, drop, spread, stored
from martlet.sizing import lookup_join

# Titles and names that show a person, by gender.
FEMALE_TITLES = "Mrs Ms Miss Frau Mme Madame Mlle Señora Sra Señorita госпожа Κυρία السيدة".split()
MALE_TITLES = "Mr Herr M Monsieur Señor Sr господин Κύριος Κύριε السيد".split()
FEMALE_NAMES = (
    "Anna Maria Mary Elizabeth Sarah Laura Julia Emma Sophie Marie Claire Carmen Lucía Isabel Katharina Susanne "
    "Анна Мария Елена Ольга Наталья Fatima Aisha Amina Leila Mei Yuki Priya Olivia Emily Jessica Linda Patricia Barbara "
    "Susan Karen Nancy Helen Sofia Giulia Chiara Ingrid Astrid Zofia Agnieszka Lucia Hannah Lena Monika Petra Rosa "
    "Ελένη Μαρία Άννα فاطمة مريم").split()
MALE_NAMES = (
    "John James Robert Michael David William Peter Thomas Hans Klaus Pierre Jean Antonio José Carlos Miguel Paul "
    "Иван Александр Сергей Дмитрий Андрей Mohammed Muhammad Ahmed Omar Wei Hiroshi Kenji Arjun Daniel Paolo Marco Luca "
    "Giovanni Lars Erik Piotr Andrzej Mehmet Richard Charles Joseph Christopher Henri Louis François Luis Juan Diego "
    "Pedro Stefan Andreas Martin Γιώργος Νίκος محمد أحمد").split()
FAMILY_FIRST = "Wang Zhang Chen Liu Huang Zhao Nguyen Tran".split()
_NOISE = r"[!#$%&*]{0,3}"  # marks that some texts put behind each word
_CAPITAL = r"(?=[^\W\d_a-zß-öø-ÿа-яёά-ώ])"
_WORD = r"[^\W\d_][^\W\d_'’-]+"
_FIRST = "|".join(FEMALE_NAMES + MALE_NAMES)
_TITLE = "|".join(FEMALE_TITLES + MALE_TITLES)
_FAMILY = "|".join(FAMILY_FIRST)
_HEX = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    "email": r"(?<![\w.+-])[\w+-][\w.+-]*@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}(?![\w-])",
    "secret": (
        r"(?i:api[_-]?key|secret|token|passwd|password|passphrase|pwd|access[_-]?key|private[_-]?key)[\w-]{0,24}[\"']?"
        r"\s*(?:=>|:=|[=:])\s*(?:\"(?P<quoted>[^\"\n]{6,})\"|'(?P<single>[^'\n]{6,})'"
        r"|[\"']?(?P<value>[^\s\"'<>,;]{5,}[^\s\"'<>,;.)\]}]))"),
    "key": (
        r"\b(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_\w{36}|sk-[\w-]{20,}|xox[abprs]-[\w-]{10,}|AIza[\w-]{35}"
        r"|eyJ[\w-]+\.[\w-]+\.[\w-]+)(?![\w-])"),
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d)(?!\w)",
    "ip6": rf"(?<![\w:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX})*)?::(?:{_HEX}(?::{_HEX})*)?)(?![\w:])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w-])",
    "phone": (
        rf"(?<![\w+])(?:\+\d{{1,3}}{_NOISE}[ .-]?(?:\(\d{{1,4}}\){_NOISE}[ .-]?)?\d{{2,4}}(?:{_NOISE}[ .-]?\d{{2,4}}){{1,4}}"
        rf"|\(\d{{2,5}}\){_NOISE} ?\d{{3}}[ .-]?\d{{3,4}}|\d{{3}}[ .-]\d{{3}}[ .-]\d{{4}}|0\d{{1,4}}[ /-]\d{{5,8}})(?!\w)"),
    "person": (
        rf"\b(?:(?P<title>{_TITLE})\b\.?\s+(?:(?P<first1>{_FIRST})\s+)?(?P<last1>{_CAPITAL}{_WORD})"
        rf"|(?P<first2>{_FIRST})\s+(?P<last2>{_CAPITAL}{_WORD})|(?P<last3>{_FAMILY})\s+(?P<first3>{_CAPITAL}{_WORD}))"),
}
_COMPILED = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
_PARTS = ("first1", "last1", "first2", "last2", "last3", "first3")
# What a text must hold for a pattern to match; most texts hold none of it, and these are quick to look for.
_DIGIT = re.compile(r"[@\d]")
_KEYWORDS = ("secret", "token", "passw", "passphrase", "pwd", "key")
_FORMS = ("AKIA", "ASIA", "gh", "sk-", "xox", "AIza", "eyJ")
_CAPITALISED = re.compile(r"[^\W\d_a-zß-öø-ÿά-ώ]\w*")
_NAMED = frozenset(FEMALE_NAMES + MALE_NAMES + FEMALE_TITLES + MALE_TITLES + FAMILY_FIRST)
_GENDER = {n.lower(): "f" for n in FEMALE_NAMES + FEMALE_TITLES} | {n.lower(): "m" for n in MALE_NAMES + MALE_TITLES}
_SYLLABLES = {
    "latin": ("b d f g k l m n p r s t v z".split(), "a e i o u".split()),
    "cyrillic": ("б в г д з к л м н п р с т".split(), "а е и о у".split()),
    "greek": ("β γ δ κ λ μ ν π ρ τ".split(), "α ε ι ο".split()),
    "arabic": ("ب ت ج د ر س ف ق ك ل م ن".split(), "ا و ي".split()),
}
_ENDINGS = {
    ("latin", "f"): "ina", ("latin", "m"): "or", ("cyrillic", "f"): "ина", ("cyrillic", "m"): "ор",
    ("greek", "f"): "ινα", ("greek", "m"): "ορ", ("arabic", "f"): "ينا", ("arabic", "m"): "ور"}
_ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"}


def script_of(word: str) -> str:
    """Script of a word's first letter, as the first part of its Unicode name."""
    return next((unicodedata.name(c, "latin").split()[0].split("-")[0].lower() for c in word if c.isalpha()), "latin")


def _alphabet(c: str) -> str:
    """Lower-case letters to draw from in place of ``c``: its script's, or its neighbours of the same kind."""
    known = _ALPHABETS.get(script_of(c))
    if known:
        return known
    low = ord(c) & ~63
    own = unicodedata.category(c)
    return "".join(d for d in map(chr, range(low, low + 64)) if unicodedata.category(d) == own) or c


def _matches(text: str) -> Iterator[tuple[int, int, str, re.Match]]:
    low = text.lower()
    kinds = []
    if _DIGIT.search(text):
        kinds += ["email", "iban", "ip", "ssn", "card", "phone"]
    if "::" in text or (kinds and text.count(":") >= 7):
        kinds.append("ip6")
    if any(k in low for k in _KEYWORDS):
        kinds.append("secret")
    if any(k in text for k in _FORMS):
        kinds.append("key")
    if not _NAMED.isdisjoint(_CAPITALISED.findall(text)) or "госпо" in text:
        kinds.append("person")
    for kind in kinds:
        for match in _COMPILED[kind].finditer(text):
            yield match.start(), match.end(), kind, match


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, normal form) of the entities in a text, in order and without overlap.

    Of matches that overlap the one that begins first stays, then the one whose type is listed first.
    """
    if not text:
        return []
    order = {kind: i for i, kind in enumerate(PATTERNS)}
    found, end = [], 0
    for start, stop, kind, match in sorted(_matches(text), key=lambda m: (m[0], order[m[2]], m[1])):
        if start < end:
            continue
        own = []
        if kind == "person":
            for part in _PARTS:
                if word := match[part]:
                    script = script_of(word)
                    gender = _GENDER.get(word.lower(), "n")
                    name = f"first.{gender}.{script}" if part[:5] == "first" else f"last.{script}"
                    own.append((*match.span(part), name, word.lower()))
            own.sort()
        elif kind == "secret":
            part = next(p for p in ("quoted", "single", "value") if match[p])
            if any(c.isalnum() for c in match[part]):
                own.append((*match.span(part), kind, match[part]))
        elif kind == "ip6":
            try:
                own.append((start, stop, kind, ipaddress.IPv6Address(match[0]).exploded))
            except ValueError:
                continue
            if not any(c.isdigit() for c in match[0]):
                continue
        elif kind == "key":
            own.append((start, stop, kind, match[0]))
        else:
            value = match[0]
            normal = value.lower() if kind == "email" else value if kind == "ip" else re.sub(r"[^\w+]", "", value).lower()
            own.append((start, stop, kind, normal))
        if own:
            found += own
            end = stop
    names = {text[s:e]: (kind, normal) for s, e, kind, normal in found if kind.startswith(("first", "last"))}
    if names:  # the same words alone, elsewhere in the text
        taken = sorted((s, e) for s, e, *_ in found)
        alone = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)")
        at = 0
        for match in alone.finditer(text):
            while at < len(taken) and taken[at][1] <= match.start():
                at += 1
            if at == len(taken) or taken[at][0] >= match.end():
                found.append((*match.span(), *names[match[0]]))
        found.sort()
    return found


class _Draws:
    """Endless keyed stream of small numbers."""

    def __init__(self, key: bytes, *what: object):
        self.key, self.what, self.block, self.left = key, "\0".join(map(str, what)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.digest(self.key, self.what + self.block.to_bytes(4, "big"), "sha256")
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n


def _alike(text: str, draws: _Draws, hexadecimal: bool = False) -> str:
    """Digits for digits and letters for letters of the same script and case; marks stay."""
    out = []
    for c in text:
        if hexadecimal and c in "0123456789abcdefABCDEF":
            d = "0123456789abcdef"[draws.below(16)]
            out.append(d.upper() if c.isupper() else d)
        elif c.isdigit():
            out.append(str(draws.below(10)))
        elif c.isalpha():
            letters = _alphabet(c)
            d = letters[draws.below(len(letters))]
            out.append(d.upper() if c.isupper() else d)
        else:
            out.append(c)
    return "".join(out)


def luhn(digits: str) -> int:
    """Luhn remainder of a number: 0 if its last digit checks."""
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * d, 10)) for d in values[1::2])) % 10


def surrogate(key: bytes, kind: str, normal: str, attempt: int) -> str:
    """Normal form of an entity's surrogate; ``attempt // 4`` signs longer than the first one's."""
    draws = _Draws(key, kind, normal, attempt)
    more = attempt // 4
    digits = lambda n: "".join(str(draws.below(10)) for _ in range(n))
    if kind == "email":
        local, _, domain = normal.rpartition("@")
        labels = domain.split(".")
        names = [_alike(x, _Draws(key, "domain", x)) for x in labels[:-1]]  # a domain stays one domain
        return f"{_alike(local, draws)}{_alike('a' * more, draws)}@{'.'.join([*names, labels[-1]])}"
    if kind == "ip":
        if more:  # the space of IPv4 addresses is finite; beyond it stands one of IPv6
            return _address(draws)
        return ".".join(str(1 + draws.below(254)) for _ in range(4))
    if kind == "ip6":
        return _address(draws) if not more else f"{_address(draws)}%{digits(more)}"
    if kind == "card":
        body = normal[0] + _alike(normal[1:-1], draws) + digits(more)
        check = (10 - luhn(body + "0")) % 10
        return body + str(check if luhn(normal) == 0 else (check + 1 + draws.below(9)) % 10)
    if kind == "phone":
        if not normal.startswith("+"):
            first = "0" if normal[0] == "0" else str(2 + draws.below(8))
            return first + _alike(normal[1:], draws) + digits(more)
        country = normal[:2] if normal[1] in "17" else normal[:3]
        return country + str(2 + draws.below(8)) + _alike(normal[len(country) + 1:], draws) + digits(more)
    if kind == "iban":
        body = _alike(normal[4:], draws) + digits(more)
        number = "".join(str(int(c, 36)) for c in body + normal[:2] + "00")
        return f"{normal[:2]}{98 - int(number) % 97:02d}{body}"
    if kind == "key":
        prefix = next(p for p in ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox", "AIza", "eyJ") if normal.startswith(p))
        return prefix + _alike(normal[len(prefix):], draws) + digits(more)
    if kind == "secret":
        return _alike(normal, draws, hexadecimal=re.fullmatch(r"[0-9a-fA-F]+", normal) is not None) + digits(more)
    if kind == "ssn":
        return f"{1 + draws.below(665):03d}{1 + draws.below(99):02d}{1 + draws.below(9999):04d}" + digits(more)
    part, *rest = kind.split(".")
    if rest[-1] not in _SYLLABLES:
        return _alike(normal, draws) + _alike(normal[0] * more, draws)
    consonants, vowels = _SYLLABLES[rest[-1]]
    word = "".join(
        consonants[draws.below(len(consonants))] + vowels[draws.below(len(vowels))]
        for _ in range(2 + (part == "last") + more))
    return word + _ENDINGS.get((rest[-1], rest[0]) if part == "first" else None, "")


def _address(draws: _Draws) -> str:
    """An address of the range that is set aside for documentation."""
    return "2001:0db8:" + ":".join(f"{draws.below(1 << 16):04x}" for _ in range(6))


def dressed(kind: str, original: str, normal: str) -> str:
    """The surrogate in the original's case and separators."""
    if kind.startswith(("first", "last")):
        return normal.upper() if original.isupper() and len(original) > 1 else normal.capitalize()
    if kind == "email":
        return normal.upper() if original.isupper() else normal
    if kind in ("ip", "ip6", "secret", "key"):
        return normal
    letters = iter(normal.upper() if original.isupper() else normal)
    return "".join([*(next(letters, "") if c.isalnum() or c == "+" else c for c in original), *letters])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = sorted({(kind, normal) for text in batch["text"].to_pylist() for _, _, kind, normal in entities(text)})
        columns = list(zip(*pairs)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["kind", "normal"])


def _drawn(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("kind", "normal", "attempt")]
            drawn = [surrogate(key, *x) for x in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch["kind"], batch["normal"], batch["attempt"], pa.array(drawn, pa.string())],
                ["kind", "normal", "attempt", "drawn"])
    return run


def attempts(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, normal, attempt) of the entities whose first surrogate collides."""
    schema = "kind string, normal string, attempt int, drawn string"
    table = stored(found.withColumn("attempt", F.lit(0)).mapInArrow(_drawn(key), schema))
    while True:
        taken = found.select("kind", F.col("normal").alias("drawn"), F.lit(True).alias("is_entity"))
        # Of those that drew alike the one with the earliest attempt stays, then the first in order.
        first = table.groupBy("kind", "drawn").agg(F.min(F.struct("attempt", "normal")).alias("first"))
        judged = (
            table.join(first, ["kind", "drawn"]).join(taken, ["kind", "drawn"], "left")
            .withColumn("again", F.col("is_entity").isNotNull() | (F.col("first.normal") != F.col("normal"))))
        judged = stored(judged.select("kind", "normal", "attempt", "drawn", "again"))
        if judged.where("again").isEmpty():
            drop(judged)
            break
        redrawn = judged.where("again").select("kind", "normal", (F.col("attempt") + 1).alias("attempt"))
        after = stored(judged.where("NOT again").drop("again").union(redrawn.mapInArrow(_drawn(key), schema)))
        drop(table, judged)
        table = after
    return table.where("attempt > 0").select("kind", "normal", "attempt")


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (digest, *pair) for text, digest in zip(batch["text"].to_pylist(), batch["digest"].to_pylist())
            for pair in sorted({(kind, normal) for _, _, kind, normal in entities(text)})]
        columns = list(zip(*rows)) or [[], [], []]
        types = [pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["digest", "kind", "normal"])


_ENTITIES = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("surrogate", pa.string())]))


def _replaced(key: bytes, names: list[str], text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                texts, lists = [], []
                for text, known in zip(part.column(text_at).to_pylist(), part["exceptions"].to_pylist()):
                    retried = {(e["kind"], e["normal"]): e["attempt"] for e in known or []}
                    pieces, at, size, own = [], 0, 0, []
                    for start, end, kind, normal in entities(text):
                        new = dressed(kind, text[start:end], surrogate(key, kind, normal, retried.get((kind, normal), 0)))
                        pieces += [text[at:start], new]
                        size += start - at
                        own.append({"kind": kind, "start": size, "surrogate": new})
                        size, at = size + len(new), end
                    texts.append("".join([*pieces, text[at:]]) if own else text)
                    lists.append(own)
                arrays = [pa.array(texts, pa.string()) if i == text_at else part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(lists, _ENTITIES)], [*names, "entities"])
    return run


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """Rows of ``docs`` with surrogates in text, and entities (kind, start in the new text, surrogate).

    All other columns are kept as they are, whatever their names; one named entities is replaced. The same key gives
    the same surrogates for the same corpus. A null text stays null with no entities, and texts without entities do
    not change. Equal rows get equal results. A corpus without entities, or without rows, is returned as is.
    """
    kept = [c for c in docs.columns if c != "entities"]
    rows = docs.select(*[column(c) for c in kept])
    plain = [f"c{i}" for i in range(len(kept))]
    text = plain[kept.index("text")]
    texts = spread(docs.select("text"))
    found = stored(texts.mapInArrow(_found, "kind string, normal string").distinct())
    retried = stored(attempts(found, key))
    digest = F.xxhash64(text)
    known = (
        lookup_join(
            texts.withColumn("digest", F.xxhash64("text")).mapInArrow(_occurrences, "digest long, kind string, normal string"),
            retried, ["kind", "normal"])
        .groupBy("digest").agg(F.collect_set(F.struct("kind", "normal", "attempt")).alias("exceptions")))
    marked = rows.toDF(*plain)
    if retried.isEmpty():
        marked = marked.withColumn("exceptions", F.lit(None).cast("array<struct<kind:string,normal:string,attempt:int>>"))
    else:
        known = stored(known)
        marked = lookup_join(marked.withColumn("own", digest), known, F.col("own") == F.col("digest"), "left").select(
            *plain, "exceptions")
    schema = T.StructType([
        *[T.StructField(n, f.dataType, f.nullable) for n, f in zip(plain, rows.schema.fields)],
        T.StructField("entities", T._parse_datatype_string("array<struct<kind:string,start:int,surrogate:string>>"))])
    return spread(marked).mapInArrow(_replaced(key, plain, kept.index("text")), schema).toDF(*kept, "entities")
