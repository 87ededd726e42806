"""Language identification by mixtures: each document's shares of languages, and the set it is made of.

A language's model gives each byte of a word the probability of following the three before it, smoothed,
from counts over all labelled training texts; 4-grams and their contexts are counted in hashed cells, whose
number grows with the corpus from 2**17 to 2**22 for each language, so a model's size is bounded. A document's words are drawn from a mixture
of languages: expectation-maximisation over its words' likelihoods estimates the shares. The set of
languages then grows from the single best one by the next largest share for as long as the gain in
log-likelihood exceeds the penalty, half the logarithm of the number of words for each share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.common import column, spread, with_columns_mapped

BITS, MOST_BITS = 17, 22  # hashed cells of a language's model: 2 to the power of these
TEXT_BITS = 30  # a corpus of 2 to the power of so many bytes has 2**BITS cells; for each doubling there are twice as many
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
#: Fit from which on a text is in the learned languages. Letters of an unknown script have -ln 64 = -4.16 each, random
#: ones less, and texts of the test tables -2.3 at least.
LEAST_FIT = -4.0
_SETTLED = 1e-4  # expectation-maximisation ends when no share changes by more
_ROUNDS = 500  # a bound that only rounding could reach: shares settle long before
_SMOOTH = 0.5
_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = True
_LETTERS[128:] = True


def bits_for(size: int) -> int:
    """Bits of a cell's number for a corpus of so many bytes."""
    return min(MOST_BITS, BITS + max(0, max(size, 1).bit_length() - TEXT_BITS))


def grams(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of each 4-gram and of its 3-gram context, and the number of the word each ends in.

    Text is in lower case, everything but letters is a space, and runs of spaces are one.
    """
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    letters = _LETTERS[raw]
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # one space behind each word
    data = np.where(letters, raw, 32)[keep].astype(np.uint64)
    if not letters.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    data = np.concatenate((np.full(3, 32, np.uint64), data))
    with np.errstate(over="ignore"):
        three = data[:-3] | data[1:-2] << np.uint64(8) | data[2:-1] << np.uint64(16)
        four = three | data[3:] << np.uint64(24)
        cells = [((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64) for x in (four, three)]
    word = np.concatenate(([0], np.cumsum(data[3:-1] == 32)))
    return cells[0], cells[1], word


def _count(bits: int):
    """Counts of cells by language in a task: ``2 << bits`` numbers for each language at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                four, three, _ = grams(text or "", bits)
                if not len(four):
                    continue
                if lang not in sums:
                    sums[lang] = np.zeros(2 << bits, np.int64)
                cells, n = np.unique(np.concatenate((four, three + (1 << bits))), return_counts=True)
                sums[lang][cells] += n
        for lang, counts in sums.items():
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(cells), pa.string()), pa.array(cells.astype(np.int32)), pa.array(counts[cells])],
                ["lang", "cell", "n"])
    return run


class Languages:
    """Models of the learned languages: log-probability tables of fixed size."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        cells = counts.shape[1] // 2
        self.bits = cells.bit_length() - 1
        four, three = counts[:, :cells], counts[:, cells:]
        self.above = np.log(four + _SMOOTH / 64).astype(np.float32).T.copy()
        self.below = np.log(three + _SMOOTH).astype(np.float32).T.copy()

    def word_scores(self, text: str) -> tuple[np.ndarray, int]:
        """Log-likelihood of each word (rows) in each language, and the number of letters that it is of."""
        four, three, word = grams(text, self.bits)
        if not len(four):
            return np.zeros((0, len(self.names))), 0
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        return np.add.reduceat(self.above[four] - self.below[three], starts, axis=0).astype(np.float64), len(four)


def _normal(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = scores.max(1, keepdims=True)
    return np.exp(scores - top), top[:, 0]


def shares_of(scores: np.ndarray, members: list[int]) -> tuple[np.ndarray, float]:
    """Shares of the member languages by expectation-maximisation, and the log-likelihood they reach."""
    likely, top = _normal(scores[:, members])
    shares = np.full(len(members), 1 / len(members))
    for _ in range(_ROUNDS):
        joint = likely * shares
        total = joint.sum(1, keepdims=True) + 1e-300
        before, shares = shares, (joint / total).mean(0)
        if np.abs(shares - before).max() < _SETTLED:
            break
    return shares, float((np.log(likely @ shares + 1e-300) + top).sum())


def mixture(scores: np.ndarray) -> tuple[list[tuple[int, float]], float]:
    """(language, share) of the set that the penalised likelihood selects, the largest share first, and its log-likelihood."""
    words, languages = scores.shape
    single = scores.sum(0)
    order = [int(np.argmax(single))]
    chosen, best = [(order[0], 1.0)], float(single[order[0]])
    if languages > 1:
        shares, _ = shares_of(scores, list(range(languages)))
        order += [int(i) for i in np.argsort(-shares, kind="stable") if i != order[0]]
        for size in range(2, languages + 1):
            members = order[:size]
            shares, value = shares_of(scores, members)
            if value - best <= 0.5 * np.log(max(words, 2)) + 1.0:
                break
            chosen, best = list(zip(members, shares.tolist())), value
    return sorted(chosen, key=lambda x: (-x[1], x[0])), best


def train(labelled: DataFrame) -> Languages:
    """Models from (text, lang); rows of a null language or without letters teach nothing."""
    table = spread(labelled.where("lang IS NOT NULL").select("text", "lang"))
    bits = bits_for(table.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    counts = (
        table.mapInArrow(_count(bits), "lang string, cell int, n long")
        .groupBy("lang", "cell").agg(F.sum("n").alias("n")))
    # Per language one array of 2 << bits counts, whatever the number of texts.
    found = counts.toArrow()
    names = sorted(set(found["lang"].to_pylist()))
    sums = np.zeros((len(names), 2 << bits))
    if names:
        at = {n: i for i, n in enumerate(names)}
        sums[[at[x] for x in found["lang"].to_pylist()], found["cell"].to_numpy()] = found["n"].to_numpy()
    return Languages(names, sums)


_SHARES = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


def _infer(model, names: list[str], at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages: Languages = model.value
        for batch in batches:
            predicted, scores, shares, fits = [], [], [], []
            for text in batch.column(at).to_pylist():
                found, letters = languages.word_scores(text) if text and languages.names and _LETTER.search(text) else ([], 0)
                mixed, likely = mixture(found) if len(found) else ([], 0.0)
                fits.append(likely / letters if mixed else None)
                predicted.append(languages.names[mixed[0][0]] if mixed else UNKNOWN)
                scores.append(min(1.0, max(0.0, mixed[0][1])) if mixed else 0.0)
                shares.append([{"lang": languages.names[i], "share": s} for i, s in mixed])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(predicted, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(shares, _SHARES), pa.array(fits, pa.float64())], names)
    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model learns from: a third, by a checksum of the id as text; a null id is none."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with held_out, lang_pred, score, shares (languages and their shares) and fit.

    fit is the mean log-likelihood of a letter in the selected languages, null where there is none.

    Models learn from text and lang of the rows that are not held out, all of them. A prediction depends
    on the text alone. lang_pred is the language of the largest share, score that share; a text that is
    null or has no letter is ``und`` with score 0 and no shares, and so is every text when there is
    nothing to learn from. Ties go to the language first in order. Columns of ``docs`` named like the
    added ones are replaced; all others are kept. Equal rows get equal results.
    """
    languages = train(docs.where(~held_out()).select("text", F.col("lang").cast("string").alias("lang")))
    model = docs.sparkSession.sparkContext.broadcast(languages)
    added = [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("shares", T._parse_datatype_string("array<struct<lang:string,share:double>>")),
        T.StructField("fit", T.DoubleType())]
    rows = docs.select(*[column(c) for c in docs.columns if c != "held_out"])
    return with_columns_mapped(
        spread(rows), lambda names, at: _infer(model, names, at("text")), added).withColumn("held_out", held_out())


def accepted(identified: DataFrame, least_fit: float = LEAST_FIT) -> DataFrame:
    """Rows of :func:`identify` in learned languages, one or several: those that fit them better than noise does."""
    return identified.where((F.col("lang_pred") != UNKNOWN) & (F.col("fit") >= least_fit))
