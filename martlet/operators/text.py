"""Text analytics without a hosted model: tokens, field extraction, summaries, classification."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.sizing import lookup_join, spread, stored

# Scripts written without spaces, and the marks that end a sentence.
CJK = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー"
SENTENCE_END = ".!?。！？"
RUNS = rf"[{CJK}]+|[\p{{L}}\p{{N}}&&[^{CJK}]]+"
WORDS = r"[\p{L}\p{N}]+"
BLANK = r"[\s\p{Z}]"


def _bigrams(run: Column) -> Column:
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(run) - 1, F.lit(1))),
        lambda i: run.substr(i, F.lit(2)),
    )
    return pairs


def tokens(text: Column) -> Column:
    """Lower-case words; runs of Chinese or Japanese characters become overlapping pairs."""
    lowered = F.lower(text)
    runs = F.regexp_extract_all(lowered, F.lit(RUNS), F.lit(0))
    paired = F.flatten(F.transform(
        runs, lambda r: F.when(r.rlike(f"^[{CJK}]"), _bigrams(r)).otherwise(F.array(r))))
    plain = F.regexp_extract_all(lowered, F.lit(WORDS), F.lit(0))
    return F.when(lowered.rlike(f"[{CJK}]"), paired).otherwise(plain)


def sentences(text: Column) -> Column:
    """Pieces between sentence ends or line ends, without white space around them."""
    found = F.regexp_extract_all(
        text, F.lit(rf"[^{SENTENCE_END}\n]+[{SENTENCE_END}]*"), F.lit(0))
    bare = F.transform(found, lambda s: F.regexp_replace(s, rf"^{BLANK}+|{BLANK}+$", ""))
    return F.filter(bare, lambda s: s != "")


def extract_fields(text: Column, rules: dict[str, str]) -> Column:
    """A struct with one array of matches per rule; a rule is a regular expression."""
    return F.struct(*[
        F.regexp_extract_all(text, F.lit(rule), F.lit(0)).alias(name)
        for name, rule in rules.items()
    ])


def document_frequency(docs: DataFrame, text: str) -> DataFrame:
    """``term``, ``df``: in how many documents each term occurs."""
    return docs.select(F.explode(F.array_distinct(tokens(F.col(text)))).alias("term")).groupBy(
        "term").agg(F.count(F.lit(1)).alias("df"))


def summarise(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and the one sentence whose terms are, on average, the rarest in the collection.

    Scores are rounded to 6 digits and the earlier sentence wins a tie. A document without a
    sentence keeps a NULL summary. Only (key, position, term) is shuffled, never the text.
    """
    total = docs.count()
    docs = spread(docs)
    frequency = stored(document_frequency(docs, text))
    rarity = frequency.select(
        "term", F.log(F.lit(float(total + 1)) / (F.col("df") + 1)).alias("idf"))
    numbered = docs.select(key, F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))
    terms = numbered.select(
        key, "pos", F.explode(F.array_distinct(tokens(F.col("sentence")))).alias("term"))
    scored = lookup_join(terms, rarity, "term").groupBy(key, "pos").agg(
        F.round(F.avg("idf"), 6).alias("score"))
    best = scored.groupBy(key).agg(
        F.min_by("pos", F.struct(-F.col("score"), "pos")).alias("pos"))
    return docs.join(best, key, "left").select(
        key, F.get(sentences(F.col(text)), F.col("pos")).alias("summary"))


def term_vectors(docs: DataFrame, text: str, features: int = 1 << 14) -> DataFrame:
    """``docs`` with hashed term counts in ``_tf``; stored once, they serve any number of label sets."""
    words = spread(docs).withColumn("_tokens", tokens(F.col(text)))
    return HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features).transform(words).drop("_tokens")


class TextClassifier:
    """Logistic regression on hashed, idf-weighted tokens, fitted to labelled texts.

    ``labels`` names the classes in the order of their numbers in the label column, so the same
    texts can be classified along another label set by fitting another instance. Tables that have ``_tf`` of
    :func:`term_vectors` are used as they are.
    """

    def __init__(self, labels: list[str], features: int = 1 << 14, iterations: int = 20):
        self.labels, self.features = labels, features
        self._pipeline = Pipeline(stages=[
            IDF(inputCol="_tf", outputCol="_features"),
            LogisticRegression(featuresCol="_features", labelCol="_label",
                               maxIter=iterations, regParam=0.01),
        ])
        self._model = None

    def _vectors(self, docs: DataFrame, text: str) -> DataFrame:
        return docs if "_tf" in docs.columns else term_vectors(docs, text, self.features)

    def fit(self, labelled: DataFrame, text: str, label: str) -> TextClassifier:
        self._model = self._pipeline.fit(self._vectors(labelled, text).select(
            "_tf", F.col(label).cast("double").alias("_label")))
        return self

    def classify(self, docs: DataFrame, text: str) -> DataFrame:
        """``docs`` with the column ``class``: a struct of ``label`` and ``score``."""
        scored = self._model.transform(self._vectors(docs, text))
        names = F.array(*[F.lit(n) for n in self.labels])
        score = F.get(vector_to_array("probability"), F.col("prediction").cast("int"))
        kept = [c for c in docs.columns if c != "_tf"]
        return scored.select(*kept, F.struct(
            F.get(names, F.col("prediction").cast("int")).alias("label"), score.alias("score"),
        ).alias("class"))


def _counted(words: DataFrame, kept: Sequence[str]) -> DataFrame:
    """``kept``, ``term``, ``tf`` of each row by itself: its sorted tokens, where a run of equal ones begins and ends."""
    sizes = words.select(*kept, F.array_sort("_tokens").alias("_sorted"))
    begins = sizes.select(*kept, F.size("_sorted").alias("_n"), F.array_compact(F.transform("_sorted", lambda w, i: F.when(
        (i == 0) | (w != F.get("_sorted", i - 1)), F.struct(w.alias("term"), i.alias("at"))))).alias("_runs"))
    counts = F.transform("_runs", lambda r, j: F.struct(
        r["term"].alias("term"),
        (F.coalesce(F.get("_runs", j + 1)["at"], F.col("_n")) - r["at"]).cast("long").alias("tf")))
    # inline_outer keeps the optimizer from tokenising once more for a filter on the array's size.
    return begins.select(*kept, F.inline_outer(counts)).where(F.col("term").isNotNull())


def count_terms(words: DataFrame, kept: Sequence[str], key: str) -> DataFrame:
    """``kept``, ``term``, ``tf`` of rows with ``_tokens``. Only rows whose ``key`` is there more than once are
    counted together, by a shuffle; all others need none."""
    copied = stored(words.groupBy(F.col(key).alias("_copied")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_copied"))
    if copied.isEmpty():
        return _counted(words, kept)
    same = F.col(key).eqNullSafe(F.col("_copied"))
    alone, several = (lookup_join(words, copied, same, how) for how in ("left_anti", "left_semi"))
    return _counted(alone, kept).unionByName(
        _counted(several, kept).groupBy(*kept, "term").agg(F.sum("tf").alias("tf")))


def term_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``term``, ``tf`` of every text."""
    return count_terms(spread(docs.select(key, text)).select(key, tokens(F.col(text)).alias("_tokens")), [key], key)


class BayesClassifier:
    """Multinomial naive Bayes on terms: counts of each class, add-one smoothing, every number an aggregate.

    ``labels`` names the classes in the order of their numbers in the label column. Terms that no labelled text
    holds say nothing; a text without known terms gets the most frequent class.
    """

    def __init__(self, labels: list[str]):
        self.labels = labels

    def fit(self, terms: DataFrame, key: str, labelled: DataFrame, label: str) -> BayesClassifier:
        """``terms`` as :func:`term_counts` gives them, ``labelled`` with ``key`` and the class's number."""
        classes = range(len(self.labels))
        texts = labelled.select(key, F.col(label).cast("int").alias("_class")).where(F.col("_class").isNotNull())
        own = lookup_join(terms, texts, key)
        count = lambda c: F.sum(F.when(F.col("_class") == c, F.col("tf")).otherwise(0)).alias(f"n{c}")
        by_term = stored(own.groupBy("term").agg(*[count(c) for c in classes]))
        totals = by_term.agg(F.count(F.lit(1)).alias("v"), *[F.coalesce(F.sum(f"n{c}"), F.lit(0)).alias(f"n{c}") for c in classes]).first()
        held = texts.groupBy("_class").count().collect()  # a row for each class
        held = {r["_class"]: r["count"] for r in held}
        all_texts = sum(held.values())
        self._prior = [F.log(F.lit((held.get(c, 0) + 1.0) / (all_texts + len(self.labels)))) for c in classes]
        self._weights = by_term.select("term", *[
            F.log((F.col(f"n{c}") + 1.0) / float(totals[f"n{c}"] + totals["v"])).alias(f"w{c}") for c in classes])
        return self

    def classify(self, terms: DataFrame, key: str, docs: DataFrame) -> DataFrame:
        """``key``, ``label``, ``score`` (the class's probability, rounded) of every row of ``docs``; keys are unique."""
        classes = range(len(self.labels))
        sums = lookup_join(terms, self._weights, "term").groupBy(key).agg(
            *[F.sum(F.col("tf") * F.col(f"w{c}")).alias(f"s{c}") for c in classes])
        logs = [F.coalesce(F.col(f"s{c}"), F.lit(0.0)) + self._prior[c] for c in classes]
        scored = docs.select(key).join(sums, key, "left").select(key, F.array(*logs).alias("_logs"))
        # Ties go to the class first in order.
        best = F.array_position("_logs", F.array_max("_logs")).cast("int") - 1
        total = F.aggregate("_logs", F.lit(0.0), lambda s, x: s + F.exp(x - F.array_max("_logs")))
        names = F.array(*[F.lit(n) for n in self.labels])
        return scored.select(key, F.get(names, best).alias("label"), F.round(1 / total, 6).alias("score"))


_CLASSES = (("0123456789", "0-9"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A-Z"), ("abcdefghijklmnopqrstuvwxyz", "a-z"))


def _runs(example: str) -> list[tuple[str, int]]:
    """Runs of digits, capitals and small letters with their lengths; any other sign stands for itself.

    Three or more runs without a sign between them, as in a code, are one run of all their kinds.
    """
    out: list[tuple[str, int]] = []
    for word in re.findall("[0-9A-Za-z]+|.", example, re.DOTALL):
        kinds = [next((k for signs, k in _CLASSES if c in signs), None) for c in word]
        if kinds[0] is None:
            out.append((re.escape(word), 1))
            continue
        cuts = [i for i in range(len(word)) if i == 0 or kinds[i] != kinds[i - 1]]
        if len(cuts) > 2:
            out.append((f"[{''.join(sorted(set(kinds)))}]", len(word)))
        else:
            out += [(f"[{kinds[low]}]", high - low) for low, high in zip(cuts, [*cuts[1:], len(word)])]
    return out


def learned_rule(examples: Sequence[str]) -> str:
    """A regular expression that generalises examples: those of one form share it, with all lengths between theirs.

    What it matches stands alone: no letter or digit beside it. Longer forms are tried first.
    """
    forms: dict[tuple[str, ...], list[tuple[int, ...]]] = {}
    for example in examples:
        runs = _runs(example)
        if not runs:
            raise ValueError("an example is empty")
        forms.setdefault(tuple(k for k, _ in runs), []).append(tuple(n for _, n in runs))
    patterns = []
    for kinds, lengths in forms.items():
        parts = [
            kind if not kind.startswith("[") else f"{kind}{{{low},{high}}}" if low != high else f"{kind}{{{low}}}"
            for kind, low, high in zip(kinds, map(min, zip(*lengths)), map(max, zip(*lengths)))]
        edge = lambda kind: r"\b" if kind.startswith("[") else ""
        patterns.append((-len(kinds), edge(kinds[0]) + "".join(parts) + edge(kinds[-1])))
    return "|".join(p for _, p in sorted(patterns))
