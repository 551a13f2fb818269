"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

The features are densities of lexicon words, their closeness to words of the second person,
capitals, punctuation and obfuscation. The lexicon is a short list of insults and what is learned:
words and word beginnings that mark labelled toxic documents. Features of the training rows come from the lexicon of the other half, so
that no row vouches for its own words.

Scores are between 0 and 1. Null and empty texts get the score of a text without words. Without
labels of both kinds all documents get the share of toxic labels, 0 without any label. A column with
the name of the score is replaced, all other columns and rows stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, forget
from .batches import short_batches, working
from .labels import labelled

# At most so many labelled rows are learned from, and so many terms make up a lexicon.
SAMPLE = 12_000
TERMS = 3_000
REJECT = 0.7
# Part of a score that is not calibrated: it keeps the order of texts on one step of the curve.
ORDER = 0.02
# Lengths of word beginnings that can be a term of their own.
STEMS = (4, 5, 6)
# Words that address a reader, in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner euch euer ihr tu te toi ton ta tes "
    "vous votre vos tú ti tus usted ustedes vosotros vuestro".split()
)
# Common insults, known without any label. What the labels mark comes on top.
INSULTS = frozenset(
    "idiot idiots idiotic moron morons stupid dumb fool fools jerk loser losers scum trash garbage "
    "worthless pathetic disgusting clown freak creep bastard imbecile vermin filthy dummkopf trottel "
    "abschaum widerlich wertlos crétin débile ordure minable dégoûtant estúpido imbécil basura "
    "asqueroso inútil".split()
)
# Signs that stand for letters.
LEET = str.maketrans({
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
    "*": "", ".": "", "-": "", "_": "",
})
NEAR = 6
WINDOW = 50
FEATURES = (
    "hit_rate", "hits", "hit_peak", "kinds", "person_rate", "near_rate", "distance", "capitals",
    "capital_words", "shouts", "punctuation", "obfuscated", "leet_rate", "words",
)


class Model(NamedTuple):
    """``trees`` and ``curve`` are None where ``prior`` is all that is known."""

    lexicon: frozenset[str]
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    prior: float


REMEMBERED = 150_000
_BITS, _MOST = 14, (1 << 14) - 1
_HIT, _PERSON, _CAPITAL, _HIDDEN, _LEET = 1, 2, 4, 8, 16
_INNER = re.compile(r"[^\W\d_][^\s\w]+[^\W\d_]|[^\W\d_][0-9@$*!]+[^\W\d_]")


class _Words(dict):
    """What a word tells, packed into an integer: five flags and counts of letters, capitals and
    other signs. Worked out at its first use."""

    def __init__(self, lexicon: frozenset[str]):
        super().__init__()
        self.lexicon = lexicon

    def listed(self, word: str) -> bool:
        known = self.lexicon
        return word in known or any(len(word) > n and word[:n] + "*" in known for n in STEMS)

    def __missing__(self, token: str) -> int:
        low = token.lower()
        core = low.strip("\"'.,;:!?()[]{}<>|&%$#*-_/\\")
        code = 0
        if self.listed(core):
            code |= _HIT
        elif _INNER.search(token) and self.listed(core.translate(LEET)):
            code |= _LEET
        if core in SECOND_PERSON:
            code |= _PERSON
        if _INNER.search(token):
            code |= _HIDDEN
        capitals = sum(map(str.isupper, token))
        letters = sum(map(str.isalpha, token))
        if capitals > 1 and capitals == letters:
            code |= _CAPITAL
        marks = sum(c in "!?" for c in token)
        signs = sum(not c.isalnum() for c in token)
        for place, count in enumerate((letters, capitals, marks, signs)):
            code |= min(count, _MOST) << (5 + _BITS * place)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(token) <= 64:
            self[token] = code
        return code


def features_of(text: str, words: _Words) -> list[float]:
    codes = np.array(list(map(words.__getitem__, text.split())), np.int64)
    n = max(1, len(codes))
    letters, capitals, marks, signs = (
        int((codes >> (5 + _BITS * place) & _MOST).sum()) for place in range(4)
    )
    hit = np.flatnonzero(codes & (_HIT | _LEET))
    person = np.flatnonzero(codes & _PERSON)
    peak, gap, near = 0, float(WINDOW), 0
    if len(hit):
        ahead = np.searchsorted(hit, hit + WINDOW) - np.arange(len(hit))
        peak = int(ahead.max())
        if len(person):
            at = np.searchsorted(person, hit)
            gaps = np.minimum(
                np.abs(person[np.minimum(at, len(person) - 1)] - hit),
                np.abs(hit - person[np.maximum(at - 1, 0)]),
            )
            gap, near = float(min(WINDOW, gaps.min())), int((gaps <= NEAR).sum())
    kinds = len(set(codes_of(text, hit))) if len(hit) else 0
    return [
        len(hit) / n, np.log1p(len(hit)), peak / WINDOW, np.log1p(kinds), len(person) / n, near / n,
        gap, capitals / max(1, letters), float((codes & _CAPITAL != 0).sum()) / n, marks / n,
        signs / max(1, letters + signs), float((codes & _HIDDEN != 0).sum()) / n,
        float((codes & _LEET != 0).sum()) / n, np.log1p(len(codes)),
    ]


def codes_of(text: str, at: np.ndarray) -> list[str]:
    """The words at some positions, lower-cased."""
    words = text.split()
    return [words[i].lower() for i in at]


def _featured(df: DataFrame, lexicon: frozenset[str], text: str, to: str) -> DataFrame:
    @F.pandas_udf("array<double>")
    def featured(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        working("toxicity")
        words = _Words(lexicon)
        for batch in column:
            yield pd.Series([features_of(x or "", words) for x in batch], dtype=object)

    return short_batches(df).withColumn(to, featured(F.col(text).cast("string")))


def _terms(rows: DataFrame) -> tuple[frozenset[str], frozenset[str], frozenset[str]]:
    """Lexicons of half 0, half 1 and both, from ``text, label, half``."""
    word = F.lower(F.col("text"))
    found = rows.select("label", "half", F.explode(F.array_distinct(
        F.regexp_extract_all(word, F.lit(r"\p{L}{2,24}"), 0)
    )).alias("word"))
    stems = [F.when(F.length("word") > n, F.concat(F.left("word", F.lit(n)), F.lit("*"))) for n in STEMS]
    found = found.select("label", "half", F.explode(F.array("word", *stems)).alias("term")).filter(
        "term is not null"
    )
    one, zero = F.col("label") == 1, F.col("label") == 0
    counts = found.groupBy("term").agg(
        *[F.count_if((F.col("half") == h) & kind).alias(f"{name}{h}")
          for h in (0, 1) for name, kind in (("bad", one), ("good", zero))]
    ).filter(F.col("bad0") + F.col("bad1") >= 3)
    sizes = {(r.half, r.label): r.n for r in
             rows.groupBy("half", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    lexicons = []
    for halves in ((0,), (1,), (0, 1)):
        bad, good = (sum((F.col(f"{k}{h}") for h in halves), F.lit(0)) for k in ("bad", "good"))
        n_bad, n_good = (sum(sizes.get((h, k), 0) for h in halves) for k in (1, 0))
        odds = F.log((bad + 0.3) / F.lit(n_bad + 0.6)) - F.log((good + 0.3) / F.lit(n_good + 0.6))
        best = counts.withColumns({"bad": bad, "odds": odds}).filter("bad >= 2 and odds > 2.5")
        best = best.orderBy(F.desc(F.col("odds") * F.log1p("bad")), "term").limit(TERMS)
        lexicons.append(INSULTS.union(r.term for r in best.select("term").collect()))
    return tuple(lexicons)


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "toxic", sample: int = SAMPLE,
) -> Model:
    """Learn from at most ``sample`` labelled rows of ``docs`` that are not held out."""
    half = F.pmod(F.xxhash64(F.lit("half"), "text"), F.lit(2)).cast("int")
    rows = cut_lineage(labelled(docs, labels, label, sample, key, text).withColumn("half", half))
    seen = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) < 2:
        forget(rows)
        return Model(frozenset(), None, None, float(max(seen, default=0)))
    first, second, every = _terms(rows)
    parts = [
        _featured(rows.filter(F.col("half") == h).select("text", "label"), lexicon, "text", "x")
        for h, lexicon in ((0, second), (1, first))
    ]
    fit = F.pmod(F.xxhash64(F.lit("fit"), "text"), F.lit(4)) > 0
    table = parts[0].union(parts[1]).select(
        array_to_vector("x").alias("x"), F.col("label").cast("double").alias("label"),
        fit.alias("fit"),
    )
    table = cut_lineage(table.coalesce(4))  # at most ``sample`` short rows
    fitted = table.filter("fit")
    if fitted.select("label").distinct().count() < 2:
        fitted = table
    trees = GBTClassifier(
        featuresCol="x", labelCol="label", predictionCol="_tree", maxIter=16, maxDepth=3, stepSize=0.25, maxBins=48, seed=7,
        minInstancesPerNode=2,
    ).fit(fitted).setProbabilityCol("_share").setRawPredictionCol("_raw")
    kept = trees.transform(table if fitted is table else table.filter("not fit"))
    if kept.select("label").distinct().count() < 2:
        kept = trees.transform(table)
    kept = kept.select("label", vector_to_array("_share")[1].alias("_share"))
    curve = IsotonicRegression(featuresCol="_share", labelCol="label", predictionCol="_score").fit(kept)
    forget(rows, table)
    return Model(every, trees, curve, seen[1] / sum(seen.values()))


def score(df: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """Add the score of every row; no row moves."""
    if model.trees is None:
        return df.withColumn(to, F.lit(model.prior))
    kept = [c for c in df.columns if c != to]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(text).alias("_text")
    )
    rows = _featured(rows, model.lexicon, "_text", "_list")
    rows = rows.select("_row", array_to_vector("_list").alias("x"))
    rows = model.trees.transform(rows).select("_row", vector_to_array("_share")[1].alias("_share"))
    scored = model.curve.transform(rows)
    value = (1 - ORDER) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_score"))) + ORDER * F.col("_share")
    return scored.select("_row.*", value.alias(to))
