"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities of a fixed and of a learned lexicon, how near its
hits stand to words of the second person, capitals, punctuation and obfuscated
spellings.  They are computed where the text is; trees and calibration are Spark ML.

The learned lexicon holds words and beginnings of words (stems of inflected forms).
Labelled rows, a bounded number, are split by a hash into two halves: each half's
features use the lexicon learned from the other, so the trees never see hits that a row
brought in itself.  A quarter of the rows is left to the calibration alone.  Scoring
uses the lexicon of all of them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, saved

#: Labelled rows that are used at most.
TRAIN_ROWS = 24_000
#: Words and stems of the learned lexicon at most; documents and odds that each needs.
LEXICON_WORDS, LEXICON_DOCS, LEXICON_ODDS = 1000, 4, 8.0
#: Bytes of the beginnings of words that may become stems.
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.3
NEAR = 6

# Insults and abuse in the corpus's languages.
INSULTS = """
idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic disgusting clown fool imbecile
retard jerk bastard bitch shit fuck fucking asshole cunt whore slut pig swine vermin filth hate kill die
crétin imbécile salaud salope connard connasse pute merde ordure débile
idiota imbécil estúpido estúpida mierda puta cabrón gilipollas basura payaso
arschloch scheisse scheiße dumm dummkopf trottel vollidiot abschaum schwein hure wichser
""".split()
# Words of the second person.
SECOND_PERSON = "you your yours yourself u ur tu toi te vous votre tes ta usted ustedes vosotros ti du dich dir ihr euch euer dein deine".split()

FEATURES = ("log_words", "fixed", "fixed_hits", "learned", "learned_hits", "weight", "near_you", "you", "capitals", "capital_words", "marks", "punctuation", "obfuscated", "obfuscated_hits", "symbols", "word_length", "heaviest", "total_weight")

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: ASCII but letters, digits and the apostrophe becomes a blank.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 or b == 39 else 32 for b in range(256))
_PLAIN = bytes.maketrans(b"01345@$!7", b"oieasasit")
_HIDDEN = re.compile(rb"(?<![a-z])(?:[a-z][ .\-_]){3,}[a-z](?![a-z])|[a-z\x80-\xff]+[0-9@$!*#_.\-]+[a-z\x80-\xff][a-z0-9@$!*#\x80-\xff]*")
_TWICE = re.compile(rb"(.)\1+")


@dataclass
class Lexicon:
    """Insults, and learned units: whole words, and stems with an asterisk behind."""

    fixed: frozenset[bytes]
    learned: dict[bytes, float]

    def __post_init__(self):
        self.starts = frozenset(u[:4] for u in self.learned if len(u) >= 4)

    def weight(self, word: bytes) -> float:
        """The largest weight of the word's units, 0 if it has none."""
        if word[:4] not in self.starts and word not in self.learned:
            return 0.0
        get = self.learned.get
        return max(get(word, 0.0), *(get(word[:k] + b"*", 0.0) for k in STEMS if len(word) >= k), 0.0)


def features(text: bytes, lexicon: Lexicon) -> list[float]:
    words = text.translate(_WORD).split()
    n = max(1, len(words))
    fixed, learned = lexicon.fixed, lexicon.learned
    hits = [i for i, w in enumerate(words) if w in fixed]
    starts, weight = lexicon.starts, lexicon.weight
    weights = [x for w in words if (w[:4] in starts or w in learned) and (x := weight(w))]
    you = [i for i, w in enumerate(words) if w in _YOU]
    near = 0
    if hits and you:
        at = np.array(you)
        k = np.searchsorted(at, hits)
        left = np.abs(np.array(hits) - at[np.maximum(k - 1, 0)])
        right = np.abs(at[np.minimum(k, len(at) - 1)] - np.array(hits))
        near = int((np.minimum(left, right) <= NEAR).sum())
    hidden = _HIDDEN.findall(text.translate(_FOLD)) if len(words) else []
    plain = [_TWICE.sub(rb"\1", re.sub(rb"[^a-z\x80-\xff]", b"", h.translate(_PLAIN))) for h in hidden]
    found = sum(p in _SQUEEZED or p in learned for p in plain)
    raw = np.frombuffer(text, np.uint8)
    size = max(1, len(raw))
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    letters = max(1, upper + int(((raw >= 97) & (raw <= 122)).sum()))
    marks = text.count(b"!") + text.count(b"?")
    other = int(_PUNCTUATION[raw].sum())
    symbols = sum(text.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|"))
    shouted = sum(1 for w in text.split()[:] if len(w) > 2 and w.isupper()) if upper > 0.05 * letters else 0
    return [
        np.log1p(len(words)), 100 * len(hits) / n, np.log1p(len(hits)), 100 * len(weights) / n, np.log1p(len(weights)), 100 * sum(weights) / n,
        np.log1p(near), 100 * len(you) / n, upper / letters, shouted / n, 100 * marks / size, 100 * other / size,
        100 * len(hidden) / n, np.log1p(found), 100 * symbols / size, size / n, max(weights, default=0.0), np.log1p(sum(weights)),
    ]


_YOU = frozenset(w.encode() for w in SECOND_PERSON)
_FIXED = frozenset(w.encode() for w in INSULTS)
_SQUEEZED = frozenset(_TWICE.sub(rb"\1", w) for w in _FIXED) | _FIXED
_PUNCTUATION = np.isin(np.arange(256), list(b".,;:!?'\"()-"))


def feature_table(docs: DataFrame, lexicon: Lexicon, *, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` of every document and its features."""
    return map_texts(docs, text, [T.StructField("x", T.ArrayType(T.DoubleType()))], lambda texts: [[features(t, lexicon) for t in texts]], keep)


def units(text: bytes) -> list[str]:
    """Distinct words and stems of a text, each byte as one character."""
    words = set(text.translate(_WORD).split())
    return [u.decode("latin-1") for u in words | {w[:k] + b"*" for k in STEMS for w in words if len(w) >= k}]


def learn_lexicon(docs: DataFrame) -> dict[bytes, float]:
    """Units that stand in toxic documents far more often than in others; docs: text, label.

    Only units with enough documents and odds reach the driver, LEXICON_WORDS at most.
    """
    found = map_texts(docs, "text", [T.StructField("units", T.ArrayType(T.StringType()))], lambda texts: [[units(t) for t in texts]], ["label"])
    totals = docs.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    bad, good = float(totals[0] or 0), float(totals[1] or 0)
    counts = found.select("label", F.explode("units").alias("unit")).groupBy("unit").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    odds = ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("good") + 0.5) / (good + 1))
    best = counts.where(F.col("bad") >= LEXICON_DOCS).withColumn("odds", odds).where(F.col("odds") >= LEXICON_ODDS).orderBy(F.desc(F.col("bad") * F.log("odds")), "unit").limit(LEXICON_WORDS)
    return {r.unit.encode("latin-1"): float(np.log(r.odds)) for r in best.collect()}


@dataclass
class Model:
    lexicon: Lexicon
    trees: object
    calibration: object

    def score(self, docs: DataFrame, *, keep: list[str], text: str = "text") -> DataFrame:
        """Columns `keep` of every document, and score from 0 to 1.

        The calibrated probability is a step function; a thousandth of the trees' own
        probability orders documents inside a step.  Empty and null texts have the
        features of no words and get the score of those.
        """
        rows = feature_table(docs, self.lexicon, keep=keep, text=text)
        if self.trees is None:
            return rows.drop("x").withColumn("score", F.lit(0.0))
        scored = self.trees.transform(rows.withColumn("features", array_to_vector("x"))).withColumn("p", vector_to_array("probability")[1])
        scored = self.calibration.transform(scored.drop("features", "prediction", "rawPrediction", "probability").withColumn("one", array_to_vector(F.array("p")))).withColumn("score", 0.999 * F.col("prediction") + 0.001 * F.col("p"))
        return scored.select(*keep, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"))


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", usable: Column | None = None, max_rows: int = TRAIN_ROWS) -> Model:
    """Learn from at most max_rows labelled rows, chosen by a hash of their ids.

    labels holds (doc_id, label); rows with nulls are left out, and those for which
    `usable` is false.  The chosen ids are broadcast: max_rows of them at most.
    """
    chosen = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull())
    if usable is not None:
        chosen = chosen.where(usable)
    chosen = chosen.groupBy(F.col(f"`{doc_id}`").alias("id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("label"))
    h = F.xxhash64("id", F.lit(8))
    chosen = chosen.orderBy(h, "id").limit(max_rows).withColumn("half", F.pmod(h, F.lit(2))).withColumn("quarter", F.pmod(F.shiftright(h, 1), F.lit(4)))
    rows = docs.select(docs[f"`{doc_id}`"].alias("id"), docs[f"`{text}`"].alias("text")).join(F.broadcast(chosen), "id").select("id", "half", "quarter", "label", "text")
    rows = saved(rows, "labelled")
    crossed = [feature_table(rows.where(F.col("half") == k), Lexicon(_FIXED, learn_lexicon(rows.where(F.col("half") != k))), keep=["id", "quarter", "label"]) for k in (0, 1)]
    lexicon = Lexicon(_FIXED, learn_lexicon(rows))
    table = saved(crossed[0].unionByName(crossed[1]).withColumn("features", array_to_vector("x")).drop("x"), "toxicity-features")
    fit, rest = table.where("quarter < 3").coalesce(2), table.where("quarter = 3").coalesce(2)
    if fit.select("label").distinct().count() < 2 or rest.limit(1).count() == 0:
        return Model(lexicon, None, None)
    trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=25, maxDepth=4, stepSize=0.2, subsamplingRate=0.8, maxBins=48, minInstancesPerNode=5, seed=7).fit(fit)
    guessed = trees.transform(rest).select(F.col("label").cast("double").alias("label"), vector_to_array("probability")[1].alias("p"))
    calibration = IsotonicRegression(labelCol="label", featuresCol="one", predictionCol="prediction").fit(guessed.withColumn("one", array_to_vector(F.array("p"))))
    return Model(lexicon, trees, calibration)
