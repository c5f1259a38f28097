"""Toxicity: gradient-boosted trees over dense features of the whole text, with isotonic calibration.

The lexicon is learned from labelled training texts: every word and word beginning that stands in far more
toxic than other texts, by the lower bound of its log-odds, whatever the sample's size; only ``LEXICON_BYTES``
bound it, as it goes to every task. Features are lexicon densities, nearness of lexicon hits to second-person words,
rates of capitals and punctuation, and rates of obfuscated spellings. Trees are fitted on a bounded
sample of labelled rows (``sample_rows``), the calibration on a part of it that the trees do not see.

Only the text is an input of a score. Null and empty texts have all-zero features and are scored like
any other. Labels that are null or not 0 or 1 are not used. Repeated rows are scored alike; further
columns pass through ``with_score`` untouched. An empty table gives no rows; with no labels of either
kind to learn from, every score is the share of toxic labels (0 where there are none).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm import common

# Bound of the labelled rows that the lexicon, trees and calibration are fitted on.
SAMPLE_ROWS = 20_000
FOLDS = 5
CALIBRATION_FOLD = 4
# Bound of the lexicon in bytes; the strongest terms stay.
LEXICON_BYTES = 8 << 20
TERM_BYTES = 64  # what a term takes beside its own text
LEAST_TEXTS = 3
# A term's log-odds less SURE standard errors must reach LEAST_WEIGHT.
LEAST_WEIGHT = 1.0
SURE = 1.96
BEGINNINGS = range(3, 8)
NEAR_WORDS = 6
# A document is toxic from this score on.
THRESHOLD = 0.5
TREES = 20
DEPTH = 4
# Words whose weight a worker remembers.
REMEMBERED = 300_000

# Fixed: second-person words of the languages at hand.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "sie ihnen usted ustedes ti tus tuyo vosotros vuestro".split()
)
# Fixed: characters that stand for letters in obfuscated spellings.
STANDS_FOR = str.maketrans("013457@$!|+", "oieastasiit")

TOKEN = re.compile(r"\w+(?:[@$!|+*.\-]+\w+)*")
LETTERS = re.compile(r"[^\W\d_]+")
STRETCHED = re.compile(r"(\w)\1\1")
FEATURES = (
    "words", "hits", "density", "weight", "strongest", "kinds", "second_person", "near_hits", "nearest",
    "capitals", "shouted", "exclamations", "questions", "punctuation", "obfuscated", "obfuscated_hits", "stretched",
)


def spellings(token: str) -> tuple[str, ...]:
    """The plain words that a lower-cased token may stand for."""
    if token.isalpha():
        return (token,)
    folded = "".join(c for c in token.translate(STANDS_FOR) if c.isalpha())
    return (folded, *LETTERS.findall(token))


def terms(token: str) -> set[str]:
    """Whole words (marked by a full stop) and word beginnings."""
    return {t for w in spellings(token) if w for t in (w + ".", *(w[:n] for n in BEGINNINGS if len(w) >= n))}


# --- lexicon ---------------------------------------------------------------------------------


def lexicon(texts: DataFrame, most: int = LEXICON_BYTES) -> dict[str, float]:
    """Terms of (text, label) rows with their log-odds, strongest first; at most ``most`` bytes reach the driver."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            names = list(found[0].keys() | found[1].keys())
            made = pa.RecordBatch.from_pydict(
                {
                    "term": pa.array(names, pa.string()),
                    "clean": pa.array([found[0][n] for n in names], pa.int64()),
                    "toxic": pa.array([found[1][n] for n in names], pa.int64()),
                }
            )
            found[0].clear()
            found[1].clear()
            return made

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[label].update(set().union(*map(terms, set(TOKEN.findall(text.lower())))))
                found[label].update([""])  # counts the texts
                if len(found[0]) + len(found[1]) > REMEMBERED:
                    yield flush()
        yield flush()

    counted = (
        texts.distinct()
        .mapInArrow(count, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    counted = common.keep(counted.where(f"toxic >= {LEAST_TEXTS} or term = ''"))
    of = counted.where("term = ''").first()
    if of is None or not of["toxic"] or not of["clean"]:
        return {}
    weight = F.log((F.col("toxic") + 0.5) / (of["toxic"] + 1.0)) - F.log((F.col("clean") + 0.5) / (of["clean"] + 1.0))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    found = (
        counted.where("term <> ''")
        .withColumn("weight", weight)
        .where(F.col("weight") - SURE * error >= LEAST_WEIGHT)
        .select("term", "weight", (F.col("toxic") * F.col("weight")).alias("gain"))
    )
    # No term is shorter than nothing, so this many are enough; the bytes are then counted exactly.
    first = found.orderBy(F.desc("gain"), F.length("term"), "term").limit(most // TERM_BYTES)
    chosen, left = {}, most
    for row in first.toLocalIterator():
        left -= TERM_BYTES + len(row["term"].encode())
        if left < 0:
            break
        chosen[row["term"]] = row["weight"]
    return chosen


# --- features --------------------------------------------------------------------------------


class Reader:
    """Dense features of texts against a lexicon; remembers the weight of words it has met."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.known: dict[str, float] = {}

    def _weight(self, token: str) -> float:
        return max((self.weights.get(t, 0.0) for t in terms(token)), default=0.0)

    def read(self, text: str) -> list[float]:
        tokens = TOKEN.findall(text)
        if not tokens:
            return [0.0] * len(FEATURES)
        n, chars = len(tokens), len(text)
        lower = TOKEN.findall(text.lower())
        kinds = set(lower)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in kinds:
            if w not in known:
                known[w] = self._weight(w)
        bad = {w for w in kinds if known[w]}
        at = [i for i, w in enumerate(lower) if w in bad] if bad else []
        persons = kinds & SECOND_PERSON
        person_at = np.array([i for i, w in enumerate(lower) if w in persons], np.int64) if persons else np.empty(0, np.int64)
        gap = NEAR_WORDS * 10
        near = 0
        if at and len(person_at):
            spot = np.searchsorted(person_at, at)
            left = np.abs(np.array(at) - person_at[np.maximum(spot - 1, 0)])
            right = np.abs(np.array(at) - person_at[np.minimum(spot, len(person_at) - 1)])
            gaps = np.minimum(left, right)
            gap, near = min(gap, int(gaps.min())), int((gaps <= NEAR_WORDS).sum())
        odd = [w for w in kinds if not w.isalpha() and not w.isdigit() and len(w) < 30]
        weight = sum(known[lower[i]] for i in at)
        upper = len(re.findall("[A-ZÀ-ÖØ-Þ]", text))
        marks = chars - len(re.findall(r"[\w\s]", text))
        return [
            math.log1p(n),
            math.log1p(len(at)),
            100.0 * len(at) / n,
            math.log1p(weight),
            max((known[w] for w in bad), default=0.0),
            float(len(bad)),
            100.0 * len(person_at) / n,
            math.log1p(near),
            1.0 / (1.0 + gap),
            upper / chars,
            sum(w.isupper() and len(w) > 1 for w in tokens) / n,
            100.0 * text.count("!") / chars,
            100.0 * text.count("?") / chars,
            marks / chars,
            100.0 * len(odd) / n,
            float(sum(1 for w in odd if w in bad)),
            100.0 * sum(1 for w in kinds if STRETCHED.search(w)) / n,
        ]


def features(weights: dict[str, float], text: Column) -> Column:
    """The features of a text column, as an array of doubles."""
    return common.per_text(lambda: Reader(weights).read, text)


# --- model -----------------------------------------------------------------------------------


@dataclass
class Model:
    weights: dict[str, float]
    share: float
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a row without an id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on labelled rows outside fold 0, at most ``sample_rows`` of them, the same ones on every run."""
    doc_id = F.col("doc_id")
    marked = (
        labels.select(doc_id.cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
        .where(doc_id.isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .where(fold_of(doc_id) != 0)
    )
    marked = common.first_in_order(marked, doc_id, sample_rows)
    texts = docs.select(doc_id.cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    # A doc_id that stands on many rows counts once, by its least text, so the sample stays bounded.
    single = texts.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    sample = common.keep(single.withColumn("fold", fold_of(doc_id)).select("text", "label", "fold"))
    learning = sample.where(F.col("fold") != CALIBRATION_FOLD)
    counts = {r["label"]: r["count"] for r in learning.groupBy("label").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if len(counts) < 2:
        return Model({}, share, None, None)
    weights = lexicon(learning.select("text", "label"))
    rows = common.keep(
        sample.select(
            array_to_vector(features(weights, F.col("text"))).alias("features"), F.col("label").cast("double"), "fold"
        )
    ).coalesce(2)  # two small tasks for each of the many short passes
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, minInstancesPerNode=3).fit(
        rows.where(F.col("fold") != CALIBRATION_FOLD)
    )
    rest = _raw(trees, rows.where(F.col("fold") == CALIBRATION_FOLD))
    if rest.select("label").distinct().count() < 2:
        return Model(weights, share, trees, None)
    steps = IsotonicRegression(featuresCol="raw_score", predictionCol="score").fit(rest)
    return Model(weights, share, trees, steps)


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    scored = trees.transform(rows).withColumn("raw_score", vector_to_array("probability")[1])
    return scored.drop("rawPrediction", "probability", "prediction", "features")


def with_score(docs: DataFrame, model: Model, name: str = "toxic_score") -> DataFrame:
    """The rows with their calibrated probability of being toxic."""
    if model.trees is None:
        return docs.withColumn(name, F.lit(model.share))
    # The caller's columns travel as one field, so that no name of the trees clashes with them.
    text = features(model.weights, F.col("text"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), array_to_vector(text).alias("features"))
    rows = _raw(model.trees, rows)
    if model.steps is None:
        return rows.select("row.*", F.col("raw_score").alias(name))
    steps = model.steps.copy().setFeaturesCol("raw_score").setPredictionCol("score")
    return steps.transform(rows).select("row.*", F.col("score").alias(name))
