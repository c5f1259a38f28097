"""Quality by co-training: a text-content view and a page-metadata view teach each other.

Each view is a logistic regression of its own: the content view reads the text, the metadata view reads
lang, source and length. Both start from labelled rows. In every round each view scores a pool of rows
without labels, and what it is confident of becomes pseudo-labelled training rows of the *other* view.
At the end each view is calibrated on labelled rows that it was not fitted on, and the calibrated
log-odds are added, less the prior that both hold. Confidence is judged on calibrated scores, so a view
that knows little teaches little.

Labels come from a bounded sample (``sample_rows``); every row without a label can teach, in every round,
and every document is scored. Texts are read once: ``views`` stores both views' features, and fitting and
scoring use those. What the content view is sure of reaches the metadata view as counts by (lang, source,
length), at most ``LANG_BUCKETS * SOURCE_BUCKETS * BANDS`` of them. So that a large corpus does not drown the
labels, the taught rows of a view weigh no more together than its labelled ones.

Null texts count as empty, null metadata is a value of its own; an empty text has all-zero content features.
Rows without doc_id have no label. Repeated rows are scored alike, further columns pass through under any
name. Without labels of both kinds every score is the share of good labels (1 where there are none).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm import common

SAMPLE_ROWS = 20_000
ROUNDS = 3
CONFIDENT = 0.95
# Every so many labelled rows one is kept for calibration.
CALIBRATION_PART = 4
LANG_BUCKETS = 16
SOURCE_BUCKETS = 32
BANDS = 24
PASSES = 12
LINE_PASSES = 8
# Rows of features that a task of a pass reads, about 10 MB, and how many tasks there may be in any case.
TASK_ROWS = 50_000
LEAST_TASKS = 8
# Good means at least this probability.
THRESHOLD = 0.5

VIEWS = ("content", "places")
METADATA = ("lang", "source", "n_chars")
SENTENCE = re.compile(r"[.!?\n]+\s*")
CONTENT = 15


def read_content(text: str) -> list[float]:
    """Dense content features: repetition, symbols, capitals, tables, word and sentence shape."""
    words = text.split()
    if not words:
        return [0.0] * CONTENT
    n, chars = len(words), len(text)
    counts = Counter(words)
    sentences = [s for s in SENTENCE.split(text) if s]
    bare = sum(1 for w in words if not w[:1].isalnum() and not w[-1:].isalnum())
    upper = sum(w.isupper() and len(w) > 1 for w in words)
    marks = Counter(re.findall(r"[^\w\s.,]", text))
    letters = len(re.findall(r"[^\W\d_]", text))
    digits = len(re.findall(r"\d", text))
    doubled = len(re.findall(r"([^\w\s])\1", text))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    lengths = np.fromiter(map(len, words), np.float64, n)
    return [
        1.0,
        float(np.log1p(n)) / 10,
        repeats / n,
        counts.most_common(1)[0][1] / n,
        1.0 - len(counts) / n,
        1.0 - len(set(sentences)) / max(1, len(sentences)),
        upper / n,
        bare / n,
        sum(marks.values()) / chars,
        min(1.0, doubled / n),
        max(marks.values(), default=0) / n,
        letters / chars,
        digits / chars,
        min(float(lengths.mean()), 40.0) / 10,
        min(n / max(1, len(sentences)), 200.0) / 100,
    ]


def content(text: Column) -> Column:
    return common.per_text(lambda: read_content, text)


def places(docs: DataFrame) -> Column:
    """Hashed lang and source and a band of the length, as three places of one vector; a missing column or
    value is a value of its own."""

    def value(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in docs.columns else F.lit("")

    size = F.coalesce(F.col("n_chars").cast("long"), F.lit(0)) if "n_chars" in docs.columns else F.lit(0)
    band = F.least(F.floor(F.log2(F.greatest(size, F.lit(0)) + 1)), F.lit(BANDS - 1))
    return F.array(
        F.pmod(F.xxhash64(value("lang")), F.lit(LANG_BUCKETS)).cast("int"),
        (F.pmod(F.xxhash64(value("source")), F.lit(SOURCE_BUCKETS)) + LANG_BUCKETS).cast("int"),
        (band + LANG_BUCKETS + SOURCE_BUCKETS).cast("int"),
    )


def views(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(row, doc_id, content, places): the named columns of every row (all unless named) as one field, so that
    no name clashes, and both views' features."""
    row = F.struct(*(docs.columns if columns is None else columns) or [F.lit(0)])
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        row.alias("row"), doc_id.alias("doc_id"), content(F.col("text")).alias("content"), places(docs).alias("places")
    )


# --- views -----------------------------------------------------------------------------------


@dataclass
class View:
    """A regression on one view and the line that calibrates its log-odds."""

    name: str
    model: LogisticRegressionModel
    slope: float = 1.0
    shift: float = 0.0

    def log_odds(self) -> Column:
        """From the view's feature column; linear, so it stays one expression."""
        return F.lit(self.slope) * self._sum() + F.lit(self.shift)

    def chance(self) -> Column:
        return 1.0 / (1.0 + F.exp(-self.log_odds()))

    def _sum(self) -> Column:
        held, total = F.col(self.name), F.lit(float(self.model.intercept))
        weights = [float(w) for w in self.model.coefficients]
        if self.name == "content":
            return sum((F.get(held, F.lit(i)) * F.lit(w) for i, w in enumerate(weights)), total)
        listed = F.array(*map(F.lit, weights))
        return sum((F.get(listed, F.get(held, F.lit(i))) for i in range(3)), total)


def _vector(name: str) -> Column:
    if name == "content":
        return array_to_vector(name)
    width = LANG_BUCKETS + SOURCE_BUCKETS + BANDS
    return array_to_vector(F.array(*[F.array_contains(name, i).cast("double") for i in range(width)]))


def _fit(rows: DataFrame, features: Column, passes: int = PASSES) -> LogisticRegressionModel:
    regression = LogisticRegression(featuresCol="x", labelCol="label", maxIter=passes, regParam=1e-3, weightCol="weight")
    return regression.fit(rows.select(features.alias("x"), "label", "weight"))


def _calibrated(view: View, held: DataFrame) -> View:
    """A line through the log-odds, fitted on labelled rows that the view has not seen."""
    line = _fit(held, array_to_vector(F.array(view.log_odds())), LINE_PASSES)
    return View(view.name, view.model, float(line.coefficients[0]), float(line.intercept))


@dataclass
class Model:
    views: tuple[View, View] | None
    prior: float


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    pool_rows: int | None = None,
    rounds: int = ROUNDS,
    confident: float = CONFIDENT,
) -> Model:
    """``fit_views`` on the views of ``docs``."""
    return fit_views(common.keep(views(docs, [])), labels, sample_rows, pool_rows, rounds, confident)


def fit_views(
    rows: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    pool_rows: int | None = None,
    rounds: int = ROUNDS,
    confident: float = CONFIDENT,
) -> Model:
    """Fit on stored ``views`` and (doc_id, quality). All rows without a label teach, unless a caller bounds them
    by ``pool_rows``. A doc_id with several labels has the least; one that stands on many rows is one labelled
    row, the least of them."""
    doc_id = F.col("doc_id")
    marked = (
        labels.select(doc_id.cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
        .where(doc_id.isNotNull() & F.col("label").isin(0.0, 1.0))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    rows = rows.select("doc_id", *VIEWS)
    # The sample is bounded, so its ids go to every task and the features stay where they are.
    chosen = F.broadcast(common.first_in_order(marked, doc_id, sample_rows))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION_PART)).alias("part")
    single = rows.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(*VIEWS)).alias("x"))
    known = single.select("label", F.lit(1.0).alias("weight"), part, "x.*")
    known = common.keep(known).coalesce(2)  # two small tasks for each of the many short passes
    by_part = known.groupBy("label", (F.col("part") == 0).alias("held")).count().collect()
    counts = {(r["label"], r["held"]): r["count"] for r in by_part}
    good, bad = (sum(n for (label, _), n in counts.items() if label == x) for x in (1.0, 0.0))
    if not all(counts.get((x, False)) for x in (0.0, 1.0)):
        return Model(None, good / (good + bad) if good + bad else 1.0)
    prior = float(np.log(good / bad))
    seen, held = known.where("part <> 0"), known.where("part = 0")
    if not all(counts.get((x, True)) for x in (0.0, 1.0)):
        held = seen
    weighed = sum(n for (_, kept_back), n in counts.items() if not kept_back)

    pool = rows.join(marked, "doc_id", "left_anti")
    if pool_rows is not None:
        pool = common.first_in_order(pool.where(doc_id.isNotNull()), doc_id, pool_rows)
    if rounds:
        pool = common.keep(pool.select(*VIEWS))
        pool = pool.coalesce(max(LEAST_TASKS, pool.count() // TASK_ROWS))

    taught: dict[str, DataFrame | None] = {name: None for name in VIEWS}
    for turn in range(rounds + 1):
        now = {}
        for name in VIEWS:
            known_rows, more = seen.select(name, "label", "weight"), taught[name]
            fitted = _fit(known_rows if more is None else known_rows.unionByName(more), _vector(name))
            now[name] = _calibrated(View(name, fitted), held)
        if turn == rounds:
            break
        for teacher, learner in zip(VIEWS, reversed(VIEWS)):
            taught[learner] = _lesson(pool, now[teacher].chance(), learner, confident, weighed)
    return Model((now[VIEWS[0]], now[VIEWS[1]]), prior)


def _lesson(pool: DataFrame, chance: Column, learner: str, confident: float, most: int) -> DataFrame | None:
    """The rows that a teacher is sure of, labelled, as the learner sees them; together they weigh ``most`` at most."""
    sure = pool.where((chance >= confident) | (chance <= 1 - confident))
    sure = sure.select(learner, (chance >= 0.5).cast("double").alias("label"))
    if learner == "places":
        # Bounded once it is grouped, so the passes over it are one small task each.
        sure = common.keep(sure.groupBy(learner, "label").agg(F.count("*").cast("double").alias("n"))).coalesce(1)
        total = sure.agg(F.sum("n")).first()[0] or 0
    else:
        sure = sure.withColumn("n", F.lit(1.0))
        total = sure.count()
    if not total:
        return None
    return sure.select(learner, "label", (F.col("n") * min(1.0, most / total)).alias("weight"))


def score_views(rows: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """The rows below ``views`` with the combined, calibrated probability of being good."""
    if model.views is None:
        return rows.select("row.*", F.lit(model.prior).alias(name))
    first, second = model.views
    total = first.log_odds() + second.log_odds() - F.lit(model.prior)
    return rows.select("row.*", (1.0 / (1.0 + F.exp(-total))).alias(name))


def with_score(docs: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """``score_views`` on the views of ``docs``."""
    return score_views(views(docs), model, name)
