from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from aerolake.llm import common, quality, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return common.read(spark, SF, "documents"), common.read(spark, SF, "labels")


@pytest.fixture(scope="module")
def toxic_model(tables):
    return toxicity.fit(*tables, sample_rows=2_000)


@pytest.fixture(scope="module")
def quality_model(tables):
    return quality.fit(*tables, sample_rows=1_000, pool_rows=500, rounds=1)


def test_toxicity_on_held_out_rows(tables, toxic_model):
    docs, labels = tables
    rows = (
        toxicity.with_score(docs.where(toxicity.fold_of(F.col("doc_id")) == 0), toxic_model)
        .join(labels, "doc_id")
        .select("toxic", "toxic_score")
        .collect()
    )
    caught = [r.toxic_score >= toxicity.THRESHOLD for r in rows if r.toxic]
    wrong = [r.toxic_score >= toxicity.THRESHOLD for r in rows if not r.toxic]
    assert all(0 <= r.toxic_score <= 1 for r in rows)
    assert sum(caught) / len(caught) > 0.9
    assert sum(wrong) / len(wrong) < 0.03


def test_only_the_text_counts(spark, tables, toxic_model):
    docs, _ = tables
    other = docs.limit(50).withColumns({"lang": F.lit("zz"), "source": F.lit(None), "doc_id": -F.col("doc_id")})
    first = toxicity.with_score(docs.limit(50), toxic_model).select("toxic_score").collect()
    assert first == toxicity.with_score(other, toxic_model).select("toxic_score").collect()


def test_quality_on_rows_not_fitted(tables, quality_model):
    docs, labels = tables
    chosen = labels.orderBy(common.in_order(F.col("doc_id")), "doc_id").limit(1_000).select("doc_id")
    rows = (
        quality.with_score(docs, quality_model)
        .join(labels.join(chosen, "doc_id", "left_anti"), "doc_id")
        .select("quality", "quality_score")
        .collect()
    )
    good = [r.quality_score >= quality.THRESHOLD for r in rows if r.quality]
    bad = [r.quality_score >= quality.THRESHOLD for r in rows if not r.quality]
    assert len(rows) > 2_000
    assert sum(good) / len(good) > 0.98
    assert sum(bad) / len(bad) < 0.1


def test_views_teach_each_other(tables):
    """With few labels, the rounds change both views."""
    alone = quality.fit(*tables, sample_rows=300, pool_rows=500, rounds=0)
    taught = quality.fit(*tables, sample_rows=300, pool_rows=500, rounds=1)
    for before, after in zip(alone.views, taught.views):
        assert before.name == after.name
    assert alone.views[1].model.coefficients != taught.views[1].model.coefficients


def test_odd_rows(odd_docs, no_docs, toxic_model, quality_model):
    for scored, name in (
        (toxicity.with_score(odd_docs, toxic_model), "toxic_score"),
        (quality.with_score(odd_docs, quality_model), "quality_score"),
    ):
        assert scored.columns == [*odd_docs.columns, name]
        rows = scored.collect()
        assert len(rows) == odd_docs.count()
        assert all(0 <= r[name] <= 1 for r in rows)
        assert len({r[name] for r in rows if r.doc_id == 1}) == 1
    assert toxicity.with_score(no_docs, toxic_model).count() == 0
    assert quality.with_score(no_docs, quality_model).count() == 0


def test_odd_labels(spark, odd_docs, no_docs):
    """No labels at all, or of one kind only, give the labels' share as every score."""
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([(None, 1, 1), (2, None, None), (3, 7, 7)], schema)
    one = spark.createDataFrame([(i, 1, 0) for i in range(8)], schema)
    for labels, shares in ((none, (1.0, 0.0)), (one, (1.0, 0.0))):
        for docs in (odd_docs, no_docs):
            model = quality.fit(docs, labels)
            assert model.views is None and model.prior == shares[0]
            model = toxicity.fit(docs, labels)
            assert model.trees is None and model.share == shares[1]
            assert toxicity.with_score(docs, model).count() == docs.count()


def test_spellings():
    assert toxicity.spellings("1d10t")[0] == "idiot"
    assert toxicity.spellings("i.d.i.o.t")[0] == "idiot"
    assert "idiot" in toxicity.spellings("you-idiot")


def test_nearness_to_the_second_person():
    reader = toxicity.Reader({"idiot.": 5.0})
    near, far = reader.read("You are an IDIOT!!"), reader.read("you " + "and so on " * 40 + "idiot")
    of = dict(zip(toxicity.FEATURES, near))
    assert of["near_hits"] > 0 and of["nearest"] > dict(zip(toxicity.FEATURES, far))["nearest"]
    assert reader.read("") == [0.0] * len(toxicity.FEATURES)


def plain_content(text):
    """The content features by plain loops over words and characters."""
    words = text.split()
    if not words:
        return [0.0] * quality.CONTENT
    n, chars = len(words), len(text)
    sentences, held = [], ""
    for c in text + "\n":
        if c in ".!?\n":
            sentences.append(held)
            held = ""
        elif held or not c.isspace() or not sentences:
            held += c
    sentences = [s for s in sentences if s]
    marks = [c for c in text if not (c.isalnum() or c == "_" or c.isspace() or c in ".,")]
    at, doubled = 0, 0
    while at + 1 < chars:
        c = text[at]
        if c == text[at + 1] and not (c.isalnum() or c == "_" or c.isspace()):
            doubled, at = doubled + 1, at + 2
        else:
            at += 1
    return [
        1.0,
        math.log1p(n) / 10,
        sum(words[i] == words[i + 1] for i in range(n - 1)) / n,
        max(words.count(w) for w in words) / n,
        1 - len(set(words)) / n,
        1 - len(set(sentences)) / max(1, len(sentences)),
        sum(len(w) > 1 and w.isupper() for w in words) / n,
        sum(not w[0].isalnum() and not w[-1].isalnum() for w in words) / n,
        len(marks) / chars,
        min(1.0, doubled / n),
        max((marks.count(c) for c in marks), default=0) / n,
        sum(c.isalpha() for c in text) / chars,
        sum(c.isdigit() for c in text) / chars,
        min(sum(map(len, words)) / n, 40) / 10,
        min(n / max(1, len(sentences)), 200) / 100,
    ]


def test_content_features_against_plain_loops():
    texts = ["", "One. Two! Two!  || a | b || 12 12", "ALL CAPS caps!!\n\n- a\n- a\n", "no sentence, only words words", "$$$ ##"]
    for text in texts:
        assert quality.read_content(text) == pytest.approx(plain_content(text)), text


def test_every_unlabelled_row_may_teach(spark):
    """Rows without a label and without an id are the pool; a label's row is not in it, names may clash."""
    schema = "doc_id long, text string, lang string, content string, places string, `row` string, features string"
    rows = [(i, f"plain words here {i}." if i % 2 else "$$ || $$ || ##", "en" if i % 2 else "xx", *"abcd") for i in range(80)]
    rows += [(None, "plain words here.", "en", *"abcd"), (None, "$$ || $$ ##", "xx", *"abcd")]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = quality.fit(docs, labels, rounds=1)
    scored = quality.with_score(docs, model, "score")
    assert scored.columns == [*docs.columns, "score"]
    assert all((r.score >= quality.THRESHOLD) == (r.lang == "en") and r.content == "a" for r in scored.collect())


def test_lexicon_against_plain_counts(spark):
    """Terms by the lower bound of their log-odds; the same share of a small language is as good."""
    texts = [(f"good text number {i} alpha", 0) for i in range(600)] + [(f"you moron {i}", 1) for i in range(20)]
    texts += [(f"du trottel {i}", 1) for i in range(8)] + [("rare", 1), ("rare x", 1)]
    made = toxicity.lexicon(spark.createDataFrame(texts, "text string, label int"))
    counts = {}
    for text, label in texts:
        for term in set().union(*map(toxicity.terms, toxicity.TOKEN.findall(text.lower()))):
            counts.setdefault(term, [0, 0])[label] += 1
    expected = {}
    for term, (clean, toxic) in counts.items():
        weight = math.log((toxic + 0.5) / 31) - math.log((clean + 0.5) / 601)
        error = math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
        if toxic >= toxicity.LEAST_TEXTS and weight - toxicity.SURE * error >= toxicity.LEAST_WEIGHT:
            expected[term] = pytest.approx(weight)
    assert made == expected and "moron." in made and "trottel." in made and "rare." not in made
