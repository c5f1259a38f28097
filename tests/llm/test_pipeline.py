from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aerolake.llm import common, packing, simhash
from tests.llm.test_packing import hold, library  # noqa: F401
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's rows, written and read again as the driver does."""
    folder = tmp_path_factory.mktemp("stages")
    docs, made = common.read(spark, SF, "documents"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(folder / str(number)))
        docs = spark.read.parquet(str(folder / str(number)))
        made.append(docs)
    return made


def test_filters_keep_columns_and_rows_whole(spark, stages):
    before = common.read(spark, SF, "documents")
    for after in stages[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString()
        assert after.exceptAll(before).count() == 0
        assert 0 < after.count() < before.count()
        before = after


def test_labelled_documents(spark, stages):
    labels = common.read(spark, SF, "labels")
    bad = stages[0].join(labels.where("quality = 0"), "doc_id", "left_semi").count()
    assert bad <= 0.1 * labels.where("quality = 0").count()
    good = stages[0].join(labels.where("quality = 1"), "doc_id", "left_semi").count()
    assert good >= 0.97 * labels.where("quality = 1").count()
    toxic = stages[1].join(labels.where("toxic = 1"), "doc_id", "left_semi").count()
    assert toxic <= 0.35 * stages[0].join(labels.where("toxic = 1"), "doc_id", "left_semi").count()


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in stages[1].collect()]
    heads = set(plain_components(rows, simhash.RADIUS))
    assert {r.doc_id for r in stages[2].collect()} == heads


def test_packing_of_what_is_left(stages, library):  # noqa: F811
    texts = {r.doc_id: r.text for r in stages[2].collect()}
    assert hold(stages[3].collect(), texts, library) > 0.95


def test_run(spark, stages):
    made = corpus_pipeline.run(spark, SF)
    assert made.exceptAll(stages[3].select(made.columns)).count() == 0
    assert made.count() == stages[3].count()


def test_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() <= docs.count() * 100
    packed = packing.pack_documents(odd_docs.where(F.col("doc_id") == 3), corpus_pipeline.WORD_VOCABULARY).collect()
    assert [r.doc_tokens for r in packed] == [1]
