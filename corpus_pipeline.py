"""A corpus pipeline over ``documents``: quality, toxicity, near-duplicates, packing.

Every stage takes all rows that the one before kept, written as Parquet and read again. All but the last
return the columns of ``documents``. Null texts count as empty in every stage; see the operators for the
other odd rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import common, packing, quality, simhash, toxicity
from aerolake.llm.register import WORD_VOCABULARY


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier does not reject."""
    rows = common.keep(quality.views(docs))
    model = quality.fit_views(rows, common.read(spark, sf_dir, "labels"))
    name = common.unused(docs.columns, "quality")
    return quality.score_views(rows, model, name).where(F.col(name) >= quality.THRESHOLD).drop(name)


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    model = toxicity.fit(docs, common.read(spark, sf_dir, "labels"))
    name = common.unused(docs.columns, "toxic")
    return toxicity.with_score(docs, model, name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def single_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest id."""
    return simhash.keep_one(docs, simhash.near_duplicates(docs))


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs, WORD_VOCABULARY)


STAGES = [
    ("quality classifier", good_documents),
    ("toxicity", civil_documents),
    ("near duplicates", single_documents),
    ("packing", packed_documents),
]

# Fitted models, XXH64 fingerprints and token ids are beyond SQL; tests hold the stages to plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(filters):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return last(spark, docs, sf_dir)
