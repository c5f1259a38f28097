"""The corpus queries by name, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import (
    bpe,
    common,
    hamming,
    jaccard,
    licenses,
    negatives,
    onebit,
    packing,
    quality,
    ranked,
    simhash,
    statements,
    toxicity,
    urls,
    warc,
)

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
STATEMENTS: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url by rule or by its host's place in the link graph; trust and distrust in 10^-12."""
    judged = urls.judge(common.read(spark, sf_dir, "pages"))
    unit = F.lit(Decimal(urls.UNIT // 10**12))
    return judged.withColumns({c: urls.whole_part(F.col(c), unit).cast("long") for c in ("trust", "distrust")})


@query
def op2_onebit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found vectors of every fiftieth one."""
    vectors = common.read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return onebit.search(vectors, F.col("vec_id") % 50 == 0, k=5)


@query
def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document and whether it stays."""
    docs = common.read(spark, sf_dir, "documents")
    rows = common.keep(quality.views(docs, ["doc_id"]))
    model = quality.fit_views(rows, common.read(spark, sf_dir, "labels"))
    scored = quality.score_views(rows, model, "score")
    return scored.select("doc_id", "score", (F.col("score") >= quality.THRESHOLD).alias("kept"))


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, and the digest of what they decode to."""
    docs = common.read(spark, sf_dir, "documents")
    return bpe.encode(docs, BYTE_VOCABULARY, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records against a replica in which every url's MD5 plants the damage: a character
    changed, the record lost, or its second half. Returns every differing node down to the records."""
    key = F.col("page_id").cast("long")
    whole, kind = F.col("whole"), F.col("kind")
    planted = F.substring(F.md5(F.coalesce("url", F.lit("")).cast("binary")), 1, 2)
    half = F.expr("char_length(whole) div 2")
    changed = F.concat(F.substr(whole, F.lit(1), half), F.lit("#"), F.substr(whole, half + 2))
    other = (
        F.when(kind == "01", None)
        .when(kind == "02", F.substr(whole, F.lit(1), half))
        .when(kind == "00", changed)
        .otherwise(whole)
    )
    pages = common.read(spark, sf_dir, "pages")
    content = warc.record(key, F.col("url"), F.col("html"))
    records = pages.select(key.alias("page_id"), content.alias("whole"), planted.alias("kind"))
    rows = records.select(
        "page_id",
        warc.digest(whole).alias("digest"),
        (F.octet_length(whole) + len(warc.END)).cast("long").alias("length"),
        warc.digest(other).alias("digest_b"),
        (F.octet_length(other) + len(warc.END)).cast("long").alias("length_b"),
    )
    # Equal records lie one after the other and are one leaf.
    leaves = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    placed = common.keep(warc.positions(leaves, ["page_id", "digest"]))
    sides = F.explode(
        F.array(
            F.struct(F.lit("a").alias("replica"), F.col("digest"), (F.col("length") * F.col("copies")).alias("length")),
            F.struct(
                F.lit("b").alias("replica"),
                F.col("digest_b").alias("digest"),
                (F.col("length_b") * F.col("copies")).alias("length"),
            ),
        )
    )
    both = placed.select("position", sides.alias("x")).select("position", "x.*").where("digest is not null")
    found = warc.audit(warc.trees(both), "a", "b")
    keys = placed.select("page_id", F.col("position").alias("first_position"), F.lit(0).alias("level"))
    return found.join(keys, ["level", "first_position"], "left")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fold 0 is held out of all fitting."""
    docs = common.read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, common.read(spark, sf_dir, "labels"))
    scored = toxicity.with_score(docs.select("doc_id", "text"), model, "score")
    held_out = toxicity.fold_of(F.col("doc_id")) == 0
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query
def op7_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every hundredth one."""
    vectors = common.read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return hamming.search(vectors, F.col("vec_id") % 100 == 0, k=10)


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document and their places in packed sequences."""
    return packing.pack_documents(common.read(spark, sf_dir, "documents"), WORD_VOCABULARY)


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(common.read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("code")).alias("fingerprint"), "component_id")


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every document."""
    found = licenses.scan(common.read(spark, sf_dir, "documents"))
    joined = {c: F.array_join(c, ",") for c in ("identifiers", "licences", "leftovers")}
    return found.withColumns(joined).select("doc_id", "identifiers", "licences", "leftovers", "matches")


@query
def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranked.search(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))


@query
def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set and its component of near-equal sets."""
    return jaccard.near_sets(common.read(spark, sf_dir, "documents"))


@query
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh row carries the next label."""
    vectors = common.read(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("embedding").alias("vector"),
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
    )
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0)


STATEMENTS["op1_urls"] = statements.url_sql()
STATEMENTS["op2_onebit"] = statements.ONEBIT
STATEMENTS["op5_merkle"] = statements.merkle_sql()
STATEMENTS["op7_hamming"] = statements.HAMMING
STATEMENTS["op10_licenses"] = statements.license_sql()
STATEMENTS["op11_ranked"] = statements.RANKED
STATEMENTS["op12_jaccard"] = statements.JACCARD
STATEMENTS["op13_negatives"] = statements.NEGATIVES
