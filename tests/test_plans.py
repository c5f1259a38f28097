"""Shape of the physical plans, and results that must not depend on it."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from aerolake.operators import lookups, quality
from aerolake.plans import consumption, gold
from aerolake.plans.register import QUERIES
from aerolake.session import broadcastable
from aerolake.sources import views
from tests import compare
from tests.conftest import DATA

SHUFFLE_FREE = (
    "bronze_vra",
    "ingest_delimited",
    "ingest_quote_off",
    "silver_legs",
    "union_registries",
    "obt_legs",
    "decode_codes",
    "plausible_range",
)


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **changed):
    keys = {k.replace("__", "."): v for k, v in changed.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_stays_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("Python", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


@pytest.mark.parametrize("name", SHUFFLE_FREE)
def test_row_by_row_queries_do_not_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"(?<!Broadcast)Exchange", text)


def test_fact_broadcasts_its_lookups(spark, sf_dir):
    text = plan(QUERIES["fact_legs"](spark, sf_dir))
    assert text.count("BroadcastHashJoin") == 3
    assert "hashpartitioning" not in text


@pytest.mark.parametrize("name", ["fact_legs", "obt_enriched", "airport_roles"])
def test_small_registries_leave_the_legs_where_they_are(spark, name):
    """The plan that ran, not the first one: no exchange of the legs at the bench's size."""
    result = QUERIES[name](spark, str(DATA / "sf0.1"))
    result.write.format("noop").mode("overwrite").save()
    result.count()
    ran = plan(result)
    assert not re.search(r"(?<!Broadcast)Exchange", ran)
    assert "SortMergeJoin" not in ran


def test_size_decides_on_a_broadcast(spark, sf_dir):
    registry = views.silver_aerodromos(spark, sf_dir)
    assert broadcastable(registry) and broadcastable(views.silver_codigos(spark, sf_dir))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1k"):
        assert not broadcastable(registry)
        assert broadcastable(views.silver_codigos(spark, sf_dir))
        assert "BroadcastHashJoin" not in plan(gold.role_play_registry(views.silver_vra(spark, sf_dir), registry))


def test_only_named_columns_are_read(spark, sf_dir):
    text = plan(QUERIES["status_profile"](spark, sf_dir))
    assert "props" not in text and "user_id" not in text
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>", text)


@pytest.mark.parametrize("name", ["delay_by_hour", "monthly_summary", "weekday_pattern", "route_ranking"])
def test_questions_aggregate_before_the_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "partial_count" in text and "Join" not in text


def test_airline_names_join_after_the_grouping(spark, sf_dir):
    text = plan(QUERIES["cancellation_rate"](spark, sf_dir))
    assert text.index("Join") < text.index("partial_count")


def test_ranking_is_a_top_k(spark, sf_dir):
    for name in ("route_ranking", "topk_earliest"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf_dir))


def test_stored_legs_push_filters_to_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "silver")
    views.silver_vra(spark, sf_dir).write.partitionBy("partida_prevista_data").parquet(path)
    stored = spark.read.parquet(path)
    regained = plan(gold.obt_legs(stored).where("minutos_recuperados > 0"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(minutos_recuperados,0\)", regained)
    ruled = gold.leg_rules(stored)
    start = stored.agg(F.min("partida_prevista_data")).first()[0]
    daily = plan(consumption.daily_series(ruled, start, start))
    assert re.search(r"PartitionFilters: \[[^\]]*partida_prevista_data", daily)


# --- skew ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def hot_legs(spark, sf_dir, tmp_path_factory):
    """Legs of which one airline and one route hold about nine tenths."""
    path = str(tmp_path_factory.mktemp("hot") / "legs")
    legs = views.silver_vra(spark, sf_dir)
    copies = legs.withColumn(
        "copia", F.explode(F.when(F.col("icao_empresa") == "7", F.sequence(F.lit(0), F.lit(999))).otherwise(F.array(F.lit(0))))
    )
    spread = copies.withColumn("event_id", F.col("event_id") * 1000 + F.col("copia")).drop("copia")
    spread.repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def checksum(df):
    rows = df.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")
    )
    return tuple(rows.first())


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}
SMALL_SKEW = {
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "256k",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "512k",
}
TINY_SKEW = {
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "32k",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
}


def build_fact(spark, sf_dir, legs, salts=1):
    return gold.fact_legs(
        legs,
        views.silver_empresas(spark, sf_dir),
        views.silver_codigos(spark, sf_dir),
        salts=salts,
    )


def test_hot_airline_is_split_when_the_registry_outgrows_a_broadcast(spark, sf_dir, hot_legs):
    expected = checksum(build_fact(spark, sf_dir, hot_legs))
    with settings(spark, **NO_BROADCAST, **SMALL_SKEW):
        fact = build_fact(spark, sf_dir, hot_legs)
        assert checksum(fact) == expected
        executed = fact.groupBy("dia_semana").agg(F.count("nome_companhia"))
        executed.collect()
        final = plan(executed)
    assert "SortMergeJoin(skew=true)" in final
    assert "AQEShuffleRead coalesced and skewed" in final or "AQEShuffleRead skewed" in final


def test_hot_airport_is_split_when_the_registry_outgrows_a_broadcast(spark, sf_dir, hot_legs):
    registry = views.silver_aerodromos(spark, sf_dir)
    expected = checksum(gold.role_play_registry(hot_legs, registry))
    with settings(spark, **NO_BROADCAST, **TINY_SKEW):
        wide = gold.role_play_registry(hot_legs, registry)
        assert checksum(wide) == expected
        executed = wide.groupBy("pais_origem").agg(
            F.count("nome_aeroporto_destino"), F.max("partida_real_hora"), F.max("icao_empresa")
        )
        executed.collect()
        assert "SortMergeJoin(skew=true)" in plan(executed)


def test_salting_spreads_a_hot_airline(spark, sf_dir, hot_legs):
    expected = checksum(build_fact(spark, sf_dir, hot_legs))
    with settings(spark, **NO_BROADCAST, spark__sql__adaptive__enabled="false"):
        salted = build_fact(spark, sf_dir, hot_legs, salts=16)
        assert checksum(salted) == expected
        sizes = salted.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] < sizes[1] / 3


def test_hot_copies_collapse_before_the_shuffle(spark, hot_legs):
    copies = hot_legs.drop("event_id").select("icao_empresa", "codigo_di", "situacao_voo")
    once = quality.dedupe_exact(copies)
    text = plan(once)
    assert text.count("HashAggregate") == 2
    assert compare.spark_table(once) == compare.spark_table(copies.distinct())


def test_key_usage_is_one_pass(spark, hot_legs):
    text = plan(lookups.key_usage(hot_legs, ("icao_origem", "icao_destino")))
    assert text.count("FileScan") == 1 and "partial_count" in text
