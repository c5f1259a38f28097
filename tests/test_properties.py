"""Properties that hold for any input."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolake.operators import conform, lookups, quality
from aerolake.plans import gold, silver

# A Spark job per example is slow, so few examples carry many rows each.
few = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

moment = st.datetimes(dt.datetime(2024, 1, 1), dt.datetime(2025, 12, 31)).map(lambda t: t.isoformat(" "))
clock_text = st.one_of(moment, st.sampled_from(["null", "", "2025", "x", "10:99"]))
code = st.sampled_from(["SBGR", "KJFK", "SBXX", "", None])
leg = st.tuples(
    st.sampled_from(["A", "B", "Z", None]),
    st.sampled_from(["0001", "0002"]),
    st.sampled_from(["0", "1", "D"]),
    st.sampled_from(["N", "I", "Z"]),
    code,
    code,
    clock_text,
    clock_text,
    clock_text,
    clock_text,
    st.sampled_from(["REALIZADO", "CANCELADO", None]),
    st.sampled_from(["N/A", "MET"]),
)
legs_lists = st.lists(leg, min_size=1, max_size=60)
DDL = ", ".join(f"{c} string" for c in (*silver.KEYS, *silver.TIMES, "situacao_voo", "codigo_justificativa"))


def airports(spark):
    return spark.createDataFrame(
        [("SBGR", "Guarulhos", "Guarulhos", "São Paulo")],
        "icao string, nome string, municipio string, uf_nome string",
    )


@few
@given(rows=legs_lists)
def test_typing_keeps_rows_and_ties_the_metrics(spark, rows):
    typed = silver.legs(spark.createDataFrame(rows, DDL))
    gap = F.col("atraso_partida_min") - F.col("atraso_chegada_min") - F.col("minutos_recuperados")
    row = typed.agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce(F.abs(gap), F.lit(0))).alias("gap"),
        F.count_if(F.col("minutos_recuperados").isNull() != gap.isNull()).alias("odd"),
    ).first()
    assert tuple(row) == (len(rows), 0, 0)


@few
@given(pairs=st.lists(st.tuples(moment, moment), min_size=1, max_size=60))
def test_minutes_agree_with_timestampdiff(spark, pairs):
    df = conform.parse_timestamps(spark.createDataFrame(pairs, "a string, b string"), ["a", "b"])
    both = conform.elapsed_minutes(df, "a", "b", "m")
    assert both.where("NOT m <=> CAST(timestampdiff(MINUTE, a, b) AS INT)").count() == 0


@few
@given(rows=legs_lists, names=st.sets(st.sampled_from(["A", "B", "C"])))
def test_lookup_by_unique_key_keeps_the_count(spark, rows, names):
    legs = spark.createDataFrame(rows, DDL)
    registry = spark.createDataFrame([(n, n.lower()) for n in names], "icao string, nome string")
    found = lookups.join_lookup(
        legs, registry, "icao_empresa", "icao", {"nome": "n"}, present_flag="tem", on_duplicate="error"
    )
    row = found.agg(F.count("*"), F.count_if("tem")).first()
    assert tuple(row) == (len(rows), sum(r[0] in names for r in rows))


@few
@given(rows=legs_lists)
def test_dimension_covers_every_leg(spark, rows):
    legs = spark.createDataFrame(rows, DDL)
    dim = gold.dim_airport(legs, airports(spark))
    assert {r[0] for r in dim.select("icao_aeroporto").collect()} == {
        c for r in rows for c in (r[4], r[5]) if c
    }
    missing = lookups.uncovered_keys(legs, ("icao_origem", "icao_destino"), dim, "icao_aeroporto")
    assert missing.count() == 0


@few
@given(rows=legs_lists)
def test_dedupe_matches_a_set_and_is_idempotent(spark, rows):
    doubled = spark.createDataFrame(rows + rows[: len(rows) // 2], DDL)
    once = quality.dedupe_exact(doubled)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(set(rows), key=str)
    assert quality.dedupe_exact(once).count() == len(set(rows))
