"""The flight model laid over the benchmark tables, so that every operator runs on them at any scale.

``events`` plays the flight legs, ``customer`` and ``supplier`` the two airline registries,
``supplier`` with its nation and region the aerodromes. FIXTURES.md holds the definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions.clock import MICROS_PER_MINUTE
from aerolake.plans import silver
from aerolake.sources.seed import operation_codes

SECONDS = "yyyy-MM-dd HH:mm:ss"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def bronze_vra(spark: SparkSession, sf_dir: str) -> DataFrame:
    flown = "event_type <> 'error'"

    def time_text(value: str, layout: str) -> str:
        return f"date_format({value}, '{layout}')"

    def later(value: str, minutes: str) -> str:
        return f"timestamp_micros(unix_micros({value}) + ({minutes}) * {MICROS_PER_MINUTE}L)"

    return events(spark, sf_dir).selectExpr(
        "event_id",
        "CASE WHEN user_id % 10 = 9 THEN concat('X', user_id) ELSE CAST(user_id AS STRING) END AS icao_empresa",
        "lpad(CAST(event_id % 1000 AS STRING), 4, '0') AS numero_voo",
        "substring('0234679DE1', CAST(event_id % 10 AS INT) + 1, 1) AS codigo_di",
        "substring('NCIGZ', CAST(event_id % 5 AS INT) + 1, 1) AS codigo_tipo_linha",
        "concat(if(user_id % 3 = 0, 'KJ', 'SB'), user_id) AS icao_origem",
        "CASE WHEN event_id % 97 = 0 THEN ''"
        " ELSE concat(if(event_id % 4 = 0, 'KJ', 'SB'), user_id + hour(ts)) END AS icao_destino",
        f"CASE WHEN event_id % 50 = 0 THEN 'null' ELSE concat({time_text('date_trunc(\'hour\', ts)', SECONDS)},"
        " if(event_id % 30 = 7, '.5', '')) END AS partida_prevista",
        # Some legs leave days late or hours early, beyond what is plausible.
        f"CASE WHEN {flown} THEN"
        f" {time_text(later('ts', 'CASE WHEN event_id % 211 = 0 THEN 1500 WHEN event_id % 223 = 0 THEN -300 ELSE 0 END'), MICROS)}"
        " ELSE 'null' END AS partida_real",
        f"{time_text('date_trunc(\'hour\', ts) + INTERVAL 1 HOUR', SECONDS)} AS chegada_prevista",
        f"CASE WHEN {flown} THEN"
        f" {time_text(later('ts', '(event_id * 7) % 120'), MICROS)}"
        " ELSE 'null' END AS chegada_real",
        f"CASE WHEN {flown} THEN 'REALIZADO' ELSE 'CANCELADO' END AS situacao_voo",
        "CASE WHEN event_id % 2 = 0 THEN 'N/A' ELSE event_type END AS codigo_justificativa",
    )


def silver_vra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.legs(bronze_vra(spark, sf_dir))


def bronze_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered operators; those with a deep negative balance carry no code."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_acctbal < -900 THEN '' ELSE CAST(c_custkey AS STRING) END AS icao",
        "CAST(NULL AS STRING) AS sigla_iata",
        "c_name AS razao_social",
        "c_mktsegment AS servico",
        "concat('Cidade ', c_nationkey) AS cidade",
        "CAST(c_nationkey AS STRING) AS uf",
        "CASE WHEN c_acctbal >= 0 THEN 'ATIVA' ELSE 'INATIVA' END AS situacao",
        "'nacionais.csv' AS _arquivo_origem",
    )


def bronze_foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        # Every fortieth is also in the other registry, under the same code.
        "concat(CASE WHEN s_suppkey % 40 = 5 THEN '' ELSE 'X' END, s_suppkey) AS icao",
        "concat('S', s_nationkey) AS sigla_iata",
        "s_name AS razao_social",
        "'REGULAR' AS servico",
        "concat('Cidade ', s_nationkey) AS cidade",
        "CAST(s_nationkey AS STRING) AS uf",
        "CASE WHEN s_acctbal >= 0 THEN 'ATIVA' ELSE 'INATIVA' END AS situacao",
        "'estrangeiras.csv' AS _arquivo_origem",
    )


def silver_empresas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.airlines(bronze_national(spark, sf_dir), bronze_foreign(spark, sf_dir))


def bronze_aerodromos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Altitude is text with a decimal comma; from 5000 up it also has a thousands point."""
    places = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    metres = "replace(CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS STRING), '.', ',')"
    return places.selectExpr(
        "concat('SB', s_suppkey) AS icao",
        "concat('C', s_suppkey) AS ciad",
        "s_name AS nome",
        "concat('Municipio ', n_name) AS municipio",
        "r_name AS uf",
        "n_name AS municipio_servido",
        "r_name AS uf_servido",
        "concat(s_nationkey, '° 52'' 08\" S') AS latitude",
        "concat(s_nationkey, '° 04'' 11\" W') AS longitude",
        f"CASE WHEN s_acctbal >= 5000 THEN concat(substring({metres}, 1, 1), '.', substring({metres}, 2))"
        f" ELSE {metres} END AS altitude",
        "CASE WHEN s_acctbal >= 0 THEN 'Aberto' ELSE 'Fechado' END AS situacao",
    )


def silver_aerodromos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.airports(bronze_aerodromos(spark, sf_dir))


def silver_codigos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operation_codes(spark)
