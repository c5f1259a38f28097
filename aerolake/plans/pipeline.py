"""From source files to the three layers, in build order; every step is a full refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions import measures
from aerolake.operators import governance, lookups
from aerolake.operators.conform import stamp
from aerolake.operators.publish import VERSION, log_edges, publish
from aerolake.plans import gold, silver
from aerolake.plans.dictionary import TABLES, TAGS, comments_for
from aerolake.session import broadcastable, pin, size_shuffles, stored_bytes
from aerolake.sources import layouts
from aerolake.sources.delimited import read_delimited
from aerolake.sources.seed import operation_codes

INGESTED, TYPED, PROCESSED = "_ingerido_em", "_transformado_em", "_processado_em"
EDGE_LOG = "governanca.linhagem"
LOAD_LOG = "governanca.cargas"
DICTIONARY = "governanca.dicionario"
TAG_TABLE = "governanca.etiquetas"
CHECK_TABLE = "governanca.verificacoes"

PUBLISHED = (
    "silver.vra",
    "silver.empresas",
    "silver.aerodromos",
    "silver.codigos_operacao",
    "gold.obt_voos",
    "gold.obt_voos_enriquecida",
    "gold.dim_aeroporto",
    "gold.fato_voos",
)


@dataclass(frozen=True)
class Inputs:
    """Where the source files lie; globs and lists are fine."""

    flights: str | Sequence[str]
    aerodromes: str | Sequence[str]
    national_airlines: str | Sequence[str]
    foreign_airlines: str | Sequence[str]

    def paths(self) -> list[str]:
        fields = (self.flights, self.aerodromes, self.national_airlines, self.foreign_airlines)
        return [p for f in fields for p in ([f] if isinstance(f, str) else f)]


class Breach(ValueError):
    """A check of the stored tables found a difference."""


@dataclass(frozen=True)
class Options:
    """``partitioned`` stores legs by day and the fact by month, whose column then comes last in the
    table; ``version`` keeps each load of the raw legs. Times in any form that Spark's cast reads are taken, or only
    those of ``time_formats``; ``guess_times`` also completes a bare time of day or year. Checks of
    the stored tables are always published; with ``strict`` a breach is an error as well."""

    run_date: dt.date
    partitioned: bool = True
    version: int | None = None
    time_formats: Sequence[str] | None = None
    guess_times: bool = False
    dedupe_fact: bool = False
    quarantine_fact: bool = False
    on_duplicate: str = "keep"
    salts: int = 1
    strict: bool = False
    tags: Mapping[tuple[str, str], Mapping[str, str]] = field(default_factory=lambda: TAGS)


def run(spark: SparkSession, inputs: Inputs, options: Options) -> Mapping[str, int]:
    """Build all layers; returns the rows of each table written."""
    pin(spark)
    size_shuffles(spark, stored_bytes(spark, inputs.paths()))
    return {
        **build_bronze(spark, inputs, options),
        **build_silver(spark, options),
        **build_gold(spark, options),
        **build_governance(spark, options),
        **build_checks(spark, options),
    }


def _store(
    df: DataFrame,
    target: str,
    sources: Sequence[str],
    options: Options,
    partition_by: Sequence[str] = (),
    version: int | None = None,
    clustered: bool = False,
) -> dict[str, int]:
    by = partition_by if options.partitioned else ()
    rows = publish(df, target, comments_for(target, df.columns), by, version, clustered, LOAD_LOG)
    log_edges(df.sparkSession, target, sources, EDGE_LOG, options.run_date)
    return {target: rows}


def build_bronze(spark: SparkSession, inputs: Inputs, options: Options) -> dict[str, int]:
    """Raw text, every source row kept. A blank source in the edge log stands for files."""
    legs = read_delimited(spark, inputs.flights, file_column="_arquivo_origem", **layouts.FLIGHT_FILE)
    written = _store(stamp(legs, INGESTED), "bronze.vra", [""], options, version=options.version)

    aerodromes = read_delimited(spark, inputs.aerodromes, **layouts.AERODROME_FILE)
    written |= _store(stamp(aerodromes, INGESTED), "bronze.aerodromos", [""], options)

    for paths, target in (
        (inputs.national_airlines, "bronze.empresas_nacionais"),
        (inputs.foreign_airlines, "bronze.empresas_estrangeiras"),
    ):
        rows = read_delimited(spark, paths, file_column="_arquivo_origem", **layouts.AIRLINE_FILE)
        written |= _store(stamp(rows, INGESTED), target, [""], options)

    written |= _store(operation_codes(spark), "bronze.codigos_operacao", [""], options)
    return written


def build_silver(spark: SparkSession, options: Options) -> dict[str, int]:
    """Typed mirrors with the row counts of their sources."""
    raw = spark.table("bronze.vra")
    if options.version is not None:
        raw = raw.where(F.col(VERSION) == options.version).drop(VERSION)
    legs = stamp(silver.legs(raw, options.time_formats, options.guess_times), TYPED)
    written = _store(legs, "silver.vra", ["bronze.vra"], options, ["partida_prevista_data"])

    sources = ["bronze.empresas_nacionais", "bronze.empresas_estrangeiras"]
    airlines = silver.airlines(*map(spark.table, sources))
    written |= _store(stamp(airlines, TYPED), "silver.empresas", sources, options)

    airports = silver.airports(spark.table("bronze.aerodromos"))
    written |= _store(stamp(airports, TYPED), "silver.aerodromos", ["bronze.aerodromos"], options)

    codes = silver.codes(spark.table("bronze.codigos_operacao"))
    target = "silver.codigos_operacao"
    return written | _store(stamp(codes, TYPED), target, ["bronze.codigos_operacao"], options)


def build_gold(spark: SparkSession, options: Options) -> dict[str, int]:
    legs, airlines = spark.table("silver.vra"), spark.table("silver.empresas")
    airports, codes = spark.table("silver.aerodromos"), spark.table("silver.codigos_operacao")
    day, month = ["partida_prevista_data"], ["mes_referencia"]

    wide = gold.obt_legs(legs)
    written = _store(wide, "gold.obt_voos", ["silver.vra"], options, day, clustered=True)

    dim = stamp(gold.dim_airport(legs, airports), PROCESSED)
    written |= _store(dim, "gold.dim_aeroporto", ["silver.vra", "silver.aerodromos"], options)

    sources = ["silver.vra", "silver.empresas", "silver.codigos_operacao"]
    # Stored by day, and nothing moves the rows: each task already holds few months.
    in_place = broadcastable(airlines) and options.salts == 1
    fact = gold.fact_legs(
        legs,
        airlines,
        codes,
        quarantine=options.quarantine_fact,
        dedupe=options.dedupe_fact,
        on_duplicate=options.on_duplicate,
        salts=options.salts,
    )
    kept = in_place and not options.dedupe_fact
    written |= _store(stamp(fact, PROCESSED), "gold.fato_voos", sources, options, month, clustered=kept)

    stored_dim = spark.table("gold.dim_aeroporto")
    wide = gold.obt_enriched(
        legs,
        airlines,
        codes,
        stored_dim,
        on_duplicate=options.on_duplicate,
        salts=options.salts,
    )
    sources = [*sources, "gold.dim_aeroporto"]
    target = "gold.obt_voos_enriquecida"
    kept = in_place and broadcastable(stored_dim)
    return written | _store(stamp(wide, PROCESSED), target, sources, options, month, clustered=kept)


def build_governance(spark: SparkSession, options: Options) -> dict[str, int]:
    """The dictionary as the tables carry it, and their tags."""
    schemas = {tuple(name.split(".")): spark.table(name).schema for name in PUBLISHED}
    dictionary = governance.data_dictionary(spark, schemas, TABLES)
    return {
        DICTIONARY: publish(dictionary, DICTIONARY),
        TAG_TABLE: publish(governance.tag_rows(spark, options.tags), TAG_TABLE),
    }


# --- checks of what was stored ---------------------------------------------------------------


def stored_checks(spark: SparkSession, options: Options) -> DataFrame:
    """(verificacao, alvo, esperado, encontrado) of the tables as they lie there now.

    Rows that were lost or repeated on the way, times that hold text but were not read, airline codes
    registered twice, and airports of the legs that the dimension lacks.
    """
    raw = spark.table("bronze.vra")
    if options.version is not None:
        raw = raw.where(F.col(VERSION) == options.version)
    legs, airlines = spark.table("silver.vra"), spark.table("silver.empresas")

    def count(*tables: DataFrame) -> DataFrame:
        return totals(*[t.agg(measures.rows().alias("linhas")) for t in tables])

    def counted(df: DataFrame) -> DataFrame:
        """Rows, and the times that hold something, in one pass over the table."""
        written = {t: F.col(t).isNotNull() & (F.col(t).cast("string") != silver.NO_TIME) for t in silver.TIMES}
        return totals(df.agg(measures.rows().alias("linhas"), *[measures.hits(w).alias(t) for t, w in written.items()]))

    def totals(*ones: DataFrame) -> DataFrame:
        """(medida, n) of one-row frames, added up."""
        named = [one.unpivot([], one.columns, "medida", "n") for one in ones]
        return reduce(DataFrame.unionByName, named).groupBy("medida").agg(F.sum("n").alias("n"))

    none = spark.range(1).select(F.lit("linhas").alias("medida"), F.lit(0).cast("long").alias("n"))
    registries = [spark.table(f"bronze.empresas_{kind}") for kind in ("nacionais", "estrangeiras")]
    named = airlines.where(F.col("icao") != "")
    airports = lookups.uncovered_keys(legs, ("icao_origem", "icao_destino"), spark.table("gold.dim_aeroporto"), "icao_aeroporto")
    checks = [
        ("linhas", "silver.vra", counted(raw), counted(legs)),
        ("linhas", "silver.empresas", count(*registries), count(airlines)),
        ("linhas", "silver.aerodromos", count(spark.table("bronze.aerodromos")), count(spark.table("silver.aerodromos"))),
        ("linhas", "gold.obt_voos", count(legs), count(spark.table("gold.obt_voos"))),
        ("linhas", "gold.obt_voos_enriquecida", count(legs), count(spark.table("gold.obt_voos_enriquecida"))),
        ("chave_unica", "silver.empresas", none, count(lookups.duplicate_keys(named, "icao"))),
        ("cobertura", "gold.dim_aeroporto", none, count(airports)),
    ]
    if not options.dedupe_fact:
        checks.append(("linhas", "gold.fato_voos", count(legs), count(spark.table("gold.fato_voos"))))
    is_time = F.col("medida") != "linhas"
    sides = [
        side.select(
            F.when(is_time, "tempo_lido").otherwise(check).alias("verificacao"),
            F.when(is_time, F.concat_ws(".", F.lit(place), "medida")).otherwise(place).alias("alvo"),
            F.lit(end).alias("lado"),
            "n",
        )
        for check, place, expected, found in checks
        for end, side in (("esperado", expected), ("encontrado", found))
    ]
    lined_up = reduce(DataFrame.unionByName, sides).groupBy("verificacao", "alvo")
    return lined_up.agg(
        *[F.coalesce(F.sum(F.when(F.col("lado") == x, F.col("n"))), F.lit(0)).alias(x) for x in ("esperado", "encontrado")]
    ).withColumn("diferenca", F.col("esperado") - F.col("encontrado"))


def build_checks(spark: SparkSession, options: Options) -> dict[str, int]:
    """Publish the checks; with ``strict`` a difference is an error, after it has been published."""
    written = publish(stored_checks(spark, options), CHECK_TABLE)
    if options.strict:
        breaches = spark.table(CHECK_TABLE).where("diferenca <> 0").orderBy("verificacao", "alvo").collect()
        if breaches:
            told = [
                f"{r['verificacao']} {r['alvo']}: {r['esperado']} expected, {r['encontrado']} found"
                for r in breaches
            ]
            raise Breach("; ".join(told))
    return {CHECK_TABLE: written}
