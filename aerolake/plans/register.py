"""Every query by name: (session, table folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions import measures, text
from aerolake.operators import conform, governance, lookups, quality
from aerolake.operators.publish import with_comments
from aerolake.plans import consumption, gold, silver
from aerolake.session import input_bytes, keep_small, pin, size_shuffles
from aerolake.sources import views
from aerolake.sources.delimited import parse_delimited

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

AIRPORT_SIDES = ("icao_origem", "icao_destino")
CODE_COLUMNS = ("codigo_di", "codigo_tipo_linha")


def query(build: Query) -> Query:
    """Register a builder under its own name; the session is pinned before it runs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin(spark)
        result = build(spark, sf_dir)
        size_shuffles(spark, input_bytes(result))
        return result

    QUERIES[build.__name__] = run
    return build


def leg_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact without its lookups: what the consumption questions read."""
    return gold.leg_rules(views.silver_vra(spark, sf_dir))


# --- raw layer -------------------------------------------------------------------------------


@query
def bronze_vra(spark, sf_dir):
    return views.bronze_vra(spark, sf_dir)


@query
def ingest_delimited(spark, sf_dir):
    """Events written out as lines with doubled quotes, quoted separators, short and long rows."""
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    head = F.concat(F.col("event_id").cast("string"), F.lit(';"'), "event_type", F.lit('""q"'))
    full = F.concat(head, F.lit(';"";"'), when, F.lit(';local"'))
    line = F.when(F.col("event_id") % 3 == 0, head).otherwise(
        F.when(F.col("event_id") % 5 == 0, F.concat(full, F.lit(";sobra"))).otherwise(full)
    )
    lines = views.events(spark, sf_dir).select(line.alias("linha"))
    return parse_delimited(lines, "linha", ("id", "tipo", "vazio", "quando"), escape='"')


@query
def ingest_quote_off(spark, sf_dir):
    """Customers written out with a double quote as plain text."""
    line = F.concat("c_custkey", F.lit(";"), "c_nationkey", F.lit(" 52' 08\" S;\""), "c_mktsegment")
    lines = views.table(spark, sf_dir, "customer").select(line.alias("linha"))
    return parse_delimited(lines, "linha", ("chave", "latitude", "segmento"), quote=None)


@query
def seed_codes(spark, sf_dir):
    """The seed list with the number of legs that use each code."""
    used = lookups.key_usage(views.bronze_vra(spark, sf_dir), CODE_COLUMNS)
    seed = views.silver_codigos(spark, sf_dir)
    match = (F.col("dominio") == F.col("coluna")) & (F.col("codigo") == F.col("chave"))
    return seed.join(used, match, "left").select(
        "dominio", "codigo", "descricao", F.coalesce("linhas", F.lit(0)).alias("etapas")
    )


@query
def sentinel_profile(spark, sf_dir):
    departed, planned = F.col("partida_real"), F.col("partida_prevista")
    return quality.profile(
        views.bronze_vra(spark, sf_dir),
        {
            "linhas": measures.rows(),
            "partida_real_nula": measures.hits_or_null(departed.isNull()),
            "partida_real_texto_null": measures.hits_or_null(departed == silver.NO_TIME),
            "partida_prevista_texto_null": measures.hits_or_null(planned == silver.NO_TIME),
            "com_fracao_de_segundo": measures.hits_or_null(departed.contains(".")),
            "prevista_com_fracao_de_segundo": measures.hits_or_null(planned.contains(".")),
        },
    )


@query
def file_manifest(spark, sf_dir):
    """One source file per calendar day."""
    daily = views.events(spark, sf_dir).select(
        F.concat(F.lit("vra_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv")).alias("_arquivo_origem"),
        F.col("ts").alias("_ingerido_em"),
    )
    return quality.manifest(daily, "_arquivo_origem", "_ingerido_em")


@query
def scanned_files(spark, sf_dir):
    """Rows and last time of every file that the scans of three tables read, by the files' own names."""
    times = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    rows = [
        views.table(spark, sf_dir, table).select(
            F.col("_metadata.file_name").alias("_arquivo_origem"), F.col(time).cast("timestamp").alias("_ingerido_em")
        )
        for table, time in times.items()
    ]
    return quality.manifest(reduce(DataFrame.unionByName, rows), "_arquivo_origem", "_ingerido_em")


# --- typed layer -----------------------------------------------------------------------------


@query
def silver_legs(spark, sf_dir):
    return views.silver_vra(spark, sf_dir)


@query
def silver_airports(spark, sf_dir):
    return views.silver_aerodromos(spark, sf_dir)


@query
def union_registries(spark, sf_dir):
    return views.silver_empresas(spark, sf_dir)


@query
def parse_profile(spark, sf_dir):
    columns = (*silver.TIMES, "atraso_partida_min", "minutos_recuperados")
    return quality.profile(
        views.silver_vra(spark, sf_dir), {f"{c}_ok": measures.filled(c) for c in columns}
    )


@query
def read_times(spark, sf_dir):
    """Event times written in ten forms, read as the build reads them; the last three stay unread."""
    forms = (
        "yyyy-MM-dd HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss",
        "yyyy-MM-dd HH:mm:ss'Z'",
        "yyyy-MM-dd H:mm:ss",
        "' 'yyyy-MM-dd HH:mm:ss",
        "yyyy-MM-dd HH:mm:ss.SSSSSS'000'",
        "yyyy-MM-dd",
        "HH:mm:ss",
        "yyyy",
        "dd/MM/yyyy HH:mm",
    )
    written = F.lit(None)
    for n, form in enumerate(forms):
        written = F.when(F.col("event_id") % len(forms) == n, F.date_format("ts", form)).otherwise(written)
    texts = views.events(spark, sf_dir).select("event_id", written.alias("texto"))
    read = conform.parse_timestamps(texts.withColumn("lido", F.col("texto")), ["lido"], guess=False)
    return read


@query
def row_parity(spark, sf_dir):
    """Raw legs against the fact, whose lookups repeat the legs of an airline code registered twice."""
    raw, fact = views.bronze_vra(spark, sf_dir), fact_legs(spark, sf_dir)
    return quality.row_parity({"bronze_vra": raw}, "fato_voos", fact, key="event_id")


@query
def union_parity(spark, sf_dir):
    """Airline codes of both registries against the different codes of their union."""

    def coded(df: DataFrame) -> DataFrame:
        return df.where(text.has_text(F.col("icao"))).select("icao")

    parts = {
        "bronze_nacionais": coded(views.bronze_national(spark, sf_dir)),
        "bronze_estrangeiras": coded(views.bronze_foreign(spark, sf_dir)),
    }
    actual = coded(views.silver_empresas(spark, sf_dir)).distinct()
    return quality.row_parity(parts, "silver_empresas", actual, "soma_esperada")


@query
def key_coverage(spark, sf_dir):
    """Usable keys of each source table."""
    covered = {"linhas": measures.rows(), "com_icao": measures.hits(text.has_text(F.col("icao")))}
    national = quality.profile(views.bronze_national(spark, sf_dir), covered)
    foreign = quality.profile(views.bronze_foreign(spark, sf_dir), covered)
    return lookups.union_with_provenance(
        {"empresas_nacionais": national, "empresas_estrangeiras": foreign}, "tabela"
    )


@query
def registry_profile(spark, sf_dir):
    covered = {"linhas": measures.rows(), "com_icao": measures.hits(text.has_text(F.col("icao")))}
    registry = views.silver_empresas(spark, sf_dir)
    return quality.profile(registry, covered, by=("origem_cadastro",)).orderBy("origem_cadastro")


@query
def filter_in_sorted(spark, sf_dir):
    return quality.sample_by_keys(
        views.silver_empresas(spark, sf_dir),
        "servico",
        ("BUILDING", "MACHINERY", "REGULAR"),
        take=("icao", "razao_social", "servico", "uf", "situacao"),
        order=("servico", "icao", "razao_social"),
    )


@query
def topk_earliest(spark, sf_dir):
    shown = views.silver_vra(spark, sf_dir).select(
        "event_id",
        "icao_empresa",
        "numero_voo",
        *AIRPORT_SIDES,
        "partida_prevista",
        "partida_prevista_data",
        "partida_prevista_hora",
        *silver.DELAYS,
        "situacao_voo",
    )
    return quality.earliest(shown, "partida_prevista", 5, tie_break=("event_id",))


# --- business layer --------------------------------------------------------------------------


@query
def obt_legs(spark, sf_dir):
    return gold.obt_legs(views.silver_vra(spark, sf_dir))


@query
def dim_airport(spark, sf_dir):
    return gold.dim_airport(views.silver_vra(spark, sf_dir), views.silver_aerodromos(spark, sf_dir))


@query
def decode_codes(spark, sf_dir):
    coded = views.silver_vra(spark, sf_dir).select("event_id", *CODE_COLUMNS)
    return gold.decode_codes(coded, views.silver_codigos(spark, sf_dir))


@query
def fact_legs(spark, sf_dir):
    return gold.fact_legs(
        views.silver_vra(spark, sf_dir),
        views.silver_empresas(spark, sf_dir),
        views.silver_codigos(spark, sf_dir),
    )


@query
def obt_enriched(spark, sf_dir):
    return gold.obt_enriched(
        views.silver_vra(spark, sf_dir),
        views.silver_empresas(spark, sf_dir),
        views.silver_codigos(spark, sf_dir),
        views.silver_aerodromos(spark, sf_dir),
    )


@query
def airport_roles(spark, sf_dir):
    """The computed dimension joined for the origin and for the destination."""
    legs = views.silver_vra(spark, sf_dir).select("event_id", *AIRPORT_SIDES)
    # Stored first, as the build does: only then is its size known before the legs move.
    dim = keep_small(gold.dim_airport(legs, views.silver_aerodromos(spark, sf_dir)))
    return gold.role_play(legs, dim)


@query
def recovery_profile(spark, sf_dir):
    """Legs that regained time. The condition stands in the measures: as a filter it would go below the
    typed legs, and every time would be read there once more."""
    regained = F.col("minutos_recuperados") > 0
    arrival = F.col("atraso_chegada_min")
    return quality.profile(
        gold.obt_legs(views.silver_vra(spark, sf_dir)),
        {
            "recuperaram": measures.hits(regained),
            "no_horario_ou_antes": measures.hits_or_null(arrival <= 0, regained),
            "ainda_atrasadas": measures.hits_or_null(arrival > 0, regained),
            "atrasadas_mais_de_15": measures.hits_or_null(arrival > gold.PUNCTUAL_MINUTES, regained),
        },
    )


@query
def status_profile(spark, sf_dir):
    undecided = measures.hits_or_null(F.col("partida_pontual").isNull())
    return quality.profile(
        gold.obt_legs(views.silver_vra(spark, sf_dir)),
        {"voos": measures.rows(), "partida_pontual_nula": undecided},
        by=("situacao_voo",),
    )


# --- quality rules ---------------------------------------------------------------------------


@query
def dim_coverage(spark, sf_dir):
    """Airport codes of the legs that the dimension lacks (none) and that the registry lacks."""
    legs = views.silver_vra(spark, sf_dir)
    registry = views.silver_aerodromos(spark, sf_dir)
    dim = gold.dim_airport(legs, registry)
    targets = {"dim_aeroporto": (dim, "icao_aeroporto"), "cadastro": (registry, "icao")}
    return lookups.coverage(legs, AIRPORT_SIDES, targets)


@query
def lookup_duplicates(spark, sf_dir):
    """Airline codes that stand in both registries, and the legs that a lookup by them repeats."""
    airlines, legs = views.silver_empresas(spark, sf_dir), views.silver_vra(spark, sf_dir)
    named = airlines.where(text.has_text(F.col("icao")))
    return lookups.duplicate_keys(named, "icao", legs, "icao_empresa")


@query
def nation_duplicates(spark, sf_dir):
    """Nation codes more than one supplier has, and the customers a lookup by them would repeat."""
    return lookups.duplicate_keys(
        views.table(spark, sf_dir, "supplier"),
        "s_nationkey",
        views.table(spark, sf_dir, "customer"),
        "c_nationkey",
    )


@query
def fact_merged(spark, sf_dir):
    """The fact with one registry row, the least, for an airline code that is registered twice."""
    return gold.fact_legs(
        views.silver_vra(spark, sf_dir),
        views.silver_empresas(spark, sf_dir),
        views.silver_codigos(spark, sf_dir),
        on_duplicate="merge",
    )


@query
def dictionary_gaps(spark, sf_dir):
    """Documents as columns and labelled documents as their descriptions: columns without one, and
    descriptions of no column. A document without a quality label is undescribed; long ones are no column."""
    documents = views.table(spark, sf_dir, "documents")
    where = [
        F.lit("corpus").alias("camada"),
        F.lit("documents").alias("tabela"),
        F.col("doc_id").cast("string").alias("coluna"),
    ]
    described = views.table(spark, sf_dir, "labels").select(
        *where, F.when(F.col("quality") == 1, "boa").otherwise("").alias("comentario")
    )
    return governance.dictionary_gaps(described, documents.where("n_chars < 3000").select(*where))


@query
def plausible_range(spark, sf_dir):
    flagged = quality.quarantine_range(
        views.silver_vra(spark, sf_dir),
        checks=("atraso_partida_min", "atraso_chegada_min"),
        metrics=silver.DELAYS,
        flag="atraso_fora_de_faixa",
        low=-30,
        high=90,
    )
    return flagged.select("event_id", *silver.DELAYS, "atraso_fora_de_faixa")


@query
def dedupe_exact(spark, sf_dir):
    """Order lines by (order, line); the shipping time stands for the audit column."""
    lines = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("_ingerido_em")
    )
    return quality.dedupe_exact(lines)


@query
def uncatalogued_codes(spark, sf_dir):
    return lookups.uncovered_keys(
        views.silver_vra(spark, sf_dir),
        CODE_COLUMNS,
        views.silver_codigos(spark, sf_dir),
        "codigo",
        domain="dominio",
    )


# --- governance ------------------------------------------------------------------------------


def _described_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as documented columns: the label, where there is one, is the comment."""
    comment = F.concat(F.lit("qualidade "), F.max("quality")).alias("comentario")
    labels = views.table(spark, sf_dir, "labels").groupBy("doc_id").agg(comment)
    named = views.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("camada"), F.col("source").alias("tabela")
    )
    return named.join(labels, "doc_id", "left")


@query
def table_dictionary(spark, sf_dir):
    """Every column of the given tables with its description and what it holds, and a row for each table."""
    tables = {}
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        df = views.table(spark, sf_dir, name)
        tables["fonte", name] = with_comments(df, {c: "chave" for c in df.columns if c.endswith("key")})
    return governance.profiled_dictionary(spark, tables, {place: f"tabela {place[1]}" for place in tables})


@query
def doc_coverage(spark, sf_dir):
    return governance.doc_coverage(_described_documents(spark, sf_dir), ("tabela",))


@query
def doc_coverage_by_layer(spark, sf_dir):
    described = _described_documents(spark, sf_dir)
    return governance.doc_coverage(described, ("camada", "tabela"), with_percent=False)


@query
def tag_listing(spark, sf_dir):
    """Documents as tagged tables: long ones form the gold layer, each tagged with its language."""
    tags = views.table(spark, sf_dir, "documents").select(
        F.when(F.col("n_chars") >= 1000, "gold").otherwise("silver").alias("camada"),
        F.col("source").alias("tabela"),
        F.lit("idioma").alias("etiqueta"),
        F.col("lang").alias("valor"),
    )
    return governance.tag_listing(tags, "gold")


@query
def lineage_edges(spark, sf_dir):
    edges = views.events(spark, sf_dir).select(
        F.when(F.col("event_id") % 11 == 0, "").otherwise(F.col("event_type")).alias("origem"),
        F.concat(F.when(F.col("event_type") == "error", "other.").otherwise("flight."), "user_id").alias(
            "destino"
        ),
        F.to_date("ts").alias("data_evento"),
    )
    return governance.lineage_edges(edges, "flight.", dt.date(2024, 1, 30))


def _loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as three loads, told apart by the day of the month; the first one created the table."""
    version = F.dayofmonth("ts") % 3
    return views.events(spark, sf_dir).select(
        version.alias("_versao"),
        F.col("ts").alias("_ingerido_em"),
        F.when(version == 0, "create").otherwise("load").alias("_operacao"),
    )


@query
def load_ledger(spark, sf_dir):
    return governance.load_ledger(_loads(spark, sf_dir), "_versao", "_ingerido_em", "_operacao")


@query
def snapshot_compare(spark, sf_dir):
    return governance.snapshot_compare(_loads(spark, sf_dir), "_versao", "_ingerido_em")


# --- questions -------------------------------------------------------------------------------


@query
def delay_by_hour(spark, sf_dir):
    return consumption.delay_by_hour(leg_rules(spark, sf_dir))


@query
def monthly_summary(spark, sf_dir):
    return consumption.monthly_summary(leg_rules(spark, sf_dir))


@query
def daily_series(spark, sf_dir):
    start, end = dt.date(2024, 1, 8), dt.date(2024, 1, 21)
    return consumption.daily_series(leg_rules(spark, sf_dir), start, end)


@query
def route_ranking(spark, sf_dir):
    return consumption.route_ranking(leg_rules(spark, sf_dir))


@query
def cancellation_rate(spark, sf_dir):
    return consumption.cancellation_rate(leg_rules(spark, sf_dir), views.silver_empresas(spark, sf_dir))


@query
def punctuality_rate(spark, sf_dir):
    return consumption.punctuality_rate(leg_rules(spark, sf_dir), views.silver_empresas(spark, sf_dir))


@query
def scope_comparison(spark, sf_dir):
    return consumption.scope_comparison(leg_rules(spark, sf_dir))


@query
def weekday_pattern(spark, sf_dir):
    return consumption.weekday_pattern(leg_rules(spark, sf_dir))
