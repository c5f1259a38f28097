"""Documentation, tags, lineage and load history as ordinary tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerolake.functions import measures, text
from aerolake.sources.seed import seed_table

DICTIONARY = "camada string, tabela string, coluna string, comentario string"
TAGS = "camada string, tabela string, etiqueta string, valor string"
LOADS = "tabela string, versao int, operacao string, linhas long"
EDGES = "origem string, destino string, data_evento date"


def data_dictionary(
    spark: SparkSession,
    schemas: Mapping[tuple[str, str], StructType],
    tables: Mapping[tuple[str, str], str] | None = None,
) -> DataFrame:
    """One row per column of the given tables, with the comment the schema carries.

    Descriptions of whole tables come as rows with a blank column name.
    """
    rows = [
        (layer, table, field.name, (field.metadata or {}).get("comment"))
        for (layer, table), schema in schemas.items()
        for field in schema.fields
    ]
    rows += [(*place, "", text) for place, text in (tables or {}).items()]
    return seed_table(spark, rows, DICTIONARY)


def column_profile(df: DataFrame) -> DataFrame:
    """(coluna, linhas, preenchidas) of every column of a table, in one pass over it."""
    counts = df.agg(measures.rows().alias("linhas"), *[measures.filled(c).alias(c) for c in df.columns])
    return counts.unpivot(["linhas"], df.columns, "coluna", "preenchidas").select("coluna", "linhas", "preenchidas")


def profiled_dictionary(
    spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame], descriptions: Mapping[tuple[str, str], str] | None = None
) -> DataFrame:
    """The data dictionary of the tables with what each column holds; a table's own row has neither count."""
    profiles = [
        column_profile(df).withColumns({"camada": F.lit(layer), "tabela": F.lit(table)})
        for (layer, table), df in tables.items()
    ]
    dictionary = data_dictionary(spark, {place: df.schema for place, df in tables.items()}, descriptions)
    return dictionary.join(reduce(DataFrame.unionByName, profiles), ["camada", "tabela", "coluna"], "left")


def dictionary_gaps(dictionary: DataFrame, schema: DataFrame) -> DataFrame:
    """Comments without a column ('sem_coluna') and columns without a comment ('sem_comentario')."""
    where = ["camada", "tabela", "coluna"]
    written = dictionary.where(text.has_text(F.col("comentario"))).select(*where)
    existing = schema.select(*where)
    stale = written.join(existing, where, "left_anti").withColumn("falta", F.lit("sem_coluna"))
    bare = existing.join(written, where, "left_anti").withColumn("falta", F.lit("sem_comentario"))
    return stale.unionByName(bare)


def doc_coverage(dictionary: DataFrame, by: Sequence[str], with_percent: bool = True) -> DataFrame:
    """Columns, columns without a comment and the percentage documented, per group."""
    documented = text.has_text(F.col("comentario"))
    measured = [
        measures.rows().alias("colunas"),
        measures.hits_or_null(~documented).alias("sem_comentario"),
    ]
    if with_percent:
        done = measures.hits_or_null(documented)
        measured.append(measures.percent(done, measures.rows()).alias("pct_documentado"))
    return dictionary.groupBy(*by).agg(*measured).orderBy(*by)


def tag_rows(spark: SparkSession, tags: Mapping[tuple[str, str], Mapping[str, str]]) -> DataFrame:
    """Tag sets of the tables as (camada, tabela, etiqueta, valor)."""
    rows = [(*table, k, v) for table, pairs in tags.items() for k, v in pairs.items()]
    return seed_table(spark, rows, TAGS)


def tag_listing(tags: DataFrame, layer: str) -> DataFrame:
    """The tags of one layer's tables; a tag recorded twice counts once."""
    listed = tags.where(F.col("camada") == layer).select("tabela", "etiqueta", "valor")
    return listed.distinct().orderBy("tabela", "etiqueta", "valor")


def edge_rows(
    spark: SparkSession, target: str, sources: Sequence[str], run_date: dt.date
) -> DataFrame:
    """Lineage edges of one write. A blank source stands for a raw file."""
    return seed_table(spark, [(s, target, run_date) for s in sources], EDGES)


def lineage_edges(
    edges: DataFrame,
    prefix: str,
    reference_date: dt.date,
    days: int = 7,
    blank_label: str = "(arquivo no volume)",
) -> DataFrame:
    """Distinct (source, target) pairs seen in the days up to the reference date."""
    since = reference_date - dt.timedelta(days=days)
    recent = edges.where(F.col("destino").startswith(prefix) & (F.col("data_evento") >= F.lit(since)))
    pairs = recent.select(text.or_label(F.col("origem"), blank_label).alias("origem"), "destino")
    return pairs.distinct().orderBy("destino", "origem")


def load_ledger(df: DataFrame, version_col: str, ts_col: str, operation_col: str) -> DataFrame:
    """One row per load: recorded operation, rows written, first ingest time."""
    return (
        df.groupBy(version_col)
        .agg(
            F.min(operation_col).alias("operacao"),
            measures.rows().alias("linhas_escritas"),
            F.min(ts_col).alias("ingerido_em"),
        )
        .orderBy(version_col)
    )


def snapshot_compare(
    df: DataFrame,
    version_col: str,
    ts_col: str,
    first: int | None = None,
    current: int | None = None,
) -> DataFrame:
    """Rows and first ingest time of an early load beside the current one (default: least and greatest).

    All loads are reduced in one scan; the two rows are picked from that ledger.
    """
    version = F.col(version_col)
    loads = df
    if first is not None and current is not None:
        loads = df.where(version.isin(first, current))
    ledger = loads.groupBy(version.alias("v")).agg(
        measures.rows().alias("linhas"), F.min(ts_col).alias("ingerido_em")
    )
    summary = F.struct("v", "linhas", "ingerido_em")

    def end(label: str, wanted: int | None, pick) -> object:
        chosen = pick(summary) if wanted is None else pick(F.when(F.col("v") == wanted, summary))
        return chosen.alias(label)

    ends = ledger.agg(end("a", first, F.min), end("b", current, F.max))
    both = F.array(
        F.struct(F.lit("primeira carga").alias("carga"), F.col("a.*")),
        F.struct(F.lit("carga atual").alias("carga"), F.col("b.*")),
    )
    return ends.select(F.inline(both)).withColumnRenamed("v", version_col)
