"""Questions asked of the gold layer.

Each is one grouping over the legs with map-side partial sums, so a group that holds a third of the
legs reaches the shuffle as one row per task. Only the columns a question names are read. Airline
names are looked up after the grouping, per airline instead of per leg.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions import measures
from aerolake.operators.lookups import join_lookup
from aerolake.operators.quality import profile


def rate_by(
    fact: DataFrame,
    by: Sequence[str],
    numerator: str,
    denominator: str | None = None,
    out: str = "taxa",
) -> DataFrame:
    """Share of rows whose ``numerator`` flag is true, among rows where ``denominator`` is known."""
    hits = measures.hits(F.col(numerator))
    base = measures.rows() if denominator is None else measures.filled(denominator)
    return profile(
        fact,
        {f"{out}_casos": hits, f"{out}_base": base, out: measures.share(hits, base)},
        by,
    )


def with_airline_name(report: DataFrame, airlines: DataFrame) -> DataFrame:
    """The report's airlines by name, the least one of a code registered twice.

    The choice comes after the join, so only rows of reported airlines are grouped, not the registry.
    """
    named = join_lookup(
        report, airlines, key="icao_empresa", lookup_key="icao", take={"razao_social": "nome_companhia"}
    )
    least = F.min(F.struct("nome_companhia")).alias("least")
    return named.groupBy(*report.columns).agg(least).select(*report.columns, "least.nome_companhia")


def delay_by_hour(fact: DataFrame) -> DataFrame:
    return profile(
        fact,
        {
            "voos": measures.rows(),
            "atraso_medio_min": F.avg("atraso_partida_min"),
            "voos_atrasados": measures.hits(~F.col("partida_pontual")),
        },
        by=("hora_partida_prevista",),
    ).orderBy("hora_partida_prevista")


def monthly_summary(fact: DataFrame) -> DataFrame:
    """Legs without a planned departure form a month of their own (NULL)."""
    return profile(
        fact,
        {
            "voos": measures.rows(),
            "realizados": measures.hits(F.col("voo_realizado")),
            "cancelados": measures.hits(F.col("voo_cancelado")),
            "atraso_partida_medio": F.avg("atraso_partida_min"),
            "atraso_chegada_medio": F.avg("atraso_chegada_min"),
            "minutos_recuperados": F.sum("minutos_recuperados"),
        },
        by=("mes_referencia",),
    ).orderBy("mes_referencia")


def daily_series(fact: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Both bounds inclusive."""
    day = F.col("partida_prevista_data")
    return profile(
        fact.where(day.between(F.lit(start), F.lit(end))),
        {
            "voos": measures.rows(),
            "cancelados": measures.hits(F.col("voo_cancelado")),
            "atraso_medio_min": F.avg("atraso_partida_min"),
        },
        by=("partida_prevista_data",),
    ).orderBy("partida_prevista_data")


def route_ranking(fact: DataFrame, k: int = 10) -> DataFrame:
    return (
        profile(
            fact.where(F.col("rota").isNotNull()),
            {"voos": measures.rows(), "atraso_medio_min": F.avg("atraso_partida_min")},
            by=("rota",),
        )
        .orderBy(F.col("voos").desc(), F.col("rota"))
        .limit(k)
    )


def cancellation_rate(fact: DataFrame, airlines: DataFrame) -> DataFrame:
    """Per airline. A cancelled leg has no delay, so it weighs in the rate and never in the mean."""
    cancelled = measures.hits(F.col("voo_cancelado"))
    report = profile(
        fact,
        {
            "voos": measures.rows(),
            "cancelados": cancelled,
            "taxa_cancelamento": measures.share(cancelled, measures.rows()),
            "atraso_medio_min": F.avg("atraso_partida_min"),
        },
        by=("icao_empresa",),
    )
    return with_airline_name(report, airlines)


def punctuality_rate(fact: DataFrame, airlines: DataFrame) -> DataFrame:
    """Per airline, over the legs whose punctuality can be told; an unknown leg is never a late one."""
    measured = {}
    for side in ("partida", "chegada"):
        on_time = measures.hits(F.col(f"{side}_pontual"))
        known = measures.filled(f"{side}_pontual")
        measured[f"{side}_avaliados"] = known
        measured[f"{side}_pontuais"] = on_time
        measured[f"{side}_taxa"] = measures.share(on_time, known)
    return with_airline_name(profile(fact, measured, by=("icao_empresa",)), airlines)


def scope_comparison(fact: DataFrame) -> DataFrame:
    """Domestic beside international; legs of other line types stay as the NULL group."""
    cancelled = measures.hits(F.col("voo_cancelado"))
    on_time = measures.hits(F.col("partida_pontual"))
    return profile(
        fact,
        {
            "voos": measures.rows(),
            "taxa_cancelamento": measures.share(cancelled, measures.rows()),
            "taxa_pontualidade": measures.share(on_time, measures.filled("partida_pontual")),
            "atraso_medio_min": F.avg("atraso_partida_min"),
        },
        by=("escopo_voo",),
    ).orderBy("escopo_voo")


def weekday_pattern(fact: DataFrame) -> DataFrame:
    return rate_by(fact, ("dia_semana",), "partida_pontual", "partida_pontual", "pontualidade").orderBy(
        "dia_semana"
    )
