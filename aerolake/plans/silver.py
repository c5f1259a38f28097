"""Typed mirrors of the raw tables: same rows, no business rule, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.operators import conform
from aerolake.operators.lookups import union_with_provenance

# Column names of the flight files and the derived measures.
TIMES = ("partida_prevista", "partida_real", "chegada_prevista", "chegada_real")
KEYS = (
    "icao_empresa",
    "numero_voo",
    "codigo_di",
    "codigo_tipo_linha",
    "icao_origem",
    "icao_destino",
)
DELAYS = ("atraso_partida_min", "atraso_chegada_min", "minutos_recuperados")
# The texts that stand for "absent" in the flight files.
NO_TIME = "null"
NO_REASON = "N/A"


def legs(raw: DataFrame, formats: Sequence[str] | None = None, guess: bool = False) -> DataFrame:
    """Typed flight legs with the three elapsed-time metrics. Other raw columns pass through.

    Without ``formats`` times are read by the lenient cast; only a bare time of day or year, of which
    it would have to ``guess`` the rest, becomes NULL.
    """
    # NO_TIME is no time in any layout, so reading it gives NULL without a test of its own.
    typed = conform.nullify(raw, {"codigo_justificativa": NO_REASON})
    typed = conform.parse_timestamps(typed, TIMES, formats, guess)
    typed = conform.split_time(typed, TIMES)
    ends = (TIMES[:2], TIMES[2:])
    for pair, delay in zip(ends, DELAYS):
        typed = conform.elapsed_minutes(typed, *pair, delay)
    typed = conform.regained_minutes(typed, *ends, DELAYS[-1])

    timed = [f"{t}{part}" for t in TIMES for part in ("", "_data", "_hora")]
    ordered = [*KEYS, *timed, "situacao_voo", "codigo_justificativa", *DELAYS]
    passed = [c for c in raw.columns if c not in ordered]
    return typed.select(*ordered, *passed)


def airlines(national: DataFrame, foreign: DataFrame) -> DataFrame:
    """One registry out of two, each row marked with the registry it came from."""
    both = union_with_provenance({"nacional": national, "estrangeira": foreign}, "origem_cadastro")
    audit = [c for c in national.columns if c.startswith("_")]
    return both.select(*[c for c in both.columns if c not in audit], *audit)


def airports(raw: DataFrame) -> DataFrame:
    renamed = raw.withColumnsRenamed(
        {
            "uf": "uf_nome",
            "uf_servido": "uf_servido_nome",
            "latitude": "latitude_dms",
            "longitude": "longitude_dms",
        }
    )
    metres = conform.decimal_comma(renamed, "altitude", "altitude")
    return metres.withColumnRenamed("altitude", "altitude_m")


def codes(raw: DataFrame) -> DataFrame:
    return raw.select("dominio", "codigo", "descricao", *[F.col(c) for c in raw.columns if c[0] == "_"])
