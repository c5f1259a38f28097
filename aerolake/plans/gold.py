"""Business rules: wide table, fact and airport dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions import rules, text
from aerolake.operators import conform
from aerolake.operators.lookups import join_lookup, key_set
from aerolake.operators.quality import AUDIT, dedupe_exact, quarantine_range
from aerolake.plans.silver import DELAYS

# Code sets, prefixes and texts of the rules.
SCOPES = {"Domestico": ("N", "C"), "Internacional": ("I", "G")}
HOME = {"Brasil": ("SB",)}
ABROAD = "Exterior"
UNLISTED_AIRPORT = "AEROPORTO FORA DO CADASTRO ANAC "
UNLISTED_AIRLINE = "COMPANHIA NAO CADASTRADA "
UNLISTED_CODE = "CODIGO NAO CATALOGADO "
FLOWN, CANCELLED = "REALIZADO", "CANCELADO"
PUNCTUAL_MINUTES = 15
PLAUSIBLE_MINUTES = (-120, 1440)

SALT_BY = ("numero_voo", "icao_origem", "partida_prevista", "chegada_prevista")

# Columns of the published tables, in order.
FACT_COLUMNS = (
    "icao_empresa",
    "nome_companhia",
    "numero_voo",
    "codigo_di",
    "descricao_di",
    "codigo_tipo_linha",
    "descricao_tipo_linha",
    "escopo_voo",
    "icao_origem",
    "icao_destino",
    "rota",
    "partida_prevista",
    "partida_prevista_data",
    "partida_prevista_hora",
    "hora_partida_prevista",
    "dia_semana",
    "mes_referencia",
    "partida_real",
    "chegada_prevista",
    "chegada_real",
    *DELAYS,
    "atraso_fora_de_faixa",
    "partida_pontual",
    "chegada_pontual",
    "situacao_voo",
    "voo_realizado",
    "voo_cancelado",
    "cadastro_companhia",
)

AIRPORT_ROLES = ("origem", "destino")
AIRPORT_ATTRIBUTES = {
    "nome_aeroporto": "nome_aeroporto_{role}",
    "municipio_aeroporto": "municipio_{role}",
    "uf_aeroporto": "uf_{role}",
    "pais_aeroporto": "pais_{role}",
}

WIDE_COLUMNS = (
    "icao_empresa",
    "nome_companhia",
    "numero_voo",
    "codigo_di",
    "descricao_di",
    "codigo_tipo_linha",
    "descricao_tipo_linha",
    "escopo_voo",
    "icao_origem",
    *[name.format(role="origem") for name in AIRPORT_ATTRIBUTES.values()],
    "icao_destino",
    *[name.format(role="destino") for name in AIRPORT_ATTRIBUTES.values()],
    "rota_icao",
    "rota_municipios",
    "partida_prevista",
    "partida_prevista_data",
    "partida_prevista_hora",
    "hora_partida_prevista",
    "dia_semana",
    "mes_referencia",
    "partida_real",
    "chegada_prevista",
    "chegada_real",
    *DELAYS,
    "atraso_fora_de_faixa",
    "partida_pontual",
    "chegada_pontual",
    "situacao_voo",
    "voo_realizado",
    "voo_cancelado",
)


def obt_legs(legs: DataFrame) -> DataFrame:
    """Silver legs plus punctuality by the clock, without tolerance."""
    return conform.on_time_by_clock(legs, "partida_prevista", "partida_real", "partida_pontual")


def dim_airport(legs: DataFrame, registry: DataFrame) -> DataFrame:
    """Every airport the legs use, registered or not."""
    keys = key_set(legs, ("icao_origem", "icao_destino"), "icao_aeroporto")
    named = join_lookup(
        keys,
        registry,
        key="icao_aeroporto",
        lookup_key="icao",
        take=dict(zip(("nome", "municipio", "uf_nome"), AIRPORT_ATTRIBUTES)),
        fallback={"nome_aeroporto": UNLISTED_AIRPORT},
        present_flag="no_cadastro_anac",
    )
    placed = conform.classify(named, "icao_aeroporto", HOME, "pais_aeroporto", ABROAD, by_prefix=True)
    return placed.select(
        "icao_aeroporto",
        "nome_aeroporto",
        "municipio_aeroporto",
        "uf_aeroporto",
        "pais_aeroporto",
        "no_cadastro_anac",
    )


def leg_rules(legs: DataFrame, locale: str = "en", quarantine: bool = False) -> DataFrame:
    """All rules of the fact that need no lookup; one pass, no join, no shuffle.

    With ``quarantine`` implausible delays are nulled and flagged; without it the flag can only show
    a flown leg whose delay is missing although both departure times are there.
    """
    if quarantine:
        delays = ("atraso_partida_min", "atraso_chegada_min")
        low, high = PLAUSIBLE_MINUTES
        legs = quarantine_range(legs, delays, DELAYS, "atraso_fora_de_faixa", low, high)
    else:
        flown = F.col("situacao_voo").eqNullSafe(F.lit(FLOWN))
        timed = F.col("partida_real").isNotNull() & F.col("partida_prevista").isNotNull()
        lost = flown & timed & F.col("atraso_partida_min").isNull()
        legs = legs.withColumn("atraso_fora_de_faixa", lost)
    legs = conform.classify(legs, "codigo_tipo_linha", SCOPES, "escopo_voo")
    legs = conform.route(legs, "icao_origem", "icao_destino", "rota")
    legs = conform.calendar_parts(legs, "partida_prevista", locale)
    for end in ("partida", "chegada"):
        legs = conform.on_time(legs, f"atraso_{end}_min", f"{end}_pontual", PUNCTUAL_MINUTES)
    return legs.withColumns(
        {
            "voo_realizado": F.col("situacao_voo") == FLOWN,
            "voo_cancelado": F.col("situacao_voo") == CANCELLED,
        }
    )


def decode_codes(legs: DataFrame, codes: DataFrame, label: str | None = None) -> DataFrame:
    """Describe both operation codes from the one code list."""
    for column, out in (("codigo_di", "descricao_di"), ("codigo_tipo_linha", "descricao_tipo_linha")):
        legs = join_lookup(
            legs,
            codes,
            key=column,
            lookup_key="codigo",
            take={"descricao": out},
            domain=("dominio", column),
            fallback={out: label} if label else None,
        )
    return legs


def fact_legs(
    legs: DataFrame,
    airlines: DataFrame,
    codes: DataFrame,
    quarantine: bool = False,
    dedupe: bool = False,
    on_duplicate: str = "keep",
    salts: int = 1,
) -> DataFrame:
    """One row per leg with its airline, decoded operation codes and the business rules.

    The registry join comes first: it is the only one that may shuffle, and then only silver columns
    travel; what the rules derive from them is computed behind it.
    """
    passed = [c for c in legs.columns if c == "event_id"]
    if dedupe:
        # Without the audit text, which the fact has no use for, the copies collapse in a hash table.
        legs = dedupe_exact(legs.drop(*AUDIT))
    named = join_lookup(
        legs,
        airlines,
        key="icao_empresa",
        lookup_key="icao",
        take={"razao_social": "nome_companhia", "origem_cadastro": "cadastro_companhia"},
        on_duplicate=on_duplicate,
        salts=salts,
        salt_by=SALT_BY,
    )
    ruled = leg_rules(decode_codes(named, codes), quarantine=quarantine)
    return ruled.select(*passed, *FACT_COLUMNS)


def role_play(legs: DataFrame, dim: DataFrame, salts: int = 1) -> DataFrame:
    """The airport dimension joined twice: its attributes for the origin and for the destination."""
    for role in AIRPORT_ROLES:
        legs = join_lookup(
            legs,
            dim,
            key=f"icao_{role}",
            lookup_key="icao_aeroporto",
            take={column: name.format(role=role) for column, name in AIRPORT_ATTRIBUTES.items()},
            salts=salts,
            salt_by=SALT_BY,
        )
    return legs


def role_play_registry(legs: DataFrame, registry: DataFrame, salts: int = 1) -> DataFrame:
    """The columns of role_play straight from the aerodrome registry.

    The dimension holds every code the legs use, so joining it back adds nothing the registry and the
    rules do not give. This needs no pass over the legs to collect their codes, and the registry's
    size is measured from its files, while that of a dimension still to be computed is not known.
    """
    for role in AIRPORT_ROLES:
        code = F.col(f"icao_{role}")
        name, city, state, country = (n.format(role=role) for n in AIRPORT_ATTRIBUTES.values())
        legs = join_lookup(
            legs,
            registry,
            key=f"icao_{role}",
            lookup_key="icao",
            take={"nome": name, "municipio": city, "uf_nome": state},
            salts=salts,
            salt_by=SALT_BY,
        )
        legs = legs.withColumns(
            {
                # A missing code is a missing answer without a test of its own.
                name: F.when(code != "", text.labelled(F.col(name), UNLISTED_AIRPORT, code)),
                country: F.when(code != "", rules.classified(code, HOME, ABROAD, True)),
            }
        )
    return legs


def obt_enriched(
    legs: DataFrame,
    airlines: DataFrame,
    codes: DataFrame,
    airports: DataFrame,
    on_duplicate: str = "keep",
    salts: int = 1,
) -> DataFrame:
    """The documented wide table: both airports named, gaps labelled, implausible delays quarantined.

    ``airports`` is the aerodrome registry, or the stored airport dimension.
    """
    passed = [c for c in legs.columns if c == "event_id"]
    wide = join_lookup(
        legs,
        airlines,
        key="icao_empresa",
        lookup_key="icao",
        take={"razao_social": "nome_companhia"},
        fallback={"nome_companhia": UNLISTED_AIRLINE},
        on_duplicate=on_duplicate,
        salts=salts,
        salt_by=SALT_BY,
    )
    play = role_play if "icao_aeroporto" in airports.columns else role_play_registry
    wide = play(wide, airports, salts)
    ends = [F.coalesce(f"municipio_{role}", f"icao_{role}") for role in AIRPORT_ROLES]
    wide = wide.withColumn("rota_municipios", text.joined(*ends))
    wide = decode_codes(wide, codes, UNLISTED_CODE)
    ruled = leg_rules(wide, locale="pt", quarantine=True).withColumnRenamed("rota", "rota_icao")
    return ruled.select(*passed, *WIDE_COLUMNS)
