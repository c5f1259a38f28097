"""What each published column and table holds; travels with the tables as column comments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

# One description per column name; a table may say it differently below.
GLOSSARY = {
    # keys and codes
    "icao_empresa": "Operating airline, three-letter ICAO code.",
    "numero_voo": "Flight number as sold; text, since leading zeros count. Repeats from day to day.",
    "codigo_di": "Authorisation code of the leg; see descricao_di or the code list.",
    "codigo_tipo_linha": "Line type code: N and C domestic, I and G international.",
    "icao_origem": "Departure airport, ICAO code.",
    "icao_destino": "Arrival airport, ICAO code.",
    "situacao_voo": "Reported status: REALIZADO (flown) or CANCELADO (cancelled).",
    "codigo_justificativa": "Reason given for a delay; NULL when none was given.",
    # times
    "partida_prevista": "Planned departure, wall clock at the origin.",
    "partida_real": "Actual departure, wall clock at the origin; NULL when the leg was not flown.",
    "chegada_prevista": "Planned arrival, wall clock at the destination.",
    "chegada_real": "Actual arrival, wall clock at the destination; NULL when the leg was not flown.",
    "partida_prevista_data": "Day of the planned departure.",
    "partida_real_data": "Day of the actual departure.",
    "chegada_prevista_data": "Day of the planned arrival.",
    "chegada_real_data": "Day of the actual arrival.",
    "partida_prevista_hora": "HH:mm of the planned departure.",
    "partida_real_hora": "HH:mm of the actual departure.",
    "chegada_prevista_hora": "HH:mm of the planned arrival.",
    "chegada_real_hora": "HH:mm of the actual arrival.",
    "hora_partida_prevista": "Hour of the planned departure, 0 to 23.",
    "dia_semana": "Weekday of the planned departure, lower case.",
    "mes_referencia": "First midnight of the month of the planned departure; NULL without a plan.",
    # measures and flags
    "atraso_partida_min": "Minutes from planned to actual departure; negative when early.",
    "atraso_chegada_min": "Minutes from planned to actual arrival; negative when early.",
    "minutos_recuperados": "Departure delay less arrival delay; positive when time was regained in the air.",
    "atraso_fora_de_faixa": "True when the delay is missing or withheld although the leg was flown on known times.",
    "partida_pontual": "Departed at most 15 minutes late; NULL when it cannot be told.",
    "chegada_pontual": "Arrived at most 15 minutes late; NULL when it cannot be told.",
    "voo_realizado": "The leg was flown.",
    "voo_cancelado": "The leg was cancelled.",
    "escopo_voo": "Domestico or Internacional, from the line type; NULL for other line types.",
    # names
    "nome_companhia": "Registered name of the airline.",
    "cadastro_companhia": "Registry the airline was found in; NULL when in none.",
    "descricao_di": "Authorisation code in words.",
    "descricao_tipo_linha": "Line type in words.",
    "rota": "Origin and destination codes joined.",
    "rota_icao": "Origin and destination codes joined; the stable key of a route.",
    "rota_municipios": "Origin and destination cities joined; the code stands in for an unknown city.",
    "nome_aeroporto_origem": "Name of the departure airport.",
    "municipio_origem": "City of the departure airport; NULL when unregistered.",
    "uf_origem": "State of the departure airport in full; NULL when unregistered.",
    "pais_origem": "Brasil or Exterior, from the code prefix.",
    "nome_aeroporto_destino": "Name of the arrival airport.",
    "municipio_destino": "City of the arrival airport; NULL when unregistered.",
    "uf_destino": "State of the arrival airport in full; NULL when unregistered.",
    "pais_destino": "Brasil or Exterior, from the code prefix.",
    "icao_aeroporto": "Airport, ICAO code; the key of the dimension.",
    "nome_aeroporto": "Airport name; a label with the code when unregistered.",
    "municipio_aeroporto": "City of the airport; NULL when unregistered.",
    "uf_aeroporto": "State of the airport in full; NULL when unregistered.",
    "pais_aeroporto": "Brasil or Exterior, from the code prefix.",
    "no_cadastro_anac": "The airport is in the aerodrome registry.",
    # registries
    "icao": "ICAO code; blank for operators without one.",
    "sigla_iata": "Two-letter IATA code.",
    "razao_social": "Registered company name.",
    "servico": "Kind of service the operator is licensed for.",
    "cidade": "City of the seat or of the local representative.",
    "uf": "State.",
    "situacao": "Registry status.",
    "origem_cadastro": "Registry the row came from: nacional or estrangeira.",
    "ciad": "Registry number of the aerodrome.",
    "nome": "Aerodrome name as published.",
    "municipio": "City the aerodrome lies in.",
    "uf_nome": "State in full.",
    "municipio_servido": "City the aerodrome serves.",
    "uf_servido": "State of the city served.",
    "uf_servido_nome": "State of the city served, in full.",
    "latitude": "Latitude as published.",
    "longitude": "Longitude as published.",
    "latitude_dms": "Latitude in degrees, minutes and seconds, as published.",
    "longitude_dms": "Longitude in degrees, minutes and seconds, as published.",
    "altitude": "Altitude as published, decimal comma.",
    "altitude_m": "Altitude in metres.",
    "dominio": "Leg column the code belongs to.",
    "codigo": "Code as it occurs in the legs.",
    "descricao": "Code in words.",
    # audit
    "_versao": "Load number.",
    "_arquivo_origem": "File the row was read from.",
    "_ingerido_em": "Time the row was landed.",
    "_transformado_em": "Time the typed row was built.",
    "_processado_em": "Time the business row was built.",
}

SPECIAL = {
    "gold.obt_voos": {"partida_pontual": "Departed no later than planned, without tolerance."},
    "gold.obt_voos_enriquecida": {
        "nome_companhia": "Registered name of the airline; a label with the code when unregistered.",
        "descricao_di": "Authorisation code in words; a label with the code when uncatalogued.",
        "dia_semana": "Weekday of the planned departure in Portuguese, lower case.",
        "atraso_fora_de_faixa": "A delay was below -2 h or above 24 h, so the three measures were withheld.",
    },
}

TABLES = {
    ("silver", "vra"): "Typed flight legs, one for each raw row, with delays and regained minutes.",
    ("silver", "empresas"): "Airlines of both registries, each row marked with its registry.",
    ("silver", "aerodromos"): "Registered aerodromes; altitude in metres.",
    ("silver", "codigos_operacao"): "Authorisation and line-type codes in words.",
    ("gold", "obt_voos"): "Wide legs with punctuality by the clock, without tolerance.",
    ("gold", "obt_voos_enriquecida"): "Wide legs with airline, both airports and codes in words; implausible delays withheld.",
    ("gold", "dim_aeroporto"): "Every airport that a leg uses, registered or not.",
    ("gold", "fato_voos"): "Legs with airline, codes in words, punctuality at 15 minutes and calendar columns.",
}

# Tag sets of the published tables unless the build is given others.
TAGS = {
    ("silver", "vra"): {
        "camada": "silver",
        "dominio": "aviacao",
        "fonte": "ANAC-VRA",
        "grao": "etapa_de_voo",
    },
    ("silver", "empresas"): {
        "camada": "silver",
        "dominio": "aviacao",
        "fonte": "ANAC-Operador-Aereo",
        "grao": "empresa",
    },
    ("silver", "aerodromos"): {
        "camada": "silver",
        "dominio": "aviacao",
        "fonte": "ANAC-Aerodromos",
        "grao": "aerodromo",
    },
    ("silver", "codigos_operacao"): {
        "camada": "silver",
        "dominio": "aviacao",
        "fonte": "ANAC-seed",
        "grao": "codigo",
    },
    ("gold", "obt_voos"): {
        "camada": "gold",
        "dominio": "aviacao",
        "consumo": "perguntas",
        "grao": "etapa_de_voo",
        "padrao": "obt",
    },
    ("gold", "obt_voos_enriquecida"): {
        "camada": "gold",
        "dominio": "aviacao",
        "consumo": "perguntas",
        "grao": "etapa_de_voo",
        "padrao": "obt",
    },
    ("gold", "fato_voos"): {
        "camada": "gold",
        "dominio": "aviacao",
        "consumo": "bi",
        "grao": "etapa_de_voo",
        "padrao": "fato",
    },
    ("gold", "dim_aeroporto"): {
        "camada": "gold",
        "dominio": "aviacao",
        "consumo": "bi",
        "grao": "aeroporto",
        "padrao": "dimensao",
    },
}


def comments_for(table: str, columns: Sequence[str]) -> Mapping[str, str]:
    """Descriptions of the columns a table really has."""
    own = SPECIAL.get(table, {})
    return {c: own.get(c, GLOSSARY.get(c)) for c in columns if own.get(c, GLOSSARY.get(c))}
