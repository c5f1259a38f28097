"""The source files: their header names, the names they land under, and how they are written."""

from __future__ import annotations

# Header text of each file -> column of the raw table.
FLIGHT_COLUMNS = {
    "ICAO Empresa Aérea": "icao_empresa",
    "Número Voo": "numero_voo",
    "Código Autorização (DI)": "codigo_di",
    "Código Tipo Linha": "codigo_tipo_linha",
    "ICAO Aeródromo Origem": "icao_origem",
    "ICAO Aeródromo Destino": "icao_destino",
    "Partida Prevista": "partida_prevista",
    "Partida Real": "partida_real",
    "Chegada Prevista": "chegada_prevista",
    "Chegada Real": "chegada_real",
    "Situação Voo": "situacao_voo",
    "Código Justificativa": "codigo_justificativa",
}

AERODROME_COLUMNS = {
    "Código OACI": "icao",
    "CIAD": "ciad",
    "Nome": "nome",
    "Município": "municipio",
    "UF": "uf",
    "Município Servido": "municipio_servido",
    "UF Servido": "uf_servido",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Altitude": "altitude",
    "Situação": "situacao",
}

AIRLINE_COLUMNS = {
    "ICAO": "icao",
    "Estrangeira": "sigla_iata",
    "Razao": "razao_social",
    "Servico": "servico",
    "Cidade": "cidade",
    "UF": "uf",
    "Ativa": "situacao",
}

FLIGHT_FILE = {"columns": FLIGHT_COLUMNS, "quote": '"', "escape": '"', "encoding": "UTF-8"}
# Latitudes are written with a double quote for seconds of arc, so quoting is off.
AERODROME_FILE = {"columns": AERODROME_COLUMNS, "quote": None, "encoding": "ISO-8859-1"}
AIRLINE_FILE = {"columns": AIRLINE_COLUMNS, "quote": '"', "encoding": "UTF-8"}
