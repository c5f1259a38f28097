"""DuckDB statements over the plain tables; they share no code with the Spark side.

Each statement is a WITH list of the base relations it needs followed by its own body.
"""

from __future__ import annotations

RAW_LEGS = """
raw_legs AS (
  SELECT event_id,
    CASE WHEN user_id % 10 = 9 THEN 'X' || user_id ELSE CAST(user_id AS VARCHAR) END AS icao_empresa,
    lpad(CAST(event_id % 1000 AS VARCHAR), 4, '0') AS numero_voo,
    substr('0234679DE1', CAST(event_id % 10 AS INT) + 1, 1) AS codigo_di,
    substr('NCIGZ', CAST(event_id % 5 AS INT) + 1, 1) AS codigo_tipo_linha,
    (CASE WHEN user_id % 3 = 0 THEN 'KJ' ELSE 'SB' END) || user_id AS icao_origem,
    CASE WHEN event_id % 97 = 0 THEN ''
         ELSE (CASE WHEN event_id % 4 = 0 THEN 'KJ' ELSE 'SB' END) || (user_id + hour(ts)) END AS icao_destino,
    CASE WHEN event_id % 50 = 0 THEN 'null'
         ELSE strftime(CAST(date_trunc('hour', ts) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')
           || IF(event_id % 30 = 7, '.5', '') END AS partida_prevista,
    CASE WHEN event_type = 'error' THEN 'null'
         ELSE strftime(ts + to_minutes(CASE WHEN event_id % 211 = 0 THEN 1500 WHEN event_id % 223 = 0 THEN -300
           ELSE 0 END), '%Y-%m-%d %H:%M:%S.%f') END AS partida_real,
    strftime(date_trunc('hour', ts) + INTERVAL 60 MINUTE, '%Y-%m-%d %H:%M:%S') AS chegada_prevista,
    CASE WHEN event_type = 'error' THEN 'null'
         ELSE strftime(ts + to_minutes(CAST((event_id * 7) % 120 AS INT)), '%Y-%m-%d %H:%M:%S.%f') END AS chegada_real,
    CASE WHEN event_type = 'error' THEN 'CANCELADO' ELSE 'REALIZADO' END AS situacao_voo,
    CASE WHEN event_id % 2 = 0 THEN 'N/A' ELSE event_type END AS codigo_justificativa
  FROM events
)"""

LEGS = (
    RAW_LEGS
    + """,
timed AS (
  SELECT * REPLACE (
    TRY_CAST(NULLIF(partida_prevista, 'null') AS TIMESTAMP) AS partida_prevista,
    TRY_CAST(NULLIF(partida_real, 'null') AS TIMESTAMP) AS partida_real,
    TRY_CAST(NULLIF(chegada_prevista, 'null') AS TIMESTAMP) AS chegada_prevista,
    TRY_CAST(NULLIF(chegada_real, 'null') AS TIMESTAMP) AS chegada_real,
    NULLIF(codigo_justificativa, 'N/A') AS codigo_justificativa)
  FROM raw_legs
),
delayed AS (
  SELECT *,
    date_sub('minute', partida_prevista, partida_real) AS late_out,
    date_sub('minute', chegada_prevista, chegada_real) AS late_in
  FROM timed
),
legs AS (
  SELECT event_id, icao_empresa, numero_voo, codigo_di, codigo_tipo_linha, icao_origem, icao_destino,
    partida_prevista, CAST(partida_prevista AS DATE) AS partida_prevista_data,
    strftime(partida_prevista, '%H:%M') AS partida_prevista_hora,
    partida_real, CAST(partida_real AS DATE) AS partida_real_data,
    strftime(partida_real, '%H:%M') AS partida_real_hora,
    chegada_prevista, CAST(chegada_prevista AS DATE) AS chegada_prevista_data,
    strftime(chegada_prevista, '%H:%M') AS chegada_prevista_hora,
    chegada_real, CAST(chegada_real AS DATE) AS chegada_real_data,
    strftime(chegada_real, '%H:%M') AS chegada_real_hora,
    situacao_voo, codigo_justificativa,
    CAST(late_out AS INT) AS atraso_partida_min,
    CAST(late_in AS INT) AS atraso_chegada_min,
    CAST(late_out - late_in AS INT) AS minutos_recuperados
  FROM delayed
)"""
)

AIRLINES = """
airlines AS (
  SELECT CASE WHEN c_acctbal < -900 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS icao,
    CAST(NULL AS VARCHAR) AS sigla_iata, c_name AS razao_social, c_mktsegment AS servico,
    'Cidade ' || c_nationkey AS cidade, CAST(c_nationkey AS VARCHAR) AS uf,
    CASE WHEN c_acctbal >= 0 THEN 'ATIVA' ELSE 'INATIVA' END AS situacao,
    'nacional' AS origem_cadastro, 'nacionais.csv' AS _arquivo_origem
  FROM customer
  UNION ALL
  SELECT IF(s_suppkey % 40 = 5, '', 'X') || s_suppkey, 'S' || s_nationkey, s_name, 'REGULAR', 'Cidade ' || s_nationkey,
    CAST(s_nationkey AS VARCHAR), CASE WHEN s_acctbal >= 0 THEN 'ATIVA' ELSE 'INATIVA' END,
    'estrangeira', 'estrangeiras.csv'
  FROM supplier
)"""

AIRPORTS = """
airports AS (
  SELECT 'SB' || s_suppkey AS icao, 'C' || s_suppkey AS ciad, s_name AS nome,
    'Municipio ' || n_name AS municipio, r_name AS uf_nome, n_name AS municipio_servido,
    r_name AS uf_servido_nome, s_nationkey || '° 52'' 08" S' AS latitude_dms,
    s_nationkey || '° 04'' 11" W' AS longitude_dms,
    CASE WHEN s_acctbal < 5000 THEN CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS DOUBLE) END AS altitude_m,
    CASE WHEN s_acctbal >= 0 THEN 'Aberto' ELSE 'Fechado' END AS situacao
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

# Operation codes and their official descriptions.
CODES = """
codes(dominio, codigo, descricao) AS (
  VALUES ('codigo_di', '0', 'Etapa Regular'), ('codigo_di', '2', 'Etapa Extra'),
    ('codigo_di', '3', 'Etapa de Retorno'), ('codigo_di', '4', 'Inclusão de Etapa'),
    ('codigo_di', '6', 'Etapa Não Remunerada Sem Transporte de Objetos'),
    ('codigo_di', '7', 'Etapa de Voo de Fretamento'), ('codigo_di', '9', 'Etapa de Voo Charter'),
    ('codigo_di', 'D', 'Etapa de Voo Duplicada'),
    ('codigo_di', 'E', 'Etapa Não Remunerada Com Transporte de Objetos'),
    ('codigo_tipo_linha', 'N', 'Doméstica Mista'), ('codigo_tipo_linha', 'C', 'Doméstica Cargueira'),
    ('codigo_tipo_linha', 'I', 'Internacional Mista'), ('codigo_tipo_linha', 'G', 'Internacional Cargueira')
)"""

DIM = """
used_airports AS (
  SELECT DISTINCT code FROM (SELECT icao_origem AS code FROM legs UNION ALL SELECT icao_destino FROM legs)
  WHERE code <> ''
),
dim AS (
  SELECT code AS icao_aeroporto, COALESCE(nome, 'AEROPORTO FORA DO CADASTRO ANAC ' || code) AS nome_aeroporto,
    municipio AS municipio_aeroporto, uf_nome AS uf_aeroporto,
    IF(starts_with(code, 'SB'), 'Brasil', 'Exterior') AS pais_aeroporto,
    icao IS NOT NULL AS no_cadastro_anac
  FROM used_airports LEFT JOIN airports ON code = icao
)"""

RULED = """
ruled AS (
  SELECT *,
    CASE codigo_tipo_linha WHEN 'N' THEN 'Domestico' WHEN 'C' THEN 'Domestico'
      WHEN 'I' THEN 'Internacional' WHEN 'G' THEN 'Internacional' END AS escopo_voo,
    icao_origem || ' - ' || icao_destino AS rota,
    CAST(hour(partida_prevista) AS INT) AS hora_partida_prevista,
    lower(dayname(partida_prevista)) AS dia_semana,
    CAST(date_trunc('month', partida_prevista) AS TIMESTAMP) AS mes_referencia,
    COALESCE(situacao_voo = 'REALIZADO' AND partida_real IS NOT NULL AND partida_prevista IS NOT NULL
      AND atraso_partida_min IS NULL, FALSE) AS atraso_fora_de_faixa,
    atraso_partida_min <= 15 AS partida_pontual,
    atraso_chegada_min <= 15 AS chegada_pontual,
    situacao_voo = 'REALIZADO' AS voo_realizado,
    situacao_voo = 'CANCELADO' AS voo_cancelado
  FROM legs
)"""

CODE_USE = """
code_use AS (
  SELECT coluna, chave, COUNT(*) AS linhas FROM (
    SELECT 'codigo_di' AS coluna, codigo_di AS chave FROM raw_legs
    UNION ALL SELECT 'codigo_tipo_linha', codigo_tipo_linha FROM raw_legs)
  WHERE chave <> '' GROUP BY ALL
)"""

DESCRIBED = """
described AS (
  SELECT lang AS camada, source AS tabela, quality IS NOT NULL AS documentada
  FROM documents
  LEFT JOIN (SELECT doc_id, MAX(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)
)"""

LOADS = """
loads AS (
  SELECT CAST(day(ts) % 3 AS INT) AS _versao, ts AS _ingerido_em,
    IF(day(ts) % 3 = 0, 'create', 'load') AS _operacao
  FROM events)"""

CLOCK_PUNCTUAL = """CASE WHEN partida_real IS NOT NULL
  THEN COALESCE(partida_real <= partida_prevista, FALSE) END"""


def _with(*parts: str, body: str) -> str:
    relations = ",".join(parts)
    return (f"WITH {relations}\n" if parts else "") + body.strip()


def _clocked(body: str) -> str:
    return _with(LEGS, f"obt AS (SELECT *, {CLOCK_PUNCTUAL} AS partida_pontual FROM legs)", body=body)


def _named_rate(measures: str) -> str:
    """Measures per airline plus the least registered (name) row of that airline."""
    return _with(
        LEGS,
        RULED,
        AIRLINES,
        "names AS (SELECT icao, MIN(razao_social) AS nome_companhia FROM airlines GROUP BY icao)",
        f"rates AS (SELECT icao_empresa, {measures} FROM ruled GROUP BY icao_empresa)",
        body="SELECT rates.*, nome_companhia FROM rates LEFT JOIN names ON icao_empresa = icao",
    )


FACT_LIST = """event_id, icao_empresa, razao_social AS nome_companhia, numero_voo, codigo_di,
  (SELECT descricao FROM codes WHERE dominio = 'codigo_di' AND codigo = codigo_di) AS descricao_di,
  codigo_tipo_linha,
  (SELECT descricao FROM codes WHERE dominio = 'codigo_tipo_linha' AND codigo = codigo_tipo_linha)
    AS descricao_tipo_linha,
  escopo_voo, icao_origem, icao_destino, rota, partida_prevista, partida_prevista_data,
  partida_prevista_hora, hora_partida_prevista, dia_semana, mes_referencia, partida_real,
  chegada_prevista, chegada_real, atraso_partida_min, atraso_chegada_min, minutos_recuperados,
  atraso_fora_de_faixa, partida_pontual, chegada_pontual, ruled.situacao_voo, voo_realizado,
  voo_cancelado, origem_cadastro AS cadastro_companhia"""

OUTSIDE = (
    "COALESCE(atraso_partida_min NOT BETWEEN {low} AND {high}, FALSE)"
    " OR COALESCE(atraso_chegada_min NOT BETWEEN {low} AND {high}, FALSE)"
)

STATEMENTS: dict[str, str] = {
    # raw layer
    "bronze_vra": _with(RAW_LEGS, body="SELECT * FROM raw_legs"),
    "ingest_delimited": """
        SELECT CAST(event_id AS VARCHAR) AS id, event_type || '"q' AS tipo, CAST(NULL AS VARCHAR) AS vazio,
          CASE WHEN event_id % 3 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ';local' END AS quando
        FROM events""",
    "ingest_quote_off": """
        SELECT CAST(c_custkey AS VARCHAR) AS chave, c_nationkey || ' 52'' 08" S' AS latitude,
          '"' || c_mktsegment AS segmento
        FROM customer""",
    "seed_codes": _with(
        RAW_LEGS,
        CODES,
        CODE_USE,
        body="""SELECT dominio, codigo, descricao, COALESCE(linhas, 0) AS etapas
          FROM codes LEFT JOIN code_use ON dominio = coluna AND codigo = chave""",
    ),
    "sentinel_profile": _with(
        RAW_LEGS,
        body="""SELECT COUNT(*) AS linhas,
          CAST(SUM(IF(partida_real IS NULL, 1, 0)) AS BIGINT) AS partida_real_nula,
          CAST(SUM(IF(partida_real = 'null', 1, 0)) AS BIGINT) AS partida_real_texto_null,
          CAST(SUM(IF(partida_prevista = 'null', 1, 0)) AS BIGINT) AS partida_prevista_texto_null,
          CAST(SUM(IF(contains(partida_real, '.'), 1, 0)) AS BIGINT) AS com_fracao_de_segundo,
          CAST(SUM(IF(contains(partida_prevista, '.'), 1, 0)) AS BIGINT) AS prevista_com_fracao_de_segundo
          FROM raw_legs""",
    ),
    "file_manifest": """
        SELECT 'vra_' || strftime(ts, '%Y-%m-%d') || '.csv' AS _arquivo_origem, COUNT(*) AS linhas,
          MAX(ts) AS ingerido_em
        FROM events GROUP BY 1 ORDER BY 1""",
    # typed layer
    "silver_legs": _with(LEGS, body="SELECT * FROM legs"),
    "silver_airports": _with(AIRPORTS, body="SELECT * FROM airports"),
    "union_registries": _with(AIRLINES, body="SELECT * FROM airlines"),
    "read_times": """
        SELECT event_id,
          CASE event_id % 10 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%SZ')
            WHEN 3 THEN strftime(ts, '%Y-%m-%d %-H:%M:%S') WHEN 4 THEN strftime(ts, ' %Y-%m-%d %H:%M:%S')
            WHEN 5 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '000' WHEN 6 THEN strftime(ts, '%Y-%m-%d')
            WHEN 7 THEN strftime(ts, '%H:%M:%S') WHEN 8 THEN strftime(ts, '%Y')
            ELSE strftime(ts, '%d/%m/%Y %H:%M') END AS texto,
          CASE WHEN event_id % 10 < 5 THEN date_trunc('second', ts) WHEN event_id % 10 = 5 THEN ts
            WHEN event_id % 10 = 6 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS lido
        FROM events""",
    "parse_profile": _with(
        LEGS,
        body="""SELECT COUNT(partida_prevista) AS partida_prevista_ok, COUNT(partida_real) AS partida_real_ok,
          COUNT(chegada_prevista) AS chegada_prevista_ok, COUNT(chegada_real) AS chegada_real_ok,
          COUNT(atraso_partida_min) AS atraso_partida_min_ok, COUNT(minutos_recuperados) AS minutos_recuperados_ok
          FROM legs""",
    ),
    "row_parity": _with(
        LEGS,
        AIRLINES,
        body="""SELECT b.n AS bronze_vra, f.n AS fato_voos, b.n - f.n AS diferenca, b.keys = f.keys AS mesmas_chaves
          FROM (SELECT COUNT(*) AS n, list(event_id ORDER BY event_id) AS keys FROM raw_legs) b,
            (SELECT COUNT(*) AS n, list(event_id ORDER BY event_id) AS keys
             FROM legs LEFT JOIN airlines ON icao_empresa = icao) f""",
    ),
    "union_parity": _with(
        AIRLINES,
        body="""SELECT c.n AS bronze_nacionais, s.n AS bronze_estrangeiras, c.n + s.n AS soma_esperada,
            a.n AS silver_empresas, c.n + s.n - a.n AS diferenca
          FROM (SELECT COUNT(*) AS n FROM customer WHERE c_acctbal >= -900) c,
            (SELECT COUNT(*) AS n FROM supplier) s,
            (SELECT COUNT(DISTINCT icao) AS n FROM airlines WHERE icao <> '') a""",
    ),
    "key_coverage": """
        SELECT 'empresas_nacionais' AS tabela, COUNT(*) AS linhas,
          COUNT(*) FILTER (WHERE c_acctbal >= -900) AS com_icao FROM customer
        UNION ALL SELECT 'empresas_estrangeiras', COUNT(*), COUNT(s_suppkey) FROM supplier""",
    "registry_profile": _with(
        AIRLINES,
        body="""SELECT origem_cadastro, COUNT(*) AS linhas, COUNT(*) FILTER (WHERE icao <> '') AS com_icao
          FROM airlines GROUP BY ALL ORDER BY 1""",
    ),
    "filter_in_sorted": _with(
        AIRLINES,
        body="""SELECT icao, razao_social, servico, uf, situacao FROM airlines
          WHERE servico IN ('BUILDING', 'MACHINERY', 'REGULAR') ORDER BY servico, icao, razao_social""",
    ),
    "topk_earliest": _with(
        LEGS,
        body="""SELECT event_id, icao_empresa, numero_voo, icao_origem, icao_destino, partida_prevista,
            partida_prevista_data, partida_prevista_hora, atraso_partida_min, atraso_chegada_min,
            minutos_recuperados, situacao_voo
          FROM legs ORDER BY partida_prevista ASC NULLS FIRST, event_id LIMIT 5""",
    ),
    # business layer
    "obt_legs": _clocked("SELECT * FROM obt"),
    "dim_airport": _with(LEGS, AIRPORTS, DIM, body="SELECT * FROM dim"),
    "decode_codes": _with(
        RAW_LEGS,
        CODES,
        body="""SELECT event_id, codigo_di, d.descricao AS descricao_di, codigo_tipo_linha,
            t.descricao AS descricao_tipo_linha
          FROM raw_legs
          LEFT JOIN (FROM codes WHERE dominio = 'codigo_di') d ON codigo_di = d.codigo
          LEFT JOIN (FROM codes WHERE dominio = 'codigo_tipo_linha') t ON codigo_tipo_linha = t.codigo""",
    ),
    "fact_legs": _with(
        LEGS,
        RULED,
        AIRLINES,
        CODES,
        body=f"SELECT {FACT_LIST} FROM ruled LEFT JOIN airlines ON icao_empresa = icao",
    ),
    "obt_enriched": _with(
        LEGS,
        AIRLINES,
        AIRPORTS,
        CODES,
        DIM,
        f"""screened AS (
          SELECT * REPLACE (IF(bad, NULL, atraso_partida_min) AS atraso_partida_min,
            IF(bad, NULL, atraso_chegada_min) AS atraso_chegada_min,
            IF(bad, NULL, minutos_recuperados) AS minutos_recuperados)
          FROM (SELECT *, {OUTSIDE.format(low=-120, high=1440)} AS bad FROM legs))""",
        body="""
        SELECT s.event_id, s.icao_empresa,
          COALESCE(a.razao_social, 'COMPANHIA NAO CADASTRADA ' || s.icao_empresa) AS nome_companhia,
          s.numero_voo, s.codigo_di,
          COALESCE(d.descricao, 'CODIGO NAO CATALOGADO ' || s.codigo_di) AS descricao_di,
          s.codigo_tipo_linha,
          COALESCE(t.descricao, 'CODIGO NAO CATALOGADO ' || s.codigo_tipo_linha) AS descricao_tipo_linha,
          CASE WHEN s.codigo_tipo_linha IN ('N', 'C') THEN 'Domestico'
               WHEN s.codigo_tipo_linha IN ('I', 'G') THEN 'Internacional' END AS escopo_voo,
          s.icao_origem, o.nome_aeroporto AS nome_aeroporto_origem, o.municipio_aeroporto AS municipio_origem,
          o.uf_aeroporto AS uf_origem, o.pais_aeroporto AS pais_origem,
          s.icao_destino, e.nome_aeroporto AS nome_aeroporto_destino, e.municipio_aeroporto AS municipio_destino,
          e.uf_aeroporto AS uf_destino, e.pais_aeroporto AS pais_destino,
          s.icao_origem || ' - ' || s.icao_destino AS rota_icao,
          COALESCE(o.municipio_aeroporto, s.icao_origem) || ' - '
            || COALESCE(e.municipio_aeroporto, s.icao_destino) AS rota_municipios,
          s.partida_prevista, s.partida_prevista_data, s.partida_prevista_hora,
          CAST(hour(s.partida_prevista) AS INT) AS hora_partida_prevista,
          CASE dayofweek(s.partida_prevista) WHEN 0 THEN 'domingo' WHEN 1 THEN 'segunda-feira'
            WHEN 2 THEN 'terça-feira' WHEN 3 THEN 'quarta-feira' WHEN 4 THEN 'quinta-feira'
            WHEN 5 THEN 'sexta-feira' WHEN 6 THEN 'sábado' END AS dia_semana,
          CAST(date_trunc('month', s.partida_prevista) AS TIMESTAMP) AS mes_referencia,
          s.partida_real, s.chegada_prevista, s.chegada_real,
          s.atraso_partida_min, s.atraso_chegada_min, s.minutos_recuperados, s.bad AS atraso_fora_de_faixa,
          s.atraso_partida_min <= 15 AS partida_pontual, s.atraso_chegada_min <= 15 AS chegada_pontual,
          s.situacao_voo, s.situacao_voo = 'REALIZADO' AS voo_realizado,
          s.situacao_voo = 'CANCELADO' AS voo_cancelado
        FROM screened s
        LEFT JOIN airlines a ON s.icao_empresa = a.icao
        LEFT JOIN codes d ON d.dominio = 'codigo_di' AND d.codigo = s.codigo_di
        LEFT JOIN codes t ON t.dominio = 'codigo_tipo_linha' AND t.codigo = s.codigo_tipo_linha
        LEFT JOIN dim o ON s.icao_origem = o.icao_aeroporto
        LEFT JOIN dim e ON s.icao_destino = e.icao_aeroporto""",
    ),
    "airport_roles": _with(
        LEGS,
        AIRPORTS,
        DIM,
        body="""SELECT event_id, icao_origem, icao_destino, o.nome_aeroporto AS nome_aeroporto_origem,
            o.municipio_aeroporto AS municipio_origem, o.uf_aeroporto AS uf_origem,
            o.pais_aeroporto AS pais_origem, e.nome_aeroporto AS nome_aeroporto_destino,
            e.municipio_aeroporto AS municipio_destino, e.uf_aeroporto AS uf_destino,
            e.pais_aeroporto AS pais_destino
          FROM legs LEFT JOIN dim o ON icao_origem = o.icao_aeroporto
          LEFT JOIN dim e ON icao_destino = e.icao_aeroporto""",
    ),
    "recovery_profile": _clocked(
        """SELECT COUNT(*) AS recuperaram,
          CAST(SUM(IF(atraso_chegada_min <= 0, 1, 0)) AS BIGINT) AS no_horario_ou_antes,
          CAST(SUM(IF(atraso_chegada_min > 0, 1, 0)) AS BIGINT) AS ainda_atrasadas,
          CAST(SUM(IF(atraso_chegada_min > 15, 1, 0)) AS BIGINT) AS atrasadas_mais_de_15
        FROM obt WHERE minutos_recuperados > 0"""
    ),
    "status_profile": _clocked(
        """SELECT situacao_voo, COUNT(*) AS voos, COUNT(*) - COUNT(partida_pontual) AS partida_pontual_nula
        FROM obt GROUP BY situacao_voo"""
    ),
    # quality rules
    "dim_coverage": _with(
        LEGS,
        AIRPORTS,
        DIM,
        """used AS (
          SELECT coluna, chave, COUNT(*) AS linhas FROM (
            SELECT 'icao_origem' AS coluna, icao_origem AS chave FROM legs
            UNION ALL SELECT 'icao_destino', icao_destino FROM legs)
          WHERE chave <> '' GROUP BY ALL)""",
        body="""SELECT coluna, chave, linhas, 'dim_aeroporto' AS alvo FROM used
            WHERE chave NOT IN (SELECT icao_aeroporto FROM dim)
          UNION ALL
          SELECT coluna, chave, linhas, 'cadastro' FROM used WHERE chave NOT IN (SELECT icao FROM airports)""",
    ),
    "lookup_duplicates": _with(
        RAW_LEGS,
        AIRLINES,
        body="""SELECT icao AS chave, COUNT(*) AS linhas_cadastro,
            (SELECT COUNT(*) FROM raw_legs WHERE icao_empresa = icao) AS linhas_fato
          FROM airlines WHERE icao <> '' GROUP BY icao HAVING COUNT(*) > 1""",
    ),
    "fact_merged": _with(
        LEGS,
        RULED,
        AIRLINES,
        CODES,
        """registered AS (
          SELECT icao, MIN({'razao_social': razao_social, 'origem_cadastro': origem_cadastro}) AS least
          FROM airlines WHERE icao <> '' GROUP BY icao)""",
        """single AS (SELECT icao, least.razao_social AS razao_social, least.origem_cadastro AS origem_cadastro
          FROM registered)""",
        body=f"SELECT {FACT_LIST} FROM ruled LEFT JOIN single ON icao_empresa = icao",
    ),
    "scanned_files": """
        SELECT 'events.parquet' AS _arquivo_origem, COUNT(*) AS linhas, MAX(CAST(ts AS TIMESTAMP)) AS ingerido_em FROM events
        UNION ALL SELECT 'lineitem.parquet', COUNT(*), MAX(CAST(l_shipdate AS TIMESTAMP)) FROM lineitem
        UNION ALL SELECT 'orders.parquet', COUNT(*), MAX(CAST(o_orderdate AS TIMESTAMP)) FROM orders""",
    "table_dictionary": " UNION ALL ".join(
        f"""SELECT 'fonte' AS camada, '{t}' AS tabela, coluna, CASE WHEN coluna LIKE '%key' THEN 'chave' END AS comentario,
          (SELECT COUNT(*) FROM {t}) AS linhas, preenchidas
        FROM (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME coluna VALUE preenchidas)
        UNION ALL SELECT 'fonte', '{t}', '', 'tabela {t}', NULL, NULL"""
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    ),
    "dictionary_gaps": """
        WITH described AS (SELECT CAST(doc_id AS VARCHAR) AS coluna FROM labels WHERE quality = 1),
        columns AS (SELECT CAST(doc_id AS VARCHAR) AS coluna FROM documents WHERE n_chars < 3000)
        SELECT 'corpus' AS camada, 'documents' AS tabela, coluna, 'sem_coluna' AS falta
        FROM described WHERE coluna NOT IN (SELECT coluna FROM columns)
        UNION ALL SELECT 'corpus', 'documents', coluna, 'sem_comentario'
        FROM columns WHERE coluna NOT IN (SELECT coluna FROM described)""",
    "nation_duplicates": """
        SELECT s_nationkey AS chave, COUNT(*) AS linhas_cadastro,
          (SELECT COUNT(*) FROM customer WHERE c_nationkey = s_nationkey) AS linhas_fato
        FROM supplier GROUP BY s_nationkey HAVING COUNT(*) > 1""",
    "plausible_range": _with(
        LEGS,
        f"marked AS (SELECT *, {OUTSIDE.format(low=-30, high=90)} AS bad FROM legs)",
        body="""SELECT event_id, IF(bad, NULL, atraso_partida_min) AS atraso_partida_min,
            IF(bad, NULL, atraso_chegada_min) AS atraso_chegada_min,
            IF(bad, NULL, minutos_recuperados) AS minutos_recuperados, bad AS atraso_fora_de_faixa
          FROM marked""",
    ),
    "dedupe_exact": """
        SELECT l_orderkey, l_linenumber, MIN(l_shipdate) AS _ingerido_em
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "uncatalogued_codes": _with(
        RAW_LEGS,
        CODES,
        CODE_USE,
        body="""SELECT coluna, chave, linhas FROM code_use
          WHERE (coluna, chave) NOT IN (SELECT (dominio, codigo) FROM codes)""",
    ),
    # governance
    "doc_coverage": _with(
        DESCRIBED,
        body="""SELECT tabela, COUNT(*) AS colunas, COUNT(*) FILTER (WHERE NOT documentada) AS sem_comentario,
            ROUND(CAST(COUNT(*) FILTER (WHERE documentada) AS DOUBLE) * 100 / COUNT(*), 1) AS pct_documentado
          FROM described GROUP BY tabela ORDER BY tabela""",
    ),
    "doc_coverage_by_layer": _with(
        DESCRIBED,
        body="""SELECT camada, tabela, COUNT(*) AS colunas, COUNT(*) FILTER (WHERE NOT documentada) AS sem_comentario
          FROM described GROUP BY camada, tabela ORDER BY camada, tabela""",
    ),
    "tag_listing": """
        SELECT DISTINCT source AS tabela, 'idioma' AS etiqueta, lang AS valor
        FROM documents WHERE n_chars >= 1000 ORDER BY tabela, valor""",
    "lineage_edges": """
        SELECT DISTINCT IF(event_id % 11 = 0, '(arquivo no volume)', event_type) AS origem,
          'flight.' || user_id AS destino
        FROM events
        WHERE event_type <> 'error' AND CAST(ts AS DATE) >= DATE '2024-01-23'
        ORDER BY destino, origem""",
    "load_ledger": _with(
        LOADS,
        body="""SELECT _versao, MIN(_operacao) AS operacao, COUNT(*) AS linhas_escritas,
            MIN(_ingerido_em) AS ingerido_em
          FROM loads GROUP BY _versao ORDER BY _versao""",
    ),
    "snapshot_compare": _with(
        LOADS,
        body="""SELECT 'primeira carga' AS carga, _versao, COUNT(*) AS linhas, MIN(_ingerido_em) AS ingerido_em
            FROM loads WHERE _versao = (SELECT MIN(_versao) FROM loads) GROUP BY _versao
          UNION ALL
          SELECT 'carga atual', _versao, COUNT(*), MIN(_ingerido_em)
            FROM loads WHERE _versao = (SELECT MAX(_versao) FROM loads) GROUP BY _versao""",
    ),
    # questions
    "delay_by_hour": _with(
        LEGS,
        RULED,
        body="""SELECT hora_partida_prevista, COUNT(*) AS voos, AVG(atraso_partida_min) AS atraso_medio_min,
            COUNT(*) FILTER (WHERE atraso_partida_min > 15) AS voos_atrasados
          FROM ruled GROUP BY hora_partida_prevista""",
    ),
    "monthly_summary": _with(
        LEGS,
        RULED,
        body="""SELECT mes_referencia, COUNT(*) AS voos, COUNT(*) FILTER (WHERE voo_realizado) AS realizados,
            COUNT(*) FILTER (WHERE voo_cancelado) AS cancelados, AVG(atraso_partida_min) AS atraso_partida_medio,
            AVG(atraso_chegada_min) AS atraso_chegada_medio,
            CAST(SUM(minutos_recuperados) AS BIGINT) AS minutos_recuperados
          FROM ruled GROUP BY mes_referencia""",
    ),
    "daily_series": _with(
        LEGS,
        RULED,
        body="""SELECT partida_prevista_data, COUNT(*) AS voos, COUNT(*) FILTER (WHERE voo_cancelado) AS cancelados,
            AVG(atraso_partida_min) AS atraso_medio_min
          FROM ruled WHERE partida_prevista_data BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
          GROUP BY partida_prevista_data""",
    ),
    "route_ranking": _with(
        LEGS,
        RULED,
        body="""SELECT rota, COUNT(*) AS voos, AVG(atraso_partida_min) AS atraso_medio_min
          FROM ruled WHERE rota IS NOT NULL GROUP BY rota ORDER BY voos DESC, rota LIMIT 10""",
    ),
    "cancellation_rate": _named_rate(
        """COUNT(*) AS voos, COUNT(*) FILTER (WHERE voo_cancelado) AS cancelados,
        CAST(COUNT(*) FILTER (WHERE voo_cancelado) AS DOUBLE) / COUNT(*) AS taxa_cancelamento,
        AVG(atraso_partida_min) AS atraso_medio_min"""
    ),
    "punctuality_rate": _named_rate(
        """COUNT(partida_pontual) AS partida_avaliados, COUNT(*) FILTER (WHERE partida_pontual) AS partida_pontuais,
        CAST(COUNT(*) FILTER (WHERE partida_pontual) AS DOUBLE) / NULLIF(COUNT(partida_pontual), 0) AS partida_taxa,
        COUNT(chegada_pontual) AS chegada_avaliados, COUNT(*) FILTER (WHERE chegada_pontual) AS chegada_pontuais,
        CAST(COUNT(*) FILTER (WHERE chegada_pontual) AS DOUBLE) / NULLIF(COUNT(chegada_pontual), 0) AS chegada_taxa"""
    ),
    "scope_comparison": _with(
        LEGS,
        RULED,
        body="""SELECT escopo_voo, COUNT(*) AS voos,
            CAST(COUNT(*) FILTER (WHERE voo_cancelado) AS DOUBLE) / COUNT(*) AS taxa_cancelamento,
            CAST(COUNT(*) FILTER (WHERE partida_pontual) AS DOUBLE) / COUNT(partida_pontual) AS taxa_pontualidade,
            AVG(atraso_partida_min) AS atraso_medio_min
          FROM ruled GROUP BY escopo_voo""",
    ),
    "weekday_pattern": _with(
        LEGS,
        RULED,
        body="""SELECT dia_semana, COUNT(*) FILTER (WHERE partida_pontual) AS pontualidade_casos,
            COUNT(partida_pontual) AS pontualidade_base,
            CAST(COUNT(*) FILTER (WHERE partida_pontual) AS DOUBLE) / NULLIF(COUNT(partida_pontual), 0)
              AS pontualidade
          FROM ruled GROUP BY dia_semana""",
    ),
}
