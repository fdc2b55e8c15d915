"""The registered queries in SQL, written independently of the Spark code."""

from __future__ import annotations

from registered.fixtures import AS_OF_YEAR, WINDOW_YEARS
from tulha.operators.catalogue import CENSUS_TOPICS

OBS = """obs AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'fechados' WHEN 'O' THEN 'abertos' ELSE 'parciais' END AS agregado_id,
         o_orderpriority AS variavel, 'money' AS unidade,
         CAST(n_nationkey AS VARCHAR) AS localidade_id, n_name AS localidade_nome,
         CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y%m') END AS periodo,
         CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS valor,
         c_mktsegment AS segmento, o_orderkey, o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

PUBLISHED = """CASE o_orderkey % 19
    WHEN 0 THEN '..' WHEN 1 THEN '...' WHEN 2 THEN '-' WHEN 3 THEN 'X' WHEN 4 THEN ''
    WHEN 5 THEN 'sigilo' WHEN 6 THEN '12d' WHEN 7 THEN 'NaN'
    WHEN 8 THEN ' ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || ' '
    WHEN 9 THEN '1_' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END"""

PUBLISHED_VALUE = """CASE WHEN o_orderkey % 19 < 8 THEN NULL
    WHEN o_orderkey % 19 = 9 THEN CAST(1000 + o_orderkey % 1000 AS DOUBLE)
    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END"""

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'fechados' WHEN 'O' THEN 'abertos' ELSE 'parciais' END"


def fold(text: str) -> str:
    return f"lower(regexp_replace(strip_accents({text}), '[^\\x00-\\x7F]', '', 'g'))"


def slug(text: str) -> str:
    return f"trim(regexp_replace({fold(text)}, '[^a-z0-9]+', '_', 'g'), '_')"


def spaced(text: str) -> str:
    return f"trim(regexp_replace({fold(text)}, '[^a-z0-9]+', ' ', 'g'))"


# The nested responses before nesting: one SELECT per result.
RESPONSES = f"""flat AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS agregado_id, 'Valor' AS variavel, 'money' AS unidade,
         CAST(o_custkey AS VARCHAR) AS localidade_id, 'Cliente nº ' || o_custkey AS localidade_nome,
         strftime(o_orderdate, '%Y') AS periodo, {PUBLISHED} AS valor_publicado, {PUBLISHED_VALUE} AS valor, 1 AS resultado FROM orders
  UNION ALL
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR), 'Valor', 'money', CAST(o_custkey AS VARCHAR), 'Cliente nº ' || o_custkey,
         strftime(o_orderdate, '%Y%m'), '1.5', 1.5, 1 FROM orders
  UNION ALL
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR), 'Valor', 'money', 'BR', 'Brasil',
         strftime(o_orderdate, '%Y'), '...', NULL, 1 FROM orders
  UNION ALL
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR), 'Valor', 'money', CAST(o_custkey AS VARCHAR), 'Cliente nº ' || o_custkey,
         strftime(o_orderdate, '%Y%m'), CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), o_totalprice, 2 FROM orders
  UNION ALL
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR), 'Quantidade', 'unidades', 'BR', 'Brasil',
         strftime(o_orderdate, '%Y%m'), '1', 1.0, 3 FROM orders)"""

CATALOGUE = f"""WITH pesquisas AS (
  SELECT p_brand AS pesquisa_id,
         CASE p_type WHEN 'STANDARD' THEN 'Pesquisa da Pecuária Municipal' WHEN 'ECONOMY' THEN 'Censo Agropecuário'
                     WHEN 'MEDIUM' THEN 'Pesquisa (PPM)' WHEN 'LARGE' THEN 'Estudos Apppmx'
                     WHEN 'SMALL' THEN 'CENSO  AGROPECUÁRIO, 2017' ELSE 'Produção Agrícola Municipal' END AS pesquisa,
         unnest([
           struct_pack(id := p_partkey * 10 + 1, nome := p_name || ' – Irrigação (ha)'),
           struct_pack(id := p_partkey * 10 + 2, nome := p_name || ' e Tratores' || CASE WHEN p_size % 2 = 0 THEN ' (série encerrada)' ELSE '' END),
           struct_pack(id := p_partkey * 10 + 3, nome := p_brand || ', área colhida e preço médio de ' || p_name)]) AS a
  FROM part),
normais AS (
  SELECT pesquisa_id, pesquisa, CAST(a.id AS VARCHAR) AS agregado_id, a.nome AS nome_original,
         {spaced('pesquisa')} AS pn, {spaced('a.nome')} AS an
  FROM pesquisas),
marcadas AS (
  SELECT *, contains(pn, 'pecuaria municipal') OR regexp_matches(pn, '(^| )ppm( |$)') AS inteira,
         contains(pn, 'censo agropecuario') AS censo,
         regexp_matches(an, '{'|'.join(CENSUS_TOPICS)}') AS tema
  FROM normais)
SELECT pesquisa_id, pesquisa, agregado_id, substr('agregado_' || agregado_id || '_' || replace(an, ' ', '_'), 1, 120) AS tabela, nome_original
FROM marcadas WHERE NOT contains(an, 'serie encerrada') AND (inteira OR (censo AND tema))"""

METADATA = """meta AS (
  SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS agregado_id,
         CASE p_partkey % 6 WHEN 0 THEN 'N6' WHEN 1 THEN 'N3' WHEN 2 THEN 'N1' WHEN 3 THEN 'N2' WHEN 4 THEN 'N3' END AS nivel,
         CASE p_partkey % 4 WHEN 1 THEN '101' WHEN 2 THEN '101|102' WHEN 3 THEN '101|102|103' ELSE '' END AS variaveis,
         CASE p_partkey % 3 WHEN 1 THEN '201[all]' WHEN 2 THEN '201[all]|202[all]' END AS classificacao,
         1995 + p_size % 8 AS y
  FROM part)"""

HOURLY = """leituras AS (
  SELECT event_type AS estacao, strftime(ts, '%Y/%m/%d') AS data, strftime(ts, '%H00') AS hora,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS precipitacao_total_mm,
         CAST(max(CAST(value AS DECIMAL(18,2))) FILTER (WHERE hour(ts) <> 7) AS DOUBLE) AS temperatura_maxima_c,
         CAST(count(*) AS DOUBLE) AS umidade
  FROM events GROUP BY 1, 2, 3)"""

MONTHLY = f"""WITH {OBS}, meses AS (
  SELECT variavel, localidade_id, periodo, sum(valor) AS valor_mes,
         CAST(substr(periodo, 1, 4) AS INTEGER) * 12 + CAST(substr(periodo, 5, 2) AS INTEGER) - 1 AS m
  FROM obs WHERE length(periodo) = 6 GROUP BY ALL)"""

ORACLE_SQL: dict[str, str] = {
    "top_locations": f"""WITH {OBS}
SELECT localidade_id, localidade_nome, round(avg(valor), 4) AS media_valor FROM obs
GROUP BY ALL ORDER BY avg(valor) DESC NULLS LAST, localidade_id LIMIT 10""",
    "location_mean": f"""WITH {OBS}
SELECT localidade_id, localidade_nome, round(avg(valor), 4) AS media_valor FROM obs GROUP BY ALL""",
    "period_total": f"""WITH {OBS}
SELECT periodo, round(sum(valor), 2) AS total_valor FROM obs GROUP BY periodo ORDER BY periodo NULLS LAST""",
    "period_window": f"""WITH {OBS}
SELECT o_orderkey, localidade_id, variavel, periodo, CAST(substr(periodo, 1, 4) AS INTEGER) AS ano, valor
FROM obs WHERE CAST(substr(periodo, 1, 4) AS INTEGER) BETWEEN {AS_OF_YEAR - WINDOW_YEARS} AND {AS_OF_YEAR}""",
    "period_window_pruned": f"""WITH {OBS}
SELECT o_orderkey, localidade_id, variavel, periodo, CAST(substr(periodo, 1, 4) AS INTEGER) AS ano, valor
FROM obs WHERE CAST(substr(periodo, 1, 4) AS INTEGER) BETWEEN {AS_OF_YEAR - WINDOW_YEARS} AND {AS_OF_YEAR}""",
    "quarantine_blocks": """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 7 AS m FROM orders)
SELECT 'A' AS variavel, count(*) AS n, CAST(sum(k) AS DOUBLE) AS total FROM o WHERE m IN (0, 1, 2, 5, 6)
UNION ALL SELECT 'B', count(*), CAST(sum(k) AS DOUBLE) FROM o WHERE m IN (0, 5, 6)
UNION ALL SELECT 'estrutura inesperada ' || (1 - m), count(*), NULL FROM o WHERE m IN (0, 1) GROUP BY m
UNION ALL SELECT CASE m WHEN 3 THEN 'json ilegivel -1' ELSE 'sem variaveis -1' END, count(*), NULL FROM o WHERE m IN (3, 4) GROUP BY m""",
    "decode_references": """SELECT p_partkey, 'PRODUÇÃO &lt; ' || repeat(chr(CAST(p_partkey % 1000 + 128512 AS INTEGER)), 2) || 'Aº&semnome;&#1114112; & ' || p_name AS texto FROM part""",
    "scan_mixed_headers": """WITH p AS (
  SELECT *, p_partkey AS k, p_partkey % 3 AS m, CASE m WHEN 0 THEN 3 WHEN 1 THEN 4 ELSE 2 END AS colunas FROM part),
r AS (
  SELECT *, CASE WHEN k % 17 = 0 THEN (colunas + 1) || ' celulas para ' || colunas || ' colunas'
                 WHEN k % 19 = 0 AND m < 2 THEN 'decimal ilegivel: preco_r' END AS motivo FROM p)
SELECT CAST(k AS VARCHAR) AS codigo,
       CASE WHEN motivo IS NULL THEN p_name || CASE WHEN k % 5 = 0 THEN '; "nº" 1' ELSE '' END END AS descricao,
       CASE WHEN motivo IS NULL AND m < 2 AND k % 23 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) END AS preco_r,
       CASE WHEN motivo IS NULL AND m = 1 THEN p_brand END AS marca, motivo, true AS com_arquivo FROM r""",
    "annual_cost": """WITH custos AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS ano,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) END AS variavel,
         CASE WHEN l_linenumber <> 6 THEN CAST(l_quantity AS DECIMAL(18,4)) END AS fixo
  FROM lineitem)
SELECT ano, CAST(sum(variavel) AS DOUBLE) AS total_custo_variavel_ha, CAST(sum(fixo) AS DOUBLE) AS total_custo_fixo_ha,
       CAST(sum(variavel) + sum(fixo) AS DOUBLE) AS total_custo_ha
FROM custos GROUP BY ano ORDER BY ano NULLS LAST""",
    "slug_text": f"""SELECT doc_id, {slug('text')} AS slug, {spaced('text')} AS normalizado FROM documents""",
    "parse_observation_value": f"""SELECT o_orderkey, {PUBLISHED} AS publicado, {PUBLISHED_VALUE} AS valor FROM orders""",
    "catalog_topics": CATALOGUE,
    "flatten_observations": f"""WITH {RESPONSES}
SELECT agregado_id, variavel, unidade, localidade_id, localidade_nome, periodo, valor_publicado,
       CASE resultado
         WHEN 1 THEN 'Situação do pedido=' || o_orderstatus || '=' || {STATUS} || ';82=0=Total'
         WHEN 2 THEN 'classificacao=p=' || o_orderpriority || ';Situação do pedido=' || o_orderstatus || '=' || {STATUS} || ';SITUACAO DO PEDIDO=z=repetida'
         ELSE '' END AS dimensoes,
       valor
FROM flat JOIN orders USING (o_orderkey)""",
    "dimension_columns": f"""WITH {RESPONSES}
SELECT agregado_id, variavel, unidade, localidade_id, localidade_nome, periodo, valor,
       CASE resultado WHEN 1 THEN 'Total' END AS "82", CASE resultado WHEN 1 THEN '0' END AS "82_id",
       CASE resultado WHEN 2 THEN o_orderpriority END AS classificacao, CASE resultado WHEN 2 THEN 'p' END AS classificacao_id,
       CASE resultado WHEN 1 THEN {STATUS} WHEN 2 THEN 'repetida' END AS situacao_do_pedido,
       CASE resultado WHEN 1 THEN o_orderstatus WHEN 2 THEN 'z' END AS situacao_do_pedido_id
FROM flat JOIN orders USING (o_orderkey)""",
    "preferred_level": f"""WITH {METADATA}
SELECT agregado_id, nivel, CASE WHEN variaveis = '' THEN 'sem variaveis' WHEN nivel IS NULL THEN 'sem nivel territorial' END AS motivo FROM meta""",
    "request_specs": f"""WITH {METADATA}, pedidos AS (
  SELECT *, unnest(['1985', CAST(y AS VARCHAR), '200106', '2002']) AS periodo FROM meta WHERE variaveis <> '' AND nivel IS NOT NULL)
SELECT agregado_id, periodo, variaveis, nivel, nivel || '[all]' AS localidades, classificacao,
       '/agregados/' || agregado_id || '/periodos/' || periodo || '/variaveis/' || variaveis AS caminho
FROM pedidos WHERE CAST(substr(periodo, 1, 4) AS INTEGER) BETWEEN {AS_OF_YEAR - WINDOW_YEARS} AND {AS_OF_YEAR}""",
    "page_link_catalog": f"""WITH titulos AS (
  SELECT page_id, url AS pagina, html, {slug("replace(replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&quot;', '\"'), '&amp;', '&')")} AS categoria
  FROM pages),
ancoras AS (
  SELECT page_id, pagina, categoria, i - 1 AS position, regexp_extract_all(html, '(?s)<a href="[^"]*">.*?</a>')[i] AS a
  FROM (SELECT *, unnest(range(1, len(regexp_extract_all(html, '(?s)<a href="[^"]*">.*?</a>')) + 1)) AS i FROM titulos)),
links AS (
  SELECT page_id, position, categoria,
         trim(regexp_replace(replace(replace(regexp_extract(a, '(?s)>(.*)</a>$', 1), '&quot;', '"'), '&amp;', '&'), '^-+', '')) AS nome_original,
         regexp_extract(pagina, '^[a-z]+://[^/]+') || replace(replace(regexp_extract(a, 'href="([^"]*)"', 1), '&quot;', '"'), '&amp;', '&') AS url
  FROM ancoras)
SELECT page_id, position, categoria, {slug('nome_original')} AS tabela, nome_original, url,
       lower(regexp_extract(url, '\\.([^.]*)$', 1)) AS extensao
FROM links WHERE categoria <> '' AND nome_original <> ''""",
    "quarantine_split": """SELECT 'Valor' AS variavel, 4 * count(*) AS n_linhas, CAST(NULL AS VARCHAR) AS motivo FROM orders WHERE o_orderkey % 23 > 4
UNION ALL SELECT 'Quantidade', count(*), NULL FROM orders WHERE o_orderkey % 23 > 4
UNION ALL
SELECT 'rejeitada', count(*), CASE o_orderkey % 23 WHEN 0 THEN 'vazio' WHEN 1 THEN 'vazio' WHEN 2 THEN 'sem variaveis'
       WHEN 3 THEN 'estrutura inesperada' ELSE 'json ilegivel' END AS motivo
FROM orders WHERE o_orderkey % 23 <= 4 GROUP BY 3""",
    "scan_semicolon_latin1": """SELECT c_custkey AS identificacao_armazem, 'Armazém nº ' || c_custkey AS nome_armazem, c_mktsegment AS uf,
       c_acctbal AS qtd_capacidade_estatica_t, c_nationkey AS col_2o_codigo, c_nationkey AS codigo, c_nationkey AS codigo_2
FROM customer""",
    "scan_csv": """SELECT p_partkey, p_name || ', "tipo" ' || p_type AS descricao, p_size AS tamanho, p_retailprice AS preco_r FROM part""",
    "parse_decimal_comma": """SELECT l_orderkey AS pedido, l_linenumber AS linha,
       CASE WHEN l_linenumber < 6 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS preco_r,
       CASE WHEN l_linenumber <> 5 THEN CAST(CAST(l_discount AS DECIMAL(18,2)) AS DOUBLE) END AS desconto,
       l_returnflag AS situacao
FROM lineitem""",
    "scan_utf16_tab": """SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderpriority AS uf, 'nº ' || o_orderkey AS serie,
       o_totalprice AS quantidade_mil_t FROM orders""",
    "scan_utf16_split": """SELECT l_orderkey AS pedido, l_linenumber AS linha, 'nº' || chr(9) || l_returnflag AS via,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS preco_r FROM lineitem""",
    "station_files_union": f"""WITH {HOURLY}
SELECT data, hora || ' UTC' AS hora_utc, precipitacao_total_mm, temperatura_maxima_c, umidade, estacao FROM leituras""",
    "archive_members": f"""WITH {HOURLY}
SELECT data, hora || ' UTC' AS hora_utc, precipitacao_total_mm, temperatura_maxima_c, umidade,
       estacao || '_' || replace(data, '/', '-') || '.CSV' AS arquivo_origem FROM leituras""",
    "climate_daily": f"""WITH {HOURLY}
SELECT estacao, data, count(*) AS n_leituras,
       min(precipitacao_total_mm) AS precipitacao_total_mm_min, max(precipitacao_total_mm) AS precipitacao_total_mm_max,
       round(avg(precipitacao_total_mm), 6) AS precipitacao_total_mm_media, round(sum(precipitacao_total_mm), 2) AS precipitacao_total_mm_soma,
       min(temperatura_maxima_c) AS temperatura_maxima_c_min, max(temperatura_maxima_c) AS temperatura_maxima_c_max,
       round(avg(temperatura_maxima_c), 6) AS temperatura_maxima_c_media, round(sum(temperatura_maxima_c), 2) AS temperatura_maxima_c_soma
FROM leituras GROUP BY estacao, data""",
    "climate_monthly": f"""WITH {HOURLY}
SELECT estacao, replace(substr(data, 1, 7), '/', '') AS mes, count(*) AS n_leituras,
       min(precipitacao_total_mm) AS precipitacao_total_mm_min, max(precipitacao_total_mm) AS precipitacao_total_mm_max,
       round(avg(precipitacao_total_mm), 4) AS precipitacao_total_mm_media, round(sum(precipitacao_total_mm), 2) AS precipitacao_total_mm_soma,
       min(temperatura_maxima_c) AS temperatura_maxima_c_min, max(temperatura_maxima_c) AS temperatura_maxima_c_max,
       round(avg(temperatura_maxima_c), 4) AS temperatura_maxima_c_media, round(sum(temperatura_maxima_c), 2) AS temperatura_maxima_c_soma,
       min(umidade) AS umidade_min, max(umidade) AS umidade_max, round(avg(umidade), 4) AS umidade_media, round(sum(umidade), 2) AS umidade_soma
FROM leituras GROUP BY ALL""",
    "union_by_name": """SELECT event_id, user_id, value, CAST(NULL AS VARCHAR) AS props, 'click.csv' AS arquivo_origem FROM events WHERE event_type = 'click'
UNION ALL BY NAME SELECT event_id, props, 'error.csv' AS arquivo_origem FROM events WHERE event_type = 'error'
UNION ALL BY NAME SELECT event_id, value, props, 'purchase.csv' AS arquivo_origem FROM events WHERE event_type = 'purchase'
UNION ALL BY NAME SELECT event_id, user_id, 'signup.csv' AS arquivo_origem FROM events WHERE event_type = 'signup'
UNION ALL BY NAME SELECT event_id, user_id, props, 'view.csv' AS arquivo_origem FROM events WHERE event_type = 'view'""",
    "evolve_create_append": """SELECT *, CASE WHEN s_suppkey % 2 = 0 THEN 'c1' ELSE 'c2' END AS carga FROM supplier""",
    "evolve_add_column": """SELECT *, CASE WHEN s_suppkey % 2 = 0 THEN 'c1' ELSE 'c2' END AS carga,
       CASE WHEN s_suppkey % 2 = 1 THEN upper(s_name) END AS "2_nome",
       CASE WHEN s_suppkey % 2 = 1 THEN round(s_acctbal / 1000, 3) END AS saldo_mil FROM supplier""",
    "evolve_missing_column": """SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS s_acctbal,
       CASE WHEN s_suppkey % 2 = 0 THEN 'c1' ELSE 'c2' END AS carga FROM supplier""",
    "evolve_type_conflict": """SELECT s_suppkey, s_name, s_nationkey, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS s_acctbal,
       CASE WHEN s_suppkey % 2 = 0 THEN 'c1' ELSE 'c2' END AS carga,
       CASE WHEN s_suppkey % 2 = 0 THEN 'backup' ELSE 'atual' END AS origem FROM supplier""",
    "ingest_landed_files": """SELECT CAST(p_partkey AS VARCHAR) AS codigo, p_name AS descricao,
       CASE WHEN p_partkey % 2 = 1 THEN p_brand END AS marca_uf,
       CASE WHEN p_partkey % 2 = 0 THEN 'c1.txt' ELSE 'c2.txt' END AS _source_file,
       CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2024-01-01 06:00:00' ELSE TIMESTAMP '2024-01-02 06:00:00' END AS _ingest_ts,
       CASE WHEN p_partkey % 2 = 0 THEN 'c1' ELSE 'c2' END AS _batch_id FROM part""",
    "ingest_listing": """SELECT 'armazens' AS table_name, count(*) AS n_rows, 2 AS n_columns, 0.0::DOUBLE AS null_ratio, TIMESTAMP '2024-01-01 06:00:00' AS last_ingest_ts FROM customer
UNION ALL SELECT 'precos', count(*), 3, 0.0, TIMESTAMP '2024-01-01 06:00:00' FROM part
UNION ALL SELECT 'capacidade', count(*), 2, 0.0, TIMESTAMP '2024-01-01 06:00:00' FROM orders""",
    "observations_by_dataset": f"""WITH {OBS}
SELECT agregado_id, segmento, count(*) AS n, round(sum(valor), 2) AS total FROM obs GROUP BY ALL""",
    "ingest_landed_responses": f"""WITH {RESPONSES}
SELECT 'pedidos_' || (o_orderkey % 10) AS agregado_id, CAST(NULL AS VARCHAR) AS motivo, count(*) AS n_linhas, round(sum(valor), 2) AS total_valor
FROM flat WHERE o_orderkey % 23 NOT IN (2, 4) GROUP BY 1
UNION ALL
SELECT 'pedidos_' || (o_orderkey % 10), CASE o_orderkey % 23 WHEN 2 THEN 'sem variaveis' ELSE 'json ilegivel' END, count(*), NULL
FROM orders WHERE o_orderkey % 23 IN (2, 4) GROUP BY 1, 2""",
    "ingest_incremental": """WITH o AS (
  SELECT *, o_orderkey % 4 // 2 AS corrida, o_orderkey % 4 >= 2 AND o_orderkey % 101 = 0 AS ruim FROM orders),
n AS (SELECT corrida, count(*) FILTER (NOT ruim) AS n_linhas, count(*) FILTER (ruim) AS n_rejeitadas FROM o GROUP BY corrida)
SELECT CAST(o_orderkey AS VARCHAR) AS codigo, CAST(o_custkey AS VARCHAR) AS cliente, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS preco_r,
       CASE WHEN corrida = 1 THEN o_orderstatus END AS o_orderstatus, CAST(corrida AS BIGINT) AS _lote,
       TIMESTAMP '2024-01-01 06:00:00' + INTERVAL 1 DAY * CAST(corrida AS INTEGER) AS _ingest_ts, n_linhas, n_rejeitadas, 'novos,novos,nada' AS corridas
FROM o JOIN n USING (corrida) WHERE NOT ruim""",
    "reconciled_responses": """WITH r AS (
  SELECT o_orderkey AS k, o_orderkey % 2 AS corrida,
         CASE o_orderkey % 7 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 0 ELSE 2 END AS bons,
         CASE WHEN o_orderkey % 7 IN (0, 2, 3) THEN 1 ELSE 0 END AS ruins FROM orders)
SELECT CAST(corrida AS BIGINT) AS _lote, count(*) AS n_respostas, CAST(sum(bons + ruins) AS BIGINT) AS n_esperados, CAST(sum(bons) AS BIGINT) AS n_carregados,
       CAST(sum(ruins) AS BIGINT) AS n_rejeitados, CAST(sum(bons) AS BIGINT) AS n_linhas, CAST(sum(bons * k) AS DOUBLE) AS total, CAST(sum(ruins) AS BIGINT) AS n_na_quarentena
FROM r GROUP BY corrida""",
    "silver_incremental": """WITH o AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3 DESC, o_orderkey DESC) AS n FROM orders WHERE o_orderkey % 13 <> 0)
SELECT CAST(o_custkey AS VARCHAR) AS cliente, o_orderkey AS pedido, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valor, 'lote-' || o_orderkey % 3 AS lote,
       (SELECT count(*) FROM orders WHERE o_orderkey % 13 = 0) AS n_rejeitadas
FROM o WHERE n = 1""",
    "compact_small_only": """SELECT c_mktsegment, count(*) AS n_linhas, CAST(sum(c_custkey) AS BIGINT) AS soma,
       CAST(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 3 ELSE 1 END AS BIGINT) AS arquivos_antes, CAST(1 AS BIGINT) AS arquivos_depois,
       c_mktsegment IN ('BUILDING', 'MACHINERY') AS reescrita
FROM customer GROUP BY c_mktsegment""",
    "compact_table": """SELECT * FROM customer""",
    "compact_twice": """SELECT *, 'parquet c_mktsegment zstd' AS layout FROM customer""",
    "ingest_ghost_table": """SELECT *, 'recover c_mktsegment' AS caminho FROM customer""",
    "silver_flow": """WITH o AS (SELECT *, o_orderkey % 13 = 0 AS ruim, o_orderkey % 2 AS n FROM orders)
SELECT 'prata' AS parte, 'carga' || n || '.csv' AS chave, count(*) AS n FROM o WHERE NOT ruim GROUP BY o.n
UNION ALL SELECT 'rejeitadas', 'valor', count(*) FROM o WHERE ruim
UNION ALL SELECT 'linhagem', 'bronze carga' || n || '.csv c' || n, count(*) FROM o GROUP BY o.n
UNION ALL SELECT 'linhagem', 'silver carga' || n || '.csv c' || n, count(*) FROM o WHERE NOT ruim GROUP BY o.n
UNION ALL SELECT 'observado', 'n_linhas', count(*) FROM o WHERE NOT ruim
UNION ALL SELECT 'observado', 'n_sem_lote', 0""",
    "missing_items_gaps": """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997)""",
    "stream_out_of_order": """SELECT date_trunc('hour', ts) AS inicio, date_trunc('hour', ts) + INTERVAL 1 HOUR AS fim, event_type, count(*) AS n_leituras,
       min(value) AS minimo, max(value) AS maximo, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS soma, CAST(arquivos AS INTEGER) AS arquivos
FROM events, (VALUES (1), (1000)) AS t(arquivos) GROUP BY ALL""",
    "star_fact_unknown": f"""WITH {OBS}, v AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN localidade_nome END AS localidade_nome, CASE WHEN o_orderkey % 5 <> 0 THEN periodo END AS periodo,
         CASE WHEN o_orderkey % 7 <> 0 THEN variavel END AS variavel, unidade, agregado_id, valor FROM obs)
SELECT localidade_nome, CAST(substr(periodo, 1, 4) AS INTEGER) AS ano, variavel, unidade, agregado_id,
       count(*) AS n_fatos, round(sum(valor), 2) AS total_valor FROM v GROUP BY ALL""",
    "nearest_site_crowded": """WITH p AS (
  SELECT c_custkey AS ponto_id, -33.0 + (c_custkey * 7919 % 38000) / 1000.0 AS la, -74.0 + (c_custkey * 104729 % 39000) / 1000.0 AS lo FROM customer),
s AS (
  SELECT s_suppkey AS local_id, (s_suppkey * 7919 % 1000) / 10000.0 - 23.5 AS lb, (s_suppkey * 613 % 1000) / 10000.0 - 46.6 AS lp FROM supplier),
d AS (
  SELECT ponto_id, local_id, 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(lb - la) / 2), 2)
         + cos(radians(la)) * cos(radians(lb)) * pow(sin(radians(lp - lo) / 2), 2)))) AS km
  FROM p, s)
SELECT ponto_id, local_id, round(km, 3) AS distancia_km FROM d
QUALIFY row_number() OVER (PARTITION BY ponto_id ORDER BY km, local_id) = 1""",
    "reference_refresh": """SELECT p_partkey, upper(p_name) AS nome, p_size FROM part""",
    "table_inventory": """SELECT 'fornecedor' AS table_name, count(*) AS n_rows, 4 AS n_columns, 0.0::DOUBLE AS null_ratio, TIMESTAMP '2024-01-02 03:00:00' AS last_ingest_ts FROM supplier
UNION ALL SELECT 'cliente', count(*), 5, 0.0, TIMESTAMP '2024-01-03 03:00:00' FROM customer
UNION ALL SELECT 'pedido', count(*), 6, round(count(*) FILTER (WHERE o_orderkey % 17 = 0) / (count(*) * 6), 6), TIMESTAMP '2024-01-04 03:00:00' FROM orders""",
    "silver_typed": """SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS valor,
       CASE WHEN o_orderkey % 29 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS data,
       CASE WHEN o_orderkey % 31 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS ano,
       concat_ws(',', CASE WHEN o_orderkey % 13 = 0 THEN 'valor' END, CASE WHEN o_orderkey % 29 = 0 THEN 'data' END) AS rejeitadas
FROM orders""",
    "silver_dedup": f"""WITH {OBS}
SELECT agregado_id, variavel, localidade_id, periodo, segmento, valor, 'arquivo_' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS arquivo
FROM obs QUALIFY row_number() OVER (PARTITION BY agregado_id, variavel, localidade_id, periodo, segmento ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "gold_state_year": f"""WITH {OBS}, somas AS (
  SELECT localidade_nome AS uf, CAST(substr(periodo, 1, 4) AS INTEGER) AS ano,
         sum(valor) FILTER (WHERE variavel = '1-URGENT') AS producao, sum(valor) FILTER (WHERE variavel = '2-HIGH') AS area
  FROM obs GROUP BY ALL)
SELECT uf, ano, round(producao, 2) AS producao, round(area, 2) AS area, round(producao / nullif(area, 0), 6) AS rendimento FROM somas""",
    "gold_partitioned": f"""WITH {OBS}, somas AS (
  SELECT localidade_nome AS uf, CAST(substr(periodo, 1, 4) AS INTEGER) AS ano,
         sum(valor) FILTER (WHERE variavel = '1-URGENT') AS producao, sum(valor) FILTER (WHERE variavel = '2-HIGH') AS area
  FROM obs GROUP BY ALL)
SELECT uf, ano, round(producao, 2) AS producao, round(area, 2) AS area, round(producao / nullif(area, 0), 6) AS rendimento
FROM somas WHERE ano >= 1998""",
    "clustered_layout": f"""WITH {OBS} SELECT o_orderkey, CAST(periodo[1:4] AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
       localidade_nome, variavel, valor FROM obs WHERE variavel = '2-HIGH'""",
    "layer_codecs": """SELECT camada, codec, (SELECT count(*) FROM supplier) AS n_linhas
FROM (VALUES ('bronze', 'snappy'), ('silver', 'snappy'), ('gold', 'zstd')) AS t(camada, codec)""",
    "star_fact": f"""WITH {OBS}
SELECT localidade_nome, CAST(substr(periodo, 1, 4) AS INTEGER) AS ano, variavel, unidade, agregado_id,
       count(*) AS n_fatos, round(sum(valor), 2) AS total_valor FROM obs GROUP BY ALL""",
    "orphan_facts": f"""WITH {OBS}
SELECT o_orderkey, localidade_id, periodo, valor FROM obs
WHERE CAST(localidade_id AS INTEGER) IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')""",
    "feature_lags": f"""{MONTHLY}, clima AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS localidade_id, strftime(l_shipdate, '%Y%m') AS periodo,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS chuva_mm
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT a.localidade_id, a.periodo, a.variavel, round(a.valor_mes, 2) AS valor_mes,
       round((SELECT b.valor_mes FROM meses b WHERE b.variavel = a.variavel AND b.localidade_id = a.localidade_id AND b.m = a.m - 1), 2) AS mes_anterior,
       round((SELECT b.valor_mes FROM meses b WHERE b.variavel = a.variavel AND b.localidade_id = a.localidade_id AND b.m = a.m - 12), 2) AS ano_anterior,
       round((SELECT avg(b.valor_mes) FROM meses b WHERE b.variavel = a.variavel AND b.localidade_id = a.localidade_id AND b.m BETWEEN a.m - 2 AND a.m), 4) AS media_3_meses,
       c.chuva_mm
FROM meses a LEFT JOIN clima c ON a.localidade_id = c.localidade_id AND a.periodo = c.periodo""",
    "pseudonymised": """SELECT c_custkey, sha256('sal-de-teste' || c_name) AS c_name, c_mktsegment FROM customer""",
    "nearest_site": """WITH p AS (
  SELECT c_custkey AS ponto_id, -33.0 + (c_custkey * 7919 % 38000) / 1000.0 AS la, -74.0 + (c_custkey * 104729 % 39000) / 1000.0 AS lo FROM customer),
s AS (
  SELECT s_suppkey AS local_id, -33.0 + (s_suppkey * 3571 % 38000) / 1000.0 AS lb, -74.0 + (s_suppkey * 6133 % 39000) / 1000.0 AS lp FROM supplier),
d AS (
  SELECT ponto_id, local_id, 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(lb - la) / 2), 2)
         + cos(radians(la)) * cos(radians(lb)) * pow(sin(radians(lp - lo) / 2), 2)))) AS km
  FROM p, s)
SELECT ponto_id, local_id, round(km, 3) AS distancia_km FROM d
QUALIFY row_number() OVER (PARTITION BY ponto_id ORDER BY km, local_id) = 1""",
    "completeness": """WITH e AS (SELECT strftime(o_orderdate, '%Y%m') AS periodo, count(*) AS n FROM orders GROUP BY 1),
c AS (SELECT strftime(l_shipdate, '%Y%m') AS periodo, count(*) AS n FROM lineitem GROUP BY 1)
SELECT periodo, coalesce(e.n, 0) AS n_esperado, coalesce(c.n, 0) AS n_carregado,
       CASE WHEN e.n IS NULL THEN 'inesperado' WHEN c.n IS NULL THEN 'ausente' WHEN c.n < e.n THEN 'parcial'
            WHEN c.n > e.n THEN 'excedente' ELSE 'completo' END AS situacao
FROM e FULL JOIN c USING (periodo)""",
    "missing_items": """SELECT p_partkey, p_brand FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)""",
    "load_kpis": """SELECT strftime(ts, '%Y-%m-%d') AS dia, count(*) AS n_execucoes, count(*) FILTER (WHERE event_type = 'error') AS n_falhas,
       max(ts) FILTER (WHERE event_type <> 'error') AS ultima_carga,
       round(count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS taxa_falha,
       count(*) FILTER (WHERE event_type = 'error') / count(*) < 0.05 AS dentro_da_meta,
       date_sub('hour', max(ts) FILTER (WHERE event_type <> 'error'), TIMESTAMP '2024-02-01 06:00:00') AS atraso_horas
FROM events GROUP BY 1""",
    "quality_report": f"""WITH {OBS}, t AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE valor IS NULL) AS f1, count(*) FILTER (WHERE NOT regexp_matches(periodo, '^[0-9]{{4}}(0[1-9]|1[0-2])?$')) AS f2,
         count(*) FILTER (WHERE length(periodo) <> 6) AS f3, count(*) FILTER (WHERE valor IS NULL OR valor < 1000 OR valor > 400000) AS f4,
         count(*) FILTER (WHERE substr(periodo, 1, 4) <> strftime(o_orderdate, '%Y')) AS f5
  FROM obs),
r AS (SELECT n, unnest([struct_pack(a := 'valor_presente', b := 'completude', c := 'valor', f := f1),
                        struct_pack(a := 'periodo_valido', b := 'validade', c := 'periodo', f := f2),
                        struct_pack(a := 'periodo_mensal', b := 'validade', c := 'periodo', f := f3),
                        struct_pack(a := 'valor_plausivel', b := 'validade', c := 'valor', f := f4),
                        struct_pack(a := 'ano_do_pedido', b := 'consistencia', c := 'periodo', f := f5)]) AS x FROM t)
SELECT x.a AS regra, x.b AS tipo, x.c AS coluna, n AS n_linhas, x.f AS n_falhas, round(1 - x.f / n, 6) AS taxa_aprovacao FROM r""",
    "contract_violations": """WITH t AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 13 = 0) AS bad, count(*) FILTER (WHERE o_orderkey % 11 = 0) AS empty FROM orders)
SELECT n AS n_linhas, x.c AS coluna, x.r AS regra, x.v AS n_violacoes
FROM (SELECT n, unnest([struct_pack(c := 'pedido', r := 'tipo', v := 0), struct_pack(c := 'pedido', r := 'obrigatorio', v := 0),
                        struct_pack(c := 'valor', r := 'tipo', v := bad), struct_pack(c := 'valor', r := 'obrigatorio', v := 0),
                        struct_pack(c := 'data', r := 'tipo', v := 0), struct_pack(c := 'data', r := 'obrigatorio', v := empty),
                        struct_pack(c := 'uf', r := 'tipo', v := 0), struct_pack(c := 'uf', r := 'obrigatorio', v := n)]) AS x FROM t)""",
    "series_anomalies": f"""{MONTHLY}, z AS (
  SELECT *, (valor_mes - avg(valor_mes) OVER w) / nullif(stddev_samp(valor_mes) OVER w, 0) AS z FROM meses
  WINDOW w AS (PARTITION BY variavel, localidade_id))
SELECT variavel, localidade_id, periodo, round(valor_mes, 2) AS valor_mes, round(z, 4) AS z FROM z WHERE abs(z) > 2""",
    "lineage": """WITH b AS (SELECT event_type || '.json' AS _source_file, strftime(ts, '%Y%m%d') AS _batch_id, ts, event_id, user_id, event_type FROM events),
s AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT _source_file, _batch_id, count(*) AS n_linhas, max(ts) AS carregado_em, 'bronze' AS camada FROM b GROUP BY 1, 2
UNION ALL SELECT _source_file, _batch_id, count(*), max(ts), 'silver' FROM s GROUP BY 1, 2""",
    "series_fences": f"""WITH {OBS}, m AS (
  SELECT variavel, localidade_id, periodo, sum(valor) AS valor_mes FROM obs WHERE length(periodo) = 6 GROUP BY ALL),
q AS (SELECT variavel, localidade_id, quantile_disc(valor_mes, 0.25) AS q1, quantile_disc(valor_mes, 0.75) AS q3 FROM m GROUP BY ALL),
c AS (SELECT *, q1 - 1.5 * (q3 - q1) AS cerca_inferior, q3 + 1.5 * (q3 - q1) AS cerca_superior FROM q)
SELECT variavel, localidade_id, periodo, round(valor_mes, 4) AS valor_mes, round(q1, 4) AS q1, round(q3, 4) AS q3,
       round(cerca_inferior, 4) AS cerca_inferior, round(cerca_superior, 4) AS cerca_superior
FROM m JOIN c USING (variavel, localidade_id) WHERE valor_mes < cerca_inferior OR valor_mes > cerca_superior""",
    "lineage_closure": """WITH RECURSIVE b AS (
  SELECT *, strftime(ts, '%Y%m%d') AS dia, strftime(ts, '%Y%m-%d')[1:8] AS lote FROM events),
l AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1),
e AS (
  SELECT DISTINCT 'fonte:' || event_type || '.json' AS de, 'raw:' || event_type || '/' || dia AS para FROM b
  UNION SELECT 'raw:' || event_type || '/' || dia, 'bronze:' || lote FROM b
  UNION SELECT 'bronze:' || lote, 'silver:' || event_type FROM l
  UNION SELECT 'silver:' || event_type, 'gold:' || CASE event_type WHEN 'error' THEN 'falhas' ELSE 'uso' END FROM l),
c(de, para, passos) AS (SELECT de, para, 1 FROM e UNION SELECT c.de, e.para, passos + 1 FROM c JOIN e ON c.para = e.de)
SELECT de, para, CAST(min(passos) AS INTEGER) AS passos FROM c WHERE para LIKE 'gold:%' GROUP BY de, para""",
    "stream_hourly": """WITH h AS (
  SELECT date_trunc('hour', ts) AS inicio, date_trunc('hour', ts) + INTERVAL 1 HOUR AS fim, event_type, count(*) AS n_leituras,
         min(value) AS minimo, max(value) AS maximo, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS soma
  FROM events GROUP BY ALL)
SELECT * FROM h WHERE fim <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "contract_resolution": """SELECT o_orderkey AS pedido, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_custkey AS DOUBLE) END AS cliente, o_orderstatus AS situacao, 'BRL' AS moeda,
       'pedido=promovida,cliente=promovida,valor=recusada,situacao=compativel,moeda=preenchida,uf=recusada,prioridade=ignorada' AS pareceres
FROM orders""",
    "stream_sliding": """WITH h AS (
  SELECT inicio, inicio + INTERVAL 1 HOUR AS fim, event_type, count(*) AS n_leituras,
         min(value) AS minimo, max(value) AS maximo, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS soma
  FROM (SELECT *, time_bucket(INTERVAL 30 MINUTES, ts) - INTERVAL 30 MINUTES * CAST(i AS INTEGER) AS inicio FROM events, range(2) t(i)) GROUP BY ALL)
SELECT * FROM h WHERE fim <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "stream_sessions": """WITH e AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS nova FROM events),
s AS (SELECT *, sum(nova) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sessao FROM e)
SELECT user_id, min(ts) AS inicio, max(ts) + INTERVAL 6 HOUR AS fim, count(*) AS n_leituras, min(value) AS minimo, max(value) AS maximo,
       CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS soma
FROM s GROUP BY user_id, sessao HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "stream_dedup": """SELECT * FROM events""",
}
