"""For each query, the same result as one SQL statement over the given tables."""

ORDER_SERIES = """
SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS serie_codigo,
       o_orderpriority AS serie_nome,
       CAST(o_orderdate AS DATE) AS data,
       round(o_totalprice * 100) AS valor
FROM orders
"""

CUSTOMER_SERIES = """
SELECT o_custkey AS serie_codigo,
       'cliente_' || o_custkey AS serie_nome,
       CAST(o_orderdate AS DATE) AS data,
       CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE round(o_totalprice * 100) END AS valor
FROM orders
"""

LINEITEM_SERIES = """
SELECT ascii(l_returnflag) AS serie_codigo,
       l_returnflag AS serie_nome,
       CAST(l_shipdate AS DATE) AS data,
       round(l_extendedprice * 100) AS valor
FROM lineitem
"""

EVENT_SERIES = """
SELECT user_id AS serie_codigo,
       CASE WHEN event_type = 'view' AND value < 5 THEN NULL ELSE event_type END AS serie_nome,
       CASE WHEN event_type = 'signup' AND value < 5 THEN NULL ELSE CAST(ts AS DATE) END AS data,
       CASE WHEN event_type = 'error' AND value < 5 THEN NULL
            WHEN event_type = 'click' AND value < 5 THEN CAST('nan' AS DOUBLE)
            ELSE value END AS valor
FROM events
"""

EVENT_BOUNDS = """
SELECT * FROM (VALUES ('click', 0, 100), ('purchase', 1, 250), ('error', 2, 150))
  AS b(serie_nome, minimo, maximo)
"""

CUSTOMER_PAGES = """
SELECT o_custkey AS codigo,
       'cliente_' || o_custkey AS nome,
       CAST(o_orderdate AS DATE) AS janela_inicio,
       o_orderkey AS pagina,
       CASE WHEN o_orderstatus = 'P' AND o_totalprice > 480000 THEN 'http_status' END AS erro,
       strftime(o_orderdate, '%d/%m/%Y') || '=' || texto || '|'
         || strftime(CAST(o_orderdate AS DATE) + 7, '%d/%m/%Y') || '=' || texto AS registros
FROM (SELECT *, replace(CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') AS texto
      FROM orders)
"""

PRIORITY_RECORDS = """
SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS serie_codigo,
       o_orderpriority AS serie_nome,
       CASE o_orderstatus WHEN 'P' THEN '2026-07-23' WHEN 'F' THEN '2026-07-22'
            ELSE '2026-07-20' END AS data_ingestao,
       CAST(o_orderdate AS DATE) AS janela_inicio,
       o_orderkey AS pagina,
       posicao,
       CAST(o_orderdate AS DATE) + CAST(7 * posicao AS INTEGER) AS data,
       CASE WHEN o_orderstatus <> 'F' THEN round(o_totalprice * 100) END AS valor
FROM orders, (VALUES (0), (1)) AS p(posicao)
"""

PRIORITY_SILVER = f"""
SELECT serie_codigo, serie_nome, data, valor
FROM (SELECT *, row_number() OVER (
          PARTITION BY serie_codigo, data
          ORDER BY data_ingestao DESC, janela_inicio DESC, pagina DESC, posicao DESC) AS rn
      FROM ({PRIORITY_RECORDS}) WHERE valor IS NOT NULL)
WHERE rn = 1
"""

DEFECTIVE_RECORDS = """
SELECT o_orderkey,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS serie_codigo,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_orderdate AS DATE) END AS data,
       CASE WHEN o_orderpriority = '3-MEDIUM' AND o_totalprice >= 999.995 THEN NULL
            WHEN o_orderpriority = '5-LOW' AND o_orderstatus IN ('P', 'F') THEN NULL
            ELSE o_totalprice END AS valor
FROM orders
"""

ORDER_VERSIONS = """
SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS serie_codigo,
       CAST(o_orderdate AS DATE) AS data,
       o_orderkey,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS valor
FROM orders
"""

PRICE_REQUESTS = """
SELECT o_custkey AS codigo,
       'cliente_' || o_custkey AS nome,
       max(inicio) AS inicio,
       max(fim) AS fim
FROM (SELECT o_custkey,
             first_value(CAST(o_orderdate AS DATE)) OVER (
                 PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS inicio,
             first_value(CAST(o_orderdate AS DATE)) OVER (
                 PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS fim
      FROM orders)
GROUP BY o_custkey
"""

CUSTOMER_LIMITS = """
SELECT o_custkey AS serie_codigo, CAST(o_orderdate AS DATE) AS valido_de,
       CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 180
            ELSE DATE '9999-12-31' END AS valido_ate,
       100000.0 AS minimo, round(o_totalprice * 100) AS maximo, o_orderkey AS limite
FROM orders WHERE o_orderpriority = '1-URGENT'
"""


def silver_of(day: str) -> str:
    """The records of one ingestion day, the latest of each series and date."""
    return f"""
SELECT serie_codigo, serie_nome, data, valor
FROM (SELECT *, row_number() OVER (
          PARTITION BY serie_codigo, data
          ORDER BY janela_inicio DESC, pagina DESC, posicao DESC) AS rn
      FROM ({PRIORITY_RECORDS}) WHERE valor IS NOT NULL AND data_ingestao = '{day}')
WHERE rn = 1
"""


def islands(pause_days: int) -> str:
    """Days with rows, each with the begin of its run and the end of the run before."""
    return f"""
SELECT *, max(CASE WHEN antes IS NULL OR data - antes > {pause_days} THEN data END)
            OVER (PARTITION BY serie_codigo ORDER BY data) AS inicio
FROM (SELECT serie_codigo, data, count(*) AS linhas, sum(valor) AS soma,
             lag(data) OVER (PARTITION BY serie_codigo ORDER BY data) AS antes
      FROM ({CUSTOMER_SERIES}) GROUP BY serie_codigo, data)
"""


def windows(requests: str) -> str:
    """Recursive body: each window from the one before."""
    return f"""
SELECT codigo, nome, fim, 0 AS ordem, inicio AS janela_inicio,
       least(CAST(inicio + INTERVAL 1 YEAR AS DATE), fim) AS janela_fim
FROM ({requests}) WHERE inicio <= fim
UNION ALL
SELECT codigo, nome, fim, ordem + 1, janela_fim + 1,
       least(CAST((janela_fim + 1) + INTERVAL 1 YEAR AS DATE), fim)
FROM w WHERE janela_fim < fim
"""


CUSTOMER_REQUESTS = """
SELECT o_custkey AS codigo, 'cliente_' || o_custkey AS nome,
       CAST(min(o_orderdate) AS DATE) AS inicio, CAST(max(o_orderdate) AS DATE) AS fim
FROM orders GROUP BY o_custkey
"""

OPEN_REQUESTS = """
SELECT codigo, nome, inicio, CASE WHEN estado = 'O' THEN ultima ELSE DATE '2002-01-31' END AS fim
FROM (SELECT o_custkey AS codigo, 'cliente_' || o_custkey AS nome,
             CAST(min(o_orderdate) OVER (PARTITION BY o_custkey) AS DATE) AS inicio,
             CAST(o_orderdate AS DATE) AS ultima, o_orderstatus AS estado,
             row_number() OVER (
                 PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders)
WHERE rn = 1
"""


def planned(landed_empty: bool) -> str:
    """Windows of the customers with the orders in them; an empty window has no order."""
    missing = "NULL" if landed_empty else "'missing_page'"
    return f"""
WITH RECURSIVE w AS ({windows(CUSTOMER_REQUESTS)}),
pages AS ({CUSTOMER_PAGES}),
checked AS (
  SELECT w.codigo, w.nome, w.janela_inicio, coalesce(p.pagina, 0) AS pagina,
         coalesce(p.registros, '') AS registros,
         CASE WHEN p.pagina IS NULL THEN {missing} ELSE p.erro END AS erro
  FROM w LEFT JOIN pages p ON w.codigo = p.codigo
       AND p.janela_inicio BETWEEN w.janela_inicio AND w.janela_fim
)
"""


def documents(source: str) -> str:
    return f"""
SELECT codigo, nome, '2026-07-23' AS data_ingestao,
       CAST(CASE WHEN registros = '' THEN 0 ELSE 2 END AS INTEGER) AS quantidade_registros,
       strftime(janela_inicio, '%Y-%m-%d') AS janela_inicio, pagina, registros AS texto
FROM (SELECT *, count(erro) OVER (PARTITION BY codigo) AS erros FROM ({source}) AS d)
WHERE erros = 0
"""


def monthly(source: str) -> str:
    return f"""
SELECT serie_codigo, serie_nome, ano, mes, valor_medio, valor_min, valor_max, qtd_observacoes,
       round((valor_medio - anterior) / nullif(anterior, 0) * 100, 2)
         AS variacao_percentual_mensal
FROM (
  SELECT *, lag(valor_medio) OVER (PARTITION BY serie_codigo ORDER BY ano, mes) AS anterior
  FROM (
    SELECT serie_codigo, serie_nome,
           CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
           avg(valor) AS valor_medio, min(valor) AS valor_min, max(valor) AS valor_max,
           count(valor) AS qtd_observacoes
    FROM ({source}) AS s
    GROUP BY ALL))
"""


SEGMENT_SERIES = """
SELECT c_nationkey AS serie_codigo, c_mktsegment || '_' || c_nationkey AS serie_nome,
       CAST(o_orderdate AS DATE) AS data, round(o_totalprice * 100) AS valor
FROM orders JOIN customer ON o_custkey = c_custkey
"""

SEGMENT_COLUMNS = ", ".join(
    f"max(CASE WHEN serie_nome = '{s}_{n}' THEN valor_medio END) AS \"{s}_{n}\""
    for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    for n in range(25)
)

MONTHLY_ORDERS = monthly(ORDER_SERIES)


def wide(source: str) -> str:
    return f"""
SELECT ano, mes,
       max(CASE WHEN serie_nome = '1-URGENT' THEN valor_medio END) AS "1-URGENT",
       max(CASE WHEN serie_nome = '2-HIGH' THEN valor_medio END) AS "2-HIGH",
       max(CASE WHEN serie_nome = '3-MEDIUM' THEN valor_medio END) AS "3-MEDIUM",
       max(CASE WHEN serie_nome = '4-NOT SPECIFIED' THEN valor_medio END) AS "4-NOT SPECIFIED",
       max(CASE WHEN serie_nome = '5-LOW' THEN valor_medio END) AS "5-LOW"
FROM ({monthly(source)}) AS m
GROUP BY ano, mes
"""


VIEW = f"SELECT *, make_date(ano, mes, 1) AS periodo FROM ({MONTHLY_ORDERS})"
WIDE_VIEW = f"SELECT *, make_date(ano, mes, 1) AS periodo FROM ({wide(ORDER_SERIES)})"
PERIOD = "periodo BETWEEN DATE '1996-03-01' AND DATE '1999-12-01'"
SELECTED = f"serie_nome IN ('1-URGENT', '5-LOW') AND {PERIOD}"


def grouping_sets(source: str, keys: str, levels: dict[str, str]) -> str:
    """Aggregates of the observations themselves by ``levels`` (name and keys)."""
    sets = ", ".join(f"({of})" for of in levels.values())
    names = list(levels)
    number = " ".join(
        f"WHEN {sum(1 << (keys.count(',') - i) for i, k in enumerate(keys.split(', ')) if k not in of.split(', '))}"
        f" THEN '{name}'"
        for name, of in zip(names, levels.values(), strict=True)
    )
    return f"""
SELECT CASE grouping({keys}) {number} END AS nivel, {keys},
       sum(valor) AS soma, count(*) AS quantidade, sum(valor) / count(*) AS media,
       min(valor) AS minimo, max(valor) AS maximo,
       min(data) AS primeira_data, min({{'d': data, 'v': valor}}).v AS primeiro_valor,
       max(data) AS ultima_data, max({{'d': data, 'v': valor}}).v AS ultimo_valor,
       count(DISTINCT data) AS dias
FROM (SELECT *, CAST(year(data) AS INTEGER) AS ano, CAST(quarter(data) AS INTEGER) AS trimestre,
             CAST(month(data) AS INTEGER) AS mes
      FROM ({source}) WHERE data IS NOT NULL AND valor IS NOT NULL)
GROUP BY GROUPING SETS ({sets})
"""


def latest(source: str) -> str:
    return f"""
SELECT * EXCLUDE (rn)
FROM (SELECT *, row_number() OVER (PARTITION BY serie_nome ORDER BY periodo DESC) AS rn
      FROM (SELECT *, make_date(ano, mes, 1) AS periodo FROM ({monthly(source)})))
WHERE rn = 1
"""


RANGE_COUNTS = f"""
SELECT serie_nome,
       CAST(count(*) FILTER (WHERE NOT isnan(valor) AND
            (valor < coalesce(minimo, 0) OR valor > coalesce(maximo, 300))) AS BIGINT)
         AS fora_da_faixa
FROM ({EVENT_SERIES}) AS s LEFT JOIN ({EVENT_BOUNDS}) AS b USING (serie_nome)
WHERE serie_nome IS NOT NULL
GROUP BY serie_nome
"""

DUPLICATES = """
SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS linhas_repetidas
FROM (SELECT count(*) AS n FROM ({source}) AS s GROUP BY serie_codigo, data)
"""

QUALITY_REPORT = f"""
SELECT 'expect_column_values_to_not_be_null' AS expectativa, 'global' AS escopo,
       count(*) AS unexpected_count
FROM ({EVENT_SERIES}) WHERE data IS NULL HAVING count(*) > 0
UNION ALL
SELECT 'expect_column_values_to_not_be_null', 'global', count(*)
FROM ({EVENT_SERIES}) WHERE valor IS NULL OR isnan(valor) HAVING count(*) > 0
UNION ALL
SELECT 'expect_compound_columns_to_be_unique', 'global', linhas_repetidas
FROM ({DUPLICATES.format(source=EVENT_SERIES)}) WHERE linhas_repetidas > 0
UNION ALL
SELECT 'expect_column_values_to_be_between', serie_nome, fora_da_faixa
FROM ({RANGE_COUNTS}) WHERE fora_da_faixa > 0
"""

SHIPMENTS = """
SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS serie_codigo,
       CAST(l_shipdate AS DATE) AS data, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_extendedprice * 100) AS valor
FROM lineitem
"""

SHIPMENT_DAYS = f"""
SELECT serie_codigo, data, sum(valor) AS soma, count(valor) AS quantidade,
       min(valor) AS minimo, max(valor) AS maximo
FROM ({SHIPMENTS}) GROUP BY serie_codigo, data
"""

ORACLES = {
    "year_windows": f"""
WITH RECURSIVE r AS (
  SELECT o_custkey AS codigo, 'cliente_' || o_custkey AS nome,
         CAST(min(o_orderdate) AS DATE) AS inicio, CAST(max(o_orderdate) AS DATE) AS fim
  FROM orders GROUP BY o_custkey),
w AS ({windows("SELECT * FROM r")})
SELECT codigo, nome, ordem, janela_inicio, janela_fim FROM w
""",
    "interval_check": f"""
SELECT codigo, nome, 'start_after_end' AS erro FROM ({PRICE_REQUESTS}) WHERE inicio > fim
""",
    "catalog_dates": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data, strftime(o_orderdate, '%d/%m/%Y') AS texto
FROM orders
""",
    "page_validation": """
SELECT user_id AS codigo, event_id AS pagina,
       CASE event_type WHEN 'error' THEN 'http_status' WHEN 'signup' THEN 'not_a_list'
            WHEN 'view' THEN 'invalid_json' END AS erro,
       CASE event_type WHEN 'click' THEN 2 WHEN 'purchase' THEN 1 END AS quantidade
FROM events
""",
    "page_concat": documents(f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS erro) FROM ({CUSTOMER_PAGES})"),
    "series_failure_isolation": documents(CUSTOMER_PAGES),
    "failed_series": f"""
SELECT codigo, nome, 'http_status' AS erro, count(*) AS paginas_com_erro
FROM ({CUSTOMER_PAGES}) WHERE erro IS NOT NULL GROUP BY codigo, nome
""",
    "ingestion_failures": f"""
{planned(landed_empty=False)}
SELECT codigo, nome, erro
FROM (SELECT *, row_number() OVER (PARTITION BY codigo ORDER BY janela_inicio, pagina) AS rn
      FROM checked WHERE erro IS NOT NULL)
WHERE rn = 1
""",
    "ingestion_documents": f"{planned(landed_empty=True)} {documents('SELECT * FROM checked')}",
    "series_record_totals": f"""
SELECT codigo, nome, '2026-07-23' AS data_ingestao, count(*) AS paginas,
       CAST(2 * count(*) AS BIGINT) AS registros
FROM ({CUSTOMER_PAGES}) GROUP BY codigo, nome HAVING count(erro) = 0
""",
    "unplanned_pages": f"""
WITH RECURSIVE r AS ({PRICE_REQUESTS}),
w AS ({windows("SELECT * FROM r")})
SELECT codigo, janela_inicio, pagina, 'unplanned_page' AS erro
FROM ({CUSTOMER_PAGES}) AS p
WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.codigo = p.codigo AND w.janela_inicio = p.janela_inicio)
""",
    "catalog_open_end": f"""
WITH RECURSIVE w AS ({windows(OPEN_REQUESTS)})
SELECT CAST(codigo AS INTEGER) AS codigo, nome, ordem, janela_inicio, janela_fim FROM w
""",
    "corrupt_documents": """
SELECT '{"codigo":' || o_custkey || ',"nome":"c' AS texto FROM orders WHERE o_orderstatus = 'P'
""",
    "batch_metrics": f"""
SELECT (SELECT count(*) * 2 FROM orders) AS records_read,
       (SELECT count(*) * 2 FROM orders WHERE o_orderstatus = 'F') AS records_discarded,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS corrupt_documents,
       (SELECT count(*) FROM ({PRIORITY_SILVER})) AS silver_rows,
       (SELECT count(*) FROM ({monthly(PRIORITY_SILVER)})) AS monthly_rows,
       (SELECT count(*) FROM ({wide(PRIORITY_SILVER)})) AS comparison_rows
""",
    "bronze_explode": """
SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS serie_codigo,
       o_orderpriority AS serie_nome,
       CASE o_orderstatus WHEN 'P' THEN '2026-07-23' WHEN 'F' THEN '2026-07-22'
            ELSE '2026-07-20' END AS data_ingestao,
       strftime(CAST(o_orderdate AS DATE) + CAST(7 * posicao AS INTEGER), '%d/%m/%Y') AS data_texto,
       CASE WHEN o_orderstatus = 'F' THEN 'n/d'
            ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) || ',0' END
         AS valor_texto
FROM orders, (VALUES (0), (1)) AS p(posicao)
""",
    "parse_br_values": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data, o_totalprice AS valor FROM orders
""",
    "parse_invalid_dropped": f"""
SELECT * FROM ({DEFECTIVE_RECORDS}) WHERE data IS NOT NULL AND valor IS NOT NULL
""",
    "discard_metric": f"""
SELECT count(*) AS lidos,
       count(*) FILTER (WHERE data IS NOT NULL AND valor IS NOT NULL) AS validos,
       count(*) FILTER (WHERE data IS NULL OR valor IS NULL) AS descartados
FROM ({DEFECTIVE_RECORDS})
""",
    "dedup_keep_latest": f"""
SELECT * EXCLUDE (rn)
FROM (SELECT *, row_number() OVER (
          PARTITION BY serie_codigo, data ORDER BY o_orderkey DESC) AS rn
      FROM ({ORDER_VERSIONS}))
WHERE rn = 1
""",
    "null_before_dedup": f"""
SELECT * EXCLUDE (rn)
FROM (SELECT *, row_number() OVER (
          PARTITION BY serie_codigo, data ORDER BY o_orderkey DESC) AS rn
      FROM ({ORDER_VERSIONS}) WHERE valor IS NOT NULL)
WHERE rn = 1
""",
    "dedup_lineitem": """
SELECT l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS data,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM (SELECT *, row_number() OVER (
          PARTITION BY l_returnflag, l_linestatus, CAST(l_shipdate AS DATE)
          ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                   l_extendedprice DESC) AS rn
      FROM lineitem)
WHERE rn = 1
""",
    "silver_from_orders": PRIORITY_SILVER,
    "monthly_by_series": MONTHLY_ORDERS,
    "monthly_lineitem": monthly(LINEITEM_SERIES),
    "rollup_levels": grouping_sets(
        ORDER_SERIES,
        "serie_codigo, serie_nome, ano, trimestre, mes",
        {
            "mes": "serie_codigo, serie_nome, ano, trimestre, mes",
            "trimestre": "serie_codigo, serie_nome, ano, trimestre",
            "ano": "serie_codigo, serie_nome, ano",
            "serie": "serie_codigo, serie_nome",
            "total": "",
        },
    ),
    "cube_levels": grouping_sets(
        LINEITEM_SERIES,
        "serie_codigo, serie_nome, ano",
        {
            "serie_e_ano": "serie_codigo, serie_nome, ano",
            "serie": "serie_codigo, serie_nome",
            "ano": "ano",
            "total": "",
        },
    ),
    "monthly_lag_gap": monthly("""
SELECT o_custkey AS serie_codigo, 'cliente_' || o_custkey AS serie_nome,
       CAST(o_orderdate AS DATE) AS data, round(o_totalprice * 100) AS valor
FROM orders
"""),
    "pct_change_zero_prev": f"""
SELECT serie_codigo, ano, mes, valor_medio, variacao_percentual_mensal
FROM ({monthly(CUSTOMER_SERIES)})
""",
    "comparison_pivot": wide(ORDER_SERIES),
    "comparison_known_names": wide(ORDER_SERIES),
    "pivot_sparse": f"""
SELECT ano, mes, {SEGMENT_COLUMNS} FROM ({monthly(SEGMENT_SERIES)}) AS m GROUP BY ano, mes
""",
    "quality_not_null": f"""
SELECT count(*) AS linhas,
       count(*) FILTER (WHERE data IS NULL) AS data_nula,
       count(*) FILTER (WHERE valor IS NULL OR isnan(valor)) AS valor_nulo
FROM ({EVENT_SERIES})
""",
    "quality_unique": DUPLICATES.format(source=ORDER_SERIES),
    "quality_range": RANGE_COUNTS,
    "quality_range_table": f"""
SELECT serie_nome,
       count(*) FILTER (WHERE valor < coalesce(minimo, -1000000)
                           OR valor > coalesce(maximo, 1000000)) AS fora_da_faixa
FROM ({CUSTOMER_SERIES}) AS s
LEFT JOIN (SELECT 'cliente_' || c_custkey AS serie_nome, 0.0 AS minimo,
                  round(c_acctbal * 100) * 40 AS maximo
           FROM customer WHERE c_acctbal >= 0) AS b USING (serie_nome)
GROUP BY serie_nome
""",
    "quality_report": QUALITY_REPORT,
    "quality_gate_report": QUALITY_REPORT,
    "period_column": VIEW,
    "comparison_view": WIDE_VIEW,
    "detail_table": f"""
SELECT serie_nome, periodo, valor_medio, valor_min, valor_max, variacao_percentual_mensal
FROM ({VIEW})
""",
    "series_options": f"SELECT DISTINCT serie_nome FROM ({ORDER_SERIES})",
    "period_bounds": f"SELECT min(periodo) AS periodo_min, max(periodo) AS periodo_max FROM ({VIEW})",
    "filter_series_period": f"SELECT * FROM ({VIEW}) WHERE {SELECTED}",
    "series_points": f"SELECT periodo, valor_medio, serie_nome FROM ({VIEW}) WHERE {SELECTED}",
    "latest_kpi": latest(ORDER_SERIES),
    "latest_by_customer": latest(CUSTOMER_SERIES),
    "kpi_labels": f"""
SELECT serie_nome,
       'Cliente ' || serie_codigo AS rotulo,
       printf('%.2f', valor_medio) AS valor,
       CASE WHEN variacao_percentual_mensal IS NOT NULL
            THEN printf('%.2f%%', variacao_percentual_mensal) END AS variacao
FROM ({latest(CUSTOMER_SERIES)})
""",
    "comparison_period": f"SELECT * FROM ({WIDE_VIEW}) WHERE {PERIOD}",
    "comparison_unpivot": f"""
SELECT periodo, '1-URGENT' AS variable, "1-URGENT" AS value FROM ({WIDE_VIEW}) WHERE {PERIOD}
UNION ALL
SELECT periodo, '5-LOW', "5-LOW" FROM ({WIDE_VIEW}) WHERE {PERIOD}
""",
    "bronze_roundtrip": PRIORITY_SILVER,
    "silver_roundtrip": ORDER_SERIES,
    "gated_batch_monthly": monthly(PRIORITY_SILVER),
    "gated_batch_comparison": wide(PRIORITY_SILVER),
    "asof_join": f"""
WITH known AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS serie_codigo,
         CAST(o_orderdate AS DATE) AS data, max(round(o_totalprice * 100)) AS valor
  FROM orders GROUP BY ALL)
SELECT s.serie_codigo, s.data, l_orderkey, l_linenumber, l_partkey, s.valor,
       k.data AS data_ref, k.valor AS valor_ref
FROM ({SHIPMENTS}) AS s ASOF LEFT JOIN known AS k
  ON s.serie_codigo = k.serie_codigo AND s.data >= k.data
""",
    "asof_join_strict": """
WITH own AS (
  SELECT o_custkey AS serie_codigo, 'cliente_' || o_custkey AS serie_nome,
         CAST(o_orderdate AS DATE) AS data, round(o_totalprice * 100) AS valor FROM orders),
known AS (SELECT serie_codigo, data, max(valor) AS valor FROM own GROUP BY ALL),
met AS (
  SELECT o.*, k.data AS d, k.valor AS v FROM own AS o ASOF LEFT JOIN known AS k
    ON o.serie_codigo = k.serie_codigo AND o.data > k.data)
SELECT serie_codigo, serie_nome, data, valor,
       CASE WHEN data - d <= 365 THEN d END AS data_ref,
       CASE WHEN data - d <= 365 THEN v END AS valor_ref
FROM met
""",
    "trailing_rows": f"""
SELECT serie_codigo, data, l_orderkey, l_linenumber, l_partkey, valor,
       sum(valor) OVER w AS soma, min(valor) OVER w AS minimo, max(valor) OVER w AS maximo,
       count(valor) OVER w AS quantidade
FROM ({SHIPMENTS})
WINDOW w AS (PARTITION BY serie_codigo
             ORDER BY data, l_orderkey, l_linenumber, l_partkey, l_suppkey, valor
             ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)
""",
    "trailing_year": f"""
SELECT serie_codigo, data, sum(soma) OVER w AS soma,
       CAST(sum(quantidade) OVER w AS BIGINT) AS quantidade,
       min(minimo) OVER w AS minimo, max(maximo) OVER w AS maximo
FROM ({SHIPMENT_DAYS})
WINDOW w AS (PARTITION BY serie_codigo ORDER BY data
             RANGE BETWEEN INTERVAL 364 DAY PRECEDING AND CURRENT ROW)
""",
    "running_totals": f"""
SELECT serie_codigo, data, sum(soma) OVER w AS acumulado,
       CAST(sum(quantidade) OVER w AS BIGINT) AS quantidade
FROM ({SHIPMENT_DAYS})
WINDOW w AS (PARTITION BY serie_codigo ORDER BY data)
""",
    "accumulated_months": """
WITH months AS (
  SELECT o_custkey AS serie_codigo, CAST(year(o_orderdate) AS INTEGER) AS ano,
         CAST(month(o_orderdate) AS INTEGER) AS mes,
         max(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE round(o_totalprice * 100) END) AS valor_max
  FROM orders GROUP BY ALL)
SELECT *, sum(valor_max) OVER w AS acumulado, count(valor_max) OVER w AS meses
FROM months
WINDOW w AS (PARTITION BY serie_codigo ORDER BY ano * 12 + mes
             RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)
""",
    "series_positions": """
WITH records AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS codigo,
         CASE o_orderstatus WHEN 'P' THEN '2026-07-23' WHEN 'F' THEN '2026-07-22'
                            ELSE '2026-07-20' END AS data_ingestao,
         CAST(o_orderdate AS DATE) AS dia, o_orderkey, i,
         CASE o_orderstatus WHEN 'F' THEN 'n/d'
              ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) || ',0' END AS valor
  FROM orders, (VALUES (0), (7)) AS t(i))
SELECT codigo, data_ingestao,
       row_number() OVER (PARTITION BY codigo, data_ingestao ORDER BY dia, o_orderkey, i) - 1 AS posicao,
       count(*) OVER (PARTITION BY codigo, data_ingestao) AS total_serie,
       strftime(dia + CAST(i AS INTEGER), '%d/%m/%Y') AS data, valor
FROM records
""",
    "incremental_silver": PRIORITY_SILVER,
    "incremental_monthly": monthly(PRIORITY_SILVER),
    "incremental_comparison": wide(PRIORITY_SILVER),
    "streaming_monthly": monthly(PRIORITY_SILVER),
    "silver_changes": f"""
SELECT coalesce(a.serie_codigo, d.serie_codigo) AS serie_codigo,
       coalesce(a.data, d.data) AS data,
       CASE WHEN a.data IS NULL THEN 'inserido' WHEN d.data IS NULL THEN 'removido'
            ELSE 'alterado' END AS mudanca,
       a.serie_nome AS serie_nome_antes, a.valor AS valor_antes,
       d.serie_nome AS serie_nome_depois, d.valor AS valor_depois
FROM ({silver_of("2026-07-20")}) a
FULL JOIN ({silver_of("2026-07-23")}) d ON a.serie_codigo = d.serie_codigo AND a.data = d.data
WHERE a.data IS NULL OR d.data IS NULL OR a.valor IS DISTINCT FROM d.valor
   OR a.serie_nome IS DISTINCT FROM d.serie_nome
""",
    "series_runs": f"""
SELECT serie_codigo, inicio, max(data) AS fim, count(*) AS dias,
       CAST(sum(linhas) AS BIGINT) AS linhas, sum(soma) AS soma,
       max(CASE WHEN data = inicio THEN antes END) AS fim_anterior
FROM ({islands(90)}) GROUP BY serie_codigo, inicio
""",
    "series_gaps": f"""
SELECT serie_codigo, antes + 1 AS falta_de, data - 1 AS falta_ate,
       CAST(data - antes - 1 AS INTEGER) AS dias
FROM ({islands(1)}) WHERE data - antes > 1
""",
    "month_spine": f"""
WITH months AS (
  SELECT serie_codigo, CAST(date_trunc('month', data) AS DATE) AS mes,
         count(*) AS quantidade, sum(valor) AS soma
  FROM ({CUSTOMER_SERIES}) GROUP BY ALL),
spine AS (
  SELECT serie_codigo, CAST(unnest(generate_series(min(mes), max(mes), INTERVAL 1 MONTH)) AS DATE) AS mes
  FROM months GROUP BY serie_codigo)
SELECT s.serie_codigo, s.mes, coalesce(m.quantidade, 0) AS quantidade, m.soma,
       CAST(CASE WHEN m.mes IS NULL THEN 0 ELSE
         coalesce(date_diff('month', max(m.mes) OVER (PARTITION BY s.serie_codigo ORDER BY s.mes
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s.mes) - 1, 0) END AS INTEGER) AS sem_dados
FROM spine s LEFT JOIN months m ON m.serie_codigo = s.serie_codigo AND m.mes = s.mes
""",
    "range_by_period": f"""
SELECT r.serie_codigo, count(*) AS verificacoes,
       count(*) FILTER (WHERE p.limite IS NULL) AS sem_periodo,
       count(*) FILTER (WHERE r.valor < coalesce(p.minimo, 0)
                           OR r.valor > coalesce(p.maximo, 20000000)) AS fora_da_faixa
FROM ({CUSTOMER_SERIES}) r
LEFT JOIN ({CUSTOMER_LIMITS}) p
       ON p.serie_codigo = r.serie_codigo AND r.data BETWEEN p.valido_de AND p.valido_ate
GROUP BY r.serie_codigo
""",
    "period_overlaps": f"""
SELECT o.o_custkey AS serie_codigo, o.o_orderkey, p.limite
FROM orders o JOIN ({CUSTOMER_LIMITS}) p
  ON p.serie_codigo = o.o_custkey AND CAST(o.o_orderdate AS DATE) <= p.valido_ate
     AND p.valido_de <= CAST(o.o_orderdate AS DATE) + 30
""",
    # The same buckets: the rank of a quantile is exact, its value within 1 %.
    "approximate_quantiles": f"""
WITH buckets AS (
  SELECT serie_codigo, CAST(year(data) AS INTEGER) AS ano, CAST(sign(valor) AS INTEGER) AS sinal,
         CASE WHEN valor = 0 THEN 0
              ELSE CAST(ceil(ln(abs(valor)) / ln(1.01 / 0.99)) AS INTEGER) END AS faixa,
         count(*) AS n
  FROM ({LINEITEM_SERIES}) WHERE valor IS NOT NULL GROUP BY ALL),
counted AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY serie_codigo, ano) AS BIGINT) AS quantidade,
         sum(n) OVER (PARTITION BY serie_codigo, ano ORDER BY sinal, sinal * faixa) AS ate
  FROM buckets),
asked AS (
  SELECT *, CAST(floor(q * (quantidade - 1)) AS BIGINT) + 1 AS posicao
  FROM counted, (VALUES (CAST(0 AS DOUBLE)), (0.25), (0.5), (0.9), (0.99), (1)) AS t(q))
SELECT serie_codigo, ano, q, posicao, quantidade, sinal, faixa,
       CASE WHEN sinal = 0 THEN 0.0
            ELSE round(sinal * 2 * pow(CAST(1.01 / 0.99 AS DOUBLE), faixa) / (1.01 / 0.99 + 1)) END AS valor
FROM asked WHERE posicao <= ate AND posicao > ate - n
""",
    "approximate_distinct": """
SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS serie_codigo,
       CAST(year(l_shipdate) AS INTEGER) AS ano, count(DISTINCT l_partkey) AS distintos,
       TRUE AS no_limite
FROM lineitem GROUP BY ALL
""",
}
