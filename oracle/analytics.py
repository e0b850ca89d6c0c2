"""Reports, API, dashboard and exercise queries over the derived star."""

from oracle.sql import dbl, div, even, money, pct, up

AS_OF = "DATE '2001-08-01'"
SOLD = "status NOT IN ('CANCELADO', 'DEVOLVIDO')"

VIEWS = {
    "vw_estoque_atual": "SELECT * FROM estoque",
    "vw_vendas_consolidadas": f"""
        SELECT num_pedido, data_pedido, status, cod_cliente, razao_social AS cliente, segmento,
               estado, qtd_itens, {dbl("bruto")} AS valor_bruto,
               {dbl("desconto_percentual")} AS desconto_percentual,
               {dbl("valor")} AS valor_liquido, mes, trimestre, ano
        FROM vendas""",
    "vw_compras_consolidadas": f"""
        SELECT num_oc, data_oc, status, cod_fornecedor, razao_social AS fornecedor,
               categoria AS categoria_fornecedor, qtd_itens, {dbl("valor")} AS valor_total_oc,
               t.mes, t.trimestre, t.ano
        FROM compras_totais LEFT JOIN dim_tempo t ON t.data = data_oc
        WHERE status <> 'CANCELADO'""",
}

_MONTH = "date_trunc('month', data_pedido)"

REPORTS = {
    "clientes_unicos_periodos": f"""
        SELECT nivel, periodo, count(DISTINCT cod_cliente) AS clientes_unicos FROM (
            SELECT 'mes' AS nivel, strftime(data_pedido, '%Y%m') AS periodo, cod_cliente, status
            FROM pedidos
            UNION ALL
            SELECT 'trimestre', strftime(data_pedido, '%Y') || 'T' || quarter(data_pedido), cod_cliente, status
            FROM pedidos
            UNION ALL
            SELECT 'ano', strftime(data_pedido, '%Y'), cod_cliente, status FROM pedidos
            UNION ALL
            SELECT 'ultimos_12_meses', strftime({_MONTH} + to_months(CAST(k AS INTEGER)), '%Y%m'), cod_cliente, status
            FROM pedidos, (SELECT unnest(range(12)) AS k)
            WHERE {_MONTH} + to_months(CAST(k AS INTEGER)) <= (
                SELECT max({_MONTH}) FROM pedidos WHERE status <> 'CANCELADO'))
        WHERE status <> 'CANCELADO' GROUP BY ALL""",
    "estoque_atual": """
        SELECT cod_produto, descricao, categoria, unidade, saldo_atual, estoque_minimo,
               estoque_maximo, valor_estoque, custo_unitario, preco_venda, status_estoque
        FROM estoque""",
    "pedidos_em_aberto": f"""
        SELECT num_pedido, data_pedido, data_entrega_prevista, status, razao_social AS cliente,
               estado, qtd_itens, {dbl("valor")} AS valor_liquido,
               CAST({AS_OF} - data_pedido AS INTEGER) AS dias_em_aberto,
               CASE WHEN data_entrega_prevista < {AS_OF} THEN 'ATRASADO' ELSE 'NO_PRAZO' END
                   AS situacao_entrega
        FROM vendas WHERE status NOT IN ('ENTREGUE', 'DEVOLVIDO')""",
    "produtos_abaixo_minimo": f"""
        SELECT cod_produto, descricao, s.categoria, unidade, {dbl("saldo")} AS saldo_atual,
               estoque_minimo, {dbl("estoque_minimo - saldo")} AS deficit,
               {dbl("custo_unitario")} AS custo_unitario,
               {money("(estoque_minimo - saldo) * custo_unitario")} AS custo_reposicao_minimo,
               f.razao_social AS fornecedor_principal, f.prazo_entrega_dias
        FROM saldos s JOIN dim_fornecedores f ON s.cod_fornecedor_principal = f.cod_fornecedor
        WHERE saldo <= estoque_minimo""",
    "vendas_por_periodo": f"""
        SELECT ano, mes, nome_mes, trimestre, qtd_pedidos, clientes_unicos,
               {money("receita")} AS receita_liquida, {up("media", 2)} AS ticket_medio,
               {pct("receita - anterior", "anterior", 1)} AS variacao_mom_pct
        FROM (SELECT *, lag(receita) OVER (ORDER BY ano, mes) AS anterior FROM (
            SELECT ano, mes, nome_mes, trimestre, count(DISTINCT num_pedido) AS qtd_pedidos,
                   count(DISTINCT cod_cliente) AS clientes_unicos, sum(valor) AS receita,
                   {div("sum(valor)", "count(valor)")} AS media
            FROM vendas WHERE ano IS NOT NULL GROUP BY ALL))""",
    "top_clientes": f"""
        SELECT ranking, cod_cliente, razao_social AS cliente, segmento, estado, qtd_pedidos,
               {money("receita")} AS receita_total,
               {up(div("receita", "qtd_pedidos"), 2)} AS ticket_medio, share_pct,
               {pct("acumulado", "total", 1)} AS share_acumulado_pct, classe_abc,
               primeiro_pedido, ultimo_pedido
        FROM clientes_abc""",
    "giro_estoque": f"""
        SELECT p.cod_produto, p.descricao, p.categoria, {dbl("p.custo_unitario")} AS custo_unitario,
               {dbl("coalesce(saida, 0)")} AS total_saida_qtd,
               {dbl("coalesce(cmv, 0)")} AS cmv_periodo,
               {dbl("coalesce(medio, 0)")} AS estoque_medio_qtd,
               {up(div("coalesce(saida, 0)", "abs(coalesce(medio, 0))"), 2)} AS giro_estoque,
               {up(div("365", div("coalesce(saida, 0)", "abs(coalesce(medio, 0))")), 0)}
                   AS dias_cobertura
        FROM dim_produtos p
        LEFT JOIN (SELECT cod_produto, sum(abs(qty_sinal)) AS saida, sum(valor_total_mov) AS cmv
                   FROM movimentos WHERE tipo_mov = 'SAIDA' GROUP BY 1) s
               ON s.cod_produto = p.cod_produto
        LEFT JOIN (SELECT cod_produto, CAST(sum(CASE WHEN tipo_mov IN ('ENTRADA', 'SAIDA')
                              THEN qty_sinal ELSE 0 END) AS DOUBLE) / 2 AS medio
                   FROM movimentos GROUP BY 1) m ON m.cod_produto = p.cod_produto""",
    "margem_por_produto": f"""
        SELECT cod_produto, descricao, categoria, {dbl("custo_unitario")} AS custo_unitario,
               {dbl("preco_venda")} AS preco_venda,
               {pct("preco_venda - custo_unitario", "preco_venda", 2)} AS margem_bruta_catalog_pct,
               {dbl("qtd")} AS qtd_vendida, {money("receita")} AS receita_bruta,
               {money("custo")} AS cmv, {money("receita - custo")} AS margem_bruta_valor,
               {pct("receita - custo", "receita", 2)} AS margem_bruta_pct
        FROM margens""",
}


STOCK_ORDER = "ORDER BY status_estoque, saldo_atual, cod_produto"

API = {
    "api_estoque": "SELECT * FROM estoque",
    "api_estoque_filtrado": "SELECT * FROM estoque WHERE status_estoque = 'OK' AND categoria = 'ECONOMY'",
    "api_estoque_criticos": "SELECT * FROM estoque WHERE status_estoque = 'CRITICO'",
    "api_estoque_resumo": f"""
        SELECT categoria, count(*) AS total_skus, {dbl("sum(saldo)")} AS saldo_total,
               {money("sum(valor)")} AS valor_total,
               count(*) FILTER (status_estoque = 'CRITICO') AS criticos,
               count(*) FILTER (status_estoque = 'ALERTA') AS alertas
        FROM saldos GROUP BY categoria""",
    "api_estoque_produto": f"""
        SELECT e.cod_produto, e.descricao, e.saldo_atual, e.status_estoque,
               CAST(m.l_orderkey AS VARCHAR) AS num_documento, m.tipo_mov,
               {dbl("m.quantidade")} AS quantidade, m.data_mov, CAST(NULL AS VARCHAR) AS observacao,
               m.num_mov
        FROM estoque e LEFT JOIN (SELECT * FROM movimentos WHERE cod_produto = 42
                                  ORDER BY data_mov DESC, num_mov LIMIT 30) m
             ON m.cod_produto = e.cod_produto
        WHERE e.cod_produto = 42""",
    "api_vendas_lista": f"""
        SELECT num_pedido, v.cod_cliente, c.razao_social AS nome_cliente, c.segmento, data_pedido,
               data_entrega_prevista, data_entrega_real, status AS status_pedido,
               {dbl("valor")} AS valor_total, {dbl("desconto_percentual")} AS desconto_pct
        FROM valores v LEFT JOIN dim_clientes c ON v.cod_cliente = c.cod_cliente
        ORDER BY data_pedido DESC, num_pedido LIMIT 50""",
    "api_vendas_lista_status": f"""
        SELECT num_pedido, v.cod_cliente, c.razao_social AS nome_cliente, c.segmento, data_pedido,
               data_entrega_prevista, data_entrega_real, status AS status_pedido,
               {dbl("valor")} AS valor_total, {dbl("desconto_percentual")} AS desconto_pct
        FROM valores v LEFT JOIN dim_clientes c ON v.cod_cliente = c.cod_cliente
        WHERE status = 'ENTREGUE'
        ORDER BY data_pedido DESC, num_pedido LIMIT 500""",
    "api_kpis_resumo": f"""
        SELECT count(*) AS total_pedidos, {money("sum(valor)")} AS receita_total,
               {up(div("sum(valor)", "count(valor)"), 2)} AS ticket_medio,
               count(DISTINCT cod_cliente) AS clientes_ativos
        FROM valores WHERE {SOLD}""",
    "api_kpis_status": f"""
        SELECT status AS status_pedido, count(*) AS total, {money("sum(valor)")} AS valor
        FROM valores GROUP BY status""",
    "api_kpis_top5": f"""
        SELECT v.cod_cliente, any_value(c.razao_social) AS nome_cliente, count(*) AS pedidos,
               {money("sum(valor)")} AS receita
        FROM valores v LEFT JOIN dim_clientes c ON v.cod_cliente = c.cod_cliente
        WHERE {SOLD} GROUP BY v.cod_cliente
        ORDER BY receita DESC NULLS LAST, v.cod_cliente LIMIT 5""",
    "api_vendas_periodo": f"""
        SELECT ano, mes, {money("receita")} AS receita, pedidos,
               {money("anterior")} AS receita_mes_anterior,
               {pct("receita - anterior", "anterior", 2)} AS variacao_pct
        FROM (SELECT *, lag(receita) OVER (ORDER BY ano, mes) AS anterior FROM (
            SELECT strftime(data_pedido, '%Y') AS ano, strftime(data_pedido, '%m') AS mes,
                   sum(valor) AS receita, count(*) AS pedidos
            FROM valores WHERE {SOLD} GROUP BY 1, 2))""",
    "api_margem": f"""
        SELECT cod_produto, descricao, categoria, {dbl("qtd")} AS unidades_vendidas,
               {money("receita")} AS receita_bruta, {money("custo")} AS cmv,
               {money("receita - custo")} AS lucro_bruto,
               {pct("receita - custo", "receita", 1)} AS margem_pct
        FROM margens""",
}

_STATS = f"""
    SELECT count(v) AS n, CAST(sum(v) AS DOUBLE) AS s,
           CAST(sum(CAST(v AS DECIMAL(18,2)) * CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS q,
           any_value(todos) AS todos
    FROM (SELECT CASE WHEN {SOLD} THEN valor END AS v,
                 (SELECT {div("sum(valor)", "count(valor)")} FROM valores) AS todos FROM valores)"""


def _anomalies(spread: str) -> str:
    score = up(f"abs(CAST(valor AS DOUBLE) - s / n) / sqrt(({spread}) / (n - 1))", 2)
    return f"""
        SELECT num_pedido, v.cod_cliente, c.razao_social AS nome_cliente,
               {dbl("valor")} AS valor_total, data_pedido, status AS status_pedido, z_score
        FROM (SELECT *, {score} AS z_score FROM valores, ({_STATS}) WHERE {SOLD}) v
        LEFT JOIN dim_clientes c ON v.cod_cliente = c.cod_cliente
        WHERE z_score > 2.5"""


_MONTHLY = f"""
    SELECT i.cod_produto, CAST(date_trunc('month', v.data_pedido) AS DATE) AS mes,
           sum(i.quantidade) AS qtd
    FROM itens i JOIN pedidos v ON i.num_pedido = v.num_pedido WHERE {SOLD}"""

_SUPPLY = f"""
    SELECT s.*, demanda, greatest(0.0, demanda * 2 - CAST(saldo AS DOUBLE)) AS falta
    FROM saldos s JOIN (
        SELECT cod_produto, {div("sum(qtd)", "count(*)")} AS demanda
        FROM ({_MONTHLY} AND v.data_pedido >= DATE '2001-05-01' GROUP BY 1, 2) GROUP BY 1) d
    ON d.cod_produto = s.cod_produto
    WHERE status_estoque IN ('CRITICO', 'ALERTA') AND demanda > 0"""

_COST = "round(CAST(falta * CAST(custo_unitario AS DOUBLE) AS DECIMAL(38,8)), 2)"

FORECAST = {
    "api_anomalias": _anomalies("q - s * s / n"),
    "api_anomalias_media_geral": _anomalies("q - 2 * todos * s + n * todos * todos"),
    "previsao_demanda": f"""
        SELECT f.cod_produto, p.descricao, a, b, {even("base", 1)} AS media_movel_3m,
               strftime(ultimo + to_months(CAST(i AS INTEGER)), '%Y-%m') AS periodo,
               CAST(prevista AS BIGINT) AS quantidade_prevista,
               CAST(round_even(prevista * 0.8::DOUBLE, 0) AS BIGINT) AS intervalo_inferior,
               CAST(round_even(prevista * 1.2::DOUBLE, 0) AS BIGINT) AS intervalo_superior
        FROM (SELECT *, greatest(0.0, round_even(base + b * (n + i - 1), 0)) AS prevista
              FROM (SELECT cod_produto, n, ultimo, base, {even("slope", 2)} AS b,
                           CASE WHEN n < 2 THEN CAST(sy AS DOUBLE)
                                ELSE {even("(CAST(sy AS DOUBLE) - slope * sx) / n", 2)} END AS a
                    FROM (SELECT *, CASE WHEN n < 2 THEN 0.0
                                 ELSE {div("n * sxy - sx * sy", "n * sxx - sx * sx")} END AS slope
                          FROM (SELECT cod_produto, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx,
                                       sum(qtd) AS sy, sum(x * qtd) AS sxy, max(mes) AS ultimo,
                                       {div("sum(qtd) FILTER (x >= m - 3)", "count(*) FILTER (x >= m - 3)")} AS base
                                FROM (SELECT *, row_number() OVER (PARTITION BY cod_produto ORDER BY mes) - 1 AS x,
                                             count(*) OVER (PARTITION BY cod_produto) AS m
                                      FROM ({_MONTHLY} GROUP BY 1, 2))
                                GROUP BY 1))),
                   generate_series(1, 3) g(i)) f
        JOIN dim_produtos p ON p.cod_produto = f.cod_produto""",
    "previsao_reposicao": f"""
        SELECT cod_produto, descricao, categoria, {dbl("saldo")} AS saldo_atual, estoque_minimo,
               status_estoque, {up("demanda", 1)} AS demanda_media_mensal,
               {up("falta", 0)} AS qtd_sugerida_compra, {dbl(_COST)} AS custo_estimado
        FROM ({_SUPPLY})""",
    "previsao_reposicao_total": f"""
        SELECT 2 AS meses_cobertura, count(*) AS total_itens,
               {dbl(f"coalesce(sum({_COST}), 0)")} AS custo_total_estimado
        FROM ({_SUPPLY})""",
}

DASHBOARD = {
    "dash_kpis": f"""
        SELECT (SELECT {money("sum(valor)")} FROM vendas) AS receita_total,
               (SELECT count(*) FROM pedidos WHERE status <> 'CANCELADO') AS pedidos_ativos,
               (SELECT count(*) FROM dim_produtos) AS produtos_cadastrados,
               (SELECT {money("sum(valor)")} FROM saldos) AS valor_em_estoque,
               (SELECT count(DISTINCT cod_cliente) FROM pedidos) AS clientes_ativos,
               (SELECT count(*) FROM compras WHERE status = 'AGUARDANDO') AS ocs_aguardando""",
    "dash_receita_mensal": f"""
        SELECT t.ano, t.mes, t.nome_mes, {money("sum(valor_total_item)")} AS receita
        FROM pedidos p JOIN itens i ON i.num_pedido = p.num_pedido
        JOIN dim_tempo t ON t.data = p.data_pedido
        WHERE status <> 'CANCELADO' GROUP BY 1, 2, 3""",
    "dash_receita_segmento": f"""
        SELECT c.segmento, {money("sum(valor_total_item)")} AS receita
        FROM pedidos p JOIN itens i ON i.num_pedido = p.num_pedido
        JOIN dim_clientes c ON c.cod_cliente = p.cod_cliente
        WHERE status <> 'CANCELADO' GROUP BY 1""",
    "dash_estoque_top20": f"SELECT * FROM estoque {STOCK_ORDER} LIMIT 20",
    "dash_status_estoque": """
        SELECT count(*) FILTER (status_estoque = 'CRITICO') AS criticos,
               count(*) FILTER (status_estoque = 'ALERTA') AS alertas,
               count(*) FILTER (status_estoque = 'OK') AS ok FROM saldos""",
    "dash_valor_categoria": f"""
        SELECT categoria, {dbl("sum(valor)")} AS valor_estoque FROM saldos GROUP BY 1""",
    "dash_abc": f"""
        SELECT cod_cliente, razao_social AS cliente, segmento, estado, qtd_pedidos AS pedidos,
               {money("receita")} AS receita, {up(div("receita", "qtd_pedidos"), 2)} AS ticket,
               {pct("receita", "total", 1)} AS share_pct, {dbl("acumulado")} AS acum,
               {dbl("total")} AS total_geral, classe_abc
        FROM clientes_abc""",
    "dash_margem_produto": f"""
        SELECT descricao, categoria, {dbl("qtd")} AS qtd, {money("receita")} AS receita,
               {money("custo")} AS cmv, {money("receita - custo")} AS margem,
               {pct("receita - custo", "receita", 1)} AS margem_pct
        FROM margens""",
    "dash_margem_categoria": f"""
        SELECT categoria, {dbl("sum(receita)")} AS receita, {dbl("sum(m)")} AS margem,
               {even(div("sum(m)", "sum(receita)") + " * 100", 1)} AS margem_pct
        FROM (SELECT *, round(receita - custo, 2) AS m FROM margens) GROUP BY 1""",
    "dash_status_pedidos": f"""
        SELECT status, count(*) AS qtd, {money("sum(valor_total_item)")} AS valor
        FROM pedidos p JOIN itens i ON i.num_pedido = p.num_pedido GROUP BY 1""",
    "dash_compras": f"""
        SELECT num_oc, data_oc, status, razao_social AS fornecedor, qtd_itens AS itens,
               {money("valor")} AS valor_total FROM compras_totais""",
    "dash_fornecedores": f"""
        SELECT razao_social AS fornecedor, prazo_entrega_dias, count(DISTINCT num_oc) AS total_ocs,
               {money("sum(valor)")} AS total_comprado
        FROM compras_totais WHERE status <> 'CANCELADO' GROUP BY cod_fornecedor, 1, 2""",
    "dash_status_oc": f"""
        SELECT status, {money("sum(valor)")} AS valor_total FROM compras_totais GROUP BY 1""",
}

EXERCISES = {
    "x_produtos_categoria": "SELECT categoria, count(*) AS total FROM dim_produtos GROUP BY 1",
    "x_top5_clientes_pedidos": """
        SELECT cod_cliente, count(*) AS pedidos FROM pedidos GROUP BY 1
        ORDER BY pedidos DESC, cod_cliente LIMIT 5""",
    "x_receita_mes": f"""
        SELECT strftime(data_pedido, '%Y-%m') AS mes, {money("sum(valor)")} AS receita
        FROM valores WHERE {SOLD} GROUP BY 1""",
    "x_mais_vendidos_abaixo_minimo": f"""
        SELECT s.cod_produto, s.descricao, {dbl("sum(i.quantidade)")} AS total_vendido,
               {dbl("any_value(s.saldo)")} AS saldo_atual, s.estoque_minimo
        FROM itens i JOIN saldos s ON s.cod_produto = i.cod_produto
        WHERE s.saldo < s.estoque_minimo GROUP BY s.cod_produto, s.descricao, s.estoque_minimo
        ORDER BY total_vendido DESC, s.cod_produto LIMIT 5""",
    "x_hist_desconto": f"""
        SELECT faixa, {up("lo + (faixa - 1) * w", 4)} AS de, {up("lo + faixa * w", 4)} AS ate, qtd
        FROM (SELECT least(10, CAST(floor((d - lo) / w) AS INTEGER) + 1) AS faixa, lo, w,
                     count(*) AS qtd
              FROM (SELECT CAST(desconto_percentual AS DOUBLE) AS d, lo, (hi - lo) / 10 AS w
                    FROM pedidos, (SELECT CAST(min(desconto_percentual) AS DOUBLE) AS lo,
                                          CAST(max(desconto_percentual) AS DOUBLE) AS hi
                                   FROM pedidos WHERE desconto_percentual > 0)
                    WHERE desconto_percentual > 0) GROUP BY 1, 2, 3)""",
    "x_receita_por_item_genero": f"""
        SELECT categoria AS genero, {dbl("sum(qtd)")} AS unidades, {money("sum(receita)")} AS receita,
               arg_max(cod_produto, receita) AS melhor_item,
               {money("max(receita)")} AS receita_melhor_item
        FROM (SELECT p.categoria, i.cod_produto, sum(quantidade) AS qtd,
                     sum(valor_total_item) AS receita
              FROM itens i JOIN dim_produtos p ON p.cod_produto = i.cod_produto GROUP BY 1, 2)
        GROUP BY 1""",
    "x_valor_total_estoque": f"""
        SELECT {money("sum(valor)")} AS valor_total, count(*) AS total_produtos FROM saldos""",
    "x_margem_topn": f"""
        SELECT cod_produto, descricao, {dbl("preco_venda - custo_unitario")} AS margem_bruta,
               {pct("preco_venda - custo_unitario", "preco_venda", 1)} AS margem_pct
        FROM dim_produtos ORDER BY margem_pct DESC, margem_bruta DESC, cod_produto LIMIT 5""",
    "x_segmento_credito": f"""
        SELECT segmento, count(*) AS clientes,
               {up(div("sum(limite_credito)", "count(*)"), 2)} AS media_credito
        FROM dim_clientes WHERE segmento = 'MACHINERY' GROUP BY 1""",
}

QUERIES = {**VIEWS, **REPORTS, **API, **FORECAST, **DASHBOARD, **EXERCISES}
