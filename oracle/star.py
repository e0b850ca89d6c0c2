"""Star schema derived from the TPC-H-like tables, as WITH entries."""

from oracle.sql import pct

COST = "CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(2,1)), 2) AS DECIMAL(12,2))"

TABLES = {
    "dim_produtos": f"""
        SELECT p_partkey AS cod_produto, upper(p_name) AS descricao, p_type AS categoria,
               'UN' AS unidade, {COST} AS custo_unitario,
               CAST(p_retailprice AS DECIMAL(12,2)) AS preco_venda,
               p_size AS estoque_minimo, p_size * 10 AS estoque_maximo,
               p_partkey % (SELECT count(*) FROM supplier) AS cod_fornecedor_principal
        FROM part""",
    "dim_clientes": """
        SELECT c_custkey AS cod_cliente, upper(c_name) AS razao_social,
               c_mktsegment AS segmento, n_name AS estado,
               CAST(c_acctbal AS DECIMAL(14,2)) AS limite_credito
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "dim_fornecedores": """
        SELECT s_suppkey AS cod_fornecedor, upper(s_name) AS razao_social, n_name AS categoria,
               CAST(1 + s_suppkey % 21 AS INTEGER) AS prazo_entrega_dias
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "dim_tempo": """
        SELECT CAST(d AS DATE) AS data, CAST(year(d) AS INTEGER) AS ano,
               CAST(quarter(d) AS INTEGER) AS trimestre, CAST(month(d) AS INTEGER) AS mes,
               monthname(d) AS nome_mes
        FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) g(d)""",
    "pedidos": """
        SELECT o_orderkey AS num_pedido, o_custkey AS cod_cliente,
               CAST(o_orderdate AS DATE) AS data_pedido,
               CAST(o_orderdate AS DATE) + CAST(10 + o_orderkey % 20 AS INTEGER)
                   AS data_entrega_prevista,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE)
                   + CAST(10 + o_orderkey % 20 + o_orderkey % 5 - 2 AS INTEGER) END
                   AS data_entrega_real,
               CASE WHEN o_orderstatus = 'F' THEN 'ENTREGUE'
                    WHEN o_orderstatus = 'O' THEN 'PROCESSANDO'
                    WHEN o_orderpriority = '1-URGENT' THEN 'CANCELADO'
                    WHEN o_orderpriority = '2-HIGH' THEN 'DEVOLVIDO'
                    ELSE 'EM_SEPARACAO' END AS status,
               CAST(o_orderkey % 6 AS DECIMAL(5,2)) AS desconto_percentual
        FROM orders""",
    "linhas": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
               CAST(l_quantity AS DECIMAL(12,2)) AS quantidade,
               CAST(l_shipdate AS DATE) AS data_envio,
               CAST(round(CAST(l_extendedprice AS DECIMAL(14,2))
                          * (1 - CAST(l_discount AS DECIMAL(5,2))), 2) AS DECIMAL(14,2)) AS valor
        FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                     l_returnflag, l_linestatus, l_shipdate) = 1""",
    "itens": """
        SELECT l_orderkey AS num_pedido, l_linenumber AS seq_item, l_partkey AS cod_produto,
               quantidade, valor AS valor_total_item
        FROM linhas""",
    "tipos": """
        SELECT *, CASE WHEN l_returnflag = 'N' THEN 'SAIDA'
                       WHEN l_returnflag = 'R' THEN 'ENTRADA'
                       WHEN l_linestatus = 'O' THEN 'AJUSTE'
                       WHEN l_linenumber % 2 = 0 THEN 'TRANSFERENCIA'
                       ELSE 'DEVOLUCAO' END AS tipo_mov
        FROM linhas""",
    "movimentos": """
        SELECT l_orderkey || '-' || l_linenumber AS num_mov, data_envio AS data_mov, tipo_mov,
               l_partkey AS cod_produto, l_orderkey,
               CASE WHEN tipo_mov = 'AJUSTE' AND l_linenumber % 2 = 1
                    THEN -quantidade ELSE quantidade END AS quantidade,
               CASE WHEN tipo_mov = 'ENTRADA' THEN quantidade
                    WHEN tipo_mov = 'AJUSTE' AND l_linenumber % 2 = 1 THEN -quantidade
                    WHEN tipo_mov = 'AJUSTE' THEN quantidade
                    ELSE -quantidade END AS qty_sinal,
               round(quantidade * custo_unitario, 2) AS valor_total_mov
        FROM tipos LEFT JOIN dim_produtos ON l_partkey = cod_produto""",
    "recebidas": """
        SELECT l_suppkey || '-' || strftime(data_envio, '%Y%m') AS num_oc, l_suppkey,
               CAST(date_trunc('month', data_envio) AS DATE) AS data_oc,
               l_orderkey * 10 + l_linenumber AS seq_item, l_partkey AS cod_produto, quantidade
        FROM linhas WHERE l_returnflag = 'R'""",
    "compras": """
        SELECT DISTINCT num_oc, l_suppkey AS cod_fornecedor, data_oc,
               CASE (l_suppkey + month(data_oc)) % 4 WHEN 0 THEN 'CANCELADO'
                    WHEN 1 THEN 'AGUARDANDO' WHEN 2 THEN 'PARCIAL' ELSE 'RECEBIDO' END AS status
        FROM recebidas""",
    "itens_compra": """
        SELECT num_oc, seq_item, r.cod_produto, quantidade,
               round(quantidade * custo_unitario, 2) AS valor_total_item
        FROM recebidas r LEFT JOIN dim_produtos p ON r.cod_produto = p.cod_produto""",
    # --- the views, with exact values ----------------------------------------
    "totais": """
        SELECT num_pedido, count(seq_item) AS qtd_itens,
               CAST(sum(valor_total_item) AS DECIMAL(24,2)) AS bruto
        FROM itens GROUP BY num_pedido""",
    "valores": """
        SELECT p.*, t.qtd_itens, t.bruto,
               CAST(round(t.bruto * (100 - p.desconto_percentual) * CAST(0.01 AS DECIMAL(2,2)), 2)
                    AS DECIMAL(24,2)) AS valor
        FROM pedidos p LEFT JOIN totais t ON p.num_pedido = t.num_pedido""",
    "vendas": """
        SELECT v.*, c.razao_social, c.segmento, c.estado, t.mes, t.trimestre, t.ano, t.nome_mes
        FROM valores v JOIN dim_clientes c ON v.cod_cliente = c.cod_cliente
        LEFT JOIN dim_tempo t ON t.data = v.data_pedido
        WHERE v.status <> 'CANCELADO' AND v.qtd_itens IS NOT NULL""",
    "saldos": """
        SELECT p.*, s.saldo, s.saldo * p.custo_unitario AS valor,
               CASE WHEN s.saldo <= estoque_minimo THEN 'CRITICO'
                    WHEN s.saldo <= estoque_minimo * 1.5 THEN 'ALERTA' ELSE 'OK' END
                   AS status_estoque
        FROM dim_produtos p JOIN (
            SELECT p.cod_produto,
                   CAST(coalesce(sum(m.qty_sinal), 0) AS DECIMAL(24,2)) AS saldo
            FROM dim_produtos p LEFT JOIN movimentos m ON p.cod_produto = m.cod_produto
            GROUP BY p.cod_produto) s ON s.cod_produto = p.cod_produto""",
    "estoque": """
        SELECT cod_produto, descricao, categoria, unidade,
               CAST(custo_unitario AS DOUBLE) AS custo_unitario,
               CAST(preco_venda AS DOUBLE) AS preco_venda, estoque_minimo, estoque_maximo,
               CAST(saldo AS DOUBLE) AS saldo_atual, CAST(valor AS DOUBLE) AS valor_estoque,
               status_estoque
        FROM saldos""",
    "compras_totais": """
        SELECT c.*, f.razao_social, f.categoria, f.prazo_entrega_dias, i.qtd_itens, i.valor
        FROM compras c JOIN dim_fornecedores f ON c.cod_fornecedor = f.cod_fornecedor
        JOIN (SELECT num_oc, count(seq_item) AS qtd_itens,
                     CAST(sum(valor_total_item) AS DECIMAL(24,2)) AS valor
              FROM itens_compra GROUP BY num_oc) i ON i.num_oc = c.num_oc""",
    "margens": """
        SELECT p.cod_produto, p.descricao, p.categoria, p.custo_unitario, p.preco_venda,
               sum(i.quantidade) AS qtd, sum(i.valor_total_item) AS receita,
               sum(i.quantidade * p.custo_unitario) AS custo
        FROM itens i JOIN dim_produtos p ON i.cod_produto = p.cod_produto
        JOIN pedidos v ON i.num_pedido = v.num_pedido
        WHERE v.status NOT IN ('CANCELADO', 'DEVOLVIDO')
        GROUP BY ALL""",
    "clientes_receita": """
        SELECT cod_cliente, razao_social, segmento, estado,
               count(DISTINCT num_pedido) AS qtd_pedidos, sum(valor) AS receita,
               avg(CAST(valor AS DOUBLE)) AS media,
               min(data_pedido) AS primeiro_pedido, max(data_pedido) AS ultimo_pedido
        FROM vendas GROUP BY ALL""",
    "clientes_acumulado": """
        SELECT r.*, row_number() OVER (ORDER BY receita DESC, cod_cliente) AS ranking,
               sum(receita) OVER (ORDER BY receita DESC, cod_cliente
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acumulado, t.total
        FROM clientes_receita r, (SELECT sum(receita) AS total FROM clientes_receita) t""",
    "clientes_abc": f"""
        SELECT *, CASE WHEN acumulado <= total * CAST(0.80 AS DECIMAL(3,2)) THEN 'A'
                       WHEN acumulado <= total * CAST(0.95 AS DECIMAL(3,2)) THEN 'B'
                       ELSE 'C' END AS classe_abc,
               {pct("receita", "total", 2)} AS share_pct
        FROM clientes_acumulado""",
}
