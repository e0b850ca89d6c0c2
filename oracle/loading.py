"""Raw extracts, cleaning, rules, checks and logs, in SQL."""

import re

from oracle.sql import dbl, even, pct, up

TOKENS = "('', 'NULL', 'null', 'N/A', 'NA', 'NaN')"


def _day(d: str, key: str) -> str:
    return (
        f"CASE ({key}) % 4 WHEN 0 THEN strftime({d}, '%d/%m/%Y') WHEN 1 THEN strftime({d}, '%Y/%m/%d') "
        f"WHEN 2 THEN strftime({d}, '%d-%m-%Y') ELSE strftime({d}, '%Y-%m-%d') END"
    )


def _money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(14,2)) AS VARCHAR)"


def _comma(x: str) -> str:
    return f"replace({x}, '.', ',')"


def _plus(d: str, days: str) -> str:
    return f"({d} + CAST({days} AS INTEGER))"


_COST = "CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(2,1)), 2) AS DECIMAL(12,2))"
_CNPJ = "lpad(CAST(c_custkey * 7919 AS VARCHAR), 14, '0')"
_ORDERED = "CAST(o_orderdate AS DATE)"
_DUE = _plus(_ORDERED, "o_orderkey % 20 - 1")
_RUN_SHIP = "'RUN_' || strftime(l_shipdate, '%Y%m')"
_OC_DUE = _plus("dia", "l_suppkey % 21 - 1")

RAW = {
    "produtos": f"""
        SELECT 'PRD' || p_partkey AS cod_produto, '  ' || p_name || ' ' AS descricao,
               lower(p_type) AS categoria,
               CASE WHEN p_partkey % 40 = 7 THEN 'DZ'
                    ELSE (['UN', 'CX', 'RS', 'LI', 'KG', 'MT', 'PC'])[p_partkey % 7 + 1] END AS unidade,
               CASE WHEN p_partkey % 31 = 3 THEN '0' WHEN p_partkey % 37 = 5 THEN 'N/A'
                    WHEN p_partkey % 43 = 9 THEN {_money("CAST(p_retailprice AS DECIMAL(12,2)) + 1")}
                    WHEN p_partkey % 59 = 11 THEN '0.00004'
                    ELSE {_comma(f"CAST({_COST} AS VARCHAR)")} END AS custo_unitario,
               {_money("p_retailprice")} AS preco_venda,
               CASE WHEN p_partkey % 53 = 0 THEN 'NULL' ELSE CAST(p_size AS VARCHAR) END AS estoque_minimo,
               CASE WHEN p_partkey % 41 = 0 THEN CAST(p_size - 1 AS VARCHAR)
                    ELSE CAST(p_size * 10 AS VARCHAR) END AS estoque_maximo,
               '1' AS ativo, 'FOR' || (p_partkey % 100) AS cod_fornecedor_principal,
               'RUN_199501' AS run
        FROM part""",
    "clientes": f"""
        SELECT 'CLI' || c_custkey AS cod_cliente,
               CASE WHEN c_custkey % 61 = 0 THEN '  ' ELSE lower(c_name) END AS razao_social,
               CASE WHEN c_custkey % 47 = 0 THEN 'NULL'
                    WHEN c_custkey % 43 = 0 THEN substr({_CNPJ}, 1, 13)
                    WHEN c_custkey % 2 = 0 THEN substr({_CNPJ}, 1, 2) || '.' || substr({_CNPJ}, 3, 3)
                        || '.' || substr({_CNPJ}, 6, 3) || '/' || substr({_CNPJ}, 9, 4)
                        || '-' || substr({_CNPJ}, 13, 2)
                    ELSE {_CNPJ} END AS cnpj,
               lower(c_mktsegment) AS segmento, n_name AS cidade, lower(n_name) AS estado,
               CASE WHEN c_custkey % 29 = 0 THEN 'NA' ELSE {_money("c_acctbal")} END AS limite_credito,
               '1' AS ativo,
               {_day(_plus("DATE '1995-01-01'", "c_custkey % 1000"), "c_custkey")} AS data_cadastro,
               'RUN_199501' AS run
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "fornecedores": """
        SELECT 'FOR' || s_suppkey AS cod_fornecedor,
               CASE WHEN s_suppkey % 33 = 5 THEN 'NaN' ELSE s_name END AS razao_social,
               lpad(CAST(s_suppkey * 7907 AS VARCHAR), 14, '0') AS cnpj, 'Geral' AS categoria,
               n_name AS cidade, n_name AS estado,
               CASE WHEN s_suppkey % 17 = 0 THEN '1.5'
                    WHEN s_suppkey % 19 = 0 THEN CAST(s_suppkey % 21 + 1 AS VARCHAR) || '.0'
                    ELSE CAST(s_suppkey % 21 + 1 AS VARCHAR) END
                   AS prazo_entrega_dias,
               '1' AS ativo, 'RUN_199501' AS run
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "pedidos_venda": f"""
        SELECT 'PV' || o_orderkey AS num_pedido,
               CASE WHEN o_orderkey % 89 = 0 THEN 'N/A' ELSE 'CLI' || o_custkey END AS cod_cliente,
               CASE WHEN o_orderkey % 211 = 0 THEN 'sem data'
                    ELSE {_day(_ORDERED, "o_orderkey")} END AS data_pedido,
               {_day(_DUE, "o_orderkey + 1")} AS data_entrega_prevista,
               CASE WHEN o_orderstatus = 'F' THEN {_day(_plus(_DUE, "2"), "o_orderkey + 2")} END
                   AS data_entrega_real,
               CASE WHEN o_orderstatus = 'F' THEN 'ENTREGUE'
                    WHEN o_orderstatus = 'O' THEN ' PROCESSANDO '
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'PENDENTE' ELSE 'EM_SEPARACAO' END AS status,
               CASE WHEN o_orderkey % 97 = 0 THEN '150' WHEN o_orderkey % 13 = 0 THEN 'null'
                    ELSE {_comma("CAST(CAST((o_orderkey % 6) * 0.5 AS DECIMAL(5,1)) AS VARCHAR)")} END
                   AS desconto_percentual,
               o_orderpriority AS observacao, 'RUN_' || strftime(o_orderdate, '%Y%m') AS run
        FROM orders""",
    "itens_pedido_venda": f"""
        SELECT 'PV' || l_orderkey AS num_pedido, CAST(l_linenumber AS VARCHAR) AS seq_item,
               'PRD' || l_partkey AS cod_produto,
               CASE WHEN l_partkey % 101 = 0 THEN '0'
                    ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantidade,
               CASE WHEN l_partkey % 97 = 1 THEN '-' || {_money("l_extendedprice")}
                    ELSE {_comma(_money("l_extendedprice"))} END AS preco_unitario,
               CASE WHEN l_discount = 0 THEN 'N/A'
                    ELSE CAST(CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,1)) AS VARCHAR) END
                   AS desconto_item_percentual,
               {_RUN_SHIP} AS run
        FROM lineitem""",
    "pedidos_compra": f"""
        SELECT 'OC' || l_suppkey || '-' || strftime(dia, '%Y%m') AS num_oc,
               CASE WHEN m % 71 = 0 THEN 'NA' ELSE 'FOR' || l_suppkey END AS cod_fornecedor,
               {_day("dia", "m")} AS data_oc, {_day(_OC_DUE, "l_suppkey")} AS data_entrega_prevista,
               CASE WHEN m % 4 = 3 THEN {_day(_OC_DUE, "l_suppkey + 1")} END AS data_recebimento,
               CASE WHEN m % 4 = 0 THEN 'CANCELADO' WHEN m % 4 = 1 THEN 'AGUARDANDO'
                    WHEN m % 37 = 2 THEN 'ABERTO' WHEN m % 4 = 2 THEN 'PARCIAL' ELSE 'RECEBIDO' END AS status,
               '' AS observacao, 'RUN_' || strftime(dia, '%Y%m') AS run
        FROM (SELECT DISTINCT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS dia,
                     l_suppkey + month(l_shipdate) AS m
              FROM lineitem WHERE l_returnflag = 'R')""",
    "itens_pedido_compra": f"""
        SELECT 'OC' || l_suppkey || '-' || strftime(l_shipdate, '%Y%m') AS num_oc,
               CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS seq_item,
               'PRD' || l_partkey AS cod_produto,
               {_comma("CAST(CAST(l_quantity AS DECIMAL(12,1)) AS VARCHAR)")} AS quantidade,
               CASE WHEN l_partkey % 103 = 0 THEN '-1' ELSE {_money("l_extendedprice")} END AS custo_unitario,
               {_RUN_SHIP} AS run
        FROM lineitem WHERE l_returnflag = 'R'""",
    "movimentacoes_estoque": f"""
        SELECT 'MOV-' || l_orderkey || '-' || l_linenumber AS num_mov,
               CASE WHEN l_orderkey % 113 = 0 THEN '00/00/0000'
                    ELSE {_day("l_shipdate", "l_orderkey")} END AS data_mov,
               CASE WHEN l_partkey % 107 = 0 THEN 'PERDA' WHEN l_returnflag = 'N' THEN 'SAIDA'
                    WHEN l_returnflag = 'R' THEN 'ENTRADA' WHEN l_linestatus = 'O' THEN 'AJUSTE'
                    WHEN l_linenumber % 2 = 0 THEN 'TRANSFERENCIA' ELSE 'DEVOLUCAO' END AS tipo_mov,
               CASE WHEN l_partkey % 109 = 0 THEN '' ELSE 'PRD' || l_partkey END AS cod_produto,
               CASE WHEN l_returnflag = 'A' AND l_linenumber % 2 = 1 THEN '-' ELSE '' END
                   || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantidade,
               {_comma(_money("l_extendedprice"))} AS valor_unitario,
               CASE WHEN l_returnflag = 'R' THEN 'COMPRA' ELSE 'VENDA' END AS origem,
               CASE WHEN l_orderkey % 127 = 0 THEN 'null' ELSE CAST(l_orderkey AS VARCHAR) END AS num_documento,
               '' AS observacao, {_RUN_SHIP} AS run
        FROM lineitem""",
}

LINE_ORDER = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus, l_shipdate"
)
# Keys that repeat in the source; every other key is unique there.
REPEATED = {
    "itens_pedido_venda": "l_orderkey, l_linenumber",
    "movimentacoes_estoque": "l_orderkey, l_linenumber",
    "itens_pedido_compra": "l_suppkey, strftime(l_shipdate, '%Y%m'), l_orderkey, l_linenumber",
}

# entity -> columns with kinds, key, NOT NULL column, rules
ENTITIES = {
    "produtos": (
        "cod_produto:t descricao:t categoria:t unidade:t custo_unitario:n preco_venda:n "
        "estoque_minimo:i estoque_maximo:i ativo:i cod_fornecedor_principal:t",
        "cod_produto", "descricao",
        [("custo_nao_positivo", "custo_unitario IS NULL OR custo_unitario <= 0"),
         ("preco_nao_positivo", "preco_venda IS NULL OR preco_venda <= 0"),
         ("preco_ate_custo", "preco_venda <= custo_unitario"),
         ("unidade_invalida", "unidade IS NULL OR unidade NOT IN ('UN','CX','RS','LI','KG','MT','PC')"),
         ("maximo_abaixo_do_minimo", "estoque_maximo < estoque_minimo")],
        {"descricao": "upper(descricao)", "categoria": "upper(categoria)",
         "margem_bruta": pct("preco_venda - custo_unitario", "preco_venda", 2)},
    ),
    "clientes": (
        "cod_cliente:t razao_social:t cnpj:t segmento:t cidade:t estado:t limite_credito:n ativo:i "
        "data_cadastro:d",
        "cod_cliente", None,
        [("razao_social_ausente", "razao_social IS NULL OR razao_social = ''"),
         ("cnpj_invalido", "cnpj IS NULL OR length(regexp_replace(cnpj, '[^0-9]', '', 'g')) <> 14"),
         ("credito_negativo", "coalesce(limite_credito, 0) < 0")],
        {"cnpj": "regexp_replace(regexp_replace(cnpj, '[^0-9]', '', 'g'), "
                 "'^(..)(...)(...)(....)(..)$', '\\1.\\2.\\3/\\4-\\5')",
         "razao_social": "upper(razao_social)", "segmento": "upper(segmento)",
         "estado": "upper(estado)", "limite_credito": "coalesce(limite_credito, 0)"},
    ),
    "fornecedores": (
        "cod_fornecedor:t razao_social:t cnpj:t categoria:t cidade:t estado:t "
        "prazo_entrega_dias:i ativo:i",
        None, "razao_social", [], {},
    ),
    "pedidos_venda": (
        "num_pedido:t cod_cliente:t data_pedido:d data_entrega_prevista:d data_entrega_real:d "
        "status:t desconto_percentual:n observacao:t",
        "num_pedido", None,
        [("cliente_ausente", "cod_cliente IS NULL"),
         ("status_invalido", "status IS NULL OR status NOT IN ('PROCESSANDO','EM_SEPARACAO','ENTREGUE',"
                             "'CANCELADO','AGUARDANDO_APROVACAO','DEVOLVIDO')"),
         ("desconto_fora_de_0_100", "desconto_percentual < 0 OR desconto_percentual > 100"),
         ("prevista_antes_do_pedido", "data_entrega_prevista < data_pedido")],
        {"desconto_percentual": "coalesce(desconto_percentual, 0)"},
    ),
    "itens_pedido_venda": (
        "num_pedido:t seq_item:i cod_produto:t quantidade:n preco_unitario:n "
        "desconto_item_percentual:n",
        "num_pedido, seq_item", None,
        [("quantidade_nao_positiva", "quantidade IS NULL OR quantidade <= 0"),
         ("preco_nao_positivo", "preco_unitario IS NULL OR preco_unitario <= 0")],
        {"desconto_item_percentual": "coalesce(desconto_item_percentual, 0)",
         "valor_total_item": "round(CAST(quantidade AS DECIMAL(12,2)) * CAST(preco_unitario AS DECIMAL(12,2))"
                             " * (100 - CAST(coalesce(desconto_item_percentual, 0) AS DECIMAL(7,4)))"
                             " * CAST(0.01 AS DECIMAL(2,2)), 2)"},
    ),
    "pedidos_compra": (
        "num_oc:t cod_fornecedor:t data_oc:d data_entrega_prevista:d data_recebimento:d status:t "
        "observacao:t",
        "num_oc", None,
        [("fornecedor_ausente", "cod_fornecedor IS NULL"),
         ("status_invalido", "status IS NULL OR status NOT IN ('AGUARDANDO','RECEBIDO','CANCELADO','PARCIAL')"),
         ("prevista_antes_da_oc", "data_entrega_prevista < data_oc")],
        {},
    ),
    "itens_pedido_compra": (
        "num_oc:t seq_item:i cod_produto:t quantidade:n custo_unitario:n",
        "num_oc, seq_item", None,
        [("quantidade_nao_positiva", "quantidade IS NULL OR quantidade <= 0"),
         ("custo_nao_positivo", "custo_unitario IS NULL OR custo_unitario <= 0")],
        {"valor_total_item": "round(quantidade * custo_unitario, 2)"},
    ),
    "movimentacoes_estoque": (
        "num_mov:t data_mov:d tipo_mov:t cod_produto:t quantidade:n valor_unitario:n origem:t "
        "num_documento:t observacao:t",
        "num_mov", None,
        [("tipo_invalido", "tipo_mov IS NULL OR tipo_mov NOT IN ('ENTRADA','SAIDA','TRANSFERENCIA','AJUSTE','DEVOLUCAO')"),
         ("produto_ausente", "cod_produto IS NULL"),
         ("valor_nao_positivo", "valor_unitario IS NULL OR valor_unitario <= 0"),
         ("documento_ausente", "tipo_mov IN ('ENTRADA','SAIDA') AND num_documento IS NULL"),
         ("data_ausente", "data_mov IS NULL")],
        {"qty_sinal": "CASE WHEN tipo_mov IN ('ENTRADA','AJUSTE') THEN quantidade ELSE -abs(quantidade) END",
         "valor_total_mov": "round(abs(quantidade) * valor_unitario, 2)"},
    ),
}

FORMATS = ["%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d", "%d-%m-%Y"]


def _columns(name: str) -> dict[str, str]:
    return dict(c.split(":") for c in ENTITIES[name][0].split())


def _typed(c: str, kind: str, formats: list[str] = FORMATS) -> str:
    if kind == "d":
        tries = ", ".join(f"try_strptime({c}, '{f}')" for f in formats)
        return f"CAST(coalesce({tries}) AS DATE) AS {c}"
    if kind == "n":
        return f"TRY_CAST(replace({c}, ',', '.') AS DECIMAL(18,4)) AS {c}"
    if kind == "i":
        whole = f"CAST(split_part({c}, '.', 1) AS BIGINT)"
        return f"CASE WHEN regexp_full_match({c}, '[+-]?[0-9]+([.]0*)?') THEN {whole} END AS {c}"
    return f"trim({c}) AS {c}"


def _as_read(name: str) -> list[str]:
    """Numbers before they are rounded to the stored scale, under their own names."""
    numbers = [c for c, k in _columns(name).items() if k == "n"]
    return [_typed(c, "n").replace("(18,4)", "(28,10)") + "_lido" for c in numbers]


def _judged(name: str, source: str) -> str:
    _, _, required, rules, _ = ENTITIES[name]
    for c, kind in _columns(name).items():  # rules see numbers as read
        if kind == "n":
            rules = [(n, re.sub(rf"\b{c}\b", f"{c}_lido", bad)) for n, bad in rules]
    broken = ", ".join(f"CASE WHEN {bad} THEN '{n}' END" for n, bad in rules)
    detail = f"concat_ws(',', {broken})" if rules else "''"
    absent = f"{required} IS NULL" if required else "false"
    return f"""
        SELECT *, CASE WHEN rn > 1 THEN 'DUPLICATE_KEY' WHEN {absent} THEN 'NOT_NULL'
                       WHEN quebras <> '' THEN 'BUSINESS_RULE_VIOLATION' END AS motivo,
               CASE WHEN rn > 1 THEN '' WHEN {absent} THEN '{required}_ausente'
                    ELSE quebras END AS detalhe
        FROM (SELECT *, {detail} AS quebras FROM {source})"""


TABLES: dict[str, str] = {}
for _name, _sql in RAW.items():
    _cols = _columns(_name)
    _nulls = ", ".join(f"CASE WHEN {c} NOT IN {TOKENS} THEN {c} END AS {c}" for c in _cols)
    _types = ", ".join([_typed(c, k) for c, k in _cols.items()] + _as_read(_name))
    if _name in REPEATED:
        _rank = f"row_number() OVER (PARTITION BY {REPEATED[_name]} ORDER BY {LINE_ORDER}) AS rn"
        _sql = _sql.replace("AS run", f"AS run, {_rank}")
    else:
        _sql = _sql.replace("AS run", "AS run, 1 AS rn")
    TABLES[f"bruto_{_name}"] = f"SELECT {_nulls}, run, rn FROM ({_sql})"
    TABLES[f"limpo_{_name}"] = f"SELECT {_types}, run, rn FROM bruto_{_name}"
    TABLES[f"julgado_{_name}"] = _judged(_name, f"limpo_{_name}")


def _valid(name: str) -> str:
    columns, derived = _columns(name), ENTITIES[name][4]
    kinds = {**columns, **{c: "n" for c in derived if c not in columns}}
    parts = []
    for c, kind in kinds.items():
        value = derived.get(c, c)
        parts.append(f"{dbl(value) if kind == 'n' else value} AS {c}")
    return f"SELECT {', '.join(parts)} FROM julgado_{name} WHERE motivo IS NULL"


def _rejected(name: str) -> str:
    parts = [f"{dbl(c)} AS {c}" if k == "n" else c for c, k in _columns(name).items()]
    return f"""
        SELECT {', '.join(parts)}, run AS _pipeline_run_id, motivo AS _reject_reason,
               detalhe AS _reject_detail
        FROM julgado_{name} WHERE motivo IS NOT NULL"""


_RUNS = " UNION ALL ".join(
    f"""SELECT run AS pipeline_run_id, '{n}' AS entity, 'SUCCESS' AS status, count(*) AS input_rows,
               count(*) FILTER (motivo IS NULL) AS valid_rows,
               count(*) FILTER (motivo IS NOT NULL) AS rejected_rows,
               CAST(last_day(strptime(run, 'RUN_%Y%m')) AS TIMESTAMP) + to_hours({i + 1}) AS executed_at
        FROM julgado_{n} GROUP BY run"""
    for i, n in enumerate(RAW)
)
TABLES["execucoes"] = f"""
    SELECT *, CAST(round(input_rows * CAST(0.0015 AS DECIMAL(5,4)), 3) AS DOUBLE) AS elapsed_seconds
    FROM ({_RUNS})"""


def _json(name: str) -> str:
    fields = ", ".join(f"{c} := CAST({c} AS VARCHAR)" for c in _columns(name))
    return f"CAST(to_json(struct_pack({fields})) AS VARCHAR)"


TABLES["rejeitados"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS entity, motivo AS reject_reason, {_json(n)} AS row_data,
               CAST(last_day(strptime(run, 'RUN_%Y%m')) AS TIMESTAMP) + to_hours({i + 1}) AS logged_at
        FROM julgado_{n} WHERE motivo IS NOT NULL"""
    for i, n in enumerate(RAW)
)

_HISTORY = f"""
    SELECT pipeline_run_id, entity, status, input_rows, valid_rows, rejected_rows,
           {up("elapsed_seconds", 2)} AS elapsed_s, executed_at FROM execucoes"""

_SHOWN = {
    "produtos": "categoria", "clientes": "estado", "pedidos_venda": "status",
    "movimentacoes_estoque": "tipo_mov",
}

LOGS = {
    "rejeicoes_por_valor": " UNION ALL ".join(
        f"""SELECT '{n}' AS entidade, CAST({c} AS VARCHAR) AS valor, motivo, count(*) AS qtd
            FROM julgado_{n} WHERE motivo IS NOT NULL GROUP BY ALL"""
        for n, c in _SHOWN.items()
    ),
    "api_execucoes": f"""
        SELECT pipeline_run_id AS run_id, entity AS entidade, status, input_rows AS linhas_lidas,
               valid_rows AS linhas_validas, rejected_rows AS linhas_rejeitadas,
               executed_at - to_microseconds(CAST(round(elapsed_seconds * 1000000) AS BIGINT))
                   AS inicio_execucao,
               executed_at AS fim_execucao, {up("elapsed_seconds", 2)} AS duracao_segundos,
               '' AS erro_mensagem
        FROM execucoes ORDER BY inicio_execucao DESC, run_id, entidade LIMIT 100""",
    "dash_historico": _HISTORY,
    "dash_execucoes_recentes": f"""
        {_HISTORY} ORDER BY executed_at DESC, pipeline_run_id, entity LIMIT 20""",
    "api_rejeicoes": f"""
        SELECT entity AS entidade, CAST(sum(rejected_rows) AS BIGINT) AS total_rejeitadas,
               CAST(sum(input_rows) AS BIGINT) AS total_lidas,
               {pct("sum(rejected_rows)", "sum(input_rows)", 2)} AS taxa_rejeicao_pct
        FROM execucoes WHERE rejected_rows > 0 GROUP BY 1""",
    "entity_report": f"""
        SELECT entity AS entidade, CAST(sum(input_rows) AS BIGINT) AS entrada,
               CAST(sum(valid_rows) AS BIGINT) AS validas,
               CAST(sum(rejected_rows) AS BIGINT) AS rejeitadas,
               {even("sum(rejected_rows)::DOUBLE / sum(input_rows)::DOUBLE * 100", 1)} AS taxa_rejeicao_pct,
               {even("sum(rejected_rows)::DOUBLE / sum(input_rows)::DOUBLE", 4)} AS reject_rate
        FROM execucoes GROUP BY 1""",
    "dash_taxa_ultima_execucao": f"""
        SELECT entity, {even("rejected_rows::DOUBLE / greatest(input_rows, 1)::DOUBLE * 100", 1)} AS taxa_rejeicao
        FROM (SELECT *, max(executed_at) OVER () AS fim,
                     max(executed_at) OVER (PARTITION BY pipeline_run_id) AS fim_da_execucao FROM execucoes)
        WHERE fim_da_execucao = fim""",
    "dash_rejeitados": """
        SELECT entity, reject_reason, logged_at, substr(row_data, 1, 120) AS row_preview
        FROM rejeitados""",
    "dash_rejeicoes_motivo": """
        SELECT entity, reject_reason, count(*) AS qtd FROM rejeitados GROUP BY 1, 2""",
    "dash_qualidade_kpis": """
        SELECT (SELECT count(*) FROM rejeitados) AS total_rejeitados,
               count(DISTINCT entity) AS entidades_monitoradas,
               count(DISTINCT pipeline_run_id) AS execucoes FROM execucoes""",
}

# --- checks ------------------------------------------------------------------
TABLES["bruto_documentos"] = """
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""

CHECKED = {
    **{name: list(_columns(name)) for name in RAW},
    "documentos": ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"],
}
REQUIRED = {
    "produtos": 5, "clientes": 2, "fornecedores": 2, "pedidos_venda": 4, "itens_pedido_venda": 5,
    "pedidos_compra": 4, "itens_pedido_compra": 5, "movimentacoes_estoque": 5, "documentos": 3,
}


def _share(word: str) -> str:
    share = "round(CAST(CASE WHEN t > 0 THEN f::DOUBLE / t ELSE 0 END * 100 AS DECIMAL(38,8)), 1)"
    return f"CASE WHEN f > 0 THEN CAST(CAST({share} AS DECIMAL(5,1)) AS VARCHAR) || '% {word}' ELSE '' END"


def _check(entity: str, name: str, status: str, failed: str, total: str, detail: str, source: str) -> str:
    return f"""
        SELECT '{entity}' AS entity, '{name}' AS check_name, {status} AS status, t - f AS passed_rows,
               f AS failed_rows, t AS total_rows, {detail} AS detail,
               CASE WHEN t > 0 THEN (t - f)::DOUBLE / t ELSE 0.0::DOUBLE END AS pass_rate
        FROM (SELECT CAST({failed} AS BIGINT) AS f, CAST({total} AS BIGINT) AS t {source})"""


def _battery() -> str:
    parts = []
    for entity, columns in CHECKED.items():
        n = REQUIRED[entity]
        parts.append(_check(entity, "required_columns", "'PASS'", "0", str(n), "''", ""))
        null_status = (
            "CASE WHEN f::DOUBLE / t <= 0.10 THEN 'PASS' WHEN f::DOUBLE / t < 0.30 THEN 'WARN' ELSE 'FAIL' END"
        )
        for c in columns:
            parts.append(
                _check(entity, f"null_check:{c}", null_status, f"count(*) - count({c})", "count(*)",
                       _share("null"), f"FROM bruto_{entity}")
            )
        parts.append(
            _check(entity, "duplicate_rows",
                   "CASE WHEN f = 0 THEN 'PASS' WHEN f::DOUBLE / t <= 0.05 THEN 'WARN' ELSE 'FAIL' END",
                   "sum(n - 1)", "sum(n)", _share("duplicates"),
                   f"FROM (SELECT count(*) AS n FROM bruto_{entity} GROUP BY {', '.join(columns)})")
        )
    return " UNION ALL ".join(parts)


TABLES["checagens"] = _battery()

_PASS_FAIL = "CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END"


def _orphans(child: str, column: str, parent: str, key: str, name: str) -> str:
    return _check(
        name, f"foreign_key:{column}", _PASS_FAIL,
        f"count(*) FILTER ({column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent}))",
        "count(*)", _share("orphans"), f"FROM {child}",
    )


def _accepted(entity: str) -> str:
    return f"(SELECT * FROM julgado_{entity} WHERE motivo IS NULL)"


def _predicates(entity: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        _check(entity, n, _PASS_FAIL, f"count(*) FILTER ({bad})", "count(*)", _share("invalid"),
               f"FROM limpo_{entity}")
        for n, bad in rules.items()
    )


def _unreadable(entity: str) -> str:
    columns = [c for c, k in _columns(entity).items() if k == "d"]
    return " UNION ALL ".join(
        f"""SELECT '{entity}' AS entidade, '{c}' AS coluna, count(b.{c}) AS preenchidas,
                   count(b.{c}) - count(coalesce({', '.join(f"try_strptime(b.{c}, '{f}')" for f in FORMATS)})) AS ilegiveis
            FROM bruto_{entity} b"""
        for c in columns
    )


_VOTE = " ".join(
    f"WHEN 2 * (SELECT count(try_strptime(data_mov, '{f}')) FROM bruto_movimentacoes_estoque)"
    f" > (SELECT count(*) FROM bruto_movimentacoes_estoque) THEN try_strptime(data_mov, '{f}')"
    for f in FORMATS
)
_voted = [
    f"CAST(CASE {_VOTE} ELSE try_strptime(data_mov, '{FORMATS[-1]}') END AS DATE) AS data_mov"
    if c == "data_mov" else _typed(c, k)
    for c, k in _columns("movimentacoes_estoque").items()
] + _as_read("movimentacoes_estoque")
TABLES["limpo_voto"] = f"SELECT {', '.join(_voted)}, run, rn FROM bruto_movimentacoes_estoque"
TABLES["julgado_voto"] = _judged("movimentacoes_estoque", "limpo_voto")

CHECKS = {
    "dq_checks": "SELECT * FROM checagens",
    "dq_resumo": """
        SELECT * , CASE WHEN failed > 0 THEN 'FAIL' WHEN warned > 0 THEN 'WARN' ELSE 'PASS' END AS overall
        FROM (SELECT CASE WHEN grouping(entity) = 1 THEN 'TOTAL' ELSE entity END AS entity,
                     CASE WHEN grouping(entity) = 0 THEN
                         max(total_rows) FILTER (check_name = 'duplicate_rows') END AS linhas,
                     count(*) AS checks, count(*) FILTER (status = 'PASS') AS passed,
                     count(*) FILTER (status = 'WARN') AS warned,
                     count(*) FILTER (status = 'FAIL') AS failed,
                     CASE WHEN grouping(entity) = 0 THEN
                         string_agg(check_name, ', ' ORDER BY check_name) FILTER (status = 'FAIL') END AS falhas
              FROM checagens GROUP BY ROLLUP (entity))""",
    "dq_integridade": " UNION ALL ".join([
        _orphans("pedidos", "cod_cliente", "dim_clientes", "cod_cliente", "fct_pedidos_venda"),
        _orphans("itens", "num_pedido", "pedidos", "num_pedido", "fct_itens_pedido_venda"),
        _orphans("itens", "cod_produto", "dim_produtos", "cod_produto", "fct_itens_pedido_venda"),
        _orphans("compras", "cod_fornecedor", "dim_fornecedores", "cod_fornecedor", "fct_pedidos_compra"),
        _orphans("itens_compra", "num_oc", "compras", "num_oc", "fct_itens_pedido_compra"),
        _orphans("itens_compra", "cod_produto", "dim_produtos", "cod_produto", "fct_itens_pedido_compra"),
        _orphans("movimentos", "cod_produto", "dim_produtos", "cod_produto", "fct_movimentacoes_estoque"),
    ]),
    "dq_integridade_validos": " UNION ALL ".join(
        _orphans(_accepted(child), column, _accepted(parent), column, f"fct_{child}")
        for child, column, parent in [
            ("pedidos_venda", "cod_cliente", "clientes"),
            ("itens_pedido_venda", "num_pedido", "pedidos_venda"),
            ("itens_pedido_venda", "cod_produto", "produtos"),
            ("pedidos_compra", "cod_fornecedor", "fornecedores"),
            ("itens_pedido_compra", "num_oc", "pedidos_compra"),
            ("itens_pedido_compra", "cod_produto", "produtos"),
            ("movimentacoes_estoque", "cod_produto", "produtos"),
        ]
    ),
    "dq_predicados": _predicates("pedidos_venda", {
        "desconto_faixa": "desconto_percentual < 0 OR desconto_percentual > 100",
        "status_dominio": "status IS NULL OR status NOT IN ('PROCESSANDO','EM_SEPARACAO','ENTREGUE',"
                          "'CANCELADO','AGUARDANDO_APROVACAO','DEVOLVIDO')",
        "prevista_antes_do_pedido": "data_entrega_prevista < data_pedido",
        "real_antes_do_pedido": "data_entrega_real < data_pedido",
    }) + " UNION ALL " + _predicates("produtos", {
        "estoque_minimo_faixa": "estoque_minimo < 0",
        "ativo_dominio": "ativo IS NULL OR ativo NOT IN (0, 1)",
    }),
    "dq_datas_ilegiveis": " UNION ALL ".join(
        _unreadable(e) for e in ("clientes", "pedidos_venda", "pedidos_compra", "movimentacoes_estoque")
    ),
    "etl_movimentacoes_voto": """
        SELECT coalesce(motivo, 'VALID') AS resultado, detalhe, count(*) AS qtd
        FROM julgado_voto GROUP BY 1, 2""",
}

# --- hash, merge, load check, calendar, unknown products ---------------------
TABLES["lote"] = """
    SELECT o_custkey * 2 AS cod_cliente, CAST(o_totalprice AS DECIMAL(14,2)) AS limite_credito,
           'PEDIDO ' || o_orderkey AS razao_social
    FROM orders WHERE o_orderstatus = 'P'
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
_HASHED = ", ".join(f"coalesce({c}, 'nan')" for c in _columns("pedidos_venda"))

MISC = {
    "src_nomes_produtos": f"SELECT {', '.join(_columns('produtos'))} FROM bruto_produtos",
    "src_row_hash": f"""
        SELECT num_pedido, md5(concat_ws('|', {_HASHED})) AS _row_hash FROM bruto_pedidos_venda""",
    "upsert_clientes": f"""
        SELECT cod_cliente, razao_social, CAST(NULL AS VARCHAR) AS segmento,
               CAST(NULL AS VARCHAR) AS estado, {dbl("limite_credito")} AS limite_credito, 1 AS _is_active
        FROM lote
        UNION ALL
        SELECT cod_cliente, razao_social, segmento, estado, {dbl("limite_credito")}, 1
        FROM dim_clientes WHERE cod_cliente NOT IN (SELECT cod_cliente FROM lote)""",
    "verificacao_carga": """
        SELECT 'dim_produtos' AS tabela, count(*) AS registros FROM dim_produtos
        UNION ALL SELECT 'dim_clientes', count(*) FROM dim_clientes
        UNION ALL SELECT 'fct_pedidos_venda', count(*) FROM pedidos
        UNION ALL SELECT 'fct_movimentacoes_estoque', count(*) FROM movimentos""",
    "calendario_pedidos": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS data_key, d AS data,
               CAST(year(d) AS INTEGER) AS ano, CAST(ceil(month(d) / 6.0) AS INTEGER) AS semestre,
               CAST(quarter(d) AS INTEGER) AS trimestre, CAST(month(d) AS INTEGER) AS mes,
               monthname(d) AS nome_mes, CAST(weekofyear(d) AS INTEGER) AS semana_ano,
               CAST(day(d) AS INTEGER) AS dia, CAST(isodow(d) AS INTEGER) AS dia_semana,
               dayname(d) AS nome_dia, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_fim_semana,
               pedidos
        FROM (SELECT data_pedido AS d, count(*) AS pedidos FROM pedidos GROUP BY 1)""",
    "x_fk_reject": f"""
        SELECT i.cod_produto, count(*) AS linhas, {dbl("sum(i.valor)")} AS valor
        FROM (SELECT * , round(quantidade * preco_unitario, 2) AS valor FROM {_accepted("itens_pedido_venda")}) i
        WHERE i.cod_produto NOT IN (SELECT cod_produto FROM {_accepted("produtos")})
        GROUP BY 1""",
}

# --- loads from landed files -------------------------------------------------
_ODD_NAME = """CASE WHEN cod_cliente LIKE '%0' THEN 'Loja "' || razao_social || '", filial'
                    WHEN cod_cliente LIKE '%5' THEN razao_social || chr(10) || 'segunda linha'
                    ELSE razao_social END"""
_CLIENT = [c for c in _columns("clientes") if c != "razao_social"]
_CLIENT_HASH = ", ".join(f"coalesce({c}, 'nan')" for c in _columns("clientes"))
TARGETS = {n: f"{'dim' if n in ('produtos', 'clientes', 'fornecedores') else 'fct'}_{n}" for n in RAW}

LOADS = {
    "src_csv_clientes": f"""
        SELECT *, md5(concat_ws('|', {_CLIENT_HASH})) AS _row_hash, CAST(NULL AS VARCHAR) AS _malformed
        FROM (SELECT {', '.join(_CLIENT)}, {_ODD_NAME} AS razao_social FROM bruto_clientes)""",
    "carga_fornecedores": _valid("fornecedores"),
    "carga_log": " UNION ALL ".join(
        f"""SELECT '{n}' AS entity, 'SUCCESS' AS status, count(*) AS input_rows,
                   count(*) FILTER (motivo IS NULL) AS valid_rows,
                   count(*) FILTER (motivo IS NOT NULL) AS rejected_rows FROM julgado_{n}"""
        for n in RAW
    ),
    "carga_metadados": " UNION ALL ".join(
        f"""SELECT '{TARGETS[n]}' AS tabela, count(*) AS registros, count(*) AS ativos,
                   count(*) AS carimbados FROM julgado_{n} WHERE motivo IS NULL
            UNION ALL SELECT 'stg_{n}', count(*), NULL, NULL FROM bruto_{n}"""
        for n in RAW
    ),
    "carga_rejeitos_csv": """
        SELECT cod_produto, motivo AS _reject_reason, detalhe AS _reject_detail
        FROM julgado_produtos WHERE motivo IS NOT NULL""",
}

STREAMS = {
    "st_ingestao_pedidos": _valid("pedidos_venda"),
    "st_saldo_produto": f"""
        SELECT cod_produto, count(*) AS movimentos,
               {dbl("sum(CASE WHEN tipo_mov IN ('ENTRADA','AJUSTE') THEN quantidade ELSE -abs(quantidade) END)")}
                   AS saldo_atual
        FROM movimentos GROUP BY 1""",
}

STREAMS["st_saldo_repetidos"] = STREAMS["st_saldo_produto"]
STREAMS["st_itens_orfaos"] = f"""
    SELECT num_pedido, seq_item, 'ORPHAN' AS reject_reason FROM {_accepted("itens_pedido_venda")}
    WHERE num_pedido NOT IN (SELECT num_pedido FROM {_accepted("pedidos_venda")})"""

QUERIES = {
    **STREAMS,
    **LOADS,
    **{f"etl_{n}_validos": _valid(n) for n in RAW},
    **{f"etl_{n}_rejeitados": _rejected(n) for n in RAW},
    **LOGS,
    **CHECKS,
    **MISC,
}
