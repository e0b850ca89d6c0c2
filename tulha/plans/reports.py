"""Operational and managerial reports."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from tulha.functions.columns import dbl, half_up, margin_percent, money, percent, ratio
from tulha.model import ABC_LIMITS
from tulha.operators.running import running_total
from tulha.plans.base import (
    calendar, order_values, product_margin, stock,
)
from tulha.sources.star import Star

DELIVERED_OR_VOID = ["ENTREGUE", "CANCELADO", "DEVOLVIDO"]


def estoque_atual(star: Star) -> DataFrame:
    """Stock position, critical products first."""
    urgency = (
        F.when(F.col("status_estoque") == "CRITICO", 1)
        .when(F.col("status_estoque") == "ALERTA", 2)
        .otherwise(3)
    )
    return (
        stock(star)
        .orderBy(urgency, "descricao", "cod_produto")
        .select(
            "cod_produto", "descricao", "categoria", "unidade", dbl("saldo").alias("saldo_atual"),
            "estoque_minimo", "estoque_maximo", money("valor").alias("valor_estoque"),
            dbl("custo_unitario").alias("custo_unitario"),
            dbl("preco_venda").alias("preco_venda"), "status_estoque",
        )
    )


def pedidos_em_aberto(star: Star, as_of: str) -> DataFrame:
    """Orders neither delivered nor void, with age and lateness on ``as_of``."""
    today = F.lit(dt.date.fromisoformat(as_of))
    customers = star.table("dim_clientes", "cod_cliente", "razao_social", "estado")
    columns = ["data_pedido", "data_entrega_prevista", "cod_cliente"]
    return (
        order_values(star, columns, DELIVERED_OR_VOID)
        .join(customers, "cod_cliente")
        .select(
            "num_pedido", "data_pedido", "data_entrega_prevista", "status",
            F.col("razao_social").alias("cliente"), "estado", "qtd_itens",
            dbl("valor").alias("valor_liquido"),
            F.datediff(today, "data_pedido").alias("dias_em_aberto"),
            F.when(F.col("data_entrega_prevista") < today, "ATRASADO")
            .otherwise("NO_PRAZO")
            .alias("situacao_entrega"),
        )
        .orderBy("data_entrega_prevista", "num_pedido")
    )


def produtos_abaixo_minimo(star: Star) -> DataFrame:
    """Products at or below their minimum, with the cost of refilling and the supplier."""
    supplier_of = star.table("dim_produtos", "cod_produto", "cod_fornecedor_principal")
    suppliers = star.table(
        "dim_fornecedores", "cod_fornecedor", "razao_social", "prazo_entrega_dias"
    )
    missing = F.col("estoque_minimo") - F.col("saldo")
    return (
        stock(star)
        .filter(F.col("status_estoque") == "CRITICO")
        .join(supplier_of, "cod_produto")
        .join(suppliers, F.col("cod_fornecedor_principal") == F.col("cod_fornecedor"))
        .select(
            "cod_produto", "descricao", "categoria", "unidade", dbl("saldo").alias("saldo_atual"),
            "estoque_minimo", dbl(missing).alias("deficit"),
            dbl("custo_unitario").alias("custo_unitario"),
            money(missing * F.col("custo_unitario")).alias("custo_reposicao_minimo"),
            F.col("razao_social").alias("fornecedor_principal"), "prazo_entrega_dias",
        )
        .orderBy(F.desc("deficit"), "cod_produto")
    )


def change_percent(current: Column, previous: Column, digits: int) -> Column:
    return percent(current - previous, previous, digits)


def vendas_por_periodo(star: Star) -> DataFrame:
    """Revenue per month with the change against the previous month present.

    Orders are summed per (month, customer) first: the customer check, the
    distinct count and the month sums all work on that smaller set.
    """
    period = ["ano", "mes", "nome_mes", "trimestre"]
    per_customer = (
        order_values(star, ["data_pedido", "cod_cliente"], ["CANCELADO"])
        .join(calendar(star, *period), F.col("data_pedido") == F.col("data"))
        .groupBy(*period, "cod_cliente")
        .agg(
            F.count(F.lit(1)).alias("pedidos"),
            F.count("valor").alias("com_valor"),
            F.sum("valor").cast("decimal(28,2)").alias("valor"),
        )
        .join(star.table("dim_clientes", "cod_cliente"), "cod_cliente", "left_semi")
    )
    monthly = per_customer.groupBy(*period).agg(
        F.sum("pedidos").alias("qtd_pedidos"),
        F.count("cod_cliente").alias("clientes_unicos"),
        F.sum("valor").cast("decimal(30,2)").alias("receita"),
        F.sum("com_valor").alias("com_valor"),
    )
    # One row per calendar month: the unpartitioned window is bounded.
    previous = F.lag("receita").over(Window.orderBy("ano", "mes"))
    return (
        monthly.withColumn("anterior", previous)
        .select(
            *period, "qtd_pedidos", "clientes_unicos", money("receita").alias("receita_liquida"),
            half_up(ratio("receita", "com_valor"), 2).alias("ticket_medio"),
            change_percent(F.col("receita"), F.col("anterior"), 1).alias("variacao_mom_pct"),
        )
        .orderBy("ano", "mes")
    )


def customer_revenue(star: Star) -> DataFrame:
    """Revenue per known customer, summed before the customer join."""
    per_customer = (
        order_values(star, ["data_pedido", "cod_cliente"], ["CANCELADO"])
        .groupBy("cod_cliente")
        .agg(
            F.count(F.lit(1)).alias("qtd_pedidos"),
            F.count("valor").alias("com_valor"),
            F.sum("valor").cast("decimal(24,2)").alias("receita"),
            F.min("data_pedido").alias("primeiro_pedido"),
            F.max("data_pedido").alias("ultimo_pedido"),
        )
    )
    customers = star.table("dim_clientes", "cod_cliente", "razao_social", "segmento", "estado")
    return per_customer.join(customers, "cod_cliente")


def abc_class(running: Column, total: Column) -> Column:
    """Class by cumulative share, the row itself included; compared exactly."""
    limits = {k: F.lit(Decimal(v)) for k, v in ABC_LIMITS.items()}
    return (
        F.when(running <= total * limits["A"], "A")
        .when(running <= total * limits["B"], "B")
        .otherwise("C")
    )


def ranked_customers(star: Star) -> DataFrame:
    """Customers in order of revenue with rank, running revenue, total and ABC class."""
    ranked = running_total(
        customer_revenue(star),
        "receita",
        [F.desc("receita"), F.asc("cod_cliente")],
        position="ranking",
        running="acumulado",
        total="total",
    )
    exact = ranked.withColumns(
        {
            "acumulado": F.col("acumulado").cast("decimal(30,2)"),
            "total": F.col("total").cast("decimal(30,2)"),
        }
    )
    return exact.withColumn("classe_abc", abc_class(F.col("acumulado"), F.col("total")))


def top_clientes(star: Star) -> DataFrame:
    """Customers by revenue with share, cumulative share and ABC class."""
    return (
        ranked_customers(star)
        .select(
            "ranking", "cod_cliente", F.col("razao_social").alias("cliente"), "segmento", "estado",
            "qtd_pedidos", money("receita").alias("receita_total"),
            half_up(ratio("receita", "com_valor"), 2).alias("ticket_medio"),
            percent("receita", "total", 2).alias("share_pct"),
            percent("acumulado", "total", 1).alias("share_acumulado_pct"),
            "classe_abc", "primeiro_pedido", "ultimo_pedido",
        )
        .orderBy("ranking")
    )


def giro_estoque(star: Star) -> DataFrame:
    """Stock turnover: quantity out over half the net movement, and days of cover."""
    kind, qty = F.col("tipo_mov"), F.col("qty_sinal")
    moves = (
        star.table(
            "fct_movimentacoes_estoque", "cod_produto", "tipo_mov", "qty_sinal", "valor_total_mov"
        )
        .groupBy("cod_produto")
        .agg(
            F.sum(F.when(kind == "SAIDA", F.abs(qty))).alias("saida"),
            F.sum(F.when(kind == "SAIDA", F.col("valor_total_mov"))).alias("cmv"),
            F.sum(F.when(kind.isin("ENTRADA", "SAIDA"), qty).otherwise(0)).alias("liquido"),
        )
    )
    products = star.table(
        "dim_produtos", "cod_produto", "descricao", "categoria", "custo_unitario", "_is_active"
    ).filter("_is_active = 1")
    out = dbl(F.coalesce("saida", F.lit(0)))
    average = dbl(F.coalesce("liquido", F.lit(0))) / 2
    turnover = ratio(out, F.abs(average))
    return (
        products.join(moves, "cod_produto", "left")
        .select(
            "cod_produto", "descricao", "categoria", dbl("custo_unitario").alias("custo_unitario"),
            out.alias("total_saida_qtd"),
            dbl(F.coalesce("cmv", F.lit(0))).alias("cmv_periodo"),
            average.alias("estoque_medio_qtd"),
            half_up(turnover, 2).alias("giro_estoque"),
            half_up(ratio(F.lit(365), turnover), 0).alias("dias_cobertura"),
        )
        .orderBy(F.desc_nulls_last("giro_estoque"), "cod_produto")
    )


def margem_por_produto(star: Star) -> DataFrame:
    """Margin per product sold, against the catalog cost."""
    return (
        product_margin(star)
        .select(
            "cod_produto", "descricao", "categoria", dbl("custo_unitario").alias("custo_unitario"),
            dbl("preco_venda").alias("preco_venda"),
            margin_percent("custo_unitario", "preco_venda").alias("margem_bruta_catalog_pct"),
            dbl("qtd").alias("qtd_vendida"), money("receita").alias("receita_bruta"),
            money("custo").alias("cmv"), money("margem").alias("margem_bruta_valor"),
            percent("margem", "receita", 2).alias("margem_bruta_pct"),
        )
        .orderBy(F.desc("margem_bruta_valor"), "cod_produto")
    )


__all__ = [
    "estoque_atual", "pedidos_em_aberto", "produtos_abaixo_minimo", "vendas_por_periodo",
    "top_clientes", "giro_estoque", "margem_por_produto",
]
