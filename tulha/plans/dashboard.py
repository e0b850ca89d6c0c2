"""Dashboard datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tulha.functions.columns import dbl, half_even, half_up, money, percent, ratio
from tulha.plans.base import calendar, order_values, product_margin, stock, stock_view
from tulha.plans.reports import customer_revenue, ranked_customers
from tulha.plans.views import purchase_totals
from tulha.sources.star import Star


def dash_kpis(star: Star) -> DataFrame:
    """One row of headline figures, each a scalar subquery over its own table."""
    revenue = customer_revenue(star).agg(money(F.sum("receita")))
    orders = (
        star.table("fct_pedidos_venda", "cod_cliente", "status")
        .groupBy("cod_cliente")
        .agg(F.count_if(F.col("status") != "CANCELADO").alias("ativos"))
        .agg(
            F.coalesce(F.sum("ativos"), F.lit(0)).alias("pedidos_ativos"),
            F.count("cod_cliente").alias("clientes_ativos"),
        )
    )
    products = star.table("dim_produtos", "_is_active").filter("_is_active = 1")
    value = stock(star).agg(money(F.sum("valor")))
    waiting = star.table("fct_pedidos_compra", "num_oc", "status").filter("status = 'AGUARDANDO'")
    return orders.select(
        revenue.scalar().alias("receita_total"),
        "pedidos_ativos",
        products.agg(F.count(F.lit(1))).scalar().alias("produtos_cadastrados"),
        value.scalar().alias("valor_em_estoque"),
        "clientes_ativos",
        waiting.agg(F.count(F.lit(1))).scalar().alias("ocs_aguardando"),
    )


def dash_receita_mensal(star: Star) -> DataFrame:
    period = ["ano", "mes", "nome_mes"]
    return (
        order_values(star, ["data_pedido"], ["CANCELADO"])
        .join(calendar(star, *period), F.col("data_pedido") == F.col("data"))
        .groupBy(*period)
        .agg(money(F.sum("valor_bruto")).alias("receita"))
        .orderBy("ano", "mes")
    )


def dash_receita_segmento(star: Star) -> DataFrame:
    """Gross revenue per segment; orders are summed per customer before the join."""
    per_customer = (
        order_values(star, ["cod_cliente"], ["CANCELADO"])
        .groupBy("cod_cliente")
        .agg(F.sum("valor_bruto").cast("decimal(26,2)").alias("bruto"))
    )
    return (
        per_customer.join(star.table("dim_clientes", "cod_cliente", "segmento"), "cod_cliente")
        .groupBy("segmento")
        .agg(money(F.sum("bruto")).alias("receita"))
        .orderBy(F.desc("receita"), "segmento")
    )


def dash_estoque_top20(star: Star) -> DataFrame:
    ordered = stock_view(star).orderBy("status_estoque", "saldo_atual", "cod_produto")
    return ordered.limit(20)


def dash_status_estoque(star: Star) -> DataFrame:
    status = F.col("status_estoque")
    return stock(star).agg(
        F.count_if(status == "CRITICO").alias("criticos"),
        F.count_if(status == "ALERTA").alias("alertas"),
        F.count_if(status == "OK").alias("ok"),
    )


def dash_valor_categoria(star: Star) -> DataFrame:
    return stock(star).groupBy("categoria").agg(dbl(F.sum("valor")).alias("valor_estoque"))


def dash_abc(star: Star) -> DataFrame:
    return (
        ranked_customers(star)
        .orderBy("ranking")
        .select(
            "cod_cliente", F.col("razao_social").alias("cliente"), "segmento", "estado",
            F.col("qtd_pedidos").alias("pedidos"), money("receita").alias("receita"),
            half_up(ratio("receita", "com_valor"), 2).alias("ticket"),
            percent("receita", "total", 1).alias("share_pct"),
            dbl("acumulado").alias("acum"), dbl("total").alias("total_geral"), "classe_abc",
        )
    )


def dash_margem_produto(star: Star) -> DataFrame:
    return (
        product_margin(star)
        .orderBy(F.desc("margem"), "cod_produto")
        .select(
            "descricao", "categoria", dbl("qtd").alias("qtd"), money("receita").alias("receita"),
            money("custo").alias("cmv"), money("margem").alias("margem"),
            percent("margem", "receita", 1).alias("margem_pct"),
        )
    )


def dash_margem_categoria(star: Star) -> DataFrame:
    """Margin per category from the rounded margins per product."""
    totals = (
        product_margin(star)
        .groupBy("categoria")
        .agg(F.sum("receita").alias("r"), F.sum(F.round("margem", 2)).alias("m"))
    )
    return totals.select(
        "categoria", dbl("r").alias("receita"), dbl("m").alias("margem"),
        half_even(ratio("m", "r") * 100, 1).alias("margem_pct"),
    ).orderBy("margem")


def dash_status_pedidos(star: Star) -> DataFrame:
    """Lines and gross value per order status."""
    return (
        order_values(star, [], [])
        .groupBy("status")
        .agg(F.sum("qtd_itens").alias("qtd"), money(F.sum("valor_bruto")).alias("valor"))
        .orderBy(F.desc("qtd"), "status")
    )


def purchases(star: Star) -> DataFrame:
    headers = star.table("fct_pedidos_compra", "num_oc", "data_oc", "status", "cod_fornecedor")
    return headers.join(purchase_totals(star), "num_oc")


def dash_compras(star: Star) -> DataFrame:
    suppliers = star.table("dim_fornecedores", "cod_fornecedor", "razao_social")
    return (
        purchases(star)
        .join(suppliers, "cod_fornecedor")
        .select(
            "num_oc", "data_oc", "status", F.col("razao_social").alias("fornecedor"),
            F.col("qtd_itens").alias("itens"), money("valor").alias("valor_total"),
        )
        .orderBy(F.desc("data_oc"), "num_oc")
    )


def dash_fornecedores(star: Star) -> DataFrame:
    """Purchases per supplier, summed before the supplier join."""
    suppliers = star.table(
        "dim_fornecedores", "cod_fornecedor", "razao_social", "prazo_entrega_dias"
    )
    per_supplier = (
        purchases(star)
        .filter(F.col("status") != "CANCELADO")
        .groupBy("cod_fornecedor")
        .agg(F.count(F.lit(1)).alias("total_ocs"), money(F.sum("valor")).alias("total_comprado"))
    )
    return (
        per_supplier.join(suppliers, "cod_fornecedor")
        .orderBy(F.desc("total_comprado"), "cod_fornecedor")
        .select(
            F.col("razao_social").alias("fornecedor"), "prazo_entrega_dias", "total_ocs",
            "total_comprado",
        )
    )


def dash_status_oc(star: Star) -> DataFrame:
    """Purchase value per status, for orders of known suppliers."""
    known = star.table("dim_fornecedores", "cod_fornecedor")
    return (
        purchases(star)
        .join(known, "cod_fornecedor", "left_semi")
        .groupBy("status")
        .agg(money(F.sum("valor")).alias("valor_total"))
    )
