"""The three analytical views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tulha.functions.columns import dbl
from tulha.plans.base import calendar, order_values, stock_view
from tulha.sources.star import Star


def vw_estoque_atual(star: Star) -> DataFrame:
    """Stock position of every active product."""
    return stock_view(star)


def vw_vendas_consolidadas(star: Star) -> DataFrame:
    """Sales orders that were not cancelled, with customer, value and calendar."""
    customers = star.table("dim_clientes", "cod_cliente", "razao_social", "segmento", "estado")
    return (
        order_values(star, ["data_pedido", "cod_cliente"], ["CANCELADO"])
        .join(customers, "cod_cliente")
        .join(
            calendar(star, "mes", "trimestre", "ano"), F.col("data_pedido") == F.col("data"), "left"
        )
        .select(
            "num_pedido", "data_pedido", "status", "cod_cliente",
            F.col("razao_social").alias("cliente"), "segmento", "estado", "qtd_itens",
            dbl("valor_bruto").alias("valor_bruto"),
            dbl("desconto_percentual").alias("desconto_percentual"),
            dbl("valor").alias("valor_liquido"),
            "mes", "trimestre", "ano",
        )
    )


def purchase_totals(star: Star) -> DataFrame:
    lines = star.table("fct_itens_pedido_compra", "num_oc", "seq_item", "valor_total_item")
    return lines.groupBy("num_oc").agg(
        F.count("seq_item").alias("qtd_itens"),
        F.sum("valor_total_item").cast("decimal(24,2)").alias("valor"),
    )


def vw_compras_consolidadas(star: Star) -> DataFrame:
    """Purchase orders that were not cancelled, with supplier, value and calendar."""
    headers = star.table("fct_pedidos_compra", "num_oc", "data_oc", "status", "cod_fornecedor")
    suppliers = star.table("dim_fornecedores", "cod_fornecedor", "razao_social", "categoria")
    return (
        headers.filter(F.col("status") != "CANCELADO")
        .join(purchase_totals(star), "num_oc")
        .join(suppliers, "cod_fornecedor")
        .join(calendar(star, "mes", "trimestre", "ano"), F.col("data_oc") == F.col("data"), "left")
        .select(
            "num_oc", "data_oc", "status", "cod_fornecedor",
            F.col("razao_social").alias("fornecedor"),
            F.col("categoria").alias("categoria_fornecedor"),
            "qtd_itens", dbl("valor").alias("valor_total_oc"), "mes", "trimestre", "ano",
        )
    )
