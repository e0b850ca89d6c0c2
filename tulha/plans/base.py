"""Shared building blocks: order values, stock balance, product sales.

Facts are summed to the grain of their own key before they meet a dimension.
The sums combine on the map side, so a hot order, product or customer never
lands in one task, and the joins that follow are one row to one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tulha.functions.columns import discounted, dbl, stock_status
from tulha.sources.star import Star

NOT_SOLD = ["CANCELADO", "DEVOLVIDO"]


def line_totals(star: Star) -> DataFrame:
    """Lines and gross value per sales order; a star that keeps them gives its own."""
    if hasattr(star, "line_totals"):
        return star.line_totals()
    lines = star.table("fct_itens_pedido_venda", "num_pedido", "seq_item", "valor_total_item")
    return lines.groupBy("num_pedido").agg(
        F.count("seq_item").alias("qtd_itens"),
        F.sum("valor_total_item").cast("decimal(24,2)").alias("valor_bruto"),
    )


def order_values(
    star: Star, columns: list[str], excluded: list[str], how: str = "inner"
) -> DataFrame:
    """Sales orders outside ``excluded`` with gross and net value.

    ``how="inner"`` keeps orders that have lines; ``"left"`` keeps all, with a
    null value for those without.
    """
    wanted = list(dict.fromkeys(["num_pedido", "status", "desconto_percentual", *columns]))
    orders = star.table("fct_pedidos_venda", *wanted)
    if excluded:
        orders = orders.filter(~F.col("status").isin(excluded))
    return orders.join(line_totals(star), "num_pedido", how).withColumn(
        "valor", discounted("valor_bruto", "desconto_percentual")
    )


def calendar(star: Star, *columns: str) -> DataFrame:
    """The calendar, broadcast: one row per day of a fixed range of years."""
    return F.broadcast(star.table("dim_tempo", "data", *columns))


def balances(star: Star) -> DataFrame:
    """Sum of signed quantities per product; a star that keeps it gives its own."""
    if hasattr(star, "balances"):
        return star.balances()
    moves = star.table("fct_movimentacoes_estoque", "cod_produto", "qty_sinal")
    return moves.groupBy("cod_produto").agg(F.sum("qty_sinal").alias("saldo"))


def stock(star: Star) -> DataFrame:
    """Active products with balance, value (exact) and status."""
    moves = balances(star)
    products = star.table(
        "dim_produtos", "cod_produto", "descricao", "categoria", "unidade", "custo_unitario",
        "preco_venda", "estoque_minimo", "estoque_maximo", "_is_active",
    ).filter("_is_active = 1")
    balance = F.coalesce("saldo", F.lit(0))
    return (
        products.join(moves, "cod_produto", "left")
        .withColumn("saldo", balance.cast("decimal(24,2)"))
        .withColumns(
            {
                "valor": F.coalesce(F.col("saldo") * F.col("custo_unitario"), F.lit(0)),
                "status_estoque": stock_status(F.col("saldo"), F.col("estoque_minimo")),
            }
        )
        .drop("_is_active")
    )


def stock_view(star: Star) -> DataFrame:
    """Stock in report form."""
    return stock(star).select(
        "cod_produto", "descricao", "categoria", "unidade",
        dbl("custo_unitario").alias("custo_unitario"),
        dbl("preco_venda").alias("preco_venda"),
        "estoque_minimo", "estoque_maximo",
        dbl("saldo").alias("saldo_atual"),
        dbl("valor").alias("valor_estoque"),
        "status_estoque",
    )


def sold_lines(star: Star, order_columns: list[str], line_columns: list[str]) -> DataFrame:
    """Lines of orders that were neither cancelled nor returned.

    Lines are summed per (order, product) before the join: what travels for a
    hot order is at most one row per product and map task.
    """
    lines = (
        star.table("fct_itens_pedido_venda", "num_pedido", "cod_produto", *line_columns)
        .groupBy("num_pedido", "cod_produto")
        .agg(*[F.sum(c).cast("decimal(24,2)").alias(c) for c in line_columns])
    )
    orders = star.table("fct_pedidos_venda", "num_pedido", "status", *order_columns).filter(
        ~F.col("status").isin(NOT_SOLD)
    )
    return lines.join(orders.drop("status"), "num_pedido")


def product_sales(star: Star) -> DataFrame:
    """Quantity and revenue per product, orders cancelled or returned left out."""
    return (
        sold_lines(star, [], ["quantidade", "valor_total_item"])
        .groupBy("cod_produto")
        .agg(
            F.sum("quantidade").cast("decimal(24,2)").alias("qtd"),
            F.sum("valor_total_item").cast("decimal(24,2)").alias("receita"),
        )
    )


def product_margin(star: Star) -> DataFrame:
    """Sales per product against the catalog cost, all values exact."""
    products = star.table(
        "dim_produtos", "cod_produto", "descricao", "categoria", "custo_unitario", "preco_venda"
    )
    return (
        product_sales(star)
        .join(products, "cod_produto")
        .withColumn("custo", (F.col("qtd") * F.col("custo_unitario")).cast("decimal(34,4)"))
        .withColumn("margem", F.col("receita") - F.col("custo"))
    )
