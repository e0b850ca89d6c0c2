"""Practice queries over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tulha.functions.columns import dbl, half_up, money, percent, ratio
from tulha.plans.base import NOT_SOLD, order_values, stock
from tulha.sources.star import Star


def x_produtos_categoria(star: Star) -> DataFrame:
    products = star.table("dim_produtos", "categoria")
    counted = products.groupBy("categoria").agg(F.count(F.lit(1)).alias("total"))
    return counted.orderBy(F.desc("total"), "categoria")


def x_top5_clientes_pedidos(star: Star) -> DataFrame:
    orders = star.table("fct_pedidos_venda", "cod_cliente")
    counted = orders.groupBy("cod_cliente").agg(F.count(F.lit(1)).alias("pedidos"))
    return counted.orderBy(F.desc("pedidos"), "cod_cliente").limit(5)


def x_receita_mes(star: Star) -> DataFrame:
    return (
        order_values(star, ["data_pedido"], NOT_SOLD, how="left")
        .groupBy(F.date_format("data_pedido", "yyyy-MM").alias("mes"))
        .agg(money(F.sum("valor")).alias("receita"))
        .orderBy("mes")
    )


def quantity_sold(star: Star) -> DataFrame:
    lines = star.table("fct_itens_pedido_venda", "cod_produto", "quantidade")
    return lines.groupBy("cod_produto").agg(F.sum("quantidade").alias("qtd"))


def x_mais_vendidos_abaixo_minimo(star: Star) -> DataFrame:
    """The five products sold most among those below their minimum."""
    low = stock(star).filter(F.col("saldo") < F.col("estoque_minimo"))
    return (
        quantity_sold(star)
        .join(low, "cod_produto")
        .orderBy(F.desc("qtd"), "cod_produto")
        .limit(5)
        .select(
            "cod_produto", "descricao", dbl("qtd").alias("total_vendido"),
            dbl("saldo").alias("saldo_atual"), "estoque_minimo",
        )
    )


def x_hist_desconto(star: Star, bins: int = 10) -> DataFrame:
    """Orders per equal-width discount bin, discounts above zero, empty bins absent."""
    given = star.table("fct_pedidos_venda", "desconto_percentual").filter("desconto_percentual > 0")
    low = dbl(given.agg(F.min("desconto_percentual")).scalar())
    high = dbl(given.agg(F.max("desconto_percentual")).scalar())
    place = F.floor((dbl("desconto_percentual") - F.col("low")) / F.col("width")).cast("int") + 1
    binned = (
        given.withColumns({"low": low, "width": (high - low) / bins})
        .groupBy(F.least(F.lit(bins), place).alias("faixa"), "low", "width")
        .agg(F.count(F.lit(1)).alias("qtd"))
    )
    return binned.select(
        "faixa",
        half_up(F.col("low") + (F.col("faixa") - 1) * F.col("width"), 4).alias("de"),
        half_up(F.col("low") + F.col("faixa") * F.col("width"), 4).alias("ate"),
        "qtd",
    ).orderBy("faixa")


def x_receita_por_item_genero(star: Star) -> DataFrame:
    """Per category: units sold, revenue and the product with the largest revenue."""
    lines = star.table("fct_itens_pedido_venda", "cod_produto", "quantidade", "valor_total_item")
    per_product = lines.groupBy("cod_produto").agg(
        F.sum("quantidade").alias("qtd"), F.sum("valor_total_item").alias("receita")
    )
    # Largest revenue first, then the smallest code.
    best = F.min(F.struct((-F.col("receita")).alias("order"), "cod_produto"))
    return (
        per_product.join(star.table("dim_produtos", "cod_produto", "categoria"), "cod_produto")
        .groupBy(F.col("categoria").alias("genero"))
        .agg(
            dbl(F.sum("qtd")).alias("unidades"),
            money(F.sum("receita")).alias("receita"),
            best["cod_produto"].alias("melhor_item"),
            money(F.max("receita")).alias("receita_melhor_item"),
        )
        .orderBy(F.desc("receita"), "genero")
    )


def x_valor_total_estoque(star: Star) -> DataFrame:
    return stock(star).agg(
        money(F.sum("valor")).alias("valor_total"), F.count(F.lit(1)).alias("total_produtos")
    )


def x_margem_topn(star: Star, n: int = 5) -> DataFrame:
    """Products with the widest catalog margin."""
    gain = F.col("preco_venda") - F.col("custo_unitario")
    return (
        star.table("dim_produtos", "cod_produto", "descricao", "custo_unitario", "preco_venda")
        .select(
            "cod_produto", "descricao", dbl(gain).alias("margem_bruta"),
            percent(gain, "preco_venda", 1).alias("margem_pct"),
        )
        .orderBy(F.desc("margem_pct"), F.desc("margem_bruta"), "cod_produto")
        .limit(n)
    )


def x_segmento_credito(star: Star, segmento: str) -> DataFrame:
    """Customers of one segment: how many and their mean credit limit."""
    customers = star.table("dim_clientes", "segmento", "limite_credito")
    return (
        customers.filter(F.col("segmento") == segmento.upper())
        .groupBy("segmento")
        .agg(
            F.count(F.lit(1)).alias("clientes"),
            half_up(ratio(F.sum("limite_credito"), F.count("limite_credito")), 2)
            .alias("media_credito"),
        )
    )
