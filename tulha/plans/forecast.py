"""Demand forecast and replenishment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from tulha.functions.columns import dbl, half_even, half_up, ratio
from tulha.plans.api import code_is, in_range
from tulha.plans.base import sold_lines, stock
from tulha.sources.star import Star

RECENT_MONTHS = 3


def monthly_demand(star: Star, since: str | None = None) -> DataFrame:
    """Quantity sold per product and month, months without sales absent."""
    sold = sold_lines(star, ["data_pedido"], ["quantidade"])
    if since is not None:
        sold = sold.filter(F.col("data_pedido") >= F.lit(dt.date.fromisoformat(since)))
    return sold.groupBy("cod_produto", F.trunc("data_pedido", "month").alias("mes")).agg(
        F.sum("quantidade").cast("decimal(24,2)").alias("qtd")
    )


def demand_trend(monthly: DataFrame) -> DataFrame:
    """Per product: months, straight-line fit over their index, recent mean, last month.

    A product has one row per calendar month, so its window is bounded. The fit
    uses exact sums; the quotients are the only floating-point steps.
    """
    per_product = Window.partitionBy("cod_produto")
    indexed = monthly.withColumns(
        {
            "x": F.row_number().over(per_product.orderBy("mes")) - 1,
            "n": F.count(F.lit(1)).over(per_product),
        }
    )
    recent = F.col("x") >= F.col("n") - RECENT_MONTHS
    sums = indexed.groupBy("cod_produto").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("x").alias("sx"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"),
        F.sum("qtd").cast("decimal(26,2)").alias("sy"),
        F.sum(F.col("x") * F.col("qtd")).cast("decimal(26,2)").alias("sxy"),
        F.sum(F.when(recent, F.col("qtd"))).alias("recente"),
        F.count_if(recent).alias("meses_recentes"),
        F.max("mes").alias("ultimo_mes"),
        F.sort_array(
            F.collect_list(
                F.struct(F.date_format("mes", "yyyy-MM").alias("periodo"), dbl("qtd").alias("quantidade"))
            )
        ).alias("historico"),
    )
    n = F.col("n").cast("decimal(10,0)")
    sx, sy = F.col("sx").cast("decimal(10,0)"), F.col("sy")
    slope = ratio(
        n * F.col("sxy") - sx * sy, F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    )
    slope = F.when(F.col("n") < 2, 0.0).otherwise(slope)
    start = F.when(F.col("n") < 2, dbl("sy")).otherwise(
        half_even((dbl("sy") - F.col("slope") * F.col("sx")) / F.col("n"), 2)
    )
    return sums.withColumn("slope", slope).select(
        "cod_produto", "n", "ultimo_mes", "historico",
        start.alias("a"),
        half_even("slope", 2).alias("b"),
        ratio("recente", "meses_recentes").alias("base"),
    )


def previsao_demanda(
    star: Star, meses_futuros: int = 3, cod_produto: object = None, historico: bool = False
) -> DataFrame:
    """Forecast per product and future month: recent mean plus accumulated trend."""
    in_range("meses_futuros", meses_futuros, 1, 12)
    monthly = monthly_demand(star)
    if cod_produto is not None:
        monthly = monthly.filter(code_is(monthly, "cod_produto", cod_produto))
    products = star.table("dim_produtos", "cod_produto", "descricao")
    steps = F.explode(F.sequence(F.lit(1), F.lit(meses_futuros)))
    expected = F.rint(F.col("base") + F.col("b") * (F.col("n") + F.col("i") - 1))
    future = (
        demand_trend(monthly)
        .join(products, "cod_produto")
        .withColumn("i", steps)
        .withColumn("prevista", F.greatest(F.lit(0.0), expected))
    )
    return future.select(
        "cod_produto", "descricao", "a", "b", half_even("base", 1).alias("media_movel_3m"),
        F.date_format(F.add_months("ultimo_mes", F.col("i")), "yyyy-MM").alias("periodo"),
        F.col("prevista").cast("long").alias("quantidade_prevista"),
        F.greatest(F.lit(0.0), F.rint(F.col("prevista") * 0.8)).cast("long")
        .alias("intervalo_inferior"),
        F.rint(F.col("prevista") * 1.2).cast("long").alias("intervalo_superior"),
        *(["historico"] if historico else []),
    ).orderBy("cod_produto", "periodo")


def months_before(day: str, months: int) -> str:
    """The same day some months earlier; a day the month lacks rolls into the next."""
    date = dt.date.fromisoformat(day)
    index = date.year * 12 + date.month - 1 - months
    first = dt.date(index // 12, index % 12 + 1, 1)
    return (first + dt.timedelta(days=date.day - 1)).isoformat()


def replenishment(star: Star, as_of: str, meses_cobertura: int) -> DataFrame:
    in_range("meses_cobertura", meses_cobertura, 1, 6)
    demand = (
        monthly_demand(star, since=months_before(as_of, 3))
        .groupBy("cod_produto")
        .agg(ratio(F.sum("qtd"), F.count("qtd")).alias("demanda"))
    )
    wanted = F.greatest(F.lit(0.0), F.col("demanda") * meses_cobertura - dbl("saldo"))
    return (
        stock(star)
        .filter(F.col("status_estoque").isin("CRITICO", "ALERTA"))
        .join(demand.filter("demanda > 0"), "cod_produto")
        .withColumn("falta", wanted)
        .withColumn(
            "custo_estimado",
            F.round((F.col("falta") * dbl("custo_unitario")).cast("decimal(38,8)"), 2),
        )
    )


def previsao_reposicao(star: Star, as_of: str, meses_cobertura: int = 2) -> DataFrame:
    """Suggested purchase per critical or alert product, from the last three months."""
    return (
        replenishment(star, as_of, meses_cobertura)
        .select(
            "cod_produto", "descricao", "categoria", dbl("saldo").alias("saldo_atual"),
            "estoque_minimo", "status_estoque", half_up("demanda", 1).alias("demanda_media_mensal"),
            half_up("falta", 0).alias("qtd_sugerida_compra"),
            dbl("custo_estimado").alias("custo_estimado"),
        )
        .orderBy("status_estoque", F.desc("qtd_sugerida_compra"), "cod_produto")
    )


def previsao_reposicao_total(star: Star, as_of: str, meses_cobertura: int = 2) -> DataFrame:
    """One row: products to buy and their cost."""
    return replenishment(star, as_of, meses_cobertura).agg(
        F.lit(meses_cobertura).alias("meses_cobertura"),
        F.count(F.lit(1)).alias("total_itens"),
        F.coalesce(F.sum("custo_estimado"), F.lit(0)).cast("double").alias("custo_total_estimado"),
    )
