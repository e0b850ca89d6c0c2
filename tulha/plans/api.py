"""Parametrised queries: stock, sales, margins and value anomalies.

An unknown product or an empty selection gives an empty result, not an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tulha.functions.columns import dbl, discounted, half_up, money, percent, ratio
from tulha.model import ANOMALY_Z
from tulha.plans.base import NOT_SOLD, order_values, product_margin, stock, stock_view
from tulha.sources.star import Star


def in_range(name: str, value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {value}")
    return value


def code_is(df: DataFrame, column: str, code: object) -> Column:
    """Equality with a business code, upper-cased when codes are text."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column) == str(code).upper()
    return F.col(column) == int(code)


# --- stock -------------------------------------------------------------------
def api_estoque(
    star: Star, status: str | None = None, categoria: str | None = None
) -> DataFrame:
    position = stock_view(star)
    if status:
        position = position.filter(F.col("status_estoque") == status.upper())
    if categoria:
        position = position.filter(F.col("categoria") == categoria)
    return position.orderBy("status_estoque", "saldo_atual", "cod_produto")


def api_estoque_criticos(star: Star) -> DataFrame:
    critical = stock_view(star).filter(F.col("status_estoque") == "CRITICO")
    return critical.orderBy("saldo_atual", "cod_produto")


def api_estoque_resumo(star: Star) -> DataFrame:
    """Stock per category."""
    return (
        stock(star)
        .groupBy("categoria")
        .agg(
            F.count(F.lit(1)).alias("total_skus"),
            dbl(F.sum("saldo")).alias("saldo_total"),
            money(F.sum("valor")).alias("valor_total"),
            F.count_if(F.col("status_estoque") == "CRITICO").alias("criticos"),
            F.count_if(F.col("status_estoque") == "ALERTA").alias("alertas"),
        )
        .orderBy(F.desc("valor_total"), "categoria")
    )


def api_estoque_produto(star: Star, cod_produto: object, movimentos: int = 30) -> DataFrame:
    """Stock of one product next to its latest movements."""
    position = stock_view(star)
    position = position.filter(code_is(position, "cod_produto", cod_produto))
    moves = star.table(
        "fct_movimentacoes_estoque", "num_mov", "cod_produto", "num_documento", "tipo_mov",
        "quantidade", "data_mov", "observacao",
    )
    latest = (
        moves.filter(code_is(moves, "cod_produto", cod_produto))
        .orderBy(F.desc("data_mov"), "num_mov")
        .limit(movimentos)
    )
    return (
        position.join(latest, "cod_produto", "left")
        .select(
            "cod_produto", "descricao", "saldo_atual", "status_estoque", "num_documento",
            "tipo_mov", dbl("quantidade").alias("quantidade"), "data_mov", "observacao", "num_mov",
        )
        .orderBy(F.desc("data_mov"), "num_mov")
    )


# --- sales -------------------------------------------------------------------
def api_vendas_lista(
    star: Star, status: str | None = None, cod_cliente: object = None, limit: int = 50
) -> DataFrame:
    """Newest orders. The page is cut first; values are computed for its rows only."""
    in_range("limit", limit, 1, 500)
    orders = star.table(
        "fct_pedidos_venda", "num_pedido", "cod_cliente", "data_pedido", "data_entrega_prevista",
        "data_entrega_real", "status", "desconto_percentual",
    )
    if status:
        orders = orders.filter(F.col("status") == status.upper())
    if cod_cliente is not None:
        orders = orders.filter(code_is(orders, "cod_cliente", cod_cliente))
    newest = [F.desc("data_pedido"), F.asc("num_pedido")]
    # At most 500 rows by the check above.
    page = F.broadcast(orders.orderBy(*newest).limit(limit))
    lines = (
        star.lines_of(page, "num_pedido", "valor_total_item")
        .groupBy("num_pedido")
        .agg(F.sum("valor_total_item").cast("decimal(24,2)").alias("bruto"))
    )
    customers = star.table("dim_clientes", "cod_cliente", "razao_social", "segmento").join(
        page.select("cod_cliente"), "cod_cliente", "left_semi"
    )
    return (
        page.join(lines, "num_pedido", "left")
        .join(customers, "cod_cliente", "left")
        .select(
            "num_pedido", "cod_cliente", F.col("razao_social").alias("nome_cliente"), "segmento",
            "data_pedido", "data_entrega_prevista", "data_entrega_real",
            F.col("status").alias("status_pedido"),
            dbl(discounted("bruto", "desconto_percentual")).alias("valor_total"),
            dbl("desconto_percentual").alias("desconto_pct"),
        )
        .orderBy(*newest)
    )


def sold_by_customer(star: Star) -> DataFrame:
    """Orders, valued orders and value per customer, cancelled and returned left out."""
    return (
        order_values(star, ["cod_cliente"], NOT_SOLD, how="left")
        .groupBy("cod_cliente")
        .agg(
            F.count(F.lit(1)).alias("pedidos"),
            F.count("valor").alias("com_valor"),
            F.sum("valor").cast("decimal(26,2)").alias("valor"),
        )
    )


def api_kpis_resumo(star: Star) -> DataFrame:
    """One row: orders, revenue, mean ticket, customers."""
    return (
        sold_by_customer(star)
        .agg(
            F.sum("pedidos").alias("total_pedidos"),
            F.sum("valor").alias("valor"),
            F.sum("com_valor").alias("com_valor"),
            F.count("cod_cliente").alias("clientes_ativos"),
        )
        .select(
            F.coalesce("total_pedidos", F.lit(0)).alias("total_pedidos"),
            money("valor").alias("receita_total"),
            half_up(ratio("valor", "com_valor"), 2).alias("ticket_medio"),
            "clientes_ativos",
        )
    )


def api_kpis_status(star: Star) -> DataFrame:
    return (
        order_values(star, [], [], how="left")
        .groupBy(F.col("status").alias("status_pedido"))
        .agg(F.count(F.lit(1)).alias("total"), money(F.sum("valor")).alias("valor"))
        .orderBy(F.desc("total"), "status_pedido")
    )


def api_kpis_top5(star: Star, n: int = 5) -> DataFrame:
    best = [F.desc("receita"), F.asc("cod_cliente")]
    top = (
        sold_by_customer(star)
        .withColumn("receita", money("valor"))
        .orderBy(*best)
        .limit(n)
        .select("cod_cliente", "pedidos", "receita")
    )
    names = star.table("dim_clientes", "cod_cliente", "razao_social")
    return (
        top.join(names, "cod_cliente", "left")
        .select("cod_cliente", F.col("razao_social").alias("nome_cliente"), "pedidos", "receita")
        .orderBy(*best)
    )


def api_vendas_periodo(star: Star) -> DataFrame:
    """Revenue and orders per month with the change against the previous month present."""
    monthly = (
        order_values(star, ["data_pedido"], NOT_SOLD, how="left")
        .groupBy(F.trunc("data_pedido", "month").alias("inicio"))
        .agg(
            F.sum("valor").cast("decimal(30,2)").alias("valor"),
            F.count(F.lit(1)).alias("pedidos"),
        )
    )
    # One row per calendar month: the unpartitioned window is bounded.
    previous = F.lag("valor").over(Window.orderBy("inicio"))
    return (
        monthly.withColumn("anterior", previous)
        .orderBy("inicio")
        .select(
            F.date_format("inicio", "yyyy").alias("ano"),
            F.date_format("inicio", "MM").alias("mes"),
            money("valor").alias("receita"),
            "pedidos",
            money("anterior").alias("receita_mes_anterior"),
            percent(F.col("valor") - F.col("anterior"), "anterior", 2).alias("variacao_pct"),
        )
    )


def api_margem(star: Star) -> DataFrame:
    return (
        product_margin(star)
        .select(
            "cod_produto", "descricao", "categoria", dbl("qtd").alias("unidades_vendidas"),
            money("receita").alias("receita_bruta"), money("custo").alias("cmv"),
            money("margem").alias("lucro_bruto"),
            percent("margem", "receita", 1).alias("margem_pct"),
        )
        .orderBy(F.desc("receita_bruta"), "cod_produto")
    )


# --- anomalies ---------------------------------------------------------------
def api_anomalias(
    star: Star, threshold: float = ANOMALY_Z, deviation_from: str = "filtered"
) -> DataFrame:
    """Orders whose value is more than ``threshold`` deviations from the mean.

    ``deviation_from="filtered"`` is the sample deviation of the orders compared;
    ``"all"`` measures it around the mean of all orders, cancelled ones included.
    Count, sum and sum of squares are exact, so the result does not depend on
    the order in which partitions are merged.
    """
    values = order_values(star, ["cod_cliente", "data_pedido"], [], how="left").withColumn(
        "valor", F.col("valor").cast("decimal(18,2)")
    )
    kept = ~F.col("status").isin(NOT_SOLD)
    of_kept = F.when(kept, F.col("valor"))
    squares = F.sum(of_kept * of_kept)
    stats = values.agg(
        F.count(of_kept).cast("double").alias("n"),
        F.sum(of_kept).cast("double").alias("s"),
        squares.cast("double").alias("q"),
        ratio(F.sum("valor"), F.count("valor")).alias("centre_all"),
    )
    mean = F.col("s") / F.col("n")
    if deviation_from == "all":
        centre = F.col("centre_all")
        spread = F.col("q") - 2 * centre * F.col("s") + F.col("n") * centre * centre
    else:
        spread = F.col("q") - F.col("s") * F.col("s") / F.col("n")
    degrees = F.when(F.col("n") > 1, F.col("n") - 1)
    # One row, one subquery for both figures.
    measure = stats.select(
        F.struct(mean.alias("mean"), F.sqrt(spread / degrees).alias("sd"))
    ).scalar()
    score = half_up(ratio(F.abs(dbl("valor") - measure["mean"]), measure["sd"]), 2)
    names = star.table("dim_clientes", "cod_cliente", "razao_social")
    return (
        values.filter(kept)
        .withColumn("z_score", score)
        .filter(F.col("z_score") > threshold)
        .join(names, "cod_cliente", "left")
        .select(
            "num_pedido", "cod_cliente", F.col("razao_social").alias("nome_cliente"),
            dbl("valor").alias("valor_total"), "data_pedido",
            F.col("status").alias("status_pedido"), "z_score",
        )
        .orderBy(F.desc("z_score"), "num_pedido")
    )
