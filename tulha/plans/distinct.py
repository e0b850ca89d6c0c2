"""Distinct customers of months, quarters, years and sliding years, from stored bitmaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tulha.plans.loading import union_all
from tulha.plans.shared import shared_path
from tulha.sinks.bitmaps import MonthlyBitmaps
from tulha.sources.fixture import FixtureStar
from tulha.sources.star import Star

SLIDING = 12


def buyers(star: Star) -> DataFrame:
    """(mes, cod_cliente, num_pedido) of orders that were not cancelled."""
    orders = star.table("fct_pedidos_venda", "num_pedido", "data_pedido", "cod_cliente", "status")
    kept = orders.filter(F.col("status") != "CANCELADO")
    return kept.select(F.date_format("data_pedido", "yyyyMM").alias("mes"), "cod_cliente", "num_pedido")


def calendar_windows(months: DataFrame) -> DataFrame:
    """(nivel, periodo, mes) the months of each month, quarter, year and sliding year.

    A sliding year ends in a month up to the last one that has keys.
    """
    day, year = F.to_date("mes", "yyyyMM"), F.substring("mes", 1, 4)
    last = months.agg(F.max("mes")).scalar()
    fixed = [
        months.select(F.lit(level).alias("nivel"), name.alias("periodo"), "mes")
        for level, name in (
            ("mes", F.col("mes")),
            ("trimestre", F.concat(year, F.lit("T"), F.quarter(day).cast("string"))),
            ("ano", year),
        )
    ]
    ends = months.select("mes", F.explode(F.sequence(F.lit(0), F.lit(SLIDING - 1))).alias("k"))
    end = F.date_format(F.add_months(day, F.col("k")), "yyyyMM")
    sliding = ends.select(F.lit("ultimos_12_meses").alias("nivel"), end.alias("periodo"), "mes")
    return union_all([*fixed, sliding.filter(F.col("periodo") <= last)])


def _stored(spark: SparkSession, sf_dir: str) -> MonthlyBitmaps:
    """Bitmaps after a first load of part of the orders, then of all orders of the odd months
    (stored twice, as after a retry) and of the even ones."""
    star = FixtureStar(spark, sf_dir)
    kind = dict(star.table("fct_pedidos_venda", "cod_cliente").dtypes)["cod_cliente"]

    def build(root: str) -> None:
        kept, rows = MonthlyBitmaps(spark, root, "cod_cliente", kind), buyers(star)
        odd = F.substring("mes", 6, 1).cast("int") % 2 == 1
        early = F.pmod(F.xxhash64("num_pedido"), F.lit(10)) <= 5
        for batch in (early, odd, odd, ~odd):
            kept.keep(rows.filter(batch))

    return MonthlyBitmaps(spark, shared_path(spark, "bitmaps", sf_dir, build), "cod_cliente", kind)


def clientes_unicos_periodos(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _stored(spark, sf_dir)
    return kept.count(calendar_windows(kept.months()), "clientes_unicos")
