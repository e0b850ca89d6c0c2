"""The star schema the reports read, from any place that can deliver its tables."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class Star(Protocol):
    """Delivers star tables; callers name the columns they need."""

    spark: SparkSession

    def table(self, name: str, *columns: str) -> DataFrame: ...

    def lines_of(self, orders: DataFrame, *columns: str) -> DataFrame:
        """Sales lines of the orders in ``orders`` (one row per num_pedido)."""
        ...


class FrameStar:
    """Star over given DataFrames (loaded warehouse tables, catalog tables, tests)."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame]):
        self.spark = spark
        self._frames = frames

    def table(self, name: str, *columns: str) -> DataFrame:
        frame = self._frames[name]
        return frame.select(*columns) if columns else frame

    def lines_of(self, orders: DataFrame, *columns: str) -> DataFrame:
        lines = self.table("fct_itens_pedido_venda", *columns)
        return lines.join(orders.select("num_pedido"), "num_pedido", "left_semi")


def catalog_star(spark: SparkSession, names: list[str], schema: str | None = None) -> FrameStar:
    """Star over tables registered in the session catalog."""
    prefix = f"{schema}." if schema else ""
    return FrameStar(spark, {n: spark.table(f"{prefix}{n}") for n in names})


def register_views(star: Star, names: list[str]) -> None:
    """Expose star tables to SQL text."""
    for name in names:
        star.table(name).createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, **parameters: object) -> DataFrame:
    """A query by text, with bound named parameters."""
    return spark.sql(text, args=parameters or None)
