"""Calendar dimension over a date range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CALENDAR_COLUMNS = [
    "data_key", "data", "ano", "semestre", "trimestre", "mes", "nome_mes", "semana_ano", "dia",
    "dia_semana", "nome_dia", "is_fim_semana",
]


def calendar_parts(day: Column) -> dict[str, Column]:
    """Calendar attributes of a date, Monday = 1, ISO weeks."""
    weekday = F.weekday(day) + 1
    return {
        "data_key": F.date_format(day, "yyyyMMdd").cast("int"),
        "ano": F.year(day),
        "semestre": F.ceil(F.month(day) / 6).cast("int"),
        "trimestre": F.quarter(day),
        "mes": F.month(day),
        "nome_mes": F.date_format(day, "MMMM"),
        "semana_ano": F.weekofyear(day),
        "dia": F.dayofmonth(day),
        "dia_semana": weekday,
        "nome_dia": F.date_format(day, "EEEE"),
        "is_fim_semana": (weekday >= 6).cast("int"),
    }


def build_calendar(
    spark: SparkSession, start: str = "2024-01-01", end: str = "2025-12-31"
) -> DataFrame:
    """One row per day of the range, both ends included."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("data")
    )
    return days.withColumns(calendar_parts(F.col("data"))).select(*CALENDAR_COLUMNS)
