"""Keep-first and keep-last per key, safe when one key holds much of the table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key.

    The filter on rank 1 lets Spark drop all but one row per key and map task
    before the shuffle (WindowGroupLimit), so a hot key does not grow one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def mark_duplicates(
    df: DataFrame, keys: list[str], order: list[str], row_id: str, mark: str = "_duplicate"
) -> DataFrame:
    """All rows, flagged true when an earlier row has the same key (nulls compare equal).

    Ranking every row of a key would put a hot key into one task. Instead keys are
    counted on the map side, only rows of repeated keys compete for the smallest
    (order, row id), and the losers are joined back on the row id, which is unique and
    so spreads evenly.
    """
    names = {k: f"_same_{k}" for k in keys}
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    repeated = counted.select(*[F.col(k).alias(n) for k, n in names.items()])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    needed = list(dict.fromkeys([*keys, *order, row_id]))
    members = df.select(*needed).join(repeated, same, "left_semi")
    first = members.groupBy(*keys).agg(
        F.min(F.struct(*order, F.col(row_id).alias("_winner"))).alias("_m")
    )
    winners = first.select(F.col("_m._winner").alias(row_id))
    losers = members.select(row_id).join(winners, row_id, "left_anti")
    flagged = df.join(losers.withColumn(mark, F.lit(True)), row_id, "left")
    return flagged.withColumn(mark, F.col(mark).isNotNull())
