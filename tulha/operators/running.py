"""Running total over the whole table without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tulha.session import cut_lineage


def running_total(
    df: DataFrame,
    value: str,
    order: list[Column],
    position: str = "_position",
    running: str = "_running",
    total: str = "_total",
) -> DataFrame:
    """Add the rank, the running sum and the grand total of ``value`` in ``order``.

    ``order`` must be total (end with a unique column). Rows are split into
    ordered ranges; each range needs only the count and sum of the ranges before
    it. The ranges are checkpointed first: both passes must see the same split
    even when a lost executor makes Spark run a stage again.
    """
    ranges = cut_lineage(df.repartitionByRange(*order)).withColumn("_range", F.spark_partition_id())

    # One row per range, so at most as many rows as shuffle partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = (
        ranges.groupBy("_range")
        .agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_count"))
        .select(
            "_range",
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
            F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_count_before"),
            F.sum("_sum").over(everything).alias(total),
        )
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    cumulative = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranges.join(F.broadcast(offsets), "_range")
        .withColumn(position, F.col("_count_before") + F.row_number().over(inside))
        .withColumn(running, F.col("_sum_before") + F.sum(value).over(cumulative))
        .drop("_range", "_sum_before", "_count_before")
    )
