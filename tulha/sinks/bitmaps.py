"""Exact counts of distinct keys over any set of months, from one bitmap per month.

Each key has a number for good, given when it is first seen; a month is a set of numbers,
stored as bitmaps of 32,768 places. A quarter, a year or a sliding window is the union of its
months' bitmaps, so it is counted without reading a fact row again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tulha.operators.running import running_total
from tulha.session import cut_lineage

BITS = "parte bigint, bits binary, mes string"


class MonthlyBitmaps:
    """The keys of each month below a folder; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str, key: str, key_type: str):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self._numbers = f"`{key}` {key_type}, numero bigint"

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def numbers(self) -> DataFrame:
        """(key, numero), one row per key ever seen, numbered from 1 without gaps."""
        return self._read("numeros", self._numbers)

    def bits(self) -> DataFrame:
        return self._read("bitmaps", BITS)

    def keep(self, rows: DataFrame) -> None:
        """Store the months (``mes``, yyyyMM) of ``rows``, which are all rows of these months.

        A month that is given again is replaced, so keys that left it no longer count; a run
        after one that died gives the same table. Null months and keys take no part. Pairs
        are made distinct on the map side, so a hot key travels once a task and month, and
        are dealt by month and part before the bitmaps are built: a bitmap is written whole
        by one task from at most 32,768 rows.
        """
        pairs = cut_lineage(rows.select("mes", self.key).dropna().distinct())
        known = self.numbers()
        fresh = pairs.select(self.key).distinct().join(known, self.key, "left_anti")
        last = known.agg(F.coalesce(F.max("numero"), F.lit(0).cast("bigint"))).first()[0]
        placed = running_total(fresh.withColumn("_one", F.lit(1)), "_one", [F.col(self.key)])
        numbered = placed.select(self.key, (F.col("_position") + F.lit(last)).cast("bigint").alias("numero"))
        cut_lineage(numbered).write.mode("append").parquet(f"{self.root}/numeros")
        number = F.col("numero")
        built = (
            pairs.join(self.numbers(), self.key)
            .select("mes", F.bitmap_bucket_number(number).alias("parte"), F.bitmap_bit_position(number).alias("bit"))
            .repartition("mes", "parte")
            .groupBy("mes", "parte")
            .agg(F.bitmap_construct_agg("bit").alias("bits"))
        )
        writer = built.select("parte", "bits", "mes").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("mes").parquet(f"{self.root}/bitmaps")

    def months(self) -> DataFrame:
        """(mes) the months that have keys."""
        return self.bits().select("mes").distinct()

    def count(self, windows: DataFrame, name: str) -> DataFrame:
        """Distinct keys of each window; ``windows`` has ``mes`` and the columns that name one.

        Months of a window that hold no key add nothing; a window without any has no row.
        """
        label = [c for c in windows.columns if c != "mes"]
        joined = self.bits().join(windows.distinct(), "mes")
        united = joined.groupBy(*label, "parte").agg(F.bitmap_or_agg("bits").alias("bits"))
        return united.groupBy(*label).agg(F.sum(F.bitmap_count("bits")).alias(name))
