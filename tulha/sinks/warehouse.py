"""Warehouse tables as Parquet folders, written by Spark's own partition overwrite.

A table is split into parts (months or hash numbers; others have one part). A load writes
the parts it touches with dynamic partition overwrite: Spark writes them aside and swaps
them in when the job commits, so a load that dies before leaves the old rows readable.
Rows that stay in the parts to be replaced are read in the same job. Where the catalog
has a table format with MERGE INTO, use that instead. One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tulha.model import ENTITIES, REJECT_LOG, RUN_LOG, Entity
from tulha.operators.calendar import build_calendar
from tulha.operators.merge import incoming, untouched
from tulha.session import COMPRESSION, remove_folder, stored_rows
from tulha.sources.star import FrameStar

HASH_PARTS = 64
ONE_PART = "all"
PART = "_part"

def by_month(column: str) -> Callable[[], Column]:
    return lambda: F.coalesce(F.date_format(column, "yyyyMM"), F.lit("sem_data"))


def by_hash(column: str, parts: int = HASH_PARTS) -> Callable[[], Column]:
    return lambda: F.pmod(F.xxhash64(column), F.lit(parts)).cast("string")


# Facts are split so that an upsert rewrites only the parts its keys live in. A warehouse
# takes its own splits: more hash parts where a part would be too large to rewrite.
PARTS: dict[str, Callable[[], Column]] = {
    "fct_pedidos_venda": by_month("data_pedido"),
    "fct_itens_pedido_venda": by_hash("num_pedido"),
    "fct_pedidos_compra": by_month("data_oc"),
    "fct_itens_pedido_compra": by_hash("num_oc"),
    "fct_movimentacoes_estoque": by_month("data_mov"),
}


class Warehouse:
    def __init__(
        self, spark: SparkSession, root: str,
        parts: dict[str, Callable[[], Column]] | None = None, keeps_sums: bool = False,
    ):
        """``keeps_sums``: loads also keep the sums of ``sinks.kept``, from the first load on."""
        self.spark = spark
        self.keeps_sums = keeps_sums
        self.root = root.rstrip("/")
        self.parts = {**PARTS, **(parts or {})}

    # --- reading -------------------------------------------------------------
    def _folder(self, name: str, schema: T.StructType) -> DataFrame:
        """All rows below a folder; none when it is not there."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _with_part(self, table: str, schema: T.StructType) -> DataFrame:
        return self._folder(table, T.StructType([*schema, T.StructField(PART, T.StringType())]))

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        return self._with_part(table, schema).drop(PART)

    def table(self, name: str) -> DataFrame:
        """A loaded target table, by name."""
        return self.read(name, table_schema(name))

    def star(self) -> FrameStar:
        frames = {e.table: self.table(e.table) for e in ENTITIES.values()}
        calendar = build_calendar(self.spark, "2024-01-01", "2024-01-01").schema
        frames["dim_tempo"] = self.read("dim_tempo", calendar)
        return FrameStar(self.spark, frames)

    def _has_parts(self, table: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        store = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in store.listStatus(path)] if store.exists(path) else []
        return any(n.startswith(PART) for n in names)

    # --- writing -------------------------------------------------------------
    def _part(self, table: str) -> Column:
        return self.parts[table]() if table in self.parts else F.lit(ONE_PART)

    def _write(self, df: DataFrame, table: str, mode: str = "dynamic") -> None:
        rows = df.withColumn(PART, self._part(table))
        if table in self.parts:
            # Rebalance: few files for a small part, several for a large one.
            rows = rows.hint("rebalance", F.col(PART))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.option("compression", COMPRESSION).partitionBy(PART).parquet(f"{self.root}/{table}")

    def replace(self, df: DataFrame, table: str, keep_when_empty: bool = True) -> None:
        """Full refresh. An empty input leaves the old rows unless told otherwise.

        A table of one part swaps it; where parts or rows may have to go altogether,
        Spark removes the old files before it writes.
        """
        if keep_when_empty and not self._has_parts(table):
            self._write(df, table)  # nothing to lose, so the rows need not be looked for first
            return
        empty = df.isEmpty()
        if empty and keep_when_empty:
            return
        self._write(df, table, "static" if empty or table in self.parts else "dynamic")

    def append(self, df: DataFrame, table: str, batch: str) -> None:
        """Add the rows of one batch to an append-only table.

        Each batch has its own folder: writing it again after a retry replaces
        it, so no row is there twice.
        """
        writer = df.write.mode("overwrite").option("compression", COMPRESSION)
        writer.parquet(f"{self.root}/{table}/batch={batch}")

    def appended(self, table: str, schema: T.StructType) -> DataFrame:
        return self._folder(table, T.StructType([*schema, T.StructField("batch", T.StringType())])).drop("batch")

    def upsert(
        self,
        df: DataFrame,
        table: str,
        keys: list[str],
        schema: T.StructType,
        latest: list[Column],
        defaults: dict[str, object] | None = None,
        one_per_key: bool = False,
    ) -> None:
        """Insert or replace whole rows by key; the first row in ``latest`` order wins.

        ``one_per_key`` says that no key repeats in ``df``, which is then read several times.

        Only the parts that hold a key of the batch, now or after it, are rewritten.
        Their names (months or hash numbers) are all the driver sees. A part whose last
        row moves to another one is removed; a run that dies before that is mended by
        running it again, since every copy of a key is replaced.
        """
        if df.isEmpty():
            return
        current = self._with_part(table, schema)
        last = incoming(df, schema, keys, latest, defaults, one_per_key)
        if current.isEmpty():
            # Nothing is replaced: no part is read, and none can lose its last row.
            self._write(last, table)
            return
        with nullcontext(last) if one_per_key else stored_rows(last) as last:
            if table in self.parts:
                old = current.join(last.select(*keys), keys, "left_semi").select(PART)
                new = last.select(self._part(table).alias(PART))
                touched = [r[PART] for r in new.union(old).distinct().collect()]
                current = current.filter(F.col(PART).isin(touched))
            else:
                touched = [ONE_PART]
            # Dynamic overwrite swaps the parts when the job commits, after all rows were read.
            written = Observation()
            merged = untouched(current.drop(PART), last, keys).unionByName(last)
            parts = F.collect_set(self._part(table)).alias("parts")
            self._write(merged.observe(written, parts), table)
        for part in set(touched) - set(written.get["parts"]):
            self._remove_part(table, part)

    def _remove_part(self, table: str, part: str) -> None:
        remove_folder(self.spark, f"{self.root}/{table}/{PART}={part}")

    def upsert_entity(
        self, df: DataFrame, entity: Entity, latest: list[Column], one_per_key: bool = False
    ) -> None:
        self.upsert(
            df, entity.table, list(entity.key), entity.schema, latest, entity.defaults, one_per_key
        )

    # --- control tables ------------------------------------------------------
    def log_run(
        self, run_id: str, entity: str, status: str, counts: tuple[int, int, int],
        elapsed: float, error: str, at: Column,
    ) -> None:
        row = [(run_id, entity, status, *counts, round(elapsed, 3), error)]
        fields = T.StructType(RUN_LOG.fields[:-1])  # all but executed_at
        log = self.spark.createDataFrame(row, fields).withColumn("executed_at", at)
        self.append(log.coalesce(1), "log_etl_execucoes", f"{run_id}-{entity}")

    def run_log(self) -> DataFrame:
        return self.appended("log_etl_execucoes", RUN_LOG)

    def reject_log(self) -> DataFrame:
        return self.appended("log_registros_rejeitados", REJECT_LOG)

    def write_reject_csv(self, rejected: DataFrame, entity: str, run_id: str) -> str:
        """Rejected rows of one run as gzipped CSV files with a header."""
        folder = f"{self.root}/rejected/{entity}_rejected_{run_id}"
        flat = rejected.drop("_ord", "_row_id")
        flat.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(folder)
        return folder

    def empty_tables(self, names: list[str]) -> list[str]:
        """Target tables without rows, for the check after a load."""
        return [n for n in names if self.table(n).isEmpty()]


def table_schema(name: str) -> T.StructType:
    return next(e.schema for e in ENTITIES.values() if e.table == name)


def ensure_tables(spark: SparkSession, database: str) -> None:
    """Create catalog tables for every staging, target and control table that is not there."""
    schemas = {e.staging: e.raw_schema for e in ENTITIES.values()}
    schemas |= {e.table: e.schema for e in ENTITIES.values()}
    schemas |= {"log_etl_execucoes": RUN_LOG, "log_registros_rejeitados": REJECT_LOG}
    schemas["dim_tempo"] = build_calendar(spark, "2024-01-01", "2024-01-01").schema
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in schemas.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
