"""Sums per key of a fact table, kept by the changes of each batch instead of a full pass.

Before a batch goes into its table, the sums that it will change are stored: the values of
its rows are added, and those of the stored rows with the same keys, which it replaces, are
taken off. Only stored rows with a key of the batch are read, from the parts that can hold
them where the table is split by its key. The sum of all changes is the sum over the table.

A batch is recorded once, by name: a batch that is run again after a crash finds its changes
and only writes its table anew. The changes therefore come first and the table second; a
reader between the two sees the sums a batch ahead. ``compact`` adds all changes up into the
base of a new generation, which counts from the moment its files are complete.

Null values add nothing; ``<value>_n`` counts the others, so that a sum of nulls stays null.
A null key of the sums is a key like any other. One writer at a time, as for the tables.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tulha.model import ENTITIES, Entity
from tulha.operators.dedup import keep_first
from tulha.session import stored_rows
from tulha.sinks.warehouse import PART, Warehouse
from tulha.sources.star import FrameStar

SUM = T.DecimalType(34, 4)
GENERATION, BATCH, BASE, DONE = "geracao=", "lote=", "base", "feitos"


def _folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly below a folder that need not be there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    return [s.getPath().getName() for s in store.listStatus(path) if s.isDirectory()]


def _complete(spark: SparkSession, folder: str) -> bool:
    """Whether the job that wrote the folder was committed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


class KeptSums:
    def __init__(
        self, warehouse: Warehouse, name: str, entity: Entity, key: str, values: list[str],
        split_by_key: bool = False,
    ):
        """Sums of ``values`` per ``key`` of the entity's target table, and ``rows`` per key.

        ``split_by_key`` says that the part of a row follows from its entity's key alone,
        so that stored rows are looked for in the parts of the batch only.
        """
        self.warehouse, self.spark, self.entity = warehouse, warehouse.spark, entity
        self.root = f"{warehouse.root}/{name}"
        self.key, self.values, self.split_by_key = key, values, split_by_key
        sums = [f for v in values for f in (T.StructField(v, SUM), T.StructField(f"{v}_n", T.LongType()))]
        self.schema = T.StructType([entity.schema[key], T.StructField("rows", T.LongType()), *sums])

    # --- where things are ----------------------------------------------------
    def _generation(self) -> int:
        """The newest generation whose base is complete; 0 has no base."""
        numbers = [int(n.removeprefix(GENERATION)) for n in _folders(self.spark, self.root) if n.startswith(GENERATION)]
        return max((n for n in numbers if _complete(self.spark, f"{self._folder(n)}/{BASE}")), default=0)

    def _folder(self, generation: int) -> str:
        return f"{self.root}/{GENERATION}{generation}"

    def _batches(self, generation: int) -> list[str]:
        folder = self._folder(generation)
        names = [n for n in _folders(self.spark, folder) if n.startswith(BATCH)]
        return [n.removeprefix(BATCH) for n in names if _complete(self.spark, f"{folder}/{n}")]

    def recorded(self) -> set[str]:
        """Names of the batches in the sums."""
        now = self._generation()
        names = set(self._batches(now))
        if now:
            names |= {r["batch"] for r in self.spark.read.parquet(f"{self._folder(now)}/{DONE}").collect()}
        return names

    # --- writing -------------------------------------------------------------
    def _stored(self, rows: DataFrame) -> DataFrame:
        """Rows of the table that have a key of ``rows``."""
        keys, table = list(self.entity.key), self.entity.table
        there = self.warehouse._with_part(table, self.entity.schema)
        if self.split_by_key:
            parts = rows.select(self.warehouse._part(table).alias(PART)).distinct().collect()
            there = there.filter(F.col(PART).isin([r[PART] for r in parts]))
        return there.join(rows.select(*keys), keys, "left_semi")

    def _signed(self, rows: DataFrame, sign: int) -> DataFrame:
        columns: list[Column] = [F.col(self.key), F.lit(sign).cast("long").alias("rows")]
        for v in self.values:
            columns.append((F.coalesce(F.col(v).cast(SUM), F.lit(0)) * sign).cast(SUM).alias(v))
            columns.append((F.col(v).isNotNull().cast("long") * sign).alias(f"{v}_n"))
        return rows.select(*columns)

    def _added(self, changes: DataFrame) -> DataFrame:
        names = self.schema.names[1:]
        sums = [F.sum(n).cast(self.schema[n].dataType).alias(n) for n in names]
        changed = F.exists(F.array(*[F.col(n).cast(SUM) for n in names]), lambda x: x != 0)
        return changes.groupBy(self.key).agg(*sums).filter(changed)

    def record(self, batch: str, rows: DataFrame, latest: list[Column], one_per_key: bool = False) -> bool:
        """Store what ``rows`` will change, before they go into the table by the same
        ``latest``; false when the batch is there already. ``one_per_key`` says that no
        key repeats."""
        if batch in self.recorded():
            return False
        new = rows if one_per_key else keep_first(rows, list(self.entity.key), latest)
        kinds = {f.name: f.dataType for f in self.entity.schema}
        new = new.select(*[F.col(c).cast(k).alias(c) if c in new.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
        changes = self._signed(new, 1).unionByName(self._signed(self._stored(new), -1))
        folder = f"{self._folder(self._generation())}/{BATCH}{batch}"
        self._added(changes).write.mode("overwrite").parquet(folder)
        return True

    def compact(self) -> None:
        """Add all changes up into the base of a new generation; the last one stays, the ones
        before it go."""
        now = self._generation()
        folder = self._folder(now + 1)
        done = self.spark.createDataFrame([(b,) for b in sorted(self.recorded())], "batch string")
        done.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{DONE}")
        self.read().write.mode("overwrite").parquet(f"{folder}/{BASE}")
        for name in _folders(self.spark, self.root):
            if name.startswith(GENERATION) and int(name.removeprefix(GENERATION)) < now:
                path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    # --- reading -------------------------------------------------------------
    def read(self) -> DataFrame:
        """The sums per key; keys without any change left out."""
        now = self._generation()
        folder = self._folder(now)
        paths = [f"{folder}/{BATCH}{b}" for b in self._batches(now)]
        if now:
            paths.append(f"{folder}/{BASE}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self._added(self.spark.read.schema(self.schema).parquet(*paths))


class KeptStar(FrameStar):
    """The star of a warehouse whose order totals and balances come from kept sums."""

    def __init__(self, warehouse: Warehouse):
        super().__init__(warehouse.spark, warehouse.star()._frames)
        self.orders, self.products = kept_sums(warehouse).values()

    def line_totals(self) -> DataFrame:
        value = F.when(F.col("valor_total_item_n") > 0, F.col("valor_total_item"))
        return self.orders.read().filter("rows > 0").select(
            "num_pedido", F.col("rows").alias("qtd_itens"),
            value.cast("decimal(24,2)").alias("valor_bruto"),
        )

    def balances(self) -> DataFrame:
        value = F.when(F.col("qty_sinal_n") > 0, F.col("qty_sinal"))
        return self.products.read().select("cod_produto", value.alias("saldo"))


def kept_sums(warehouse: Warehouse) -> dict[str, KeptSums]:
    """The sums behind the sales and stock views, by entity."""
    lines, moves = ENTITIES["itens_pedido_venda"], ENTITIES["movimentacoes_estoque"]
    return {
        lines.name: KeptSums(
            warehouse, "soma_pedido", lines, "num_pedido", ["valor_total_item"], split_by_key=True
        ),
        moves.name: KeptSums(warehouse, "soma_produto", moves, "cod_produto", ["qty_sinal"]),
    }


def upsert_kept(
    warehouse: Warehouse, rows: DataFrame, entity: Entity, batch: str, latest: list[Column],
    one_per_key: bool = False,
) -> None:
    """A batch into its table, its changes into the kept sums first.

    The rows that win their keys are stored, so that the batch is worked out only once;
    ``one_per_key`` says that no key repeats in ``rows``, which is then read several times.
    """
    sums = kept_sums(warehouse).get(entity.name)
    if sums is None:
        warehouse.upsert_entity(rows, entity, latest, one_per_key)
        return
    won = nullcontext(rows) if one_per_key else stored_rows(keep_first(rows, list(entity.key), latest))
    with won as last:
        sums.record(batch, last, latest, one_per_key=True)
        warehouse.upsert_entity(last, entity, latest, one_per_key=True)
