"""Arrival-driven loads: each landed file is processed once, in micro-batches."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tulha.functions.columns import signed_quantity
from tulha.loader import store
from tulha.model import ENTITIES, NUMBER
from tulha.operators.cleaning import null_tokens
from tulha.session import cut_lineage
from tulha.sinks.warehouse import Warehouse
from tulha.operators.rules import MALFORMED
from tulha.sources.csv_files import CSV_OPTIONS, row_hash


def landed_rows(
    spark: SparkSession, folder: str, name: str, max_files: int | None = None
) -> DataFrame:
    """Stream of the CSV rows of one entity, with their place in the source.

    A file whose header is not the entity's columns in their order stops the stream.
    """
    entity = ENTITIES[name]
    schema = T.StructType([*entity.raw_schema, T.StructField(MALFORMED, T.StringType())])
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    columns = list(entity.columns)
    rows = reader.csv(folder).select(
        *columns,
        MALFORMED,
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    return null_tokens(rows, columns).withColumn("_row_hash", row_hash(columns))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the running stream; it lives in the checkpoint and is new for a new one."""
    running = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return running or hashlib.md5(checkpoint.encode()).hexdigest()


def ingest(
    spark: SparkSession, folder: str, name: str, root: str, checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Load every file not loaded yet into the warehouse, then stop.

    Batch ids begin at 0 for every checkpoint, so the stream's own id is part of the
    name of a batch wherever it is stored. A batch that is run again after a failure
    overwrites its own log folders, and its upsert gives the same table.
    """
    warehouse = Warehouse(spark, root)

    def load_batch(rows: DataFrame, batch_id: int) -> None:
        batch = f"stream-{name}-{stream_id(rows.sparkSession, checkpoint)}-{batch_id}"
        place = F.struct("_source_file", "_block", F.monotonically_increasing_id().alias("row"))
        numbered = rows.withColumns(
            {"_ord": place, "_pipeline_run_id": F.lit(batch), "_ingestion_ts": F.current_timestamp()}
        ).withColumn("_row_id", F.col("_ord.row"))
        store(warehouse, name, cut_lineage(numbered.drop("_block")), batch)

    return (
        landed_rows(spark, folder, name, max_files)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


BALANCE = T.StructType([
    T.StructField("cod_produto", T.LongType()),
    T.StructField("saldo_atual", T.DecimalType(28, 4)),
    T.StructField("movimentos", T.LongType()),
])


def balance_of(moves: DataFrame) -> DataFrame:
    """Running balance and number of movements per product, batch or stream."""
    signed = signed_quantity(F.col("tipo_mov"), F.col("quantidade").cast(NUMBER))
    return moves.groupBy("cod_produto").agg(
        F.sum(signed).cast("decimal(28,4)").alias("saldo_atual"),
        F.count(F.lit(1)).alias("movimentos"),
    )


def keep_balance(
    moves: DataFrame, root: str, checkpoint: str, table: str = "saldo_corrente"
) -> StreamingQuery:
    """Maintain the balance table from a stream of movements.

    Update mode sends only products that changed; their new balance replaces the
    stored row, so running a batch again gives the same table.
    """
    warehouse = Warehouse(moves.sparkSession, root)
    keys = ["cod_produto"]

    def merge(changed: DataFrame, batch_id: int) -> None:
        warehouse.upsert(cut_lineage(changed), table, keys, BALANCE, [F.desc("movimentos")])

    return (
        balance_of(moves)
        .writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
