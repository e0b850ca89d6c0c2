"""Registered streaming queries: run to the end of the data, then read the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tulha.model import ENTITIES
from tulha.plans.etl import accepted, decimals_as_double
from tulha.session import scratch_path
from tulha.sinks.warehouse import Warehouse
from tulha.sources.fixture import FixtureStar
from tulha.sources.raw_fixture import RawFixture
from tulha.streaming.ingest import BALANCE, ingest, keep_balance
from tulha.streaming.stateful import RECEIVED, first_arrivals, keep_matched, lines_with_orders


def st_ingestao_pedidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales orders landed as CSV files, loaded by the incremental ingest."""
    entity = ENTITIES["pedidos_venda"]
    base = scratch_path(spark, "ingestao")
    raw = RawFixture(spark, sf_dir).extract(entity.name).select(*entity.columns)
    writer = raw.write.option("header", True).option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(f"{base}/landing")
    ingest(
        spark, f"{base}/landing", entity.name, f"{base}/warehouse", f"{base}/checkpoint"
    ).awaitTermination()
    loaded = Warehouse(spark, f"{base}/warehouse").table(entity.table)
    return decimals_as_double(loaded.drop("_dw_loaded_at", "_is_active"))


def st_saldo_produto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock balance per product, kept by a stream over landed movement files.

    The movements land as files of the star's fact table, in which repeats are gone; the
    stream's balance is the one of the batch view.
    """
    base = scratch_path(spark, "saldo")
    moves = FixtureStar(spark, sf_dir).table(
        "fct_movimentacoes_estoque", "cod_produto", "tipo_mov", "quantidade"
    )
    moves.write.parquet(f"{base}/landing")
    landed = spark.readStream.schema(moves.schema).parquet(f"{base}/landing")
    keep_balance(landed, f"{base}/warehouse", f"{base}/checkpoint").awaitTermination()
    table = Warehouse(spark, f"{base}/warehouse").read("saldo_corrente", BALANCE)
    return decimals_as_double(table)


def _received(lot: int, by: Column) -> Column:
    """A time within the hour of a lot, spread by a hash."""
    return F.timestamp_seconds(F.lit(1704067200 + 3600 * lot) + F.pmod(F.xxhash64(by), F.lit(3600)))


def st_saldo_repetidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock balance per product from movements that arrive with their repeats.

    Three lots land one after the other, and the stream is started anew for each. The last
    one holds all repeats, and first rows that are late: received two hours before.
    """
    base = scratch_path(spark, "repetidos")
    sent = FixtureStar(spark, sf_dir).movements_as_sent()
    share = F.pmod(F.xxhash64("num_mov"), F.lit(10))
    first = F.col("ordem") == 1
    lots = [first & (share < 5), first & share.between(5, 8), ~first | (share == 9)]
    columns = ["num_mov", "cod_produto", "tipo_mov", "quantidade"]
    for lot, chosen in enumerate(lots):
        when = F.when(first & (share == 9), _received(0, F.col("num_mov"))).otherwise(
            _received(lot, F.col("num_mov"))
        )
        rows = sent.where(chosen).select(*columns, when.alias(RECEIVED))
        rows.write.mode("append").parquet(f"{base}/landing")
        landed = spark.readStream.schema(rows.schema).parquet(f"{base}/landing")
        once = first_arrivals(landed, ["num_mov"])
        keep_balance(once, f"{base}/warehouse", f"{base}/checkpoint").awaitTermination()
    table = Warehouse(spark, f"{base}/warehouse").read("saldo_corrente", BALANCE)
    return decimals_as_double(table)


def st_itens_orfaos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted sales lines whose order never arrives, rejected once the delay is over.

    Half of the orders land a lot later than their lines, the others a lot before. A mark a
    day later on both streams moves the watermark past the last line.
    """
    base = scratch_path(spark, "orfaos")
    raw = RawFixture(spark, sf_dir)
    lines = accepted(raw.extract("itens_pedido_venda"), "itens_pedido_venda").select("num_pedido", "seq_item")
    orders = accepted(raw.extract("pedidos_venda"), "pedidos_venda").select("num_pedido")
    number = F.col("num_pedido")
    early = F.pmod(F.xxhash64(number), F.lit(2)) == 0
    mark = spark.range(1).select(F.lit("fim").alias("num_pedido"), F.lit(0).cast("long").alias("seq_item"))
    lots = [
        (lines.where(early), orders.where(~early)), (lines.where(~early), orders.where(early)),
        (mark, mark.select("num_pedido")),
    ]
    for lot, (some_lines, some_orders) in enumerate(lots):
        hour = 24 * lot if lot == 2 else lot
        parts = {"lines": some_lines, "orders": some_orders}
        landed = {}
        for name, rows in parts.items():
            rows = rows.withColumn(RECEIVED, _received(hour, number))
            rows.write.mode("append").parquet(f"{base}/{name}")
            landed[name] = spark.readStream.schema(rows.schema).parquet(f"{base}/{name}")
        matched = lines_with_orders(landed["lines"], landed["orders"])
        keep_matched(matched, f"{base}/warehouse", f"{base}/checkpoint").awaitTermination()
    log = Warehouse(spark, f"{base}/warehouse").reject_log()
    row = F.from_json("row_data", "num_pedido string, seq_item bigint").alias("r")
    return log.select("reject_reason", row).select("r.num_pedido", "r.seq_item", "reject_reason")
