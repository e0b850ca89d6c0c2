"""Streams with keyed state that a watermark bounds: repeats, and lines without an order.

Rows carry the time they were received. A row counts as late after ``DELAY``: state older
than that is dropped, so its size follows the rows of one delay, not of the whole stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tulha.sinks.warehouse import Warehouse
from tulha.streaming.ingest import stream_id

RECEIVED = "recebido_em"
DELAY = "6 hours"
ORPHAN = "ORPHAN"
MATCHED = "itens_conferidos"


def first_arrivals(rows: DataFrame, keys: list[str], delay: str = DELAY) -> DataFrame:
    """The row of each key that arrives first; repeats within the delay are dropped.

    A key leaves the state when the watermark has passed its row by the delay.
    """
    return rows.withWatermark(RECEIVED, delay).dropDuplicatesWithinWatermark(keys)


def lines_with_orders(lines: DataFrame, orders: DataFrame, delay: str = DELAY) -> DataFrame:
    """Lines with ``_pedido``, the order's number, or null once the delay is over without it.

    ``orders`` has each order once. A line may arrive before or after its order, by up to
    the delay; both sides keep their rows no longer than that.
    """
    known = orders.select(
        F.col("num_pedido").alias("_pedido"), F.col(RECEIVED).alias("_recebido")
    ).withWatermark("_recebido", delay)
    gap = F.expr(f"INTERVAL {delay}")
    near = (F.col("_pedido") == F.col("num_pedido")) & F.col("_recebido").between(
        F.col(RECEIVED) - gap, F.col(RECEIVED) + gap
    )
    return lines.withWatermark(RECEIVED, delay).join(known, near, "left")


def keep_matched(matched: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Store lines that have an order, and reject the others, from ``lines_with_orders``.

    Both go to folders named after the stream and its batch: a batch that is run again
    writes the same folders.
    """
    warehouse = Warehouse(matched.sparkSession, root)

    def store(rows: DataFrame, batch_id: int) -> None:
        batch = f"itens-{stream_id(rows.sparkSession, checkpoint)}-{batch_id}"
        kept = rows.drop("_pedido", "_recebido")
        warehouse.append(kept.where(rows["_pedido"].isNotNull()), MATCHED, batch)
        orphans = kept.where(rows["_pedido"].isNull()).select(
            F.lit("itens_pedido_venda").alias("entity"),
            F.lit(ORPHAN).alias("reject_reason"),
            F.to_json(F.struct("*")).alias("row_data"),
            F.lit(batch).alias("pipeline_run"),
            F.current_timestamp().alias("logged_at"),
        )
        warehouse.append(orphans, "log_registros_rejeitados", batch)

    return (
        matched.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
