"""Kept sums against sums over the whole table, with retractions, retries and compaction."""

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tulha.loader import store
from tulha.model import ENTITIES
from tulha.plans.views import vw_estoque_atual
from tulha.sinks.kept import KeptStar, KeptSums, kept_sums, upsert_kept
from tulha.sinks.warehouse import Warehouse

LINES, MOVES = ENTITIES["itens_pedido_venda"], ENTITIES["movimentacoes_estoque"]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"file://{tmp_path}/wh", keeps_sums=True)


def moves(spark, *rows):
    df = spark.createDataFrame(rows, "num_mov string, cod_produto string, q string, day string")
    return df.select("num_mov", "cod_produto", F.col("q").cast("decimal(14,2)").alias("qty_sinal"), F.to_date("day").alias("data_mov"))


def sums(kept):
    return {r["cod_produto"]: (r["rows"], r["qty_sinal"], r["qty_sinal_n"]) for r in kept.read().collect()}


def whole(warehouse):
    rows = warehouse.table(MOVES.table).groupBy("cod_produto").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("qty_sinal"), F.lit(0)).alias("s"), F.count("qty_sinal").alias("c"))
    return {r["cod_produto"]: (r["n"], r["s"], r["c"]) for r in rows.collect()}


def test_sums_follow_batches_that_replace_rows(spark, warehouse):
    kept, key, dice = kept_sums(warehouse)[MOVES.name], [F.desc("qty_sinal")], random.Random(3)
    assert kept.read().isEmpty() and kept.recorded() == set()
    for number in range(3):
        rows = [
            (f"m{dice.randrange(12)}", dice.choice(["a", "b", "c", None]), dice.choice(["1.5", "-2", "0", None]), f"2024-0{dice.randrange(1, 4)}-01")
            for _ in range(10)
        ]  # keys repeat within a batch and between batches, and move between months
        batch = moves(spark, *rows)
        upsert_kept(warehouse, batch, MOVES, f"b{number}", key)
        assert sums(kept) == whole(warehouse)
        if number == 1:
            kept.compact()
            assert sums(kept) == whole(warehouse) and kept.recorded() == {"b0", "b1"}
        upsert_kept(warehouse, batch, MOVES, f"b{number}", key)  # run again
        assert sums(kept) == whole(warehouse)


def test_a_batch_that_died_between_sums_and_table(spark, warehouse):
    kept, key = kept_sums(warehouse)[MOVES.name], [F.col("num_mov")]
    upsert_kept(warehouse, moves(spark, ("m1", "a", "5", "2024-01-01")), MOVES, "b0", key)
    batch = moves(spark, ("m1", "b", "7", "2024-02-01"), ("m2", "a", "1", "2024-01-01"))
    assert kept.record("b1", batch, key)  # the table was not reached
    assert not kept.record("b1", batch, key)
    upsert_kept(warehouse, batch, MOVES, "b1", key)
    assert sums(kept) == whole(warehouse) == {"b": (1, Decimal(7), 1), "a": (1, Decimal(1), 1)}
    # Changes without their end mark do not count, nor does a base without one.
    folder = f"{warehouse.root}/soma_produto/geracao="
    moves(spark).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}0/lote=b2")
    moves(spark).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}1/base")
    assert kept.recorded() == {"b0", "b1"} and sums(kept) == whole(warehouse)
    kept.compact()
    kept.compact()
    assert kept.recorded() == {"b0", "b1"} and sums(kept) == whole(warehouse)


def test_only_parts_of_the_batch_are_read(spark, warehouse):
    rows = spark.range(300).select(
        F.concat(F.lit("v"), "id").alias("num_pedido"), F.lit(1).alias("seq_item"), F.lit(2).cast("decimal(14,2)").alias("valor_total_item"))
    upsert_kept(warehouse, rows, LINES, "b0", [F.col("seq_item")])
    kept = kept_sums(warehouse)[LINES.name]
    one = rows.filter("num_pedido = 'v7'").withColumn("valor_total_item", F.lit(9))
    plan = kept._stored(one)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(_part#\d+\), \(_part#\d+ = \d+\)\]", plan)
    upsert_kept(warehouse, one, LINES, "b1", [F.col("seq_item")])
    totals = {r["num_pedido"]: (r["qtd_itens"], r["valor_bruto"]) for r in KeptStar(warehouse).line_totals().collect()}
    assert len(totals) == 300 and totals["v7"] == (1, 9) and totals["v8"] == (1, 2)


def test_loads_keep_the_sums(spark, warehouse):
    from test_rules import BASE

    def load(name, batch, *changes):
        columns = list(ENTITIES[name].columns)
        rows = [tuple(None if (v := {**BASE[name], **c}[k]) is None else str(v) for k in columns) for c in changes]
        store(warehouse, name, spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)), batch)

    load("produtos", "r1", {})
    load("movimentacoes_estoque", "r1", {}, {"num_mov": "M77"})
    load("movimentacoes_estoque", "r2", {"num_mov": "M77"}, {"num_mov": "M78"})
    full = vw_estoque_atual(warehouse.star()).collect()
    assert vw_estoque_atual(KeptStar(warehouse)).collect() == full and full[0]["saldo_atual"] != 0
    assert kept_sums(warehouse)[MOVES.name].recorded() == {"r1-movimentacoes_estoque", "r2-movimentacoes_estoque"}
    assert isinstance(kept_sums(warehouse)[LINES.name], KeptSums)
