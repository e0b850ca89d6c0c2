"""Streams with keyed state: late rows, repeats across restarts, bounded state, orphans."""

import datetime as dt

import pytest

from tulha.sinks.warehouse import Warehouse
from tulha.streaming.ingest import BALANCE, keep_balance
from tulha.streaming.stateful import MATCHED, first_arrivals, keep_matched, lines_with_orders

MOVES = "num_mov string, cod_produto long, tipo_mov string, quantidade double, recebido_em timestamp"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def land(spark, folder, schema, rows):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).parquet(str(folder))


def test_repeats_go_inside_the_stream(spark, tmp_path):
    def lot(*rows):
        rows = [(k, 1, "ENTRADA", float(q), at(m)) for k, q, m in rows]
        landed = land(spark, tmp_path / "in", MOVES, rows)
        query = keep_balance(first_arrivals(landed, ["num_mov"], "1 hour"), str(tmp_path / "wh"), str(tmp_path / "cp"))
        query.awaitTermination()
        table = Warehouse(spark, str(tmp_path / "wh")).read("saldo_corrente", BALANCE)
        kept = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"] if "dedup" in s["operatorName"].lower()]
        return [(float(r["saldo_atual"]), r["movimentos"]) for r in table.collect()], kept[-1]

    assert lot(("a", 1, 0), ("b", 2, 10), ("b", 2, 10)) == ([(3.0, 2)], 2)
    # A repeat after a restart, and a row that is late by less than the delay.
    assert lot(("a", 1, 20), ("c", 4, 5)) == ([(7.0, 3)], 3)
    # Far later rows push the keys of the first hour out of the state.
    balance, kept = lot(("d", 8, 600))
    assert balance == [(15.0, 4)] and kept == 1
    # A row later than the watermark allows is dropped, not counted twice.
    assert lot(("a", 1, 30)) == ([(15.0, 4)], 1)


LINES = "num_pedido string, seq_item long, recebido_em timestamp"
ORDERS = "num_pedido string, recebido_em timestamp"


def test_orphan_lines_after_the_delay(spark, tmp_path):
    def lot(lines, orders):
        left = land(spark, tmp_path / "lines", LINES, [(k, n, at(m)) for k, n, m in lines])
        right = land(spark, tmp_path / "orders", ORDERS, [(k, at(m)) for k, m in orders])
        keep_matched(lines_with_orders(left, right, "1 hour"), str(tmp_path / "wh"), str(tmp_path / "cp")).awaitTermination()
        warehouse = Warehouse(spark, str(tmp_path / "wh"))
        kept = {(r["num_pedido"], r["seq_item"]) for r in warehouse.appended(MATCHED, left.schema).collect()}
        gone = sorted(r["row_data"].split('"')[3] for r in warehouse.reject_log().collect())
        return kept, gone

    first = lot([("a", 1, 0), ("b", 1, 1), ("x", 1, 2), ("x", 2, 2)], [("a", 3)])
    assert first == ({("a", 1)}, [])
    # The order of b comes after its line, and after a restart; x waits.
    second = lot([("a", 2, 20)], [("b", 30)])
    assert second == ({("a", 1), ("a", 2), ("b", 1)}, [])
    # A day later nothing can come for x any more.
    kept, gone = lot([("z", 1, 1440)], [("z", 1440)])
    assert kept == {("a", 1), ("a", 2), ("b", 1), ("z", 1)} and gone == ["x", "x"]


@pytest.mark.parametrize("label", ["shared"])
def test_shared_results_follow_the_files(spark, tmp_path, label):
    from tulha.plans.shared import shared_path

    built = []
    folder = tmp_path / "tables"
    folder.mkdir()
    (folder / "a.parquet").write_text("one")

    def build(path):
        built.append(path)
        spark.range(1).write.parquet(path)

    first = shared_path(spark, label, str(folder), build)
    assert shared_path(spark, label, str(folder), build) == first and len(built) == 1
    (folder / "a.parquet").write_text("other")
    assert shared_path(spark, label, str(folder), build) != first and len(built) == 2
    Warehouse(spark, str(tmp_path))._remove_part("none", "none")  # nothing there: no error
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(built[1])
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    shared_path(spark, label, str(folder), build)
    assert len(built) == 3
