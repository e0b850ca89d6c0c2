"""What loads and stored logs leave on disk, and how often they work their rows out."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tulha.model import ENTITIES
from tulha.plans import incremental, landed, loading
from tulha.session import SHORT_SHUFFLES, short_shuffles, shared_dir, stored_rows
from tulha.sinks.warehouse import Warehouse
from tulha.sources.fixture import FixtureStar
from tulha.sources.raw_fixture import ONE_TO_ONE, RawFixture


def set_aside(spark):
    """Rows in the shared folder that are no result: checkpoints and stored rows."""
    top = shared_dir(spark).removeprefix("file://")
    found = [d for d, _, _ in os.walk(top) if os.path.basename(d).startswith(("rdd-", "linhas-"))]
    return sorted(found)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.length()) if files.apply(k).getName().startswith("shuffle_")}


def left_by(spark, before):
    for _ in range(300):  # files go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_stored_rows_go_with_their_block(spark):
    before = set_aside(spark)
    with pytest.raises(ZeroDivisionError), stored_rows(spark.range(5)) as rows:
        assert rows.count() == 5 and len(set_aside(spark)) == len(before) + 1
        raise ZeroDivisionError
    assert set_aside(spark) == before


def test_shuffles_go_with_their_query(spark):
    before, rows = shuffle_files(spark), spark.range(500).groupBy(F.col("id") % 7).count()
    with pytest.raises(ZeroDivisionError), short_shuffles(spark):
        assert rows.selectExpr("sum(count) s").first()["s"] == 500 and not left_by(spark, before)
        raise ZeroDivisionError
    assert spark.conf.get(SHORT_SHUFFLES) == "false"


def test_load_leaves_results_only(spark, folder):
    checkpoints, shuffles = set_aside(spark), shuffle_files(spark)
    warehouse = landed._loaded(spark, folder)
    assert set_aside(spark) == checkpoints and not left_by(spark, shuffles)
    root = warehouse.root.removeprefix("file://")
    landing = f"{os.path.dirname(root)}/landing/movimentacoes_estoque.csv"
    assert all(f.endswith(".gz") for f in os.listdir(landing) if f.startswith("part-"))
    rejected = f"{root}/rejected/produtos_rejected_{landed.RUN}"
    assert all(f.endswith(".gz") for f in os.listdir(rejected) if f.startswith("part-"))


@pytest.mark.parametrize("name", [*ONE_TO_ONE, "clientes"])
def test_extracts_in_order(spark, folder, name):
    raw = RawFixture(spark, folder)
    found = raw.in_order(name).withColumn("_place", F.monotonically_increasing_id())
    places = [r["_ord"] for r in found.orderBy("_place").select("_ord").collect()]
    assert places == [r["_ord"] for r in raw.extract(name).orderBy("_ord").select("_ord").collect()]
    columns = list(ENTITIES[name].columns)
    assert found.select(columns).exceptAll(raw.extract(name).select(columns)).isEmpty()


def test_kept_views_work_lines_out_once(spark, tmp_path, monkeypatch):
    import shutil

    shutil.copytree("/root/testdata/sf0.001", tmp_path / "t")
    asked, lines = [], FixtureStar._lines
    monkeypatch.setattr(FixtureStar, "_lines", lambda self, orders=None: asked.append(1) or lines(self, orders))
    checkpoints, shuffles = set_aside(spark), shuffle_files(spark)
    incremental._kept(spark, str(tmp_path / "t"))
    assert len(asked) == 1 and set_aside(spark) == checkpoints and not left_by(spark, shuffles)


def test_batch_is_worked_out_once(spark, tmp_path):
    """Rows drawn anew each time they are worked out: sums and table must have the same ones."""
    from tulha.sinks.kept import kept_sums, upsert_kept

    moves, kept = ENTITIES["movimentacoes_estoque"], Warehouse(spark, f"file://{tmp_path}/wh", keeps_sums=True)
    rows = spark.range(40).select(
        F.concat(F.lit("m"), "id").alias("num_mov"), F.lit("a").alias("cod_produto"),
        F.expr("cast(conv(substr(uuid(), 1, 6), 16, 10) as decimal(14,2))").alias("qty_sinal"))
    for batch in ("b0", "b1"):
        upsert_kept(kept, rows, moves, batch, [F.col("num_mov")])
    stored = kept.table(moves.table).agg(F.sum("qty_sinal")).first()[0]
    assert [r["qty_sinal"] for r in kept_sums(kept)[moves.name].read().collect()] == [stored]


def test_upsert_of_unique_rows(spark, tmp_path):
    clients, warehouse = ENTITIES["clientes"], Warehouse(spark, f"file://{tmp_path}/wh")
    rows = spark.createDataFrame([("C1", "a"), (None, "b"), ("C2", "c")], "cod_cliente string, razao_social string")
    for change in (rows, rows.filter("cod_cliente = 'C1'").withColumn("razao_social", F.lit("z"))):
        warehouse.upsert_entity(change, clients, [F.col("cod_cliente")], one_per_key=True)
    table = warehouse.table(clients.table).select("cod_cliente", "razao_social", "limite_credito").collect()
    assert sorted(map(tuple, table), key=str) == [("C1", "z", 0), ("C2", "c", 0), (None, "b", 0)]


def test_first_replace_needs_no_look_at_the_rows(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, f"file://{tmp_path}/wh")
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", lambda self: pytest.fail("looked at"))
    warehouse.replace(spark.range(3), "stg_x")
    assert warehouse.read("stg_x", spark.range(1).schema).count() == 3


def test_stored_log_leaves_results_only(spark, tmp_path):
    import shutil

    shutil.copytree("/root/testdata/sf0.001", tmp_path / "t")
    shuffles = shuffle_files(spark)
    log = loading.StoredLog(RawFixture(spark, str(tmp_path / "t")))
    assert not left_by(spark, shuffles) and spark.conf.get(SHORT_SHUFFLES) == "false"
    logged = {r["entity"]: r["count"] for r in log.rejects().groupBy("entity").count().collect()}
    runs = {r["entity"]: r["n"] for r in log.runs().groupBy("entity").agg(F.sum("rejected_rows").alias("n")).collect()}
    assert logged == {k: n for k, n in runs.items() if n}
