"""Catalog tables that the warehouse writes: defaults, parts, views after a new registration."""

import pytest
from pyspark.sql import functions as F

from tulha.model import ENTITIES
from tulha.sinks.catalog import VIEWS, CatalogWarehouse

CLIENTS = ENTITIES["clientes"]


@pytest.fixture
def warehouse(spark, tmp_path):
    found = CatalogWarehouse(spark, f"file://{tmp_path}/wh", "tulha_catalog_test")
    yield found
    spark.sql("DROP DATABASE tulha_catalog_test CASCADE")


def test_defaults_come_from_the_table(spark, warehouse):
    rows = spark.createDataFrame([("C1", "Um", None), ("C2", "Dois", 5)], "cod_cliente string, razao_social string, limite_credito int")
    warehouse.upsert_entity(rows, CLIENTS, [F.col("cod_cliente")])
    spark.sql(f"INSERT INTO {warehouse.name(CLIENTS.table)} (cod_cliente, razao_social, _part) VALUES ('C3', 'Tres', 'all')")
    warehouse.upsert_entity(rows.drop("limite_credito").limit(0), CLIENTS, [F.col("cod_cliente")])
    found = {r["cod_cliente"]: (r["ativo"], r["_is_active"], r["limite_credito"]) for r in warehouse.table(CLIENTS.table).collect()}
    # An explicit null stays; a column that is left out takes the default of the table.
    assert found == {"C1": (1, 1, None), "C2": (1, 1, 5), "C3": (1, 1, 0)}


def test_upsert_moves_rows_between_parts(spark, warehouse):
    orders = ENTITIES["pedidos_venda"]
    schema = "num_pedido string, data_pedido date, status string"

    def upsert(*rows):
        df = spark.createDataFrame(rows, "num_pedido string, day string, status string")
        df = df.select("num_pedido", F.to_date("day").alias("data_pedido"), "status")
        warehouse.upsert_entity(df, orders, [F.col("num_pedido")])
        parts = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {warehouse.name(orders.table)}").collect()}
        return {(r["num_pedido"], r["status"]) for r in warehouse.table(orders.table).collect()}, parts

    assert schema
    assert upsert(("a", "2024-01-05", "x"), ("b", "2024-02-05", "x")) == (
        {("a", "x"), ("b", "x")}, {"_part=202401", "_part=202402"})
    # The last row of January leaves: its part goes from the catalog and from the files.
    assert upsert(("a", "2024-02-09", "y")) == ({("a", "y"), ("b", "x")}, {"_part=202402"})


def test_views_after_a_new_registration(spark, tmp_path, warehouse):
    from tulha.plans.cataloged import catalog

    filled = catalog(spark, "/root/testdata/sf0.001")
    before = {v: spark.table(filled.name(v)).count() for v in VIEWS}
    assert all(before.values())
    spark.sql(f"DROP DATABASE {filled.database} CASCADE")  # the files stay
    again = CatalogWarehouse(spark, filled.root, filled.database)
    assert {v: spark.table(again.name(v)).count() for v in VIEWS} == before
