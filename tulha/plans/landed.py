"""Registered queries that render extracts as landed CSV files, load them and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tulha.loader import load_all
from tulha.model import ENTITIES
from tulha.plans.etl import decimals_as_double
from tulha.plans.loading import union_all
from tulha.plans.shared import shared_path
from tulha.session import scratch_path
from tulha.sinks.warehouse import Warehouse
from tulha.sources.csv_files import read_csv
from tulha.sources.raw_fixture import RawFixture

RUN = "carga"


def _land(rows: DataFrame, path: str) -> str:
    writer = rows.write.option("header", True).option("escape", '"').option("emptyValue", "")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("compression", "gzip")
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def _loaded(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse after one load of all entities from their landed files.

    The files keep the order of the extract, which decides the row that a key keeps.
    """

    def build(base: str) -> None:
        raw, sources = RawFixture(spark, sf_dir), {}
        for name, entity in ENTITIES.items():
            rows = raw.in_order(name).select(*entity.columns)
            sources[name] = _land(rows, f"{base}/landing/{name}.csv")
        # Two at a time: three of the sources are as long as the lines, and each one's
        # shuffles are on disk while it is judged.
        load_all(spark, sources, f"{base}/warehouse", RUN, at_once=2)

    return Warehouse(spark, f"{shared_path(spark, 'carga', sf_dir, build)}/warehouse")


def src_csv_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV with quotes, commas and line breaks in names, read back."""
    columns = list(ENTITIES["clientes"].columns)
    name, code = F.col("razao_social"), F.col("cod_cliente")
    odd = (
        F.when(code.endswith("0"), F.concat(F.lit('Loja "'), name, F.lit('", filial')))
        .when(code.endswith("5"), F.concat(name, F.lit("\nsegunda linha")))
        .otherwise(name)
    )
    rows = RawFixture(spark, sf_dir).extract("clientes").withColumn("razao_social", odd)
    path = _land(rows.select(*columns), scratch_path(spark, "csv"))
    return read_csv(spark, path, multi_line=True).select(*columns, "_row_hash", "_malformed")


def carga_fornecedores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier table after a load from landed files."""
    table = _loaded(spark, sf_dir).table("dim_fornecedores")
    return decimals_as_double(table.drop("_dw_loaded_at", "_is_active"))


def carga_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, kept and rejected by a load, from its run log."""
    log = _loaded(spark, sf_dir).run_log()
    return log.select("entity", "status", "input_rows", "valid_rows", "rejected_rows")


def carga_metadados(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load marks of the target tables, and rows of the staging tables."""
    warehouse = _loaded(spark, sf_dir)
    counted = []
    for entity in ENTITIES.values():
        staged = warehouse.read(entity.staging, entity.raw_schema)
        counted.append(
            warehouse.table(entity.table).agg(
                F.lit(entity.table).alias("tabela"),
                F.count(F.lit(1)).alias("registros"),
                F.count_if(F.col("_is_active") == 1).alias("ativos"),
                F.count("_dw_loaded_at").alias("carimbados"),
            )
        )
        counted.append(
            staged.agg(
                F.lit(entity.staging).alias("tabela"),
                F.count(F.lit(1)).alias("registros"),
                F.lit(None).cast("long").alias("ativos"),
                F.lit(None).cast("long").alias("carimbados"),
            )
        )
    return union_all(counted)


def carga_rejeitos_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected products of a load, from the CSV files it left."""
    warehouse = _loaded(spark, sf_dir)
    rows = spark.read.option("header", True).csv(f"{warehouse.root}/rejected/produtos_rejected_{RUN}")
    return rows.select("cod_produto", "_reject_reason", "_reject_detail")
