"""A warehouse whose tables and views live in the catalog, over the same files.

Tables are created with their column defaults and written by ``insertInto``, so the catalog
knows every part. Nothing but the files and the table definitions is kept: a session with an
empty catalog registers the same folder again and finds all parts and views.

Dynamic partition overwrite is set for the session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tulha.model import ALERT_FACTOR, ENTITIES, Entity
from tulha.operators.calendar import build_calendar
from tulha.sinks.warehouse import PART, Warehouse

ORDER_TOTALS = """
    SELECT {key}, count(seq_item) AS qtd_itens, CAST(sum(valor_total_item) AS DECIMAL(24,2)) AS valor
    FROM {db}.{lines} GROUP BY {key}"""

VIEWS = {
    "vw_estoque_atual": """
        SELECT cod_produto, descricao, categoria, unidade, CAST(custo_unitario AS DOUBLE) AS custo_unitario,
               CAST(preco_venda AS DOUBLE) AS preco_venda, estoque_minimo, estoque_maximo,
               CAST(saldo AS DOUBLE) AS saldo_atual,
               CAST(coalesce(saldo * custo_unitario, 0) AS DOUBLE) AS valor_estoque,
               CASE WHEN saldo <= estoque_minimo THEN 'CRITICO'
                    WHEN saldo <= estoque_minimo * {alert} THEN 'ALERTA' ELSE 'OK' END AS status_estoque
        FROM (SELECT p.*, CAST(coalesce(m.saldo, 0) AS DECIMAL(24,2)) AS saldo
              FROM {db}.dim_produtos p
              LEFT JOIN (SELECT cod_produto, sum(qty_sinal) AS saldo
                         FROM {db}.fct_movimentacoes_estoque GROUP BY cod_produto) m
                ON m.cod_produto = p.cod_produto
              WHERE p._is_active = 1)""",
    "vw_vendas_consolidadas": """
        SELECT o.num_pedido, o.data_pedido, o.status, o.cod_cliente, c.razao_social AS cliente,
               c.segmento, c.estado, l.qtd_itens, CAST(l.valor AS DOUBLE) AS valor_bruto,
               CAST(o.desconto_percentual AS DOUBLE) AS desconto_percentual,
               CAST(round(l.valor * (100 - CAST(o.desconto_percentual AS DECIMAL(9,4))) * 0.01, 2) AS DOUBLE)
                   AS valor_liquido, t.mes, t.trimestre, t.ano
        FROM {db}.fct_pedidos_venda o
        JOIN ({sales}) l ON l.num_pedido = o.num_pedido
        JOIN {db}.dim_clientes c ON c.cod_cliente = o.cod_cliente
        LEFT JOIN {db}.dim_tempo t ON t.data = o.data_pedido
        WHERE o.status <> 'CANCELADO'""",
    "vw_compras_consolidadas": """
        SELECT o.num_oc, o.data_oc, o.status, o.cod_fornecedor, f.razao_social AS fornecedor,
               f.categoria AS categoria_fornecedor, l.qtd_itens, CAST(l.valor AS DOUBLE) AS valor_total_oc,
               t.mes, t.trimestre, t.ano
        FROM {db}.fct_pedidos_compra o
        JOIN ({purchases}) l ON l.num_oc = o.num_oc
        JOIN {db}.dim_fornecedores f ON f.cod_fornecedor = o.cod_fornecedor
        LEFT JOIN {db}.dim_tempo t ON t.data = o.data_oc
        WHERE o.status <> 'CANCELADO'""",
}


def _literal(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


class CatalogWarehouse(Warehouse):
    def __init__(self, spark: SparkSession, root: str, database: str, **options):
        super().__init__(spark, root, **options)
        self.database = database
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        self.columns: dict[str, T.StructType] = {e.table: e.schema for e in ENTITIES.values()}
        self.columns["dim_tempo"] = build_calendar(spark, "2024-01-01", "2024-01-01").schema
        self._create()

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def _create(self) -> None:
        """Register tables, parts and views that the catalog does not have."""
        spark = self.spark
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        defaults = {e.table: {"_is_active": 1, **e.defaults} for e in ENTITIES.values()}
        for table, schema in self.columns.items():
            columns = []
            for f in schema:
                value = defaults.get(table, {}).get(f.name)
                kind = f.dataType.simpleString()
                default = "" if value is None else f" DEFAULT CAST({_literal(value)} AS {kind})"
                columns.append(f"`{f.name}` {kind}{default}")
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({', '.join(columns)}, {PART} STRING) "
                f"USING parquet PARTITIONED BY ({PART}) LOCATION '{self.root}/{table}'"
            )
            self._ensure_folder(f"{self.root}/{table}")
            spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")
        totals = {
            "sales": ORDER_TOTALS.format(key="num_pedido", lines="fct_itens_pedido_venda", db=self.database),
            "purchases": ORDER_TOTALS.format(key="num_oc", lines="fct_itens_pedido_compra", db=self.database),
        }
        for view, text in VIEWS.items():
            query = text.format(db=self.database, alert=ALERT_FACTOR, **totals)
            spark.sql(f"CREATE OR REPLACE VIEW {self.name(view)} AS {query}")

    def _ensure_folder(self, folder: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)

    # --- reading -------------------------------------------------------------
    def _with_part(self, table: str, schema: T.StructType) -> DataFrame:
        if table not in self.columns:
            return super()._with_part(table, schema)
        return self.spark.table(self.name(table)).select(*schema.fieldNames(), PART)

    def defaults(self, table: str) -> dict[str, Column]:
        """What the table itself puts into columns that an insert leaves out."""
        fields = self.spark.table(self.name(table)).schema.fields
        return {f.name: F.expr(f.metadata["CURRENT_DEFAULT"]) for f in fields if "CURRENT_DEFAULT" in f.metadata}

    # --- writing -------------------------------------------------------------
    def _write(self, df: DataFrame, table: str, mode: str = "dynamic") -> None:
        """Replace the parts that ``df`` has; ``static`` drops all other parts after that."""
        if table not in self.columns:
            return super()._write(df, table, mode)
        names = self.columns[table].fieldNames()
        rows = df.withColumn(PART, self._part(table)).select(*names, PART)
        rows.hint("rebalance", F.col(PART)).write.insertInto(self.name(table), overwrite=True)
        if mode == "static":
            kept = {r[PART] for r in rows.select(PART).distinct().collect()}
            there = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
            for part in {r["partition"].split("=", 1)[1] for r in there} - kept:
                self._remove_part(table, part)

    def _remove_part(self, table: str, part: str) -> None:
        if table in self.columns:
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({PART} = '{part}')")
        super()._remove_part(table, part)

    def upsert_entity(
        self, df: DataFrame, entity: Entity, latest: list[Column], one_per_key: bool = False
    ) -> None:
        defaults = self.defaults(entity.table)
        self.upsert(df, entity.table, list(entity.key), entity.schema, latest, defaults, one_per_key)
