"""Star schema derived from TPC-H-like tables.

The derivation is a plan like any other: nothing is read until a report runs,
and a report pays only for the columns it names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tulha.functions.columns import line_total, signed_quantity
from tulha.operators.calendar import build_calendar
from tulha.operators.dedup import keep_first

FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"
AS_OF = "2001-08-01"

# Tie-break of repeated (order, line) rows: every column a report can see.
LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
    "l_linestatus", "l_shipdate",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _unit_cost(price):
    return F.round(price.cast("decimal(12,2)") * F.lit(0.6).cast("decimal(2,1)"), 2).cast(
        "decimal(12,2)"
    )


class FixtureStar:
    """Star tables as lazy plans over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir

    def table(self, name: str, *columns: str) -> DataFrame:
        build = getattr(self, f"_{name}")
        frame = build(set(columns))
        return frame.select(*columns) if columns else frame

    def _read(self, name: str) -> DataFrame:
        return read_table(self.spark, self._dir, name)

    def _nation_names(self) -> DataFrame:
        # 25 nations at every scale factor.
        return F.broadcast(self._read("nation").select("n_nationkey", "n_name"))

    # --- dimensions ----------------------------------------------------------
    def _dim_produtos(self, wanted: set[str]) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(12,2)")
        parts = self._read("part")
        if not wanted or "cod_fornecedor_principal" in wanted:
            suppliers = self._read("supplier").agg(F.count(F.lit(1)))
            supplier = F.col("p_partkey") % suppliers.scalar()
        else:
            supplier = F.lit(None).cast("long")
        return parts.select(
            F.col("p_partkey").alias("cod_produto"),
            F.upper("p_name").alias("descricao"),
            F.col("p_type").alias("categoria"),
            F.lit("UN").alias("unidade"),
            _unit_cost(F.col("p_retailprice")).alias("custo_unitario"),
            price.alias("preco_venda"),
            F.col("p_size").alias("estoque_minimo"),
            (F.col("p_size") * 10).alias("estoque_maximo"),
            F.lit(1).alias("ativo"),
            supplier.alias("cod_fornecedor_principal"),
            F.lit(1).alias("_is_active"),
        )

    def _dim_clientes(self, wanted: set[str]) -> DataFrame:
        customers = self._read("customer")
        if not wanted or "estado" in wanted:
            customers = customers.join(
                self._nation_names(), F.col("c_nationkey") == F.col("n_nationkey"), "left"
            )
        else:
            customers = customers.withColumn("n_name", F.lit(None).cast("string"))
        return customers.select(
            F.col("c_custkey").alias("cod_cliente"),
            F.upper("c_name").alias("razao_social"),
            F.col("c_mktsegment").alias("segmento"),
            F.col("n_name").alias("estado"),
            F.col("c_acctbal").cast("decimal(14,2)").alias("limite_credito"),
            F.lit(1).alias("_is_active"),
        )

    def _dim_fornecedores(self, wanted: set[str]) -> DataFrame:
        suppliers = self._read("supplier").join(
            self._nation_names(), F.col("s_nationkey") == F.col("n_nationkey"), "left"
        )
        return suppliers.select(
            F.col("s_suppkey").alias("cod_fornecedor"),
            F.upper("s_name").alias("razao_social"),
            F.col("n_name").alias("categoria"),
            (F.lit(1) + F.col("s_suppkey") % 21).cast("int").alias("prazo_entrega_dias"),
            F.lit(1).alias("_is_active"),
        )

    def _dim_tempo(self, wanted: set[str]) -> DataFrame:
        return build_calendar(self.spark, FIRST_DAY, LAST_DAY)

    # --- sales ---------------------------------------------------------------
    def _fct_pedidos_venda(self, wanted: set[str]) -> DataFrame:
        key = F.col("o_orderkey")
        day = F.col("o_orderdate").cast("date")
        due = F.date_add(day, (F.lit(10) + key % 20).cast("int"))
        status = (
            F.when(F.col("o_orderstatus") == "F", "ENTREGUE")
            .when(F.col("o_orderstatus") == "O", "PROCESSANDO")
            .when(F.col("o_orderpriority") == "1-URGENT", "CANCELADO")
            .when(F.col("o_orderpriority") == "2-HIGH", "DEVOLVIDO")
            .otherwise("EM_SEPARACAO")
        )
        return self._read("orders").select(
            key.alias("num_pedido"),
            F.col("o_custkey").alias("cod_cliente"),
            day.alias("data_pedido"),
            due.alias("data_entrega_prevista"),
            F.when(
                F.col("o_orderstatus") == "F", F.date_add(due, (key % 5 - 2).cast("int"))
            ).alias("data_entrega_real"),
            status.alias("status"),
            (key % 6).cast("decimal(5,2)").alias("desconto_percentual"),
        )

    def _lines(self, orders: DataFrame | None = None) -> DataFrame:
        raw = self._read("lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER)
        if orders is not None:
            # Before the keep-first exchange: whole orders stay or go.
            keys = orders.select(F.col("num_pedido").alias("l_orderkey"))
            raw = raw.join(keys, "l_orderkey", "left_semi")
        return self._typed(keep_first(raw, ["l_orderkey", "l_linenumber"], LINE_ORDER))

    @staticmethod
    def _typed(lines: DataFrame) -> DataFrame:
        return lines.withColumns(
            {
                "quantidade": F.col("l_quantity").cast("decimal(12,2)"),
                "data_envio": F.col("l_shipdate").cast("date"),
            }
        )

    def lines_of(self, orders: DataFrame, *columns: str) -> DataFrame:
        return self._fct_itens_pedido_venda(set(columns), orders).select(*columns)

    def _fct_itens_pedido_venda(
        self, wanted: set[str], orders: DataFrame | None = None
    ) -> DataFrame:
        gross = F.col("l_extendedprice").cast("decimal(14,2)")
        off = F.col("l_discount").cast("decimal(5,2)")
        return self._lines(orders).select(
            F.col("l_orderkey").alias("num_pedido"),
            F.col("l_linenumber").alias("seq_item"),
            F.col("l_partkey").alias("cod_produto"),
            "quantidade",
            (off * 100).cast("decimal(5,2)").alias("desconto_item_percentual"),
            F.round(gross * (F.lit(1) - off), 2).cast("decimal(14,2)").alias("valor_total_item"),
        )

    # --- stock ---------------------------------------------------------------
    def _with_cost(self, lines: DataFrame) -> DataFrame:
        cost = self._read("part").select(
            F.col("p_partkey").alias("l_partkey"),
            _unit_cost(F.col("p_retailprice")).alias("valor_unitario"),
        )
        return lines.join(cost, "l_partkey", "left")

    @staticmethod
    def _kind_and_quantity() -> dict[str, Column]:
        flag, status, line = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
        kind = (
            F.when(flag == "N", "SAIDA")
            .when(flag == "R", "ENTRADA")
            .when(status == "O", "AJUSTE")
            .when(line % 2 == 0, "TRANSFERENCIA")
            .otherwise("DEVOLUCAO")
        )
        qty = F.when((kind == "AJUSTE") & (line % 2 == 1), -F.col("quantidade")).otherwise(
            F.col("quantidade")
        )
        return {"tipo_mov": kind, "quantidade": qty}

    def movements_as_sent(self) -> DataFrame:
        """All movements with their repeats; ``ordem`` is 1 for the one that counts."""
        keys = ["l_orderkey", "l_linenumber"]
        raw = self._read("lineitem").select(*keys, *LINE_ORDER)
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*LINE_ORDER))
        rows = self._typed(raw.withColumn("ordem", place)).withColumns(self._kind_and_quantity())
        number = F.concat_ws("-", *keys).alias("num_mov")
        return rows.select(number, F.col("l_partkey").alias("cod_produto"), "tipo_mov", "quantidade", "ordem")

    def _fct_movimentacoes_estoque(self, wanted: set[str]) -> DataFrame:
        moves = self._lines()
        if not wanted or wanted & {"valor_unitario", "valor_total_mov"}:
            moves = self._with_cost(moves)
        else:
            moves = moves.withColumn("valor_unitario", F.lit(None).cast("decimal(12,2)"))
        return (
            moves.withColumns(self._kind_and_quantity())
            .withColumns(
                {
                    "qty_sinal": signed_quantity(F.col("tipo_mov"), F.col("quantidade")).cast(
                        "decimal(12,2)"
                    ),
                    "valor_total_mov": line_total(F.abs("quantidade"), F.col("valor_unitario")),
                }
            )
            .select(
                F.concat_ws("-", "l_orderkey", "l_linenumber").alias("num_mov"),
                F.col("data_envio").alias("data_mov"),
                "tipo_mov",
                F.col("l_partkey").alias("cod_produto"),
                "quantidade",
                "qty_sinal",
                "valor_unitario",
                "valor_total_mov",
                F.col("l_orderkey").cast("string").alias("num_documento"),
                F.lit(None).cast("string").alias("observacao"),
            )
        )

    # --- purchases -----------------------------------------------------------
    def _receipts(self) -> DataFrame:
        month = F.date_format("data_envio", "yyyyMM")
        return (
            self._lines()
            .filter(F.col("l_returnflag") == "R")
            .withColumns(
                {
                    "data_oc": F.trunc("data_envio", "month"),
                    "num_oc": F.concat_ws("-", "l_suppkey", month),
                }
            )
        )

    def _fct_pedidos_compra(self, wanted: set[str]) -> DataFrame:
        headers = self._receipts().select("num_oc", "l_suppkey", "data_oc").distinct()
        status = F.element_at(
            F.array(*[F.lit(s) for s in ["CANCELADO", "AGUARDANDO", "PARCIAL", "RECEBIDO"]]),
            ((F.col("l_suppkey") + F.month("data_oc")) % 4 + 1).cast("int"),
        )
        due = F.date_add("data_oc", (F.lit(1) + F.col("l_suppkey") % 21).cast("int"))
        return headers.select(
            "num_oc",
            F.col("l_suppkey").alias("cod_fornecedor"),
            "data_oc",
            due.alias("data_entrega_prevista"),
            F.when(status == "RECEBIDO", due).alias("data_recebimento"),
            status.alias("status"),
        )

    def _fct_itens_pedido_compra(self, wanted: set[str]) -> DataFrame:
        lines = self._with_cost(self._receipts())
        # Unique per order without ranking the lines of a (possibly huge) order.
        number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return lines.select(
            "num_oc",
            number.alias("seq_item"),
            F.col("l_partkey").alias("cod_produto"),
            "quantidade",
            F.col("valor_unitario").alias("custo_unitario"),
            line_total(F.col("quantidade"), F.col("valor_unitario")).alias("valor_total_item"),
        )
