"""Raw ERP extracts as text, rendered from TPC-H-like tables.

Each entity comes out as an ERP would send it: every column text, mixed date
formats, decimal commas, null tokens, stray blanks and rule-breaking rows. The
marks are functions of the keys, so the share of bad rows is the same at every
scale. ``_pipeline_run_id`` is the month of the row: one load per month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tulha.model import ENTITIES
from tulha.operators.cleaning import null_tokens
from tulha.sources.fixture import LINE_ORDER, read_table

FIRST_RUN = "RUN_199501"
#: Extracts without a join or a distinct, which would not keep an order.
ONE_TO_ONE = ["pedidos_venda", "itens_pedido_venda", "itens_pedido_compra", "movimentacoes_estoque"]


def _text(c: Column | str, kind: str = "string") -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(kind).cast("string")


def _money(c: Column | str) -> Column:
    return _text(c, "decimal(14,2)")


def _comma(c: Column) -> Column:
    return F.replace(c, F.lit("."), F.lit(","))


def _day(c: Column, key: Column) -> Column:
    """A date in one of four formats, chosen by the key."""
    return (
        F.when(key % 4 == 0, F.date_format(c, "dd/MM/yyyy"))
        .when(key % 4 == 1, F.date_format(c, "yyyy/MM/dd"))
        .when(key % 4 == 2, F.date_format(c, "dd-MM-yyyy"))
        .otherwise(F.date_format(c, "yyyy-MM-dd"))
    )


def _run(c: Column) -> Column:
    return F.concat(F.lit("RUN_"), F.date_format(c, "yyyyMM"))


def _physical_id() -> Column:
    """Unique place of a Parquet row, the same in every scan."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )


class RawFixture:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.folder = sf_dir

    def extract(self, name: str) -> DataFrame:
        """Text rows of one entity with run id and row id, null tokens applied."""
        rows = getattr(self, f"_{name}")()
        columns = list(ENTITIES[name].columns)
        return null_tokens(rows.select(*columns, "_pipeline_run_id", "_row_id", "_ord"), columns)

    def in_order(self, name: str) -> DataFrame:
        """The extract in the order of ``_ord``. Where each row comes from one row of a table,
        the table is sorted, whose rows are narrower than their text."""
        if name not in ONE_TO_ONE:
            return self.extract(name).orderBy("_ord")
        return _SortedFixture(self.spark, self.folder).extract(name)

    def _read(self, name: str) -> DataFrame:
        """A table with row ids, and with the order that decides which repeat is first."""
        table = read_table(self.spark, self.folder, name)
        order = F.struct(*LINE_ORDER) if name == "lineitem" else _physical_id()
        return table.select("*", _physical_id().alias("_row_id"), order.alias("_ord"))

    def _nations(self) -> DataFrame:
        # 25 nations at every scale factor.
        nation = read_table(self.spark, self.folder, "nation")
        return F.broadcast(nation.select("n_nationkey", "n_name"))

    def _produtos(self) -> DataFrame:
        k, size = F.col("p_partkey"), F.col("p_size")
        price = F.col("p_retailprice").cast("decimal(12,2)")
        cost = F.round(price * F.lit(0.6).cast("decimal(2,1)"), 2).cast("decimal(12,2)")
        units = F.array(*[F.lit(u) for u in ["UN", "CX", "RS", "LI", "KG", "MT", "PC"]])
        return self._read("part").select(
            F.concat(F.lit("PRD"), _text(k)).alias("cod_produto"),
            F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("descricao"),
            F.lower("p_type").alias("categoria"),
            F.when(k % 40 == 7, "DZ")
            .otherwise(F.element_at(units, (k % 7 + 1).cast("int")))
            .alias("unidade"),
            F.when(k % 31 == 3, "0")
            .when(k % 37 == 5, "N/A")
            .when(k % 43 == 9, _money(price + 1))
            .when(k % 59 == 11, "0.00004")
            .otherwise(_comma(_money(cost)))
            .alias("custo_unitario"),
            _money(price).alias("preco_venda"),
            F.when(k % 53 == 0, "NULL").otherwise(_text(size)).alias("estoque_minimo"),
            F.when(k % 41 == 0, _text(size - 1)).otherwise(_text(size * 10)).alias("estoque_maximo"),
            F.lit("1").alias("ativo"),
            F.concat(F.lit("FOR"), _text(k % 100)).alias("cod_fornecedor_principal"),
            F.lit(FIRST_RUN).alias("_pipeline_run_id"),
            "_row_id",
            "_ord",
        )

    def _clientes(self) -> DataFrame:
        k = F.col("c_custkey")
        digits = F.lpad(_text(k * 7919), 14, "0")
        spaced = F.concat_ws(
            "",
            F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 3), F.lit("."),
            F.substring(digits, 6, 3), F.lit("/"), F.substring(digits, 9, 4), F.lit("-"),
            F.substring(digits, 13, 2),
        )
        since = F.date_add(F.lit("1995-01-01").cast("date"), (k % 1000).cast("int"))
        customers = self._read("customer").join(
            self._nations(), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        return customers.select(
            F.concat(F.lit("CLI"), _text(k)).alias("cod_cliente"),
            F.when(k % 61 == 0, "  ").otherwise(F.lower("c_name")).alias("razao_social"),
            F.when(k % 47 == 0, "NULL")
            .when(k % 43 == 0, F.substring(digits, 1, 13))
            .when(k % 2 == 0, spaced)
            .otherwise(digits)
            .alias("cnpj"),
            F.lower("c_mktsegment").alias("segmento"),
            F.col("n_name").alias("cidade"),
            F.lower("n_name").alias("estado"),
            F.when(k % 29 == 0, "NA").otherwise(_money("c_acctbal")).alias("limite_credito"),
            F.lit("1").alias("ativo"),
            _day(since, k).alias("data_cadastro"),
            F.lit(FIRST_RUN).alias("_pipeline_run_id"),
            "_row_id",
            "_ord",
        )

    def _fornecedores(self) -> DataFrame:
        k = F.col("s_suppkey")
        suppliers = self._read("supplier").join(
            self._nations(), F.col("s_nationkey") == F.col("n_nationkey"), "left"
        )
        return suppliers.select(
            F.concat(F.lit("FOR"), _text(k)).alias("cod_fornecedor"),
            F.when(k % 33 == 5, "NaN").otherwise(F.col("s_name")).alias("razao_social"),
            F.lpad(_text(k * 7907), 14, "0").alias("cnpj"),
            F.lit("Geral").alias("categoria"),
            F.col("n_name").alias("cidade"),
            F.col("n_name").alias("estado"),
            F.when(k % 17 == 0, "1.5")
            .when(k % 19 == 0, F.concat(_text(k % 21 + 1), F.lit(".0")))
            .otherwise(_text(k % 21 + 1))
            .alias("prazo_entrega_dias"),
            F.lit("1").alias("ativo"),
            F.lit(FIRST_RUN).alias("_pipeline_run_id"),
            "_row_id",
            "_ord",
        )

    def _pedidos_venda(self) -> DataFrame:
        k, status = F.col("o_orderkey"), F.col("o_orderstatus")
        day = F.col("o_orderdate").cast("date")
        due = F.date_add(day, (k % 20 - 1).cast("int"))
        return self._read("orders").select(
            F.concat(F.lit("PV"), _text(k)).alias("num_pedido"),
            F.when(k % 89 == 0, "N/A")
            .otherwise(F.concat(F.lit("CLI"), _text("o_custkey")))
            .alias("cod_cliente"),
            F.when(k % 211 == 0, "sem data").otherwise(_day(day, k)).alias("data_pedido"),
            _day(due, k + 1).alias("data_entrega_prevista"),
            F.when(status == "F", _day(F.date_add(due, 2), k + 2)).alias("data_entrega_real"),
            F.when(status == "F", "ENTREGUE")
            .when(status == "O", " PROCESSANDO ")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "PENDENTE")
            .otherwise("EM_SEPARACAO")
            .alias("status"),
            F.when(k % 97 == 0, "150")
            .when(k % 13 == 0, "null")
            .otherwise(_comma(_text((k % 6) * F.lit(0.5).cast("decimal(2,1)"), "decimal(5,1)")))
            .alias("desconto_percentual"),
            F.col("o_orderpriority").alias("observacao"),
            _run(day).alias("_pipeline_run_id"),
            "_row_id",
            "_ord",
        )

    def _itens_pedido_venda(self) -> DataFrame:
        part = F.col("l_partkey")
        price = _money("l_extendedprice")
        percent = (F.col("l_discount").cast("decimal(5,2)") * 100).cast("decimal(5,1)")
        return self._read("lineitem").select(
            F.concat(F.lit("PV"), _text("l_orderkey")).alias("num_pedido"),
            _text("l_linenumber").alias("seq_item"),
            F.concat(F.lit("PRD"), _text(part)).alias("cod_produto"),
            F.when(part % 101 == 0, "0").otherwise(_text("l_quantity", "int")).alias("quantidade"),
            F.when(part % 97 == 1, F.concat(F.lit("-"), price)).otherwise(_comma(price))
            .alias("preco_unitario"),
            F.when(percent == 0, "N/A").otherwise(_text(percent)).alias("desconto_item_percentual"),
            _run(F.col("l_shipdate")).alias("_pipeline_run_id"),
            "_row_id",
            "_ord",
        )

    def _pedidos_compra(self) -> DataFrame:
        month = F.date_format("l_shipdate", "yyyyMM")
        k = F.col("l_suppkey")
        day = F.trunc(F.col("l_shipdate").cast("date"), "month")
        headers = (
            self._read("lineitem")
            .filter(F.col("l_returnflag") == "R")
            .select("l_suppkey", day.alias("_day"), month.alias("_month"))
            .distinct()
        )
        mark = k + F.month("_day")
        number = F.concat(F.lit("OC"), _text(k), F.lit("-"), F.col("_month"))
        due = F.date_add("_day", (k % 21 - 1).cast("int"))
        return headers.select(
            number.alias("num_oc"),
            F.when(mark % 71 == 0, "NA")
            .otherwise(F.concat(F.lit("FOR"), _text(k)))
            .alias("cod_fornecedor"),
            _day(F.col("_day"), mark).alias("data_oc"),
            _day(due, k).alias("data_entrega_prevista"),
            F.when(mark % 4 == 3, _day(due, k + 1)).alias("data_recebimento"),
            F.when(mark % 4 == 0, "CANCELADO")
            .when(mark % 4 == 1, "AGUARDANDO")
            .when(mark % 37 == 2, "ABERTO")
            .when(mark % 4 == 2, "PARCIAL")
            .otherwise("RECEBIDO")
            .alias("status"),
            F.lit("").alias("observacao"),
            _run(F.col("_day")).alias("_pipeline_run_id"),
            F.struct(number.alias("num_oc")).alias("_row_id"),
            number.alias("_ord"),
        )

    def _itens_pedido_compra(self) -> DataFrame:
        part = F.col("l_partkey")
        month = F.date_format("l_shipdate", "yyyyMM")
        return self._read("lineitem").filter(F.col("l_returnflag") == "R").select(
            F.concat(F.lit("OC"), _text("l_suppkey"), F.lit("-"), month).alias("num_oc"),
            _text(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq_item"),
            F.concat(F.lit("PRD"), _text(part)).alias("cod_produto"),
            _comma(_text("l_quantity", "decimal(12,1)")).alias("quantidade"),
            F.when(part % 103 == 0, "-1").otherwise(_money("l_extendedprice"))
            .alias("custo_unitario"),
            _run(F.col("l_shipdate")).alias("_pipeline_run_id"),
            "_row_id",
            "_ord",
        )

    def _movimentacoes_estoque(self) -> DataFrame:
        flag, part, line = F.col("l_returnflag"), F.col("l_partkey"), F.col("l_linenumber")
        order = F.col("l_orderkey")
        kind = (
            F.when(part % 107 == 0, "PERDA")
            .when(flag == "N", "SAIDA")
            .when(flag == "R", "ENTRADA")
            .when(F.col("l_linestatus") == "O", "AJUSTE")
            .when(line % 2 == 0, "TRANSFERENCIA")
            .otherwise("DEVOLUCAO")
        )
        day = F.col("l_shipdate").cast("date")
        return self._read("lineitem").select(
            F.concat_ws("-", F.lit("MOV"), _text(order), _text(line)).alias("num_mov"),
            F.when(order % 113 == 0, "00/00/0000").otherwise(_day(day, order)).alias("data_mov"),
            kind.alias("tipo_mov"),
            F.when(part % 109 == 0, "").otherwise(F.concat(F.lit("PRD"), _text(part)))
            .alias("cod_produto"),
            F.when((flag == "A") & (line % 2 == 1), F.concat(F.lit("-"), _text("l_quantity", "int")))
            .otherwise(_text("l_quantity", "int"))
            .alias("quantidade"),
            _comma(_money("l_extendedprice")).alias("valor_unitario"),
            F.when(flag == "R", "COMPRA").otherwise("VENDA").alias("origem"),
            F.when(order % 127 == 0, "null").otherwise(_text(order)).alias("num_documento"),
            F.lit("").alias("observacao"),
            _run(day).alias("_pipeline_run_id"),
            "_row_id",
            "_ord",
        )


class _SortedFixture(RawFixture):
    def _read(self, name: str) -> DataFrame:
        return super()._read(name).orderBy("_ord")
