"""Data model: entities, tables, keys and the fixed values of the domain."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- Fixed values (must equal the source system's) ---------------------------
NULL_TOKENS = ["", "NULL", "null", "N/A", "NA", "NaN"]
# In this order of preference
DATE_FORMATS = ["%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d", "%d-%m-%Y"]
UNIDADES = ["UN", "CX", "RS", "LI", "KG", "MT", "PC"]
STATUS_VENDA = [
    "PROCESSANDO", "EM_SEPARACAO", "ENTREGUE", "CANCELADO", "AGUARDANDO_APROVACAO", "DEVOLVIDO",
]
STATUS_COMPRA = ["AGUARDANDO", "RECEBIDO", "CANCELADO", "PARCIAL"]
TIPOS_MOVIMENTO = ["ENTRADA", "SAIDA", "TRANSFERENCIA", "AJUSTE", "DEVOLUCAO"]
MAX_NULL_PCT = 0.10
FAIL_NULL_PCT = 0.30
MAX_DUPLICATE_PCT = 0.05
ABC_LIMITS = {"A": "0.80", "B": "0.95"}
ALERT_FACTOR = "1.5"
ANOMALY_Z = 2.5
DUPLICATE_KEY = "DUPLICATE_KEY"
BUSINESS_RULE_VIOLATION = "BUSINESS_RULE_VIOLATION"
NOT_NULL = "NOT_NULL"
MALFORMED_ROW = "MALFORMED_ROW"
# -----------------------------------------------------------------------------

# As read, for the rules; as stored.
EXACT = T.DecimalType(38, 10)
NUMBER = T.DecimalType(18, 4)
VALUE = T.DecimalType(18, 2)

LINEAGE = ["_source_file", "_ingestion_ts", "_pipeline_run_id", "_row_hash"]

_KINDS = {"text": T.StringType(), "date": T.DateType(), "num": NUMBER, "int": T.LongType()}


@dataclass(frozen=True)
class Entity:
    """One source file: its columns with their kinds, its key and its target table."""

    name: str
    table: str
    columns: dict[str, str]
    key: tuple[str, ...]
    required: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    derived: dict[str, T.DataType] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    dedup: bool = True

    @property
    def staging(self) -> str:
        return f"stg_{self.name}"

    def of_kind(self, kind: str) -> list[str]:
        return [c for c, k in self.columns.items() if k == kind]

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(c, _KINDS[k]) for c, k in self.columns.items()]
        fields += [T.StructField(c, t) for c, t in self.derived.items()]
        fields += [
            T.StructField("_dw_loaded_at", T.TimestampType()),
            T.StructField("_is_active", T.IntegerType()),
        ]
        return T.StructType(fields)


def _entity(name: str, table: str, columns: str, **options) -> Entity:
    parsed = dict(part.split(":") for part in columns.split())
    return Entity(name=name, table=table, columns=parsed, **options)


ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in [
        _entity(
            "produtos", "dim_produtos",
            "cod_produto:text descricao:text categoria:text unidade:text custo_unitario:num "
            "preco_venda:num estoque_minimo:int estoque_maximo:int ativo:int "
            "cod_fornecedor_principal:text",
            key=("cod_produto",),
            required=("cod_produto", "descricao", "unidade", "custo_unitario", "preco_venda"),
            not_null=("descricao",),
            derived={"margem_bruta": T.DoubleType()},
            defaults={"estoque_minimo": 0, "estoque_maximo": 0, "ativo": 1},
        ),
        _entity(
            "clientes", "dim_clientes",
            "cod_cliente:text razao_social:text cnpj:text segmento:text cidade:text estado:text "
            "limite_credito:num ativo:int data_cadastro:date",
            key=("cod_cliente",),
            required=("cod_cliente", "razao_social"),
            defaults={"limite_credito": 0, "ativo": 1},
        ),
        _entity(
            "fornecedores", "dim_fornecedores",
            "cod_fornecedor:text razao_social:text cnpj:text categoria:text cidade:text "
            "estado:text prazo_entrega_dias:int ativo:int",
            key=("cod_fornecedor",),
            required=("cod_fornecedor", "razao_social"),
            not_null=("razao_social",),
            defaults={"ativo": 1},
            dedup=False,
        ),
        _entity(
            "pedidos_venda", "fct_pedidos_venda",
            "num_pedido:text cod_cliente:text data_pedido:date data_entrega_prevista:date "
            "data_entrega_real:date status:text desconto_percentual:num observacao:text",
            key=("num_pedido",),
            required=("num_pedido", "cod_cliente", "data_pedido", "status"),
            defaults={"desconto_percentual": 0},
        ),
        _entity(
            "itens_pedido_venda", "fct_itens_pedido_venda",
            "num_pedido:text seq_item:int cod_produto:text quantidade:num preco_unitario:num "
            "desconto_item_percentual:num",
            key=("num_pedido", "seq_item"),
            required=("num_pedido", "seq_item", "cod_produto", "quantidade", "preco_unitario"),
            derived={"valor_total_item": VALUE},
            defaults={"desconto_item_percentual": 0},
        ),
        _entity(
            "pedidos_compra", "fct_pedidos_compra",
            "num_oc:text cod_fornecedor:text data_oc:date data_entrega_prevista:date "
            "data_recebimento:date status:text observacao:text",
            key=("num_oc",),
            required=("num_oc", "cod_fornecedor", "data_oc", "status"),
        ),
        _entity(
            "itens_pedido_compra", "fct_itens_pedido_compra",
            "num_oc:text seq_item:int cod_produto:text quantidade:num custo_unitario:num",
            key=("num_oc", "seq_item"),
            required=("num_oc", "seq_item", "cod_produto", "quantidade", "custo_unitario"),
            derived={"valor_total_item": VALUE},
        ),
        _entity(
            "movimentacoes_estoque", "fct_movimentacoes_estoque",
            "num_mov:text data_mov:date tipo_mov:text cod_produto:text quantidade:num "
            "valor_unitario:num origem:text num_documento:text observacao:text",
            key=("num_mov",),
            required=("num_mov", "data_mov", "tipo_mov", "cod_produto", "quantidade"),
            derived={"qty_sinal": NUMBER, "valor_total_mov": VALUE},
        ),
    ]
}

# child table, column, parent table, parent column
FOREIGN_KEYS = [
    ("fct_pedidos_venda", "cod_cliente", "dim_clientes", "cod_cliente"),
    ("fct_itens_pedido_venda", "num_pedido", "fct_pedidos_venda", "num_pedido"),
    ("fct_itens_pedido_venda", "cod_produto", "dim_produtos", "cod_produto"),
    ("fct_pedidos_compra", "cod_fornecedor", "dim_fornecedores", "cod_fornecedor"),
    ("fct_itens_pedido_compra", "num_oc", "fct_pedidos_compra", "num_oc"),
    ("fct_itens_pedido_compra", "cod_produto", "dim_produtos", "cod_produto"),
    ("fct_movimentacoes_estoque", "cod_produto", "dim_produtos", "cod_produto"),
]

RUN_LOG = T.StructType([
    T.StructField("pipeline_run_id", T.StringType()),
    T.StructField("entity", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("input_rows", T.LongType()),
    T.StructField("valid_rows", T.LongType()),
    T.StructField("rejected_rows", T.LongType()),
    T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("executed_at", T.TimestampType()),
])

REJECT_LOG = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("reject_reason", T.StringType()),
    T.StructField("row_data", T.StringType()),
    T.StructField("pipeline_run", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
])
