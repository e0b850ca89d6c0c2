"""Business rules as lists of predicates, and the valid / rejected split.

A rule is a name and a Column that is true for a bad row. Adding a rule means
adding a line; the split, the reject reasons and the metrics follow.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tulha.functions.columns import (
    format_cnpj,
    line_total,
    margin_percent,
    not_in,
    only_digits,
    sales_line_total,
    signed_quantity,
)
from tulha.model import (
    BUSINESS_RULE_VIOLATION,
    DUPLICATE_KEY,
    ENTITIES,
    LINEAGE,
    MALFORMED_ROW,
    NOT_NULL,
    NUMBER,
    STATUS_COMPRA,
    STATUS_VENDA,
    TIPOS_MOVIMENTO,
    UNIDADES,
    Entity,
)
from tulha.operators.cleaning import clean
from tulha.operators.dedup import keep_first, mark_duplicates

#: Where a reader puts the text of a row that does not fit its header.
MALFORMED = "_malformed"


class Split(NamedTuple):
    """Every input row is in exactly one side."""

    valid: DataFrame
    rejected: DataFrame


@dataclass(frozen=True)
class RuleSet:
    entity: Entity
    rules: list[tuple[str, Column]] = field(default_factory=list)
    derive: Callable[[DataFrame], DataFrame] = lambda df: df


def _c(name: str) -> Column:
    return F.col(name)


def _not_positive(name: str) -> Column:
    return _c(name).isNull() | (_c(name) <= 0)


def _blank(name: str) -> Column:
    return _c(name).isNull() | (F.trim(_c(name)) == "")


def _ends_before(end: str, start: str) -> Column:
    return _c(end) < _c(start)


def _zero_when_null(*names: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumns({n: F.coalesce(n, F.lit(0)).cast(NUMBER) for n in names})


def rule_sets() -> dict[str, RuleSet]:
    """The rules of each entity. Built on call: columns need a live session."""
    credit = F.coalesce(_c("limite_credito"), F.lit(0))
    sets = [
        RuleSet(
            ENTITIES["produtos"],
            [
                ("custo_nao_positivo", _not_positive("custo_unitario")),
                ("preco_nao_positivo", _not_positive("preco_venda")),
                ("preco_ate_custo", _c("preco_venda") <= _c("custo_unitario")),
                ("unidade_invalida", not_in("unidade", UNIDADES)),
                ("maximo_abaixo_do_minimo", _c("estoque_maximo") < _c("estoque_minimo")),
            ],
            lambda df: df.withColumns(
                {
                    "descricao": F.upper("descricao"),
                    "categoria": F.upper("categoria"),
                    "margem_bruta": margin_percent("custo_unitario", "preco_venda"),
                }
            ),
        ),
        RuleSet(
            ENTITIES["clientes"],
            [
                ("razao_social_ausente", _blank("razao_social")),
                (
                    "cnpj_invalido",
                    _c("cnpj").isNull() | (F.length(only_digits("cnpj")) != 14),
                ),
                ("credito_negativo", credit < 0),
            ],
            lambda df: df.withColumns(
                {
                    "cnpj": format_cnpj("cnpj"),
                    "razao_social": F.upper("razao_social"),
                    "segmento": F.upper("segmento"),
                    "estado": F.upper("estado"),
                    "limite_credito": credit.cast(NUMBER),
                }
            ),
        ),
        RuleSet(ENTITIES["fornecedores"]),
        RuleSet(
            ENTITIES["pedidos_venda"],
            [
                ("cliente_ausente", _c("cod_cliente").isNull()),
                ("status_invalido", not_in("status", STATUS_VENDA)),
                ("desconto_fora_de_0_100", ~_c("desconto_percentual").between(0, 100)),
                ("prevista_antes_do_pedido", _ends_before("data_entrega_prevista", "data_pedido")),
            ],
            _zero_when_null("desconto_percentual"),
        ),
        RuleSet(
            ENTITIES["itens_pedido_venda"],
            [
                ("quantidade_nao_positiva", _not_positive("quantidade")),
                ("preco_nao_positivo", _not_positive("preco_unitario")),
            ],
            lambda df: _zero_when_null("desconto_item_percentual")(df).withColumn(
                "valor_total_item",
                sales_line_total(
                    _c("quantidade"), _c("preco_unitario"), _c("desconto_item_percentual")
                ),
            ),
        ),
        RuleSet(
            ENTITIES["pedidos_compra"],
            [
                ("fornecedor_ausente", _c("cod_fornecedor").isNull()),
                ("status_invalido", not_in("status", STATUS_COMPRA)),
                ("prevista_antes_da_oc", _ends_before("data_entrega_prevista", "data_oc")),
            ],
        ),
        RuleSet(
            ENTITIES["itens_pedido_compra"],
            [
                ("quantidade_nao_positiva", _not_positive("quantidade")),
                ("custo_nao_positivo", _not_positive("custo_unitario")),
            ],
            lambda df: df.withColumn(
                "valor_total_item", line_total(_c("quantidade"), _c("custo_unitario"))
            ),
        ),
        RuleSet(
            ENTITIES["movimentacoes_estoque"],
            [
                ("tipo_invalido", not_in("tipo_mov", TIPOS_MOVIMENTO)),
                ("produto_ausente", _c("cod_produto").isNull()),
                ("valor_nao_positivo", _not_positive("valor_unitario")),
                (
                    "documento_ausente",
                    _c("tipo_mov").isin("ENTRADA", "SAIDA") & _c("num_documento").isNull(),
                ),
                ("data_ausente", _c("data_mov").isNull()),
            ],
            lambda df: df.withColumns(
                {
                    "qty_sinal": signed_quantity(_c("tipo_mov"), _c("quantidade")),
                    "valor_total_mov": line_total(F.abs("quantidade"), _c("valor_unitario")),
                }
            ),
        ),
    ]
    return {s.entity.name: s for s in sets}


def judge(
    raw: DataFrame, name: str, date_mode: str = "per_value", drop_repeats: bool = False
) -> DataFrame:
    """Clean rows of one entity with ``_reject_reason`` (null = valid) and ``_reject_detail``.

    Duplicates are judged first, by key, keeping the first row in source order:
    ``_ord`` when the source carries one, else the row's own content. With
    ``drop_repeats`` the later rows of a key are left out instead of flagged, which
    takes one shuffle less. Rules see numbers as read; stored scale comes after them.
    Rows that the reader marked as malformed are rejected as such and win no key.
    """
    rule_set = rule_sets()[name]
    entity = rule_set.entity
    if "_row_id" not in raw.columns:
        raw = raw.withColumn("_row_id", F.monotonically_increasing_id())
    broken_rows = None
    if MALFORMED in raw.columns:
        broken_rows = raw.filter(F.col(MALFORMED).isNotNull()).drop(MALFORMED)
        raw = raw.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
    rows = clean(raw, entity, date_mode)
    order = ["_ord"] if "_ord" in rows.columns else list(entity.columns)
    if entity.dedup and drop_repeats:
        rows = keep_first(rows, list(entity.key), [*order, "_row_id"])
    if entity.dedup and not drop_repeats:
        rows = mark_duplicates(rows, list(entity.key), order, "_row_id")
    else:
        rows = rows.withColumn("_duplicate", F.lit(False))

    def broken(rules: list[tuple[str, Column]]) -> Column:
        # A comparison with null is not a violation: the row stays on one side.
        return F.array_compact(
            F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(n)) for n, bad in rules])
        )

    numbers = entity.of_kind("num")
    too_large = [
        (f"{n}_fora_da_escala", _c(n).isNotNull() & _c(n).try_cast(NUMBER).isNull())
        for n in numbers
    ]
    required = [(f"{n}_ausente", _c(n).isNull()) for n in entity.not_null]
    nothing = F.array().cast("array<string>")
    violations = broken(rule_set.rules + too_large) if rule_set.rules or too_large else nothing
    absent = broken(required) if required else nothing
    judged = (
        rows.withColumns({"_violations": violations, "_absent": absent})
        .withColumns(
            {
                "_reject_reason": F.when(_c("_duplicate"), DUPLICATE_KEY)
                .when(F.size("_absent") > 0, NOT_NULL)
                .when(F.size("_violations") > 0, BUSINESS_RULE_VIOLATION),
                "_reject_detail": F.when(_c("_duplicate"), F.lit(""))
                .when(F.size("_absent") > 0, F.array_join("_absent", ","))
                .otherwise(F.array_join("_violations", ",")),
            }
        )
        .drop("_violations", "_absent", "_duplicate")
    )
    if broken_rows is not None:
        marks = {"_reject_reason": F.lit(MALFORMED_ROW), "_reject_detail": F.lit("campos")}
        judged = judged.unionByName(clean(broken_rows, entity, date_mode).withColumns(marks))
    return judged.withColumns({n: _c(n).try_cast(NUMBER) for n in numbers}) if numbers else judged


def valid_rows(
    judged: DataFrame, name: str, loaded_at: Column | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Accepted rows in the target's columns, plus any of ``keep`` the rows carry."""
    rule_set = rule_sets()[name]
    good = judged.filter(F.col("_reject_reason").isNull())
    stamped = rule_set.derive(good).withColumns(
        {
            "_dw_loaded_at": loaded_at if loaded_at is not None else F.current_timestamp(),
            "_is_active": F.lit(1),
        }
    )
    extra = [c for c in keep or [] if c in judged.columns]
    return stamped.select(*rule_set.entity.schema.names, *extra)


def accepted(raw: DataFrame, name: str) -> DataFrame:
    """Judged rows of one entity that passed."""
    return judge(raw, name, drop_repeats=True).filter(F.col("_reject_reason").isNull())


def rejected_rows(judged: DataFrame, name: str) -> DataFrame:
    entity = ENTITIES[name]
    kept = [c for c in LINEAGE if c in judged.columns]
    return judged.filter(F.col("_reject_reason").isNotNull()).select(
        *entity.columns, *kept, "_reject_reason", "_reject_detail"
    )


def transform(
    raw: DataFrame, name: str, date_mode: str = "per_value", loaded_at: Column | None = None
) -> Split:
    """Clean one entity and split it; nothing runs until a side is written."""
    judged = judge(raw, name, date_mode)
    return Split(valid_rows(judged, name, loaded_at), rejected_rows(judged, name))


def counts_by_run(judged: DataFrame, name: str) -> DataFrame:
    """Input, valid and rejected rows of one entity per run."""
    bad = F.col("_reject_reason").isNotNull()
    return judged.groupBy("_pipeline_run_id").agg(
        F.lit(name).alias("entity"),
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(~bad).alias("valid_rows"),
        F.count_if(bad).alias("rejected_rows"),
    )


def reject_log(judged: DataFrame, name: str, logged_at: Column) -> DataFrame:
    """Audit rows of the rejected side, the row itself as JSON of its text values."""
    entity = ENTITIES[name]
    values = F.struct(*[F.col(c).cast("string").alias(c) for c in entity.columns])
    run = F.col("_pipeline_run_id") if "_pipeline_run_id" in judged.columns else F.lit("")
    return judged.filter(F.col("_reject_reason").isNotNull()).select(
        F.lit(name).alias("entity"),
        F.col("_reject_reason").alias("reject_reason"),
        F.to_json(values, {"ignoreNullFields": "false"}).alias("row_data"),
        run.alias("pipeline_run"),
        logged_at.alias("logged_at"),
    )
