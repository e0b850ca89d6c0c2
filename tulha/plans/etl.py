"""Registered load queries over the raw extracts: splits, checks, merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tulha.functions.columns import dbl
from tulha.model import ENTITIES, STATUS_VENDA
from tulha.operators.calendar import CALENDAR_COLUMNS, calendar_parts
from tulha.operators.cleaning import clean, standardize_names, unreadable_dates
from tulha.operators.merge import upsert
from tulha.operators.quality import (
    all_orphan_checks, ends_before_start, out_of_domain, out_of_range, predicate_checks, run_checks,
    summary,
)
from tulha.operators.rules import accepted, judge, rejected_rows, valid_rows
from tulha.plans.loading import union_all
from tulha.sources.csv_files import row_hash
from tulha.sources.fixture import read_table
from tulha.sources.raw_fixture import RawFixture
from tulha.sources.star import Star

def decimals_as_double(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({n: dbl(n) for n in names}) if names else df


def etl_valid(raw: RawFixture, name: str) -> DataFrame:
    good = valid_rows(accepted(raw.extract(name), name), name)
    return decimals_as_double(good.drop("_dw_loaded_at", "_is_active"))


def etl_rejected(raw: RawFixture, name: str) -> DataFrame:
    return decimals_as_double(rejected_rows(judge(raw.extract(name), name), name))


def dates_by_vote(raw: RawFixture, name: str) -> DataFrame:
    """Outcome counts when each date column gets one format by vote."""
    judged = judge(raw.extract(name), name, date_mode="column_vote")
    outcome = F.coalesce("_reject_reason", F.lit("VALID"))
    return judged.groupBy(
        outcome.alias("resultado"), F.col("_reject_detail").alias("detalhe")
    ).agg(F.count(F.lit(1)).alias("qtd"))


# --- checks ------------------------------------------------------------------
def dq_checks(raw: RawFixture) -> DataFrame:
    """The standard battery over raw extracts, and over documents with their labels."""
    documents = read_table(raw.spark, raw.folder, "documents")
    labels = read_table(raw.spark, raw.folder, "labels")
    labelled = documents.join(labels, "doc_id", "left")
    batteries = [run_checks(raw.extract(n), n, ENTITIES[n].required) for n in ENTITIES]
    batteries.append(run_checks(labelled, "documentos", ("doc_id", "text", "lang")))
    return union_all(batteries)


def dq_resumo(raw: RawFixture) -> DataFrame:
    return summary(dq_checks(raw))


def dq_integridade_validos(raw: RawFixture) -> DataFrame:
    """References between accepted rows: a rejected parent leaves orphans."""
    by_table = {e.table: n for n, e in ENTITIES.items()}

    def passed(table: str, *columns: str) -> DataFrame:
        name = by_table[table]
        return accepted(raw.extract(name), name).select(*columns)

    return all_orphan_checks(passed)


def dq_predicados(raw: RawFixture) -> DataFrame:
    """Range, domain and date-order checks over cleaned rows."""
    orders = clean(raw.extract("pedidos_venda"), ENTITIES["pedidos_venda"])
    products = clean(raw.extract("produtos"), ENTITIES["produtos"])
    day = F.col("data_pedido")
    return union_all(
        [
            predicate_checks(
                orders,
                "pedidos_venda",
                {
                    "desconto_faixa": out_of_range(F.col("desconto_percentual"), 0, 100),
                    "status_dominio": out_of_domain(F.col("status"), STATUS_VENDA),
                    "prevista_antes_do_pedido": ends_before_start(
                        day, F.col("data_entrega_prevista")
                    ),
                    "real_antes_do_pedido": ends_before_start(day, F.col("data_entrega_real")),
                },
            ),
            predicate_checks(
                products,
                "produtos",
                {
                    "estoque_minimo_faixa": out_of_range(F.col("estoque_minimo"), low=0),
                    "ativo_dominio": out_of_domain(F.col("ativo"), [0, 1]),
                },
            ),
        ]
    )


def dq_datas_ilegiveis(raw: RawFixture) -> DataFrame:
    """Dates present but unreadable, per date column."""
    names = ["clientes", "pedidos_venda", "pedidos_compra", "movimentacoes_estoque"]
    return union_all(
        [
            unreadable_dates(raw.extract(n), ENTITIES[n]).select(
                F.lit(n).alias("entidade"), "coluna", "preenchidas", "ilegiveis"
            )
            for n in names
        ]
    )


# --- other operators ---------------------------------------------------------
def src_row_hash(raw: RawFixture) -> DataFrame:
    columns = list(ENTITIES["pedidos_venda"].columns)
    rows = raw.extract("pedidos_venda")
    return rows.select("num_pedido", row_hash(columns).alias("_row_hash"))


def src_nomes_produtos(raw: RawFixture) -> DataFrame:
    """Products under untidy column names, brought to the standard ones."""
    columns = list(ENTITIES["produtos"].columns)
    rows = raw.extract("produtos").select(*columns)
    untidy = rows.toDF(*[f" {c.replace('_', '  ').title()}! " for c in columns])
    return standardize_names(untidy)


def upsert_clientes(star: Star, orders: DataFrame) -> DataFrame:
    """Customers after merging a batch with several rows per key, known and new keys."""
    batch = orders.filter("o_orderstatus = 'P'").select(
        (F.col("o_custkey") * 2).alias("cod_cliente"),
        F.concat(F.lit("PEDIDO "), F.col("o_orderkey").cast("string")).alias("razao_social"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("limite_credito"),
        "o_orderdate",
        "o_orderkey",
    )
    target = star.table("dim_clientes").select(
        "cod_cliente", "razao_social", "segmento", "estado", "limite_credito", "_is_active"
    )
    latest = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    merged = upsert(target, batch, ["cod_cliente"], latest, {"_is_active": 1})
    return decimals_as_double(merged)


def verificacao_carga(star: Star) -> DataFrame:
    """Row counts of the tables every load must fill."""
    names = ["dim_produtos", "dim_clientes", "fct_pedidos_venda", "fct_movimentacoes_estoque"]
    keys = ["cod_produto", "cod_cliente", "num_pedido", "num_mov"]
    return union_all(
        [
            star.table(n, k).agg(F.lit(n).alias("tabela"), F.count(F.lit(1)).alias("registros"))
            for n, k in zip(names, keys)
        ]
    )


def calendario_pedidos(star: Star) -> DataFrame:
    """Calendar attributes and number of orders of every day with orders."""
    days = (
        star.table("fct_pedidos_venda", "data_pedido")
        .groupBy(F.col("data_pedido").alias("data"))
        .agg(F.count(F.lit(1)).alias("pedidos"))
    )
    return days.withColumns(calendar_parts(F.col("data"))).select(*CALENDAR_COLUMNS, "pedidos")


def x_fk_reject(raw: RawFixture) -> DataFrame:
    """Accepted sales lines of products that were rejected, summed per product."""
    lines = accepted(raw.extract("itens_pedido_venda"), "itens_pedido_venda")
    products = accepted(raw.extract("produtos"), "produtos")
    value = F.round(F.col("quantidade") * F.col("preco_unitario"), 2)
    per_product = (
        lines.groupBy("cod_produto")
        .agg(F.count(F.lit(1)).alias("linhas"), dbl(F.sum(value)).alias("valor"))
    )
    return per_product.join(products.select("cod_produto"), "cod_produto", "left_anti").orderBy("cod_produto")
