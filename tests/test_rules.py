"""Row rules, one case per behaviour, on tiny frames."""

import datetime as dt
from decimal import Decimal

import pytest

from tulha.model import ENTITIES
from tulha.operators.rules import counts_by_run, judge, transform

BASE = {
    "produtos": dict(
        cod_produto="P1", descricao="cabo hdmi", categoria="acessorios", unidade="UN",
        custo_unitario="10.00", preco_venda="25.00", estoque_minimo="5", estoque_maximo="50",
        ativo="1", cod_fornecedor_principal="F1",
    ),
    "clientes": dict(
        cod_cliente="C1", razao_social="loja azul", cnpj="11.222.333/0001-44", segmento="varejo",
        cidade="Recife", estado="pe", limite_credito="900.50", ativo="1",
        data_cadastro="2024-02-03",
    ),
    "fornecedores": dict(
        cod_fornecedor="F1", razao_social="Fabrica", cnpj="1", categoria="x", cidade="y",
        estado="z", prazo_entrega_dias="7", ativo="1",
    ),
    "pedidos_venda": dict(
        num_pedido="V1", cod_cliente="C1", data_pedido="2024-03-01",
        data_entrega_prevista="2024-03-09", data_entrega_real=None, status="ENTREGUE",
        desconto_percentual=None, observacao=None,
    ),
    "itens_pedido_venda": dict(
        num_pedido="V1", seq_item="1", cod_produto="P1", quantidade="2", preco_unitario="25",
        desconto_item_percentual="0",
    ),
    "pedidos_compra": dict(
        num_oc="O1", cod_fornecedor="F1", data_oc="2024-03-01",
        data_entrega_prevista="2024-03-09", data_recebimento=None, status="RECEBIDO",
        observacao=None,
    ),
    "itens_pedido_compra": dict(
        num_oc="O1", seq_item="1", cod_produto="P1", quantidade="4", custo_unitario="10.255",
    ),
    "movimentacoes_estoque": dict(
        num_mov="M1", data_mov="2024-03-01", tipo_mov="ENTRADA", cod_produto="P1",
        quantidade="10", valor_unitario="3.00", origem="COMPRA", num_documento="O1",
        observacao=None,
    ),
}


def split(spark, name, *changes, **options):
    rows = [{**BASE[name], **c} for c in (changes or ({},))]
    columns = list(ENTITIES[name].columns)
    raw = spark.createDataFrame([[r[c] for c in columns] for r in rows], ENTITIES[name].raw_schema)
    sides = transform(raw.coalesce(1), name, **options)
    return [r.asDict() for r in sides.valid.collect()], [r.asDict() for r in sides.rejected.collect()]


@pytest.mark.parametrize("name", list(BASE))
def test_good_row_is_kept(spark, name):
    valid, rejected = split(spark, name)
    assert len(valid) == 1 and rejected == []
    assert valid[0]["_is_active"] == 1 and valid[0]["_dw_loaded_at"] is not None


BROKEN = [
    ("produtos", dict(custo_unitario="-10"), "custo_nao_positivo"),
    ("produtos", dict(custo_unitario=None), "custo_nao_positivo"),
    ("produtos", dict(preco_venda="0"), "preco_nao_positivo,preco_ate_custo"),
    ("produtos", dict(preco_venda="9"), "preco_ate_custo"),
    ("produtos", dict(unidade="ZZ"), "unidade_invalida"),
    ("produtos", dict(unidade=None), "unidade_invalida"),
    ("produtos", dict(estoque_maximo="4"), "maximo_abaixo_do_minimo"),
    ("clientes", dict(razao_social="   "), "razao_social_ausente"),
    ("clientes", dict(razao_social=None), "razao_social_ausente"),
    ("clientes", dict(cnpj=None), "cnpj_invalido"),
    ("clientes", dict(cnpj="11.222.333/0001-4"), "cnpj_invalido"),
    ("clientes", dict(limite_credito="-0,01"), "credito_negativo"),
    ("pedidos_venda", dict(cod_cliente=None), "cliente_ausente"),
    ("pedidos_venda", dict(status="NOVO"), "status_invalido"),
    ("pedidos_venda", dict(desconto_percentual="100.5"), "desconto_fora_de_0_100"),
    ("pedidos_venda", dict(desconto_percentual="-1"), "desconto_fora_de_0_100"),
    ("pedidos_venda", dict(data_entrega_prevista="2024-02-28"), "prevista_antes_do_pedido"),
    ("itens_pedido_venda", dict(quantidade="0"), "quantidade_nao_positiva"),
    ("itens_pedido_venda", dict(preco_unitario="-50"), "preco_nao_positivo"),
    ("pedidos_compra", dict(cod_fornecedor=None), "fornecedor_ausente"),
    ("pedidos_compra", dict(status="ENTREGUE"), "status_invalido"),
    ("pedidos_compra", dict(data_entrega_prevista="2024-02-28"), "prevista_antes_da_oc"),
    ("itens_pedido_compra", dict(custo_unitario="abc"), "custo_nao_positivo"),
    ("movimentacoes_estoque", dict(tipo_mov="OUTRO"), "tipo_invalido"),
    ("movimentacoes_estoque", dict(cod_produto=None), "produto_ausente"),
    ("movimentacoes_estoque", dict(valor_unitario="0"), "valor_nao_positivo"),
    ("movimentacoes_estoque", dict(tipo_mov="SAIDA", num_documento=None), "documento_ausente"),
    ("movimentacoes_estoque", dict(data_mov="ontem"), "data_ausente"),
]


@pytest.mark.parametrize("name", sorted({b[0] for b in BROKEN}))
def test_broken_rows_are_rejected_with_the_rule(spark, name):
    key = ENTITIES[name].key[0]
    cases = [(c, d) for n, c, d in BROKEN if n == name]
    rows = [{**change, key: f"K{i}"} for i, (change, _) in enumerate(cases)]
    valid, rejected = split(spark, name, *rows)
    assert valid == []
    found = {r[key]: (r["_reject_reason"], r["_reject_detail"]) for r in rejected}
    for i, (_, detail) in enumerate(cases):
        assert found[f"K{i}"] == ("BUSINESS_RULE_VIOLATION", detail)


def test_missing_required_text_is_not_null(spark):
    for name, column in [("produtos", "descricao"), ("fornecedores", "razao_social")]:
        valid, rejected = split(spark, name, {column: None})
        assert valid == [] and rejected[0]["_reject_reason"] == "NOT_NULL"


def test_product_text_margin_and_null_limits(spark):
    valid, _ = split(spark, "produtos", dict(estoque_minimo=None, estoque_maximo="7"))
    assert valid[0]["descricao"] == "CABO HDMI" and valid[0]["categoria"] == "ACESSORIOS"
    assert valid[0]["margem_bruta"] == 60.0  # a null limit breaks no rule


def test_customer_cnpj_credit_and_text(spark):
    valid, _ = split(spark, "clientes", dict(cnpj="11222333000144", limite_credito=None))
    row = valid[0]
    assert row["cnpj"] == "11.222.333/0001-44" and row["limite_credito"] == 0
    assert (row["razao_social"], row["segmento"], row["estado"]) == ("LOJA AZUL", "VAREJO", "PE")


def test_line_totals(spark):
    valid, _ = split(
        spark, "itens_pedido_venda",
        dict(quantidade="3", preco_unitario="100", desconto_item_percentual="10"),
    )
    assert valid[0]["valor_total_item"] == Decimal("270.00")
    valid, _ = split(spark, "itens_pedido_compra")
    assert valid[0]["valor_total_item"] == Decimal("41.02")


@pytest.mark.parametrize(
    "kind, qty, signed",
    [("ENTRADA", "10", 10), ("SAIDA", "10", -10), ("SAIDA", "-10", -10), ("AJUSTE", "-20", -20),
     ("TRANSFERENCIA", "3", -3), ("DEVOLUCAO", "3", -3)],
)
def test_signed_quantity(spark, kind, qty, signed):
    valid, _ = split(spark, "movimentacoes_estoque", dict(tipo_mov=kind, quantidade=qty))
    assert valid[0]["qty_sinal"] == signed
    assert valid[0]["valor_total_mov"] == abs(signed) * 3


def test_adjustment_needs_no_document(spark):
    valid, _ = split(spark, "movimentacoes_estoque", dict(tipo_mov="AJUSTE", num_documento=None))
    assert len(valid) == 1


def test_dates_per_value_and_by_vote(spark):
    rows = [dict(num_mov=f"M{i}") for i in range(5)] + [dict(num_mov="M9", data_mov="01/05/2024")]
    valid, rejected = split(spark, "movimentacoes_estoque", *rows)
    assert rejected == []
    assert [r["data_mov"] for r in valid if r["num_mov"] == "M9"] == [dt.date(2024, 5, 1)]
    valid, rejected = split(spark, "movimentacoes_estoque", *rows, date_mode="column_vote")
    assert len(valid) == 5 and rejected[0]["_reject_detail"] == "data_ausente"


def test_vote_wipes_a_half_empty_column(spark):
    rows = [dict(num_pedido="V1", data_entrega_real="2024-03-05"), dict(num_pedido="V2")]
    valid, _ = split(spark, "pedidos_venda", *rows, date_mode="column_vote")
    assert {r["data_entrega_real"] for r in valid} == {None}
    valid, _ = split(spark, "pedidos_venda", *rows)
    assert {r["data_entrega_real"] for r in valid} == {None, dt.date(2024, 3, 5)}


def test_first_of_a_key_is_kept_even_when_it_breaks_a_rule(spark):
    rows = [dict(custo_unitario="0"), dict(descricao="segundo"), dict(cod_produto="P2")]
    valid, rejected = split(spark, "produtos", *rows)
    assert [r["cod_produto"] for r in valid] == ["P2"]
    reasons = sorted(r["_reject_reason"] for r in rejected)
    assert reasons == ["BUSINESS_RULE_VIOLATION", "DUPLICATE_KEY"]


def test_every_row_lands_on_one_side(spark, folder):
    from tulha.sources.raw_fixture import RawFixture

    raw = RawFixture(spark, folder)
    for name in ("itens_pedido_venda", "produtos"):
        rows = raw.extract(name)
        counts = counts_by_run(judge(rows, name), name).groupBy().sum().first()
        assert counts[0] == rows.count() == counts[1] + counts[2]


def test_omitted_columns_take_defaults_but_nulls_stay(spark):
    columns = [c for c in ENTITIES["produtos"].columns if c not in ("ativo", "estoque_minimo")]
    row = {**BASE["produtos"], "estoque_maximo": None}
    raw = spark.createDataFrame([[row[c] for c in columns]], ", ".join(f"{c} string" for c in columns))
    found = transform(raw.coalesce(1), "produtos").valid.first()
    assert (found["ativo"], found["estoque_minimo"], found["estoque_maximo"]) == (1, 0, None)


def test_source_names_are_standardised(spark):
    names = [f" {c.replace('_', ' ').upper()} " for c in ENTITIES["fornecedores"].columns]
    raw = spark.createDataFrame([list(BASE["fornecedores"].values())], names)
    assert transform(raw.coalesce(1), "fornecedores").valid.first()["razao_social"] == "Fabrica"

