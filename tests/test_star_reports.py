"""Report rules on hand-made star tables, against plain Python."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row

from tulha.operators.calendar import build_calendar
from tulha.plans import api, exercises, forecast, reports, views
from tulha.sources.star import FrameStar

D = Decimal


def month(i):
    return dt.date(2024 + (i - 1) // 12, (i - 1) % 12 + 1, 15)


def make_star(spark, sales, stock=((1, 100),), minimum=10):
    """sales: (order, month index, customer, status, discount, [(product, qty, total)])"""
    orders = [
        Row(num_pedido=o, cod_cliente=c, data_pedido=month(m), data_entrega_prevista=month(m),
            data_entrega_real=None, status=s, desconto_percentual=D(d))
        for o, m, c, s, d, _ in sales
    ]
    lines = [
        Row(num_pedido=o, seq_item=i, cod_produto=p, quantidade=D(q), valor_total_item=D(v))
        for o, _, _, _, _, items in sales
        for i, (p, q, v) in enumerate(items, 1)
    ]
    products = sorted({p for p, _ in stock} | {x.cod_produto for x in lines})
    number = "decimal(14,2)"
    frames = {
        "fct_pedidos_venda": spark.createDataFrame(
            orders, "num_pedido string, cod_cliente string, data_pedido date, data_entrega_prevista "
            f"date, data_entrega_real date, status string, desconto_percentual {number}"),
        "fct_itens_pedido_venda": spark.createDataFrame(
            lines, f"num_pedido string, seq_item long, cod_produto int, quantidade {number}, "
            f"valor_total_item {number}"),
        "dim_clientes": spark.createDataFrame(
            [(c, f"Nome {c}", "S", "UF") for c in ("C1", "C2", "C3")],
            "cod_cliente string, razao_social string, segmento string, estado string"),
        "dim_produtos": spark.createDataFrame(
            [(p, f"Produto {p}", "CAT", "UN", D("2"), D("5"), minimum, 99, 1) for p in products],
            f"cod_produto int, descricao string, categoria string, unidade string, custo_unitario "
            f"{number}, preco_venda {number}, estoque_minimo int, estoque_maximo int, _is_active int"),
        "fct_movimentacoes_estoque": spark.createDataFrame(
            [(f"M{p}", p, month(1), "ENTRADA", D(q), D(q), D(q) * 2) for p, q in stock],
            f"num_mov string, cod_produto int, data_mov date, tipo_mov string, quantidade {number}, "
            f"qty_sinal {number}, valor_total_mov {number}"),
        "dim_tempo": build_calendar(spark),
    }
    return FrameStar(spark, frames)


def python_forecast(qty, ahead):
    n = len(qty)
    if n < 2:
        a, b = float(qty[0]), 0.0
    else:
        xs = range(n)
        sx, sy = sum(xs), sum(qty)
        sxy, sxx = sum(x * y for x, y in zip(xs, qty)), sum(x * x for x in xs)
        slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
        a, b = round((sy - slope * sx) / n, 2), round(slope, 2)
    base = sum(qty[-3:]) / len(qty[-3:])
    rows = []
    for i in range(1, ahead + 1):
        q = max(0, round(base + b * (n + i - 1)))
        rows.append((a, b, round(base, 1), q, max(0, round(q * 0.8)), round(q * 1.2)))
    return rows


@pytest.mark.parametrize(
    "history", [[7], [3, 8], [10, 20, 30, 40], [50, 20, 5, 1], [4, 4, 4], [1, 2, 2, 9, 3, 3, 8]]
)
def test_forecast_matches_plain_python(spark, history):
    sales = [(f"V{i}", i, "C1", "ENTREGUE", 0, [(1, q, 1)]) for i, q in enumerate(history, 1)]
    star = make_star(spark, sales)
    rows = forecast.previsao_demanda(star, 4, cod_produto="1", historico=True).collect()
    found = [
        (r["a"], r["b"], r["media_movel_3m"], r["quantidade_prevista"], r["intervalo_inferior"],
         r["intervalo_superior"])
        for r in rows
    ]
    assert found == python_forecast(history, 4)
    last = month(len(history) + 1)
    assert rows[0]["periodo"] == f"{last:%Y-%m}"
    assert [h["quantidade"] for h in rows[0]["historico"]] == history


def test_forecast_rolls_over_the_year_and_skips_void_orders(spark):
    sales = [("V1", 11, "C1", "ENTREGUE", 0, [(1, 5, 1)]), ("V2", 12, "C1", "CANCELADO", 0, [(1, 9, 1)]),
             ("V3", 12, "C1", "DEVOLVIDO", 0, [(1, 9, 1)])]
    rows = forecast.previsao_demanda(make_star(spark, sales), 3).collect()
    assert [r["periodo"] for r in rows] == ["2024-12", "2025-01", "2025-02"]
    assert {r["a"] for r in rows} == {5.0}


def test_parameter_limits(spark):
    star = make_star(spark, [("V1", 1, "C1", "ENTREGUE", 0, [(1, 5, 1)])])
    for call in (
        lambda: forecast.previsao_demanda(star, 13),
        lambda: forecast.previsao_reposicao(star, "2024-02-01", 7),
        lambda: api.api_vendas_lista(star, limit=501),
    ):
        with pytest.raises(ValueError):
            call()


def test_months_before_rolls_a_missing_day_forward():
    assert forecast.months_before("2024-05-31", 3) == "2024-03-02"
    assert forecast.months_before("2024-02-10", 3) == "2023-11-10"


def test_replenishment(spark):
    sales = [("V1", 1, "C1", "ENTREGUE", 0, [(1, 90, 1)]), ("V2", 5, "C1", "ENTREGUE", 0, [(1, 10, 1), (2, 8, 1)]),
             ("V3", 6, "C1", "ENTREGUE", 0, [(1, 5, 1)])]
    star = make_star(spark, sales, stock=((1, 4), (2, 500)))
    rows = forecast.previsao_reposicao(star, "2024-06-30", 2).collect()
    # Only product 1 is low; January is outside the last three months.
    assert [(r["cod_produto"], r["demanda_media_mensal"], r["qtd_sugerida_compra"], r["custo_estimado"])
            for r in rows] == [(1, 7.5, 11.0, 22.0)]


def test_orders_of_unknown_customers(spark):
    """They leave the customer reports but still count in sales figures and margins."""
    sales = [("V1", 1, "C1", "ENTREGUE", 10, [(1, 2, 100)]), ("V2", 1, "XX", "ENTREGUE", 0, [(1, 1, 50)])]
    star = make_star(spark, sales)
    assert [r["valor_liquido"] for r in views.vw_vendas_consolidadas(star).collect()] == [90.0]
    assert [r["receita_liquida"] for r in reports.vendas_por_periodo(star).collect()] == [90.0]
    assert reports.margem_por_produto(star).first()["receita_bruta"] == 150.0
    assert api.api_kpis_resumo(star).first()["total_pedidos"] == 2


def test_void_orders_leave_each_report_as_defined(spark):
    sales = [("V1", 1, "C1", "DEVOLVIDO", 0, [(1, 2, 100)]), ("V2", 1, "C1", "CANCELADO", 0, [(1, 1, 50)]),
             ("V3", 3, "C1", "ENTREGUE", 0, [(1, 1, 30)]), ("V4", 3, "C2", "ENTREGUE", 0, [])]
    star = make_star(spark, sales)
    assert {r["num_pedido"] for r in views.vw_vendas_consolidadas(star).collect()} == {"V1", "V3"}
    months = [(r["mes"], r["variacao_mom_pct"]) for r in reports.vendas_por_periodo(star).collect()]
    assert months == [(1, None), (3, -70.0)]  # against the previous month present
    assert reports.margem_por_produto(star).first()["receita_bruta"] == 30.0
    listed = {r["num_pedido"]: r["valor_total"] for r in api.api_vendas_lista(star).collect()}
    assert listed == {"V1": 100.0, "V2": 50.0, "V3": 30.0, "V4": None}


def test_abc_limits_include_the_row_itself(spark):
    sales = [(f"V{i}", 1, f"C{i}", "ENTREGUE", 0, [(1, 1, v)]) for i, v in ((1, 80), (2, 15), (3, 5))]
    top = reports.top_clientes(make_star(spark, sales)).collect()
    assert [(r["cod_cliente"], r["classe_abc"], r["share_acumulado_pct"]) for r in top] == [
        ("C1", "A", 80.0), ("C2", "B", 95.0), ("C3", "C", 100.0)]


def test_open_orders_lateness(spark):
    sales = [("V1", 1, "C1", "PROCESSANDO", 0, [(1, 1, 10)]), ("V2", 1, "C1", "ENTREGUE", 0, [(1, 1, 10)])]
    star = make_star(spark, sales)
    late = reports.pedidos_em_aberto(star, "2024-01-16").collect()
    assert [(r["num_pedido"], r["dias_em_aberto"], r["situacao_entrega"]) for r in late] == [("V1", 1, "ATRASADO")]
    assert reports.pedidos_em_aberto(star, "2024-01-15").first()["situacao_entrega"] == "NO_PRAZO"


def test_stock_status_and_products_without_movements(spark):
    star = make_star(spark, [("V1", 1, "C1", "ENTREGUE", 0, [(9, 1, 1)])], stock=((1, 10), (2, 15), (3, 16)))
    status = {r["cod_produto"]: (r["saldo_atual"], r["status_estoque"]) for r in views.vw_estoque_atual(star).collect()}
    assert status == {1: (10.0, "CRITICO"), 2: (15.0, "ALERTA"), 3: (16.0, "OK"), 9: (0.0, "CRITICO")}
    assert api.api_estoque_produto(star.__class__(spark, {**star._frames,
        "fct_movimentacoes_estoque": star._frames["fct_movimentacoes_estoque"].selectExpr(
            "*", "'d' AS num_documento", "'o' AS observacao")}), 77).count() == 0


def test_anomaly_deviation_options(spark):
    values = [10] * 20 + [1000]
    sales = [(f"V{i}", 1, "C1", "ENTREGUE", 0, [(1, 1, v)]) for i, v in enumerate(values)]
    sales.append(("VX", 1, "C1", "CANCELADO", 0, [(1, 1, 90000)]))
    star = make_star(spark, sales)
    import statistics

    z = round(abs(1000 - statistics.mean(values)) / statistics.stdev(values), 2)
    assert [(r["num_pedido"], r["z_score"]) for r in api.api_anomalias(star).collect()] == [("V20", z)]
    assert api.api_anomalias(star, deviation_from="all").count() == 0


def test_histogram_keeps_every_row(spark):
    sales = [(f"V{i}", 1, "C1", "ENTREGUE", d, [(1, 1, 10)]) for i, d in enumerate([0, 1, 2, 5, 11, 11])]
    rows = exercises.x_hist_desconto(make_star(spark, sales)).collect()
    assert [(r["faixa"], r["de"], r["ate"], r["qtd"]) for r in rows] == [
        (1, 1.0, 2.0, 1), (2, 2.0, 3.0, 1), (5, 5.0, 6.0, 1), (10, 10.0, 11.0, 2)]
