"""Every query by name, over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tulha.model import ENTITIES
from tulha.operators.quality import referential_checks
from tulha.plans import (
    api, cataloged, dashboard, distinct, etl, exercises, forecast, incremental, landed, loading, reports,
    streams, views,
)
from tulha.session import tune
from tulha.sinks.catalog import VIEWS
from tulha.sources.fixture import AS_OF, FixtureStar, read_table
from tulha.sources.raw_fixture import RawFixture

Query = Callable[[SparkSession, str], DataFrame]


def _on_star(plan: Callable[..., DataFrame], **parameters: object) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(FixtureStar(tune(spark), sf_dir), **parameters)

    return run


def _star_queries() -> dict[str, Query]:
    plain = [
        *[getattr(views, n) for n in ("vw_estoque_atual", "vw_vendas_consolidadas",
                                      "vw_compras_consolidadas")],
        *[getattr(reports, n) for n in reports.__all__ if n != "pedidos_em_aberto"],
        api.api_estoque, api.api_estoque_criticos, api.api_estoque_resumo, api.api_vendas_lista,
        api.api_kpis_resumo, api.api_kpis_status, api.api_kpis_top5, api.api_vendas_periodo,
        api.api_margem, api.api_anomalias, forecast.previsao_demanda,
        dashboard.dash_kpis, dashboard.dash_receita_mensal, dashboard.dash_receita_segmento,
        dashboard.dash_estoque_top20, dashboard.dash_status_estoque,
        dashboard.dash_valor_categoria, dashboard.dash_abc, dashboard.dash_margem_produto,
        dashboard.dash_margem_categoria, dashboard.dash_status_pedidos, dashboard.dash_compras,
        dashboard.dash_fornecedores, dashboard.dash_status_oc,
        exercises.x_produtos_categoria, exercises.x_top5_clientes_pedidos,
        exercises.x_receita_mes, exercises.x_mais_vendidos_abaixo_minimo,
        exercises.x_hist_desconto, exercises.x_receita_por_item_genero,
        exercises.x_valor_total_estoque, exercises.x_margem_topn,
    ]
    return {
        **{plan.__name__: _on_star(plan) for plan in plain},
        "pedidos_em_aberto": _on_star(reports.pedidos_em_aberto, as_of=AS_OF),
        "api_estoque_filtrado": _on_star(api.api_estoque, status="ok", categoria="ECONOMY"),
        "api_estoque_produto": _on_star(api.api_estoque_produto, cod_produto=42),
        "api_vendas_lista_status": _on_star(api.api_vendas_lista, status="entregue", limit=500),
        "api_anomalias_media_geral": _on_star(api.api_anomalias, deviation_from="all"),
        "previsao_reposicao": _on_star(forecast.previsao_reposicao, as_of=AS_OF),
        "previsao_reposicao_total": _on_star(forecast.previsao_reposicao_total, as_of=AS_OF),
        "x_segmento_credito": _on_star(exercises.x_segmento_credito, segmento="machinery"),
    }


def _on_raw(plan: Callable[..., DataFrame], *arguments: object) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(RawFixture(tune(spark), sf_dir), *arguments)

    return run


def _on_runs(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_raw(lambda raw: plan(loading.StoredLog(raw).runs()))


def _on_rejects(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_raw(lambda raw: plan(loading.StoredLog(raw).rejects()))


def _quality_kpis(raw: RawFixture) -> DataFrame:
    log = loading.StoredLog(raw)
    return loading.dash_qualidade_kpis(log.runs(), log.rejects())


def _merged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = FixtureStar(tune(spark), sf_dir)
    return etl.upsert_clientes(star, read_table(spark, sf_dir, "orders"))


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def _load_queries() -> dict[str, Query]:
    runs = [
        loading.api_execucoes, loading.dash_historico, loading.dash_execucoes_recentes,
        loading.api_rejeicoes, loading.entity_report, loading.dash_taxa_ultima_execucao,
    ]
    rejects = [loading.dash_rejeitados, loading.dash_rejeicoes_motivo, loading.rejeicoes_por_valor]
    checks = [
        etl.dq_checks, etl.dq_resumo, etl.dq_integridade_validos, etl.dq_predicados,
        etl.dq_datas_ilegiveis, etl.src_row_hash, etl.x_fk_reject,
        etl.src_nomes_produtos,
    ]
    return {
        **{f"etl_{n}_validos": _on_raw(etl.etl_valid, n) for n in ENTITIES},
        **{f"etl_{n}_rejeitados": _on_raw(etl.etl_rejected, n) for n in ENTITIES},
        **{plan.__name__: _on_runs(plan) for plan in runs},
        **{plan.__name__: _on_rejects(plan) for plan in rejects},
        **{plan.__name__: _on_raw(plan) for plan in checks},
        "dash_qualidade_kpis": _on_raw(_quality_kpis),
        "etl_movimentacoes_voto": _on_raw(etl.dates_by_vote, "movimentacoes_estoque"),
        "dq_integridade": _on_star(referential_checks),
        "verificacao_carga": _on_star(etl.verificacao_carga),
        "calendario_pedidos": _on_star(etl.calendario_pedidos),
        "upsert_clientes": _merged_customers,
        **{
            plan.__name__: _tuned(plan)
            for plan in (
                landed.src_csv_clientes, landed.carga_fornecedores, landed.carga_log,
                landed.carga_metadados, landed.carga_rejeitos_csv,
            )
        },
        **{f"cat_{view}": _tuned(cataloged.view_by_name(view)) for view in VIEWS},
        **{
            f"inc_{view}": _tuned(incremental.kept_view(view))
            for view in ("vw_estoque_atual", "vw_vendas_consolidadas")
        },
        "clientes_unicos_periodos": _tuned(distinct.clientes_unicos_periodos),
        "st_ingestao_pedidos": _tuned(streams.st_ingestao_pedidos),
        **{
            plan.__name__: _tuned(plan)
            for plan in (streams.st_saldo_produto, streams.st_saldo_repetidos, streams.st_itens_orfaos)
        },
    }


def queries() -> dict[str, Query]:
    return {**_star_queries(), **_load_queries()}
