"""Wall time of the registered queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma-separated names, default: the headline set) steer the run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "vw_estoque_atual", "vw_vendas_consolidadas", "vw_compras_consolidadas",
    "estoque_atual", "pedidos_em_aberto", "produtos_abaixo_minimo", "vendas_por_periodo",
    "top_clientes", "giro_estoque", "margem_por_produto",
    "api_vendas_lista", "api_kpis_resumo", "api_margem", "api_anomalias",
    "previsao_demanda", "previsao_reposicao",
    "dash_kpis", "dash_receita_mensal", "dash_abc", "dash_fornecedores",
    "etl_itens_pedido_venda_validos", "etl_itens_pedido_venda_rejeitados",
    "dq_checks", "dq_integridade", "upsert_clientes", "st_saldo_produto",
    "api_execucoes", "api_rejeicoes", "dash_historico", "dash_execucoes_recentes",
    "dash_rejeitados", "dash_rejeicoes_motivo", "dash_qualidade_kpis", "dash_taxa_ultima_execucao",
    "entity_report",
]


def main() -> None:
    from tulha import registry
    from tulha.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    shared = f"file://{tempfile.mkdtemp(prefix='bench-')}"
    conf = {"spark.checkpoint.dir": shared}
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", **conf)
    queries = registry.queries()
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("vw_vendas_consolidadas")  # warm the JVM and the file cache
    times = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total wall time of the queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
