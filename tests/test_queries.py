"""Every registered query against its SQL oracle, and the shape of its plan."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from tulha import registry
from tulha.session import tune

ORACLE = entry.oracle_sql()
QUERIES = {name: entry.queries()[name] for name in registry.queries()}
# Written by their own actions; nothing is left to see in the plan.
ACTIONS = {
    "st_ingestao_pedidos", "st_saldo_produto", "st_saldo_repetidos", "st_itens_orfaos", "carga_fornecedores", "carga_log", "carga_metadados",
    "carga_rejeitos_csv",
}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    if name not in ACTIONS:
        plan = df._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"):
            assert word not in plan, word
    assert differences(df, con, ORACLE[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "ranking" and df.count() > 0


def plan_of(spark, folder, name):
    tune(spark)
    return QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_the_columns_they_need(spark, folder):
    plan = plan_of(spark, folder, "x_top5_clientes_pedidos")
    assert "ReadSchema: struct<o_custkey:bigint>" in plan
    assert "TakeOrderedAndProject" in plan


def test_page_of_orders_reduces_the_lines_before_the_shuffle(spark, folder):
    """The semi-join with the page runs below the keep-first exchange."""
    df = QUERIES["api_vendas_lista"](spark, folder)
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {}
    for line in plan:
        for word in ("Window [", "Join LeftSemi"):
            if word in line:
                depth.setdefault(word, []).append(len(line) - len(line.lstrip(" :+-")))
    assert max(depth["Join LeftSemi"]) > min(depth["Window ["])
