"""Sources, sinks, loads and streams on small files."""

import csv
import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from test_rules import BASE
from tulha.loader import check_landing, check_loaded, load_all
from tulha.model import ENTITIES
from tulha.operators.rules import judge
from tulha.plans import reports
from tulha.sinks.warehouse import Warehouse, by_hash, ensure_tables
from tulha.sources.csv_files import ExtractError, extract, preview, read_csv
from tulha.sources.landing import list_files, missing_files
from tulha.sources.star import catalog_star, register_views, run_sql
from tulha.streaming.ingest import BALANCE, ingest, keep_balance

PEDIDOS = ENTITIES["pedidos_venda"]


def write_csv(path, name, rows):
    columns = list(ENTITIES[name].columns)
    with open(path, "w", newline="") as file:
        out = csv.writer(file)
        out.writerow(columns)
        for change in rows:
            row = {**BASE[name], **change}
            out.writerow(["" if row[c] is None else row[c] for c in columns])


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    rows = {
        "produtos": [{}, dict(cod_produto="P2", preco_venda="1")],
        "pedidos_venda": [{}, {}, dict(num_pedido="V2", cod_cliente="C9", data_pedido="02/04/2024",
                                       data_entrega_prevista=None)],
        "itens_pedido_venda": [{}, dict(num_pedido="V2")],
        "fornecedores": [{}, dict(razao_social="Fabrica Nova")],
    }
    for name in ENTITIES:
        write_csv(folder / f"{name}.csv", name, rows.get(name, [{}]))
    return folder


def paths(landing):
    return {n: str(landing / f"{n}.csv") for n in ENTITIES}


def test_read_csv_lineage_and_null_tokens(spark, landing):
    with open(landing / "produtos.csv", "a") as file:
        file.write('P3,Tela 24" larga,N/A,UN,1,2,,NULL,1,F1\n')
    rows = {r["cod_produto"]: r for r in read_csv(spark, str(landing / "produtos.csv"), (), "r1").collect()}
    odd = rows["P3"]
    assert odd["descricao"] == 'Tela 24" larga' and odd["categoria"] is None
    assert odd["estoque_minimo"] is None and odd["estoque_maximo"] is None
    assert (odd["_source_file"], odd["_pipeline_run_id"]) == ("produtos.csv", "r1")
    again = read_csv(spark, str(landing / "produtos.csv"), (), "r2").collect()
    assert {r["_row_hash"] for r in again} == {r["_row_hash"] for r in rows.values()}
    assert preview(spark, str(landing / "produtos.csv"), 2).count() == 2


def csv_text(*lines):
    return "\n".join([",".join(ENTITIES["fornecedores"].columns), *lines]) + "\n"


def test_quoted_fields_and_malformed_rows(spark, tmp_path):
    path = tmp_path / "fornecedores.csv"
    path.write_text(csv_text(
        'F1,"Monitor 24"" HD",1,"a, ""b""",x,y,3,1', "F2,tem campo,demais,1,x,y,3,1,9", "F3,falta,1",
        'F4,"duas\nlinhas",1,g,x,y,5.0,1',
    ))
    rows = read_csv(spark, str(path), multi_line=True)
    found = {r["cod_fornecedor"]: r for r in rows.collect()}
    assert found["F1"]["razao_social"] == 'Monitor 24" HD' and found["F1"]["categoria"] == 'a, "b"'
    assert found["F4"]["razao_social"] == "duas\nlinhas"
    assert {k for k, r in found.items() if r["_malformed"]} == {"F2", "F3"}
    judged = {r["cod_fornecedor"]: r for r in judge(rows, "fornecedores").collect()}
    assert {k: r["_reject_reason"] for k, r in judged.items()} == {
        "F1": None, "F2": "MALFORMED_ROW", "F3": "MALFORMED_ROW", "F4": None}
    assert judged["F4"]["prazo_entrega_dias"] == 5


def test_malformed_row_wins_no_key(spark, tmp_path):
    path = tmp_path / "clientes.csv"
    write_csv(path, "clientes", [{}])
    good = path.read_text().splitlines()
    path.write_text("\n".join([good[0], good[1] + ",x", good[1]]) + "\n")
    reasons = [r["_reject_reason"] for r in judge(read_csv(spark, str(path)), "clientes").collect()]
    assert sorted(reasons, key=str) == ["MALFORMED_ROW", None]


def test_extract_errors(spark, landing, tmp_path):
    entity = ENTITIES["produtos"]
    with pytest.raises(ExtractError, match="not found"):
        extract(spark, str(tmp_path / "nada.csv"), entity)
    write_csv(landing / "produtos.csv", "produtos", [])
    with pytest.raises(ExtractError, match="empty"):
        extract(spark, str(landing / "produtos.csv"), entity)
    (landing / "produtos.csv").write_text("cod_produto,descricao\n1,x\n")
    with pytest.raises(ExtractError, match="unidade"):
        extract(spark, str(landing / "produtos.csv"), entity)


def test_landing_checks(spark, landing):
    check_landing(spark, str(landing))
    (landing / "vazio.csv").write_text("")
    found = {tuple(r) for r in missing_files(spark, str(landing), ["vazio.csv", "outro.csv", "produtos.csv"]).collect()}
    assert found == {("vazio.csv", "vazio"), ("outro.csv", "ausente")}
    listed = {r["arquivo"]: r["tamanho_bytes"] for r in list_files(spark, str(landing)).collect()}
    assert len(listed) == 9 and listed["vazio.csv"] == 0 and listed["produtos.csv"] > 0


def test_load_all(spark, landing, tmp_path):
    root = str(tmp_path / "wh")
    sources = paths(landing)
    sources["clientes"] = str(landing / "nao_existe.csv")
    result = load_all(spark, sources, root, "r1")
    assert result.status == "PARTIAL" and len(result.errors) == 1
    sources["clientes"] = str(landing / "clientes.csv")
    result = load_all(spark, sources, root, "r2")
    assert result.status == "SUCCESS"
    assert (result.total("input"), result.total("valid"), result.total("rejected")) == (13, 11, 2)
    warehouse = Warehouse(spark, root)
    check_loaded(warehouse)
    # A second load of the same files changes no key; the later supplier row wins.
    assert warehouse.table("fct_pedidos_venda").count() == 2
    assert [r["razao_social"] for r in warehouse.table("dim_fornecedores").collect()] == ["Fabrica Nova"]
    assert warehouse.read("stg_produtos", ENTITIES["produtos"].raw_schema).count() == 2
    runs = warehouse.run_log()
    assert runs.count() == 16 and runs.filter("status = 'EXTRACT_ERROR'").count() == 1
    rejects = {(r["entity"], r["reject_reason"], r["pipeline_run"]) for r in warehouse.reject_log().collect()}
    assert rejects == {(e, m, r) for r in ("r1", "r2") for e, m in
                       [("produtos", "BUSINESS_RULE_VIOLATION"), ("pedidos_venda", "DUPLICATE_KEY")]}
    folder = f"{root}/rejected/produtos_rejected_r2"
    assert spark.read.option("header", True).csv(folder).first()["cod_produto"] == "P2"
    checks = spark.read.parquet(f"{root}/dq_resultados/batch=r2-referencias")
    orphans = {r["check_name"] for r in checks.filter("entity = 'fct_pedidos_venda' and failed_rows > 0").collect()}
    assert orphans == {"foreign_key:cod_cliente"}
    star = warehouse.star()
    assert star.table("dim_tempo").count() == 731
    top = reports.top_clientes(star).collect()
    assert [(r["ranking"], r["cod_cliente"], r["receita_total"], r["classe_abc"]) for r in top] == [(1, "C1", 50.0, "C")]
    register_views(star, ["dim_produtos"])
    query = "SELECT count(*) AS n FROM dim_produtos WHERE preco_venda > :low"
    assert run_sql(spark, query, low=20).first()["n"] == 1


def orders(spark, *rows):
    data = [(k, "C1", d, None, None, "ENTREGUE", None, note, None, 1) for k, d, note in rows]
    return spark.createDataFrame(data, PEDIDOS.schema)


def files_by_part(spark, root):
    """Part -> its files, to tell rewritten parts from others."""
    rows = spark.read.parquet(f"{root}/{PEDIDOS.table}").select("_part", F.input_file_name().alias("f"))
    found = {}
    for r in rows.distinct().collect():
        found.setdefault(str(r["_part"]), set()).add(r["f"])
    return found


def test_upsert_rewrites_only_touched_parts(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    jan, feb, mar = dt.date(2024, 1, 5), dt.date(2024, 2, 5), dt.date(2024, 3, 5)
    latest = [F.col("num_pedido")]
    first = orders(spark, ("A", jan, "1"), ("B", feb, "1"), ("C", feb, "1"), ("D", None, "1"))
    warehouse.upsert_entity(first, PEDIDOS, latest)
    before = files_by_part(spark, tmp_path)
    assert set(before) == {"202401", "202402", "sem_data"}
    # B moves to March; A's part must stay as it is. Again: nothing changes.
    for _ in range(2):
        warehouse.upsert_entity(orders(spark, ("B", mar, "2")), PEDIDOS, latest)
        after = files_by_part(spark, tmp_path)
        assert after["202401"] == before["202401"] and after["202402"] != before["202402"]
        rows = {r["num_pedido"]: (r["data_pedido"], r["observacao"]) for r in warehouse.table(PEDIDOS.table).collect()}
        assert rows == {"A": (jan, "1"), "B": (mar, "2"), "C": (feb, "1"), "D": (None, "1")}
    # The only row of a part moves away: the part disappears.
    warehouse.upsert_entity(orders(spark, ("A", mar, "3")), PEDIDOS, latest)
    assert "202401" not in files_by_part(spark, tmp_path)
    assert warehouse.table(PEDIDOS.table).count() == 4


def test_failed_write_leaves_old_rows(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    latest = [F.col("num_pedido")]
    warehouse.upsert_entity(orders(spark, ("A", None, "1")), PEDIDOS, latest)
    bad = orders(spark, ("A", None, "2")).withColumn("observacao", F.raise_error(F.lit("morto")).cast("string"))
    with pytest.raises(Exception, match="morto"):
        warehouse._write(bad, PEDIDOS.table)
    assert [r["observacao"] for r in warehouse.table(PEDIDOS.table).collect()] == ["1"]


def test_only_a_missing_path_is_an_empty_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.table(PEDIDOS.table).count() == 0
    with pytest.raises(Exception, match="semesquema"):
        Warehouse(spark, "semesquema://x").table(PEDIDOS.table).count()


def test_hash_parts_are_a_table_property(spark, tmp_path):
    parts = {PEDIDOS.table: by_hash("num_pedido", 2)}
    warehouse = Warehouse(spark, str(tmp_path), parts)
    rows = [(f"V{k}", None, "1") for k in range(30)]
    warehouse.upsert_entity(orders(spark, *rows), PEDIDOS, [F.col("num_pedido")])
    assert set(files_by_part(spark, tmp_path)) == {"0", "1"} and warehouse.table(PEDIDOS.table).count() == 30


def test_replace_and_append(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    old, new = spark.range(5), spark.range(2)
    warehouse.replace(old, "t")
    warehouse.replace(new.filter("id > 9"), "t")
    assert warehouse.read("t", old.schema).count() == 5  # empty input keeps the old rows
    warehouse.replace(new, "t")
    assert warehouse.read("t", old.schema).count() == 2
    warehouse.replace(new.filter("id > 9"), "t", keep_when_empty=False)
    assert warehouse.read("t", old.schema).count() == 0
    for batch in ("a", "b", "b"):
        warehouse.append(new, "log", batch)
    assert warehouse.appended("log", new.schema).count() == 4
    assert warehouse.appended("none", new.schema).count() == 0


def test_catalog_tables(spark):
    for _ in range(2):
        ensure_tables(spark, "tulha_test")
    names = {t.name for t in spark.catalog.listTables("tulha_test")}
    assert {"dim_produtos", "fct_movimentacoes_estoque", "log_etl_execucoes", "dim_tempo"} <= names
    assert {e.staging for e in ENTITIES.values()} <= names
    star = catalog_star(spark, ["dim_produtos"], "tulha_test")
    assert star.table("dim_produtos", "cod_produto").count() == 0
    spark.sql("DROP DATABASE tulha_test CASCADE")


def test_stream_loads_each_file_once(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    args = (str(landing), "pedidos_venda", str(tmp_path / "wh"), str(tmp_path / "cp"), 1)
    write_csv(landing / "a.csv", "pedidos_venda", [{}, dict(num_pedido="V2", status="RUIM")])
    write_csv(landing / "b.csv", "pedidos_venda", [dict(num_pedido="V3"), dict(num_pedido="V3")])
    ingest(spark, *args).awaitTermination()
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    loaded = {r["num_pedido"]: r["status"] for r in warehouse.table(PEDIDOS.table).collect()}
    assert loaded == {"V1": "ENTREGUE", "V3": "ENTREGUE"}
    assert {r["reject_reason"] for r in warehouse.reject_log().collect()} == {"BUSINESS_RULE_VIOLATION", "DUPLICATE_KEY"}
    # A file that lands later replaces the row of its key; older files are not read again.
    write_csv(landing / "c.csv", "pedidos_venda", [dict(status="CANCELADO")])
    ingest(spark, *args).awaitTermination()
    loaded = {r["num_pedido"]: r["status"] for r in warehouse.table(PEDIDOS.table).collect()}
    assert loaded == {"V1": "CANCELADO", "V3": "ENTREGUE"}
    assert warehouse.reject_log().count() == 2


def test_two_streams_into_one_warehouse(spark, tmp_path):
    root = str(tmp_path / "wh")
    for k in (1, 2, 1):  # the third run has nothing new
        landing = tmp_path / f"in{k}"
        landing.mkdir(exist_ok=True)
        name = f"V{k}"
        write_csv(landing / "a.csv", "pedidos_venda", [dict(num_pedido=name), dict(num_pedido=name)])
        ingest(spark, str(landing), "pedidos_venda", root, str(tmp_path / f"cp{k}")).awaitTermination()
    warehouse = Warehouse(spark, root)
    assert {r["num_pedido"] for r in warehouse.table(PEDIDOS.table).collect()} == {"V1", "V2"}
    log = warehouse.reject_log().collect()
    assert len(log) == 2 and len({r["pipeline_run"] for r in log}) == 2


def test_stream_checks_the_header(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    columns = list(ENTITIES["clientes"].columns)
    columns[:2] = columns[1::-1]
    (landing / "a.csv").write_text(",".join(columns) + "\n" + "Empresa,C1" + "," * (len(columns) - 2) + "\n")
    stream = ingest(spark, str(landing), "clientes", str(tmp_path / "wh"), str(tmp_path / "cp"))
    with pytest.raises(StreamingQueryException):
        stream.awaitTermination()


def test_numbers_are_judged_as_read(spark, tmp_path):
    path = tmp_path / "produtos.csv"
    rows = [dict(cod_produto="A", custo_unitario="0.00004"), dict(cod_produto="B", custo_unitario="-0.00004"),
            dict(cod_produto="C", preco_venda="123456789012345678"), dict(cod_produto="D", estoque_minimo="5.0")]
    write_csv(path, "produtos", rows)
    found = {r["cod_produto"]: r for r in judge(read_csv(spark, str(path)), "produtos").collect()}
    assert {k: r["_reject_detail"] for k, r in found.items()} == {
        "A": "", "B": "custo_nao_positivo", "C": "preco_venda_fora_da_escala", "D": ""}
    assert found["D"]["estoque_minimo"] == 5 and found["A"]["custo_unitario"] == 0


def test_stream_balance(spark, tmp_path):
    source = tmp_path / "in"
    schema = "cod_produto long, tipo_mov string, quantidade double"
    run = lambda: keep_balance(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source)),
        str(tmp_path / "wh"), str(tmp_path / "cp"),
    ).awaitTermination()
    first = [(1, "ENTRADA", 10.0), (1, "SAIDA", 3.0), (2, "AJUSTE", -4.0)]
    spark.createDataFrame(first, schema).write.parquet(str(source))
    run()
    spark.createDataFrame([(1, "DEVOLUCAO", 2.0)], schema).write.mode("append").parquet(str(source))
    run()
    table = Warehouse(spark, str(tmp_path / "wh")).read("saldo_corrente", BALANCE)
    assert {(r["cod_produto"], float(r["saldo_atual"]), r["movimentos"]) for r in table.collect()} == {(1, 5.0, 3), (2, -4.0, 1)}
