"""Cleaning, duplicates, running totals, merge, checks: against brute force."""

import datetime as dt
import itertools
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tulha.functions.columns import half_even, half_up, parse_date, parse_integer, parse_number
from tulha.operators.calendar import build_calendar
from tulha.operators.cleaning import null_tokens, standard_name, trim_text
from tulha.operators.dedup import keep_first, mark_duplicates
from tulha.operators.merge import upsert
from tulha.operators.quality import (
    ends_before_start, orphan_checks, out_of_domain, out_of_range, run_checks, summary,
)
from tulha.operators.running import running_total


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, expression, kind="string"):
    rows = column(spark, values, kind).select("i", expression.alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_dates(spark):
    texts = ["2024-01-09", "09/01/2024", "2024/01/09", "09-01-2024", "9/1/2024", "2024-13-01",
             "31/02/2024", "2024-01-09 10:00", " 2024-01-09", "09.01.2024", "00/00/0000", "", None]
    day = dt.date(2024, 1, 9)
    assert apply(spark, texts, parse_date("v")) == [day] * 5 + [None] * 8


def test_numbers(spark):
    texts = ["1.5", "1,5", " 7 ", "1e3", "abc", "1.234,56", "1d", "NaN", None]
    found = apply(spark, texts, parse_number("v").cast("double"))
    assert found == [1.5, 1.5, 7.0, 1000.0, None, None, None, None, None]
    assert apply(spark, ["7", "1.5", "x", None], parse_integer("v")) == [7, None, None, None]


def test_rounding(spark):
    values = [2.5, 0.125, 1.005, -2.5]
    assert apply(spark, values, half_up("v", 0), "double") == [3, 0, 1, -3]
    assert apply(spark, values, half_up("v", 2), "double") == [2.5, 0.13, 1.01, -2.5]
    assert apply(spark, values, half_even("v", 2), "double") == [2.5, 0.12, 1.0, -2.5]


def test_names_tokens_and_blanks(spark):
    assert standard_name("  Data da Venda (R$) ") == "data_da_venda_r"
    df = column(spark, ["", "NULL", "null", "N/A", "NA", "NaN", "Null", " x\t"])
    kept = [r["v"] for r in trim_text(null_tokens(df)).orderBy("i").collect()]
    assert kept == [None] * 6 + ["Null", "x"]


def test_calendar(spark):
    rows = {r["data"]: r for r in build_calendar(spark).collect()}
    assert len(rows) == 731
    day = rows[dt.date(2024, 12, 30)]
    assert (day["data_key"], day["semestre"], day["trimestre"], day["semana_ano"]) == (20241230, 2, 4, 1)
    assert (day["dia_semana"], day["nome_dia"], day["is_fim_semana"]) == (1, "Monday", 0)
    assert rows[dt.date(2024, 6, 30)]["is_fim_semana"] == 1


def test_duplicates_with_a_hot_key(spark):
    rng = random.Random(7)
    rows = [(1 if rng.random() < 0.4 else rng.choice([None, *range(2, 200)]), rng.randrange(50), i)
            for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, o int, id int").repartition(6)
    expected = {}
    for k, o, i in rows:
        expected[k] = min(expected.get(k, (o, i)), (o, i))
    winners = {(k, *v) for k, v in expected.items()}
    assert {tuple(r) for r in keep_first(df, ["k"], ["o", "id"]).collect()} == winners
    marked = mark_duplicates(df, ["k"], ["o"], "id").collect()
    assert len(marked) == len(rows)
    assert {(r["k"], r["o"], r["id"]) for r in marked if not r["_duplicate"]} == winners


def test_keep_first_prunes_before_the_shuffle(spark):
    plan = keep_first(column(spark, ["a", "b"]), ["v"], ["i"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60))
def test_running_total(spark, values):
    df = column(spark, values, "int").repartition(5)
    rows = running_total(df, "v", [F.desc("v"), F.asc("i")]).orderBy("_position").collect()
    ordered = sorted(enumerate(values), key=lambda p: (-p[1], p[0]))
    assert [r["i"] for r in rows] == [i for i, _ in ordered]
    assert [r["_running"] for r in rows] == list(itertools.accumulate(v for _, v in ordered))
    assert {r["_total"] for r in rows} == {sum(values)}
    assert [r["_position"] for r in rows] == list(range(1, len(values) + 1))


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, t string, n int")
    source = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, None, 1)], "k int, t string, o int")
    merged = upsert(target, source, ["k"], [F.desc("o")], {"n": 9})
    assert sorted(map(tuple, merged.collect()), key=str) == [(1, "a", 5), (2, "y", 9), (3, None, 9)]


def checks_of(spark, rows, schema, required=()):
    df = spark.createDataFrame(rows, schema)
    return {r["check_name"]: r for r in run_checks(df, "t", required).collect()}


SCHEMA = "cod string, nome string, valor double, _source_file string"
ROWS = [("a", "x", 1.0, "f"), ("b", "y", 2.0, "f"), ("c", "z", 3.0, "f")]


def test_clean_table_passes(spark):
    found = checks_of(spark, ROWS, SCHEMA, ("cod", "nome"))
    assert {r["status"] for r in found.values()} == {"PASS"}
    assert set(found) == {"required_columns", "null_check:cod", "null_check:nome",
                          "null_check:valor", "duplicate_rows"}


def test_missing_column_nulls_and_repeats(spark):
    rows = [("a", "x", None, "f"), ("a", "x", None, "f"), ("c", "z", 3.0, "f")]
    found = checks_of(spark, rows, SCHEMA, ("cod", "falta"))
    assert (found["required_columns"]["status"], found["required_columns"]["failed_rows"]) == ("FAIL", 1)
    assert (found["null_check:valor"]["status"], found["null_check:valor"]["detail"]) == ("FAIL", "66.7% null")
    assert (found["duplicate_rows"]["failed_rows"], found["duplicate_rows"]["status"]) == (1, "FAIL")


@pytest.mark.parametrize("nulls, status", [(10, "PASS"), (11, "WARN"), (29, "WARN"), (30, "FAIL")])
def test_null_limits(spark, nulls, status):
    rows = [(str(i), None if i < nulls else "x", 1.0, "f") for i in range(100)]
    assert checks_of(spark, rows, SCHEMA)["null_check:nome"]["status"] == status


def test_summary(spark):
    df = spark.createDataFrame([("a", None)] * 3, "k string, n string")
    rows = {r["entity"]: r for r in summary(run_checks(df, "t")).collect()}
    assert (rows["t"]["linhas"], rows["t"]["overall"], rows["TOTAL"]["failed"]) == (3, "FAIL", 2)


def test_row_predicates(spark):
    values = [1, 5, 10, -1, 200, None]
    assert apply(spark, values, out_of_range(F.col("v"), 0, 100), "int") == [False] * 3 + [True, True, False]
    texts = ["UN", "CX", "QQ", None]
    assert apply(spark, texts, out_of_domain(F.col("v"), ["UN", "CX"])) == [False, False, True, True]
    day = F.lit("2024-01-02").cast("date")
    dates = ["2024-01-01", "2024-01-02", None]
    assert apply(spark, dates, ends_before_start(day, F.col("v").cast("date"))) == [True, False, False]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (7,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    row = orphan_checks(child, "filha", [("fk", parent, "pk")]).first()
    assert (row["failed_rows"], row["total_rows"], row["status"]) == (1, 4, "FAIL")
