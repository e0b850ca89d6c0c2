"""Distinct keys from monthly bitmaps against plain sets."""

import random

import pytest

from tulha.plans.distinct import calendar_windows
from tulha.sinks.bitmaps import MonthlyBitmaps

MONTHS = ["202311", "202312", "202401", "202402", "202404"]


@pytest.fixture
def kept(spark, tmp_path):
    return MonthlyBitmaps(spark, f"file://{tmp_path}/b", "cod_cliente", "string")


def frame(spark, rows):
    return spark.createDataFrame(rows, "mes string, cod_cliente string")


def counts(kept, windows):
    found = kept.count(windows, "n").collect()
    return {(r["nivel"], r["periodo"]): r["n"] for r in found}


def test_windows_equal_sets_after_replaced_months(spark, kept):
    dice = random.Random(5)
    # More keys than a bitmap has places, dealt to months at random.
    first = [(m, f"C{dice.randrange(200_000)}") for m in MONTHS for _ in range(9_000)]
    kept.keep(frame(spark, first))
    second = [("202312", f"C{n}") for n in range(39_990, 40_020)] + [("202404", "C1")] * 3
    for _ in range(2):
        kept.keep(frame(spark, second + [(None, "C7"), ("202404", None)]))
    rows = [r for r in first if r[0] not in ("202312", "202404")] + second
    of = {m: {c for month, c in rows if month == m} for m in MONTHS}
    found = counts(kept, calendar_windows(kept.months()))
    assert {m: found["mes", m] for m in MONTHS} == {m: len(s) for m, s in of.items()}
    assert found["trimestre", "2023T4"] == len(of["202311"] | of["202312"])
    assert found["ano", "2024"] == len(of["202401"] | of["202402"] | of["202404"])
    assert found["ultimos_12_meses", "202403"] == len(set().union(*(of[m] for m in MONTHS[:4])))
    assert ("ultimos_12_meses", "202405") not in found
    numbers = sorted(r["numero"] for r in kept.numbers().collect())
    assert numbers == list(range(1, len({c for _, c in first + second}) + 1))
    assert kept.bits().selectExpr("max(parte)").first()[0] == 2


def test_empty(spark, kept):
    kept.keep(frame(spark, []))
    assert counts(kept, calendar_windows(kept.months())) == {}
