"""Periodic runs against brute force over all starts and periods; odd rows; long texts."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tulha.llm import periodic, queries
from tulha.llm.common import table


def brute(words):
    """Every stretch with period q that cannot grow, whose smallest period is q."""
    found = []
    for q in range(1, len(words) // 3 + 1):
        equal = [a == b for a, b in zip(words, words[q:])] + [False]
        begin = 0
        for k, same in enumerate(equal):
            if not same:
                length = k - begin + q
                if k > begin and length >= max(24, 3 * q):
                    part = words[begin : begin + length]
                    if not any(part[d:] == part[:-d] for d in range(1, q)):
                        found.append((begin, length, q))
                begin = k + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, change=True):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if change and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def same(found, rows, change=True):
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str(expected(*r, change)) for r in rows)


def test_whole_table(spark, folder):
    rows = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    same(queries.op12_periodic_runs(spark, folder), rows)


def made(draw):
    """Loops with odd ends, loops inside loops, loops side by side, few different words."""
    words = []
    while len(words) < draw.choice([0, 3, 30, 90, 200]):
        unit = [draw.choice("abc") for _ in range(draw.choice([1, 1, 2, 3, 5, 9]))]
        unit = unit * draw.choice([1, 1, 4, 13]) + [draw.choice("abcd")] * draw.choice([0, 0, 1])
        words += unit * draw.choice([1, 2, 3, 5])
    return words


def test_random_loops():
    draw = random.Random(7)
    texts = [made(draw) for _ in range(700)] + [["a"] * 24, ["a"] * 23, ["a", "b"] * 12, list("abcdefgh") * 3, [], ["x"]]
    found = periodic.runs_of_texts([[w.encode() for w in t] for t in texts])
    assert found == [brute(t) for t in texts]
    assert sum(map(len, found)) > 500


def test_sorted_suffixes():
    draw = random.Random(8)
    words = np.array([draw.randrange(2) for _ in range(300)] + [-1] + [draw.randrange(2) for _ in range(200)] + [-2])
    order, begins = periodic.sorted_suffixes(words, 4)
    plain = words.tolist()
    starts = [tuple(plain[k : k + 4]) for k in range(len(plain))]
    want = sorted((k for k in range(len(plain)) if starts.count(starts[k]) > 1), key=lambda k: plain[k:])
    assert order.tolist() == want
    assert begins.tolist() == [not k or starts[a] != starts[b] for k, (a, b) in enumerate(zip([0, *want], want))]


def test_positions():
    draw = random.Random(9)
    values = draw.sample(range(10**6), 9000)
    held = periodic.Positions(values[0])
    inside = [values[0]]
    for value in values[1:]:
        before, after = held.add(value)
        inside = sorted([*inside, value])
        at = inside.index(value)
        assert before == (inside[at - 1] if at else None)
        assert after == (inside[at + 1] if at + 1 < len(inside) else None)
    assert list(held) == inside


ODD = [
    (1, None), (2, ""), (3, " \t\x0b "), (None, "ab " * 30), (None, None), (4, "x"), (5, "a\x0bb\n" * 20),
    (5, "a\x0bb\n" * 20), (6, "É é " * 30), (7, "w " * 3000), (8, "w " * 1000 + "v " * 1000),
]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_rows(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, start int, words string")
    same(periodic.report(df), rows, change=False)


def test_very_long_texts():
    """A million times one word, and a long loop of different words."""
    began = time.time()
    loop = [str(k).encode() for k in range(100_000)] * 4
    found = periodic.runs_of_texts([[b"a"] * 1_000_000, loop])
    assert found == [[(0, 1_000_000, 1)], [(0, 400_000, 100_000)]]
    assert time.time() - began < 60
