"""Edit matching against brute force, planted passages, and defined results of odd rows."""

import random

import pytest

from tulha.llm import decontaminate as d
from tulha.llm.common import table


def distance(pattern, text):
    """Least edits of the pattern to any stretch of the text, and the first such end."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, e in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != e)))
        row = new
    return min((v, j) for j, v in enumerate(row))


def test_myers_equals_dynamic_programming():
    draw = random.Random(1)
    for _ in range(500):
        pattern, text = ("".join(draw.choice("ab ") for _ in range(draw.randint(1, n))) for n in (70, 90))
        edits, end = distance(pattern, text)
        got = d.myers(d.masks_of(pattern), len(pattern), text, len(pattern) - 1)
        assert got == ((edits, end) if edits < len(pattern) else None)


@pytest.mark.parametrize("seed", range(3))
def test_find_equals_brute_force(seed):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcde") for _ in range(draw.randint(2, 6))) for _ in range(30)]
    say = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [(k, say(draw.randint(1, 40))) for k in range(12)]
    matcher = d.Matcher(items)
    for _ in range(60):
        item = list(draw.choice(items)[1])
        for _ in range(draw.randint(0, max(1, d.budget(len(item)) + 2))):
            item[draw.randrange(len(item))] = draw.choice(["", "x", "yz"])
        text = f"{say(draw.randint(0, 15))} {''.join(item)}  {say(9)}"
        want = {}
        for k, t in items:
            edits, _ = distance(t, d.plain(text))
            if edits <= d.budget(len(t)):
                want[k] = edits
        assert {k: e for k, _, e in matcher.find(text)} == want


ODD = [(1, None), (2, ""), (None, "X  the Passage\nof some bench mark here y"), (3, "clean")]
ODD += [(4, "the passage of some bench mark here")] * 2


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 5, "z") for i, t in docs], "doc_id long, text string, item_id int, place string"),
        spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, edits int"),
    )


def test_odd_rows(spark):
    items = [(7, "The passage of some bench mark here"), (8, None), (9, " "), (7, "The passage of some bench mark here")]
    docs, bench = frames(spark, ODD, items)
    got = sorted(str(tuple(r)) for r in d.matches(docs, bench).collect())
    assert got == sorted(["(4, 7, 0, 0)"] * 4 + ["(None, 7, 2, 0)"] * 2)
    kept = d.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]
    for a, b in (([], items), (ODD, [])):
        docs, bench = frames(spark, a, b)
        assert d.matches(docs, bench).count() == 0 and d.clean(docs, bench).count() == len(a)


def test_groups_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(d, "GROUP", 40)
    docs, bench = frames(spark, ODD, [(k, f"item number {k} about something else") for k in range(5)] + [(7, ODD[-1][1])])
    assert {r.doc_id for r in d.matches(docs, bench).collect()} == {4, None}


def test_whole_table_finds_every_exact_passage(spark, folder):
    docs, bench = (table(spark, folder, t) for t in ("documents", "benchmark"))
    items = [(r.item_id, d.plain(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in d.plain(r.text or "")}
    got = {(r.doc_id, r.item_id) for r in d.matches(docs, bench).collect()}
    assert want and want <= got
