"""Repeated strings against brute force, and defined results of odd rows."""

import hashlib
import random
from collections import Counter

import pytest

from tulha.llm import queries, repeats
from tulha.llm.common import table


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        runs = [(k, k + length) for k in range(len(b) - length + 1) if seen[b[k : k + length]] > 1]
        runs = repeats.merged(runs)
        cut = {k for a, e in runs for k in range(a, e)}
        kept = bytes(c for k, c in enumerate(b) if k not in cut)
        out.append((str(i), len(b), len(cut), len(runs), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df, length):
    return sorted((str(r[0]), *r[1:]) for r in repeats.report(df, length).collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, 1) for i, t in rows], "doc_id long, text string, a int, r1 int")


def texts(kind):
    draw = random.Random(kind)
    word = lambda n, s="abcdé ": "".join(draw.choice(s) for _ in range(n))
    shared = [word(draw.randint(30, 90)) for _ in range(6)]
    rows = [(k, word(draw.randint(0, 80)) + draw.choice(shared) + word(draw.randint(0, 60))) for k in range(60)]
    rows += [(100 + k, draw.choice(shared) + draw.choice(shared)) for k in range(10)]
    rows += [(200, None), (201, ""), (None, shared[0]), (202, "a" * 300), (203, "ab" * 150), (204, rows[0][1])]
    return rows + rows[5:8]


@pytest.mark.parametrize("kind", [1, 2])
def test_small_windows(spark, kind, monkeypatch):
    monkeypatch.setattr(repeats, "GRAM", 8)
    if kind == 2:
        monkeypatch.setattr(repeats, "CHUNK", 64)
    marks = repeats.marks
    monkeypatch.setattr(repeats, "marks", lambda rows, length: marks(rows, length, gram=8, bucket=4))
    rows = texts(kind)
    assert got(frame(spark, rows), 40) == brute(rows, 40)


def test_whole_table_equals_brute_force(spark, folder):
    docs = table(spark, folder, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, repeats.LENGTH)
    assert sum(w[2] for w in want) > 0
    assert got(docs, repeats.LENGTH) == want


def test_empty_table(spark):
    assert got(frame(spark, []), 40) == []


@pytest.mark.parametrize("text", ["a" * 300_000, "ab\n" * 100_000 + "x" * 500 + "ab\n" * 900])
def test_very_long_text_of_one_loop(spark, text):
    """A stretch per byte is merged before it meets the text."""
    rows = got(frame(spark, [(1, text), (2, "b" * 600 + "c")]), repeats.LENGTH)
    assert rows[0][:4] == ("1", len(text), len(text), 1)
    assert rows[1][:4] == ("2", 601, 600, 1)


def shared_brute(rows, words):
    windows = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - words + 1):
            windows.setdefault(tuple(w[k : k + words]), set()).add((i, t))
    several = set().union(*(s for s in windows.values() if len(s) > 1))
    return sorted((str(i), int((i, t) in several)) for i, t in rows)


def shared_got(df, words, length=repeats.LENGTH):
    return sorted((str(r.doc_id), r.shared_passage) for r in repeats.report(df, length, words).collect())


@pytest.mark.parametrize("kind", [1, 2, 3])
def test_passages_of_words_against_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(repeats, "WORD_GRAM", 2)
    draw = random.Random(kind)
    line = lambda n, s: [draw.choice(s) + str(draw.randint(0, 40)) for _ in range(n)]
    shared = [line(draw.randint(9, 16), "abc") for _ in range(12)]  # some too short to count
    rows = []
    for k in range(80):
        body = line(draw.randint(0, 30), "xyz") + draw.choice(shared)[draw.randint(0, 2) :] + line(20, "uvw")
        rows.append((k, "".join(w + draw.choice([" ", "\n", "\t ", "\x0b"]) for w in body)))
    rows += [(100, None), (101, ""), (102, "la " * 90), (103, rows[0][1]), (None, rows[1][1])]
    rows += [(104, " ".join(["é\xa0b"] + line(40, "o") * 2)), rows[2], rows[2]]
    want = shared_brute(rows, 12)
    assert 10 < sum(s for _, s in want) < len(rows) - 10
    assert shared_got(frame(spark, rows), 12) == want


def test_passage_of_over_50_words_under_400_bytes(spark):
    """Nothing of it is removed, but both documents are marked; 50 words are too few."""
    text = lambda seed, n: " ".join(f"{seed}{k:03}" for k in range(n))
    fifty, more = text("a", 50), text("b", 51)
    rows = [(1, f"{text('p', 90)} {more}\n{text('q', 70)}"), (2, f"{text('r', 40)}\n{more} {text('s', 9)}")]
    rows += [(3, f"{fifty} {text('t', 60)}"), (4, f"{text('u', 60)} {fifty}"), (5, f"{text('v', 60)} " * 2)]
    found = repeats.report(frame(spark, rows), words=repeats.WORDS).orderBy("doc_id").collect()
    assert [r.shared_passage for r in found] == [1, 1, 0, 0, 0]
    assert [r.n_removed for r in found] == [0] * 5


def test_passages_of_the_whole_table(spark, folder):
    docs = table(spark, folder, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = shared_brute(rows, repeats.WORDS)
    assert 0 < sum(s for _, s in want) < len(rows)
    full = queries.op6_repeats(spark, folder).collect()
    assert sorted((str(r.doc_id), r.shared_passage) for r in full) == want
    assert sorted((str(r[0]), *r[1:5]) for r in full) == brute(rows, repeats.LENGTH)


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    draw = random.Random(4)
    texts = [" ".join("ab\0é"[: draw.randint(1, 4)] * draw.randint(1, 30) for _ in range(n)).encode() for n in (40, 0, 7, 90)]
    texts += [b"", b" \n", b"x\x0b\x0cy\tz\r\n", b"y" * 300 + b" x", b"q " * 9 + b"y" * 300]
    whole = repeats._word_hashes(texts)
    assert [len(w) for w in whole] == [len(t.split()) for t in texts]
    for size in (5, 64, 301):
        monkeypatch.setattr(repeats, "CHUNK", size)
        cut = [h for w in repeats._word_hashes(texts) for h in w.tolist()]
        words = [w for t in texts for w in t.split()]
        assert len(set(zip(words, cut))) == len(set(words)) == len(set(cut))
