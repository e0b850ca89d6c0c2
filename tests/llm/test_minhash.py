"""b-bit MinHash against brute force over 4-word shingles; hard near copies; odd rows."""

import random
import re

import numpy as np
import pytest

from tulha.llm import minhash, queries
from tulha.llm.common import table

SCHEMA = "doc_id long, text string, n long, fp string"


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    width = min(4, len(words))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of every row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            small, large = sorted((len(sets[a]), len(sets[b])))
            if not small or 100 * small < 80 * large or root(a) == root(b):
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (small + large - both):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(i, len(sets[k]), c := least.get(root(k)), i == c) for k, (i, _) in enumerate(rows)]


def same(found, rows):
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute(rows)))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "f") for i, t in rows], SCHEMA)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    same(queries.op13_minhash(spark, folder), rows)


def copies(draw):
    """Changed, added and lost words; chains of copies; short texts."""
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(30):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([2, 4, 6, 30, 80, 300]))]
        rows.append(base)
        for _ in range(6):
            base = list(draw.choice([base, rows[-1]]))
            for _ in range(max(1, len(base) * draw.choice([0, 1, 2, 4]) // 100)):
                at = draw.randrange(len(base))
                base[at : at + draw.choice([0, 1])] = [draw.choice(vocabulary)] * draw.choice([0, 1, 1])
            rows.append(base)
    return [(k, " ".join(r)) for k, r in enumerate(rows)]


def template(draw, count):
    """Copies of one 200-word text with six words changed: alike, and few of them similar."""
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(count):
        words = list(base)
        for at in draw.sample(range(200), 6):
            words[at] = f"v{draw.randrange(30)}"
        rows.append((k, " ".join(words)))
    return rows


@pytest.mark.parametrize("gathered", [3000, minhash.GATHERED])
def test_near_copies(spark, gathered, monkeypatch):
    """Also where a band is cut into several blocks."""
    monkeypatch.setattr(minhash, "GATHERED", gathered)
    monkeypatch.setattr(minhash.links, "__defaults__", (gathered,))
    draw = random.Random(3)
    rows = copies(draw)
    rows += [(1000 + i, t) for i, t in template(draw, 300)]
    want = brute(rows)
    assert 50 < sum(not r[3] for r in want) < len(rows) - 150
    same(minhash.report(frame(spark, rows)), rows)


def test_alike_but_not_similar_write_few_rows(spark):
    """Rows written grow with the classes and bands, not with the pairs."""
    written = []
    for count in (150, 300):
        rows = stored_rows(spark, frame(spark, template(random.Random(5), count)))
        written.append(rows)
    assert written[1] < 3 * written[0]


def stored_rows(spark, docs):
    """Rows of all tables that the links write on their way."""
    total, keep = [0], minhash.stored

    def counting(df, label):
        out = keep(df, label)
        total[0] += out.count()
        return out

    minhash.stored = counting
    try:
        minhash.report(docs).count()
    finally:
        minhash.stored = keep
    return total[0]


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (None, "one two"), (4, "one two"), (4, "one two"), (5, "ONE\x0btwo"),
    (6, "word " * 30_000), (7, "é É ß"), (None, None), (None, "only null ids here"), (None, "only NULL ids here"),
    (8, " ".join(map(str, range(60_000)))), (9, " ".join(map(str, range(1, 60_000)))),
]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_rows(spark, rows):
    found = minhash.report(frame(spark, rows))
    want = [(i, n, c, i == c) for i, n, c, _ in brute(rows)]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_estimate_is_corrected_for_collisions():
    draw = np.random.default_rng(1)
    for share in (0.0, 0.3, 0.5, 0.8, 0.95):
        found = []
        for _ in range(60):
            both = round(share * 400)
            values = draw.integers(0, 1 << 63, 400 + 400 - both).astype(np.uint64)
            a, b = np.unique(values[:400]), np.unique(values[400 - both :])
            x, y = (minhash.packed(minhash.minima(s)) for s in (a, b))
            found.append(minhash.estimated(minhash.equal_groups(x, y)))
            real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(np.mean(found) - real) < 0.02


def test_bit_counts_agree_in_spark(spark):
    draw = np.random.default_rng(2)
    pairs = draw.integers(-(1 << 62), 1 << 62, (50, 2, 10))
    pairs[:25, 1, :5] = pairs[:25, 0, :5]
    df = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in pairs], "x array<long>, y array<long>")
    found = [r[0] for r in df.select(minhash._equal_column(df.x, df.y)).collect()]
    assert found == [int(minhash.equal_groups(x, y)) for x, y in pairs] and len(set(found)) > 3
