"""Vector codes against plain rounds without bounds; odd rows."""

import hashlib
import math

import numpy as np
import pytest

from tulha.llm import queries, vectorcodes
from tulha.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, key string, x int"


def plain(rows):
    """The contract, every distance of every round."""
    kept = [
        (i, [math.floor(4096 * c) for c in v], label)
        for i, v, label in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // 8
    parts = np.array([v for _, v, _ in kept], np.int64).reshape(len(kept), 8, width)
    books = parts[:16].transpose(1, 0, 2).copy()

    def assigned():
        square = ((parts[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return square.argmin(axis=2), square.min(axis=2)

    for _ in range(6):
        chosen, _ = assigned()
        for p in range(8):
            for e in range(books.shape[1]):
                mine = parts[chosen[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(axis=0) // len(mine)
    chosen, square = assigned()
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    error = square.sum(axis=1).tolist()
    by_label = {}
    for (_, _, label), e in zip(kept, error):
        by_label[label] = by_label.get(label, 0) + e
    return [
        (i, "".join(f"{c:02x}" for c in chosen[k]), error[k], by_label[label], digest)
        for k, (i, _, label) in enumerate(kept)
    ]


def same(found, want):
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", "label").collect()
    same(queries.op11_vector_codes(spark, folder), plain([tuple(r) for r in rows]))


def test_odd_rows(spark):
    draw = np.random.default_rng(1)
    near = [[float(c) for c in np.round(draw.normal(size=16) * 4) / 4] for _ in range(60)]  # many ties
    rows = [(k, near[k % 40], k % 3 or None) for k in range(60)] + [(7, near[3], 2), (7, near[3], 2), (None, near[5], 1)]
    rows += [(90, None, 1), (91, [1.0] * 15 + [None], 1), (92, [math.nan] * 16, 1), (93, [math.inf] + [0.0] * 15, None)]
    rows += [(94, [0.0] * 16, 1)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    same(vectorcodes.report(df), plain(rows))


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(5, [1.5] * 8, None)], [(k, [float(k)] * 8, k) for k in range(9)]])
def test_few_rows(spark, rows):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    same(vectorcodes.report(df), plain(rows))


def test_lengths_must_agree(spark):
    for rows in ([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], [(1, [1.0] * 9, 1)], [(1, [1e9] * 8, 1)]):
        with pytest.raises(ValueError):
            vectorcodes.report(spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA))


def test_bounds_spare_scans_and_change_nothing():
    """Codebooks that swing and return: net displacement keeps parts that drifts would scan."""
    draw = np.random.default_rng(2)
    centers = draw.integers(-3000, 3000, (8, 16, 4))
    parts = np.stack([centers[p, draw.integers(0, 16, 500)] for p in range(8)], axis=1) + draw.integers(-40, 40, (500, 8, 4))
    swing = draw.integers(-400, 400, centers.shape)
    history = np.stack([centers, centers + swing, centers + draw.integers(-5, 5, centers.shape)])
    state, scans = None, []
    for now in range(3):
        state, error, scanned = vectorcodes.nearest(parts, history[: now + 1], state)
        square = ((parts[:, :, None, :] - history[now][None]) ** 2).sum(axis=3)
        assert (state["entry"] == square.argmin(axis=2)).all() and (error == square.min(axis=2)).all()
        scans.append(scanned)
    assert scans[0] == 4000 and scans[2] < 400
