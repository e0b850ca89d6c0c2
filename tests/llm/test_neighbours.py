"""Nearest neighbours against brute force, and defined results of odd vectors."""

import numpy as np

from tulha.llm import neighbours
from tulha.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, score string, block int"


def brute(ids, vectors, every, k):
    out = {}
    for i, q in zip(ids, vectors):
        if i % every == 0:
            score = neighbours.exact(q, vectors)
            best = sorted((-s, j) for j, s in zip(ids, score) if j != i)[:k]
            out[i] = [(j, -s) for s, j in best]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark, folder, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 60)  # several blocks and rounds
    monkeypatch.setattr(neighbours, "BATCH", 10)
    rows = table(spark, folder, "embeddings")
    data = rows.toPandas()
    want = brute(data.vec_id.tolist(), np.array(data.embedding.tolist(), float), 20, 20)
    got = found(neighbours.nearest(rows))
    assert got.keys() == want.keys()
    hits = [len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want]
    assert sum(hits) >= 0.95 * 20 * len(want)
    exact = {(q, j): s for q in want for j, s in want[q]}
    assert all(exact.get((q, j), s) == s for q in got for j, s in got[q])


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None),
        (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0]),
        (None, [1.0, 1.0]), (20, [-1.0, 0.5]), (20, [-1.0, 0.5]),
    ]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = found(neighbours.nearest(df))
    assert [j for j, _ in got[0]] == [1, 2, 20, 20]
    assert [j for j, _ in got[20]] == [0, 1, 2]
    assert set(got) == {0, 20}
    assert neighbours.nearest(df.where("vec_id > 900")).count() == 0


def test_blocks_do_not_follow_the_splits(spark, folder, monkeypatch):
    """A round that is planned with other splits reads the same blocks."""
    monkeypatch.setattr(neighbours, "BLOCK", 60)
    index, blocks = neighbours.build(table(spark, folder, "embeddings").repartition(8))
    assert blocks > 1

    def dealt():
        return {r.vec_id: r.block for r in index.select("vec_id", "block").collect()}

    before = dealt()
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        after = dealt()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert after == before and set(before.values()) == set(range(blocks))
