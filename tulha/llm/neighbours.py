"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector's direction, turned by one fixed random rotation, is kept as the signs of its
coordinates (packed bits) with two scalars: its length, and the inner product of the
direction with its own code. The inner product with a query is estimated from the code
alone, with an error bound of ``EPSILON`` standard deviations. A candidate is reranked
with the original vector in double precision exactly where estimate plus bound reaches
the k-th best exact product known so far.

Layout: the index is dealt evenly to blocks of about ``BLOCK`` vectors by a place stored
with each vector, so a value that many rows share fills no block and every round reads
the same blocks. The query set, one row in twenty, comes in batches of
``BATCH``; each batch meets each block once, in rounds of growing size (1 block, then
``GROWTH`` times as many as before). After a round every query knows its k-th best
product so far, and later blocks return only what reaches it, so a round returns about
GROWTH x k rows per query however large the index is. Work is queries times vectors, the
stated search of a query set against all rows; no row is skipped, and recall is limited
by the error bound only.

Defined results: null and zero vectors, vectors with a null or non-finite number, and
vectors of another length than the most common one (ties: the longer) take no part, as
query or candidate; a null id neither queries nor is found; rows that repeat an id are
all candidates of other ids (and a query per row is one query per id); fewer than k
candidates give them all; other columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tulha.llm.common import stored

K = 20
EVERY = 20
BLOCK = 16384
BATCH = 1024
GROWTH = 4
EPSILON = 2.5
PROBE = 4  # times k estimates that are looked up first
SEED = 9


def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length, and the product of the direction with its own code."""
    length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    turned = vectors / length[:, None] @ rotation(vectors.shape[1]).T
    own = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), length, own


def estimates(
    queries: np.ndarray, packed: np.ndarray, length: np.ndarray, own: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated products (queries x vectors) and their error bounds."""
    dims = queries.shape[1]
    turned = queries @ rotation(dims).T
    signs = np.unpackbits(packed, axis=1, count=dims).astype(np.float32) * 2 - 1
    product = turned.astype(np.float32) @ signs.T / np.float32(np.sqrt(dims))
    spread = EPSILON * np.sqrt(np.maximum(1 - own**2, 0) / max(dims - 1, 1)) / own
    size = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    scale = (length / own).astype(np.float32)
    return product * scale, np.outer(size, length * spread + 1e-6 * length).astype(np.float32)


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up from the first place to the last."""
    return np.add.accumulate(vectors * query, axis=1)[:, -1]


def search_block(
    ids: np.ndarray, vectors: np.ndarray, code: tuple[np.ndarray, ...],
    query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query numbers, vector numbers, products): at most the k best of each query that
    reach its floor, ties to smaller ids."""
    for at in range(0, len(queries), 128):
        estimate, bound = estimates(queries[at : at + 128], *code)
        for row in range(len(estimate)):
            number, query = at + row, queries[at + row]
            allowed = ids != query_ids[number]
            guess = np.where(allowed, estimate[row], -np.inf)
            need = floor[number]
            if len(ids) > PROBE * k + 1:
                first = np.argpartition(guess, -PROBE * k)[-PROBE * k :]
                need = max(need, np.sort(vectors[first] @ query)[-k] - 1e-9)
            picked = np.flatnonzero(allowed & (guess + bound[row] >= need))
            rough = vectors[picked] @ query
            if len(picked) > k:
                need = max(need, np.partition(rough, -k)[-k] - 1e-9)
            picked = picked[rough >= need - 1e-9]
            if len(picked):
                score = exact(query, vectors[picked])
                best = np.lexsort((ids[picked], -score))[:k]
                best = best[score[best] >= floor[number]]
                yield np.full(len(best), number), picked[best], score[best]


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    rows = rows.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & some
    )
    sizes = rows.groupBy(F.size("embedding").alias("n")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    dims = common["n"] if common else 0
    return rows.where(F.size("embedding") == dims).select("vec_id", v.alias("v"))


def _matrix(series: pd.Series) -> np.ndarray:
    return np.array(series.tolist(), np.float64)


def build(rows: DataFrame) -> tuple[DataFrame, int]:
    """The stored index (vec_id, v, code, length, own, place), the block of each vector from
    its stored place, and the number of blocks.

    The place is written with the vector: a row number of a later scan would follow how
    that scan is split, and rounds could differ."""
    clean = usable(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("v")
            vectors = flat.flatten().to_numpy().reshape(batch.num_rows, -1)
            packed, length, own = codes(vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), flat,
                    pa.array([p.tobytes() for p in packed], pa.binary()),
                    pa.array(length), pa.array(own),
                ],
                names=["vec_id", "v", "code", "length", "own"],
            )

    schema = "vec_id bigint, v array<double>, code binary, length double, own double"
    coded = clean.select(F.col("vec_id").cast("long"), "v").mapInArrow(run, schema)
    place = F.xxhash64(F.monotonically_increasing_id(), F.lit(1))
    index = stored(coded.withColumn("place", place), "codes")
    blocks = max(1, -(-index.count() // BLOCK))
    return index.withColumn("block", F.pmod("place", F.lit(blocks)).cast("int")), blocks


def _scan(asked: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) found by each batch of ``asked`` in each block of ``index``."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if not len(left) or not len(right):
            return empty
        ids, vectors = right["vec_id"].to_numpy(np.int64), _matrix(right["v"])
        packed = np.array([np.frombuffer(c, np.uint8) for c in right["code"]])
        code = (packed, right["length"].to_numpy(), right["own"].to_numpy())
        queries = left["query_id"].to_numpy(np.int64)
        found = list(
            search_block(ids, vectors, code, queries, _matrix(left["q"]), left["floor"].to_numpy(), k)
        )
        if not found:
            return empty
        number, at, score = (np.concatenate([f[i] for f in found]) for i in range(3))
        return pd.DataFrame({"query_id": queries[number], "vec_id": ids[at], "score": score})

    key = ["batch", "block"]
    return (
        asked.groupBy(*key)
        .cogroup(index.groupBy(*key))
        .applyInPandas(run, "query_id bigint, vec_id bigint, score double")
    )


def nearest(rows: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors of each query."""
    index, blocks = build(rows)
    queries = index.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("q"))
    batches = max(1, -(-queries.count() // BATCH))
    queries = queries.select(
        F.col("vec_id").alias("query_id"),
        "q",
        F.pmod(F.xxhash64("vec_id"), F.lit(batches)).cast("int").alias("batch"),
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = None
    first, size = 0, 1
    while first < blocks:
        till = min(blocks, first + size)
        if best is None:
            asked = queries.withColumn("floor", F.lit(float("-inf")))
        else:
            floors = best.groupBy("query_id").agg(
                F.when(F.count("*") >= k, F.min("score")).otherwise(float("-inf")).alias("floor")
            )
            asked = queries.join(floors, "query_id", "left").fillna(float("-inf"), "floor")
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(till - 1))))
        part = index.where(F.col("block").between(first, till - 1)).withColumn(
            "batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1)))
        )
        found = _scan(asked, part, k)
        found = found if best is None else best.drop("rank").unionByName(found)
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = stored(ranked, "nearest")
        first, size = till, size * GROWTH
    return best.select("query_id", "rank", "vec_id", "score")
