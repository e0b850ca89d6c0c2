"""Vector codes: each vector's parts become indexes into learned codebooks.

A vector is turned into integers and cut into ``PARTS`` equal parts; each part position has
a codebook of ``ENTRIES`` entries, learned by ``ROUNDS`` rounds of assigning every part to
its nearest entry and moving each entry to the mean of its parts.

Norm-of-sum bounds spare most distances. The driver keeps the history of all codebooks,
which is small and of fixed size. Each part keeps, with its entry, a lower bound of its
distance to all other entries and the stamp of the round in which that bound was an exact
distance. In a later round another entry can have come nearer by its net displacement since
the stamp at most, the norm of the sum of its moves, read off the history: never more than
the sum of the norms that accumulated drifts add up to, and far less where entries swing.
The distance to the own entry is computed exactly; where it is below the bound less the
greatest net displacement of the other entries, the part keeps its entry without a look at
them. Else all entries are scanned exactly, and the bound gets a new stamp. One bound per
part rather than one per entry keeps the state at 48 bytes a vector, which matters more
than the distances saved, since the state is written in every round.

Distances are compared as exact integers; bounds are rounded down, so a part that is not
scanned again has the entry that a scan would give, ties included.

Each round is one job without a shuffle: it reads the rows that the round before wrote,
writes them with the new state and one row of partial sums per task, and drops the table of
the round before. The partial sums are one column, read alone; ``GATHER`` tasks add them up,
so the driver gets at most that many rows of fixed size.

Defined results: rows whose vector is null, or holds null or non-finite components, are
dropped; null ids sort behind all others when the codebooks are begun; repeated rows count
as often as they occur, and of equal ids the smaller vector comes first; with fewer than
ENTRIES rows the codebooks have that many entries; rows with null labels share one
label_error; an empty table gives an empty result; other columns are not read. Vectors of
several lengths, of a length that PARTS does not divide, or with integers of ``LARGEST`` or
more are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tulha.llm.common import joined_hot, stored
from tulha.session import scratch_path

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LARGEST = 1 << 27
GATHER = 64
SLACK = 1e-6  # more than the rounding of a bound kept in 32 bits

#: Per part: its entry, the bound's stamp, the bound.
STATE = np.dtype([("entry", "u1", PARTS), ("stamp", "u1", PARTS), ("bound", "<f4", PARTS)])


def integers(column: str) -> Column:
    return F.transform(column, lambda v: F.floor(v.cast("double") * SCALE).cast("int"))


def _finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def _kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x) of the rows that take part; an error for vectors out of range."""
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("v"))
    rows = rows.where(F.col("v").isNotNull()).where(F.forall("v", _finite))
    bounds = rows.agg(
        F.min(F.size("v")), F.max(F.size("v")),
        F.max(F.array_max(F.transform("v", lambda v: F.abs(v.cast("double"))))),
    ).first()
    least, most, high = bounds
    if least != most or (most or 0) % PARTS:
        raise ValueError(f"vectors have {least} to {most} components, not one multiple of {PARTS}")
    if (high or 0.0) * SCALE >= LARGEST:
        raise ValueError(f"a component has {LARGEST} or more steps of 1/{SCALE}")
    return rows.select("vec_id", "label", integers("v").alias("x"))


def nearest(
    parts: np.ndarray, history: np.ndarray, state: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, int]:
    """State after the round of the last codebooks in ``history``, the exact squared distance
    of every part to its entry, and how many parts were scanned.

    parts: vectors x PARTS x width; history: rounds x PARTS x entries x width.
    """
    out = np.zeros(len(parts), STATE)
    error = np.zeros((len(parts), PARTS), np.int64)
    now, entries = len(history) - 1, history.shape[2]
    scanned = 0
    for p in range(PARTS):
        mine, book = parts[:, p], history[-1, p]
        if state is None:
            again = np.arange(len(parts))
        else:
            out[:]["entry"][:, p] = entry = state["entry"][:, p]
            out["stamp"][:, p] = stamp = state["stamp"][:, p]
            out["bound"][:, p] = bound = state["bound"][:, p]
            error[:, p] = ((mine - book[entry]) ** 2).sum(axis=1)
            moved = np.sqrt(((history[:, p] - book) ** 2).sum(axis=2).astype(float))
            others = np.array([np.delete(moved, a, axis=1).max(axis=1, initial=0) for a in range(entries)])
            least = bound - others[entry, stamp] * (1 + SLACK)
            again = np.flatnonzero(~(np.sqrt(error[:, p].astype(float)) * (1 + SLACK) < least))
        scanned += len(again)
        if len(again):
            square = ((mine[again, None, :] - book) ** 2).sum(axis=2)
            entry = square.argmin(axis=1)  # the first of equals
            rows = np.arange(len(again))
            error[again, p] = square[rows, entry]
            square = square.astype(float)
            square[rows, entry] = np.inf
            out["entry"][again, p] = entry
            out["stamp"][again, p] = now
            out["bound"][again, p] = np.sqrt(square.min(axis=1)) * (1 - SLACK)
    return out, error, scanned


def _components(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column(batch.schema.get_field_index("x"))
    return x.flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.int64)


def _state(batch: pa.RecordBatch) -> np.ndarray | None:
    at = batch.schema.get_field_index("state")
    if at < 0:
        return None
    return np.frombuffer(b"".join(batch.column(at).to_pylist()), STATE)


def _round(rows: DataFrame, history: np.ndarray) -> DataFrame:
    """``rows`` with their state after one more round; per task a row of sums and counts."""
    shape = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        schema = None
        for batch in batches:
            x = _components(batch)
            parts = x.reshape(len(x), PARTS, -1)
            state = nearest(parts, history, _state(batch))[0]
            for p in range(PARTS):
                np.add.at(sums[p], state["entry"][:, p], parts[:, p])
                counts[p] += np.bincount(state["entry"][:, p], minlength=shape[1])
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label", "x")]
            columns += [pa.array([s.tobytes() for s in state], pa.binary()), pa.nulls(len(x), pa.binary())]
            found = pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "x", "state", "sums"])
            schema = found.schema
            yield found
        if schema is not None:
            last = [pa.nulls(1, f.type) for f in list(schema)[:-1]]
            last.append(pa.array([sums.tobytes() + counts.tobytes()], pa.binary()))
            yield pa.RecordBatch.from_arrays(last, schema=schema)

    kinds = dict(rows.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, x array<int>, state binary, sums binary"
    return rows.mapInArrow(run, schema)


def _total(table: DataFrame, shape: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            for sums in batch.column(0).to_pylist():
                values = np.frombuffer(sums, np.int64)
                whole = values if whole is None else whole + values
        if whole is not None:
            yield pa.RecordBatch.from_arrays([pa.array([whole.tobytes()], pa.binary())], names=["sums"])

    parts = table.select("sums").where("sums is not null").coalesce(GATHER).mapInArrow(run, "sums binary")
    whole = sum(np.frombuffer(r.sums, np.int64) for r in parts.collect())
    size = int(np.prod(shape))
    return whole[:size].reshape(shape), whole[size:].reshape(shape[:2])


def _drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def learn(rows: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(rows with the state of the last round, history of rounds + 1 codebooks)."""
    spark = rows.sparkSession
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(ENTRIES).collect()
    book = np.array([r.x for r in first], np.int64).reshape(len(first), PARTS, -1).transpose(1, 0, 2)
    history, old = book[None], None
    for _ in range(rounds):
        stepped = _round(rows, history)
        path = scratch_path(spark, "codes")
        stepped.write.parquet(path)
        table = spark.read.schema(stepped.schema).parquet(path)
        sums, counts = _total(table, book.shape)
        used = counts > 0
        book = np.where(used[:, :, None], sums // np.where(used, counts, 1)[:, :, None], history[-1])
        history = np.concatenate([history, book[None]])
        rows = table.where("x is not null").drop("sums")
        if old is not None:
            _drop(spark, old)
        old = path
    return rows, history


def books_sha256(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every row that takes part."""
    kinds = dict(vectors.dtypes)
    rows = stored(_kept(vectors), "vectors")
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    if rows.isEmpty():
        empty = vectors.sparkSession.createDataFrame([], f"{schema}, label_error bigint, codebooks_sha256 string")
        return empty.drop("label")
    rows, history = learn(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _components(batch)
            state, error, _ = nearest(x.reshape(len(x), PARTS, -1), history, _state(batch))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label")]
            columns += [pa.array([e.tobytes().hex() for e in state["entry"]]), pa.array(error.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    text = F.col("label").cast("string")
    key = F.coalesce(F.concat(F.lit("="), text), F.lit("")).alias("key")
    coded = stored(rows.mapInArrow(run, schema).select("vec_id", key, "code", "error"), "coded")
    sums = coded.groupBy("key").agg(F.sum("error").alias("label_error"))
    found = joined_hot(coded, sums, "key")
    return found.select(
        "vec_id", "code", "error", "label_error", F.lit(books_sha256(history[-1])).alias("codebooks_sha256")
    )
