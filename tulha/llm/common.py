"""What the operators share: reading, shared scratch tables, folded text, word hashes.

Batches that go to Python hold few rows, so that a batch of very long texts stays
small, and a text is cut into slices before any array is built from it.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tulha.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SLICE = 1 << 20  # code points turned into arrays at a time


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, 256 rows or 16 MB; workers that see this folder import from it.

    A cluster whose machines do not see the folder gets the package by ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    given = spark.sparkContext.environment
    paths = given.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        given["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: later plans never recompute ``df``."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


HOT = 1000
SALTS = 16


def joined_hot(rows: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` (many per key) with ``one`` (one row per key), both stored.

    A key that holds over 1 / HOT of the rows would load one task; there are fewer than HOT
    such keys, so their rows of ``one`` are broadcast. All other keys are shuffled.
    """
    total = rows.count()
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") * HOT > total)
    hot = F.broadcast(stored(one.join(F.broadcast(counts.select(key)), key), "hot"))
    rest = rows.join(hot.select(key), key, "left_anti").join(one, key)
    return rows.join(hot, key).unionByName(rest)


def joined_salted(rows: DataFrame, one: DataFrame, key: str, by: str) -> DataFrame:
    """Inner join of ``rows`` (many per key) with ``one`` (one row per key): the rows of a
    key are dealt to SALTS tasks by the hash of ``by``, and ``one`` goes to each of them.

    For small rows and tables that are joined often: one plain join, no counting before."""
    salt = F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("_salt", salt)
    return salted.join(one.withColumn("_salt", every), [key, "_salt"]).drop("_salt")


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def column_list(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null reads as empty."""
    return [t or "" for t in column_list(batch, name)]


def map_batches(
    df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict | None]
) -> DataFrame:
    """Per Arrow batch: ``work`` returns lists or arrays by column of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    target = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := work(batch)) is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in target], schema=target
                )

    return df.mapInArrow(run, schema)


def chunks(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Slices of the texts, about SLICE code points at a time, with the text's number."""
    numbers, parts, size = [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, len(text), SLICE):
            numbers.append(k)
            parts.append(text[at : at + SLICE])
            size += len(parts[-1])
            if size >= SLICE:
                yield numbers, parts
                numbers, parts, size = [], [], 0
    if parts:
        yield numbers, parts


@cache
def letter_table() -> np.ndarray:
    """By code point: the lower-case letter's code, 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def code_points(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All parts, each followed by a line feed, and each place's part number."""
    joined = "\n".join(parts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    return codes, np.repeat(np.arange(len(parts), dtype=np.int32), sizes)


MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return run(MULTIPLIER), run(pow(MULTIPLIER, -1, 1 << 64))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def word_hashes(letters: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, part, start and end of each run of non-zero codes."""
    inside = letters != 0
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    size = 1 << max(20, int(len(letters)).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(letters.astype(np.uint64) * up[: len(letters)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start]), part[start], start, end


def chance(seed: int, *columns: str) -> Column:
    """A whole number from 0 below CHANCES, the same for equal values of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 3)


CHANCES = 1 << 61  # fine enough for a sample of any table, however large


def share(bound: int, total: int) -> int:
    """The limit of ``chance`` under which about ``bound`` of ``total`` rows stay."""
    return CHANCES if total <= bound else CHANCES * bound // total


def some_texts(docs: DataFrame, bound: int, seed: int) -> DataFrame:
    """(text) different texts without null, about ``bound`` of them at most.

    Texts are kept by their hash at a rate of bound / rows, and equal ones count once (a
    map-side aggregate), so neither an id nor a text that holds much of the table exceeds
    the bound; a table of up to ``bound`` rows is kept whole.
    """
    few = share(bound, docs.count())
    texts = docs.select("text").where(F.col("text").isNotNull() & (chance(seed, "text") < few))
    return texts.distinct()


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, bound: int
) -> DataFrame:
    """(doc_id, text, y) of labelled rows outside the held-out remainder, about ``bound`` at most.

    Ids are kept by their hash at a rate of bound / labels, so the sample of ids is small
    enough to broadcast whatever the size of the corpus. The rows of the kept ids are kept
    by the hash of id and text at a rate of bound / such rows, and rows equal in both count
    once (a map-side aggregate), so an id or a row that holds much of the table does not
    exceed the bound. Repeated labels of an id count once (the larger); null labels, ids and
    texts take no part.
    """
    ids = (
        labels.select("doc_id", F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & (remainder("doc_id", modulus) != held))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    ids = ids.where(chance(11, "doc_id") < share(bound, ids.count()))
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    rows = rows.join(F.broadcast(ids), "doc_id").withColumn("_place", chance(13, "doc_id", "text"))
    total = rows.select("doc_id", "_place").distinct().count()
    kept = rows.where(F.col("_place") < share(bound, total))
    return kept.select("doc_id", "text", "y").distinct()
