"""Quality: random Fourier features of document statistics, ridge scores, isotonic calibration.

Each text becomes ``STATISTICS`` numbers (lengths, shares of kinds of characters, repeated
words, pairs and lines). After scaling, random Fourier features approximate a Gaussian
kernel over them. Ridge regression on the labels is fitted by normal equations: every
partition adds up its own Z'Z and Z'y, Spark adds the partitions' sums row by row, and one
system of ``FEATURES`` unknowns is solved. Scores are calibrated by pool-adjacent-violators
over ``BINS`` bins of the training scores.

Texts are read once for training (a sample of at most about ``SAMPLE`` labelled rows, a
documented bound) and once for scoring; nothing of the size of the corpus is shuffled.

Defined results: null and empty texts have all statistics zero and are scored as such;
without labelled rows every score is 0; repeated labels of an id count once; a null id is
not held out and not learned from; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.llm.common import (
    chunks, code_points, column_list, labelled, letter_table, map_batches, mixed, remainder,
    stored, texts_of, word_hashes,
)

SAMPLE = 20_000
FOLD = (3, 1)  # modulus and held-out remainder
FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-2
BINS = 256
PARTS = 32
STATISTICS = 16


def _marks() -> np.ndarray:
    """By ASCII code: 1 digit, 2 white space, 3 stop or comma, 4 other mark; 0 beyond."""
    out = np.zeros(128, np.uint8)
    for code in range(128):
        char = chr(code)
        if char.isdigit():
            out[code] = 1
        elif char.isspace():
            out[code] = 2
        elif char in ".,;:'\"?()-":
            out[code] = 3
        elif not char.isalpha():
            out[code] = 4
    return out


MARKS = _marks()


def _distinct(owner: np.ndarray, key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of each owner, and the count of its most frequent one."""
    if not len(key):
        return np.zeros(size), np.zeros(size)
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (key[1:] != key[:-1]))))
    times = np.diff(np.append(first, len(key)))
    most = np.zeros(size)
    np.maximum.at(most, owner[first], times)
    return np.bincount(owner[first], minlength=size).astype(float), most


def statistics(texts: list[str]) -> np.ndarray:
    """One row of numbers per text. Texts beyond a slice add up their slices' counts."""
    size = len(texts)
    total = np.zeros((size, 20))
    for numbers, parts in chunks(texts):
        count = len(parts)
        codes, part = code_points(parts)
        letters = letter_table()[codes]
        word, owner, start, end = word_hashes(letters, part)
        is_letter = letters != 0
        mark = np.where(codes < 128, MARKS[np.minimum(codes, 127)], np.where(is_letter, 0, 4))
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        mark[ends] = 5  # the line feeds that code_points adds
        upper = is_letter & (codes != letters)
        length = end - start
        same = owner[1:] == owner[:-1]
        again = same & (word[1:] == word[:-1])
        pair = mixed(word[:-1] * np.uint64(0xA24BAED4963EE407) + word[1:])[same]
        words, most = _distinct(owner, word, count)
        pairs, _ = _distinct(owner[:-1][same], pair, count)
        breaks = np.flatnonzero(codes == 10)
        edge = np.concatenate(([-1], breaks))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(1)), out=sums[1:])
        line = mixed(sums[edge[1:]] - sums[edge[:-1] + 1])
        long_line = edge[1:] - edge[:-1] > 1
        lines, _ = _distinct(part[edge[1:]][long_line], line[long_line], count)

        def per(where: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(where, weight, count)

        rows = [
            per(part) - 1, per(part[is_letter]), per(part[upper]), per(part[mark == 1]),
            per(part[mark == 2]), per(part[mark == 3]), per(part[mark == 4]),
            per(owner), per(owner, length), per(owner, length.astype(float) ** 2),
            per(owner[1:][again]), words, most, pairs, per(owner[:-1][same]),
            per(part[edge[1:]][long_line]), lines, per(part[codes == 33]),
            per(owner[length <= 3]), per(part[codes == 124]),
        ]
        np.add.at(total, np.array(numbers), np.array(rows).T)
    chars, letters, upper, digit, space, stop, other, words, long, square = total[:, :10].T
    again, kinds, most, pairs, neighbours, lines, own_lines, shouts, short, bars = total[:, 10:].T

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a / np.maximum(b, 1)

    mean = share(long, words)
    return np.column_stack(
        [
            np.log1p(chars), np.log1p(words), mean, np.sqrt(np.maximum(share(square, words) - mean**2, 0)),
            share(letters, chars), share(upper, letters), np.log1p(100 * share(digit, chars)),
            share(stop, words), np.log1p(10 * share(other, words)), share(again, neighbours),
            share(kinds, words), share(most, words), share(pairs, neighbours),
            share(own_lines, lines), np.log1p(10 * share(shouts, words)), np.log1p(10 * share(bars, words)),
        ]
    )


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None  # None: nothing learned
    edges: np.ndarray
    levels: np.ndarray

    def raw(self, numbers: np.ndarray) -> np.ndarray:
        return fourier(numbers, self.center, self.scale) @ self.weights

    def scores(self, numbers: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(numbers))
        return np.interp(self.raw(numbers), self.edges, self.levels)


def fourier(numbers: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """cos(xW + b) of scaled numbers, the numbers themselves and a constant."""
    draw = np.random.default_rng(10)
    w = draw.normal(size=(STATISTICS, FEATURES)) / WIDTH
    b = draw.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((numbers - center) / scale, -6, 6)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(x @ w + b), np.ones((len(x), 1))])


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``value`` (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for v, w in zip(value.tolist(), weight.tolist()):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows outside the held-out remainder; see the module."""
    rows = labelled(docs, labels, "quality", FOLD[0], FOLD[1], SAMPLE)

    def work(batch: pa.RecordBatch) -> dict:
        return {"y": column_list(batch, "y"), "x": list(statistics(texts_of(batch)))}

    sample = stored(
        map_batches(rows, "y double, x array<double>", work).repartition(PARTS), "quality"
    )
    moments = (
        sample.select(F.posexplode("x").alias("k", "v"))
        .groupBy("k")
        .agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"))
        .orderBy("k")
        .collect()
    )
    if not moments:
        nothing = np.zeros(0)
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), None, nothing, nothing)
    center = np.array([r["m"] for r in moments])
    scale = np.array([max(r["s"], 1e-6) for r in moments])

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            if batch.num_rows:
                z = fourier(_matrix(batch), center, scale)
                y = batch.column("y").to_numpy()
                total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(FEATURES + 1), pa.int32()), pa.array(list(total))], names=["i", "v"]
        )

    sums = (
        sample.mapInArrow(equations, "i int, v array<double>")
        .select("i", F.posexplode("v").alias("j", "v"))
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    whole = np.zeros((FEATURES + 1, FEATURES + 2))
    for r in sums:
        whole[r["i"], r["j"]] = r["v"]
    rows_n = whole[-1, -2]
    ridge = RIDGE * rows_n / FEATURES * np.eye(FEATURES + 1)
    ridge[-1, -1] = 0
    weights = np.linalg.solve(whole[:, :-1] + ridge + 1e-9 * np.eye(FEATURES + 1), whole[:, -1])
    model = Model(center, scale, weights, np.zeros(0), np.zeros(0))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = np.clip(model.raw(_matrix(batch)), -0.5, 1.5)
                place = np.minimum(((raw + 0.5) / 2 * BINS).astype(np.int32), BINS - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place), batch.column("y")], names=["bin", "y"]
                )

    bins = (
        sample.mapInArrow(binned, "bin int, y double")
        .groupBy("bin")
        .agg(F.avg("y").alias("y"), F.count("*").alias("n"))
        .orderBy("bin")
        .collect()
    )
    place = np.array([r["bin"] for r in bins])
    fitted = isotonic(np.array([r["y"] for r in bins]), np.array([r["n"] for r in bins], float))
    return Model(center, scale, weights, (place + 0.5) / BINS * 2 - 0.5, fitted)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index("x")).flatten()
    return flat.to_numpy().reshape(batch.num_rows, STATISTICS)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = train(docs, labels)

    def work(batch: pa.RecordBatch) -> dict:
        score = model.scores(statistics(texts_of(batch)))
        return {
            "doc_id": column_list(batch, "doc_id"),
            "score": score,
            "predicted": (score >= 0.5).astype(np.int32),
        }

    kind = dict(docs.dtypes)["doc_id"]
    found = map_batches(
        docs.select("doc_id", "text"), f"doc_id {kind}, score double, predicted int", work
    )
    held = F.coalesce(remainder("doc_id", FOLD[0]) == FOLD[1], F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")
