"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its hashed words (lower-case letter runs), neighbouring pairs and
pairs with one word between. Weights come from FTRL-proximal: a learning rate of its own
for each coordinate, and L1 sparsity, so the model that is broadcast holds the few
non-zero weights only (``SPACE`` at the very most). One task learns from a sample of at
most about ``SAMPLE`` labelled rows, a documented bound that holds for rows however often an
id repeats; scoring is one pass over whole texts without a shuffle.

Defined results: null and empty texts get the score of the bias alone; without labelled
rows to learn from every score is 0; repeated labels of an id and rows equal in id and text
count once in training; a null id is not
held out and not learned from; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.llm.common import (
    chunks, code_points, column_list, labelled, letter_table, map_batches, mixed, remainder,
    texts_of, word_hashes,
)

BITS = 20
SPACE = 1 << BITS
SAMPLE = 16384
FOLD = (5, 0)  # modulus and held-out remainder
EPOCHS = 8
ALPHA, BETA, L1, L2 = 2.0, 1.0, 8.0, 1.0
#: Features of fewer training rows get no weight: they could only be learned by heart.
LEAST_ROWS = 4


def features(texts: list[str]):
    """(text numbers, hashed features) of slices of the texts; repeats are left in."""
    for numbers, parts in chunks(texts):
        codes, part = code_points(parts)
        word, owner, _, _ = word_hashes(letter_table()[codes], part)
        number = np.array(numbers, np.int64)
        found = [(number[owner], word)]
        for gap, salt in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
            same = owner[gap:] == owner[:-gap]
            pair = word[:-gap][same] * np.uint64(salt) + word[gap:][same]
            found.append((number[owner[gap:][same]], mixed(pair)))
        yield (
            np.concatenate([f[0] for f in found]),
            (np.concatenate([f[1] for f in found]) >> np.uint64(64 - BITS)).astype(np.int64),
        )


def sets(texts: list[str]) -> list[np.ndarray]:
    """The different features of each text."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for numbers, found in features(texts):
        key = np.unique(numbers << BITS | found)
        edges = np.searchsorted(key, np.arange(len(texts) + 1) << BITS)
        for k in np.unique(numbers).tolist():
            out[k].append(key[edges[k] : edges[k + 1]] & (SPACE - 1))
    return [np.unique(np.concatenate(x)) if x else np.zeros(0, np.int64) for x in out]


@dataclass
class Model:
    index: np.ndarray  # sorted features with a weight
    weight: np.ndarray
    bias: float | None  # None: nothing learned

    def dense(self) -> np.ndarray:
        out = np.zeros(SPACE, np.float32)
        out[self.index] = self.weight
        return out

    def scores(self, texts: list[str], weights: np.ndarray) -> np.ndarray:
        """Each text's probability; ``weights`` is ``dense()``, kept by the caller."""
        if self.bias is None:
            return np.zeros(len(texts))
        hits = []
        for numbers, found in features(texts):
            live = weights[found] != 0
            hits.append(np.unique(numbers[live] << BITS | found[live]))
        total = np.full(len(texts), self.bias)
        if hits:
            key = np.unique(np.concatenate(hits))
            total += np.bincount(key >> BITS, weights[key & (SPACE - 1)], len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def ftrl(rows: list[np.ndarray], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Follow the regularised leader, one row after the other."""
    z, n = np.zeros(SPACE + 1), np.zeros(SPACE + 1)

    def weights(at: np.ndarray, l1: np.ndarray | float = L1) -> np.ndarray:
        zs = z[at]
        rate = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / rate)

    penalty = np.full(SPACE + 1, L1)
    penalty[SPACE] = 0.0  # the bias
    times = np.zeros(SPACE, np.int64)
    for r in rows:
        times[r] += 1
    last = np.array([SPACE], np.int32)
    for k, r in enumerate(rows):  # in place: the features left out need not be kept
        rows[k] = np.concatenate([r[times[r] >= LEAST_ROWS].astype(np.int32), last])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)).tolist():
            at = rows[k]
            w = weights(at, penalty[at])
            error = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[k]
            before = n[at]
            n[at] = before + error * error
            z[at] += error - (np.sqrt(n[at]) - np.sqrt(before)) / ALPHA * w
    w = weights(np.arange(SPACE + 1), penalty)
    index = np.flatnonzero(w[:SPACE])
    return Model(index, w[index].astype(np.float32), float(w[SPACE]))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn toxic against other rows outside the held-out remainder; see the module."""
    rows = labelled(docs, labels, "toxic", FOLD[0], FOLD[1], SAMPLE)

    def work(batch: pa.RecordBatch) -> dict:
        return {
            "one": np.zeros(batch.num_rows, np.int32),
            "doc_id": column_list(batch, "doc_id"),
            "place": column_list(batch, "place"),
            "y": column_list(batch, "y"),
            "x": sets(texts_of(batch)),
        }

    kind = dict(docs.dtypes)["doc_id"]
    rows = rows.withColumn("place", F.xxhash64("text"))
    sample = map_batches(rows, f"one int, doc_id {kind}, place bigint, y int, x array<int>", work)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "place"])
        model = ftrl(group.pop("x").tolist(), group["y"].tolist())
        return pd.DataFrame(
            {"k": [*model.index.tolist(), SPACE], "w": [*model.weight.tolist(), model.bias]}
        )

    found = sample.groupBy("one").applyInPandas(fit, "k int, w double").collect()
    found.sort(key=lambda r: r["k"])
    if not found:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), None)
    return Model(
        np.array([r["k"] for r in found[:-1]], np.int64),
        np.array([r["w"] for r in found[:-1]], np.float32),
        found[-1]["w"],
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = train(docs, labels)
    kept: list[np.ndarray] = []

    def work(batch: pa.RecordBatch) -> dict:
        if not kept:
            kept.append(model.dense())
        score = model.scores(texts_of(batch), kept[0])
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
