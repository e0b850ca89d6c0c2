"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed letter n-grams (one to three letters, runs of other
characters read as one gap): square-rooted counts times inverse document frequency,
scaled to length one. Each language has up to ``CLUSTERS`` centroids; a text takes the
language of the centroid with the largest cosine. It is rejected where that cosine is
below the floor of the language for texts of its size. Sizes are classes by powers of two
of the number of n-grams; the floor of a class is ``FLOOR`` times the cosine that all but
a hundredth of its training texts reach, and never above the floor of a larger class.
The cosines are those of sampled texts and of beginnings of them, 16 to 4,000 characters
long, to centroids of the half of the sample without the text. A class of fewer than
``LEAST`` texts takes the next smaller classes with it; where all smaller ones together
have fewer, nothing with a letter is rejected. A language of fewer than ``LEAST`` texts
has half the thousandth quantile of its cosines as floor, at most ``CEILING``.

Training reads whole texts of all learnable rows once: document frequencies cover all of
them, added up per task; the clustering gets a sample of at most about ``SAMPLE`` rows
per language (by the hash of id and text; rows equal in both count once) and a beginning of
each, a documented bound, so one task per language holds 2 x SAMPLE vectors of DIMS numbers
at most, however often an id or a row repeats. The model is languages x CLUSTERS x DIMS
numbers, whatever the corpus.

Defined results: null texts and texts without a letter are ``und`` with score 0, and are
rejected; without anything to learn from every text is ``und``; ties go to the language
first by name; a null id is not held out and not learned from; repeated rows give repeated
results; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.llm.common import (
    chance, chunks, code_points, column_list, letter_table, map_batches, remainder, share, stored,
    texts_of,
)

DIMS = 4096
CLUSTERS = 4
SAMPLE = 1000
FLOOR = 0.6
CEILING = 0.15
CLASSES = 40
LEAST = 100
UNKNOWN = "und"
FOLD = (4, 2)  # modulus and held-out remainder


def counts(texts: list[str]) -> np.ndarray:
    """Hashed n-gram counts, one row per text; a text without letters has only zeros."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for numbers, parts in chunks(texts):
        codes, part = code_points(parts)
        letters = letter_table()[codes]
        keep = letters != 0
        keep[1:] |= letters[:-1] != 0
        letters, part = letters[keep], part[keep]
        if not letters.any():
            continue
        owner = np.array(numbers, np.int64)[part]
        one = letters * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ letters[1:]) * np.uint32(0x85EBCA77)
        three = (two[:-1] ^ letters[2:]) * np.uint32(0xC2B2AE3D)
        first, last = numbers[0], numbers[-1]
        total = np.zeros((last - first + 1) * DIMS)
        for size, grams in ((1, one), (2, two), (3, three)):
            place = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x27D4EB2F + 2 * size)
            place = (place >> np.uint32(20)).astype(np.int64) + (owner[: len(grams)] - first) * DIMS
            inside = letters[: len(grams)] != 0
            for k in range(1, size):
                inside |= letters[k : len(grams) + k] != 0
            inside &= part[: len(grams)] == part[size - 1 :]
            total += np.bincount(place[inside], minlength=len(total))
        out[first : last + 1] += total.reshape(-1, DIMS).astype(np.float32)
    return out


@dataclass
class Model:
    languages: list[str]  # by centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray  # by centroid and class of size

    def vectors(self, found: np.ndarray) -> np.ndarray:
        return scaled(np.sqrt(found) * self.idf)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine (0 to 1) and rejection of each text."""
        found = counts(texts)
        lettered = found.any(axis=1)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = self.vectors(found) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1).astype(float) * lettered
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        return names, score, ~lettered | (score < self.floors[best, sizes(found)])


def sizes(found: np.ndarray) -> np.ndarray:
    """The class of each row of counts."""
    total = np.maximum(found.sum(axis=1, dtype=np.float64), 1)
    return np.minimum(np.log2(total).astype(int), CLASSES - 1)


def beginning(text: str, place: int) -> str:
    """16 to 4,000 characters, or nothing where that would be the whole text."""
    size = (16 + place // 8 % 16) << place % 8
    return text[:size] if size < len(text) else ""


def scaled(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    return (rows / np.where(norm > 0, norm, 1)).astype(np.float32)


def clustered(rows: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Centroids of spherical k-means, begun with rows far from one another."""
    centers = [scaled(rows.sum(axis=0, keepdims=True))[0]]
    while len(centers) < min(clusters, len(rows)):
        nearest = (rows @ np.array(centers).T).max(axis=1)
        centers.append(rows[int(nearest.argmin())])
    found = np.array(centers)
    for _ in range(rounds):
        own = (rows @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, own, rows)
        empty = ~sums.any(axis=1)
        found = np.where(empty[:, None], found, scaled(sums))
    return found


def floors(vectors: np.ndarray, size: np.ndarray, owner: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The floor of each class of size, from texts and their beginnings; ``owner`` tells
    which text a row belongs to."""
    cosine = np.zeros(len(vectors))
    for half in (0, 1):
        own = owner % 2 == half
        if own.any() and (whole & ~own).any():
            centers = clustered(vectors[whole & ~own], CLUSTERS)
            cosine[own] = (vectors[own] @ centers.T).max(axis=1)
    if len(vectors) < LEAST:
        centers = clustered(vectors[whole], CLUSTERS)
        least = np.quantile((vectors[whole] @ centers.T).max(axis=1), 0.001)
        return np.full(CLASSES, min(0.5 * float(least), CEILING))
    out = np.zeros(CLASSES)
    for k in range(CLASSES):
        first = next((j for j in range(k, -1, -1) if ((size >= j) & (size <= k)).sum() >= LEAST), None)
        if first is not None:
            out[k] = FLOOR * np.quantile(cosine[(size >= first) & (size <= k)], 0.01)
    return np.minimum.accumulate(out[::-1])[::-1]


def sampled(known: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Vectors of the rows of ``known`` whose chance is under their language's limit, each
    row's own and its beginning's; without a language, the document frequencies of a task.

    Rows equal in id and text have one chance: a task gives them once, and so does the
    aggregate of whoever gathers them by ``lang`` and ``n``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, rows = np.zeros(DIMS), 0
        given = set()
        for batch in batches:
            kept = [
                (t, lang, place)
                for t, lang, place in zip(*(column_list(batch, c) for c in ("text", "lang", "place")))
                if t
            ]
            if not kept:
                continue
            found = counts([k[0] for k in kept])
            frequency += (found > 0).sum(axis=0)
            rows += len(kept)
            chosen = []
            for k, (_, lang, at) in enumerate(kept):
                if at < limits[lang] and (lang, at) not in given:
                    given.add((lang, at))
                    chosen.append(k)
            names = [kept[k][1] for k in chosen]
            yield _sums(names, found[chosen], [2 * kept[k][2] for k in chosen])
            begun = counts([beginning(kept[k][0], kept[k][2]) for k in chosen])
            yield _sums(names, begun, [2 * kept[k][2] + 1 for k in chosen])
        yield _sums([None], frequency[None], [rows])

    rows = known.select("text", "lang", chance(2, "doc_id", "text").alias("place"))
    return stored(rows.mapInArrow(work, "lang string, v array<float>, n bigint"), "language")


def train(docs: DataFrame) -> Model:
    """Learn from text and lang of rows outside the held-out remainder; see the module."""
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & (remainder("doc_id", FOLD[0]) != FOLD[1])
    )
    totals = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not totals:
        return Model([], np.zeros((0, DIMS)), np.ones(DIMS), np.zeros((0, CLASSES)))
    out = sampled(known, {k: share(SAMPLE, n) for k, n in totals.items()})
    sums = (
        out.where(F.col("lang").isNull())
        .select("n", F.posexplode("v").alias("k", "x"))
        .groupBy("k")
        .agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
        .collect()
    )
    frequency, rows = np.zeros(DIMS), sums[0]["n"] if sums else 0
    for r in sums:
        frequency[r["k"]] = r["x"]
    idf = np.log((1 + rows) / (1 + frequency)) + 0.1

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        found = np.array(group["v"].tolist(), np.float32)
        some = found.any(axis=1)
        found, number = found[some], group["n"].to_numpy()[some]
        vectors, whole = scaled(np.sqrt(found) * idf), number % 2 == 0
        if not whole.any():
            return pd.DataFrame({"lang": [], "v": [], "floor": []}, dtype=object)
        centers = clustered(vectors[whole], CLUSTERS)
        floor = floors(vectors, sizes(found), number // 256, whole).tolist()
        return pd.DataFrame(
            {
                "lang": group["lang"].iloc[0],
                "v": [c.tolist() for c in centers],
                "floor": [floor] * len(centers),
            }
        )

    fitted = (
        out.where(F.col("lang").isNotNull())
        .groupBy("lang", "n")
        .agg(F.first("v").alias("v"))
        .select("lang", "v", "n")
        .groupBy("lang")
        .applyInPandas(fit, "lang string, v array<float>, floor array<double>")
        .collect()
    )
    fitted.sort(key=lambda r: r["lang"])
    return Model(
        [r["lang"] for r in fitted],
        np.array([r["v"] for r in fitted], np.float32).reshape(-1, DIMS),
        idf,
        np.array([r["floor"] for r in fitted]).reshape(-1, CLASSES),
    )


def _sums(langs: list, vectors: np.ndarray, rows: list[int]) -> pa.RecordBatch:
    flat = pa.array(np.ascontiguousarray(vectors, np.float32).ravel())
    offsets = pa.array(np.arange(len(langs) + 1, dtype=np.int32) * DIMS)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(langs, pa.string()),
            pa.ListArray.from_arrays(offsets, flat),
            pa.array(rows, pa.int64()),
        ],
        names=["lang", "v", "n"],
    )


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row."""

    def work(batch: pa.RecordBatch) -> dict:
        names, score, rejected = model.predict(texts_of(batch))
        return {
            "doc_id": column_list(batch, "doc_id"),
            "lang_pred": names,
            "score": score,
            "rejected": rejected,
        }

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    return map_batches(docs.select("doc_id", "text"), schema, work)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rejected = model.predict(texts_of(batch))[2]
                yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(work, docs.schema)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    held = F.coalesce(remainder("doc_id", FOLD[0]) == FOLD[1], F.lit(False))
    return identify(docs, train(docs)).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "rejected"
    )
