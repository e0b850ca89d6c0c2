"""Near duplicates by b-bit MinHash: texts whose sets of 4-word shingles have a Jaccard
similarity of ``SIMILAR`` or more are linked.

Texts with equal sets are one class; only classes are compared. A class has BANDS x ROWS
minima of its set. The minima of a band are hashed to the band's key, and of each minimum
only the low ``BITS`` bits are kept, packed into longs. Classes with the same key in a band
are candidates; a pair at the threshold shares no band with a probability of
(1 - 0.8 ** ROWS) ** BANDS, about 3 in a million, and less above it. The similarity of
candidates is estimated from the count of equal low bits, corrected for the minima that
agree by chance, and pairs ``SIGMAS`` standard deviations below the threshold are left out.
All others are decided exactly, on the full sets.

Not all pairs of a band are looked at, and none is written:

1. Every class is compared with one class of each of its bands, the one with most copies.
   The links found give components. A group of near copies is mostly joined here, at one
   row per class and band.
2. Bands whose classes are still in several components are gathered, in blocks of
   ``GATHERED`` shingles at most, a task for each pair of blocks of a band. Inside a task a
   class is compared with those of other components only, all at once: sizes, then band
   keys (a pair that shares an earlier band is left to that band), then bit counts, then
   exact sizes of the intersections. Found links unite components on the spot, so a task
   returns at most one link per class. No pair of candidates stays undecided unless its
   ends are connected already.

What grows with the square of a band's classes is the bit counting inside the tasks of step
2, and only where its classes are many, alike and yet not similar.

A shingle is named by a 64-bit hash of its words, a class by 64 bits of its set.

Defined results: words are what ASCII white space parts, with A to Z in lower case; fewer
than four words are one shingle; null text is empty text; texts without a word have an
empty set, are linked with nothing and are their own component; null ids never win as
component_id (a component of null ids only has a null id, and its rows are kept); repeated
rows share a class and are all kept or all dropped; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tulha.llm.common import column_list, joined_hot, map_batches, mixed, stored
from tulha.llm.simhash import components, rooted, row_key

WIDTH = 4
SIMILAR = (80, 100)
BANDS = 32
ROWS = 5
BITS = 4
SIZE = BANDS * ROWS
SEED = 17
SIGMAS = 5.0
STEP = 1 << 14  # shingles hashed at a time
HUB = 256  # members of a band that share a copy of its hub's set
GATHERED = 1 << 20  # shingles of a block

#: A one in the lowest bit of each group of BITS bits.
LOWEST = sum(1 << k for k in range(0, 64, BITS))


@cache
def _factors() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    draw = random.integers(0, 1 << 32, (2, SIZE), np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, seed=42)


def shingles(words: list[bytes], known: dict[bytes, int], width: int = WIDTH) -> np.ndarray:
    """The sorted different hashes of the shingles; ``known`` keeps the words' hashes."""
    if not words:
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    for word in set(words).difference(known):
        known[word] = word_hash(word)
    single = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    count = len(words) - width + 1
    out = np.full(count, width, np.uint64)
    for k in range(width):
        out = mixed(out + single[k : k + count])  # of all words before, in their order
    return np.unique(out)


def minima(shingle: np.ndarray) -> np.ndarray:
    """The least value of each of SIZE hash functions over a set."""
    times, plus = _factors()
    least = np.full(SIZE, 0xFFFFFFFF, np.uint32)
    short = (shingle >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), STEP):
        turned = np.multiply.outer(short[at : at + STEP], times) + plus
        turned ^= turned >> np.uint32(15)
        np.minimum(least, turned.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band, different for different bands."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + row)
    return key.view(np.int64)


def packed(least: np.ndarray) -> np.ndarray:
    """The low BITS bits of all minima, in longs."""
    low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, 64 // BITS)
    shift = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low << shift, axis=1).view(np.int64)


def _least_equal() -> int:
    """Equal groups of bits that a pair at the threshold has at least, but for chance."""
    share = SIMILAR[0] / SIMILAR[1]
    chance = 2.0**-BITS
    # Kept bits agree where the minima do, or else by chance: E = J + (1 - J) * chance. The
    # estimate (E - chance) / (1 - chance) is compared with J by comparing counts.
    equal = share + (1 - share) * chance
    return math.floor(SIZE * equal - SIGMAS * math.sqrt(SIZE * equal * (1 - equal)))


def estimated(equal: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal groups of bits, corrected for collisions."""
    chance = 2.0**-BITS
    return (equal / SIZE - chance) / (1 - chance)


def equal_groups(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the SIZE groups of bits of packed signatures are equal."""
    unlike = (a ^ b).view(np.uint64)
    for half in (1 << k for k in range(BITS.bit_length() - 1)):
        unlike = unlike | unlike >> np.uint64(half)
    return SIZE - np.bitwise_count(unlike & np.uint64(LOWEST)).sum(axis=-1, dtype=np.int64)


def _equal_column(a: Column, b: Column) -> Column:
    """``equal_groups`` of two arrays of longs, by Spark's functions."""

    def unlike(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        for half in (1 << k for k in range(BITS.bit_length() - 1)):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, half))
        return F.bit_count(bits.bitwiseAND(F.lit(LOWEST)))

    return F.lit(SIZE) - F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda x, y: x + y)


def _alike(n: Column, m: Column) -> Column:
    """Sets of these sizes can be similar."""
    return F.least(n, m) * SIMILAR[1] >= F.greatest(n, m) * SIMILAR[0]


def similar(both: np.ndarray | int, n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | bool:
    return SIMILAR[1] * both >= SIMILAR[0] * (n + m - both)


def _words(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
    column = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
    for text in column.to_pylist():
        yield (text or b"").lower().split()  # bytes: A-Z and ASCII white space only


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, key, fp (names the set), n (its size), bands and bits of every row."""

    def work(batch: pa.RecordBatch) -> dict:
        known: dict[bytes, int] = {}
        out: dict[str, list] = {c: [] for c in ("fp", "n", "bands", "bits")}
        for words in _words(batch):
            found = shingles(words, known)
            least = minima(found)
            out["fp"].append(xxhash.xxh64_intdigest(found.tobytes(), seed=42))
            out["n"].append(len(found))
            out["bands"].append(band_keys(least))
            out["bits"].append(packed(least))
        out["fp"] = np.array(out["fp"], np.uint64).view(np.int64)
        return {"doc_id": column_list(batch, "doc_id"), "key": column_list(batch, "key"), **out}

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", "text", row_key().alias("key"))
    schema = f"doc_id {kind}, key bigint, fp bigint, n bigint, bands array<bigint>, bits array<bigint>"
    return map_batches(rows, schema, work)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (fp, key and more, one row per class) with the set of each class."""

    def work(batch: pa.RecordBatch) -> dict:
        known: dict[bytes, int] = {}
        out = {c: batch.column(batch.schema.get_field_index(c)) for c in others}
        return {**out, "members": [shingles(w, known).tobytes() for w in _words(batch)]}

    others = [c for c in wanted.columns if c != "key"]
    kinds = dict(wanted.dtypes)
    # Rows with the same id and text have the same key and the same set: one is enough.
    texts = docs.select("text", row_key().alias("key")).join(wanted, "key").dropDuplicates(["fp"])
    schema = ", ".join([f"{c} {kinds[c]}" for c in others] + ["members binary"])
    return map_batches(texts.select(*others, "text"), schema, work)


def _set_of(members: bytes) -> np.ndarray:
    return np.frombuffer(members, np.uint64)


def _with_hubs(dealt: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) links between a class and the hub of one of its bands.

    The hub's set travels once for every HUB members, under a number that only they share.
    """
    pairs = dealt.where("fp <> hub.fp").where(_alike(F.col("n"), F.col("hub.n")))
    pairs = pairs.groupBy(F.col("hub.fp").alias("a"), F.col("fp").alias("b")).agg(F.max("many").alias("many"))
    copy = F.pmod(F.xxhash64("b"), F.ceil(F.col("many") / HUB)).cast("int")
    pairs = stored(pairs.select("a", "b", copy.alias("copy")), "pairs")
    hubs = pairs.select("a", "copy").distinct()

    def joined(pairs: DataFrame, column: str) -> DataFrame:
        mine = sets.select(F.col("fp").alias("b"), F.col(column).alias("of_b"))
        hub = sets.select(F.col("fp").alias("a"), F.col(column).alias("of_a")).join(hubs, "a")
        return pairs.join(mine, "b").join(hub, ["a", "copy"])

    near = joined(pairs, "bits").where(_equal_column(F.col("of_a"), F.col("of_b")) >= _least_equal())
    near = stored(near.select("a", "b", "copy"), "candidates")

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"a": [], "b": []}
        for a, b, x, y in zip(*(column_list(batch, c) for c in ("a", "b", "of_a", "of_b"))):
            one, other = _set_of(x), _set_of(y)
            both = len(np.intersect1d(one, other, assume_unique=True))
            if similar(both, len(one), len(other)):
                out["a"].append(a)
                out["b"].append(b)
        return out

    return map_batches(joined(near, "members").select("a", "b", "of_a", "of_b"), "a bigint, b bigint", work)


class Block:
    """Classes of one band, or of two blocks of it, gathered to be compared."""

    def __init__(self, band: int, rows: list[dict]) -> None:
        self.band = band
        self.fp = [r["fp"] for r in rows]
        self.side = np.array([r["side"] for r in rows])
        self.root = np.unique([r["root"] for r in rows], return_inverse=True)[1]
        self.bands = np.array([r["bands"][:band] for r in rows], np.int64).reshape(len(rows), band)
        self.bits = np.array([r["bits"] for r in rows], np.int64)
        sets = [_set_of(r["members"]) for r in rows]
        self.n = np.array([len(s) for s in sets])
        self.ends = np.cumsum(self.n)
        self.shingle = np.unique(np.concatenate(sets), return_inverse=True)[1]  # numbered from 0
        self.mark = np.zeros(len(self.shingle) + 1, np.int64)

    def members(self, k: int) -> np.ndarray:
        return self.shingle[self.ends[k] - self.n[k] : self.ends[k]]

    def links(self, two: bool) -> list[tuple[int, int]]:
        """Links that unite all components with a similar pair; with ``two`` blocks only
        pairs across them are looked at."""
        out = []
        for k in range(1, len(self.fp)):
            other = np.flatnonzero(self.root[:k] != self.root[k])
            n = self.n[other]
            fits = np.minimum(n, self.n[k]) * SIMILAR[1] >= np.maximum(n, self.n[k]) * SIMILAR[0]
            if two:
                fits &= self.side[other] != self.side[k]
            other = other[fits]
            other = other[~(self.bands[other] == self.bands[k]).any(axis=1)]
            other = other[equal_groups(self.bits[other], self.bits[k]) >= _least_equal()]
            if not len(other):
                continue
            mine = self.members(k)
            self.mark[mine] = 1
            for part in np.array_split(other, 1 + int(self.n[other].sum()) // GATHERED):
                hit = self.mark[np.concatenate([self.members(j) for j in part])]
                starts = np.cumsum(self.n[part]) - self.n[part]
                both = np.add.reduceat(hit, starts)
                for j in part[similar(both, self.n[part], self.n[k])]:
                    if self.root[j] != self.root[k]:
                        out.append((self.fp[k], self.fp[j]))
                        self.root[self.root == self.root[j]] = self.root[k]
            self.mark[mine] = 0
        return out


def _inside(dealt: DataFrame, sets: DataFrame, found: DataFrame, gathered: int) -> DataFrame:
    """(a, b) links between classes of bands that still have several components."""
    joined = components(found).withColumnRenamed("node", "fp")
    dealt = dealt.where("many > 2").join(joined, "fp", "left")
    dealt = dealt.select("fp", "band", "number", "n", F.coalesce("root", "fp").alias("root"))
    dealt = stored(dealt, "rooted")
    apart = dealt.groupBy("band").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.sum("n").alias("total")
    )
    blocks = F.ceil(F.col("total") / gathered).cast("int")
    apart = stored(apart.where("least <> most").select("band", blocks.alias("blocks")), "apart")
    open_ = joined_hot(dealt, apart, "band").withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    open_ = open_.withColumn("other", other)
    # A block meets itself, which needs no second copy, and every other block once.
    open_ = open_.withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")})
    open_ = open_.select("fp", "root", "band", "number", "side", "low", "high")
    rows = open_.join(sets.select("fp", "bands", "bits", "members"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def links() -> list[tuple[int, int]]:
            return Block(key[3], rows).links(key[1] != key[2]) if len(rows) > 1 else []

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                at = row["band"], row["low"], row["high"], row["number"]
                if at != key:
                    out += links()
                    key, rows = at, []
                rows.append(row)
            yield _links(out)
        yield _links(links())

    parts = ("band", "low", "high", "number")
    return rows.repartition(*parts).sortWithinPartitions(*parts).mapInArrow(run, "a bigint, b bigint")


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = [pa.array([pair[k] for pair in links], pa.int64()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(ends, names=["a", "b"])


def links(docs: DataFrame, rows: DataFrame, gathered: int = GATHERED) -> DataFrame:
    """(a, b) links that connect the similar classes of ``rows`` (see _rows)."""
    first = [F.first(c).alias(c) for c in ("n", "bands", "bits")]
    classes = rows.groupBy("fp").agg(F.min("key").alias("key"), F.count("*").alias("copies"), *first)
    classes = stored(classes, "classes")
    dealt = classes.select("fp", "n", "copies", F.posexplode("bands").alias("number", "band"))
    hub = F.max(F.struct("copies", "n", "fp"))
    shared = dealt.groupBy("band").agg(F.count("*").alias("many"), hub.alias("hub")).where("many > 1")
    dealt = joined_hot(dealt.drop("copies"), stored(shared, "shared"), "band")
    dealt = stored(dealt, "bands")
    wanted = classes.join(dealt.select("fp").distinct(), "fp", "left_semi")
    sets = stored(_sets(docs, wanted.select("fp", "key", "bands", "bits")), "sets")
    found = stored(_with_hubs(dealt, sets), "similar")
    return found.unionByName(stored(_inside(dealt, sets, found, gathered), "similar"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    rows = stored(_rows(docs), "sketches")
    some = rows.where("n > 0")
    sizes = some.groupBy("fp").agg(F.first("n").alias("n_shingles"))
    named = rooted(some.select("doc_id", "key", "fp"), lambda classes: links(docs, some), sizes)
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    found = named.select("doc_id", "n_shingles", "component_id").unionByName(none)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
