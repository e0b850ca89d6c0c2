"""SimHash near-duplicates: fingerprints, BK-tree links, connected components.

A fingerprint has 64 bits from the XXH64 values of a document's 3-word shingles.
Documents with equal fingerprints are one class; only classes are compared.

Links within ``RADIUS`` bits are found in shards. With the bits in four blocks, two
fingerprints that differ in at most two bits agree in at least two blocks, so each class
is dealt to six shards, one per pair of blocks and the 32 bits found there. A shard is
held in a BK-tree (children keyed by their integer Hamming distance to the parent, only
edges within the radius followed). A shard of more than ``SHARD`` classes is not
gathered: its members go on to the next level, which splits the bits that are still free
in the same way (32, 16, 8 bits free). At the last level a shard has at most 2**8
different members, so no task meets an unbounded group and no link is lost.
Trees are small and local to a shard; they are never broadcast, since the number of
fingerprints grows with the corpus. Inside a shard only links to the neighbours' set
root are returned, at most one per member, never all pairs.

Components of the links come from alternating large-star and small-star steps, each
step stored in the shared folder.

Defined results: null text is empty text; texts without words have fingerprint zero and
link like any others; null ids never win as component id (a component of null ids only
has a null id); repeated rows share a class; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tulha.llm.common import column_list, joined_hot, joined_salted, map_batches, stored, texts_of

RADIUS = 2
SHINGLE = 3
SHARD = 1024
STEP = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the shingles' hashes; 0 without words."""
    words = text.encode().lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    width = min(shingle, len(words))
    count = len(words) - width + 1
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, STEP):
        till = min(count, at + STEP)
        pairs = zip(start[at:till].tolist(), end[at + width - 1 : till + width - 1].tolist())
        hashes = np.fromiter((digest(joined[a:b]) for a, b in pairs), "<u8", till - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * ones > count).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, key (a hash of id and text) and fp (the 64 bits, signed) of every row."""

    def work(batch: pa.RecordBatch) -> dict:
        found = [fingerprint(t, shingle) for t in texts_of(batch)]
        return {
            "doc_id": column_list(batch, "doc_id"),
            "key": column_list(batch, "key"),
            "fp": np.array(found, np.uint64).view(np.int64),
        }

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", "text", row_key().alias("key"))
    return map_batches(rows, f"doc_id {kind}, key bigint, fp bigint", work)


def row_key() -> Column:
    """Rows with the same id and text have the same key."""
    return F.xxhash64("doc_id", "text")


class BKTree:
    """Different integers; a child hangs on the edge of its distance to the parent."""

    def __init__(self) -> None:
        self.nodes: list[int] = []
        self.edges: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Numbers of the nodes within the radius."""
        found, open_ = [], [0] if self.nodes else []
        while open_:
            node = open_.pop()
            distance = (value ^ self.nodes[node]).bit_count()
            if distance <= radius:
                found.append(node)
            edges = self.edges[node]
            for edge in range(max(1, distance - radius), distance + radius + 1):
                if edge in edges:
                    open_.append(edges[edge])
        return found

    def add(self, value: int) -> None:
        number = len(self.nodes)
        node = 0
        while number:
            distance = (value ^ self.nodes[node]).bit_count()
            if distance == 0:
                return
            following = self.edges[node].setdefault(distance, number)
            if following == number:
                break
            node = following
        self.nodes.append(value)
        self.edges.append({})


def shard_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """(member, root) links that connect what is within the radius inside a shard."""
    tree, parent = BKTree(), []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for value in dict.fromkeys(values):
        own = len(parent)
        parent.append(own)
        for near in tree.near(value, radius):
            parent[root(near)] = root(own)
        tree.add(value)
    return [(v, tree.nodes[r]) for k, v in enumerate(tree.nodes) if (r := root(k)) != k]


def _dealt(rows: DataFrame, width: int) -> DataFrame:
    """Six shards per row: two of the four blocks of the free bits become part of the key."""
    mask = (1 << width) - 1
    block = [F.shiftrightunsigned("free", k * width).bitwiseAND(F.lit(mask)) for k in range(4)]
    shards = []
    for number, (i, j) in enumerate(combinations(range(4), 2)):
        m, n = (k for k in range(4) if k not in (i, j))
        bits = F.shiftleft(F.shiftleft(F.col("bits"), width).bitwiseOR(block[i]), width)
        shards.append(
            F.struct(
                (F.col("path") * 6 + number).alias("path"),
                bits.bitwiseOR(block[j]).alias("bits"),
                F.shiftleft(block[m], width).bitwiseOR(block[n]).alias("free"),
                "fp",
            )
        )
    return rows.select(F.explode(F.array(*shards)).alias("s")).select("s.*")


def _tree_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links of shards that lie sorted, one after the other, in each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, values = None, []
        for batch in batches:
            links = []
            for path, bits, value in zip(*(column_list(batch, c) for c in ("path", "bits", "fp"))):
                if (path, bits) != key:
                    links += shard_links(values, radius)
                    key, values = (path, bits), []
                values.append(value & (1 << 64) - 1)
            yield _link_batch(links)
        yield _link_batch(shard_links(values, radius))

    together = rows.repartition("path", "bits").sortWithinPartitions("path", "bits")
    return together.select("path", "bits", "fp").mapInArrow(run, "a bigint, b bigint")


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ends[:, 0], pa.int64()), pa.array(ends[:, 1], pa.int64())], names=["a", "b"]
    )


def links(classes: DataFrame, shard: int = SHARD) -> DataFrame:
    """(a, b) links that connect all fingerprints of ``classes`` (fp) within the radius."""
    rows = classes.select(
        F.lit(0).alias("path"), F.lit(0).cast("long").alias("bits"), F.col("fp").alias("free"), "fp"
    )
    found = []
    for width, last in ((16, False), (8, False), (4, True)):
        dealt = _dealt(rows, width)
        counted = dealt.groupBy("path", "bits").agg(F.count("*").alias("n")).where("n > 1")
        dealt = stored(dealt.join(counted, ["path", "bits"]), "shards")
        small = dealt if last else dealt.where(F.col("n") <= shard)
        found.append(_tree_links(small, RADIUS))
        rows = dealt.where(F.col("n") > shard).drop("n")
        if last or rows.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b), root the smallest node reachable."""
    edges = stored(edges, "edges")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = joined_salted(both, least, "a", "b").where("b > a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            joined_salted(large, least, "a", "b")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("s"))
            .select(F.col("s.b").alias("a"), F.col("s.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, key, fp, component_id and root (the component's fingerprint) of every row."""
    return rooted(stored(fingerprints(docs), "fingerprints"), links)


def rooted(
    rows: DataFrame, link: Callable[[DataFrame], DataFrame], more: DataFrame | None = None
) -> DataFrame:
    """``rows`` (doc_id, key, fp) with component_id and root, by the links between classes,
    and with the columns of ``more`` (one row per fp)."""
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = components(link(classes)).withColumnRenamed("node", "fp").join(classes, "fp")
    roots = classes.withColumnRenamed("fp", "root").join(
        linked.groupBy("root").agg(F.min("least").alias("reached")), "root"
    )
    roots = roots.select("root", F.least("least", "reached").alias("component_id"))
    inner = joined_salted(linked, roots, "root", "fp").select("fp", "root", "component_id")
    whole = roots.select(F.col("root").alias("fp"), "root", "component_id").unionByName(inner)
    named = classes.join(whole, "fp", "left").select(
        "fp",
        F.coalesce("component_id", "least").alias("component_id"),
        F.coalesce("root", "fp").alias("root"),
    )
    if more is not None:
        named = named.join(more, "fp")
    return joined_hot(rows, stored(named, "components"), "fp")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component of near duplicates; see keep_one."""
    return keep_one(docs, near_duplicates(docs))


def keep_one(docs: DataFrame, named: DataFrame) -> DataFrame:
    """One row of each component of ``named`` (doc_id, key, root), with all its columns: the
    smallest id (null ids last), then the smallest key; of equal rows one."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    kept = named.groupBy("root").agg(F.min(order).alias("k"))
    kept = kept.select(F.col("k.key").alias("key")).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col("doc_id").alias("id"), row_key().alias("key"))
    rows = rows.join(kept, "key", "left_semi").dropDuplicates(["key", "id"])
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
