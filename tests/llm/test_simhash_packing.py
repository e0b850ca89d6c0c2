"""SimHash and packing against brute force and exact round trips; odd rows."""

import random
import zlib

import numpy as np
import pytest
import xxhash

from tulha.llm import packing, queries, simhash
from tulha.llm.common import table

ODD = [
    (1, None), (2, ""), (3, " \t\n"), (None, "one two"), (4, "one two"), (4, "one two"), (5, "ONE\x0btwo"),
    (6, "word " * 30_000), (7, "é É ß"), (None, None),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, key int, fp string")


def plain_fingerprint(text):
    """The contract word by word."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    root = list(range(len(ids)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(ids))]


def check(df):
    rows = df.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    want = zip(rows, prints, brute_components([r.doc_id for r in rows], prints))
    found = simhash.near_duplicates(df).collect()
    got = sorted(f"{r.doc_id} {r.fp & (1 << 64) - 1:016x} {r.component_id}" for r in found)
    assert got == sorted(f"{r.doc_id} {p:016x} {c}" for r, p, c in want)


@pytest.mark.parametrize("rows", [ODD, []])
def test_simhash_odd_rows(spark, rows):
    check(frame(spark, rows))


def test_simhash_whole_table(spark, folder):
    docs = table(spark, folder, "documents")
    check(docs)
    row = queries.op4_simhash(spark, folder).first()
    assert len(row.fingerprint) == 16 and row.asDict().keys() == {"doc_id", "fingerprint", "component_id"}


@pytest.mark.parametrize("shard", [4, 1024])
def test_links_join_all_near_fingerprints(spark, shard):
    """Also where shards are too large for a tree and go on to further bits."""
    draw = random.Random(4)
    prints = {draw.getrandbits(64) for _ in range(40)}
    for center in list(prints)[:4]:
        for _ in range(40):
            prints.add(center ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64))
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), shard)
    found = {r.node & (1 << 64) - 1: r.root for r in simhash.components(edges).collect()}
    want = brute_components(list(range(len(prints))), prints)
    groups = {}
    for k, p in enumerate(prints):
        groups.setdefault(want[k], set()).add(found.get(p, p if p < 1 << 63 else p - (1 << 64)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)


def test_bk_tree_equals_scan():
    draw = random.Random(5)
    tree, values = simhash.BKTree(), []
    for _ in range(400):
        value = draw.getrandbits(12)
        tree.add(value)
        values.append(value)
    assert len(tree.nodes) == len(set(values))
    for value in values[:100]:
        near = {tree.nodes[k] for k in tree.near(value, 2)}
        assert near == {v for v in values if (v ^ value).bit_count() <= 2}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 160)]
    found = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(k, 1) for k in range(2, 61)} | {(k, 100) for k in range(101, 160)}


def sample_texts():
    draw = random.Random(6)
    parts = ["a", "é", "'s", "\n", " ", "  ", "\t", "1", "#", "\xa0", "\x85", "漢", "\x1c", ". ", "Don't", "<|", "|>"]
    odd = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(5000)]
    return odd + ["", "<|endoftext|> x", "a b ²³ 漢字 　 y"]


def test_ids_equal_the_tokenizer(spark, folder):
    texts = sample_texts() + [r.text for r in table(spark, folder, "documents").limit(60).collect()]
    want = packing._tokenizer(packing.VOCABULARY).encode_batch(texts, add_special_tokens=False)
    for text, ids in zip(texts, want):
        assert packing.encode(text) == np.array(ids.ids, "<u4").tobytes()


def check_packing(rows, texts, length):
    by_row, by_sequence = {}, {}
    for r in rows:
        by_row.setdefault(str(r.doc_id), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id in {str(i) for i, _ in texts}:
        want = []
        for text in (t for i, t in texts if str(i) == doc_id):
            ids = packing.encode(text or "") + packing.CLOSING
            total, start, piece = len(ids) // 4, 0, 0
            while start < total:
                size = (total % length or length) if not start else length
                crc = zlib.crc32(ids[4 * start : 4 * (start + size)])
                want.append((piece, start, size, crc))
                start, piece = start + size, piece + 1
        got = [(r.piece, r.start, r.length, r.ids_crc32) for r in by_row[doc_id]]
        assert sorted(got) == sorted(want)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by_sequence)


@pytest.mark.parametrize("rows", [ODD, []])
def test_packing_odd_rows(spark, rows):
    found = packing.packed(frame(spark, rows)).collect()
    assert check_packing(found, rows, packing.LENGTH) >= bool(rows)


def test_packing_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = packing.packed(docs).collect()
    sequences = check_packing(rows, texts, packing.LENGTH)
    least = sum(r.length for r in rows) / packing.LENGTH
    assert least <= sequences <= 1.005 * least + 1


def test_every_capacity_holds():
    draw = np.random.default_rng(8)
    lengths = draw.integers(1, 90, 400)
    capacity = (100.0, 3.0, 5000.0)
    sequence, offset = packing.best_fit(lengths, capacity, (1.0, 0.5, 0.5))
    for s in np.unique(sequence):
        own = lengths[sequence == s]
        assert own.sum() <= 100 and len(own) <= 3
        assert (own**2).sum() <= 5000 or len(own) == 1
        order = np.argsort(offset[sequence == s])
        assert (np.append(0, np.cumsum(own[order]))[:-1] == offset[sequence == s][order]).all()
