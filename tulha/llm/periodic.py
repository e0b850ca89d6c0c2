"""Periodic runs of words by descending-LCP Kruskal over suffix classes.

A run is a longest stretch of words that repeats with a smallest period q at least
``TIMES`` times and has ``SHORTEST`` words or more. The suffixes of a text are sorted, and
neighbours in that order are joined by decreasing length of their longest common prefix
(LCP), as Kruskal joins edges: a union-find over classes of suffixes, each with the ordered
set of its positions. When two classes are united at LCP l, the smaller set goes into the
larger one, and positions i < j that become neighbours there are at distance p = j - i.
Where p is within l, the words from i to j + l have period p, and no smaller one: with a
smaller period, position i + q would share more than l words with i, and would already
stand between them. They end where the run ends, since l is the whole common prefix. So a
seed is a run as soon as no word to its left keeps the period, and every run is seeded
exactly once, by its first position and the one a period later.

Only runs of TIMES periods and SHORTEST words count, so their seeds have l of at least
``LEAST``, the largest power of two that they cannot fall below. Suffixes are sorted by
doubling; those whose first LEAST words occur once in the text are dropped there, exactly,
and only the others are sorted to the end. Common prefixes are counted from one position to
the next, as a prefix loses at most one word. All steps take about n log n, also for a text
of one word over and over.

Many texts are sorted at once, parted by separators that equal nothing. A text is worked
whole by one task, and nothing is shuffled.

Defined results: words are what ASCII white space parts; null text has no words; a text
without a run has nulls for the best run and keeps all its words; repeated rows give
repeated results; null ids are kept; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cmp_to_key
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tulha.llm.common import column_list, map_batches

SHORTEST = 24
TIMES = 3
LEAST = 16
CHUNK = 1 << 19  # words sorted at once; a longer text is sorted alone
BLOCK = 1024

Run = tuple[int, int, int]  # start, length, period


class Positions:
    """An ordered set of integers, in sorted blocks."""

    def __init__(self, first: int) -> None:
        self.blocks = [[first]]
        self.last = [first]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        return chain.from_iterable(self.blocks)

    def add(self, value: int) -> tuple[int | None, int | None]:
        """Put in a new value; its neighbours."""
        number = min(bisect_left(self.last, value), len(self.blocks) - 1)
        block = self.blocks[number]
        at = bisect_left(block, value)
        before = block[at - 1] if at else self.last[number - 1] if number else None
        after = block[at] if at < len(block) else None  # past the end only in the last block
        block.insert(at, value)
        self.last[number] = block[-1]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[number : number + 1] = block[:BLOCK], block[BLOCK:]
            self.last[number : number + 1] = block[BLOCK - 1], block[-1]
        return before, after


def united(large: Positions, small: Positions) -> Iterator[tuple[int, int]]:
    """Put ``small`` into ``large``; the pairs of neighbours that came from different sets."""
    previous = None
    for value in small:
        before, after = large.add(value)
        # The value before it may have come from the same set, and values still to come may
        # part it from the next one, so that pair waits for them.
        if previous is not None and previous[1] is not None and previous[1] < value:
            yield previous
        if before is not None and (previous is None or before != previous[0]):
            yield before, value
        previous = value, after
    if previous[1] is not None:
        yield previous


def sorted_suffixes(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose first ``least`` words (a power of two) occur again, in the order of
    their suffixes, and which of them begin with other words than the one before.

    The last word of each text occurs nowhere else, so all suffixes differ.
    """
    count = len(words)
    order = np.argsort(words, kind="stable")
    rank = np.empty(count, np.int64)
    active, size = order, 1
    keys = words[order]
    rank[:] = 0
    head, found = np.zeros(0, np.int64), None
    while True:
        # ``active`` is sorted by its ranks and then by ``keys``: split the classes.
        place = np.arange(len(active))
        old = rank[active]
        starts = np.diff(old, prepend=-1) != 0
        split = starts.copy()
        split[1:] |= keys[1:] != keys[:-1]
        group = np.maximum.accumulate(np.where(starts, place, 0))
        part = np.maximum.accumulate(np.where(split, place, 0))
        rank[active] = old + part - group
        alone = split & np.append(split[1:], True)
        active = active[~alone]
        if size == least:
            found, head = active, rank[active].copy()
        if not len(active):
            break
        following = rank[active + size]
        order = np.argsort(rank[active] * count + following)
        active, keys = active[order], following[order]
        size *= 2
    if found is None:
        found = np.zeros(0, np.int64)
    order = np.argsort(rank[found])
    found, head = found[order], head[order]
    return found, np.diff(head, prepend=-1) != 0


def common_prefixes(words: list, order: list[int], begins: list[bool], least: int) -> list[tuple[int, int, int]]:
    """(LCP, position, position) of neighbours in ``order`` that share ``least`` words."""
    before = {b: a for (a, b), begin in zip(pairwise(order), begins[1:]) if not begin}
    out, last, length = [], -2, 0
    for i in sorted(before):
        j = before[i]
        length = max(length - 1, least) if last == i - 1 else least
        while words[i + length] == words[j + length]:
            length += 1
        out.append((length, i, j))
        last = i
    return out


def seeds(edges: list[tuple[int, int, int]]) -> Iterator[Run]:
    """(start, length, period) of all neighbours whose distance is within their LCP; their
    left side may still go on."""
    owner: dict[int, int] = {}
    sets: dict[int, Positions] = {}

    def root(k: int) -> int:
        while (up := owner.setdefault(k, k)) != k:
            owner[k] = k = owner[up]
        return k

    for length, i, j in sorted(edges, key=lambda e: -e[0]):
        large, small = root(i), root(j)
        a = sets.pop(large, None) or Positions(large)
        b = sets.pop(small, None) or Positions(small)
        if a.size < b.size:
            large, small, a, b = small, large, b, a
        for left, right in united(a, b):
            if right - left <= length:
                yield left, right - left + length, right - left
        owner[small] = large
        sets[large] = a


def runs_of(words: np.ndarray) -> list[Run]:
    """All runs of a sequence of numbered words, several texts with a unique number at the
    end of each, by start and then period."""
    order, begins = sorted_suffixes(words, LEAST)
    if not len(order):
        return []
    plain = words.tolist()
    edges = common_prefixes(plain, order.tolist(), begins.tolist(), LEAST)
    found = [
        (start, length, period)
        for start, length, period in seeds(edges)
        if length >= max(SHORTEST, TIMES * period) and (not start or plain[start - 1] != plain[start - 1 + period])
    ]
    return sorted(found, key=lambda r: (r[0], r[2]))


def best_of(runs: list[Run]) -> Run | None:
    """The run with the most periods, as an exact fraction; then the first, then the shortest
    period."""

    def order(a: Run, b: Run) -> int:
        return b[1] * a[2] - a[1] * b[2] or a[0] - b[0] or a[2] - b[2]

    return min(runs, key=cmp_to_key(order), default=None)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(depth).tolist()) if not d]


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a tenth of the documents, with a part of them over and over to the end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    loop = words[at : at + period]
    return words[:at] + (loop * -(-(n - at) // period))[: n - at]


def _groups(texts: list[list[bytes]]) -> Iterator[range]:
    """Numbers of consecutive texts, up to CHUNK words together."""
    begin, size = 0, 0
    for k, words in enumerate(texts):
        if size and size + len(words) > CHUNK:
            yield range(begin, k)
            begin, size = k, 0
        size += len(words) + 1
    if size:
        yield range(begin, len(texts))


def runs_of_texts(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text."""
    out: list[list[Run]] = [[] for _ in texts]
    for group in _groups(texts):
        known: dict[bytes, int] = {}
        numbers, starts = [], []
        for k in group:
            starts.append(len(numbers))
            numbers += [known.setdefault(w, len(known)) for w in texts[k]]
            numbers.append(-1 - k)
        for start, length, period in runs_of(np.array(numbers, np.int64)):
            k = int(np.searchsorted(starts, start, side="right")) - 1
            out[group[k]].append((start - starts[k], length, period))
    return out


Change = Callable[[list[bytes], int | None], list[bytes]]


def report(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """doc_id, n_runs, the best run, and hashes of all runs and of the text without repeats.

    ``change`` turns a text's words into those to look at.
    """

    def work(batch: pa.RecordBatch) -> dict:
        ids = column_list(batch, "doc_id")
        column = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
        texts = [(t or b"").split() for t in column.to_pylist()]  # bytes: ASCII white space only
        if change:
            texts = [change(words, i) for words, i in zip(texts, ids)]
        out: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")}
        for i, words, runs in zip(ids, texts, runs_of_texts(texts)):
            best = best_of(runs)
            start, length, period = best or (None, None, None)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
            kept = b" ".join(collapsed(words, runs))
            for name, value in (
                ("doc_id", i), ("n_runs", len(runs)), ("start", start), ("length", length), ("period", period),
                ("exponent_milli", 1000 * length // period if best else None),
                ("runs_sha256", hashlib.sha256(listed.encode()).hexdigest()),
                ("collapsed_sha256", hashlib.sha256(kept).hexdigest()),
            ):
                out[name].append(value)
        return out

    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
        "runs_sha256 string, collapsed_sha256 string"
    )
    return map_batches(docs.select("doc_id", "text"), schema, work)
