"""Benchmark decontamination by pigeonhole edit matching.

An item is found in a document where some stretch of the document is within an edit
distance of ``BUDGET`` times the item's length (at least 0 edits; both sides lower-case,
runs of white space read as one space). With k edits allowed the item is split into k + 1
pieces; at least one of them must occur unchanged, so an Aho-Corasick automaton over all
pieces finds every candidate place, and Myers' bit-parallel algorithm checks the stretch
around it. The check climbs from the piece over halves of halves to the item: of two parts
with m and n pieces and fewer than m + n edits, one has fewer edits than pieces, so a part
that has as many edits as pieces ends the check early and loses nothing. Items whose pieces would be shorter than ``PIECE`` characters get a smaller
budget (pieces of PIECE characters at least).

The benchmark goes to every task in groups whose texts add up to at most ``GROUP``
characters, the size bound of what is broadcast; a larger benchmark is more passes over
the documents, each with its own group. Documents are read whole and never shuffled.

Defined results: null or blank items match nothing; null and empty documents hold nothing;
items that repeat a text are found one by one under their own ids; rows that repeat a
document are judged alike; null ids are returned as they are; empty tables give an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.llm.common import column_list, map_batches, texts_of

BUDGET = 0.08
PIECE = 12
GROUP = 4_000_000


def plain(text: str) -> str:
    """Lower-case, white space runs as one space, none at the ends."""
    return " ".join(text.lower().split())


def budget(length: int) -> int:
    """Edits allowed for an item of this length."""
    return max(0, min(int(BUDGET * length), length // PIECE - 1))


def split(item: str, pieces: int) -> list[tuple[int, int]]:
    """(begin, end) of nearly equal pieces."""
    cuts = [len(item) * k // pieces for k in range(pieces + 1)]
    return list(zip(cuts, cuts[1:]))


Masks = dict[str, int]


def masks_of(pattern: str) -> Masks:
    """The places of each character as bits."""
    out: Masks = {}
    for k, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << k
    return out


def myers(masks: Masks, size: int, text: str, limit: int) -> tuple[int, int] | None:
    """(distance, end) of the stretch of ``text`` nearest to a pattern, within ``limit``.

    One step per character of the text on bit vectors of the pattern's length; of equal
    distances the first end counts.
    """
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, distance = full, 0, size
    best = None
    for end, c in enumerate(text, 1):
        match = masks.get(c, 0)
        zero = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | ~(zero | plus) & full
        down = plus & zero
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up = up << 1 & full  # a match may begin anywhere: the first row stays 0
        plus = (down << 1 | ~(zero | up)) & full
        minus = up & zero
        if distance <= limit and (best is None or distance < best[0]):
            best = (distance, end)
            if distance == 0:
                break
    return best


def climbs(item: str, cuts: list[tuple[int, int]]) -> list[list[tuple[int, int, int, Masks]]]:
    """Per piece: (begin, end, edits allowed, masks) of the parts above it, below the item."""
    above: list[list[tuple[int, int, int, Masks]]] = [[] for _ in cuts]

    def halve(low: int, high: int) -> None:
        if high - low < 2:
            return
        if high - low < len(cuts):
            begin, end = cuts[low][0], cuts[high - 1][1]
            part = (begin, end, high - low - 1, masks_of(item[begin:end]))
            for k in range(low, high):
                above[k].insert(0, part)
        middle = (low + high) // 2
        halve(low, middle)
        halve(middle, high)

    halve(0, len(cuts))
    return above


class Matcher:
    """Finds the items of one group in normalised texts."""

    def __init__(self, items: list[tuple[int | None, str]]) -> None:
        self.items = [(i, p) for i, t in items if (p := plain(t or ""))]
        self.pieces = ahocorasick.Automaton()
        self.masks = [masks_of(item) for _, item in self.items]
        places: dict[str, list[tuple]] = defaultdict(list)
        for number, (_, item) in enumerate(self.items):
            cuts = split(item, budget(len(item)) + 1)
            for (begin, end), parts in zip(cuts, climbs(item, cuts)):
                places[item[begin:end]].append((number, begin, parts))
        for piece, found in places.items():
            self.pieces.add_word(piece, (len(piece), found))
        if places:
            self.pieces.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int]]:
        """(item id, place in the normalised text, edits) of the nearest match of each item."""
        if not self.items:
            return []
        text = plain(text)
        best: dict[int, tuple[int, int]] = {}
        for end, (size, found) in self.pieces.iter(text):
            for number, at, parts in found:
                item = self.items[number][1]
                limit = budget(len(item))
                if number in best:
                    limit = best[number][0] - 1
                    if limit < 0:
                        continue
                start = end + 1 - size - at
                if start >= 0 and text.startswith(item, start):
                    best[number] = (0, start)
                elif limit and self._climb(text, start, parts):
                    low = max(0, start - limit)
                    stretch = text[low : start + len(item) + limit]
                    hit = myers(self.masks[number], len(item), stretch, limit)
                    if hit is not None:
                        best[number] = (hit[0], max(0, low + hit[1] - len(item)))
        return [(self.items[n][0], place, edits) for n, (edits, place) in sorted(best.items())]

    @staticmethod
    def _climb(text: str, start: int, parts: list[tuple[int, int, int, Masks]]) -> bool:
        for begin, end, edits, masks in parts:
            stretch = text[max(0, start + begin - edits) : max(0, start + end + edits)]
            if myers(masks, end - begin, stretch, edits) is None:
                return False
        return True


def groups(items: list[tuple[int | None, str]]) -> Iterator[list[tuple[int | None, str]]]:
    """Items in groups of at most GROUP characters (one item at least)."""
    group, size = [], 0
    for item in items:
        if group and size + len(item[1] or "") > GROUP:
            yield group
            group, size = [], 0
        group.append(item)
        size += len(item[1] or "")
    yield group


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, place (in the normalised text), edits: one row per document and item."""
    kinds = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, place int, edits int"

    def finder(group: list):
        kept: list[Matcher] = []

        def work(batch: pa.RecordBatch) -> dict:
            if not kept:
                kept.append(Matcher(group))
            out: dict[str, list] = {"doc_id": [], "item_id": [], "place": [], "edits": []}
            for doc_id, text in zip(column_list(batch, "doc_id"), texts_of(batch)):
                for item_id, place, edits in kept[0].find(text):
                    out["doc_id"].append(doc_id)
                    out["item_id"].append(item_id)
                    out["place"].append(place)
                    out["edits"].append(edits)
            return out

        return work

    found = None
    for group in groups(_items(benchmark)):
        part = map_batches(docs.select("doc_id", "text"), schema, finder(group))
        found = part if found is None else found.unionByName(part)
    return found


def _items(benchmark: DataFrame) -> Iterator[tuple[int | None, str]]:
    """Items one after the other, a partition at a time, in the order of their ids."""
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        yield row["item_id"], row["text"]


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text holds no item, with all their columns."""
    rows = docs
    for group in groups(_items(benchmark)):
        rows = rows.mapInArrow(_without(group), docs.schema)
    return rows


def _without(group: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(group)
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array([not matcher.find(t) for t in texts_of(batch)]))

    return run
