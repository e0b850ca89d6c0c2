"""Removal of long repeated strings: equal windows are found by narrowing groups.

A suffix matters only through its first ``LENGTH`` bytes, its window. The plain radix sort
by most-significant-digit passes starts with a row for each byte of the corpus, some
16 bytes of digit and place for one byte of text, which is over six times what a pass may
shuffle here. So digits are not taken from the front, and nothing is put in order: a digit
is content that equal windows have in common, chosen so that neighbouring windows share it
and travel as one row as long as they can. Each pass splits the groups of the one before by
more of the window, until members of a group are equal windows, and drops members that are
alone as early as possible:

1. The first digit of a window is its anchor: the ``GRAM``-byte string in it with the
   least hash (the first of equals). Equal windows have equal anchors at equal places.
   Neighbouring windows share an anchor, so a row is an anchor with the run of its
   windows. An anchor without a second row is dropped before anything else. Rows with
   the same anchor and the same bytes under their whole run are copies: all their windows
   repeat, and one of them stands for all from here on.
2. Runs are cut to ``BUCKET`` neighbouring windows. The digit is the bytes that all
   windows of the bucket have in common; again rows with the same bytes under the whole
   bucket are copies, and rows alone with their digit are dropped.
3. What is left is split into single windows, and the digit is the whole window.

Digits are compared by hashes of 128 bits in all (64 of the group, 64 of the content; the
last pass 128 of the window). Counting combines on the map side and members are marked by
a join, so no group, however large, is gathered in one task. A passage that a third of
the corpus shares is one class after the first pass. Whole texts are shuffled twice,
compressed: to the rows that pass 2 needs, and to the marks in the end.

Passages of over 50 words take the same way with words ``[^\\x20\\x09-\\x0D]+`` for bytes:
windows of ``WORDS`` words, anchors of ``WORD_GRAM`` words, and after the first pass single
windows, from the same shuffle of the texts. They are often shorter than LENGTH bytes, so
nothing is removed for them; a text is only marked if another document, one with another
id or another text, has a window of it too. Texts marked by the first pass are settled, and
only anchors that some other text has are looked at again.

Defined results: null text is empty text; texts under LENGTH bytes keep all their bytes;
a repeated row is an occurrence of its own, so two equal rows of LENGTH bytes lose all;
null ids are kept as they are; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tulha.llm.common import column_list, map_batches, stored, word_hashes

LENGTH = 400
GRAM = 64
BUCKET = 12
WORDS = 51  # words of the least passage of over 50
WORD_GRAM = 8
CHUNK = 1 << 20  # windows turned into arrays at a time
PLACE = np.uint64((1 << 22) - 1)
WORD, GAP = re.compile(rb"[^\x20\x09-\x0D]+"), re.compile(rb"[\x20\x09-\x0D]")
#: By byte: 0 for what parts words.
WORD_BYTES = np.array([0 if GAP.match(bytes([k])) else k + 1 for k in range(256)], np.uint16)


def _stir(values: np.ndarray) -> np.ndarray:
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(32)
    return values


def _string_hashes(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all strings of the sizes (powers of two), by doubling."""
    hashes = _stir((data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    out, size = [], 1
    while size < sizes[-1]:
        hashes = _stir(hashes[:-size] * np.uint64(0xBF58476D1CE4E5B9 + 2 * size) + hashes[size:])
        size *= 2
        if size in sizes:
            out.append(hashes)
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each stretch of ``width`` values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(
    data: np.ndarray, valid: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place, first and last window, digit and content hash of each run of windows with
    one anchor; windows that are not ``valid`` belong to no run."""
    count = len(data) - length + 1
    wide = 1 << (length.bit_length() - 1)
    short, long = _string_hashes(data, (gram, wide))
    key = (short & ~PLACE) | np.arange(len(short), dtype=np.uint64)
    place = (_least(key, length - gram + 1) & PLACE).astype(np.int64)
    place[~valid[:count]] = -1
    first = np.flatnonzero(np.diff(place, prepend=-2))
    last = np.append(first[1:], count) - 1
    own = place[first] >= 0
    first, last = first[own], last[own]
    at = place[first]

    def window(i: np.ndarray) -> np.ndarray:
        return _stir(long[i] * np.uint64(0xD6E8FEB86659FD93) + long[i + length - wide])

    shape = (at - first).astype(np.uint64) << np.uint64(20) | (last - at + length).astype(np.uint64)
    content = _stir(window(first) * np.uint64(0xA24BAED4963EE407) + window(last))
    content = _stir(content + shape * np.uint64(0x9FB21C651E98DF25))
    return at, first, last, short[at], content


def _pieces(
    texts: list[bytes] | list[np.ndarray], length: int
) -> Iterator[tuple[list[tuple[int, int, bytes | np.ndarray]], int]]:
    """Groups of (text number, place, bytes or word hashes), about CHUNK of them together;
    long texts are cut so that each window is whole in one piece."""
    group, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, CHUNK):
            piece = text[at : at + CHUNK + length - 1]
            group.append((number, at, piece))
            size += len(piece)
            if size >= CHUNK:
                yield group, size
                group, size = [], 0
    if group:
        yield group, size


def _bytes_of(batch: pa.RecordBatch) -> list[bytes]:
    column = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
    return [t or b"" for t in column.to_pylist()]


def _compressed(rows: DataFrame) -> DataFrame:
    """The rows with their text as a compressed column ``z``: less to shuffle and keep."""
    others = [c for c in rows.columns if c != "text"]

    def work(batch: pa.RecordBatch) -> dict:
        press = zstandard.ZstdCompressor(level=3)
        out = {c: column_list(batch, c) for c in others}
        return {**out, "z": [press.compress(t) for t in _bytes_of(batch)]}

    kinds = dict(rows.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in others] + ["z binary"])
    return map_batches(rows, schema, work)


def _plain(batch: pa.RecordBatch) -> list[bytes]:
    open_ = zstandard.ZstdDecompressor()
    return [open_.decompress(z) for z in column_list(batch, "z")]


def _anchor_rows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(r1, r2, p, l, span, k, h): anchors of every text, places from its begin."""

    def work(batch: pa.RecordBatch) -> dict:
        r1, r2 = (np.array(column_list(batch, c), np.int64) for c in ("r1", "r2"))
        out: dict[str, list] = {c: [np.zeros(0, np.int64)] for c in ("r1", "r2", "p", "l", "span", "k", "h")}
        for group, size in _pieces(_bytes_of(batch), length):
            data = np.frombuffer(b"".join(piece for _, _, piece in group), np.uint8)
            ends = np.cumsum([len(piece) for _, _, piece in group])
            valid = np.ones(size, bool)
            for end in ends:
                valid[max(0, end - length + 1) : end] = False
            at, first, last, k, h = anchors(data, valid, length, gram)
            owner = np.searchsorted(ends, at, side="right")
            number = np.array([n for n, _, _ in group])[owner]
            shift = np.array([a for _, a, _ in group])[owner] - np.append(0, ends)[owner]
            for name, values in (
                ("r1", r1[number]), ("r2", r2[number]), ("p", at + shift), ("l", first + shift),
                ("span", last - first), ("k", k.view(np.int64)), ("h", h.view(np.int64)),
            ):
                out[name].append(values)
        return {name: np.concatenate(parts) for name, parts in out.items()}

    schema = "r1 bigint, r2 bigint, p int, l int, span int, k bigint, h bigint"
    return map_batches(rows.select("r1", "r2", "text"), schema, work)


def _blocks(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Groups of (text number, slice) of about CHUNK bytes together; no word is cut."""
    block, size = [], 0
    for number, text in enumerate(texts):
        if len(text) > CHUNK:  # a longer word would be a slice without bound
            text = WORD.sub(lambda m: m[0] if len(m[0]) <= CHUNK else _digest(m[0]), text)
        at = 0
        while at < len(text):
            gap = GAP.search(text, at + CHUNK)
            end = gap.end() if gap else len(text)
            block.append((number, text[at:end]))
            size += end - at
            at = end
            if size >= CHUNK:
                yield block
                block, size = [], 0
    if block:
        yield block


def _digest(word: bytes) -> bytes:
    return xxhash.xxh3_128_hexdigest(word).encode()


def _word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """The hash of each word of each text."""
    out: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)] for _ in texts]
    for block in _blocks(texts):
        data = np.frombuffer(b"".join(part + b"\n" for _, part in block), np.uint8)
        sizes = [len(part) + 1 for _, part in block]
        part = np.repeat(np.arange(len(block), dtype=np.int32), sizes)
        hashes, owner, _, _ = word_hashes(WORD_BYTES[data], part)
        cuts = np.cumsum(np.bincount(owner, minlength=len(block)))[:-1]
        for (number, _), words in zip(block, np.split(hashes, cuts)):
            out[number].append(words)
    return [np.concatenate(parts) for parts in out]


def _word_rows(rows: DataFrame, words: int, gram: int) -> DataFrame:
    """(r1, r2, l, span, k, h): anchors of every text's words, places in words."""

    def work(batch: pa.RecordBatch) -> dict:
        r1, r2 = (np.array(column_list(batch, c), np.int64) for c in ("r1", "r2"))
        out: dict[str, list] = {c: [np.zeros(0, np.int64)] for c in ("r1", "r2", "l", "span", "k", "h")}
        for group, size in _pieces(_word_hashes(_bytes_of(batch)), words):
            ends = np.cumsum([len(piece) for _, _, piece in group])
            valid = np.ones(size, bool)
            for end in ends:
                valid[max(0, end - words + 1) : end] = False
            data = np.concatenate([piece for _, _, piece in group])
            _, first, last, k, h = anchors(data, valid, words, gram)
            owner = np.searchsorted(ends, first, side="right")
            number = np.array([n for n, _, _ in group])[owner]
            shift = np.array([a for _, a, _ in group])[owner] - np.append(0, ends)[owner]
            for name, values in (
                ("r1", r1[number]), ("r2", r2[number]), ("l", first + shift), ("span", last - first),
                ("k", k.view(np.int64)), ("h", h.view(np.int64)),
            ):
                out[name].append(values)
        return {name: np.concatenate(parts) for name, parts in out.items()}

    schema = "r1 bigint, r2 bigint, l int, span int, k bigint, h bigint"
    return map_batches(rows.select("r1", "r2", "text"), schema, work)


def _of_several(rows: DataFrame, *digit: str) -> DataFrame:
    """The digits that more than one document has."""
    ends = rows.groupBy(*digit).agg(F.min("r1").alias("low"), F.max("r1").alias("high"))
    return ends.where("low < high").select(*digit)


def _passages(rows: DataFrame, words: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Texts (r1, r2) that share a whole run of word windows with another document, and the
    runs (r1, r2, l, span) whose windows tell for the others."""
    runs = stored(_word_rows(rows, words, gram), "words")
    several = stored(_of_several(runs, "k"), "several")  # else the join splits no skewed key
    runs = stored(runs.join(several, "k"), "passages")
    one = [F.first(c).alias(c) for c in ("r1", "r2", "l", "span")]
    ends = F.min("r1").alias("low"), F.max("r1").alias("high")
    classes = stored(runs.groupBy("k", "h").agg(*ends, *one), "classes")
    copies = classes.where("low < high").select("k", "h")
    found = stored(runs.join(copies, ["k", "h"]).select("r1", "r2").distinct(), "found")
    left = runs.join(found, ["r1", "r2"], "left_anti").select("k").distinct()
    return found, classes.join(left, "k").select("r1", "r2", "l", "span")


def _contested(classes: DataFrame, digit: str, times: str) -> DataFrame:
    """Classes whose digit has another class and a member that is not known to repeat."""
    digits = classes.groupBy(digit).agg(F.count("*").alias("c"), F.min(times).alias("least"))
    return classes.join(digits.where("c > 1 and least = 1").select(digit), digit)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _near_rows(
    rows: DataFrame, need: DataFrame, length: int, passages: DataFrame | None, words: int
) -> DataFrame:
    """(rep, r1, r2, p, l, span, n, near, w1, w2): the bytes under each needed run; for runs
    of ``passages`` a row without bytes for the hash of each window."""
    least = length
    if passages is not None:
        none = F.lit(None)
        need = need.select("r1", "r2", "p", "l", "span", "n").unionByName(
            passages.select("r1", "r2", none.cast("int").alias("p"), "l", "span", none.cast("long").alias("n"))
        )
        least = min(length, 2 * words - 1)
    lists = need.groupBy("r1", "r2").agg(F.collect_list(F.struct("p", "l", "span", "n")).alias("a"))
    names = ("r1", "r2", "p", "l", "span", "n", "near", "w1", "w2")

    def work(batch: pa.RecordBatch) -> dict:
        found: list[tuple] = []
        columns = (column_list(batch, c) for c in ("r1", "r2", "a"))
        for text, r1, r2, runs in zip(_plain(batch), *columns):
            split = text.split() if any(run["p"] is None for run in runs) else []
            for run in runs:
                p, l, span = run["p"], run["l"], run["span"]
                if p is not None:
                    found.append((r1, r2, p, l, span, run["n"], text[l : l + span + length], None, None))
                    continue
                for at in range(l, l + span + 1):
                    w = xxhash.xxh3_128_intdigest(b" ".join(split[at : at + words]))
                    w1, w2 = _signed(w >> 64), _signed(w & (1 << 64) - 1)
                    found.append((r1, r2, None, None, None, None, None, w1, w2))
        return dict(zip(names, zip(*found))) if found else {c: [] for c in names}

    schema = (
        "r1 bigint, r2 bigint, p int, l int, span int, n bigint, near binary, w1 bigint, w2 bigint"
    )
    long = rows.where(F.octet_length("text") >= least).select("r1", "r2", "text")
    found = map_batches(_compressed(long).join(lists, ["r1", "r2"]), schema, work)
    return stored(found.withColumn("rep", F.monotonically_increasing_id()), "near")


def _bucket_rows(reps: DataFrame, length: int, bucket: int) -> DataFrame:
    """(i, o, rep, a, b, n): buckets of windows a to b, digit i, content o."""

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("i", "o", "rep", "a", "b", "n")}
        columns = (column_list(batch, c) for c in ("rep", "p", "l", "span", "n", "near"))
        for rep, p, l, span, n, near in zip(*columns):
            place = p - l  # windows begin 0 to span here; their distance to the anchor counts
            for number in range((place - span) // bucket, place // bucket + 1):
                low, high = number * bucket, number * bucket + bucket - 1
                a, b = max(0, place - high), min(span, place - low)
                inner = near[place - low : place - high + length]
                outer = near[a : b + length]
                out["i"].append(_signed(xxhash.xxh3_64_intdigest(inner, seed=number)))
                seed = (place - a) << 32 | (place - b)
                out["o"].append(_signed(xxhash.xxh3_64_intdigest(outer, seed=seed)))
                out["rep"].append(rep)
                out["a"].append(a)
                out["b"].append(b)
                out["n"].append(n)
        return out

    schema = "i bigint, o bigint, rep bigint, a int, b int, n bigint"
    chosen = reps.select("rep", "p", "l", "span", "n", "near")
    return stored(map_batches(chosen, schema, work), "buckets")


def _window_rows(reps: DataFrame, need: DataFrame, length: int) -> DataFrame:
    """(w1, w2, rep, a, m): single windows."""
    lists = need.groupBy("rep").agg(F.collect_list(F.struct("a", "b", "m")).alias("runs"))

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("w1", "w2", "rep", "a", "m")}
        for rep, near, runs in zip(*(column_list(batch, c) for c in ("rep", "near", "runs"))):
            for run in runs:
                for a in range(run["a"], run["b"] + 1):
                    found = xxhash.xxh3_128_intdigest(near[a : a + length])
                    out["w1"].append(_signed(found >> 64))
                    out["w2"].append(_signed(found & (1 << 64) - 1))
                    out["rep"].append(rep)
                    out["a"].append(a)
                    out["m"].append(run["m"])
        return out

    schema = "w1 bigint, w2 bigint, rep bigint, a int, m bigint"
    return map_batches(reps.select("rep", "near").join(lists, "rep"), schema, work)


def marks(
    rows: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET
) -> DataFrame:
    """(r1, r2, a, b): stretches of texts under windows that occur elsewhere too."""
    return _marks(rows, length, gram, bucket, None, 0)[0]


def marks_and_passages(rows: DataFrame, length: int, words: int) -> tuple[DataFrame, DataFrame]:
    """``marks``, and (r1, r2) of the texts with a window of words of another document."""
    found, need = _passages(rows, words, WORD_GRAM)
    stretches, near = _marks(rows, length, GRAM, BUCKET, need, words)
    windows = near.where("w1 is not null").select("r1", "r2", "w1", "w2")
    late = windows.join(_of_several(windows, "w1", "w2"), ["w1", "w2"]).select("r1", "r2")
    return stretches, found.unionByName(late)


def _marks(
    rows: DataFrame, length: int, gram: int, bucket: int, passages: DataFrame | None, words: int
) -> tuple[DataFrame, DataFrame]:
    runs = stored(_anchor_rows(rows, length, gram), "anchors")
    several = runs.groupBy("k").agg(F.count("*").alias("c")).where("c > 1").select("k")
    runs = stored(runs.join(stored(several, "several"), "k"), "runs")  # else no skewed key is split
    one = [F.first(c).alias(c) for c in ("r1", "r2", "p", "l", "span")]
    classes = stored(runs.groupBy("k", "h").agg(F.count("*").alias("n"), *one), "classes")
    copies = runs.join(classes.where("n > 1").select("k", "h"), ["k", "h"])
    found = copies.select("r1", "r2", F.col("l").alias("a"), (F.col("l") + F.col("span") + length).alias("b"))

    near = _near_rows(rows, _contested(classes, "k", "n"), length, passages, words)
    reps = near.where("near is not null").drop("w1", "w2")
    buckets = _bucket_rows(reps, length, bucket)
    one = [F.first(c).alias(c) for c in ("rep", "a", "b")]
    classes = stored(buckets.groupBy("i", "o").agg(F.sum("n").alias("m"), *one), "classes")
    copies = buckets.where("n = 1").join(classes.where("m > 1").select("i", "o"), ["i", "o"])
    inner = copies.select("rep", "a", (F.col("b") + length).alias("b"))

    windows = stored(_window_rows(reps, _contested(classes, "i", "m"), length), "windows")
    counted = windows.groupBy("w1", "w2").agg(F.count("*").alias("c")).where("c > 1")
    copies = windows.where("m = 1").join(counted, ["w1", "w2"])
    inner = inner.unionByName(copies.select("rep", "a", (F.col("a") + length).alias("b")))

    places = reps.select("rep", "r1", "r2", "l").join(inner, "rep")
    places = places.select("r1", "r2", (F.col("l") + F.col("a")).alias("a"), (F.col("l") + F.col("b")).alias("b"))
    return found.unionByName(places), near


def _united(stretches: DataFrame) -> DataFrame:
    """Maximal runs of each text's stretches, by a window that can spill: a text that
    repeats all over has a stretch per byte, which no row could hold."""
    before = Window.partitionBy("r1", "r2").orderBy("a", "b")
    reach = F.max("b").over(before.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("a") <= reach, 0).otherwise(1)
    numbered = stretches.withColumn("fresh", fresh)
    number = F.sum("fresh").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = numbered.withColumn("run", number).groupBy("r1", "r2", "run")
    return runs.agg(F.min("a").alias("a"), F.max("b").alias("b"))


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def report(docs: DataFrame, length: int = LENGTH, words: int = 0) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; with ``words`` also
    shared_passage, 1 if another document has a passage of so many words of it."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select("doc_id", text)
    rows = rows.withColumns(
        {"r1": F.xxhash64("doc_id", "text"), "r2": F.xxhash64(F.lit(1), "text", "doc_id")}
    )
    if words:
        found, passages = marks_and_passages(rows, length, words)
        none = F.lit(None).cast("int")
        passages = passages.select("r1", "r2", none.alias("a"), none.alias("b"))
        lists = _united(found).select("r1", "r2", "a", "b").unionByName(passages)
    else:
        lists = _united(marks(rows, length))
    stretch = F.when(F.col("a").isNotNull(), F.struct("a", "b"))  # lists leave nulls out
    lists = lists.groupBy("r1", "r2").agg(
        F.collect_list(stretch).alias("runs"), F.max(F.col("a").isNull().cast("int")).alias("shared")
    )

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {
            c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "shared_passage")
        }
        columns = (column_list(batch, c) for c in ("doc_id", "runs", "shared"))
        for content, doc_id, runs, shared in zip(_plain(batch), *columns):
            spans = merged([(r["a"], r["b"]) for r in runs or ()])
            kept, last = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(content[last:a])
                last = b
            kept.update(content[last:])
            out["doc_id"].append(doc_id)
            out["n_bytes"].append(len(content))
            out["n_removed"].append(sum(b - a for a, b in spans))
            out["n_spans"].append(len(spans))
            out["kept_sha256"].append(kept.hexdigest())
            out["shared_passage"].append(shared or 0)
        return out

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    schema += ", shared_passage int" if words else ""
    whole = _compressed(rows).join(lists, ["r1", "r2"], "left").select("doc_id", "z", "runs", "shared")
    return map_batches(whole, schema, work)
