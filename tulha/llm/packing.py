"""Vector best-fit packing of tokenised documents into sequences.

A document is its ids by a public tokenizer and a closing id. Documents longer than a
sequence are cut into whole sequences and one shorter first piece, so only pieces below
the sequence length compete for room. A sequence has three capacities: tokens, documents
and attention cost (sum of squared lengths). Pieces go, longest first, to the open
sequence that fits them under every capacity and leaves the smallest weighted norm of
the residuals.

With the default limits, which op8 and the pipeline use, only the tokens bind: a piece has
at least one token and a sum of squares never exceeds the squared sum, so documents and
attention cost only weigh in the norm. Smaller limits bind where a caller gives them.

Scale: texts are read once; what is stored and shuffled is one short row per piece.
Pieces are dealt by a hash of their place to packs of about ``PACK`` pieces, each packed
by one task. A pack leaves less than a sequence's worth of room in its last sequences, a
loss of under 0.05 % at this size, and no task grows with the corpus.

Defined results: a null text is an empty one and is a piece of one token; rows with a null
or repeated id are packed like any others; ties go to the sequence opened first; an empty
table gives an empty result; other columns of the documents are not read.
"""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array
from collections.abc import Callable
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.llm.common import column_list, map_batches, stored, texts_of

VOCABULARY = "byte_bpe_50k"
LENGTH = 2048
CLOSING = np.zeros(1, "<u4").tobytes()
PACK = 8192

#: Runs of white space need a look ahead; without them the plain rule splits alike, faster.
RUN = re.compile(r"\s\s")
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


@cache
def _tokenizer(vocabulary: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(str(public_tokenizers.path(f"{vocabulary}.json")))


@cache
def _coders(vocabulary: str) -> tuple[Callable[[str], list[int]], Callable[[str], list[int]]]:
    """Encoders by the same vocabulary as ranks: for texts without runs, and for all."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain, full = (
        tiktoken.Encoding(vocabulary, pat_str=p, mergeable_ranks=ranks, special_tokens={})
        for p in (PLAIN, public_tokenizers.PATTERN)
    )
    return plain.encode_ordinary, full.encode_ordinary


def _packed_ids(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def encode(text: str, vocabulary: str = VOCABULARY) -> bytes:
    """Ids of a text as little-endian 32-bit numbers, as ``tokenizers`` gives them.

    The same vocabulary in the rank form encodes several times faster; a text that may
    hold a special token goes to ``tokenizers`` itself.
    """
    if "<|" in text:
        ids = _tokenizer(vocabulary).encode(text, add_special_tokens=False).ids
    else:
        ids = _coders(vocabulary)[bool(RUN.search(text))](text)
    return _packed_ids(ids)


def pieces(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc_id, text in zip(column_list(batch, "doc_id"), texts_of(batch)):
            ids = encode(text, vocabulary) + CLOSING
            total = len(ids) // 4
            start = 0
            piece = 0
            while start < total:
                size = min(length, total) if start else (total % length or length)
                out["doc_id"].append(doc_id)
                out["piece"].append(piece)
                out["start"].append(start)
                out["length"].append(size)
                out["ids_crc32"].append(zlib.crc32(ids[4 * start : 4 * (start + size)]))
                start += size
                piece += 1
        return out

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_batches(docs.select("doc_id", "text"), schema, work)


def best_fit(
    lengths: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item, by vector best-fit decreasing.

    A sequence that cannot take the shortest item any more is closed, so the search
    touches open sequences only.
    """
    limit = np.array(capacity, float)
    scale = np.array(weights, float) / limit
    order = np.argsort(-lengths, kind="stable")
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    left = np.zeros((len(lengths), 3))
    name = np.zeros(len(lengths), np.int64)
    opened = made = 0
    least = int(lengths.min()) if len(lengths) else 0
    for item in order:
        size = int(lengths[item])
        need = np.array([size, 1.0, float(size) * size])
        room = left[:opened] - need
        fits = np.flatnonzero(room.min(axis=1) >= 0) if opened else ()
        if len(fits):
            rest = room[fits] * scale
            place = int(fits[np.argmin(np.einsum("ij,ij->i", rest, rest))])
            left[place] = room[place]
        else:
            place = opened
            left[place] = limit - need
            name[place] = made
            opened += 1
            made += 1
        sequence[item] = name[place]
        offset[item] = limit[0] - left[place, 0] - size
        if left[place, 0] < least or left[place, 1] < 1:
            opened -= 1
            left[place : opened] = left[place + 1 : opened + 1]
            name[place : opened] = name[place + 1 : opened + 1]
    return sequence, offset


def pack(
    rows: DataFrame,
    length: int = LENGTH,
    max_documents: int = LENGTH,
    max_attention: float = float(LENGTH) ** 2,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
) -> DataFrame:
    """Add sequence_id and offset to stored rows with a length up to ``length``.

    Whole-length rows are packed like the others: they fill a sequence each. A row whose
    own squared length exceeds ``max_attention`` gets a sequence of its own.
    """
    total = rows.count()
    packs = max(1, -(-total // PACK))
    names = rows.columns
    place = F.xxhash64(F.monotonically_increasing_id())  # repeated rows spread like others
    numbered = rows.withColumn("_pack", F.pmod(place, F.lit(packs)).cast("int"))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "ids_crc32", "start"], ascending=[False, True, True])
        group = group.reset_index(drop=True)
        sequence, offset = best_fit(
            group["length"].to_numpy(np.int64), (length, max_documents, max_attention), weights
        )
        number = int(group["_pack"].iloc[0])
        group["sequence_id"] = sequence * packs + number
        group["offset"] = offset
        return group[[*names, "sequence_id", "offset"]]

    return numbered.groupBy("_pack").applyInPandas(
        run, f"{schema}, sequence_id bigint, offset bigint"
    )


def packed(docs: DataFrame, **options: object) -> DataFrame:
    """Tokenise, cut and pack documents; see the module."""
    return pack(stored(pieces(docs), "pieces"), **options)
