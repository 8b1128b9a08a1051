"""Bounded-space online best-fit packing of token pieces (operator 6)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from roadlens.llm.common import written
from roadlens.llm.tokens import token_pieces

MAX_LEN = 2048
#: Bins that a shard holds open at a time.
OPEN_BINS = 1024
#: Pieces that a shard packs, on average; the number of shards grows with the input.
SHARD_PIECES = 30_000


class OpenBins:
    """A fixed number of open bins.  Bit ``f`` of ``free`` is set when some
    open bin has exactly ``f`` free places, so the best fit for a piece is
    the lowest set bit at or above its length, and the fullest bin (the next
    one to close) is the lowest set bit of all."""

    def __init__(self, capacity: int, max_open: int):
        self.capacity, self.max_open = capacity, max_open
        self.free, self.open, self.bins, self.made = 0, 0, [[] for _ in range(capacity + 1)], 0

    def _pop(self, space: int) -> int:
        bins = self.bins[space]
        got = bins.pop()
        if not bins:
            self.free &= ~(1 << space)
        self.open -= 1
        return got

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1..capacity places."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            at = self._pop(space)
        else:
            if self.open >= self.max_open:
                self._pop((self.free & -self.free).bit_length() - 1)  # the fullest closes
            space, at = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:  # a full bin closes at once
            self.bins[left].append(at)
            self.free |= 1 << left
            self.open += 1
        return at, self.capacity - space


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` written once with a unique number ``_row`` each."""
    return written(rows.withColumn("_row", F.monotonically_increasing_id()), "pieces")


def pack(pieces: DataFrame, length: str = "length", capacity: int = MAX_LEN, max_open: int = OPEN_BINS,
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: online best-fit in
    shards of about ``shard_pieces`` pieces, each with at most ``max_open``
    open bins.

    ``pieces`` must be a written table with a unique ``_row`` (see
    ``numbered``); every length must lie in 1..``capacity``.  Rows are dealt
    to shards by a hash of that number, so equal rows, null ids and long
    documents spread evenly, and a shard's size is bounded.  Only row numbers
    and lengths are shuffled to the packing; sequence ids are unique over all
    shards but not dense.  An empty table gives an empty result."""
    n = pieces.count()
    shards = max(1, math.ceil(n / shard_pieces))
    slim = pieces.select("_row", F.pmod(F.xxhash64("_row"), F.lit(shards)).alias("_shard"),
                       F.col(length).cast("bigint").alias("_len"))

    def best_fit(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row", kind="stable")
        bins = OpenBins(capacity, max_open)
        places = [bins.place(x) for x in pdf["_len"].tolist()]
        at = np.array(places, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"_row": pdf["_row"].to_numpy(), "sequence_id": int(key[0]) * 2 ** 32 + at[:, 0],
                             "offset": at[:, 1]})

    placed = slim.groupBy("_shard").applyInPandas(best_fit, "_row bigint, sequence_id bigint, offset bigint")
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    return pieces.select(*keep).join(placed, "_row").drop("_row")


def pack_documents(docs: DataFrame, path: str, capacity: int = MAX_LEN, end_id: int = 0, doc_id: str = "doc_id",
                   text: str = "text", max_open: int = OPEN_BINS, shard_pieces: int = SHARD_PIECES,
                   with_ids: bool = False) -> DataFrame:
    """Tokenizes and packs whole documents: one row per piece, ``(doc_id,
    piece, start, length, ids_crc32, sequence_id, offset[, ids])``.  A null
    text is an empty one (one ``end_id``); only documents longer than
    ``capacity`` are cut; null, repeated and clashing ids or columns are
    harmless; an empty table gives an empty result."""
    pieces = token_pieces(docs, path, capacity, end_id, doc_id, text, with_ids)
    return pack(numbered(pieces), capacity=capacity, max_open=max_open, shard_pieces=shard_pieces)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the packed token sequences themselves
    (``ids`` little-endian unsigned 32-bit), from ``pack_documents(...,
    with_ids=True)``.  A sequence holds at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform("_p", lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("_p"))
            .select("sequence_id", "length", joined.alias("ids")))
