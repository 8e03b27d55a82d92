"""Packing documents into sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into full sequences and a rest; rests are cut into
halves of halves and dealt into groups of bounded size. In a group every piece
starts as a partial partition into k windows; the two partial partitions with
the largest imbalance are merged so that they oppose each other, until one is
left whose windows are nearly equal. If a window is beyond the capacity, k rises.
"""

from __future__ import annotations

import gc
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, slices, stage, text_buffer, workers_import_us
from .tokens import KEPT_BYTES, decoded, unit_ids

#: tokens in a sequence, pieces up to which a rest is not halved again, and windows in a group
CAPACITY, LEAST_PIECE, GROUP_WINDOWS = 2048, 64, 128
#: bytes of text encoded at once
SLICE_BYTES = 1 << 20
END = (1).to_bytes(4, "little")
#: sequences made of one full piece carry this bit and their task's number
_FULL = 1 << 62

_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, deal long")
_OUT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long")


def cuts(tokens: int, capacity: int = CAPACITY, least: int = LEAST_PIECE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full sequences, then halves of what is
    left down to ``least``. Sizes of many magnitudes let differencing even windows
    out: the large pieces fill them, the small ones settle what is uneven."""
    at = tokens - tokens % capacity
    out = [(i, capacity) for i in range(0, at, capacity)]
    while at < tokens:
        rest = tokens - at
        length = rest if rest <= least else rest - rest // 2
        out.append((at, length))
        at += length
    return out


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, least: int = LEAST_PIECE,
           kept: int = KEPT_BYTES) -> DataFrame:
    """All pieces of all documents; full ones already have a sequence of their own.

    Copies of a text that stand near each other, as a mix leaves them, are encoded once.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        collects = gc.isenabled()
        gc.disable()  # lists of many strings, none of them cyclic: each pass would walk them all
        try:
            yield from cut(batches)
        finally:
            if collects:
                gc.enable()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = unit_ids(path, kept)
        task, serial = TaskContext.get().partitionId(), 0
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            ids = batch.column(0).to_pylist()
            for lo, hi in slices(offsets, SLICE_BYTES):
                texts = decoded(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                once = dict.fromkeys(texts)
                once.update(zip(once, book.streams([book.units(t) for t in once])))
                rows = []
                for i, text in enumerate(texts, lo):
                    stream = once[text] + END
                    n = len(stream) // 4
                    for start, length in cuts(n, capacity, least):
                        code = (task << 33) + serial
                        serial += 1
                        rows.append((ids[i], start, length, zlib.crc32(stream[4 * start:4 * (start + length)]), n,
                                     _FULL | code if length == capacity else None, code))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "deal"])

    workers_import_us(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(work, tables=True), _PIECES)


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """Karmarkar-Karp: the window (0 .. k-1) of every piece, sums nearly equal.

    A partial partition is its k sums in falling order, less the smallest, with
    a piece standing for each window's pieces. While single pieces have the
    largest imbalances, opposing them only puts them into free windows, so up to
    k of them are merged at once.
    """
    if k == 1:
        return np.zeros(len(sizes), np.int64)
    parent = np.arange(len(sizes))
    heap = [(-int(x), i, None, i) for i, x in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1 or heap[0][2] is None:
        _, i, a, in_a = heapq.heappop(heap)
        if a is None:
            singles = [in_a]
            while heap and heap[0][2] is None and len(singles) < k:
                singles.append(heapq.heappop(heap)[3])
            a, in_a = np.zeros(k, np.int64), np.full(k, -1)
            a[:len(singles)], in_a[:len(singles)] = sizes[singles], singles
        else:
            _, _, b, in_b = heapq.heappop(heap)
            if b is None:
                b, in_b = np.append(sizes[in_b], np.zeros(k - 1, np.int64)), np.append(in_b, np.full(k - 1, -1))
            a, with_ = a + b[::-1], in_b[::-1]
            both = (in_a >= 0) & (with_ >= 0)
            parent[with_[both]] = in_a[both]
            in_a = np.where(in_a >= 0, in_a, with_)
            order = np.argsort(-a, kind="stable")
            a, in_a = a[order], in_a[order]
        a = a - a[-1]
        heapq.heappush(heap, (-int(a[0]), i, a, in_a))
    while True:
        above = parent[parent]
        if (above == parent).all():
            break
        parent = above
    window = np.full(len(sizes), -1)
    own = heap[0][3]
    window[own[own >= 0]] = np.flatnonzero(own >= 0)
    return window[parent]


def windows(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Windows of at most ``capacity``, as few as differencing reaches from the least possible."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = difference(sizes, k)
        if np.bincount(window, weights=sizes).max() <= capacity:
            return window
        k += 1


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, least: int = LEAST_PIECE,
         group_windows: int = GROUP_WINDOWS, kept: int = KEPT_BYTES) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Pieces are dealt into groups by the number they got in their task, not by
    their contents, so no key can fill a group.

    ``kept`` bounds what a worker's table of units may take, in bytes.

    Defined cases: a null or empty text is its end id alone; a text of any length is
    encoded whole, in one task; repeated rows are
    packed each for itself, as are rows with a null ``doc_id``; an empty table
    gives an empty result; other columns are ignored.
    """
    cut = stage(pieces(docs, path, capacity, least, kept), "pieces")
    open_ = cut.where("sequence_id is null").drop("sequence_id")
    tokens = open_.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(tokens / (group_windows * capacity)))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "deal"], ignore_index=True)
        window = windows(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = (int(pdf["grp"].iloc[0]) << 20) + window
        pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
        return pdf[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    packed = (open_.withColumn("grp", F.pmod(F.xxhash64("deal"), F.lit(groups)))
              .groupBy("grp").applyInPandas(work, _OUT))
    full = cut.where("sequence_id is not null").drop("deal").withColumn("offset", F.lit(0).cast("long"))
    return full.unionByName(packed)
