"""Helpers shared by the operators: staging, Arrow text buffers, hashing, components."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path

#: ASCII white space that separates words: space and \x09-\x0D
WHITE = "\\x20\\x09-\\x0D"
#: texts are worked on in slices of about this many bytes, cut between documents
SLICE_BYTES = 2 << 20

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ddl(schema: StructType) -> str:
    """A schema as text, whatever its columns are called."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def workers_import_us(spark: SparkSession) -> None:
    """Let Python workers import this package when it is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


#: tables that this worker holds beyond a task, by what they are for
_worker_tables: dict[Hashable, object] = {}


def worker_table(key: Hashable, make: Callable[[], object]):
    """This worker's table for ``key``; tables for anything else are given up, as a
    worker goes from one operator to the next."""
    if key not in _worker_tables:
        _worker_tables.clear()
        _worker_tables[key] = make()
    return _worker_tables[key]


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], tables: bool = False):
    """``work`` that gives memory it no longer uses back when its task ends: a worker
    waits beside its executor's others, and what its allocators keep counts there.
    Work without ``tables`` gives up those that earlier operators left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not tables:
            _worker_tables.clear()
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # glibc only
                ctypes.CDLL(None).malloc_trim(0)

    return run


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: work is done once,
    and lost executors cost only the tasks they were running."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table nobody reads any more."""
    jvm, jsc = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


# ---------------------------------------------------------------------------
# Text buffers
# ---------------------------------------------------------------------------

def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and their ``len + 1`` offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes; a longer document is alone."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(raw: np.ndarray, offsets: np.ndarray, solid: np.ndarray = ~_IS_WHITE
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (exclusive) and document numbers of all words, runs of ``solid`` bytes."""
    if len(raw) == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    solid = solid[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | first[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


# ---------------------------------------------------------------------------
# Hashing
# ---------------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every bit of the result depends on every bit of x."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span of bytes (A-Z lower-cased), from prefix sums of a
    polynomial over random byte codes; equal spans hash alike wherever they stand."""
    if len(start) == 0:
        return np.empty(0, np.uint64)
    codes = (_BYTE_CODES[_LOWER] if lower else _BYTE_CODES)[raw]
    with np.errstate(over="ignore"):
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(codes * _powers(_BASE, len(raw)), out=total[1:])
        value = (total[end] - total[start]) * _powers(_UNBASE, len(raw))[start]
        return mix64(value + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


# ---------------------------------------------------------------------------
# Pairs within groups
# ---------------------------------------------------------------------------

#: rows of a bucket that are compared in one piece, and pairs worked on at once
BLOCK, PAIRS = 1024, 1 << 17


def in_blocks(rows: DataFrame, node: str, block: int = BLOCK) -> DataFrame:
    """``rows(bucket, node, ...)`` of buckets with several rows, dealt for comparison.

    A large bucket is cut into blocks by hash and every two of its blocks meet
    under a key of their own, so no group exceeds about two blocks. ``own`` is a
    row's block; where ``cross`` is set only rows of different blocks are a pair.
    """
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    return (rows.join(counts, "bucket").withColumn("n_rows", F.ceil(F.col("n_rows") / block).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64(node, "bucket"), F.col("n_rows")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1)))
            .withColumn("cross", F.col("own") != F.col("other"))
            .withColumn("key", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")))
            .drop("bucket", "n_rows", "other"))


def whole_groups(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[pa.Table]:
    """Tables of whole groups out of batches sorted by a key: its rows never part."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch.column(column).to_numpy()
        first = int(np.searchsorted(key, key[-1]))
        if first or (held and held[-1].column(column)[-1].as_py() != key[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, first)]).combine_chunks()
            held = []
        held.append(batch.slice(first))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_pairs(key: np.ndarray, own: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions i < j of all pairs of a sorted key, about ``PAIRS`` at a time."""
    ends = np.searchsorted(key, key, side="right")
    todo = np.flatnonzero(ends - np.arange(len(key)) > 1)
    while len(todo):
        many = np.cumsum(ends[todo] - todo - 1)
        take = max(1, int(np.searchsorted(many, PAIRS, side="right")))
        rows, todo = todo[:take], todo[take:]
        reps = ends[rows] - rows - 1
        i = np.repeat(rows, reps)
        j = np.arange(len(i)) - np.repeat(np.cumsum(reps) - reps, reps) + i + 1
        ok = ~cross[i] | (own[i] != own[j])
        yield i[ok], j[ok]


# ---------------------------------------------------------------------------
# Connected components
# ---------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (smallest id reachable) of every endpoint of ``edges(a, b)``.

    Union-find as alternating star contractions: each round hangs every node's
    larger neighbours, then its smaller ones, under its smallest neighbour,
    until the forest is flat. A round aggregates partially before its shuffle
    and is staged, so a hub with very many links is never gathered in a task.
    """
    def links(df):
        return df.where("u <> v").distinct()

    def same(df):
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    current = stage(links(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "links")
    seen = same(current)
    while seen[0]:
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = links(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s")).select("s.*")
        following = stage(links(small), "links")
        now = same(following)
        drop_staged(current)
        current = following
        if now == seen:
            break
        seen = now
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
