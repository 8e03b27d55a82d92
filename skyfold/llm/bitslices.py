"""Ranked lexical search on bit-sliced Bloom signatures.

A document's signature is a Bloom filter of its terms, each entered once for
every power of two up to its frequency. Documents of one signature size are
laid side by side in blocks and stored by bit: slice ``i`` is a bitmap of the
documents whose signature has bit ``i``. And-ing the slices of a term's bits gives
the documents that may hold it (at least so often), never fewer; with the weight
that each frequency can be worth at most, summed slices bound every score from
above. An item's threshold is the tenth exact score among the documents with
the highest bounds; then all documents whose bound reaches it are scored exactly.

Terms are known by 64-bit hashes; two of an item's terms and a corpus's would
have to collide to change a result (chance below 1e-6 for 1e9 terms).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean, mix64, slices, span_hashes, stage, text_buffer, word_spans, workers_import_us

#: bytes of terms: ASCII letters and digits, and all of other characters
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: least bits a signature has for an element (at most twice as many), bits that an element sets,
#: bits of a block, and documents of a block at most
ELEMENT_BITS, HASHES, BLOCK_BITS, BLOCK_DOCS = 8, 5, 1 << 22, 512
#: answers of an item, documents of the highest bounds that give its threshold, items
#: and bytes of items searched in one pass
TOP, PROBES, PASS_ITEMS, PASS_BYTES = 10, 32, 256, 8 << 20

_LEVEL = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------------------
# Terms and scores
# ---------------------------------------------------------------------------

def document_terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and frequency of every distinct term, by document; terms of each document with repeats."""
    start, end, doc = word_spans(raw, offsets, TERM_BYTES)
    h = span_hashes(raw, start, end)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    return doc[at], h[at], np.diff(np.append(at, len(h))), np.bincount(doc, minlength=len(offsets) - 1)


def terms_of(column: pa.Array) -> Iterator[tuple[int, int, tuple]]:
    """``document_terms`` of a column of texts, a slice ``lo:hi`` at a time."""
    raw, offsets = text_buffer(column)
    for lo, hi in slices(offsets):
        yield lo, hi, document_terms(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def damping(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """A document's m, by its number of terms."""
    return 100 - 75 + (75 * n.astype(np.int64) * documents) // max(terms, 1)


def worth(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's weight is multiplied by; it grows with its frequency."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass
class Items:
    """The terms of some items and what the corpus says of them."""

    names: list            # (item_id, copies) of every item
    hashes: np.ndarray     # distinct terms of all items, ascending
    bounds: np.ndarray     # of each item's entries
    term: np.ndarray       # an entry's term, its place in hashes
    times: np.ndarray      # its repeats in the item
    documents: int = 0
    terms: int = 0
    value: np.ndarray | None = None  # an entry's weight, by its repeats

    @staticmethod
    def of(rows: list) -> Items:
        texts = pa.array([r.text for r in rows], pa.string())
        item, h, tf = [], [], []
        for lo, _, (doc, hashes, times, _) in terms_of(texts):
            item.append(doc + lo)
            h.append(hashes)
            tf.append(times)
        none = np.empty(0, np.int64)
        item, h, tf = (np.concatenate([none.astype(t), *x]) for x, t in
                       ((item, np.int64), (h, np.uint64), (tf, np.int64)))
        distinct, term = np.unique(h, return_inverse=True)
        return Items([(r.item_id, r.copies) for r in rows], distinct,
                     np.searchsorted(item, np.arange(len(rows) + 1)), term.reshape(-1), tf)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are terms of the items, and their places."""
        if not len(self.hashes):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        return hit, at[hit]

    def weighted(self, documents: int, terms: int, df: dict[int, int]) -> None:
        self.documents, self.terms = documents, terms
        w = np.array([weight(documents, df.get(t, 0)) for t in range(len(self.hashes))], np.int64)
        self.value = self.times * (w[self.term] if len(w) else 0)

    def scores(self, level: np.ndarray) -> np.ndarray:
        """Every item's score from what each term is worth."""
        total = np.append(0, np.cumsum(self.value * level[self.term]))
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def statistics(docs: DataFrame, items: Items) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, terms of all of them, and the documents that hold each of the items' terms."""
    shared = docs.sparkSession.sparkContext.broadcast(items.hashes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Items([], shared.value, *[np.empty(0, np.int64)] * 3)
        df, documents, terms = np.zeros(len(own.hashes), np.int64), 0, 0
        for batch in batches:
            for _, _, (_, h, _, n) in terms_of(batch.column(0)):
                df += np.bincount(own.find(h)[1], minlength=len(df))
                documents += int((n > 0).sum())
                terms += int(n.sum())
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, [-1, -2])), pa.array(np.append(df[at], [documents, terms]))], names=["term", "n"])

    counted = docs.select("text").mapInArrow(lean(work), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in counted.collect()}  # a row a term of the items
    return found.pop(-1, 0), found.pop(-2, 0), found


# ---------------------------------------------------------------------------
# Signatures
# ---------------------------------------------------------------------------

def positions(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bits of the element (term, level) in a signature of ``bits`` (a power of two): ``[n, HASHES]``."""
    with np.errstate(over="ignore"):
        h = mix64(hashes + np.uint64(level) * _LEVEL)
        step = (h >> np.uint64(32)) | np.uint64(1)
        at = h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]
    return (at & np.uint64(bits - 1)).astype(np.int64)


class _Block:
    """Signatures of one size, until there are enough of them."""

    def __init__(self, bits: int):
        self.bits, self.room = bits, max(8, min(BLOCK_DOCS, BLOCK_BITS // bits))
        self.clear()

    def clear(self) -> None:
        self.rows = np.zeros((self.bits, self.room), bool)
        self.docs: list[tuple[int, int, int]] = []

    def row(self) -> list:
        return [self.bits, *map(list, zip(*self.docs)), np.packbits(self.rows[:, :len(self.docs)], axis=1).tobytes()]


_INDEX = "bits int, docs array<long>, n array<long>, most array<long>, slices binary"


def index(docs: DataFrame) -> DataFrame:
    """Bit slices of the signatures of ``docs(doc, text)`` that have terms, in blocks.

    A block holds at most ``BLOCK_BITS`` bits (8 documents, where one alone has more);
    a task holds one unfinished block of every size. ``most`` is a document's highest
    frequency.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}

        def told(rows: list[list]) -> pa.RecordBatch:
            kinds = (pa.int32(), *[pa.list_(pa.int64())] * 3, pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                              names=["bits", "docs", "n", "most", "slices"])

        for batch in batches:
            key = batch.column(0).to_numpy()
            for lo, _, (doc, h, tf, n) in terms_of(batch.column(1)):
                levels = np.frexp(tf)[1]  # 1 + log2
                elements = np.bincount(doc, levels, len(n)).astype(np.int64)
                most = np.zeros(len(n), np.int64)
                np.maximum.at(most, doc, tf)
                at = np.searchsorted(doc, np.arange(len(n) + 1))
                for d in np.flatnonzero(n):
                    bits = max(64, 1 << int(elements[d] * ELEMENT_BITS - 1).bit_length())
                    block = blocks.get(bits) or blocks.setdefault(bits, _Block(bits))
                    own, often = h[at[d]:at[d + 1]], levels[at[d]:at[d + 1]]
                    for level in range(int(often.max())):
                        block.rows[positions(own[often > level], level, bits), len(block.docs)] = True
                    block.docs.append((int(key[lo + d]), int(n[d]), int(most[d])))
                    if len(block.docs) == block.room:
                        yield told([block.row()])
                        block.clear()
        for block in blocks.values():
            if block.docs:
                yield told([block.row()])

    workers_import_us(docs.sparkSession)
    return docs.select("doc", "text").mapInArrow(lean(work), _INDEX)


def upper_bounds(items: Items, bits: int, n: np.ndarray, most: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """An upper bound of every item's score in every document of a block: ``[items, documents]``."""
    m = damping(n, items.documents, items.terms)
    total = np.zeros((len(items.names), len(n)))
    before, level = None, 0
    while (most >= 1 << level).any():
        at = positions(items.hashes, level, bits)
        may = packed[at[:, 0]]
        for k in range(1, HASHES):
            may = may & packed[at[:, k]]
        if before is not None:
            may &= before  # held 2**level times, so 2**(level - 1) times too
        some = may.any(axis=1)
        if not some.any():
            break
        # a term at this level and none above is held at most 2**(level + 1) - 1 times
        more = worth(np.minimum((2 << level) - 1, most), m) - worth(np.minimum((1 << level) - 1, most), m)
        row = np.cumsum(some) - 1
        held = np.unpackbits(may[some], axis=1, count=len(n)).astype(np.float64)
        for i in range(len(items.names)):
            lo, hi = items.bounds[i], items.bounds[i + 1]
            own = some[items.term[lo:hi]]
            if own.any():
                total[i] += (items.value[lo:hi][own] @ held[row[items.term[lo:hi][own]]]) * more
        before, level = may, level + 1
    return total * (1 + 1e-9)  # doubles may round below the exact sum


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(len(batch)):
            bits = batch.column(0)[k].as_py()
            docs, n, most = (batch.column(c)[k].values.to_numpy() for c in (1, 2, 3))
            packed = np.frombuffer(batch.column(4)[k].as_buffer(), np.uint8).reshape(bits, -1)
            yield bits, docs, n, most, packed


def _wanted(item: np.ndarray, doc: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(doc.astype(np.int64)), pa.array(bound)],
                                      names=["item", "doc", "bound"])


_WANTED = "item int, doc long, bound double"


def highest_bounds(blocks: DataFrame, items: Items, probes: int = PROBES) -> DataFrame:
    """``item, doc`` of every item's ``probes`` highest bounds; a task passes on as many an item."""
    shared = blocks.sparkSession.sparkContext.broadcast(items)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best, keys = np.zeros((len(own.names), probes)), np.zeros((len(own.names), probes), np.int64)
        for bits, docs, n, most, packed in _blocks(batches):
            both = np.concatenate([best, upper_bounds(own, bits, n, most, packed)], axis=1)
            pick = np.argpartition(-both, probes - 1, axis=1)[:, :probes]
            best = np.take_along_axis(both, pick, axis=1)
            keys = np.take_along_axis(np.concatenate([keys, np.broadcast_to(docs, (len(own.names), len(docs)))], axis=1),
                                      pick, axis=1)
        item, at = np.nonzero(best > 0)
        yield _wanted(item, keys[item, at], best[item, at])

    told = blocks.mapInArrow(lean(work), _WANTED)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "doc"))
    return told.withColumn("rank", rank).where(F.col("rank") <= probes).select("item", "doc").distinct()


def reaching(blocks: DataFrame, items: Items, threshold: np.ndarray) -> DataFrame:
    """``item, doc`` of all documents whose bound is not below the item's threshold."""
    shared = blocks.sparkSession.sparkContext.broadcast((items, threshold))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least = shared.value
        for bits, docs, n, most, packed in _blocks(batches):
            bound = upper_bounds(own, bits, n, most, packed)
            item, at = np.nonzero((bound >= least[:, None]) & (bound > 0))
            yield _wanted(item, docs[at], bound[item, at])

    return blocks.mapInArrow(lean(work), _WANTED).select("item", "doc").distinct()


# ---------------------------------------------------------------------------
# Search
# ---------------------------------------------------------------------------

def exact_scores(docs: DataFrame, wanted: DataFrame, items: Items) -> DataFrame:
    """``item, doc_id, score`` of the rows of ``docs(doc, doc_id, text)`` that are ``wanted(item, doc)``."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    asked = wanted.groupBy("doc").agg(F.collect_set("item").alias("asked"))  # at most PASS_ITEMS an item list

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids, lists = batch.column(0), batch.column(2)
            for lo, hi, (doc, h, tf, n) in terms_of(batch.column(1)):
                hit, term = own.find(h)
                m = damping(n, own.documents, own.terms)
                at = np.searchsorted(doc[hit], np.arange(hi - lo + 1))
                item, score, row = [], [], []
                for d in range(hi - lo):
                    mine = slice(at[d], at[d + 1])
                    level = np.zeros(len(own.hashes), np.int64)
                    level[term[mine]] = worth(tf[hit[mine]], m[d])
                    want = lists[lo + d].values.to_numpy()
                    item.append(want)
                    score.append(own.scores(level)[want])
                    row.append(np.full(len(want), lo + d))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(item).astype(np.int32)), ids.take(pa.array(np.concatenate(row))),
                     pa.array(np.concatenate(score))], names=["item", "doc_id", "score"])

    return (docs.join(asked, "doc").select("doc_id", "text", "asked")
            .mapInArrow(lean(work), "item int, doc_id long, score long").where("score > 0"))


def _best(scored: DataFrame, top: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top)


def _passes(items: DataFrame) -> Iterator[list]:
    """Distinct items with their number of copies, a bounded number and size at a time."""
    distinct = stage(items.select(F.col("item_id").cast("long"), "text").groupBy("item_id", "text")
                     .agg(F.count("*").alias("copies")), "items")
    n, size = distinct.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    passes = max(1, -(-n // PASS_ITEMS), -(-(size or 0) // PASS_BYTES))
    for k in range(passes):
        rows = distinct.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).orderBy("item_id", "text").collect()
        if rows:
            yield rows


def search(docs: DataFrame, items: DataFrame, top: int = TOP, probes: int = PROBES) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``top`` documents of every row of ``items``.

    The slices are built once; items are searched in passes of a bounded number, each
    of which reads the slices twice. Documents are scored where they lie: the wanted
    ones reach the scan of the texts as a join that Spark broadcasts while it is small
    and sorts beyond that.

    Defined cases: null texts, empty ones and those without terms count and are found
    nowhere, and such items have no rows; rows that repeat an id, or an id and a text,
    are documents of their own with ranks of their own; equal scores go by ascending
    doc_id, null last; an item row that is repeated has its rows as often; a text of
    any length is one signature that grows with its distinct terms; empty tables give
    an empty result; other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    workers_import_us(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumn("doc", F.xxhash64("doc_id", "text"))
    blocks, found = None, None
    for rows in _passes(items):
        own = Items.of(rows)
        own.weighted(*statistics(docs, own))
        if not own.documents:
            break
        if blocks is None:
            blocks = stage(index(docs), "slices")
        first = _best(exact_scores(docs, F.broadcast(highest_bounds(blocks, own, probes)), own), top)
        threshold = np.zeros(len(rows), np.int64)
        for r in first.where(F.col("rank") == top).collect():  # one row an item of this pass
            threshold[r.item] = r.score
        wanted = stage(reaching(blocks, own, threshold), "wanted")
        best = _best(exact_scores(docs, wanted, own), top).select("item", "rank", "doc_id", "score")
        names = spark.createDataFrame([(k, i, c) for k, (i, c) in enumerate(own.names)], "item int, item_id long, copies long")
        best = (best.join(F.broadcast(names), "item").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
                .select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
        found = best if found is None else found.unionAll(best)
    if found is None:
        found = docs.selectExpr("0L as item_id", "0 as rank", "doc_id", "0L as score").where("false")
    return found


#: DuckDB SQL for the rows of the query
ORACLE = r"""
with t as (select doc_id, row_number() over () as r, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x{0}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) as term from documents),
  tf as materialized (select r, any_value(doc_id) as doc_id, term, count(*) as tf from t group by r, term),
  doc as (select r, sum(tf)::bigint as n from tf group by r),
  total as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from doc),
  df as (select term, count(*) as df from tf group by term),
  m as (select r, 100 - 75 + (75 * n * n_docs) // n_terms as m from doc, total),
  q as (select k, any_value(item_id) as item_id, term, count(*) as times from (
      select row_number() over () as k, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x{0}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) as term from benchmark) group by k, term),
  w as (select q.k, q.item_id, q.term, q.times,
      floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)::double))::bigint as w from q join df using (term), total),
  s as (select k, any_value(item_id) as item_id, r, any_value(doc_id) as doc_id,
      sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
    from w join tf using (term) join m using (r) group by k, r)
select item_id, (row_number() over (partition by k order by score desc, doc_id nulls last))::integer as rank, doc_id, score
from s where score > 0
qualify row_number() over (partition by k order by score desc, doc_id nulls last) <= 10
"""
