"""MinHash near-duplicates by SuperMinHash signatures.

Every shingle walks its own pseudo-random permutation of the signature's
positions, one step per round; round ``j`` offers rank ``j + r`` (r uniform in
[0, 1)) to the position it reaches. The ranks of one element at different
positions are correlated, which lowers the variance of the estimate, and a
document stops early: once all its positions hold ranks below ``j + 1`` no later
round can change them. Positions are then banded, candidates verified on full
shingle sets, and verified links grouped into components.

Defined cases: null or empty texts, and texts of white space alone, have no
shingles and link with nothing; texts of fewer words than a shingle count as
one shingle; repeated rows share a set and so a component; rows without an id
link with nothing and are kept; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (components, group_pairs, in_blocks, lean, mix64, slices, span_hashes, stage, text_buffer,
                     whole_groups, word_spans, workers_import_us)

#: words in a shingle, and the least similarity of a link in hundredths
SHINGLE_WORDS, PERCENT = 5, 75
#: positions in a band, and bands: a pair at similarity 0.75 shares no band
#: with probability (1 - 0.75**6)**60 = 8e-6, at 0.8 with 1e-8
BAND_ROWS, BANDS = 6, 60
#: deviations of the estimate below the threshold at which a pair is not compared
DEVIATIONS = 4.0
#: rounds after which the few elements still walking get an explicit permutation
LAZY_ROUNDS = 24
WALK_ELEMENTS = 20_000

_ODD = mix64(np.arange(11, 11 + 64, dtype=np.uint64)) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int = SHINGLE_WORDS
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every document, ascending, and their
    ``len + 1`` offsets. Shingles are told apart by 64-bit hashes."""
    start, end, doc = word_spans(raw, offsets)
    code = span_hashes(raw, start, end)
    n_docs = len(offsets) - 1
    counts = np.bincount(doc, minlength=n_docs)
    with np.errstate(over="ignore"):
        if len(code) >= words:
            last = len(code) - words + 1
            value = code[:last] * _ODD[0]
            for k in range(1, words):
                value = value + code[k:k + last] * _ODD[k]
            whole = doc[:last] == doc[words - 1:]
            value, owner = mix64(value[whole]), doc[:last][whole]
        else:
            value, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
        short = (counts[doc] < words) if len(doc) else np.empty(0, bool)
        if short.any():
            first = np.searchsorted(doc, doc[short])
            place = np.flatnonzero(short) - first
            part = code[short] * _ODD[place]
            docs, group = np.unique(doc[short], return_inverse=True)
            sums = np.zeros(len(docs), np.uint64)
            np.add.at(sums, group, part)
            value = np.concatenate([value, mix64(sums + counts[docs].astype(np.uint64))])
            owner = np.concatenate([owner, docs])
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    value, owner = value[order], owner[order]
    if len(value):
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        value, owner = value[new], owner[new]
    bounds = np.zeros(n_docs + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=n_docs), out=bounds[1:])
    return value, bounds


def _draw(element: np.ndarray, j: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Step ``j`` of each element's generator: its fraction (32 bits) and the
    index in ``j .. m-1`` that it swaps with ``j``."""
    with np.errstate(over="ignore"):
        bits = mix64(element + _STEP * np.uint64(j + 1))
    low = bits & np.uint64(0xFFFFFFFF)
    return bits >> np.uint64(32), (j + ((low * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)).astype(np.int32)


def _offer(ranks: np.ndarray, owner: np.ndarray, at: np.ndarray, r: np.ndarray, j: int, m: int) -> None:
    np.minimum.at(ranks, owner * m + at, (np.uint64(j) << np.uint64(32)) | r)


def superminhash(element: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """Signatures ``[documents, m]`` of the sets ``element[bounds[i]:bounds[i+1]]``."""
    n_docs = len(bounds) - 1
    sizes = np.diff(bounds)
    ranks = np.full(n_docs * m, np.iinfo(np.uint64).max, dtype=np.uint64)
    owner = np.repeat(np.arange(n_docs), sizes)
    open_docs = sizes > 0
    swaps: list[np.ndarray] = []
    for j in range(min(m, LAZY_ROUNDS)):
        r, k = _draw(element, j, m)
        at = k.copy()
        for i in range(j - 1, -1, -1):  # what earlier swaps left at index k
            at[at == swaps[i]] = i
        _offer(ranks, owner, at, r, j, m)
        swaps.append(k)
        left = np.flatnonzero(open_docs)
        full = ranks.reshape(n_docs, m)[left].max(axis=1) < (np.uint64(j + 1) << np.uint64(32))
        if full.any():
            open_docs[left[full]] = False
            keep = open_docs[owner]
            element, owner, swaps = element[keep], owner[keep], [s[keep] for s in swaps]
        if len(element) == 0:
            break
    for lo in range(0, len(element), WALK_ELEMENTS):
        part = slice(lo, lo + WALK_ELEMENTS)
        e, o = element[part], owner[part]
        rows = np.arange(len(e))
        order = np.tile(np.arange(m, dtype=np.int16 if m < 32768 else np.int32), (len(e), 1))
        for j in range(m):
            r, k = _draw(e, j, m)
            at = order[rows, k].copy()
            order[rows, k] = order[:, j]
            if j >= LAZY_ROUNDS:
                _offer(ranks, o, at, r, j, m)
    return ranks.reshape(n_docs, m)


def _band_keys(ranks: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        grouped = ranks.reshape(len(ranks), bands, rows)
        value = (np.arange(bands, dtype=np.uint64) + np.uint64(1))[None, :] * _STEP
        for k in range(rows):
            value = mix64(value ^ (grouped[:, :, k] * _ODD[k]))
    return value


_SKETCH = "row long, doc_id long, print long, n int, set_a long, set_b long, ranks binary, bands array<long>"


def _prints(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 128-bit fingerprint of every set, as two rows of signed numbers."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out = np.zeros((2, len(bounds) - 1), np.uint64)
    with np.errstate(over="ignore"):
        for row, salt in zip(out, _ODD[40:42]):
            np.add.at(row, owner, mix64(value * salt))
    return out.view(np.int64)


def _listed(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows and sets of a batch ``doc_id, text, ...``, some documents at a time."""
    raw, offsets = text_buffer(batch.column(1))
    for lo, hi in slices(offsets):
        yield (batch.slice(lo, hi - lo),
               *shingle_sets(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], words))


#: a set held by more than this share of all rows is joined by a broadcast, of fewer sets than that
HOT_SETS = 1000


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = BAND_ROWS, words: int = SHINGLE_WORDS) -> DataFrame:
    """Per document: a number of its own, its text's hash, set size and fingerprint, a byte of every rank, and band keys."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part, value, bounds in _sets(batch, words):
                n = len(part)
                ranks = superminhash(value, bounds, bands * rows)
                short = mix64(ranks).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), part.column(0), part.column(2), pa.array(np.diff(bounds).astype(np.int32)),
                     *map(pa.array, _prints(value, bounds)), pa.array([r.tobytes() for r in short], pa.binary()),
                     _listed(_band_keys(ranks, bands, rows).reshape(-1), np.arange(n + 1) * bands)],
                    names=["row", "doc_id", "print", "n", "set_a", "set_b", "ranks", "bands"])
                row += n

    workers_import_us(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("print"))
            .mapInArrow(lean(work), _SKETCH))


def full_sets(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, set_a, set_b, shingles``: the full set of every document and its fingerprint."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, value, bounds in _sets(batch, words):
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, _prints(value, bounds)), _listed(value, bounds)],
                                                 names=["doc_id", "set_a", "set_b", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lean(work), "doc_id long, set_a long, set_b long, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    a, b = (sets.select(F.col("cid").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(a, "a").join(b, "b")
            .where(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both))
            .select("a", "b"))


def _likely_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` within the groups of ``rows(key, own, cross, band, cid, c, n, ranks, bands)`` that lie
    in different components ``c`` and whose ranks don't rule a link out.

    The share of equal ranks estimates the similarity with a deviation of at
    most ``sqrt(p (1 - p) / m)``; pairs more than DEVIATIONS below the threshold
    are left. A pair is looked at in the first band it shares, by the full keys of the
    bands: with a byte of every rank, bands that differ can look shared.
    """
    p = percent / 100

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches):
            key, own, cross, band, cid, c, n = (t.column(k).to_numpy() for k in range(7))
            ranks = np.stack([np.frombuffer(r, np.uint8) for r in t.column(7).to_pylist()])
            keys = t.column(8).combine_chunks().flatten().to_numpy().reshape(len(ranks), -1)
            least = p - DEVIATIONS * math.sqrt(p * (1 - p) / ranks.shape[1])
            for i, j in group_pairs(key, own, cross):
                ok = (c[i] != c[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
                i, j = i[ok], j[ok]
                ok = (ranks[i] == ranks[j]).mean(axis=1) >= least
                i, j = i[ok], j[ok]
                ok = (keys[i] == keys[j]).argmax(axis=1) == band[i]
                a, b = cid[i[ok]], cid[j[ok]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return (rows.select("key", "own", "cross", "band", "cid", "c", "n", "ranks", "bands")
            .repartition("key").sortWithinPartitions("key").mapInArrow(lean(work), "a long, b long"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = BAND_ROWS,
                    words: int = SHINGLE_WORDS, by_row: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents with the same set are one class, found by the set's fingerprint,
    and enter the search once. Within a bucket every class is first compared
    with the bucket's smallest alone, which unites a group of copies with one
    pair a member. Then the pairs that are still in different components are
    looked at in blocks; those that full signatures don't rule out are compared
    too, so that no link between components is lost and a group of thousands
    never becomes all its pairs. With ``by_row``, two columns follow: ``print``, the text's hash, which
    tells rows of one id apart, and ``root``, which is the same for all rows of a
    component and no others (null for rows that link with nothing by definition).
    """
    near = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    sketch = stage(sketches(docs, bands, rows, words), "sketches")
    full = sketch.where("n > 0 and doc_id is not null")
    classes = stage(full.groupBy("set_a", "set_b").agg(
        F.min("row").alias("cid"), F.min("doc_id").alias("low"), F.count("*").alias("size")), "classes")

    reps = full.select("row", "n", "bands").join(classes.select(F.col("cid").alias("row")), "row")
    listed = reps.select(F.col("row").alias("cid"), "n", F.posexplode("bands").alias("band", "bucket"))
    hubs = (listed.groupBy("bucket").agg(F.min(F.struct(F.col("cid").alias("hub"), F.col("n").alias("m"))).alias("h"),
                                         F.max("cid").alias("top"))
            .where("h.hub < top").select("bucket", "h.hub", "h.m"))
    shared = stage(listed.join(hubs, "bucket"), "buckets")
    asked = shared.select("cid").distinct().join(classes, "cid").select("low", "cid", "set_a", "set_b")
    text = docs.join(asked.select(F.col("low").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = stage(full_sets(text, words).join(asked, ["set_a", "set_b"]).where("doc_id = low").select("cid", "shingles"), "sets")
    if sets.groupBy("cid").count().where("count > 1").take(1):  # the same row more than once
        sets = stage(sets.dropDuplicates(["cid"]), "sets")

    pairs = shared.where("hub < cid").where(near).select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    links = stage(_confirmed(pairs, sets, percent), "links")
    found = components(links)

    owned = (shared.join(found.withColumnRenamed("id", "cid"), "cid", "left")
             .select("bucket", "band", "cid", "n", F.coalesce("component", "cid").alias("c")))
    open_ = owned.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("bucket")
    ranks = sketch.select(F.col("row").alias("cid"), "ranks", "bands")
    dealt = in_blocks(owned.join(open_, "bucket"), "cid").join(ranks, "cid")
    others = stage(_confirmed(_likely_pairs(dealt, percent), sets, percent), "links")

    merged = components(links.unionAll(others)).withColumnRenamed("id", "cid")
    owner = classes.join(merged, "cid", "left").withColumn("root", F.coalesce("component", "cid"))
    least = stage(owner.groupBy("root").agg(F.min("low").alias("component_id")), "roots")
    named = stage(owner.join(least, "root").select("set_a", "set_b", "component_id", "root", "size"), "components")

    # members of the few sets that many rows share find them by a broadcast, the others by a shuffle
    bulk = F.col("size") * HOT_SETS > (classes.agg(F.sum("size")).first()[0] or 0)
    hot, key = F.broadcast(named.where(bulk)), ["set_a", "set_b"]
    alone = sketch.where("n = 0 or doc_id is null")
    member = full.join(hot, key).unionByName(full.join(hot.select(*key), key, "left_anti").join(named.where(~bulk), key))
    parts = [member.select("doc_id", "n", "component_id", "print", "root"),
             alone.select("doc_id", "n", F.col("doc_id").alias("component_id"), "print", F.lit(None).cast("long").alias("root"))]
    return (parts[0].unionByName(parts[1])
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id",
                    F.expr("coalesce(doc_id = component_id, true)").alias("kept"), *(["print", "root"] if by_row else [])))


#: the same rows in DuckDB's dialect. A class is a set; two linked classes share one of
#: the rarest n - ceil(0.75 n) + 1 shingles of each, so only such pairs are compared
ORACLE = """
with recursive cut as (
    select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as words from documents),
placed as (select r, unnest(words) as w, generate_subscripts(words, 1) as place from cut where len(words) >= 5),
windows as (select r, w || ' ' || lead(w, 1) over o || ' ' || lead(w, 2) over o || ' ' || lead(w, 3) over o || ' '
            || lead(w, 4) over o as shingle from placed window o as (partition by r order by place)),
long as (select r, list_sort(list(distinct shingle)) as shingles from windows where shingle is not null group by r),
sets as (
    select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
        else l.shingles end as shingles from cut left join long l using (r)),
classes as (select shingles, len(shingles) as n, min(doc_id) as low from sets
            where len(shingles) > 0 and doc_id is not null group by shingles),
listed as (select low, n, unnest(shingles) as shingle from classes),
rare as (select shingle, count(*) as holders from listed group by shingle),
ranked as (select low, n, shingle, row_number() over (partition by low order by holders, shingle) as place
           from listed join rare using (shingle)),
prefixes as (select low, n, shingle from ranked where place <= n - (75 * n + 99) // 100 + 1),
likely as (select distinct a.low as a, b.low as b from prefixes a join prefixes b using (shingle)
           where a.low < b.low and 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)),
links as (select a, b from (
    select l.a, l.b, x.n, y.n as m, len(list_intersect(x.shingles, y.shingles)) as common
    from likely l join classes x on x.low = l.a join classes y on y.low = l.b)
    where 100 * common >= 75 * (n + m - common)),
edges as (select a, b from links union all select b, a from links),
reach as (select low as id, low as root from classes
          union select e.b, r.root from reach r join edges e on e.a = r.id where r.root < e.b),
roots as (select id, min(root) as component_id from reach group by id)
select s.doc_id, cast(len(s.shingles) as bigint) as n_shingles,
       coalesce(r.component_id, s.doc_id) as component_id,
       coalesce(s.doc_id = coalesce(r.component_id, s.doc_id), true) as kept
from sets s left join classes c on c.shingles = s.shingles and s.doc_id is not null left join roots r on r.id = c.low
"""
