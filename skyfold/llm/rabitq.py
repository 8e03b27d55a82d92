"""Embedding near-duplicates with randomised-rotation binary codes.

A unit vector ``o`` is rotated at random and kept as the signs of its
components, ``x = sign(R o) / sqrt(d)``, with the correction factor
``f = <x, R o>``. Then ``<x, R q> / f`` estimates ``<o, q>`` without bias, and
its error is below ``z * sqrt((1 / f**2 - 1) / (d - 1))`` but with a probability
that falls exponentially in ``z**2``. Pairs whose bound stays below the threshold
are dropped from codes alone; the others are recomputed exactly.

Candidates are vectors that agree in a whole band of sign bits. The bits of a
band grow with the logarithm of the table and the bands so that a pair at the
threshold is missed with probability ``MISS``, so buckets stay small but for
real neighbours. Large buckets are compared in blocks; every pair counts in
the first band it agrees in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, components, group_pairs, in_blocks, lean, mix64, stage, whole_groups, workers_import_us
from .vectors import classes, matrix, rotation

#: least cosine of a link, deviations within a bound, chance to miss a pair at
#: the threshold
COSINE, DEVIATIONS, MISS = 0.95, 4.5, 1e-4


def band_plan(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Bits of a band and number of bands for ``n`` vectors."""
    bits = min(32, max(8, math.ceil(math.log2(max(n, 2))) + 4))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, whatever their magnitude."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _encode(table: DataFrame, bits: int, bands: int) -> DataFrame:
    """Adds the binary code, its factor, and the sign bits of every band."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(pc.list_value_length(batch.column(1)))
            for d in np.unique(lengths):  # vectors of one length are compared with each other
                part = batch.filter(pa.array(lengths == d))
                v = unit(matrix(part.column(1)))
                signs, factor, codes = [], None, None
                for k in range(-(-bits * bands // d)):
                    turned = v @ rotation(int(d), k).T
                    if k == 0:
                        factor = np.abs(turned).sum(axis=1) / math.sqrt(d)
                        codes = np.packbits(turned > 0, axis=1)
                    signs.append(turned > 0)
                grouped = np.concatenate(signs, axis=1)[:, :bits * bands].reshape(len(v), bands, bits)
                keys = (grouped * (np.uint64(1) << np.arange(bits, dtype=np.uint64))).sum(axis=2).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factor),
                     pa.array([k.tobytes() for k in keys], pa.binary())],
                    names=["cid", "embedding", "size", "code", "factor", "bands"])

    kind = table.schema["embedding"].dataType.simpleString()
    return table.select("cid", "embedding", "size").mapInArrow(
        work, f"cid long, embedding {kind}, size long, code binary, factor double, bands binary")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d = np.asarray(pc.list_value_length(batch.column(1))).astype(np.uint64)
        keys = np.stack([np.frombuffer(b, "<u4") for b in batch.column(2).to_pylist()]).astype(np.uint64)
        bands = keys.shape[1]
        band = np.arange(bands, dtype=np.uint64)
        with np.errstate(over="ignore"):
            bucket = mix64(keys ^ mix64((band + np.uint64(1))[None, :] * np.uint64(0x9E3779B97F4A7C15) + d[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.asarray(batch.column(0)), bands)), pa.array(np.tile(band.astype(np.int32), len(batch))),
             pa.array(bucket.reshape(-1).view(np.int64))], names=["cid", "band", "bucket"])


def _links_within(key: np.ndarray, own: np.ndarray, cross: np.ndarray, band: np.ndarray, v: np.ndarray,
                  codes: np.ndarray, factor: np.ndarray, bands: np.ndarray, cosine: float, deviations: float
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows of equal key whose first common band is this bucket's."""
    n, d = v.shape
    turned = v @ rotation(d, 0).T
    signs = np.where(np.unpackbits(codes, axis=1)[:, :d], 1.0, -1.0)
    spread = deviations * np.sqrt(np.maximum(1 / factor ** 2 - 1, 0) / max(d - 1, 1))
    scale = factor * math.sqrt(d)
    found = []
    for i, j in group_pairs(key, own, cross):
        for coded, exact in ((0, 1), (1, 0)):  # either one's code may rule a pair out
            a, b = (i, j)[coded], (i, j)[exact]
            ok = np.einsum("ij,ij->i", signs[a], turned[b]) / scale[a] + spread[a] >= cosine
            i, j = i[ok], j[ok]
        ok = (v[i] * v[j]).sum(axis=1) >= cosine
        i, j = i[ok], j[ok]
        ok = (bands[i] == bands[j]).argmax(axis=1) == band[i]
        found.append((i[ok], j[ok]))
    none = np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip((none, none), *found))


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row reachable by links i-j, for each of n rows."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, miss: float = MISS, block: int = BLOCK,
                    deviations: float = DEVIATIONS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Identical vectors are one class and enter the search once. Links are counted
    where they are found, by class size, so no list of pairs is ever made; the
    tasks only pass on counts and, per group, a spanning forest of its links.

    Defined cases: rows whose vector is null, zero or holds null or non-finite
    components, or whose id is null, link with nothing and are components of
    their own; vectors of different length never link; repeated rows are links
    of each other; an empty table gives an empty result; other columns are ignored.
    """
    workers_import_us(vectors.sparkSession)
    table, members = classes(vectors)
    bits, bands = band_plan(table.count(), cosine, miss)
    coded = stage(_encode(table, bits, bands), "codes")
    rows = coded.select("cid", "embedding", "bands").mapInArrow(_buckets, "cid long, band int, bucket long")
    loaded = in_blocks(rows, "cid", block).join(coded, "cid").select("key", "own", "cross", "band", "cid", "size", "embedding",
                                              "code", "factor", "bands")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            lengths = np.asarray(pc.list_value_length(table.column(6)).combine_chunks())
            for d in np.unique(lengths):  # a key's vectors have one length
                yield tell(table.filter(pa.array(lengths == d)).combine_chunks())

    def tell(t: pa.Table) -> pa.RecordBatch:
        key, own, cross, band, cid, size = (t.column(k).to_numpy() for k in range(6))
        code, keys = (t.column(k).to_pylist() for k in (7, 9))
        i, j = _links_within(
            key, own, cross, band, unit(matrix(t.column(6).combine_chunks())),
            np.stack([np.frombuffer(c, np.uint8) for c in code]), t.column(8).to_numpy(),
            np.stack([np.frombuffer(k, "<u4") for k in keys]), cosine, deviations)
        links = np.bincount(i, size[j], len(key)) + np.bincount(j, size[i], len(key))
        root = _roots(len(key), i, j)
        at = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(cid[at]), pa.array(links[at].astype(np.int64)), pa.array(cid[root[at]])],
            names=["cid", "links", "root"])

    told = stage(loaded.repartition("key").sortWithinPartitions("key")
                 .mapInArrow(lean(work), "cid long, links long, root long"), "links")
    counted = told.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(told.select(F.col("cid").alias("a"), F.col("root").alias("b")).where("a <> b").distinct())
    owner = (table.select("cid", "low", "size").join(joined.withColumnRenamed("id", "cid"), "cid", "left")
             .select("cid", "low", "size", F.coalesce("component", "cid").alias("component")))
    least = stage(owner.groupBy("component").agg(F.min("low").alias("component_id")), "roots")
    named = (members.join(owner.join(least, "component").drop("low"), "cid").join(counted, "cid", "left")
             .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
             .groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")))
    return (vectors.select(F.col("vec_id").cast("long")).join(named, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.expr("coalesce(vec_id = component_id, false)")))


#: the same rows in DuckDB's dialect, by comparing all pairs
ORACLE = """
with recursive usable as (
    select vec_id, cast(embedding as double[]) as v from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from usable a join usable b
          on len(a.v) = len(b.v) and a.vec_id < b.vec_id
          where list_cosine_similarity(a.v, b.v) >= 0.95),
edges as (select a, b from links union all select b, a from links),
reach as (select vec_id as id, vec_id as root from usable
          union select e.b, r.root from reach r join edges e on e.a = r.id where r.root < e.b),
roots as (select id, min(root) as component_id from reach group by id),
counted as (select a, count(*) as n from edges group by a)
select e.vec_id, coalesce(c.n, 0) as n_links, coalesce(r.component_id, e.vec_id) as component_id,
       coalesce(e.vec_id = r.component_id, false) as kept
from embeddings e left join counted c on c.a = e.vec_id left join roots r on r.id = e.vec_id
"""
