"""Centroid clustering of integer vectors with scalar lookup tables.

Components are integers, so a round needs the squared difference of few numbers
only: for each dimension, each integer that occurs there and each centroid it is
tabulated once, and a vector's distances are sums of table rows, gathered by the
vector's components. Tables are made anew for every batch of vectors from the
integers that occur in it, so they never exceed the batch. Tasks pass on sums and
counts of their clusters, which Spark adds up; the driver holds the centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, stage, workers_import_us

#: components of a vector, factor before rounding down, centroids, rounds
COMPONENTS, SCALE, CENTROIDS, ROUNDS = 64, 1024, 8, 10
#: integers stay within this, so that any squared distance of 64 components is a long
LARGEST = 1 << 27
_LONG = (1 << 63) - 1


def points(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` of the vectors kept, ``v`` their components as integers."""
    v = F.col("embedding")
    inside = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < LARGEST / scale))
    return (vectors.where(F.col("vec_id").isNotNull() & (F.size(v) == components) & F.coalesce(inside, F.lit(False)))
            .select(F.col("vec_id").cast("long"),
                    F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("v")))


def first_centroids(table: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of their id; equal ids go by their components."""
    by = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    rows = table.orderBy(by, "vec_id", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def coded(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integers that occur in each dimension, one after the other, the dimension of
    each, and the place of every component of ``v`` among them."""
    n, d = v.shape
    low = v.min(axis=0)
    wide = (v.max(axis=0) - low + 1).astype(np.int64)
    if wide.sum() <= 4 * v.size:  # a mark for each integer between least and largest
        cells = (v - low) + (np.cumsum(wide) - wide)
        there = np.zeros(int(wide.sum()), bool)
        there[cells.reshape(-1)] = True
        at = np.flatnonzero(there)
        dim = np.repeat(np.arange(d), wide)[at]
        value = at - (np.cumsum(wide) - wide)[dim] + low[dim]
        return value, dim, (np.cumsum(there) - 1)[cells]
    values, codes, first = [], np.empty((n, d), np.int64), 0
    for j in range(d):
        own, at = np.unique(v[:, j], return_inverse=True)
        codes[:, j] = at.reshape(-1) + first
        values.append(own)
        first += len(own)
    return np.concatenate(values), np.repeat(np.arange(d), [len(x) for x in values]), codes


def assign(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every row (the smaller number of equals), and its squared distance."""
    value, dim, codes = coded(v)
    table = (value[:, None] - centroids.T[dim]) ** 2
    total = np.zeros((len(v), len(centroids)), np.int64)
    for j in range(v.shape[1]):
        total += table[codes[:, j]]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(v)), cluster]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), -1)


def _moments(table: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """Per cluster: vectors, their summed distance, and their componentwise sums."""
    k, d = centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        high, low = np.zeros(k, np.int64), np.zeros(k, np.int64)  # 32 bits each of the distances
        for batch in batches:
            v = _matrix(batch.column(0))
            if not len(v):
                continue
            cluster, distance = assign(v, centroids)
            for c in np.unique(cluster):
                own = cluster == c
                count[c] += own.sum()
                sums[c] += v[own].sum(axis=0)
                high[c] += (distance[own] >> 32).sum()
                low[c] += (distance[own] & 0xFFFFFFFF).sum()
        # a row for each cluster and number: the count, the distances, the sums
        numbers = np.concatenate([count[:, None], high[:, None], low[:, None], sums], axis=1)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, d + 3), pa.int32()), pa.array(np.tile(np.arange(d + 3), len(at)), pa.int32()),
             pa.array(numbers[at].reshape(-1))], names=["cluster", "number", "part"])

    parts = table.select("v").mapInArrow(lean(work), "cluster int, number int, part long")
    # at most k * (d + 3) rows, whatever the input
    rows = parts.groupBy("cluster", "number").agg(F.sum("part").alias("total")).collect()
    found: dict[int, dict[int, int]] = {}
    for r in rows:
        found.setdefault(r.cluster, {})[r.number] = r.total
    return {c: (t[0], (t[1] << 32) + t[2], [t[j + 3] for j in range(d)]) for c, t in found.items()}


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


_ANSWER = {"vec_id": "long", "cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long",
           "centroid_sha256": "string"}


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, components: int = COMPONENTS,
            scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every vector
    kept, and the final centroids.

    A round that moves no centroid is the last that can change anything, so the
    rounds after it are left out.

    Defined cases: vectors of another length, that are null or hold null or
    non-finite components, or whose id is null, are not kept, nor are those with a
    component whose integer is 2**27 or more away from 0 (their squared distances
    need not fit a long; a sum of distances beyond a long is null); repeated rows
    count each for itself; with fewer kept vectors than ``k`` there are as many
    centroids; ties go to the smaller number; empty clusters keep their centroid;
    an empty table gives an empty result; other columns are ignored.
    """
    workers_import_us(vectors.sparkSession)
    table = stage(points(vectors, components, scale), "points")
    centroids = first_centroids(table, k)
    if not len(centroids):
        return (vectors.select(*[F.lit(None).cast(t).alias(c) for c, t in _ANSWER.items()]).where("false"),
                np.empty((0, components), np.int64))
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (n, _, sums) in _moments(table, centroids).items():
            moved[c] = [s // n for s in sums]
        if (moved == centroids).all():
            break
        centroids = moved
    inertia = {c: total for c, (_, total, _) in _moments(table, centroids).items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                own, distance = assign(_matrix(batch.column(1)), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(own, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    def of_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster") + 1)

    fits = lambda x: x if x <= _LONG else None
    found = table.mapInArrow(lean(work), "vec_id long, cluster int, distance long")
    return found.select(
        "*", of_cluster([fits(inertia.get(c, 0)) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(fits(sum(inertia.values()))).cast("long").alias("inertia"),
        of_cluster([_digest(c) for c in centroids], "string").alias("centroid_sha256")), centroids


def oracle(k: int = CENTROIDS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE) -> str:
    """DuckDB SQL for the rows of the query: the rounds one after the other."""
    def nearest(n: int) -> str:
        return f"""
  d{n} as materialized (select p.r, c.k, sum((p.x - c.x) * (p.x - c.x))::bigint as d
    from p join c{n} c on p.j = c.j group by p.r, c.k),
  a{n} as materialized (select r, k, d from d{n}
    qualify row_number() over (partition by r order by d, k) = 1)"""

    steps = []
    for n in range(rounds):
        steps.append(nearest(n) + f""",
  s{n} as (select a.k, p.j, sum(p.x)::bigint as s, count(*) as n
    from a{n} a join p using (r) group by a.k, p.j),
  c{n + 1} as materialized (select c.k, c.j,
      coalesce((s.s - (((s.s % s.n) + s.n) % s.n)) // s.n, c.x) as x
    from c{n} c left join s{n} s on s.k = c.k and s.j = c.j)""")
    steps.append(nearest(rounds))
    return f"""with kept as (
    select row_number() over (order by vec_id, embedding) as r, vec_id,
      list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v
    from embeddings
    where vec_id is not null and len(embedding) = {components}
      and len(list_filter(embedding, lambda x: x is not null and abs(x::double) < {LARGEST // scale})) = {components}),
  p as materialized (select r, unnest(v) as x, unnest(range(1, {components + 1})) as j from kept),
  first as (select row_number() over (order by sha256('3:' || vec_id::varchar), vec_id, v) - 1 as k, v
    from kept qualify k < {k}),
  c0 as materialized (select k, unnest(v) as x, unnest(range(1, {components + 1})) as j from first),
{','.join(steps)},
  h as (select k, sha256(string_agg(x::varchar, ',' order by j)) as centroid_sha256 from c{rounds} group by k),
  i as (select k, sum(d)::bigint as cluster_inertia from a{rounds} group by k)
select kept.vec_id, a.k::integer as cluster, a.d as distance, i.cluster_inertia,
  (select sum(d)::bigint from a{rounds}) as inertia, h.centroid_sha256
from a{rounds} a join kept using (r) join i on i.k = a.k join h on h.k = a.k"""
