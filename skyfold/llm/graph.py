"""Approximate nearest neighbours on robust-pruned directed graphs.

Vectors are dealt into shards of bounded size and nearly equal length, as a query
finds its way badly among nodes that are near only by their length; every shard
gets a graph. A new
vector's neighbours are proposed by a greedy beam search on the graph so far;
pruning walks them from near to far and drops those to which an already kept
neighbour is closer by the factor ``1 / alpha`` than the vector itself, which
keeps edges in diverse directions; edges are added both ways. Every graph is
built once and written beside its vectors. A query runs a beam search on every
shard: tasks hold some shards each, the queries stream past them, and only a
query's best over a task's shards go on to be ranked by their exact scores. The largest inner product becomes the least distance by one
more component, ``sqrt(M**2 - |x|**2)``.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, stage, workers_import_us
from .vectors import classes, usable

#: vectors in a shard, edges of a node, beam widths of building and of
#: searching, relaxation of the pruning, fewest queries worth a block of their own
SHARD, DEGREE, BUILD_BEAM, BEAM, ALPHA, QUERIES = 4096, 32, 64, 96, 1.2, 512
#: vectors and edges of the shards that a task holds, in 32-bit numbers
GROUP_BYTES = 32 << 20
#: ratio of the lengths of the vectors in a shard
LENGTHS = 1.1
#: vectors a batch inserts at most, and searches that run together
BATCH = 512
#: shares of a class's members that are ranked apart before they meet
SALT = 64


def shortened(v: np.ndarray, each: bool = False) -> np.ndarray:
    """Vectors divided by the largest length of all, or each by its own."""
    axis = 1 if each else None
    v = v / np.abs(v).max(axis=axis, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True).max(axis=axis, keepdims=True))


def raised(v: np.ndarray) -> np.ndarray:
    """Vectors of one length on which the least distance is the largest inner product."""
    norm = (v * v).sum(axis=1)
    return np.concatenate([v, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]], axis=1).astype(np.float32)


def beam_search(x: np.ndarray, graph: np.ndarray, starts: np.ndarray, q: np.ndarray, width: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest nodes found for every query, nearest first, -1 where there
    are fewer, and their squared distances less the query's own norm."""
    n, b = len(x), len(q)
    norms = (x * x).sum(axis=1)
    seen = np.zeros((b, n + 1), dtype=bool)  # column n stands for "no edge"
    seen[:, n] = True
    ids = np.full((b, width), -1)
    dist = np.full((b, width), np.inf, dtype=np.float32)
    open_ = np.zeros((b, width), dtype=bool)
    rows = np.arange(b)
    near = np.broadcast_to(starts, (b, len(starts)))
    while len(rows):
        fresh = ~seen[rows[:, None], near]
        seen[rows[:, None], near] = True
        d = norms[near % n] - 2 * np.einsum("bd,brd->br", q[rows], x[near % n])
        both = np.concatenate([dist[rows], np.where(fresh, d, np.inf)], axis=1)
        pick = np.argpartition(both, width - 1, axis=1)[:, :width]
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], near], axis=1), pick, axis=1)
        dist[rows] = np.take_along_axis(both, pick, axis=1)
        open_[rows] = np.take_along_axis(np.concatenate([open_[rows], fresh], axis=1), pick, axis=1)
        waiting = np.where(open_[rows] & np.isfinite(dist[rows]), dist[rows], np.inf)
        best = waiting.argmin(axis=1)
        more = np.isfinite(waiting[np.arange(len(rows)), best])
        rows, best = rows[more], best[more]
        open_[rows, best] = False
        near = graph[ids[rows, best]]
    order = np.argsort(dist, axis=1, kind="stable")
    dist = np.take_along_axis(dist, order, axis=1)
    return np.where(np.isfinite(dist), np.take_along_axis(ids, order, axis=1), -1), dist


def robust_prune(x: np.ndarray, nodes: np.ndarray, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse neighbours of ``nodes`` out of ``pool`` (ids, -1 for none): ``[len(nodes), degree]``."""
    n = len(x)
    pool = np.where(pool == nodes[:, None], -1, pool)
    v = x[pool]
    d = ((v - x[nodes][:, None, :]) ** 2).sum(axis=2)
    d[pool < 0] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    pool, d = np.take_along_axis(pool, order, axis=1), np.take_along_axis(d, order, axis=1)
    same = np.zeros(pool.shape, bool)  # a node twice stands side by side or at a tie: drop repeats by id
    by_id = np.argsort(pool, axis=1, kind="stable")
    sorted_ids = np.take_along_axis(pool, by_id, axis=1)
    np.put_along_axis(same, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], axis=1)
    alive = (pool >= 0) & ~same
    v = x[pool]
    sq = (v * v).sum(axis=2)
    between = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    out = np.full((len(nodes), degree), n)
    rows = np.arange(len(nodes))
    for k in range(degree):
        first = alive.argmax(axis=1)
        has = alive[rows, first]
        if not has.any():
            break
        out[has, k] = pool[rows, first][has]
        alive[rows, first] = False
        alive &= alpha * alpha * between[rows, first] > d
    return out


def build(x: np.ndarray, degree: int = DEGREE, width: int = BUILD_BEAM, alpha: float = ALPHA
          ) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``[n, degree]`` (n: no edge) and the nodes where searches start."""
    n = len(x)
    graph = np.full((n, degree), n)
    order = np.random.default_rng(0).permutation(n)
    starts = np.unique(np.append(order[:4], ((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin()))
    order = np.concatenate([starts, order[~np.isin(order, starts)]])
    done = min(n, BATCH)
    first = order[:done]
    d = ((x[first] ** 2).sum(axis=1)[None, :] - 2 * x[first] @ x[first].T)
    np.fill_diagonal(d, np.inf)
    pool = first[np.argsort(d, axis=1)[:, :2 * width]]
    for lo in range(0, done, 128):
        graph[first[lo:lo + 128]] = robust_prune(x, first[lo:lo + 128], pool[lo:lo + 128], degree, alpha)
    while done < n:
        new = order[done:done + min(done, BATCH)]
        found, _ = beam_search(x, graph, starts, x[new], width)
        for lo in range(0, len(new), 128):
            graph[new[lo:lo + 128]] = robust_prune(x, new[lo:lo + 128], found[lo:lo + 128], degree, alpha)
        _link_back(x, graph, new, degree, alpha)
        done += len(new)
    return graph, starts


def _link_back(x: np.ndarray, graph: np.ndarray, new: np.ndarray, degree: int, alpha: float) -> None:
    """Adds the edges of ``new`` in the other direction; full nodes are pruned again."""
    n = len(x)
    to, frm = graph[new].reshape(-1), np.repeat(new, degree)
    to, frm = to[to < n], frm[to < n]
    near = ((x[to] - x[frm]) ** 2).sum(axis=1)
    order = np.lexsort((near, to))
    to, frm = to[order], frm[order]
    rank = np.arange(len(to)) - np.searchsorted(to, to)
    to, frm, rank = to[rank < degree], frm[rank < degree], rank[rank < degree]
    nodes, row = np.unique(to, return_inverse=True)
    added = np.full((len(nodes), degree), -1)
    added[row, rank] = frm
    pool = np.concatenate([np.where(graph[nodes] < n, graph[nodes], -1), added], axis=1)
    count = (pool >= 0).sum(axis=1)
    roomy = np.flatnonzero(count <= degree)
    for i in roomy:
        kept = np.unique(pool[i][pool[i] >= 0])
        graph[nodes[i]] = n
        graph[nodes[i], :len(kept)] = kept
    full = np.flatnonzero(count > degree)
    for lo in range(0, len(full), 128):
        part = full[lo:lo + 128]
        graph[nodes[part]] = robust_prune(x, nodes[part], pool[part], degree, alpha)


def exactly(vectors: np.ndarray) -> bool:
    """Whether a shard has so few vectors that a beam would read them all anyway."""
    return len(vectors) <= 2 * BEAM


def search(vectors: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, k: int, width: int = BEAM
           ) -> tuple[np.ndarray, np.ndarray]:
    """Positions and exact inner products of the best ``k`` found for every query (-1: fewer)."""
    n = len(vectors)
    k, width = min(k, n), min(n, max(width, k))
    if exactly(vectors):
        found = np.broadcast_to(np.arange(n), (len(queries), n))
    else:
        # in float32 lengths of any magnitude: neither changes a query's order of the vectors
        x = raised(shortened(vectors.astype(np.float64)))
        q = np.concatenate([shortened(queries, each=True), np.zeros((len(queries), 1))], axis=1).astype(np.float32)
        found = np.concatenate([beam_search(x, graph, starts, q[lo:lo + BATCH], width)[0]
                                for lo in range(0, len(q), BATCH)])
    score = np.empty(found.shape)
    for lo in range(0, len(queries), 64):  # in double precision, each product on its own
        score[lo:lo + 64] = (vectors[found[lo:lo + 64]].astype(np.float64) * queries[lo:lo + 64, None, :]).sum(axis=2)
    score[found < 0] = -np.inf
    best = np.argsort(-score, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(found, best, axis=1), np.take_along_axis(score, best, axis=1)


def _rows(column: pa.Array) -> np.ndarray:
    """Arrays of equal length as the rows of a matrix of their own type."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _with_edges(nodes: pa.Table) -> pa.Table:
    """The nodes of one shard by ``cid`` with their edges: places in that order, as
    many as there are nodes where there is no edge; null in a shard searched without."""
    nodes = nodes.sort_by("cid").combine_chunks()
    n = len(nodes)
    vectors = _rows(nodes["embedding"].combine_chunks())
    edges, start = pa.nulls(n, pa.list_(pa.int32())), np.zeros(n, bool)
    if not exactly(vectors):
        graph, starts = build(raised(shortened(vectors.astype(np.float64))))
        start[starts] = True
        edges = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * graph.shape[1]),
                                         pa.array(graph.reshape(-1).astype(np.int32)))
    return nodes.append_column("start", pa.array(start)).append_column("edges", edges)


class _Shard:
    """One shard's nodes, as a task holds them while queries stream by."""

    def __init__(self, nodes: pa.Table):
        self.cid, self.low = nodes["id"].to_numpy(), nodes["low"].to_numpy()
        self.vectors = _rows(nodes["embedding"].combine_chunks())
        self.starts = np.flatnonzero(nodes["start"].to_numpy())
        self.graph = None if exactly(self.vectors) else _rows(nodes["edges"].combine_chunks())

    def best(self, queries: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, score = search(self.vectors, self.graph, self.starts, queries, k, width)
        return np.where(found < 0, -1, self.cid[found]), self.low[found], score


def _answers(shards: list[_Shard], ids: np.ndarray, queries: np.ndarray, k: int, width: int) -> pa.RecordBatch:
    """The best ``k`` over all shards for every query, equal scores by the smaller id."""
    cid, low, score = (np.concatenate(part, axis=1) for part in zip(*(s.best(queries, k, width) for s in shards)))
    order = np.lexsort((low, -score), axis=1)[:, :k]
    cid, low, score = (np.take_along_axis(part, order, axis=1) for part in (cid, low, score))
    there = cid >= 0
    return pa.RecordBatch.from_arrays(
        [pa.array(np.broadcast_to(ids[:, None], cid.shape)[there]), *(pa.array(part[there]) for part in (cid, low, score))],
        names=["query_id", "cid", "low", "score"])


def _runs(t: pa.RecordBatch, *columns: str) -> Iterator[pa.RecordBatch]:
    """Slices of neighbouring rows that agree in ``columns``."""
    changes = np.zeros(len(t) + 1, bool)
    changes[[0, -1]] = True
    for c in columns:
        value = t[c].to_numpy(zero_copy_only=False)
        changes[1:-1] |= value[1:] != value[:-1]
    for lo, hi in itertools.pairwise(np.flatnonzero(changes)):
        yield t.slice(lo, hi - lo)


def _search_stream(k: int, width: int):
    """Work on rows sorted by (key, queries after nodes, dim, shard, id): a key's shards are
    held, its queries pass by a batch at a time."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shards, nodes = None, {}, []

        def settle() -> None:
            if nodes:
                whole = pa.Table.from_batches(nodes)
                shards.setdefault(whole["dim"][0].as_py(), []).append(_Shard(whole))
                nodes.clear()

        for run in (r for batch in batches if len(batch) for r in _runs(batch, "key", "asks", "dim", "shard")):
            key, asks, dim, shard = (run[c][0].as_py() for c in ("key", "asks", "dim", "shard"))
            if (key, asks, dim, shard) != at:
                settle()
                if at is None or key != at[0]:
                    shards.clear()
                at = key, asks, dim, shard
            if not asks:
                nodes.append(run)
            elif dim in shards:
                for lo in range(0, len(run), BATCH):
                    part = run.slice(lo, BATCH)
                    yield _answers(shards[dim], part["id"].to_numpy(), _rows(part["embedding"]).astype(np.float64), k, width)

    return work


def _few_members(members: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest ids of every class; a class of any size is ranked in shares first."""
    salted = members.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALT)))
    for keys in (["cid", "salt"], ["cid"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))
        salted = salted.withColumn("rank", rank).where(F.col("rank") <= k)
    return salted.select("cid", "vec_id")


_ANSWER = {"query_id": "long", "rank": "int", "vec_id": "long", "score": "double"}


def _with_band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of one band differ in length by at most LENGTHS; 1 lies in the middle of one."""
    for batch in batches:
        if len(batch):
            v = np.abs(batch["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            dim = batch["embedding"].value_lengths().to_numpy()
            at = np.cumsum(dim) - dim
            largest = np.maximum.reduceat(v, at)
            squares = np.add.reduceat((v / np.repeat(largest, dim)) ** 2, at)
            band = np.floor((np.log(largest) + np.log(squares) / 2) / math.log(LENGTHS) + 0.5)
            yield batch.append_column("band", pa.array(band.astype(np.int32)))


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, shard: int = SHARD, width: int = BEAM,
            block: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found of every query.

    Queries are the rows whose id is divisible by ``every``; all of them pass
    every shard. Identical vectors are one node of a graph and all their
    ids are answers.

    Defined cases: rows whose vector is null, zero or holds null or non-finite
    components, or whose id is null, take no part; vectors meet queries of their
    own length only; ties go to the smaller id; rows that repeat an id are that
    query's own; with fewer candidates than ``k`` all are returned; an empty
    table gives an empty result; other columns are ignored.
    """
    workers_import_us(vectors.sparkSession)
    table, members = classes(vectors)
    asked = (vectors.where(usable()).where(F.col("vec_id") % every == 0)
             .select(F.col("vec_id").cast("long").alias("query_id"), "embedding").distinct())
    # one row a band of lengths; a shard's number is its band's first plus a hash
    kind = table.schema["embedding"].dataType.simpleString()
    table = table.select("cid", "low", "embedding").mapInArrow(
        lean(_with_band), f"cid long, low long, embedding {kind}, band int")
    shards, first, longest = 0, {}, 0
    for r in table.groupBy("band").agg(F.count("*").alias("count"), F.max(F.size("embedding")).alias("dim")).orderBy("band").collect():
        longest = max(longest, r.dim)
        first[r.band] = (shards, -(-r["count"] // shard))
        shards += first[r.band][1]
    if not shards:
        return vectors.select(*[F.lit(None).cast(t).alias(c) for c, t in _ANSWER.items()]).where("false")
    look = lambda k: F.element_at(F.create_map(*[F.lit(x) for b, v in first.items() for x in (b, v[k])]), F.col("band"))
    table = table.withColumn("shard", (look(0) + F.pmod(F.xxhash64("cid"), look(1))).cast("int")).withColumn("dim", F.size("embedding"))
    nodes = table.select("shard", "dim", "cid", "low", "embedding")
    graph = stage(nodes.groupBy("shard", "dim").applyInArrow(
        _with_edges, f"shard int, dim int, cid long, low long, embedding {kind}, start boolean, edges array<int>"), "graph")

    # a task holds some shards and sees one block of the queries; few shards leave tasks
    # idle, so their queries are split further
    tasks = vectors.sparkSession.sparkContext.defaultParallelism
    held = max(1, min(GROUP_BYTES // (4 * shard * (longest + DEGREE)), shards // tasks))
    groups = -(-shards // held)
    blocks = max(1, min(-(-asked.count() // block), -(-tasks // groups)))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = graph.withColumn("block", each(blocks)).select(
        ((F.col("shard") / held).cast("int") * blocks + F.col("block")).alias("key"), F.lit(False).alias("asks"),
        "dim", "shard", F.col("cid").alias("id"), "low", "embedding", "start", "edges")
    none = {c: F.lit(None).cast(left.schema[c].dataType) for c in ("low", "start", "edges")}
    right = asked.withColumn("group", each(groups)).select(
        (F.col("group") * blocks + F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).alias("key"),
        F.lit(True).alias("asks"), F.size("embedding").alias("dim"), F.lit(-1).alias("shard"),
        F.col("query_id").alias("id"), none["low"].alias("low"), "embedding", none["start"].alias("start"),
        none["edges"].alias("edges"))
    found = (left.unionByName(right).repartitionById(groups * blocks, F.col("key"))
             .sortWithinPartitions("key", "asks", "dim", "shard", "id")
             .mapInArrow(lean(_search_stream(k + 1, width)), "query_id long, cid long, low long, score double"))
    first_few = Window.partitionBy("query_id").orderBy(F.desc("score"), "low")
    found = found.withColumn("place", F.row_number().over(first_few)).where(F.col("place") <= k + 1)
    few = _few_members(members, k + 1)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.join(few, "cid").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select(*[F.col(c).cast(t) for c, t in _ANSWER.items()]))
