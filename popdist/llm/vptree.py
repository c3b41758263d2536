"""Nearest neighbours by vantage-point trees, one per shard.

A node keeps a vantage point and the distance ranges of its two halves.  A
half is skipped when the triangle inequality puts all of it farther than the
best k found so far: ``bound * relax > worst``.  ``relax`` 1 is exact search;
larger factors skip more and lose recall.

Shards are the vectors nearest to one of the pivots, a bounded sample, and
know the range of their distances from it.  The tree of a shard is built once
and kept as bytes; queries stream through it.  Each query visits its own shard
first; the k-th distance found there bounds the others, and it visits only
those whose range the same inequality does not rule out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popdist.llm.common import bucket, staged

LEAF = 64
#: rows of a shard: its tree is one value
SHARD_ROWS = 50_000
#: queries that one task streams through a tree; more take turns with a copy
BLOCK_QUERIES = 1_000_000
#: bound on the pivots' bytes; with more vectors shards grow in parts instead
PIVOT_BYTES = 64 << 20
#: allowance for rounding when bounds are compared
SLACK = 1e-9


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean, all rows of ``a`` against all rows of ``b``, from differences."""
    out = np.empty((len(a), len(b)))
    step = max(1, 2_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        diff = a[i:i + step, None, :] - b[None, :, :]
        out[i:i + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


class VPTree:
    """Over float64 rows ``points`` with ids; ties go to the smaller id."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, seed: int = 0):
        self.points, self.ids = points, ids
        self.random = np.random.default_rng(seed)
        self.root = self._build(np.argsort(ids, kind="stable"))

    def _build(self, rows: np.ndarray):
        """Iterative, so equal points cannot exhaust the stack."""
        root: list = [None]
        todo = [(rows, root, 0)]
        while todo:
            rows, parent, slot = todo.pop()
            if len(rows) <= LEAF:
                parent[slot] = ("leaf", rows)
                continue
            vantage = self.points[self.random.choice(rows)]
            d = distances(vantage[None], self.points[rows])[0]
            order = np.argsort(d, kind="stable")
            half = len(rows) // 2
            near, far = order[:half], order[half:]
            node = ["node", vantage, (d[near[0]], d[near[-1]]), (d[far[0]], d[far[-1]]), None, None]
            parent[slot] = node
            todo += [(rows[near], node, 4), (rows[far], node, 5)]
        return root[0]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, relax: float = 1.0,
               worst: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ids (k a query; an infinite distance where there are fewer),
        without rows whose id is the query's own.  Rows beyond ``worst``, a
        distance for each query, need not be found."""
        best = np.full((len(queries), k), np.inf)
        who = np.full((len(queries), k), np.iinfo(np.int64).max)
        everyone = np.arange(len(queries))
        todo = [(self.root, everyone, np.zeros(len(queries)))]
        while todo:
            node, active, bound = todo.pop()
            limit = best[active, -1] if worst is None else np.minimum(best[active, -1], worst[active])
            still = ~(bound * relax > limit + SLACK)
            active = active[still]
            if not len(active):
                continue
            if node[0] == "leaf":
                rows = node[1]
                d = distances(queries[active], self.points[rows])
                d[self.ids[rows][None, :] == own[active][:, None]] = np.inf
                all_d = np.concatenate([best[active], d], axis=1)
                all_i = np.concatenate([who[active], np.broadcast_to(self.ids[rows], d.shape)], axis=1)
                all_i[np.isinf(all_d)] = np.iinfo(np.int64).max
                order = np.lexsort((all_i, all_d), axis=1)[:, :k]
                best[active] = np.take_along_axis(all_d, order, 1)
                who[active] = np.take_along_axis(all_i, order, 1)
                continue
            _, vantage, inner, outer, near, far = node
            d = distances(queries[active], vantage[None])[:, 0]
            to = [(c, np.maximum(0, np.maximum(lo - d, d - hi))) for c, (lo, hi) in ((near, inner), (far, outer))]
            first = to[0][1] <= to[1][1]  # the half with the smaller bound first
            for which, (child, b) in ((~first, to[0]), (first, to[1]), (first, to[0]), (~first, to[1])):
                if which.any():  # the last pushed is searched first
                    todo.append((child, active[which], b[which]))
        return best, who


class Pivots:
    """The pivots of every vector length, numbered from 0."""

    def __init__(self, sample: list[list[float]]):
        by_dim: dict[int, set[tuple[float, ...]]] = {}
        for v in sample:
            by_dim.setdefault(len(v), set()).add(tuple(v))
        self.points = {d: np.array(sorted(vs)) for d, vs in by_dim.items()}

    def distances(self, dim: int, vectors: np.ndarray) -> np.ndarray:
        """[vectors, pivots]; one pivot at distance 0 where a length has none."""
        return distances(vectors, self.points[dim]) if dim in self.points else np.zeros((len(vectors), 1))


def _by_dim(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """The rows of each vector length of a batch, with their vectors."""
    dims = b.column("dim").to_numpy()
    for dim in np.unique(dims):
        rows = b.filter(pa.array(dims == dim))
        yield int(dim), rows.column("embedding").flatten().to_numpy().reshape(len(rows), dim), rows


_ASKED = "dim int, shard int, query_id long, embedding array<double>, worst double"


def _search(batches: Iterator[pa.RecordBatch], k: int, relax: float) -> Iterator[pa.RecordBatch]:
    """Sorted rows of (dim, shard, sub, slice): a tree, then its queries."""
    tree, key = None, None
    for b in batches:
        keys = list(zip(*(b.column(c).to_pylist() for c in ("dim", "shard", "sub", "slice"))))
        is_tree = b.column("tree").is_valid().to_numpy(zero_copy_only=False)
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or is_tree[i - 1]), len(keys)]
        for a, e in zip(cuts, cuts[1:]):
            if is_tree[a]:
                tree, key = pickle.loads(b.column("tree")[a].as_py()), keys[a]
            elif keys[a] == key:  # a shard without a tree has no vectors
                part = b.slice(a, e - a)
                own = part.column("query_id").to_numpy()
                queries = part.column("embedding").flatten().to_numpy().reshape(len(own), -1)
                d, who = tree.search(queries, own, k, relax, part.column("worst").to_numpy())
                found = np.isfinite(d)
                yield pa.RecordBatch.from_pydict({"query_id": np.repeat(own, found.sum(1)), "vec_id": who[found], "score": d[found]})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, relax: float = 1.0,
            shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, least_shards: int = 16) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` of each row of ``queries``; both
    (vec_id, embedding).

    Left out: vectors that are null, empty, all zero or hold null or
    non-finite components, and rows without vec_id.  Of repeated vec_ids the
    smallest vector counts.  A query never finds its own vec_id.  Vectors are
    compared with those of their own length.  At ``relax`` 1 a shard is left out
    only where it cannot hold a nearer vector, so the result is exact.
    Columns: query_id, rank, vec_id, score.
    """
    def valid(df):
        v = F.col("embedding")
        ok = F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(
            v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))) & F.exists(v, lambda x: x != 0)
        return df.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding")) \
            .groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))

    spark = vectors.sparkSession
    points, asked = staged(valid(vectors), "nearest-points"), staged(valid(queries), "nearest-queries")
    n, widest, n_asked = *points.agg(F.count("*"), F.max("dim")).first(), asked.count()
    slices = max(1, -(-n_asked // block_queries))
    draw = min(max(least_shards, -(-n // shard_rows)), PIVOT_BYTES // (8 * (widest or 1)))
    sample = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(1, draw)).select("embedding").collect()
    pivots = spark.sparkContext.broadcast(Pivots([r.embedding for r in sample]))

    def place(batches):
        for b in batches:
            for dim, v, rows in _by_dim(b):
                d = pivots.value.distances(dim, v)
                home = d.argmin(1)
                yield pa.RecordBatch.from_pydict({
                    "dim": rows.column("dim"), "vec_id": rows.column("vec_id"), "embedding": rows.column("embedding"),
                    "shard": pa.array(home, pa.int32()), "d": pa.array(d[np.arange(len(d)), home])})

    placed = staged(points.mapInArrow(place, "dim int, vec_id long, embedding array<double>, shard int, d double"), "nearest-placed")
    shards = staged(placed.groupBy("dim", "shard").agg(
        F.min("d").alias("lo"), F.max("d").alias("hi"), F.ceil(F.count("*") / shard_rows).cast("int").alias("subs")), "nearest-shards")

    def build(part: pd.DataFrame) -> pd.DataFrame:
        tree = VPTree(np.stack(part.embedding.to_numpy()).astype(float), part.vec_id.to_numpy())
        return part[["dim", "shard", "sub"]].iloc[:1].assign(tree=[pickle.dumps(tree, 5)])

    trees = staged(placed.join(shards.select("dim", "shard", "subs"), ["dim", "shard"]).withColumn(
        "sub", F.pmod(F.xxhash64("vec_id"), F.col("subs")).cast("int")).select("dim", "shard", "sub", "vec_id", "embedding")
        .groupBy("dim", "shard", "sub").applyInPandas(build, "dim int, shard int, sub int, tree binary"), "nearest-trees")
    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))

    def visit(rows: DataFrame) -> DataFrame:
        """Neighbours of ``rows`` (_ASKED) in their shards, all parts of them."""
        rows = rows.join(shards.select("dim", "shard", "subs"), ["dim", "shard"]).select(
            "dim", "shard", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), bucket(slices, "query_id").alias("slice"),
            "query_id", "embedding", "worst", F.lit(None).cast("binary").alias("tree"))
        held = trees.select("dim", "shard", "sub", every.alias("slice"), F.lit(None).cast("long").alias("query_id"),
                            F.lit(None).cast("array<double>").alias("embedding"), F.lit(None).cast("double").alias("worst"), "tree")
        keys = ["dim", "shard", "sub", "slice"]
        both = held.unionByName(rows).withColumn("_q", F.col("tree").isNull()).repartition(*keys).sortWithinPartitions(*keys, "_q")
        return both.drop("_q").mapInArrow(lambda it: _search(it, k, relax), "query_id long, vec_id long, score double")

    homes = asked.mapInArrow(place, "dim int, vec_id long, embedding array<double>, shard int, d double")
    homes = staged(homes.select("dim", "shard", F.col("vec_id").alias("query_id"), "embedding",
                                F.lit(float("inf")).alias("worst")), "nearest-homes")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    near = staged(visit(homes), "nearest-home")
    worst = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    ranges = shards.where(F.col("dim").isin([int(d) for d in pivots.value.points])).collect()  # a row a pivot at most
    known = spark.sparkContext.broadcast({(r.dim, r.shard): (r.lo, r.hi) for r in ranges})

    def others(batches):
        """A row for every further shard that may hold a nearer vector."""
        for b in batches:
            for dim, v, rows in _by_dim(b):
                d = pivots.value.distances(dim, v)
                lo, hi = np.array([known.value.get((dim, i), (np.inf, -np.inf)) for i in range(d.shape[1])]).T
                bound = np.maximum(0, np.maximum(lo - d, d - hi))
                limit = rows.column("worst").to_numpy()
                go = ~(bound * relax > limit[:, None] + SLACK) & np.isfinite(lo)
                go[np.arange(len(d)), rows.column("shard").to_numpy()] = False
                q, shard = np.nonzero(go)
                for i in range(0, len(q), 10_000):
                    some = rows.take(pa.array(q[i:i + 10_000]))
                    yield pa.RecordBatch.from_pydict({
                        "dim": some.column("dim"), "shard": pa.array(shard[i:i + 10_000], pa.int32()),
                        "query_id": some.column("query_id"), "embedding": some.column("embedding"), "worst": some.column("worst")})

    bounded = homes.drop("worst").join(worst, "query_id", "left").select(
        "dim", "shard", "query_id", "embedding", F.coalesce("kth", F.lit(float("inf"))).alias("worst"))
    far = visit(bounded.mapInArrow(others, _ASKED))
    return near.unionByName(far).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
