"""Centroid clustering whose assignments search a vantage-point tree.

Vectors become integers (``floor(scale * x)``) once and are written; every
round reads them back.  Each round the driver builds a vantage-point tree over
the centroids (at most ``k``, a parameter, whatever the input) and broadcasts
it.  A node holds one centroid, its vantage, and the others of its part split
in two halves by their squared distance from it, with the least and greatest
of those distances per half.

Every vector searches the tree best first: it opens the part whose lower bound
is smallest, measures that node's vantage (or the members of a leaf) and ends
when the smallest bound is beyond its best distance.  All vectors of a batch
take one such step at a time, each with a frontier of its own.  Distances are
squared, in 64-bit integers, hence exact; the bounds need square roots, so
they are lowered by more than those can be off, and a part whose bound equals
the best distance is still opened: it may hold a centroid as near with a
smaller number.

Sums per cluster are kept per task and added up by Spark, so a round returns
at most ``k`` rows to the driver, which divides them exactly.

Cases: vectors that are null, have another length than ``dims`` or hold null
or non-finite components take no part; every other row is a vector of its own,
also where rows repeat or the id is null (hashed as ``null`` for the start);
equal hashes start in the order of their components; fewer vectors than ``k``
are all centroids; an empty table gives an empty result.  A component of
2^19 or more in magnitude is an error: squared distances would not fit 64 bits
(at the default scale of 256).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package, written

K, ROUNDS, DIMS, SCALE, SEED = 40, 5, 64, 256, "2:"
LEAF = 4
# integer components stay below this, so that 64 squared differences fit 64 bits
LARGEST = 1 << 27
# vectors that search at once
STEP = 4096
_FAR = np.iinfo(np.int64).max


@dataclass
class Tree:
    """Node 0 is the root; -1 stands for no node, no vantage, no member."""
    centroids: np.ndarray     # k x dims
    vantage: np.ndarray       # centroid of an inner node
    child: np.ndarray         # nodes x 2: nearer and farther half
    low: np.ndarray           # nodes x 2: least squared distance of a half from the vantage
    high: np.ndarray          # nodes x 2: greatest
    members: np.ndarray       # nodes x LEAF: centroids of a leaf


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def build(centroids: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree over the rows of ``centroids`` (64-bit integers)."""
    vantage, child, low, high, members = [], [], [], [], []

    def add(own: np.ndarray) -> int:
        node = len(vantage)
        vantage.append(-1)
        child.append([-1, -1])
        low.append([0, 0])
        high.append([0, 0])
        members.append(np.full(leaf, -1))
        if len(own) <= leaf:
            members[node][:len(own)] = own
            return node
        # far out: the farthest from the first one sees the others at different distances
        v = own[np.argmax(squared(centroids[own], centroids[own[0]]))]
        rest = own[own != v]
        d = squared(centroids[rest], centroids[v])
        order = np.argsort(d, kind="stable")
        vantage[node] = v
        for side, part in enumerate(np.array_split(order, 2)):
            low[node][side], high[node][side] = d[part[0]], d[part[-1]]
            child[node][side] = add(rest[part])
        return node

    add(np.arange(len(centroids)))
    return Tree(centroids, np.array(vantage), np.array(child), np.array(low, np.int64), np.array(high, np.int64),
                np.array(members))


def search(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row of ``x`` (ties to the smaller number) and its exact squared distance."""
    best, who = np.full(len(x), _FAR), np.full(len(x), len(tree.centroids))
    at = np.arange(len(x))                                   # rows still searching
    node, bound = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))

    def measure(rows: np.ndarray, c: np.ndarray) -> np.ndarray:
        d = squared(x[rows], tree.centroids[c])
        better = (d < best[rows]) | ((d == best[rows]) & (c < who[rows]))
        best[rows[better]], who[rows[better]] = d[better], c[better]
        return d

    while len(at):
        slot = np.argmin(bound, axis=1)
        line = np.arange(len(at))
        b = bound[line, slot]
        # inclusive: a bound as large as the best distance may hide a tie
        open_ = b * b * (1 - 2.0 ** -40) <= best[at]
        open_ &= b < np.inf
        at, node, bound, slot, b = at[open_], node[open_], bound[open_], slot[open_], b[open_]
        if not len(at):
            break
        line = np.arange(len(at))
        here = node[line, slot]
        bound[line, slot] = np.inf
        leaf = tree.vantage[here] < 0
        for c in tree.members[here[leaf]].T:
            real = c >= 0
            measure(at[leaf][real], c[real])
        inner = np.flatnonzero(~leaf)
        grown_node, grown_bound = np.zeros(len(at), np.int64), np.full(len(at), np.inf)
        if len(inner):
            n = here[inner]
            d = np.sqrt(measure(at[inner], tree.vantage[n]).astype(float))
            for side in (0, 1):
                lo, hi = (np.sqrt(m[n, side].astype(float)) for m in (tree.low, tree.high))
                part = np.maximum(np.maximum(lo - d, d - hi) - (d + hi) * 2.0 ** -48, b[inner])
                if side:
                    grown_node[inner], grown_bound[inner] = tree.child[n, side], part
                else:
                    node[inner, slot[inner]], bound[inner, slot[inner]] = tree.child[n, side], part
            node, bound = np.column_stack([node, grown_node]), np.column_stack([bound, grown_bound])
    return who, best


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(
        np.int64)


def _sums_batch(clusters: np.ndarray, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(clusters, pa.int32()), pa.array(n), pa.array(list(sums), pa.list_(pa.int64()))],
        names=["cluster", "n", "sums"])


def _cluster_sums(points: DataFrame, tree: Tree, dims: int) -> dict[int, tuple[int, list[int]]]:
    """Per cluster that has vectors, their number and the sum of each component: at most k rows.

    A task adds up its own vectors; one row per task and cluster is shuffled
    by cluster and added up as it streams in, in two halves of 32 bits, which
    cannot overflow.
    """
    held = points.sparkSession.sparkContext.broadcast(tree)

    def partial(batches):
        t = held.value
        n, sums = np.zeros(len(t.centroids), np.int64), np.zeros(t.centroids.shape, np.int64)
        for b in batches:
            x = _vectors(b, dims)
            for lo in range(0, len(x), STEP):
                part = x[lo:lo + STEP]
                who, _ = search(t, part)
                order = np.argsort(who, kind="stable")
                first = np.flatnonzero(np.diff(who[order], prepend=-1))
                sums[who[order][first]] += np.add.reduceat(part[order], first, axis=0)
                n += np.bincount(who, minlength=len(n))
        some = np.flatnonzero(n)
        yield _sums_batch(some, n[some], sums[some])

    def merged(batches):
        n, halves = {}, {}
        for b in batches:
            for c, rows, s in zip(b.column(0).to_numpy(), b.column(1).to_numpy(), _vectors(b, dims)):
                n[c] = n.get(c, 0) + rows
                halves[c] = halves.get(c, 0) + np.concatenate([s >> 32, s & 0xFFFFFFFF])
        if n:
            yield _sums_batch(np.array(list(n)), np.array(list(n.values())), np.array(list(halves.values())))

    schema = "cluster int, n long, sums array<long>"
    out = (points.select("vector").mapInArrow(partial, schema).repartition("cluster")
           .mapInArrow(merged, schema).collect())
    held.destroy()
    return {r.cluster: (r.n, [(hi << 32) + lo for hi, lo in zip(r.sums[:dims], r.sums[dims:])]) for r in out}


def kept_vectors(rows: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, vector array<int>): floor(scale * x) of the rows whose vectors take part."""
    vec = F.col("vector")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))

    def whole(x: Column) -> Column:
        y = F.floor(x * scale)
        return F.when(F.abs(x * scale) < LARGEST, y).otherwise(
            F.raise_error(F.lit("a component is too large for exact squared distances")).cast("long")).cast("int")

    return (rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .filter((F.size(vec) == dims) & finite)
            .select("id", F.transform(vec, whole).alias("vector")))


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = K,
            rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = SEED
            ) -> tuple[DataFrame, DataFrame]:
    """Assignments (id, cluster, distance) of all vectors that take part, and the final centroids
    (cluster, n, inertia, components array<long>), at most ``k`` rows.

    Centroids start as the ``k`` vectors with the smallest SHA-256 of ``seed``
    and their id; ``rounds`` times all vectors are assigned and every centroid
    that has any becomes their floored mean.
    """
    spark = rows.sparkSession
    ship_package(spark)
    points = written(kept_vectors(rows, id_col, vector_col, dims, scale), "cluster-vectors")
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("null"))).cast("binary"), 256)
    start = points.orderBy(key, "vector").limit(k).collect()                       # k rows
    centroids = np.array([r.vector for r in start], np.int64).reshape(-1, dims)
    for _ in range(rounds if len(start) else 0):
        for c, (n, sums) in _cluster_sums(points, build(centroids), dims).items():
            centroids[c] = [s // n for s in sums]                                  # floors below 0 too
    held = spark.sparkContext.broadcast(build(centroids))

    def assign(batches):
        for b in batches:
            x = _vectors(b, dims)
            found = [search(held.value, x[lo:lo + STEP]) for lo in range(0, len(x), STEP)]
            if found:
                who, d = (np.concatenate(f) for f in zip(*found))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(who, pa.int32()), pa.array(d)],
                                                 names=["id", "cluster", "distance"])

    id_type = points.schema["id"].dataType.simpleString()
    assigned = written(points.mapInArrow(assign, f"id {id_type}, cluster int, distance long"), "clusters")
    inertia = {r.cluster: (r.n, int(r.inertia)) for r in assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    table = [(i, *inertia.get(i, (0, 0)), c.tolist()) for i, c in enumerate(centroids)]
    return (assigned.withColumnRenamed("id", id_col),
            spark.createDataFrame(table, "cluster int, n long, inertia long, components array<long>"))


def components_sha256(components: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, components)).encode()).hexdigest()
