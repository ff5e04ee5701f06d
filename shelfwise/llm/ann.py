"""Approximate nearest neighbours with randomly rotated one-bit codes.

A vector is normalised, padded with zeros to ``CODE_BITS`` dimensions (d, more
if it has more) and rotated by a random orthogonal matrix; its code is the
sign of each coordinate, packed into 64-bit words, with two correction
scalars: the vector's norm and f, the inner product of the rotated vector with
its own normalised code.  The inner product of a query, rotated alike, with
the code, divided by f, is an unbiased estimate of its inner product with the
vector.  A block's codes are unpacked to signs once, so that a matrix product
gives these for many queries at a time.  The error of an estimate stays within ``EPSILON * sqrt((1 - f^2) / f^2 / (d - 1))`` with high
probability.  The best estimates of a block of candidates are reranked first;
a vector whose upper bound is below the k-th of those scores is skipped, all
others are reranked too, by the exact inner product on the original vectors in
double precision.

Candidates are dealt into blocks of about ``BLOCK`` by id hash, and every block
meets the whole query set as a stream of rows: a task holds one block, however
many queries or rows there are.  The best ``k`` of each block and query are
merged.  Every row is indexed; nothing is fitted (the rotation is random).

Cases: vectors that are null, empty or zero, hold nulls or non-finite
components, have another than the most frequent length, or have a null id
take no part; rows that repeat an id count once, with their smallest vector;
fewer than k candidates are all returned; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import short_batches

K = 20
BLOCK = 4096
EPSILON = 1.9
CODE_BITS = 256
SEED = 7
# queries that are estimated against a block at once
STEP = 64


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """The first ``dims`` columns of a random orthogonal matrix: all that meets a padded vector."""
    d = max(CODE_BITS, -(-dims // 64) * 64)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return (q * np.sign(np.diag(r)))[:, :dims]


@dataclass
class Codes:
    bits: np.ndarray       # n x d / 8 packed signs
    norm: np.ndarray
    f: np.ndarray          # inner product of a rotated unit vector with its normalised code

    def signs(self) -> np.ndarray:
        """n x d matrix of -1 and 1."""
        return 2 * np.unpackbits(self.bits, axis=1, bitorder="little").astype(np.float32) - 1


def _rotated(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    return (vectors / norm[:, None]) @ turn.T, norm


def encode(vectors: np.ndarray, turn: np.ndarray) -> Codes:
    x, norm = _rotated(vectors, turn)
    return Codes(np.packbits(x > 0, axis=1, bitorder="little"), norm,
                 np.abs(x).sum(axis=1) / np.sqrt(x.shape[1]))


def bounds(queries: np.ndarray, codes: Codes, signs: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors) and how far off they may be."""
    y, norm = _rotated(queries, turn)
    d = y.shape[1]
    near = (y * norm[:, None]).astype(np.float32) @ signs.T
    near *= (codes.norm / codes.f / np.sqrt(d)).astype(np.float32)
    spread = EPSILON * np.sqrt(np.maximum(1 - codes.f ** 2, 0) / (d - 1)) / codes.f
    return near, norm[:, None].astype(np.float32) * (codes.norm * spread).astype(np.float32)


def exact(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the columns a[:, i] and b[:, j], each summed from the first component to the last."""
    total = np.zeros(len(i))
    for x, y in zip(a, b):
        total += x[i] * y[j]
    return total


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                 codes: Codes, turn: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query_id, vec_id, score) of each query's best k of the block, a few queries at a time.

    ``vectors`` has a column per candidate, ``queries`` a row per query.
    """
    n, signs = len(ids), codes.signs()
    for lo in range(0, len(queries), STEP):
        qid, q = query_ids[lo:lo + STEP], queries[lo:lo + STEP]
        columns = np.ascontiguousarray(q.T)
        near, off = bounds(q, codes, signs, turn)
        own_i, own_j = np.nonzero(qid[:, None] == ids[None, :])
        near[own_i, own_j] = -np.inf
        rows = np.arange(len(q))[:, None]
        kth = np.full(len(q), -np.inf)
        if n > k + 1:
            first = np.argpartition(near, n - min(2 * k, n - 1), axis=1)[:, -min(2 * k, n - 1):]
            s = exact(columns, np.broadcast_to(rows, first.shape).ravel(), vectors, first.ravel()).reshape(first.shape)
            s[near[rows, first] == -np.inf] = -np.inf
            kth = np.partition(s, -k, axis=1)[:, -k]
        near += off
        i, j = np.nonzero((near >= kth[:, None].astype(np.float32) - np.float32(1e-6)) & (near > -np.inf))
        s = exact(columns, i, vectors, j)
        order = np.lexsort((ids[j], -s, i))
        i, j, s = i[order], j[order], s[order]
        top = np.arange(len(i)) - np.searchsorted(i, i) < k
        yield qid[i[top]], ids[j[top]], s[top]


def valid(vec: Column, dims: Column | int) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (F.size(vec) == dims) & finite & F.exists(vec, lambda x: x != 0)


def nearest(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", *,
            k: int = K, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest ``k`` of each row for which ``is_query`` holds of the
    id column ``id``; ranks from 1."""
    named = rows.select(F.col(id_col).cast("long").alias("id"),
                        F.col(vector_col).cast("array<double>").alias("vector")).filter("id is not null")
    common = (named.filter("size(vector) > 0").groupBy(F.size("vector").alias("dims"))
              .agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "dims").first())
    dims = common.dims if common else 1
    vectors = (named.filter(valid(F.col("vector"), F.lit(dims)))
               .groupBy("id").agg(F.min("vector").alias("vector")))
    blocks = max(1, -(-(common.rows if common else 1) // block))
    of_block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    candidates = vectors.select(of_block.alias("block"), F.lit(0).alias("kind"), "id", "vector")
    queries = vectors.filter(is_query).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "vector")
    met = (candidates.unionByName(queries).repartition(2 * blocks, "block")
           .sortWithinPartitions("block", "kind", "id"))

    def search(batches):
        turn = rotation(dims)
        at, ids, vecs, codes = None, [], [], None
        for b in batches:
            block_, kind, id_ = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            vector = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            cut = np.flatnonzero((np.diff(block_) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(id_)]):
                if lo == hi:
                    continue
                if block_[lo] != at:
                    at, ids, vecs, codes = block_[lo], [], [], None
                if kind[lo] == 0:
                    ids.append(id_[lo:hi])
                    vecs.append(vector[lo:hi])
                elif ids:
                    if codes is None:
                        held_ids, held = np.concatenate(ids), np.concatenate(vecs)
                        codes = encode(held, turn)
                        held = np.ascontiguousarray(held.T)
                    for out in search_block(id_[lo:hi], vector[lo:hi], held_ids, held, codes, turn, k):
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out],
                                                         names=["query_id", "vec_id", "score"])

    best = short_batches(met).mapInArrow(search, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
