"""Centroid clustering on subvector dictionaries, in whole numbers.

Vectors become integers and are stored once as slabs of SLAB vectors. A slab
cuts the dimensions into blocks of BLOCK and keeps, for each block, its distinct
subvectors and a code per vector: nothing is lost, and a dictionary is bounded
by the slab, whatever the table's size. In every round a task works out the
exact squared distance of each distinct subvector to each centroid once, and a
vector's distance is the sum of its codes' entries. The same codes give the sums
of a cluster: how often a code occurs in it, times the subvector. Tasks return a
row a centroid; only those sums and the centroids meet on the driver.

The start is the ``k`` vectors of smallest sha256 of ``seed:id``; an empty
cluster keeps its centroid; ties go to the smaller number.

Edge cases: vectors that are null, of another length, or hold a null or
non-finite component are left out, and so are those with an integer component
of LIMIT or more, whose squared distances would not fit a long; a null id is
clustered and starts no centroid before the others; rows that share an id are
rows of their own and start centroids in the order of their components; with
fewer than k vectors there are fewer centroids; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.operators.keys import materialize

CENTROIDS = 40
ROUNDS = 5
DIMS = 64
SCALE = 256
SEED = 2
BLOCK = 2           # dimensions of a subvector
SLAB = 8192         # vectors that share dictionaries
LIMIT = 2**27


def kept(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(id, x) of the vectors that take part; x holds the integers."""
    e = F.col("embedding").cast("array<double>")
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * scale >= LIMIT - 1))
    v = vectors.select(F.col("vec_id").cast("long").alias("id"), e.alias("e"))
    return v.where((F.size("e") == dims) & ~bad).select("id", F.transform("e", lambda x: F.floor(x * scale).cast("int")).alias("x"))


def slab(ids: pa.Array, x: np.ndarray, block: int) -> pa.RecordBatch:
    """One row: ids, and by block of dimensions the codes and the distinct subvectors."""
    codes, size, words = [], [], []
    for at in range(0, x.shape[1], block):
        part = np.ascontiguousarray(x[:, at:at + block])
        wide = part.itemsize * part.shape[1]
        whole = part.view(f"<i{wide}" if wide in (4, 8) else np.dtype((np.void, wide))).ravel()
        _, first, code = np.unique(whole, return_index=True, return_inverse=True)
        codes.append(code.astype("<u2").tobytes())
        size.append(len(first))
        words.append(part[first].astype("<i4").tobytes())
    return pa.record_batch([pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([b"".join(codes)], pa.binary()),
                            pa.array([size], pa.list_(pa.int32())), pa.array([b"".join(words)], pa.binary())],
                           names=["ids", "codes", "sizes", "words"])


def _encode(batches: Iterator[pa.RecordBatch], dims: int, block: int, most: int) -> Iterator[pa.RecordBatch]:
    ids, xs, held = [], [], 0

    def full(n):
        """The slab of the first n held vectors; the rest stays."""
        nonlocal ids, xs, held
        every, x = pa.concat_arrays(ids), np.concatenate(xs)
        ids, xs, held = [every[n:]], [x[n:]], held - n
        return slab(every[:n], x[:n], block)

    for b in batches:
        if b.num_rows:
            ids.append(b.column("id"))
            xs.append(b.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(b.num_rows, dims))
            held += b.num_rows
        while held >= most:
            yield full(most)
    if held:
        yield full(held)


def _blocks(row: dict, dims: int, block: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(dimensions, distinct subvectors, codes) of a slab."""
    n, at = len(row["ids"]), 0
    for i, (lo, size) in enumerate(zip(range(0, dims, block), row["sizes"])):
        wide = min(block, dims - lo)
        words = np.frombuffer(row["words"], "<i4", size * wide, at).reshape(size, wide).astype(np.int64)
        at += 4 * size * wide
        yield slice(lo, lo + wide), words, np.frombuffer(row["codes"], "<u2", n, 2 * n * i)


def nearest(row: dict, centroids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of a slab's vectors."""
    total = np.zeros((len(row["ids"]), len(centroids)), np.int64)
    for dims, words, codes in _blocks(row, centroids.shape[1], block):
        table = np.zeros((len(words), len(centroids)), np.int64)
        for c, w in zip(centroids[:, dims].T, words.T):
            table += (w[:, None] - c) ** 2
        total += table[codes]
    best = total.argmin(1)
    return best, total[np.arange(len(total)), best]


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
    """Vectors and component sums of each cluster, over all slabs of the task."""
    k, dims = centroids.shape
    n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for b in batches:
        for row in b.to_pylist():
            best, _ = nearest(row, centroids, block)
            n += np.bincount(best, minlength=k)
            for at, words, codes in _blocks(row, dims, block):
                seen = np.bincount(best * len(words) + codes, minlength=k * len(words)).reshape(k, len(words))
                sums[:, at] += seen @ words
    yield pa.record_batch([pa.array(range(k), pa.int32()), pa.array(n), *(pa.array(sums[:, d]) for d in range(dims))],
                          names=["cluster", "n", *(f"s{d}" for d in range(dims))])


def _assign(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            best, far = nearest(row, centroids, block)
            yield pa.record_batch([pa.array(row["ids"], pa.int64()), pa.array(best.astype(np.int32)), pa.array(far)], names=["vec_id", "cluster", "distance"])


def dictionary_clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE,
                        seed: int = SEED, block: int = BLOCK, slab_size: int = SLAB) -> tuple[DataFrame, DataFrame]:
    """Members (vec_id, cluster, distance) and clusters (cluster, n, cluster_inertia, centroid), at most k rows,
    of vectors(vec_id, embedding)."""
    if not 0 < slab_size <= 1 << 16:
        raise ValueError("a slab holds 1 to 65,536 vectors")
    spark = vectors.sparkSession
    v = kept(vectors, dims, scale)
    start = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = v.orderBy(start.asc_nulls_last(), "x").limit(k).select("x").collect()
    members = "vec_id long, cluster int, distance long"
    if not first:
        return spark.createDataFrame([], members), spark.createDataFrame([], "cluster int, n long, cluster_inertia long, centroid array<int>")
    centroids = np.array([r.x for r in first], np.int64)
    slabs = materialize(v.mapInArrow(lambda it: _encode(it, dims, block, slab_size), "ids array<long>, codes binary, sizes array<int>, words binary"), "slabs")
    for _ in range(rounds):
        parts = slabs.mapInArrow(lambda it, c=centroids: _sums(it, c, block), "cluster int, n long, " + ", ".join(f"s{d} long" for d in range(dims)))
        new = centroids.copy()
        for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(f"s{d}").alias(f"s{d}") for d in range(dims))).collect():    # k rows
            if r.n:
                new[r.cluster] = [r[f"s{d}"] // r.n for d in range(dims)]
        centroids = new
    found = materialize(slabs.mapInArrow(lambda it, c=centroids: _assign(it, c, block), members), "clusters")
    per = {r.cluster: r for r in found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, per[c].n if c in per else 0, int(per[c].s) if c in per else 0, centroids[c].tolist()) for c in range(len(centroids))]
    return found, spark.createDataFrame(rows, "cluster int, n long, cluster_inertia long, centroid array<int>")


def with_digests(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """Members with the sums of their cluster and of all, and the sha256 of their centroid."""
    rows = clusters.collect()       # at most k
    total = sum(r.cluster_inertia for r in rows)
    told = [(r.cluster, r.cluster_inertia, total, hashlib.sha256(",".join(map(str, r.centroid)).encode()).hexdigest()) for r in rows]
    if total > 2**63 - 1:
        raise OverflowError(f"the inertia has 2 ** {math.log2(total):.0f} or more and does not fit a long")
    side = members.sparkSession.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return members.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
