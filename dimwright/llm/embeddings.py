"""Near-duplicate vectors by an exact metric range join.

Unit vectors with cosine >= COSINE lie within r = sqrt(2 - 2 * COSINE) of each
other. Pivots cut the space into cells (a vector's home is its nearest pivot).
For x at home at p, every vector within r of x lies, by the triangle
inequality, on x's side of the border to pivot q or at most r beyond it; so each
vector is also sent to every cell whose border it comes within r of, and a cell
finds all links of the vectors at home there without the others. A cell's home
vectors are cut into blocks of BLOCK that work alone and read the cell's vectors
as a stream, so a dense cell gets more tasks, not larger ones.

Equal vectors are one class with a count. Products in single precision pick
candidates (with a margin above their error), double precision decides, a slice
of the pairs at a time: memory grows with a block, not with its links.

Vectors spread evenly over many dimensions lie near every border, and any exact
join of them compares nearly all pairs; the cells prune as far as the vectors
cluster.

Edge cases: null vectors, zero vectors and vectors with a null or non-finite
component link with nothing, nor do vectors of other lengths with each other;
components near the limits of a double are scaled by a power of two first;
rows that share a vec_id are one node; a null vec_id orders last and stays
null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import NULL_ID, columns_of, components, width
from dimwright.operators.keys import materialize

COSINE = 0.9
PIVOT_SAMPLE = 2000     # vectors that pivots are chosen among
PIVOTS = 16
BLOCK = 4096
TILE = 256              # vectors of a block multiplied at once
SLICE = 32_768          # candidate pairs decided at once
_SLACK = 1e-4           # above the rounding error of single-precision products


def choose_pivots(v: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first pivots of unit vectors."""
    out = [0]
    far = np.full(len(v), np.inf)
    for _ in range(min(n, len(v)) - 1):
        far = np.minimum(far, 2 - 2 * v @ v[out[-1]])
        if far.max() <= 1e-9:
            break
        out.append(int(far.argmax()))
    return v[out]


def cells(v: np.ndarray, pivots: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """(home, near): near[i, c] if cell c must see vector i."""
    cos = v @ pivots.T
    home = cos.argmax(1)
    gap = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
    beyond = cos[np.arange(len(v)), home][:, None] - cos        # times 1 / gap: distance to the border
    return home, beyond <= (r + 1e-6) * gap[home] + 1e-9


def normed(v: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by a power of two first, so that no square overflows or vanishes."""
    v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, initial=0))[1][:, None])
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _unit(rows: list[bytes]) -> np.ndarray:
    return normed(np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1))


def close_pairs(a: np.ndarray, b: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of unit vectors of a and b with the cosine, slice by slice: memory does not grow with the pairs."""
    a32, b32 = a.astype(np.float32), b.astype(np.float32).T.copy()
    for lo in range(0, len(a), TILE):
        i, j = np.nonzero(a32[lo:lo + TILE] @ b32 >= cosine - _SLACK)
        i += lo
        for at in range(0, len(i), SLICE):
            p, q = i[at:at + SLICE], j[at:at + SLICE]
            ok = np.einsum("ij,ij->i", a[p], b[q]) >= cosine
            yield p[ok], q[ok]


def _deal(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray], r: float) -> Iterator[pa.RecordBatch]:
    """Vectors to the units (dim, cell, block) they work in (kind 0) or are read by (kind 1)."""
    for ids, dims, blocks, nbs, counts, raw in columns_of(batches, "id", "dim", "block", "nb", "n", "raw"):
        for dim in set(dims):
            mine = [i for i, d in enumerate(dims) if d == dim]
            v = _unit([raw[i] for i in mine])
            home, near = cells(v, pivots[dim], r)
            out = []
            for i, h, seen in zip(mine, home.tolist(), near):
                out.append((dim, h, blocks[i], 0, ids[i], counts[i], raw[i]))
                out += [(dim, int(c), b, 1, ids[i], counts[i], raw[i]) for c in np.flatnonzero(seen) for b in range(nbs[i])]
            for lo in range(0, len(out), 5000):
                cols = list(zip(*out[lo:lo + 5000]))
                yield pa.record_batch([pa.array(c, pa.binary() if k == 6 else pa.int64()) for k, c in enumerate(cols)],
                                      names=["dim", "cell", "block", "kind", "id", "n", "raw"])


def _join(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Of each vector at home: links (as counts of vectors) and the smallest linked ids, found in one stream."""
    now, home, block, ids, links, forest = None, [], None, None, None, None

    def close():
        if block is None:
            return
        n, parents = links, forest.edges
        a = pa.array(ids.tolist() + [x for x, _ in parents], pa.int64())
        yield pa.record_batch([a, pa.array([None] * len(ids) + [y for _, y in parents], pa.int64()),
                               pa.array(n.tolist() + [0] * len(parents), pa.int64())], names=["a", "b", "n_links"])

    for b in batches:
        dims, cs, bs, kinds, vid, counts, raw = (b.column(x).to_pylist() for x in ("dim", "cell", "block", "kind", "id", "n", "raw"))
        lo = 0
        for hi in range(1, len(vid) + 1):
            if hi < len(vid) and (dims[hi], cs[hi], bs[hi], kinds[hi]) == (dims[lo], cs[lo], bs[lo], kinds[lo]):
                continue
            key = dims[lo], cs[lo], bs[lo]
            if key != now:
                yield from close()
                now, home, block = key, [], None
            if kinds[lo] == 0:
                home += list(zip(vid[lo:hi], raw[lo:hi]))
            elif home:
                if block is None:
                    ids = np.array([x for x, _ in home])
                    block, links, forest = _unit([x for _, x in home]), np.zeros(len(ids), np.int64), Forest(ids)
                v, other, n = _unit(raw[lo:hi]), np.array(vid[lo:hi]), np.array(counts[lo:hi])
                forest.meet(other)
                for i, j in close_pairs(block, v, cosine):
                    apart = ids[i] != other[j]
                    np.add.at(links, i[apart], n[j[apart]])
                    up = other[j] < ids[i]
                    forest.link(i[up], j[up])
            lo = hi
    yield from close()


class Forest:
    """Spanning forest of links between the vectors of a block and those that stream by.

    ``edges`` holds a link only if it joins two parts that were apart, so it grows
    with the vectors, not with the links.
    """

    def __init__(self, ids: np.ndarray):
        self.ids, self.n, self.edges = ids, len(ids), []
        self.part = np.arange(self.n)       # the smallest place in the same part; the block's places come first
        self.other = ids[:0]

    def meet(self, other: np.ndarray) -> None:
        """The next vectors of the stream; parts of the block are kept."""
        self.other = other
        self.part = np.concatenate([self.part[:self.n], np.arange(self.n, self.n + len(other))])

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        """Links between block[i] and other[j]."""
        while True:
            a, b = self.part[i], self.part[self.n + j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            _, one = np.unique(a, return_index=True)        # a link of each part at most, then look again
            root: dict[int, int] = {}
            for x, y, p, q in zip(i[one].tolist(), j[one].tolist(), a[one].tolist(), b[one].tolist()):
                while p in root:
                    p = root[p]
                while q in root:
                    q = root[q]
                if p != q:
                    root[max(p, q)] = min(p, q)
                    self.edges.append((int(self.ids[x]), int(self.other[y])))
            up = np.arange(len(self.part))
            up[list(root)] = list(root.values())
            while (up != up[up]).any():
                up = up[up]
            self.part = up[self.part]


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of vectors(vec_id, embedding)."""
    spark = vectors.sparkSession
    r = float(np.sqrt(2 - 2 * cosine))
    e = F.col("embedding").cast("array<double>")
    fine = F.coalesce(~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(e, lambda x: x != 0), F.lit(False))
    v = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.when(fine, F.transform(e, lambda x: x + F.lit(0.0))).alias("e"))
    key = F.xxhash64("e"), F.hash("e"), F.size("e")
    v = materialize(v.select("id", "e", *(k.alias(f"k{i}") for i, k in enumerate(key))), "vectors")
    classes = (v.where("e is not null").groupBy("k0", "k1", "k2")
               .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("e").alias("e")))
    classes = materialize(classes, "vector-classes")
    dims = {}
    for row in classes.groupBy("k2").agg(F.count(F.lit(1)).alias("n")).collect():      # a row for each length of vector
        some = classes.where(F.col("k2") == row.k2).orderBy("k0", "id").limit(PIVOT_SAMPLE).select("e").collect()
        s = np.array([x.e for x in some])
        dims[row.k2] = choose_pivots(normed(s), PIVOTS), row.n
    if not dims:
        return v.select(F.nullif("id", F.lit(NULL_ID)).alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                        F.nullif("id", F.lit(NULL_ID)).alias("component_id"), F.lit(True).alias("kept"))
    # blocks of a cell: the whole table's size over BLOCK and the pivots, so that an even cell's blocks are full
    nb = F.lit(1)
    for dim, (p, n) in dims.items():
        nb = F.when(F.col("k2") == dim, -(-n // (BLOCK * len(p)))).otherwise(nb)
    pivots = spark.sparkContext.broadcast({d: p for d, (p, _) in dims.items()})
    raw = classes.select("id", F.col("k2").cast("long").alias("dim"), F.pmod(F.xxhash64("id", "k1"), nb).cast("long").alias("block"),
                         nb.cast("long").alias("nb"), "n", "e")

    def packed(batches):
        for b in batches:
            e = b.column("e")
            size = np.diff(e.offsets.to_numpy())
            flat = e.flatten().to_numpy().tobytes()
            at = np.concatenate([[0], np.cumsum(size)]) * 8
            yield pa.record_batch([*(b.column(x) for x in ("id", "dim", "block", "nb", "n")), pa.array([flat[x:y] for x, y in zip(at, at[1:])], pa.binary())],
                                  names=["id", "dim", "block", "nb", "n", "raw"])

    dealt = raw.mapInArrow(lambda it: _deal(packed(it), pivots.value, r), "dim long, cell long, block long, kind long, id long, n long, raw binary")
    units = dealt.repartition(width(spark), "dim", "cell", "block").sortWithinPartitions("dim", "cell", "block", "kind")
    found = materialize(units.mapInArrow(lambda it: _join(it, cosine), "a long, b long, n_links long"), "vector-links")
    comp = components(found.where("b is not null"))
    count = found.where("b is null").groupBy("a").agg(F.sum("n_links").alias("l"))
    per = (classes.select("k0", "k1", "k2", F.col("id").alias("rep"), "n").join(count, F.col("rep") == F.col("a"), "left")
           .join(comp, F.col("rep") == F.col("node"), "left").select("k0", "k1", "k2", "rep", "n", "l", "component"))
    out = v.withColumn("ok", F.col("e").isNotNull()).drop("e").join(per, ["k0", "k1", "k2"], "left")
    c = F.when(F.col("ok"), F.coalesce("component", "rep")).otherwise(F.col("id"))
    return out.select(F.nullif("id", F.lit(NULL_ID)).alias("vec_id"),
                      F.when(F.col("ok"), F.coalesce("l", F.lit(0)) + F.col("n") - 1).otherwise(0).cast("long").alias("n_links"),
                      F.nullif(c, F.lit(NULL_ID)).alias("component_id"), (c == F.col("id")).alias("kept"))
