"""Operator 11 against plain Python with whole numbers."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from dimwright.llm.centroids import _blocks, dictionary_clusters, slab, with_digests

SCHEMA = "vec_id long, embedding array<double>, cluster string, id int"


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) and abs(x) < 500_000 for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cent = [x for _, x in order[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cent))
    for _ in range(rounds):
        of = {}
        for _, x in kept:
            of.setdefault(near(x)[1], []).append(x)
        cent = [[sum(col) // len(of[n]) for col in zip(*of[n])] if n in of else c for n, c in enumerate(cent)]
    got = [(i, *near(x)[::-1]) for i, x in kept]
    per = {}
    for _, c, d in got:
        per[c] = per.get(c, 0) + d
    return sorted(((i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, cent[c])).encode()).hexdigest()) for i, c, d in got), key=repr)


def vectors(seed, n, dims):
    rng = random.Random(seed)
    base = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, .2) for x in rng.choice(base)]) for i in range(n)]
    rows += [(n + i, rows[2][1]) for i in range(30)] + [rows[0], (None, rows[1][1]), (5, [-x for x in rows[5][1]])]
    rows += [(900, None), (901, []), (902, [1.0] * (dims - 1)), (903, [None] * dims), (904, [float("nan")] + [0.0] * (dims - 1)),
             (905, [float("-inf")] * dims), (906, [0.0] * dims), (907, [-0.0] * dims), (908, [1e300] * dims), (909, [400_000.0] + [0.0] * (dims - 1))]
    return rows


@pytest.mark.parametrize("k,dims,block,size", [(5, 7, 2, 16), (5, 7, 3, 8192), (40, 8, 1, 50), (500, 4, 4, 8)])
def test_clusters(spark, k, dims, block, size):
    rows = vectors(k + block, 120, dims)
    v = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA).repartition(3)
    got = with_digests(*dictionary_clusters(v, k=k, rounds=3, dims=dims, block=block, slab_size=size))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, k, 3, dims)


def test_nothing_kept(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        m, c = dictionary_clusters(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert with_digests(m, c).collect() == [] and c.count() == 0


def test_slab_loses_nothing():
    rng = np.random.default_rng(3)
    x = rng.integers(-5, 5, (300, 9)).astype(np.int32)
    for block in (1, 2, 4):
        row = slab(pa.array(range(300)), x, block).to_pylist()[0]
        back = np.concatenate([words[codes] for _, words, codes in _blocks(row, 9, block)], axis=1)
        assert (back == x).all()
