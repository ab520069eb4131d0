import re

import numpy as np
from llm.fixture import SCHEMA, documents
from pyspark.sql import functions as F

from dimwright.llm import minhash
from dimwright.llm.minhash import near_duplicates


def brute(rows):
    def shingle_set(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    big = 2**63 - 1
    sets = [(big if d is None else d, shingle_set(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    comp = [(d, len(s), find(d) if s else d) for d, s in sets]      # a row without shingles links with nothing
    return sorted((-1 if d == big else d, n, -1 if c == big else c, c == d) for d, n, c in comp)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def result(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id, r.kept) for r in df.collect())


def test_components(spark, monkeypatch):
    docs = documents(spark, 4, 80).repartition(4)
    assert result(near_duplicates(docs)) == brute(rows_of(docs))


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(30):     # a chain: neighbours link, ends do not
        rows.append((100 - i, " ".join(base[i * 3:] + [f"n{j}" for j in range(i * 3)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(docs)) == brute(rows)


def test_every_union_size(spark):
    """Pairs of 60 to 100 shingles that just link, subsets included; each pair has its own words, all texts share some."""
    rows = []

    def pair(a, b, both):       # sets of a and b shingles that share `both`
        at = len(rows)
        common = [f"{at}c{i}" for i in range(both + 4)]
        rows.extend((at + t, " ".join(common + [f"{at}{t}x{i}" for i in range(size - both)])) for t, size in enumerate((a, b)))

    for a in range(60, 101):
        pair(a, -(-3 * a // 4), -(-3 * a // 4))     # the least subset
        pair(a, a - a // 12, a - a // 12)
        pair(a, a, -(-6 * a // 7))                  # equal sizes
        pair(a, a - 3, -(-3 * (2 * a - 3) // 7))
        pair(a, a, -(-6 * a // 7) - 1)              # just no link
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(near_duplicates(docs))
    assert sum(not kept for *_, kept in got) == 41 * 4
    assert got == brute(rows)


def test_needed_is_the_least_over_unions(spark):
    n = np.arange(1, 400)
    got = [r[0] for r in spark.range(1, 400).select(minhash.needed(F.col("id"))).collect()]
    assert got == minhash._need(n).tolist()
    for size, need in zip(n.tolist(), got):
        for union in range(size, min(minhash.K, size * 4 // 3) + 1):
            assert need <= -(-3 * union // 4)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
