"""Operator 13 against a tree built in plain Python, and tampered rows."""

import hashlib

import pytest
from llm.fixture import SCHEMA, documents
from pyspark.sql import functions as F

from dimwright.llm.merkle import COLUMNS, fold, merkle_manifest, proof


def H(*parts):
    return hashlib.sha256(b"".join(p if isinstance(p, bytes) else p.encode() for p in parts)).hexdigest()


def field(v):
    return b"-" if v is None else str(len(str(v).encode())).encode() + b":" + str(v).encode()


def brute(rows, found=lambda r: r):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root) of rows given as tuples of COLUMNS."""
    def climb(nodes):
        """[levels of nodes], the last of one."""
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
        return out

    def way(tree, p):
        for level in tree[:-1]:
            lo = p // 8 * 8
            yield level[lo:p], level[p + 1:lo + 8]
            p //= 8
    of = {}
    for r in rows:
        of.setdefault(b"" if r[2] is None else b"=" + r[2].encode(), []).append((r[0] is not None, r[0] or 0, H(*map(field, r)), r))
    groups = sorted(of)
    trees = {g: climb([x[2] for x in sorted(of[g], key=lambda x: x[:3])]) for g in groups}
    trunk = climb([trees[g][-1][0] for g in groups])
    out = []
    for at, g in enumerate(groups):
        for p, (_, _, leaf, r) in enumerate(sorted(of[g], key=lambda x: x[:3])):
            path = [*way(trees[g], p), *way(trunk, at)]
            h = H(*map(field, found(r)))
            for a, b in path:
                h = H(*a, h, *b)
            out.append((r[0], leaf, trees[g][-1][0], trunk[-1][0], H(*(x for a, b in path for x in [*a, *b])), h))
    return sorted(out, key=repr)


def result(m):
    m = m.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")), fold(F.col("path"), F.col("found_leaf")))
    return sorted((tuple(r) for r in m.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 7, 60, 150])
def test_tree(spark, n):
    docs = documents(spark, n=n).repartition(3)
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    got = merkle_manifest(docs, found={"text": F.lower("text")})
    assert result(got) == brute(rows, lambda r: (*r[:4], r[4] and r[4].lower()))


def test_many_groups(spark):
    """Seventy groups, some of one leaf, among them the null and the empty one."""
    rows = [(i, f"t{i}", None if i % 50 == 0 else "" if i % 50 == 1 else f"ä{i % 68}", "s", i, "x", 1, None) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(merkle_manifest(docs)) == brute([tuple(r) for r in docs.select(*COLUMNS).collect()])


def test_single_leaf_and_empty_table(spark):
    one = spark.createDataFrame([(4, "Text", None, None, None, None, None, None)], SCHEMA)
    r = merkle_manifest(one).collect()[0]
    assert r.leaf == r.subroot == r.root and r.path == []
    assert merkle_manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_changed_field_is_seen(spark):
    docs = documents(spark, n=40)
    m = merkle_manifest(docs, found={"source": F.when(F.col("doc_id") == 7, "other").otherwise(F.col("source"))})
    bad = m.where(fold(F.col("path"), F.col("found_leaf")) != F.col("root")).select("doc_id").collect()
    assert [r.doc_id for r in bad] == [7]
