import random
import zlib

from llm.fixture import SCHEMA, documents

from dimwright.llm import sharding
from dimwright.llm.sharding import Points, minimax_cuts, minimax_shards


def best(weights, shards):
    """Smallest feasible capacity by trying each candidate sum."""
    def fits(c):
        n, at = 1, 0
        for w in weights:
            if w > c:
                return False
            if at + w > c:
                n, at = n + 1, 0
            at += w
        return n <= shards
    return min(c for i in range(len(weights)) for j in range(i, len(weights)) if fits(c := sum(weights[i:j + 1])))


def test_capacity_is_minimal(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKETS", 8)     # several rounds of refinement
    for seed in range(4):
        rng = random.Random(seed)
        w = [rng.randrange(1, 90) for _ in range(70)]
        p, rows = 0, []
        for i, x in enumerate(w):
            p += x
            rows.append((i // 20, p))
        cap, cuts = minimax_cuts(spark.createDataFrame(rows, "bucket int, p long"), 6)
        assert cap == best(w, 6) and cuts[-1] == p
        assert max(b - a for a, b in zip([0, *cuts], cuts)) == cap


def test_bounds():
    p = Points([10, 20, 30], [True, False, True])
    assert p.step(0, 5, True) == 5 and p.step(0, 5, False) == 0 and p.step(0, 15, True) == 10


def test_rows(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = minimax_shards(docs, 7).collect()
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (d or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    shard_of, by = {}, {}
    text = {}
    for d, t in rows:
        text.setdefault((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())), t)
    for r in got:
        t = text[(r.doc_id, r.size, r.text_crc32)]
        assert shard_of.setdefault(t, r.shard) == r.shard
        by.setdefault(r.shard, []).append((r.slot, r.size))
    assert all(sorted(s for s, _ in x) == list(range(len(x))) for x in by.values())
    assert set(by) <= set(range(7)) and len(by) >= 5
    sums = {s: sum(z for _, z in x) for s, x in by.items()}
    group = {}
    for d, t in rows:
        group[t] = group.get(t, 0) + len((t or "").encode()) + 16
    assert max(sums.values()) <= max(max(group.values()), sum(group.values()) / 7 * 1.35)


def test_empty(spark):
    assert minimax_shards(spark.createDataFrame([], SCHEMA)).collect() == []
