"""Operators 2 and 10 against brute force."""

import hashlib
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from llm.fixture import SCHEMA, documents

from dimwright.llm import substring, suffix
from dimwright.llm.substring import substring_dedup
from dimwright.llm.suffix import prefix_hashes, suffix_dedup, suffix_order
from dimwright.llm.windows import RUN, SPAN, TURNS, send_runs, unpack

BIG = 2**63 - 1


def brute(rows, symbols, join, length):
    first = {}
    seqs = [(BIG if d is None else d, d, symbols(t or "")) for d, t in rows]
    for o, _, s in seqs:
        for i in range(len(s) - length + 1):
            k = tuple(s[i:i + length])
            first[k] = min(o, first.get(k, o))
    out = []
    for o, d, s in seqs:
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            if first[tuple(s[i:i + length])] < o:
                gone[i:i + length] = [True] * length
        kept = join([x for x, g in zip(s, gone) if not g])
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((-1 if d is None else d, len(s), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    docs = documents(spark, seed).repartition(5)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup(docs).collect())
    assert got == brute(rows_of(docs), lambda t: list(t.encode()), bytes, 50)


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    docs = documents(spark, seed).repartition(5)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(docs).collect())
    want = brute(rows_of(docs), lambda t: re.findall(r"[^\x20\x09-\x0D]+", t), lambda w: " ".join(w).encode(), 13)
    assert got == [(d, n, r, h) for d, n, r, _, h in want]


@pytest.mark.parametrize("op", [suffix, substring])
def test_many_runs_on_one_anchor(op):
    """A passage among other words in 300,000 documents: no long stretch beside it repeats."""
    rng = np.random.default_rng(5)
    n = 300_000
    if op is suffix:
        passage, side, chance = "".join(map(chr, rng.integers(97, 123, 60))), 30, 12
        other = rng.integers(97, 123, (2, n, side)).astype(np.uint8)
        texts = [a.tobytes() + passage.encode() + b.tobytes() for a, b in zip(*other)]
        size = len(passage)
    else:
        passage, side, chance, size = " ".join(f"p{i}" for i in range(15)), 8, 3, 15
        other = rng.integers(0, 10**6, (2, n, side)).tolist()
        texts = [" ".join([*map(str, a), passage, *map(str, b)]).encode() for a, b in zip(*other)]
    docs = pa.record_batch([pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "uid", "text"])
    spans = [unpack(p, SPAN) for b in send_runs(iter([docs]), op.spec(), 1)
             for k, p in zip(b.column("kind").to_pylist(), b.column("payload").to_pylist()) if k == 1]
    s = np.concatenate(spans)
    assert len(s) and s["lo"].min() >= side - chance and s["hi"].max() <= side + size + chance


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup(none).collect() == [] and substring_dedup(none).collect() == []


def test_suffix_order_sorts():
    rng = np.random.default_rng(3)
    buf = rng.integers(97, 99, 3000).astype(np.uint8)
    buf[500:900] = buf[100:500]
    pos = np.arange(len(buf) - 50)
    o = suffix_order(buf, prefix_hashes(buf), pos, 50)
    raw = buf.tobytes()
    assert [raw[p:p + 50] for p in pos[o]] == sorted(raw[p:p + 50] for p in pos)


@pytest.mark.parametrize("op", [suffix, substring])
def test_turns_share_out_the_runs(op):
    """Each run is sent in one turn, and no turn sends most of them."""
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 500, 300)).encode() for _ in range(200)]
    docs = pa.record_batch([pa.array(range(200), pa.int64()), pa.array(range(200), pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "uid", "text"])

    def sent(*turn):
        return [r for b in send_runs(iter([docs]), op.spec(), 1, *turn)
                for k, p in zip(b.column("kind").to_pylist(), b.column("payload").to_pylist()) if k == 0 for r in unpack(p, RUN).tolist()]
    every, shares = sent(), [sent(t, TURNS) for t in range(TURNS)]
    assert len(every) > 1000 and sorted(sum(shares, [])) == sorted(every)
    assert TURNS > 1 and max(map(len, shares)) < 0.65 * len(every)


@pytest.mark.parametrize("dedup", [suffix_dedup, substring_dedup])
def test_shuffle_files_go_as_tables_are_written(spark, dedup):
    """What a table was gathered from does not lie on disk while the next one is."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        f = disk.getAllFiles()
        return {name for i in range(f.size()) if (name := f.apply(i).getName()).startswith("shuffle_")}
    docs = documents(spark, 1).repartition(5).cache()
    docs.count()
    spark._jvm.System.gc()
    time.sleep(2)
    before = held()
    out = dedup(docs)       # its last step has not run yet
    for _ in range(50):
        if not (left := held() - before):
            break
        time.sleep(0.1)
    assert not left and out.count() == docs.count()
    docs.unpersist()
