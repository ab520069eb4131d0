import hashlib
import random
import re

from llm.fixture import SCHEMA, documents

from dimwright.llm.decontam import decontaminate


def split(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(rows, items):
    wins = [(str(i) if i is not None else "", tuple(w[k:k + 10])) for i, t in items if (w := split(t)) for k in range(max(1, len(w) - 9))]
    out = []
    for d, t in rows:
        w = split(t)
        hit, got = [False] * len(w), set()
        for i, x in wins:
            for p in range(len(w) - len(x) + 1):
                if tuple(w[p:p + len(x)]) == x:
                    hit[p:p + len(x)] = [True] * len(x)
                    got.add(i)
        names = sorted(got)
        out.append((-1 if d is None else d, len(w), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), any(hit)))
    return sorted(out)


def test_against_brute_force(spark):
    docs = documents(spark, 6).repartition(3)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    long = [t for _, t in rows if t and len(t.split()) > 40]
    items = [(n, " ".join(t.split()[5:5 + k])) for n, (t, k) in enumerate(zip(long, [10, 11, 25, 9, 4, 1, 12, 30, 10, 10, 3]))]
    items += [(3, "unseen words " * 8), (50, None), (51, ""), (None, " ".join(long[2].split()[:14])), (7, "WORD3 word4"), (60, "ab ab ab"), (61, "ab " * 12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    for bits in (26, 6):        # a filter of its usual size, and one that lets nearly all through
        got = sorted((-1 if r.doc_id is None else r.doc_id, *r[1:6]) for r in decontaminate(docs, bench, bits).collect())
        assert got == want
    assert sum(w[2] > 0 for w in want) > 5


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(none, bench).collect() == []
    assert not any(r.contaminated for r in decontaminate(documents(spark), bench).collect())


def test_hot_passages_and_long_items(spark):
    """One passage in most documents and items, small alphabets, windows at both ends, repeated rows."""
    rng = random.Random(3)
    some = [" ".join(rng.choice("abcde") for _ in range(rng.choice([5, 14, 40, 120]))) for _ in range(60)]
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(i, t if i % 3 else f"{t} {passage}" if i % 2 else f"{passage} {t}") for i, t in enumerate(some)]
    rows += [(90, passage), (90, passage), (91, passage[:40]), (92, "P0, p1! " + passage[6:])]
    items = [(i, f"{passage} {some[i]}") for i in range(0, 20, 2)] + [(100 + i, some[i][3:40]) for i in range(20)] + [(5, "a b"), (5, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, *r[1:6]) for r in got) == brute(rows, items)


def test_words_that_are_not_utf8(spark):
    docs = spark.createDataFrame([(1, b"\xff\xfe " + b"one two three four five six seven eight nine ten")], "doc_id long, text binary")
    bench = spark.createDataFrame([("x", "one two three four five six seven eight nine ten"), ("y", "seven, eight")], "item_id string, text string")
    r = decontaminate(docs, bench).first()
    assert (r.n_words, r.n_hit, r.n_items) == (11, 10, 2)


def test_the_join_has_no_single_task_and_no_loop(spark):
    docs = documents(spark, 6)
    plan = decontaminate(docs, docs.selectExpr("doc_id item_id", "text"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan
