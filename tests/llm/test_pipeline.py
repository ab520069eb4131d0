"""The pipeline's decisions against brute force, stage by stage."""

import random
import re

import corpus_pipeline
from llm.fixture import SCHEMA, documents
from llm.test_minhash import brute as near
from llm.test_substrings import brute as repeats


def test_stages(spark, tmp_path):
    docs = documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    benchmark = spark.createDataFrame([(0, " ".join(docs.where("length(text) > 400").orderBy("doc_id").first().text.split()[3:20]))], "item_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    steps = []
    for n, (_, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{n}")
        steps.append((now, spark.read.parquet(f"{tmp_path}/{n}")))
        now = steps[-1][1]
    rows = [({r.doc_id: r.text for r in a.collect()}, {r.doc_id: r.text for r in b.collect()}) for a, b in steps[:-1]]
    assert all(b.columns == a.columns for a, b in steps[:-1])
    a, b = rows[0]
    assert all(a[d] and re.search(r"[^\W\d_]", a[d]) for d in b) and all(d in b for d, t in a.items() if t and "Word" in t)
    a, b = rows[1]
    assert sorted(b) == [d for d, _, c, kept in near(list(a.items())) if kept]
    a, b = rows[2]
    gone = {d: (n, r) for d, n, r, _, _ in repeats(list(a.items()), lambda t: re.findall(r"[^\x20\x09-\x0D]+", t), lambda w: " ".join(w).encode(), 13)}
    assert set(b) == {d for d, (n, r) in gone.items() if r < n or not r}
    assert all(len(b[d].split()) == gone[d][0] - gone[d][1] for d in b)
    a, b = rows[3]
    assert 0 < len(a) - len(b) < len(a) and set(b) < set(a)
    pieces = steps[-1][1].collect()
    assert {r.doc_id for r in pieces} == set(b)


def test_near_duplicates_of_null_and_repeated_ids(spark, tmp_path):
    def text(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))
    rows = [(1, text("a")), (2, text("a", 41)),                                 # 2 goes
            (None, text("a", 42)), (None, text("v")), (None, text("v", 41)),    # the copy of 1 goes, and one of the v
            (7, text("a", 43)), (7, text("u")), (7, text("u")),                 # the copy of 1 goes, both rows of u stay
            (None, None), (8, ""), (0, "few words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_removal(spark, docs, str(tmp_path)).collect()]
    v = [r for r in got if r[1] and r[1].startswith("v0")]
    assert len(v) == 1 and v[0] in rows
    assert sorted(map(str, got)) == sorted(map(str, [rows[0], rows[6], rows[7], *rows[8:], *v]))


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    none = spark.createDataFrame([], SCHEMA)
    for _, f in corpus_pipeline.STAGES:
        out = f(spark, none, str(tmp_path))
        assert out.collect() == []


def test_language_stage_keeps_a_text_that_is_half_unlearned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(400)
    some = docs.where("lang = 'en' and length(text) > 600").first()
    rng = random.Random(4)
    noise = "".join(rng.choice("bcdfghjklmnpqrstvwxyz") for _ in range(1500))
    probes = [(10**9, some.text[:300] + " " + noise), (10**9 + 1, some.text[:300] + " κόσμος и мир" * 60), (10**9 + 2, "12 34 !!")]
    more = spark.createDataFrame([(d, t, None, "s", len(t)) for d, t in probes], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(more), "").select("doc_id").collect()}
    assert {10**9, 10**9 + 1} <= kept and 10**9 + 2 not in kept
