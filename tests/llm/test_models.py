"""Operators 1, 6 and 7: held-out accuracy, and brute force."""

import tracemalloc
import zlib

import numpy as np
from llm.fixture import SCHEMA, documents
from pyspark.sql import functions as F

from dimwright.llm import embeddings
from dimwright.llm.common import table
from dimwright.llm.embeddings import near_vectors
from dimwright.llm.langid import DIM, Profiles, identify, learn, letter_vector, trigram_keys
from dimwright.llm.toxicity import SEGMENT, cross_validate, loss_and_gradient, segment_bags, segment_means, toxicity, worst_means

SF = "/root/testdata/sf0.01"


def fold(d):
    return zlib.crc32(str(d).encode()) % 3 == 1


def test_toxicity_on_held_out_rows(spark):
    big = "/root/testdata/sf0.1"        # a few hundred toxic rows to learn from
    docs, labels = table(spark, big, "documents"), table(spark, big, "labels")
    got = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    assert len(got) == docs.count() and all(r.held_out == fold(d) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for d, r in got.items())
    y = [(got[r.doc_id].score, r.toxic) for r in labels.collect() if fold(r.doc_id) and r.doc_id in got]
    pos, neg = [s for s, t in y if t], [s for s, t in y if not t]
    assert np.mean([p > n for p in pos for n in neg]) > 0.9


def test_toxicity_edges(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2, None if i % 5 == 0 else i % 2) for i in range(40)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity(docs, labels).count() == docs.count()
    assert {r.score for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity(spark.createDataFrame([], SCHEMA), labels).collect() == []
    assert segment_means(np.array([])).tolist() == [0.0]


def test_toxicity_scores_of_a_batch():
    rng = np.random.default_rng(2)
    for _ in range(50):
        size = rng.choice([0, 1, 2, 3, 4, 5, 9, 300], rng.integers(1, 30))
        z = rng.normal(size=size.sum())
        parts = np.split(z, np.cumsum(size)[:-1])
        assert np.allclose(worst_means(z, size), [segment_means(x).max() for x in parts], rtol=0, atol=1e-12)
    assert worst_means(np.zeros(0), np.zeros(0, np.int64)).tolist() == []


def test_toxicity_gradient_by_finite_differences():
    texts = ["you are a vile fool", "a calm day by the sea and more of it", "", "vile", "the sea is calm"]
    bags = segment_bags(texts, SEGMENT)
    flat = np.unique(bags[0])
    bags = (np.searchsorted(flat, bags[0]), *bags[1:])          # few buckets
    y, weight = np.array([1, 0, 0, 1, 0]), np.array([.2, .1, .1, .3, .3])
    rng = np.random.default_rng(4)
    params = [rng.normal(0, .5, (len(flat), 3)), rng.normal(0, .5, (2, 3)), rng.normal(0, .5, 2)]
    _, grad = loss_and_gradient(params, bags, y, weight, 1e-3)
    for p, g in zip(params, grad):
        for at in list(np.ndindex(p.shape))[:40]:
            was = p[at]
            p[at] = was + 1e-6
            up = loss_and_gradient(params, bags, y, weight, 1e-3)[0]
            p[at] = was - 1e-6
            down = loss_and_gradient(params, bags, y, weight, 1e-3)[0]
            p[at] = was
            assert abs((up - down) / 2e-6 - g[at]) < 1e-6


def test_toxicity_cross_validation_is_over_unseen_rows():
    rng = np.random.default_rng(6)
    bad, good = ["vilefool", "hatescum", "rottenjerk"], [f"plain{i}" for i in range(30)]
    texts = [" ".join(rng.choice(good, 12)) for _ in range(60)]
    labels = [0] * 30 + [1] * 30
    texts[30:] = [t + " " + str(rng.choice(bad)) for t in texts[30:]]
    loss, auc = cross_validate(texts, labels, 2, 1e-5)
    assert loss < 0.4 and auc > 0.9
    loss, auc = cross_validate(texts, rng.permutation(labels).tolist(), 2, 1e-5)
    assert loss > 0.4 and auc < 0.8


def test_toxicity_of_text_that_is_not_utf8(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([b"\xff\xfe vile words", b"fine words", None, b""] * 5)], "doc_id long, text binary")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(20)], "doc_id long, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == 20 and all(0 <= r.score <= 1 for r in got)


def test_language(spark):
    docs = table(spark, SF, "documents")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = identify(docs, learn(docs)).collect()
    assert len(got) == len(truth)
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.97 and all(r.held_out == fold(r.doc_id) for r in got)


def test_language_edges(spark):
    docs = documents(spark)
    got = identify(docs, learn(docs)).collect()
    assert len(got) == docs.count()
    p = Profiles(["the cat and the dog"], ["en"])
    assert p.predict(None) == ("und", 0.0) and p.predict("12 !?") == ("und", 0.0)
    assert p.predict("the")[0] == "en" and p.predict("東京")[0] == "en" and p.predict("東京")[1] == 0
    wide = Profiles(["".join(chr(c) for c in range(0x4e00, 0x4e00 + 300)), "the cat"], ["zh", "en"])      # more letters than the table takes
    assert not wide.dense and wide.predict("cat")[0] == "en" and wide.predict("一丁丂七")[0] == "zh"
    assert len(trigram_keys("ab")) == 2
    none = spark.createDataFrame([], SCHEMA)
    assert identify(none, learn(none)).collect() == []


def bundle(text):
    """The sum of a text's trigram vectors, built letter by letter."""
    v = np.zeros(DIM)
    for k in trigram_keys(text).tolist():
        v += np.roll(letter_vector(k >> 42), 2) * np.roll(letter_vector(k >> 21 & 0x1FFFFF), 1) * letter_vector(k & 0x1FFFFF)
    return v


def test_language_score_is_the_cosine_of_built_vectors():
    """Learned, half unlearned and mixed texts, with a table of few letters and one of many."""
    rng = np.random.default_rng(5)
    en = "the quick brown fox jumps over the lazy dog and runs to the river with all of its friends " * 3
    fr = "le renard brun saute par dessus le chien et court vers la rivière avec tous ses amis de la forêt " * 3
    noise = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 900))
    many = "".join(chr(0x4e00 + i) for i in range(200))
    for texts, langs in (([en, fr], ["en", "fr"]), ([en, fr, many], ["en", "fr", "zh"])):
        p = Profiles(texts, langs)
        proto = {x: bundle(t) / np.linalg.norm(bundle(t)) for x, t in zip(langs, texts)}
        for text in (en, en + noise, en[:200] + noise, fr + " Ж" * 50, en + " κόσμος" * 40, "the the the", noise):
            v = bundle(text)
            want = {x: v @ q / np.linalg.norm(v) for x, q in proto.items()}
            got, score = p.predict(text)
            assert abs(score - max(0, want[got])) < 0.05 and want[got] >= max(want.values()) - 0.03
    assert p.predict(en + noise)[1] > 0.5


def test_language_of_malformed_text(spark):
    docs = documents(spark).withColumn("text", F.when(F.col("doc_id") == 1, F.expr("cast(x'ff4100e9' as string)")).otherwise(F.col("text")))
    assert identify(docs, learn(docs)).count() == docs.count()


def vectors(spark, seed, n=260):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, 8))
    rows = [[float(np.float32(x)) for x in base[rng.integers(12)] + rng.normal(scale=0.35, size=8)] for _ in range(n)]
    rows += [rows[3]] * 20 + [[2 * x for x in rows[5]], None, [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] * 8, [None] * 8, [], [1.0, 2.0], [1.0, 2.1], [-0.0, 1.0], [0.0, 1.0]]
    out = [(i, r, i % 3, "x") for i, r in enumerate(rows)]
    return spark.createDataFrame(out + [(None, rows[0], 1, None)], "vec_id long, embedding array<float>, label int, id string")


def brute_vectors(rows):
    big = 2**63 - 1
    good = [(big if i is None else i, np.array(e, float)) for i, e in rows if e and None not in e and np.isfinite(np.array(e, float)).all() and any(e)]
    root, n = {(big if i is None else i): (big if i is None else i) for i, _ in rows}, {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, x in good:
        n[i] = 0
        for j, y in good:
            if i != j and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                n[i] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((-1 if i is None else i, n.get(big if i is None else i, 0), -1 if (c := find(big if i is None else i)) == big else c, c == (big if i is None else i)) for i, _ in rows)


def test_vectors(spark, monkeypatch):
    for seed, block in ((1, 4096), (2, 20)):
        monkeypatch.setattr(embeddings, "BLOCK", block // 16 or 1)
        v = vectors(spark, seed).repartition(4)
        want = brute_vectors([(r.vec_id, r.embedding) for r in v.collect()])
        got = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id, r.kept) for r in near_vectors(v).collect())
        assert got == want
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_components_near_the_limits_of_a_double(spark):
    rows = [(0, [1e200, 2e200, 0.0]), (1, [1e-200, 2e-200, 0.0]), (2, [1.0, 2.0, 0.0]), (3, [-1e300, -2e300, 0.0]), (4, [5e-324, 1e-323, 0.0])]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("vec_id").collect()
    assert [(r.n_links, r.component_id) for r in got] == [(3, 0), (3, 0), (3, 0), (0, 3), (3, 0)]


def test_many_close_vectors_take_little_memory():
    """5,000 vectors that all link: 25 million pairs, decided slice by slice."""
    rng = np.random.default_rng(2)
    v = embeddings.normed(1 + rng.normal(scale=.02, size=(5000, 64)))
    ids, forest, n = np.arange(5000) * 3, embeddings.Forest(np.arange(5000) * 3), 0
    tracemalloc.start()
    forest.meet(ids)
    for i, j in embeddings.close_pairs(v, v, 0.9):
        n += len(i)
        up = ids[j] < ids[i]
        forest.link(i[up], j[up])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 5000 * 5000 and peak < 300e6
    find = {x: x for x in ids.tolist()}

    def root(x):
        while find[x] != x:
            x = find[x]
        return x
    for a, b in forest.edges:
        x, y = sorted((root(a), root(b)))
        find[y] = x
    assert len(forest.edges) <= 2 * 5000 and {root(x) for x in ids.tolist()} == {0}


def test_forest_joins_what_the_links_join():
    rng = np.random.default_rng(9)
    for _ in range(30):
        ids, streams = rng.permutation(60)[:20], [rng.permutation(60)[:25] for _ in range(3)]
        forest, links = embeddings.Forest(ids), []
        for other in streams:
            forest.meet(other)
            i, j = np.nonzero(rng.random((20, 25)) < .04)
            forest.link(i[:7], j[:7])
            forest.link(i[7:], j[7:])
            links += list(zip(ids[i].tolist(), other[j].tolist()))

        def groups(edges):
            of = {x: {x} for x in range(60)}
            for a, b in edges:
                if of[a] is not of[b]:
                    of[a] |= of[b]
                    for x in of[a]:
                        of[x] = of[a]
            return {frozenset(g) for g in of.values()}
        assert groups(forest.edges) == groups(links) and set(forest.edges) <= set(links)
