"""Small documents with the hard cases: nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.IntegerType()), T.StructField("part", T.StringType()),
                       T.StructField("uid", T.IntegerType()), T.StructField("a", T.StringType())])


def words(rng, n, vocab=400):
    return [f"w{rng.randrange(vocab)}é" if rng.random() < .1 else f"Word{rng.randrange(vocab)}," for _ in range(n)]


def texts(seed=1, n=60):
    """Fresh texts, exact copies, near copies, shared passages, edge cases."""
    rng = random.Random(seed)
    out = [" ".join(words(rng, rng.choice([3, 12, 30, 80, 200]))) for _ in range(n)]
    passage = " ".join(words(rng, 45))
    for i in range(0, n, 5):
        w = out[i].split(" ")
        w.insert(rng.randrange(len(w) + 1), passage)
        out[i] = " ".join(w)
    for i in rng.sample(range(n), n // 6):
        out.append(out[i])
        w = out[i].split(" ")
        for _ in range(max(1, len(w) // 40)):
            w[rng.randrange(len(w))] = "edit"
        out.append(" ".join(w) + "\n\ttail")
    out += [None, "", "  \n", "a", "x" * 3000, "ab " * 2000, " ".join(words(rng, 6000)), "ß∑ 東京 " * 40, "ab " * 2000]
    rng.shuffle(out)
    return out


def documents(spark, seed=1, n=60):
    rows = [(i, t, None if i % 7 == 0 else "en", "s", None, "x", 1, None) for i, t in enumerate(texts(seed, n))]
    rows += [rows[3], rows[5], (None, rows[4][1], None, None, 0, None, None, None), (None, None, None, None, 0, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)
