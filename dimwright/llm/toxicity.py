"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with word ends marked), hashed to
BUCKETS vectors of DIM numbers; the vectors of SEGMENT consecutive words are
averaged into a softmax over two classes, and a document scores as its most
toxic segment, so a few words in a long text are not averaged away. Vectors and
softmax are trained together in numpy (Adam, full batches, the worst segment of
each document chosen anew in every epoch). Unseen misspellings share n-grams,
and so vectors, with words that were seen.

Fitting takes at most SAMPLE toxic and CLEAN other labelled rows outside the
held-out fold, those of smallest hash of the id (a documented bound; the whole
text of each). SEGMENT and DECAY are chosen by cross-validation inside those
rows (``cross_validate``). All documents are scored, whole. As the model is linear, a
word adds a number that depends on the word alone; a task keeps it, and segments
are added up for a batch of documents at once.

Edge cases: null and empty texts score as an empty segment (the bias alone);
malformed UTF-8 is read as replacement characters, which part words;
rows with a null doc_id are held out and scored; a null label is no label;
several labels of one id count once each; without rows of both classes to learn
from every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimwright.llm.common import Memo, by_size, columns_of, held_out

SAMPLE = 1500       # toxic rows to learn from
CLEAN = 3000        # clean rows to learn from
BUCKETS = 1 << 17
DIM = 8
SEGMENT = 3
EPOCHS = 80
DECAY = 1e-4        # weight decay of the vectors
THRESHOLD = 0.7

_WORD = re.compile(r"\w+")


def grams(word: str) -> list[int]:
    b = f"<{word}>".encode()
    return [zlib.crc32(b[i:i + n]) % BUCKETS for n in (3, 4, 5) for i in range(len(b) - n + 1)] + [zlib.crc32(b) % BUCKETS]


def segment_means(z: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Means over SEGMENT consecutive values, every half segment; one mean at least."""
    if len(z) <= segment:
        return np.array([z.mean() if len(z) else 0.0])
    c = np.concatenate([[0.0], np.cumsum(z)])
    at = np.append(np.arange(0, len(z) - segment, segment // 2), len(z) - segment)
    return (c[at + segment] - c[at]) / segment


def worst_means(z: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The largest of the segment means of each document, for the values of documents laid end to end."""
    out = np.zeros(len(size))
    lo = np.cumsum(size) - size
    few = np.flatnonzero((size > 0) & (size <= SEGMENT))
    for i in few.tolist():
        out[i] = z[lo[i]:lo[i] + size[i]].mean()
    many = np.flatnonzero(size > SEGMENT)
    if len(many):
        run = sum(z[j:len(z) - SEGMENT + 1 + j] for j in range(SEGMENT)) / SEGMENT
        n = (size[many] - SEGMENT - 1) // (SEGMENT // 2) + 2        # every half segment, and the last
        first = np.cumsum(n) - n
        step = np.minimum((np.arange(n.sum()) - np.repeat(first, n)) * (SEGMENT // 2), np.repeat(size[many] - SEGMENT, n))
        out[many] = np.maximum.reduceat(run[np.repeat(lo[many], n) + step], first)
    return out


def loss_and_gradient(params: list[np.ndarray], bags: tuple[np.ndarray, ...], y: np.ndarray, weight: np.ndarray,
                      decay: float) -> tuple[float, list[np.ndarray]]:
    """Weighted cross-entropy of the worst segment of each document, with the weight decay of the vectors, and
    its gradient by (vectors, softmax, bias). bags: buckets of the words end to end, where each word begins
    there, their counts, the words of the documents end to end, segments as ranges of those (lo, hi), their owners."""
    emb, soft, bias = params
    flat, begin, size, words, lo, hi, owner = bags
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    n = np.maximum(hi - lo, 1)
    z = emb @ (soft[1] - soft[0])       # what a bucket adds to class 1 over class 0
    zw = np.add.reduceat(z[flat], begin) / size if len(begin) else np.zeros(0)
    c = np.concatenate([[0.0], np.cumsum(zw[words])])
    margin = (c[hi] - c[lo]) / n + bias[1] - bias[0]
    top = np.maximum.reduceat(margin, first)
    worst = np.flatnonzero(margin == top[owner])
    worst = worst[np.unique(owner[worst], return_index=True)[1]]
    m = margin[worst]
    loss = float((weight * (np.logaddexp(0, m) - y * m)).sum() + decay / 2 * (emb * emb).sum())
    d1 = (1 / (1 + np.exp(-m)) - y) * weight                     # d loss / d logit of class 1; class 0 has the negative
    length = hi[worst] - lo[worst]
    pos = np.repeat(lo[worst] - (np.cumsum(length) - length), length) + np.arange(length.sum())
    w = np.bincount(words[pos], np.repeat(d1 / n[worst], length), minlength=len(size))
    used = np.flatnonzero(w)
    k = size[used]
    slot = np.repeat(begin[used] - (np.cumsum(k) - k), k) + np.arange(k.sum())
    g = np.bincount(flat[slot], np.repeat(w[used] / k, k), minlength=len(emb))
    both = np.stack([-g, g], 1)
    return loss, [both @ soft + decay * emb, both.T @ emb, np.array([-d1.sum(), d1.sum()])]


def segment_bags(texts: list[str], segment: int) -> tuple[np.ndarray, ...]:
    """The words, buckets and segments of texts, as ``loss_and_gradient`` takes them."""
    names: dict[str, int] = {}
    docs = [np.array([names.setdefault(w, len(names)) for w in _WORD.findall(t.lower())], np.int64) for t in texts]
    bag, size = array("i"), array("i")
    for w in names:
        g = grams(w)
        bag.extend(g)
        size.append(len(g))
    flat, size = np.array(bag, np.int32), np.array(size, np.int64)
    lo, hi, owner, at = [], [], [], 0
    for i, d in enumerate(docs):
        s = [0] if len(d) <= segment else [*range(0, len(d) - segment, segment // 2), len(d) - segment]
        lo += [at + x for x in s]
        hi += [at + min(x + segment, len(d)) for x in s]
        owner += [i] * len(s)
        at += len(d)
    return flat, np.cumsum(size) - size, size, np.concatenate(docs), np.array(lo), np.array(hi), np.array(owner)


def fit(texts: list[str], labels: list[int], seed: int = 7, segment: int = SEGMENT, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """(logit of class 1 against 0 that each bucket adds, bias)."""
    bags = segment_bags(texts, segment)
    y = np.array(labels)
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (BUCKETS, DIM)), rng.normal(0, 0.1, (2, DIM)), np.zeros(2)]
    share = {c: 0.5 / max(1, (y == c).sum()) for c in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for epoch in range(1, EPOCHS + 1):
        _, grad = loss_and_gradient(params, bags, y, weight, decay)
        for p, m, v, dp in zip(params, mean, var, grad):
            m += 0.1 * (dp - m)
            v += 0.01 * (dp * dp - v)
            p -= 0.05 * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    emb, soft, bias = params
    z = emb @ soft.T
    return (z[:, 1] - z[:, 0]).astype(np.float32), float(bias[1] - bias[0])


def cross_validate(texts: list[str], labels: list[int], segment: int, decay: float, folds: int = 3) -> tuple[float, float]:
    """(mean loss per class, AUC) of rows that a model has not seen, over folds of the learning rows."""
    y = np.array(labels)
    at = np.array([zlib.crc32(t.encode()) % folds for t in texts])      # equal texts stay together
    margin = np.zeros(len(y))
    for f in range(folds):
        rest = np.flatnonzero(at != f)
        table, bias = fit([texts[i] for i in rest], y[rest].tolist(), segment=segment, decay=decay)
        memo = Memo(lambda w, t=table: float(t[grams(w)].mean()))
        for i in np.flatnonzero(at == f).tolist():
            margin[i] = segment_means(np.array([memo[w] for w in _WORD.findall(texts[i].lower())]), segment).max() + bias
    loss = np.logaddexp(0, margin) - y * margin
    ranks = np.argsort(np.argsort(margin))
    n = int((y == 1).sum())
    auc = (ranks[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))
    return float((loss[y == 1].mean() + loss[y == 0].mean()) / 2), float(auc)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for t, y in columns_of(batches, "text", "toxic"):
        texts += [x.decode(errors="replace") for x in t]
        labels += y
    if set(labels) == {0, 1}:
        table, bias = fit(texts, labels)
        yield pa.record_batch([pa.array([table.tobytes()], pa.binary()), pa.array([bias])], names=["logits", "bias"])


def _score(batches: Iterator[pa.RecordBatch], model: tuple[np.ndarray, float] | None) -> Iterator[pa.RecordBatch]:
    if model:
        table, bias = model
        memo = Memo(lambda w: float(table[grams(w)].mean()))
    for ids, held, texts in by_size(batches, "text", ["doc_id", "held_out", "text"], 2_000_000):
        score = np.zeros(len(texts))
        if model:
            found = [_WORD.findall(t.decode(errors="replace").lower()) if t else [] for t in texts]
            size = np.array([len(w) for w in found], np.int64)
            z = np.fromiter(map(memo.__getitem__, chain.from_iterable(found)), np.float64, int(size.sum()))
            score = 1 / (1 + np.exp(-np.clip(worst_means(z, size) + bias, -500, 500)))
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(score, pa.float64()),
                               pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])


def learning_rows(d: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) to learn from: at most SAMPLE toxic and CLEAN clean labels outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
    # about twice the bound by hash, then the bound itself: the window sees no more than that of each class
    per = known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"))
    order = F.xxhash64("doc_id")
    most = F.when(F.col("toxic") == 1, SAMPLE).otherwise(CLEAN)
    few = (known.join(F.broadcast(per), "toxic").where(F.pmod(order, F.lit(1_000_000)) < 2_000_000.0 * most / F.col("n"))
           .withColumn("rank", F.row_number().over(Window.partitionBy("toxic").orderBy(order, "doc_id"))).where(F.col("rank") <= most))
    return (d.join(F.broadcast(few.select("doc_id", "toxic")), "doc_id").where("text is not null")     # at most SAMPLE + CLEAN labels
            .select("doc_id", "text", "toxic").repartition(1).sortWithinPartitions("doc_id", "toxic", "text"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of docs(doc_id, text), learned from labels(doc_id, toxic)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), F.col("text").cast("binary").alias("text"))
    rows = learning_rows(d, labels)
    got = rows.mapInArrow(_fit, "logits binary, bias double").collect()     # a row of BUCKETS numbers
    model = (np.frombuffer(got[0].logits, np.float32), got[0].bias) if got else None
    held = docs.sparkSession.sparkContext.broadcast(model)
    return d.mapInArrow(lambda it: _score(it, held.value), "doc_id long, held_out boolean, score double, predicted int")
