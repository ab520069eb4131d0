"""Near-duplicate documents by bottom-k sketches.

A document is the set of its distinct 5-word shingles (hashes of 64 bits). One
hash function orders all shingles; the K smallest of a set are its sketch. Two
documents link when 100 * |A and B| >= 75 * |A or B| on the full sets.

1. Documents with equal sets form a class; one of them goes on.
2. Inverted lists: a sketch value held by two classes makes a list. The union
   sketch of a linked pair (its K smallest shingles) holds at least
   ``needed(n)`` values of both, exactly when the union has at most K shingles,
   else with a margin of MARGIN standard deviations. A set of n shingles does
   not tell its unions, so needed(n) is the least over all from n to n / 0.75.
   So a class may leave out its needed(n) - 1 commonest values: lists of
   boilerplate are left out unless it is most of a document.
3. Classes joined by lists fall into groups. A group is cut into blocks of
   BLOCK classes and every pair of blocks is one unit of work, so no task holds
   a large group and no pair is written down: a unit counts overlaps of
   sketches by matrix products over its inverted lists, drops pairs below the
   union-sketch bound, counts the full sets of the rest, and returns a spanning
   forest of the links that hold.
4. Connected components of these links, as classes, then as documents.

Nothing is capped: a value held by a third of all documents gives a large group
that is cut into more units.

Edge cases: null texts and texts without words have 0 shingles and link with
nothing; fewer than five words make one shingle; rows that share a doc_id are
one document with several texts; a null doc_id orders after all others and
stays null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import NULL_ID, Memo, U, by_size, columns_of, components, mix, width
from dimwright.operators.keys import assign_keys, materialize

SHINGLE = 5
K = 96
PERCENT = 75
MARGIN = 6.5
BLOCK = 256

_CODES = Memo(xxhash.xxh3_64_intdigest)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    w = text.lower().split() if text else []
    c = np.array(list(map(_CODES.__getitem__, w)), U)
    n = min(len(c), SHINGLE)
    if not n:
        return c
    h = c[:len(c) - n + 1] * U(2 * n + 1)
    for j in range(1, n):
        h = h * U(0x9E3779B97F4A7C15) + c[j:len(c) - n + 1 + j]
    return np.unique(mix(h))


def needed(n: Column) -> Column:
    """Values that a linked pair shares at least in the K smallest of its union, by the size of either set."""
    union = n * 100 / PERCENT       # the largest; the smallest is n
    p = PERCENT / 100
    far = F.floor(p * K - MARGIN * F.sqrt(K * p * (1 - p) * F.greatest(F.lit(0.0), 1 - K / union)))
    return F.least(F.ceil(n * p), far).cast("int")


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, uids, texts in by_size(batches, "text", ["doc_id", "uid", "text"], 2_000_000):
        sets = [shingles(t) for t in texts]
        mark = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"\0" * 16 for s in sets]
        c = np.frombuffer(b"".join(mark), "<i8").reshape(-1, 2)
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(uids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(c[:, 0]), pa.array(c[:, 1]),
                               pa.array([s[:K].view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "uid", "n", "c1", "c2", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for *head, texts in by_size(batches, "text", ["id", "grp", "nb", "b", "text"], 2_000_000):
        yield pa.record_batch([*(pa.array(h, pa.int64()) for h in head), pa.array([shingles(t).tobytes() for t in texts], pa.binary())],
                              names=["id", "grp", "nb", "b", "set"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of common values, by products over the inverted lists of values held twice."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    size = [len(s) for s in sets]
    value, who = np.concatenate(sets), np.repeat(np.arange(n), size)
    o = np.argsort(value, kind="stable")
    value, who = value[o], who[o]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    at = np.cumsum(new) - 1
    twice = np.bincount(at, minlength=1)[at] > 1
    who, at = who[twice], np.unique(at[twice], return_inverse=True)[1]
    for lo in range(0, int(at.max(initial=-1)) + 1, 4096):
        a, b = np.searchsorted(at, [lo, lo + 4096])
        m = np.zeros((n, 4096), np.float32)
        m[who[a:b], at[a:b] - lo] = 1
        out += m @ m.T
    return out


def _need(n: np.ndarray) -> np.ndarray:
    p, union = PERCENT / 100, n * 100 / PERCENT
    far = np.floor(p * K - MARGIN * np.sqrt(K * p * (1 - p) * np.maximum(0, 1 - K / union)))
    return np.minimum(np.ceil(n * p), far)


def links(ids: list[int], sets: list[np.ndarray], left: np.ndarray | None) -> list[tuple[int, int]]:
    """Spanning forest of the links in a unit; left: only pairs with one side in it."""
    n = np.array([len(s) for s in sets])
    need = _need(n)
    ok = overlaps([s[:K] for s in sets]) >= np.maximum(need[:, None], need[None, :])
    ok &= 100 * np.minimum(n[:, None], n[None, :]) >= PERCENT * np.maximum(n[:, None], n[None, :])
    if left is not None:
        ok &= left[:, None] != left[None, :]
    ok = np.triu(ok, 1)
    used = np.flatnonzero(ok.any(0) | ok.any(1))
    if not len(used):
        return []
    both = overlaps([sets[i] for i in used]).astype(np.int64)
    m = n[used]
    ok = ok[np.ix_(used, used)] & (100 * both >= PERCENT * (m[:, None] + m[None, :] - both))
    root = list(range(len(used)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for a, b in np.argwhere(ok).tolist():
        x, y = find(a), find(b)
        if x != y:
            root[y] = x
            out.append((ids[used[a]], ids[used[b]]))
    return out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def done(key, rows):
        ids, b, sets = [r[0] for r in rows], np.array([r[1] for r in rows]), [np.frombuffer(r[2], U) for r in rows]
        found = links(ids, sets, (b == key[1]) if key[1] != key[2] else None)
        return pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    now, held = None, []
    for cols in columns_of(batches, "grp", "i", "j", "id", "b", "set"):
        for g, i, j, *row in zip(*cols):
            if (g, i, j) != now and held:
                yield done(now, held)
                held = []
            now = (g, i, j)
            held.append(row)
    if held:
        yield done(now, held)


def near_duplicates(docs: DataFrame, by_row: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, uid) per row of docs(doc_id, text); uid is the hash of doc_id and text.

    by_row: every (doc_id, text) is a document of its own, numbered by doc_id
    (null last) and uid; component_id is the number of the one kept."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).withColumn(
        "uid", F.xxhash64("doc_id", "text"))
    sk = materialize(d.mapInArrow(_sketches, "doc_id long, uid long, n long, c1 long, c2 long, sketch array<long>"), "sketches")
    sk = sk.withColumn("id", F.coalesce("doc_id", F.lit(NULL_ID)))
    if by_row:
        number = assign_keys(sk.select("id", "uid").distinct(), ["id", "uid"], "number").select("uid", F.col("number").alias("id"))
        sk = sk.drop("id").join(number, "uid")
    classes = sk.where("n > 0").groupBy("c1", "c2")
    reps = classes.agg(F.min("id").alias("id"), F.min_by("sketch", "id").alias("sketch"), F.first("n").alias("n"))
    entries = reps.select("id", "n", F.explode("sketch").alias("value"))
    held = entries.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = (entries.join(held, "value").groupBy("id", "n")
              .agg(F.sort_array(F.collect_list(F.struct("held", "value"))).alias("v")))      # at most K a document
    # the needed(n) - 1 commonest values may go; values held once come first and make no list
    keep = F.size("v") - needed(F.col("n")) + 1
    lists = shared.where(keep > 0).select("id", F.explode(F.slice("v", 1, keep)).alias("v")).select("id", F.col("v.value").alias("value"))
    lists = materialize(lists, "lists")
    first = lists.groupBy("value").agg(F.min("id").alias("b"))
    group = materialize(components(lists.join(first, "value").select(F.col("id").alias("a"), "b")), "groups")
    blocks = (group.join(group.groupBy("component").agg(F.count(F.lit(1)).alias("m")), "component")
              .select(F.col("node").alias("id"), F.col("component").alias("grp"), F.ceil(F.col("m") / BLOCK).alias("nb"))
              .withColumn("b", F.pmod(F.xxhash64("id"), "nb")))
    if by_row:
        texts = d.select("uid", "text").join(blocks.join(number, "id").hint("shuffle_hash"), "uid")
    else:
        texts = d.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "text").join(blocks.hint("shuffle_hash"), "id")
    sets = texts.select("id", "grp", "nb", "b", "text").mapInArrow(_sets, "id long, grp long, nb long, b long, set binary")
    units = (sets.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
             .select("grp", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "id", "b", "set")
             .repartition(width(spark), "grp", "i", "j").sortWithinPartitions("grp", "i", "j"))
    found = materialize(units.mapInArrow(_units, "a long, b long"), "links")
    member = components(found)
    rep = classes.agg(F.min("id").alias("rep")).join(member, F.col("rep") == F.col("node"), "left").select(
        "c1", "c2", F.coalesce("component", "rep").alias("component"))
    out = sk.drop("sketch").join(rep, ["c1", "c2"], "left")
    # one doc_id may carry several texts, and so several classes
    comp = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.nullif(comp, F.lit(NULL_ID)).alias("component_id"),
                      comp.eqNullSafe(F.col("id")).alias("kept"), "uid")
