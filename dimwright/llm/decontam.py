"""Benchmark decontamination by winnowing.

A window is WINDOW consecutive words of an item (an item of fewer words, but
not none, is one window). A document word inside any occurrence of a window is
hit. Of the k-grams of every WINDOW-word stretch the one with the smallest hash
is its fingerprint, on both sides, so a shared stretch always shares one. A
fingerprint carries the words around it, as far as a window that holds it can
reach; fingerprints join by hash on Spark, and a joined pair is extended left
and right word by word. An extension of WINDOW words or more is a hit, and as
every window holds a fingerprint of its own, the extensions cover all hits.
Short items are fingerprints of their own length.

Documents are read once. What bounds the join: a table of 2**FILTER_BITS bits
says which hashes the benchmark holds (its size does not depend on either
table; a full one lets more through to the join, never less), so only document
fingerprints that may match are written and joined. A hash that many documents
share is dealt out by row, the benchmark's side repeated for each share; there
are at most SHARES of them for each shuffle partition. Nothing else of
either table reaches the driver.

Edge cases: null or empty texts have no words and no hits; null and empty items
have no windows; an item without id counts and is listed as an empty string;
items that share an id are one item; repeated documents each get their row; an
empty benchmark hits nothing; bytes that are not UTF-8 are parts of words.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import U, Memo, by_size, columns_of, mix, width
from dimwright.llm.windows import sliding_min
from dimwright.operators.keys import materialize

WINDOW = 10
GRAM = 5
FILTER_BITS = 26
SHARES = 4

# separators: ASCII but digits and letters
_BLANK = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

_PROBE = "need int, code long, left array<binary>, right array<binary>"
_PROBE_TYPE = pa.struct([("need", pa.int32()), ("code", pa.int64()), ("left", pa.list_(pa.binary())),
                         ("right", pa.list_(pa.binary())), ("places", pa.list_(pa.int32()))])


def words(text: bytes | None) -> list[bytes]:
    return text.lower().translate(_BLANK).split() if text else []


def gram_codes(sym: np.ndarray, k: int) -> np.ndarray:
    n = len(sym) - k + 1
    g = sym[:n].astype(U)
    for j in range(1, k):
        g = g * U(0x9E3779B97F4A7C15) + sym[j:j + n].astype(U)
    return mix(g)


def fingerprints(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, 64-bit codes) of the winnowed k-grams: one at least in any WINDOW symbols."""
    if len(sym) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, U)
    code = gram_codes(sym, GRAM)
    v = (code & U(0xFFFFFFFF00000000)) | np.arange(len(code), dtype=U)
    at = np.unique(sliding_min(v, WINDOW - GRAM + 1) & U(0xFFFFFFFF)).astype(np.int64)
    return at, code[at]


def symbols() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


class Filter:
    """Which codes the benchmark may hold: one bit for each value of the low ``bits`` bits."""

    def __init__(self, words_: np.ndarray, bits: int):
        self.words, self.bits = words_, bits

    def passes(self, code: np.ndarray) -> np.ndarray:
        low = code & U((1 << self.bits) - 1)
        return (self.words[(low >> U(6)).astype(np.int64)] >> (low & U(63))) & U(1) == 1


def probes(batch: list[list[bytes]], memo: Memo, lengths: list[int], known: Filter) -> list[dict[tuple, list[int]]]:
    """{(need, code, words to the left, words from there on): places} of each document: its fingerprints
    that the benchmark may hold, and its stretches as long as a short item."""
    size = np.array([len(w) for w in batch], np.int64)
    ends = np.cumsum(size)
    flat = [x for w in batch for x in w]
    sym = np.fromiter(map(memo.__getitem__, flat), U, len(flat))
    out: list[dict[tuple, list[int]]] = [defaultdict(list) for _ in batch]
    found = [(WINDOW, GRAM, *fingerprints(sym))]
    found += [(k, k, np.arange(len(sym) - k + 1), gram_codes(sym, k)) for k in lengths if len(sym) >= k]
    for need, k, at, code in found:
        keep = known.passes(code)
        at, code = at[keep], code[keep].view(np.int64)
        doc = np.searchsorted(ends, at, side="right")
        inside = ends[doc] - at >= k
        for p, c, d in zip(at[inside].tolist(), code[inside].tolist(), doc[inside].tolist()):
            hi = int(ends[d])
            lo = hi - int(size[d])
            left = flat[max(lo, p - (need - k)):p][::-1]
            out[d][need, c, tuple(left), tuple(flat[p:min(hi, p + need)])].append(p - lo)
    return out


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fingerprints of every item of WINDOW words or more, and every shorter one as a whole."""
    memo = symbols()
    for ids, texts in by_size(batches, "text", ["item_id", "text"], 500_000):
        rows: dict[str, list] = {n: [] for n in ("item_id", "need", "code", "left", "right")}
        for i, t in zip(ids, texts):
            w = words(t)
            sym = np.fromiter(map(memo.__getitem__, w), U, len(w))
            need = min(WINDOW, len(w))
            k = GRAM if need == WINDOW else need
            at, code = fingerprints(sym) if need == WINDOW else (np.zeros(min(1, need), np.int64), gram_codes(sym, k) if k else sym)
            for p, c in zip(at.tolist(), code.view(np.int64).tolist()):
                for n, v in zip(rows, (i, need, c, w[max(0, p - (need - k)):p][::-1], w[p:p + need])):
                    rows[n].append(v)
        types = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.binary())]
        yield pa.record_batch([pa.array(v, t) for v, t in zip(rows.values(), types)], names=list(rows))


def _scan(batches: Iterator[pa.RecordBatch], lengths: list[int], known: Filter) -> Iterator[pa.RecordBatch]:
    memo = symbols()
    for ids, uids, texts in by_size(batches, "text", ["doc_id", "uid", "text"], 2_000_000):
        batch = [words(t) for t in texts]
        found = [[dict(zip(("need", "code", "left", "right"), key), places=at) for key, at in one.items()]
                 for one in probes(batch, memo, lengths, known)]
        yield pa.record_batch([
            pa.array(ids, pa.int64()), pa.array(uids, pa.int64()), pa.array([len(w) for w in batch], pa.int64()),
            pa.array(found, pa.list_(_PROBE_TYPE))], names=["doc_id", "uid", "n_words", "probes"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, uids, n_words, spans, items in columns_of(batches, "doc_id", "uid", "n_words", "spans", "items"):
        n_hit, names = [], []
        for n, parts, lists in zip(n_words, spans, items):
            hit = np.zeros(n + 1 if parts else 1, np.int64)
            for p in parts or ():
                at = np.array(p["places"], np.int64)
                np.add.at(hit, at - p["a"], 1)
                np.add.at(hit, at + p["b"], -1)
            n_hit.append(int((np.cumsum(hit) > 0).sum()))
            names.append(sorted({x for part in lists or () for x in part}))
        yield pa.record_batch([
            pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in names], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]), pa.array([x > 0 for x in n_hit]), pa.array(uids, pa.int64())],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "uid"])


def _shared(x: str, y: str) -> Column:
    """How many words two lists have in common from their start on."""
    same = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def benchmark_prints(benchmark: DataFrame) -> DataFrame:
    """(need, code, their_left, their_right, items): each distinct fingerprint of benchmark(item_id, text)
    with the words around it and the ids of the items that hold it."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.col("text").cast("binary").alias("text")).where("text is not null")
    rows = items.mapInArrow(_items, f"item_id string, {_PROBE}")
    return (rows.groupBy("need", "code", F.col("left").alias("their_left"), F.col("right").alias("their_right"))
            .agg(F.collect_set("item_id").alias("items")))


def code_filter(prints: DataFrame, bits: int) -> Filter:
    """The filter of the codes, put together on Spark: 2**(bits - 6) longs at most come to the driver."""
    low = F.col("code").bitwiseAND(F.lit((1 << bits) - 1))
    one = F.expr("shiftleft(1L, cast(low & 63 as int))")
    got = (prints.select(low.alias("low")).groupBy(F.shiftright("low", 6).alias("at")).agg(F.bit_or(one).alias("word"))).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[got.column("at").to_numpy()] = got.column("word").to_numpy()
    return Filter(table.view(U), bits)


def meet(found: DataFrame, prints: DataFrame) -> DataFrame:
    """(row, places, a, b, items): the words from a before to b after each of the places are a window of the items, or more."""
    spark = found.sparkSession
    mine = found.select("row", F.explode("probes").alias("p")).select("row", "p.*")
    count = mine.groupBy("need", "code").agg(F.count(F.lit(1)).alias("n"))
    total = count.agg(F.sum("n")).first()[0] or 0
    most = total // (SHARES * width(spark)) + 1
    hot = count.where(F.col("n") > most).select("need", "code", F.ceil(F.col("n") / most).cast("int").alias("shares"))
    hot = F.broadcast(materialize(hot, "hot"))      # codes over that share of the rows: fewer than SHARES * width
    share = F.pmod(F.xxhash64("row", "left", "right"), F.coalesce("shares", F.lit(1)))
    mine = mine.join(hot, ["need", "code"], "left").withColumn("share", share.cast("int")).drop("shares")
    theirs = (prints.join(hot, ["need", "code"], "left")
              .withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1))).drop("shares"))
    return (mine.join(theirs, ["need", "code", "share"])
            .select("row", "need", "places", _shared("left", "their_left").alias("a"), _shared("right", "their_right").alias("b"), "items")
            .where("a + b >= need").drop("need"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, uid) per row of docs(doc_id, text);
    uid is the hash of doc_id and text."""
    prints = materialize(benchmark_prints(benchmark), "prints")
    lengths = sorted(r.need for r in prints.select("need").where(F.col("need") < WINDOW).distinct().collect())     # nine at most
    known = docs.sparkSession.sparkContext.broadcast(code_filter(prints, filter_bits))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).withColumn(
        "uid", F.xxhash64("doc_id", "text"))
    found = d.mapInArrow(lambda it: _scan(it, lengths, known.value),
                         f"doc_id long, uid long, n_words long, probes array<struct<{_PROBE}, places array<int>>>")
    found = materialize(found.withColumn("row", F.monotonically_increasing_id()), "found")
    hits = meet(found, prints).groupBy("row").agg(F.collect_list(F.struct("places", "a", "b")).alias("spans"), F.collect_set("items").alias("items"))
    rows = found.select("row", "doc_id", "uid", "n_words").join(hits, "row", "left")
    return rows.mapInArrow(_finish, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, uid long")
