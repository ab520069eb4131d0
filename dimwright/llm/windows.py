"""Candidate search for windows of L symbols that start in two documents.

Substring operators (suffix.py over bytes, substring.py over words) ask which
windows of L consecutive symbols of a document also start in a document with a
smaller id. Writing down every window costs several times the input, so:

1. *Runs.* In each window the k-gram with the smallest hash is its anchor
   (leftmost on ties). The choice depends on the window's own symbols only, so
   equal windows have equal anchors at equal offsets. Consecutive windows with
   one anchor form a run: about 2 in (L - k + 2) symbols start one. A run is
   sent as (anchor hash, 128-bit hash of all its symbols, place), after a task
   has dropped runs that repeat one of a smaller document in the same task.
   Runs are sent in ``TURNS``, each with its share of the anchors: the texts are
   read once a turn, and a turn's shuffle files go before the next, so that they
   never lie on disk together.
2. *Runs with equal anchors meet.* An anchor seen in one run is done. A run
   equal to one of a smaller document is wholly repeated. What is left are
   distinct runs with an anchor in common: the ends of shared passages, and
   chance repeats of k symbols.
3. Those runs alone are cut out of the texts and given to the operator's own
   exact search (``kernel``), which finds their repeated windows.
4. Spans meet their texts again, by document.

Texts cross the network twice, compressed; hashes once, in packed blocks. No
window of a document is left out at any size.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import NULL_ID, U, by_size, mix, width
from dimwright.operators.keys import materialize, swept

BATCH = 1_000_000       # symbols hashed at once in a task
FLUSH = 1_500_000       # runs held by a task before it sends them
TURNS = 2               # shares of the anchors whose runs are sent one after the other

_M = 0x9E3779B97F4A7C15
_INV = pow(_M, -1, 2**64)
RUN = np.dtype([("key", "<u8"), ("sw", "<u8"), ("sx", "<u8"), ("uid", "<i8"), ("did", "<i8"), ("lo", "<u4"), ("n", "u1"), ("off", "u1")])
SPAN = np.dtype([("uid", "<i8"), ("lo", "<u4"), ("hi", "<u4")])
ASK = np.dtype([("uid", "<i8"), ("key", "<u8"), ("lo", "<u4"), ("n", "u1"), ("off", "u1")])
ARROW = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
PACK = "part int, kind int, doc_id long, uid long, payload binary"


class Powers:
    """Powers of the hash base and of its inverse, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, U)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", _M), ("down", _INV)):
                p = np.full(n, base, U)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))


POW = Powers()


def prefix_hashes(sym: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = sum of (sym + 1) * base**t over t in [i, j)."""
    POW.upto(len(sym) + 1)
    h = np.zeros(len(sym) + 1, U)
    np.cumsum((sym.astype(U) + U(1)) * POW.up[:len(sym)], out=h[1:])
    return h


def span_hash(h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Polynomial hash of sym[lo:hi], the same wherever the symbols stand."""
    return (h[hi] - h[lo]) * POW.down[lo]


def gram_hash(sym: np.ndarray, k: int) -> np.ndarray:
    """32-bit hash of every k-gram (k a power of two for bytes, any k for words)."""
    if sym.dtype == np.uint8:
        h, at, m = sym.astype(np.uint32) * np.uint32(2654435761) + np.uint32(374761393), 1, 0x85EBCA6B
        while at < k:
            h = h[:-at] * np.uint32(m) + h[at:]
            m, at = m * m % 2**32, at * 2
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        return h ^ (h >> np.uint32(13))
    n = len(sym) - k + 1
    g = sym[:n].copy()
    for j in range(1, k):
        g = g * U(_M) + sym[j:j + n]
    return (mix(g) >> U(32)).astype(np.uint32)


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    at = 1
    while at * 2 <= w:
        v = np.minimum(v[:-at], v[at:])
        at *= 2
    return np.minimum(v[:len(v) - (w - at)], v[w - at:]) if w > at else v


def scrambled(sym: np.ndarray) -> np.ndarray:
    if sym.dtype == np.uint8:
        return mix(np.arange(256, dtype=U) + U(0x2545F4914F6CDD1D))[sym]
    return mix(sym.astype(U) + U(0x2545F4914F6CDD1D))


def find_runs(sym: np.ndarray, ends: np.ndarray, k: int, length: int, turn: int = 0, turns: int = 1) -> tuple[np.ndarray, ...]:
    """(lo, n, off, key, sw, sx) of the runs in documents laid end to end; sw and sx are independent hashes of a run.

    Of several turns, each has the runs of its share of the anchors."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),) * 3
    if len(sym) < length:
        return none
    v = (gram_hash(sym, k).astype(U) << U(32)) | np.arange(len(sym) - k + 1, dtype=U)
    at = (sliding_min(v, length - k + 1) & U(0xFFFFFFFF)).astype(np.int64)
    # windows that would leave their document are void
    bad = np.zeros(len(sym) + 1, np.int32)
    starts = np.concatenate([[0], ends[:-1]])
    lo = np.maximum(starts, ends - length + 1)
    np.add.at(bad, lo, 1)
    np.add.at(bad, ends, -1)
    ok = np.cumsum(bad)[:len(at)] == 0
    cut = np.empty(len(at) + 1, bool)
    cut[0] = cut[-1] = True
    cut[1:-1] = (at[1:] != at[:-1]) | (ok[1:] != ok[:-1])
    edge = np.flatnonzero(cut)
    lo, hi = edge[:-1], edge[1:]
    good = ok[lo]
    lo, hi = lo[good], hi[good]
    if not len(lo):
        return none
    p = at[lo]
    h = prefix_hashes(sym)
    key = mix(span_hash(h, p, p + k))
    if turns > 1:
        mine = key % U(turns) == U(turn)
        lo, hi, p, key = lo[mine], hi[mine], p[mine], key[mine]
    off, n = p - lo, hi - lo
    sw = mix(span_hash(h, lo, hi - 1 + length) + off.astype(U) * U(0xD1B54A32D192ED03) + n.astype(U))
    # symbols scrambled first, so that symbols that sum alike in sw do not in sx
    other = prefix_hashes(scrambled(sym))
    sx = mix(span_hash(other, lo, hi - 1 + length) + off.astype(U) * U(0xD1B54A32D192ED03) + n.astype(U))
    return lo, n, off, key, sw, sx


@dataclass(frozen=True)
class Spec:
    """What makes symbols of a text, how long windows and anchors are, and the exact search."""

    length: int
    gram: int
    symbols: Callable[[bytes], np.ndarray]                   # text -> symbols
    cut: Callable[[bytes, list[tuple[int, int]]], list[bytes]]  # text, symbol ranges -> their bytes
    kernel: Callable[[np.ndarray, list[bytes], int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _rows(part, kind, payload, doc_id=None, uid=None) -> pa.RecordBatch:
    n = len(part)
    return pa.record_batch([pa.array(part, pa.int32()), pa.array([kind] * n, pa.int32()),
                            pa.array(doc_id if doc_id is not None else [None] * n, pa.int64()),
                            pa.array(uid if uid is not None else [None] * n, pa.int64()), pa.array(payload, pa.binary())],
                           names=["part", "kind", "doc_id", "uid", "payload"])


def _by_part(a: np.ndarray, part: np.ndarray) -> tuple[list[int], list[bytes]]:
    o = np.argsort(part, kind="stable")
    part, a = part[o], a[o]
    cut = np.flatnonzero(np.diff(part, prepend=-1))
    # field by field: equal kinds of bytes lie together and compress
    return part[cut].tolist(), [pack(x) for x in np.split(a, cut[1:])] if len(cut) else []


def pack(a: np.ndarray) -> bytes:
    return struct.pack("<q", len(a)) + b"".join(a[n].tobytes() for n in a.dtype.names)


def unpack(b: bytes, kind: np.dtype) -> np.ndarray:
    (n,) = struct.unpack_from("<q", b)
    out, at = np.empty(n, kind), 8
    for name in kind.names:
        t = kind[name]
        out[name] = np.frombuffer(b, t, n, at)
        at += n * t.itemsize
    return out


def _bucket(key: np.ndarray, n: int) -> np.ndarray:
    return ((key >> U(32)) * U(n) >> U(32)).astype(np.int32)


def _home(uid: np.ndarray, n: int) -> np.ndarray:
    return _bucket(mix(uid.astype(np.int64).view(U) + U(_M)), n)


def _repeats(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ordered by (key, sw, sx, did), and which repeat a run of a smaller document."""
    r = r[np.lexsort((r["did"], r["sx"], r["sw"], r["key"]))]
    new = np.ones(len(r), bool)
    new[1:] = (r["key"][1:] != r["key"][:-1]) | (r["sw"][1:] != r["sw"][:-1]) | (r["sx"][1:] != r["sx"][:-1])
    first = r["did"][np.flatnonzero(new)][np.cumsum(new) - 1] if len(r) else r["did"]
    return r, r["did"] > first


def _spans(r: np.ndarray, length: int) -> np.ndarray:
    """Spans of whole runs, joined where they touch."""
    s = np.empty(len(r), SPAN)
    s["uid"], s["lo"], s["hi"] = r["uid"], r["lo"], r["lo"] + r["n"].astype(np.uint32) - 1 + length
    return joined(s)


def joined(s: np.ndarray) -> np.ndarray:
    """Union of spans per uid."""
    if len(s) < 2:
        return s
    s = s[np.lexsort((s["lo"], s["uid"]))]
    g = np.cumsum(np.diff(s["uid"], prepend=s["uid"][0]) != 0)
    top = np.maximum.accumulate(s["hi"].astype(np.int64) + (g.astype(np.int64) << 33)) - (g.astype(np.int64) << 33)
    new = np.ones(len(s), bool)
    new[1:] = (g[1:] != g[:-1]) | (s["lo"][1:] > top[:-1])
    at = np.flatnonzero(new)
    out = s[at]
    out["hi"] = np.append(top[at[1:] - 1], top[-1])
    return out


def send_runs(batches: Iterator[pa.RecordBatch], spec: Spec, parts: int, turn: int = 0, turns: int = 1) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def flush():
        r, again = _repeats(np.concatenate(held))
        s = _spans(r[again], spec.length)
        yield _rows(*_kinded(_by_part(s, _home(s["uid"], parts)), 1))
        r = r[~again]
        yield _rows(*_kinded(_by_part(r, _bucket(r["key"], parts)), 0))

    for ids, uids, texts in by_size(batches, "text", ["doc_id", "uid", "text"], BATCH):
        rows = [(NULL_ID if d is None else d, u, s) for d, u, t in zip(ids, uids, texts) if t and len(s := spec.symbols(t)) >= spec.length]
        if not rows:
            continue
        ends = np.cumsum([len(s) for *_, s in rows])
        lo, cnt, off, key, sw, sx = find_runs(np.concatenate([s for *_, s in rows]), ends, spec.gram, spec.length, turn, turns)
        doc = np.searchsorted(ends, lo, side="right")
        r = np.empty(len(lo), RUN)
        r["key"], r["sw"], r["sx"], r["n"], r["off"] = key, sw, sx, cnt, off
        r["did"] = np.array([d for d, *_ in rows], np.int64)[doc]
        r["uid"] = np.array([u for _, u, _ in rows], np.int64)[doc]
        r["lo"] = lo - np.concatenate([[0], ends[:-1]])[doc]
        held.append(r)
        n += len(r)
        if n >= FLUSH:
            yield from flush()
            held, n = [], 0
    if n:
        yield from flush()


def _kinded(packed: tuple[list[int], list[bytes]], kind: int):
    return packed[0], kind, packed[1]


def grouped(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[int, list[list]]]:
    """(part, rows) for input sorted by part; rows are tuples of the named columns."""
    now, held = None, []
    for b in batches:
        cols = [b.column(n).to_pylist() for n in ("part", *names)]
        for part, *row in zip(*cols):
            if part != now and held:
                yield now, held
                held = []
            now = part
            held.append(row)
    if held:
        yield now, held


def meet_runs(batches: Iterator[pa.RecordBatch], spec: Spec, parts: int) -> Iterator[pa.RecordBatch]:
    """Runs of a bucket of anchors: spans of whole repeats (kind 1), runs to look into (kind 2)."""
    for part, rows in grouped(batches, "kind", "payload"):
        got = [unpack(p, RUN) for kind, p in rows if kind == 0]
        if done := [unpack(p, SPAN) for kind, p in rows if kind == 1]:
            yield _rows([part], 1, [pack(joined(np.concatenate(done)))])
        if not got:
            continue
        r, again = _repeats(np.concatenate(got))
        s = _spans(r[again], spec.length)
        yield _rows(*_kinded(_by_part(s, _home(s["uid"], parts)), 1))
        r = r[~again]
        if not len(r):
            continue
        # anchors met in two documents with unequal runs
        new = np.ones(len(r), bool)
        new[1:] = r["key"][1:] != r["key"][:-1]
        at = np.flatnonzero(new)
        multi = np.maximum.reduceat(r["did"], at) != np.minimum.reduceat(r["did"], at)
        q = r[multi[np.cumsum(new) - 1]]
        ask = np.empty(len(q), ASK)
        for f in ASK.names:
            ask[f] = q[f]
        yield _rows(*_kinded(_by_part(ask, _home(ask["uid"], parts)), 2))


def send_texts(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=3)
    for ids, uids, texts in by_size(batches, "text", ["doc_id", "uid", "text"], 4 * BATCH):
        yield _rows(_home(np.array(uids, np.int64), parts).tolist(), 9, [None if t is None else z.compress(t) for t in texts], ids, uids)


def cut_runs(batches: Iterator[pa.RecordBatch], spec: Spec, parts: int) -> Iterator[pa.RecordBatch]:
    """Texts met by the runs asked for: the runs' own symbols, sent to their anchors."""
    z = zstandard.ZstdDecompressor()
    for at, ids, uids, texts in met(batches, ASK, 2):
        keys, head, body = [], [], []
        for d, u, t in zip(ids, uids, texts):
            if t is None or not len(q := at(u)):
                continue
            keys.append(q["key"])
            spans = [(int(a), int(a) + int(n) - 1 + spec.length) for a, n in zip(q["lo"], q["n"])]
            body += spec.cut(z.decompress(t), spans)
            h = np.empty(len(q), RUN)
            for f in ("key", "uid", "lo", "n", "off"):
                h[f] = q[f]
            h["sw"], h["sx"], h["did"] = 0, 0, NULL_ID if d is None else d
            head.append(h)
        if head:
            h = np.concatenate(head)
            b = _bucket(h["key"], parts)
            o = np.argsort(b, kind="stable")
            edge = np.flatnonzero(np.diff(b[o], prepend=-1))
            groups = np.split(o, edge[1:])
            yield _rows(b[o][edge].tolist(), 3, [_block(h[g], [body[i] for i in g.tolist()]) for g in groups])


def _block(h: np.ndarray, body: list[bytes]) -> bytes:
    p = pack(h)
    return struct.pack("<q", len(p)) + p + np.array([len(x) for x in body], "<u4").tobytes() + b"".join(body)


def _unblock(b: bytes) -> tuple[np.ndarray, list[bytes]]:
    (n,) = struct.unpack_from("<q", b)
    h = unpack(b[8:8 + n], RUN)
    size = np.frombuffer(b, "<u4", len(h), 8 + n)
    end = (8 + n + 4 * len(h) + np.cumsum(size, dtype=np.int64)).tolist()
    return h, [b[e - s:e] for e, s in zip(end, size.tolist())]


def met(batches: Iterator[pa.RecordBatch], kind: np.dtype, code: int):
    """Rows sorted by part and kind: packed arrays first, then texts in batches. Yields (lookup, ids, uids, texts)."""
    now, held, have, lookup = None, [], [], None
    for b in batches:
        part, k, ids, uids, load = (b.column(n).to_pylist() for n in ("part", "kind", "doc_id", "uid", "payload"))
        i = 0
        while i < len(part):
            if part[i] != now:
                now, held, lookup = part[i], [], None
            if k[i] != 9:
                if k[i] == code:
                    held.append(unpack(load[i], kind))
                i += 1
                continue
            if lookup is None:
                have = np.concatenate(held) if held else np.empty(0, kind)
                have = have[np.lexsort((have["lo"], have["uid"]))]
                lookup = _lookup(have)
            j = i
            while j < len(part) and part[j] == now:
                j += 1
            yield lookup, ids[i:j], uids[i:j], load[i:j]
            i = j


def _lookup(have: np.ndarray):
    u = np.ascontiguousarray(have["uid"])

    def at(uid: int) -> np.ndarray:
        return have[np.searchsorted(u, uid):np.searchsorted(u, uid, side="right")]
    return at


def look_into(batches: Iterator[pa.RecordBatch], spec: Spec, parts: int) -> Iterator[pa.RecordBatch]:
    """Exact search among runs that share anchors."""
    for _, rows in grouped(batches, "payload"):
        blocks = [_unblock(p) for (p,) in rows]
        h = np.concatenate([x for x, _ in blocks])
        body = [y for _, ys in blocks for y in ys]
        which, lo, hi = spec.kernel(h["did"], body, spec.length)
        s = np.empty(len(which), SPAN)
        s["uid"], s["lo"], s["hi"] = h["uid"][which], h["lo"][which] + lo, h["lo"][which] + hi
        s = joined(s)
        yield _rows(*_kinded(_by_part(s, _home(s["uid"], parts)), 1))


def repeated_spans(docs: DataFrame, spec: Spec, finish: Callable, schema: str) -> DataFrame:
    """``finish(doc_id, text, spans)`` of every row of docs(doc_id, text): spans are
    the [lo, hi) symbol ranges covered by windows that start in a smaller document.
    uid, the hash of doc_id and text, is added."""
    parts = width(docs.sparkSession)
    schema += ", uid long"
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).withColumn(
        "uid", F.xxhash64("doc_id", "text"))
    sort = lambda x: x.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind")
    texts = d.mapInArrow(lambda it: send_texts(it, parts), PACK)
    with swept(docs.sparkSession):
        found = []
        for turn in range(TURNS):
            runs = sort(d.mapInArrow(lambda it, turn=turn: send_runs(it, spec, parts, turn, TURNS), PACK))
            found.append(materialize(runs.mapInArrow(lambda it: meet_runs(it, spec, parts), PACK), "runs"))
        found = reduce(DataFrame.union, found)
        asked = sort(texts.union(found.where("kind = 2"))).mapInArrow(lambda it: cut_runs(it, spec, parts), PACK)
        more = materialize(sort(asked).mapInArrow(lambda it: look_into(it, spec, parts), PACK), "spans")

    def last(batches):
        z = zstandard.ZstdDecompressor()
        names, kinds = zip(*(x.split() for x in schema.split(", ")))
        for at, ids, uids, texts in met(batches, SPAN, 1):
            rows = []
            for doc, uid, t in zip(ids, uids, texts):
                s = joined(at(uid))
                text = b"" if t is None else z.decompress(t)
                rows.append((*finish(doc, text, s["lo"].astype(np.int64), s["hi"].astype(np.int64)), uid))
            yield pa.record_batch([pa.array(c, ARROW[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))

    return sort(texts.union(found.where("kind = 1")).union(more)).mapInArrow(last, schema)
