"""Packing documents into training sequences by order-preserving dynamic programming.

Documents keep the order in which their partition is read. The token stream is
cut into windows of at most LENGTH tokens; a cut may stand at the end of a
document (free), of a sentence (SENTENCE) or, where neither comes for FORCED
tokens, inside one (TRUNCATE). With c the places of possible cuts,

    f[j] = min over i, c[j] - c[i] <= LENGTH, of f[i] + LENGTH - (c[j] - c[i]) + penalty[j]

is the least padding plus penalty up to cut j; f[i] + c[i] goes through a
monotone queue, so a cut costs O(1). The window open at the end of a stretch is
carried into the next, so each partition pads one last window.

Edge cases: a null text is an empty one; an empty document is its end id; a
document of any length is cut over as many windows as it needs; repeated rows
are packed each; a null doc_id is kept; malformed UTF-8 is read as replacement
characters; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import by_size
from dimwright.llm.tokens import encoder

LENGTH = 2048
END = 1
SENTENCE = 2
TRUNCATE = 24
FORCED = 64         # tokens without a boundary after which a cut inside is offered
STRETCH = 1_000_000  # tokens planned at once
MEMO = 200_000      # stretches of text in each generation a worker keeps; the pipeline's workers hold other stages' memos too

COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def possible_cuts(ids: np.ndarray, doc_ends: np.ndarray, sentence: np.ndarray, forced: int = FORCED) -> tuple[np.ndarray, np.ndarray]:
    """(places, penalties): ends of documents and sentences, and places inside long ones."""
    pen = np.full(len(ids) + 1, -1, np.int64)
    pen[1:][sentence[ids]] = SENTENCE
    pen[doc_ends] = 0
    pen[0] = 0
    at = np.flatnonzero(pen >= 0)
    gap = np.diff(np.append(at, len(ids)))
    for a, g in zip(at[gap > forced].tolist(), gap[gap > forced].tolist()):
        pen[a + forced:a + g:forced] = TRUNCATE
    pen[len(ids)] = 0
    at = np.flatnonzero(pen >= 0)
    return at, pen[at]


def best_cuts(at: list[int], penalty: list[int], length: int = LENGTH, open_end: bool = False) -> list[int]:
    """Places of the cuts of least padding and penalty, first and last place included; with an
    open end the last window goes on, so what it leaves free is no padding."""
    g, back = [at[0]], [0]          # g[i] = f[i] + c[i]
    queue = deque([0])              # g rises along the queue, so its head is the least in reach
    for j in range(1, len(at)):
        c = at[j]
        while at[queue[0]] < c - length:
            queue.popleft()
        i = queue[0]
        back.append(i)
        v = g[i] + length + penalty[j]      # f[j] + c[j]
        g.append(v)
        while queue and g[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    if open_end and len(at) > 1:
        back[-1] = min((i for i in range(bisect_left(at, at[-1] - length), len(at) - 1)), key=lambda i: g[i] - at[i])
    out, j = [at[-1]], len(at) - 1
    while j:
        j = back[j]
        out.append(at[j])
    return out[::-1]


def _pack(batches: Iterator[pa.RecordBatch], path: str, length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    enc = encoder(path, False, MEMO)
    sentence = np.zeros(enc.tok.get_vocab_size() + 2, bool)
    sentence[[i for t, i in enc.tok.get_vocab().items() if re.fullmatch(r"[^\w\s]*[.!?][\"')\]]*</w>", t)]] = True
    seq = TaskContext.get().partitionId() << 33      # sequence ids of a partition
    head: list[tuple] = []      # (doc_id, tokens before, tokens in all, ids) waiting

    def plan(last: bool):
        nonlocal seq, head
        ids = np.concatenate([h[3] for h in head])
        ends = np.cumsum([len(h[3]) for h in head])
        cuts = best_cuts(*(x.tolist() for x in possible_cuts(ids, ends, sentence, min(FORCED, length))), length, not last)
        if not last:
            cuts = cuts[:-1]
        edge = np.union1d(cuts, ends[ends <= cuts[-1]])
        lo, hi = edge[:-1], edge[1:]
        doc = np.searchsorted(ends, lo, side="right")
        win = np.searchsorted(cuts, lo, side="right") - 1
        begin = ends - np.array([len(h[3]) for h in head])
        raw = ids.tobytes()
        cols = [[head[d][0] for d in doc], [head[d][1] + int(a - begin[d]) for d, a in zip(doc, lo)], hi - lo,
                [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(lo.tolist(), hi.tolist())], [head[d][2] for d in doc],
                seq + win, lo - np.array(cuts)[win]]
        arrays = [pa.array(c, pa.int64()) for c in cols]
        if with_ids:
            arrays.append(pa.array([raw[4 * a:4 * b] for a, b in zip(lo.tolist(), hi.tolist())], pa.binary()))
        seq += len(cuts) - 1
        stay = int(cuts[-1])
        head = [(d, n + max(0, stay - int(b)), t, x[max(0, stay - int(b)):]) for (d, n, t, x), b, e in zip(head, begin, ends) if e > stay]
        return pa.record_batch(arrays, names=COLUMNS + ["ids"] * with_ids)

    held = 0
    for ids, texts in by_size(batches, "text", ["doc_id", "text"], 1_000_000):
        for d, x in zip(ids, enc.batch([t.decode("utf-8", "replace") if t else "" for t in texts])):
            head.append((d, 0, len(x) + 1, np.append(x, np.uint32(END)).astype("<u4")))
            held += len(x) + 1
        if held >= STRETCH:
            yield plan(False)
            held = sum(len(h[3]) for h in head)
    if head:
        yield plan(True)


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """A row per piece of docs(doc_id, text): its place in its document and in its sequence, and its ids
    (little-endian u32). A sequence id is unique; its offsets are gapless from 0."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = ", ".join(f"{c} long" for c in COLUMNS) + (", ids binary" if with_ids else "")
    return d.mapInArrow(lambda it: _pack(it, path, length, with_ids), schema)
