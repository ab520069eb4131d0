"""Token ids in Simple-8b files.

A file is a run of payloads in ascending doc_id order; a payload holds whole
documents, about PAYLOAD ids. Layout (little-endian):

    magic b"S8B1", then u64: documents d, ids n, blocks b, words w, nulls z
    i64[d] doc ids (null ids as the smallest i64), u64[d] ids per document
    u64[b + 1] first word of every block of BLOCK ids
    u64[w] words: the top 4 bits select how many ids of how many bits follow
    from the lowest bit up; selector 14 escapes: the next word is one raw id

Blocks start on a word, so any block decodes on its own and all words of one
selector decode in one vector operation. Payloads are binary values of a
Parquet table in the shared folder, one part file per range of doc_ids: Spark
commits and re-reads them on any store.

Edge cases: a null text is an empty one; an empty document holds the end id
only; null doc_ids come first; rows that share a doc_id stand in the order of
a hash of their texts, so an order that holds wherever the rows are stored, and
the rows of one id spread over tasks;
repeated rows are written each; malformed UTF-8 is read as replacement
characters; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimwright.llm.common import U, by_size, columns_of, width
from dimwright.llm.tokens import encoder
from dimwright.operators.keys import materialize

#: ids a word holds, bits of each; the selector is the place in this list
SELECTORS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 14
BLOCK = 4096
TOGETHER = 128      # blocks encoded at once
PAYLOAD = 500_000
END = 0
_COUNT = np.array([c for c, _ in SELECTORS] + [0, 0])
_LIMIT = np.array([1 << b for b in range(64)], U)
_HOP = np.where(_COUNT, _COUNT, 1)      # an escape takes one id
_BITS = np.searchsorted(_LIMIT, np.arange(1 << 16, dtype=U), side="right").astype(np.uint8)
_NULL = -2**63


def encode_blocks(x: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words of blocks of u64 ids, and where each block's words start (with their number appended)."""
    n = -(-len(x) // block)
    ids = np.zeros((n, block + 60), U)      # a zero takes no bit, and zeros follow each block
    ids[:, :block].flat[:len(x)] = x
    bits = _BITS[ids] if int(x.max(initial=0)) < len(_BITS) else np.searchsorted(_LIMIT, ids, side="right").astype(np.uint8)
    run = {1: bits}         # widest of the next so many ids
    sel = np.full((n, block), ESCAPE, np.uint8)
    for s, (count, b) in zip(range(len(SELECTORS) - 1, -1, -1), SELECTORS[::-1]):
        half = max(c for c in run if c <= count)
        part = run[half]
        while half < count:         # two overlapping stretches make a longer one
            step = min(half, count - half)
            part = np.maximum(part[:, :-step], part[:, step:])
            half += step
        run[count] = part
        fits = part[:, :block] <= b
        if not fits.any():          # then no longer run of fewer bits fits either
            break
        np.copyto(sel, s, where=fits)
    sel = sel.ravel()
    # all blocks hop from word to word together
    begins = np.zeros(n * block, bool)
    at = np.arange(n) * block
    end = np.minimum(at + block, len(x))
    while len(at):
        begins[at] = True
        at = at + _HOP[sel[at]]
        go = at < end
        at, end = at[go], end[go]
    starts = np.flatnonzero(begins)
    of = starts // block
    sel = sel[starts]
    wide = sel == ESCAPE
    slot = np.arange(len(starts)) + np.cumsum(wide) - wide
    out = np.zeros(len(starts) + int(wide.sum()), U)
    flat, place = ids.ravel(), starts + 60 * of
    for s in np.unique(sel).tolist():
        mine = np.flatnonzero(sel == s)
        where, to = place[mine], slot[mine]
        if s == ESCAPE:
            out[to] = U(ESCAPE << 60)
            out[to + 1] = flat[where]
            continue
        count, b = SELECTORS[s]
        word = np.full(len(mine), s << 60, U)
        for i in range(count):
            word |= flat[where + i] << U(i * b)
        out[to] = word
    size = np.bincount(of, minlength=n) + np.bincount(of[wide], minlength=n)
    return out, np.concatenate([[0], np.cumsum(size)])


def encode_block(x: np.ndarray) -> np.ndarray:
    """Words of one block of u64 ids."""
    return encode_blocks(x, max(len(x), 1))[0]


def decode_words(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The n ids of words whose blocks start at ``first`` (with the end appended)."""
    sel = (words >> U(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(sel == ESCAPE).tolist():        # a raw word may look like an escape
        if not raw[i]:
            raw[i + 1] = True
    count = np.where(raw, 1, _COUNT[sel])
    at = np.concatenate([[0], np.cumsum(count)])
    flat = np.zeros(int(at[-1]), U)
    flat[at[:-1][raw]] = words[raw]
    for s, (c, b) in enumerate(SELECTORS):
        mine = np.flatnonzero((sel == s) & ~raw)
        if len(mine):
            flat[at[mine][:, None] + np.arange(c)] = (words[mine][:, None] >> (np.arange(c) * b).astype(U)) & U((1 << b) - 1)
    # the last word of a block may hold more than is left of it
    begin = at[first[:-1].astype(np.int64)]
    size = np.full(len(begin), BLOCK)
    size[-1:] = n - BLOCK * (len(begin) - 1)
    out = np.empty(n, U)
    for i, (a, k) in enumerate(zip(begin.tolist(), size.tolist())):
        out[i * BLOCK:i * BLOCK + k] = flat[a:a + k]
    return out


def write_payload(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    x = np.concatenate(docs).astype(U) if docs else np.zeros(0, U)
    parts = [encode_blocks(x[i:i + BLOCK * TOGETHER]) for i in range(0, len(x), BLOCK * TOGETHER)]
    words = [w for w, _ in parts]
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *(np.diff(f) for _, f in parts)]))]).astype("<u8")
    head = struct.pack("<4s5Q", b"S8B1", len(docs), len(x), len(first) - 1, int(first[-1]), sum(d is None for d in doc_ids))
    ids = np.array([_NULL if d is None else d for d in doc_ids], "<i8")
    return b"".join([head, ids.tobytes(), np.array([len(d) for d in docs], "<u8").tobytes(), first.tobytes(),
                     *(w.astype("<u8").tobytes() for w in words)])


def read_payload(b: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    magic, d, n, blocks, w, _ = struct.unpack_from("<4s5Q", b)
    if magic != b"S8B1":
        raise ValueError("not a Simple-8b payload")
    at = 44
    ids = np.frombuffer(b, "<i8", d, at)
    size = np.frombuffer(b, "<u8", d, at + 8 * d).astype(np.int64)
    first = np.frombuffer(b, "<u8", blocks + 1, at + 16 * d)
    x = decode_words(np.frombuffer(b, "<u8", w, at + 16 * d + 8 * (blocks + 1)), first, n)
    return [None if i == _NULL else i for i in ids.tolist()], np.split(x, np.cumsum(size)[:-1]) if d else []


def _write(batches: Iterator[pa.RecordBatch], path: str, payload: int) -> Iterator[pa.RecordBatch]:
    enc, part = encoder(path, True), TaskContext.get().partitionId()
    ids, docs, held, before = [], [], 0, 0

    def row():
        return pa.record_batch([pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([held], pa.int64()),
                                pa.array([write_payload(ids, docs)], pa.binary())], names=["file", "before", "n_ids", "payload"])

    for doc_ids, texts in by_size(batches, "text", ["doc_id", "text"], 1_000_000):
        for d, x in zip(doc_ids, enc.batch([t.decode("utf-8", "replace") if t else "" for t in texts])):
            ids.append(d)
            docs.append(np.append(x, np.uint32(END)))
            held += len(x) + 1
            if held >= payload:
                yield row()
                ids, docs, before, held = [], [], before + held, 0
    if ids:
        yield row()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for starts, payloads in columns_of(batches, "start", "payload"):
        for at, p in zip(starts, payloads):
            ids, docs = read_payload(p)
            n = np.array([len(x) for x in docs], np.int64)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(at + np.cumsum(n) - n), pa.array(n),
                                   pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in docs], pa.int64())],
                                  names=["doc_id", "start", "n_tokens", "ids_crc32"])


def write_token_files(docs: DataFrame, path: str, payload: int = PAYLOAD) -> DataFrame:
    """Encode docs(doc_id, text), write the files, return them as (file, before, n_ids, payload)."""
    n = width(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    tie = F.xxhash64("text")       # the range sample holds ids and hashes, not texts
    d = d.repartitionByRange(n, F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    return materialize(d.mapInArrow(lambda it: _write(it, path, payload), "file int, before long, n_ids long, payload binary"), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    total = files.groupBy("file").agg(F.sum("n_ids").alias("n"))      # a row a file
    offset = total.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("o"))
    return (files.join(F.broadcast(offset), "file").select((F.col("before") + F.col("o")).alias("start"), "payload")
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long"))
