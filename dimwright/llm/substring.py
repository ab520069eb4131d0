"""Word-level substring dedup by relative Lempel-Ziv parsing.

A window is ``length`` consecutive words of a document. Words covered by a
window whose words also start in a document with a smaller doc_id are removed;
windows are judged on the input.

windows.py brings together the stretches of text that share an anchor. The
stretches of smaller documents are the reference block of a stretch: every
window of the block is indexed at its smallest document, and the stretch is
factored greedily against the index: the longest copy from the indexed place,
else one literal word. A factor of ``length`` words or more is a repeated span.
Greedy factors hide windows that straddle the end of a factor, so parsing goes
on at the first window that the factor does not hold whole.

Edge cases: a null text has no words; a text of fewer than ``length`` words
keeps all; rows with a null doc_id order after all others; repeated doc_ids
never remove from each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from dimwright.llm.common import Memo
from dimwright.llm.windows import Spec, prefix_hashes, repeated_spans, span_hash

LENGTH = 13
GRAM = 5        # words of an anchor

_CODES = Memo(xxhash.xxh3_64_intdigest)


def word_codes(text: bytes) -> np.ndarray:
    """64-bit codes of the words [^\\x20\\x09-\\x0D]+ of a text."""
    return np.array(list(map(_CODES.__getitem__, text.split())), np.uint64)


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    w = text.split()
    return [b" ".join(w[a:b]) for a, b in spans]


def relative_factors(did: np.ndarray, body: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(body, lo, hi) of the long factors of each body against the bodies of smaller documents."""
    names: dict[bytes, int] = {}
    words = [[names.setdefault(w, len(names)) for w in x.split()] for x in body]
    sym = np.array([w for x in words for w in x], np.uint64)
    size = np.array([len(x) for x in words], np.int64)
    begin = np.cumsum(size) - size
    count = size - length + 1
    which = np.repeat(np.arange(len(body)), count)
    pos = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
    h = prefix_hashes(sym)
    code = span_hash(h, pos, pos + length)
    # the index: window -> its place in the smallest document
    o = np.lexsort((did[which], code))
    new = np.ones(len(o), bool)
    new[1:] = code[o][1:] != code[o][:-1]
    source = np.empty(len(o), np.int64)
    source[o] = o[np.flatnonzero(new)][np.cumsum(new) - 1]
    known = did[which[source]] < did[which]
    out: list[tuple[int, int, int]] = []
    at = np.cumsum(count) - count
    stop = begin + size
    for b in np.unique(which[known]).tolist():
        i, n, w = 0, int(count[b]), words[b]
        hit = known[at[b]:at[b] + n]
        while i < n:
            if not hit[i]:
                step = np.argmax(hit[i:])       # literals up to the next indexed window
                if not hit[i + step]:
                    break
                i += int(step)
            j = int(source[at[b] + i])
            ref = words[which[j]]
            r = int(pos[j] - begin[which[j]])
            m = 0
            while i + m < len(w) and r + m < len(ref) and w[i + m] == ref[r + m]:
                m += 1
            if m >= length:
                out.append((b, i, i + m))
                i += m - length + 1
            else:
                i += 1
    a = np.array(out, np.int64).reshape(-1, 3)
    return a[:, 0], a[:, 1], a[:, 2]


def finish(doc_id, text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple:
    w = text.split()
    edge = np.concatenate([[0], np.stack([lo, hi], 1).ravel(), [len(w)]]).tolist()
    kept = b" ".join(x for a, b in zip(edge[::2], edge[1::2]) for x in w[a:b])
    return doc_id, len(w), int((hi - lo).sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")


def spec(length: int = LENGTH, gram: int = GRAM) -> Spec:
    return Spec(length, gram, word_codes, cut_words, relative_factors)


def substring_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) per row of docs(doc_id, text)."""
    return repeated_spans(docs, spec(length, gram), finish,
                          "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
