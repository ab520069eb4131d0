"""Language ID by hyperdimensional profiles.

Every letter has a random +1/-1 vector of DIM numbers. A trigram of a word
(with blanks at its ends) is bound by permuting and multiplying its letters'
vectors, a text bundles (adds) the vectors of its trigrams, a language is the
bundle of its learning texts, and a document takes the language whose prototype
has the largest cosine with its bundle.

A bundle is linear in its trigrams, so the inner products with the prototypes
come from a table with a row per trigram, and no vector is built for a document.
The document's own norm is the same for all languages; as trigram vectors are
close to orthogonal it is taken as sqrt(DIM * sum of squared counts). Letters
and trigrams that no learning text holds are as good as orthogonal to every
prototype: they count in the norm alone.

Learning takes at most SAMPLE texts a language outside the held-out fold, those
of smallest hash of the id (a documented bound). Every document is read whole.

Edge cases: a null text or one without a letter is ``und`` with score 0; a null
doc_id is held out and predicted; a null lang is not learned from; ties go to
the language that sorts first; if nothing can be learned all are ``und``;
malformed UTF-8 reads as replacement characters, which are no letters; an empty
table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimwright.llm.common import by_size, held_out

SAMPLE = 400        # learning texts a language
DIM = 4096
SEED = 11


@lru_cache(1)
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def trigram_keys(text: str) -> np.ndarray:
    """Trigrams centred on a letter, as 63-bit keys of three code points; what is no letter is a blank (0)."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c[~_is_letter()[c]] = 0
    return ((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[c[1:-1] > 0]


def letter_vector(c: int) -> np.ndarray:
    return np.random.default_rng([SEED, c]).integers(0, 2, DIM, dtype=np.int8) * 2 - 1


class Profiles:
    """Prototypes of the languages, as a table with the inner products of each learned trigram."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.langs = sorted(set(langs))
        keys = [trigram_keys(t) for t in texts]
        self.keys = np.unique(np.concatenate(keys))
        place = {x: i for i, x in enumerate(self.langs)}
        count = np.zeros((len(self.langs), len(self.keys)), np.float32)
        for k, x in zip(keys, langs):
            u, n = np.unique(k, return_counts=True)
            count[place[x], np.searchsorted(self.keys, u)] += n / max(1, len(k))
        letter = {int(c): letter_vector(int(c)) for c in np.unique(np.stack([self.keys >> 42, self.keys >> 21 & 0x1FFFFF, self.keys & 0x1FFFFF]))}
        proto = np.zeros((len(self.langs), DIM), np.float32)
        self.table = np.zeros((len(self.keys), len(self.langs)), np.float32)
        blocks = [range(i, min(i + 2048, len(self.keys))) for i in range(0, len(self.keys), 2048)]

        def bound(block):       # permute and multiply
            return np.stack([np.roll(letter[int(k) >> 42], 2) * np.roll(letter[int(k) >> 21 & 0x1FFFFF], 1) * letter[int(k) & 0x1FFFFF]
                             for k in self.keys[block.start:block.stop]]).astype(np.float32)
        for b in blocks:
            proto += count[:, b.start:b.stop] @ bound(b)
        proto /= np.maximum(np.linalg.norm(proto, axis=1, keepdims=True), 1e-9)
        for b in blocks:
            self.table[b.start:b.stop] = bound(b) @ proto.T
        # letters of the learned texts, numbered, so that a trigram is found by one lookup
        letters = np.array(sorted(letter))
        self.dense = len(letters) <= 160
        if self.dense:
            self.number = np.full(sys.maxunicode + 1, len(letters), np.int32)
            self.number[letters] = np.arange(len(letters))
            self.width = len(letters) + 1
            at = self._cell(self.keys >> 42, self.keys >> 21 & 0x1FFFFF, self.keys & 0x1FFFFF)
            self.index = np.full(self.width**3, len(self.keys), np.int32)
            self.index[at] = np.arange(len(self.keys))

    def _cell(self, a, b, c):
        return (self.number[a] * self.width + self.number[b]) * self.width + self.number[c]

    def places(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the table of a text's trigrams, the row past the end for unlearned ones; and the keys of those."""
        if not self.dense:
            k = trigram_keys(text)
            i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
            at = np.where(self.keys[i] == k, i, len(self.keys))
            return at, k[at == len(self.keys)]
        c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _is_letter()[c]
        n = np.where(letter, self.number[c], self.number[0])
        centre = np.flatnonzero(n[1:-1] != self.number[0])
        at = self.index[(n[centre] * self.width + n[centre + 1]) * self.width + n[centre + 2]]
        new = centre[at == len(self.keys)]
        w = np.where(letter, c, 0).astype(np.int64)
        return at, (w[new] << 42) | (w[new + 1] << 21) | w[new + 2]

    def predict(self, text: str | None) -> tuple[str, float]:
        at, new = self.places(text) if text else ((), ())
        if not len(at):
            return "und", 0.0
        n = np.bincount(at, minlength=len(self.keys) + 1)[:-1].astype(np.float64)
        dot = n.astype(np.float32) @ self.table
        best = int(dot.argmax())
        other = np.unique(new, return_counts=True)[1].astype(np.float64)      # each unlearned trigram is a vector of its own
        return self.langs[best], float(np.clip(dot[best] / np.sqrt(DIM * (n @ n + other @ other)), 0, 1))


def _text(raw: bytes | None) -> str | None:
    return None if raw is None else raw.decode("utf-8", "replace")


def _predict(batches: Iterator[pa.RecordBatch], profiles: Profiles | None) -> Iterator[pa.RecordBatch]:
    for ids, held, texts in by_size(batches, "text", ["doc_id", "held_out", "text"], 2_000_000):
        got = [profiles.predict(_text(t)) if profiles else ("und", 0.0) for t in texts]
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array([x for x, _ in got]), pa.array([s for _, s in got], pa.float64())],
                              names=["doc_id", "held_out", "lang_pred", "score"])


def learn(docs: DataFrame, sample: int = SAMPLE) -> Profiles | None:
    """Profiles from docs(doc_id, text, lang): at most ``sample`` texts a language."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").where(F.col("lang").isNotNull() & ~held_out("doc_id"))
    per = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))       # a row a language
    order = F.xxhash64("doc_id")
    few = (known.join(F.broadcast(per), "lang").where(F.pmod(order, F.lit(1_000_000)) < 2_000_000.0 * sample / F.col("n"))
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id"))).where(F.col("rank") <= sample))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), "lang").where("text is not null")
            .join(few.select("doc_id", "lang").distinct(), ["doc_id", "lang"]).select("text", "lang").collect())
    rows = [(t, r.lang) for r in rows if len(trigram_keys(t := _text(bytes(r.text))))]
    return Profiles([t for t, _ in rows], [x for _, x in rows]) if rows else None


def language(text: Column, profiles: Profiles | None) -> Column:
    """Struct (lang_pred, score) of a text column."""
    held = SparkSession.active().sparkContext.broadcast(profiles)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        p = held.value
        got = [p.predict(_text(t)) if p else ("und", 0.0) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], names=["lang_pred", "score"])
    return predict(text.cast("binary"))


def identify(docs: DataFrame, profiles: Profiles | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of docs(doc_id, text)."""
    held = docs.sparkSession.sparkContext.broadcast(profiles)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), F.col("text").cast("binary").alias("text"))
    return d.mapInArrow(lambda it: _predict(it, held.value), "doc_id long, held_out boolean, lang_pred string, score double")
