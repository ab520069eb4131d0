"""Helpers the training-data operators share.

Every operator reads only the columns it names, so extra columns of any name
pass by unread. Rows are told apart by ``uid`` (a hash of doc_id and text), so
repeated ids and repeated rows stay separate rows of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.operators.keys import materialize

NULL_ID = 2**63 - 1     # a null doc_id orders after every other id


def width(spark: SparkSession) -> int:
    """Shuffle partitions the session asks for; the cluster sizes them to the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str) -> Column:
    """crc32(doc_id as text) mod 3 is 1; a null id counts as held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def columns_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    """Python lists of the named columns, batch by batch."""
    for b in batches:
        if b.num_rows:
            yield tuple(b.column(n).to_pylist() for n in names)


def by_size(batches: Iterator[pa.RecordBatch], text: str, names: list[str], most: int) -> Iterator[tuple[list, ...]]:
    """Like columns_of, in pieces of about ``most`` bytes of the binary column ``text`` (one row at least)."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False)
        lo = got = 0
        for i, n in enumerate(sizes.tolist()):
            got += n
            if got >= most or i == len(sizes) - 1:
                piece = b.slice(lo, i + 1 - lo)
                yield tuple(piece.column(n).to_pylist() for n in names)
                lo, got = i + 1, 0


class Memo(dict):
    """dict that computes missing values with ``fn`` and is emptied when ``most`` keys are held."""

    def __init__(self, fn, most: int = 300_000):
        super().__init__()
        self.fn, self.most = fn, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        v = self[key] = self.fn(key)
        return v


U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer (in place on a fresh array)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> U(31))
        h *= U(0x9FB21C651E98DF25)
        h ^= h >> U(29)
        h *= U(0xD6E8FEB86659FD93)
        h ^= h >> U(32)
    return h


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components as (node, component): component is the smallest node
    reachable. Nodes without an edge are not listed.

    Alternating large-star and small-star steps on the edge table: every step
    is a min per node and a join, each round is written to the shared folder
    and the loop ends when a round changes nothing. Rounds grow with the
    logarithm of the longest path.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    e = materialize(e, "cc")
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark or now[0] == 0:
            break
        mark = tuple(now)
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low2.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small, "cc")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
