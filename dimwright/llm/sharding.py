"""Minimax contiguous sharding with DataFrame operations only.

Documents with equal texts form an atomic group. Groups stand in the order of
their text's SHA-256; the smallest capacity for which a greedy left-to-right
fill needs at most ``shards`` shards is found by binary search, and the order
is cut there (law ``bytes``: the largest shard is as small as it can be). A
group larger than an even share would leave shards empty, so such groups (at
most ``shards`` of them) get a shard each first and the others share the rest.

Prefix sums are two-level: 65,536 buckets by the first 16 bits of the digest,
then an ordered window inside each bucket, so no task sees more than a bucket.
The driver holds prefix sums at bucket borders, which bound the capacity from
below and above; only the stretches that the two bounds leave open are looked
up more finely, round by round, until single groups decide. What the driver
holds is bounded by the bucket count, whatever the table's size.

Edge cases: null texts form one group of size 16 a row with crc32 0; an empty
text is another; repeated rows each get a slot; a null doc_id is kept; an empty
table gives an empty result; with fewer groups than shards some stay empty.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimwright.operators.keys import materialize

SHARDS = 40
OVERHEAD = 16       # bytes counted for each document besides its text
BUCKETS = 65_536    # first-level buckets of the group order, and most points looked up in a round
CELLS = 512         # parts of a shard that number their slots on their own


def sized(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("0" * 64)).alias("g"))


class Points:
    """Known prefix sums in order; ``open`` tells whether groups lie between a point and the next."""

    def __init__(self, ends: list[int], open_: list[bool]):
        self.ends, self.open = [0, *ends], [*open_, False]     # open[i]: between ends[i] and ends[i + 1]
        self.total = self.ends[-1]

    def step(self, at: int, capacity: int, hopeful: bool) -> int:
        """Where a shard that starts at ``at`` ends; hopeful: a cut inside an open stretch is possible."""
        to = at + capacity
        if to >= self.total:
            return self.total
        i = bisect_right(self.ends, to) - 1
        return to if hopeful and self.open[i] else max(at, self.ends[i])

    def cuts(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        at, out = 0, []
        for _ in range(shards):
            at = self.step(at, capacity, hopeful)
            out.append(at)
        return out

    def smallest(self, shards: int, hopeful: bool) -> int:
        lo, hi = -(-self.total // shards), self.total
        while lo < hi:
            mid = (lo + hi) // 2
            if self.cuts(mid, shards, hopeful)[-1] == self.total:
                hi = mid
            else:
                lo = mid + 1
        return lo


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(capacity, prefix sums after each shard) for groups(bucket, p): p is the prefix sum that ends a group."""
    level = groups.groupBy("bucket").agg(F.max("p").alias("p"), F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    known = {r.p: r.n > 1 for r in level}       # prefix sum -> are there unknown ones between it and the one before
    bucket_of = {r.p: r.bucket for r in level}
    while True:
        ends = sorted(known)
        pts = Points(ends, [known[e] for e in ends])
        low, high = pts.smallest(shards, True), pts.smallest(shards, False)
        windows = list(zip(pts.cuts(low, shards, False), pts.cuts(high, shards, True)))
        todo = []
        for i, end in enumerate(ends):
            start = pts.ends[i]
            if known[end] and any(a < end and b >= start for a, b in windows):
                todo.append((bucket_of[end], start, end))
        if not todo:
            return high, pts.cuts(high, shards, False)
        # look into the open stretches: all their points if few, else evenly spread ones
        per = max(2, BUCKETS // len(todo))
        spans = groups.sparkSession.createDataFrame(todo, "bucket int, a long, b long")
        cell = F.floor((F.col("p") - F.col("a") - 1) * per / (F.col("b") - F.col("a")))
        found = (groups.join(F.broadcast(spans), "bucket").where("p > a and p <= b")    # at most BUCKETS stretches
                 .groupBy("bucket", "b", cell.alias("cell")).agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.count(F.lit(1)).alias("n")).collect())
        for r in found:     # both ends of a cell become known, so every round closes in
            known[r.lo] = False
            known[r.hi] = r.n > 2
            bucket_of[r.hi] = r.bucket


def minimax_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of docs(doc_id, text)."""
    d = sized(docs)
    groups = materialize(d.groupBy("g").agg(F.sum("size").alias("w"))
                         .withColumn("bucket", F.conv(F.substring("g", 1, 4), 16, 10).cast("int")), "groups")
    total = groups.agg(F.sum("w")).first()[0] or 0
    # groups above an even share of what is left stand alone; there are fewer than `shards`
    alone, left = [], total
    for r in groups.orderBy(F.desc("w"), "g").limit(shards - 1).collect():
        if r.w * (shards - len(alone)) <= left:
            break
        alone.append(r.g)
        left -= r.w
    rest = groups.where(~F.col("g").isin(alone)) if alone else groups
    per = rest.groupBy("bucket").agg(F.sum("w").alias("s"))       # one row a bucket
    offset = per.select("bucket", (F.sum("s").over(Window.orderBy("bucket")) - F.col("s")).alias("o"))
    inside = F.sum("w").over(Window.partitionBy("bucket").orderBy("g"))
    prefix = materialize(rest.withColumn("p", inside).join(F.broadcast(offset), "bucket")
                         .select("bucket", "g", (F.col("p") + F.col("o")).alias("p")), "prefix")
    ends = []
    if left:
        _, cuts = minimax_cuts(prefix, shards - len(alone))
        last = {r.p: r.g for r in prefix.where(F.col("p").isin(sorted(set(cuts)))).collect()}
        ends = [last.get(c, "") for c in cuts[:-1]]     # no shard but the last ends at the total unless it is the end
    shard = F.lit(len(alone))
    for g in ends:
        shard = shard + (F.col("g") > g).cast("int")
    for i, g in enumerate(alone):
        shard = F.when(F.col("g") == g, i).otherwise(shard)
    cell = F.pmod(F.xxhash64("doc_id", "g"), F.lit(CELLS)).cast("int")
    placed = d.withColumn("shard", shard.cast("int")).withColumn("cell", cell)
    counts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))      # at most shards x CELLS rows
    before = counts.select("shard", "cell", (F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n")).alias("before"))
    slot = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "g"))
    return (placed.withColumn("slot", slot).join(F.broadcast(before), ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("slot") + F.col("before") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
