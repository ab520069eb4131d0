"""Merkle manifest of a dataset by lag and lead windows.

Every row is a leaf; leaves of a group stand in the order of an id, and runs of
FAN nodes hash to a parent, level by level, up to the group's subroot. Subroots
of all groups, in the order of the group, hash to the root the same way. On each
level a window over a run holds the FAN - 1 nodes before and after a node as lag
and lead columns; the node's slot and the run's length mask those that exist.
The masked columns are the node's siblings, and the first node of a run hashes
its parent from them.

Positions come from a range sort: rows are numbered in their range, and counts
by (group, range) give what lies before, so a group of any size is spread over
tasks and no window sees more than a run. Each level is a table in the shared
folder; it holds a FAN-th of the level below. The siblings on the way to the
root meet a leaf from the top down, by one join a level.

Edge cases: a null column hashes as ``-``; a null group is the first group, a
null id the first leaf of its group; rows that share an id stand in the order
of their leaves, so the result does not depend on how the rows are stored;
repeated rows are leaves each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimwright.operators.keys import materialize

FAN = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows(g, ...) with ``pos``, the place in g by ``order`` from 0, and ``n``, the rows of g."""
    d = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    d = d.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"))
    d = materialize(d, "leaves")
    spans = d.groupBy("g", "part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("k"))
    of = Window.partitionBy("g")
    before = F.coalesce(F.sum("k").over(of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row for each group in each range that holds it; stored, so that Spark knows its size when it joins
    spans = materialize(spans.select("g", "part", (before - F.col("first")).alias("shift"), F.sum("k").over(of).alias("n")), "spans")
    return d.join(spans, ["g", "part"]).withColumn("pos", F.col("seq") + F.col("shift")).drop("part", "seq", "shift")


def rungs(nodes: DataFrame) -> DataFrame:
    """nodes(g, pos, n, h, ...) of groups that have more than one, with ``run``, and the siblings before (``left``) and after (``right``)."""
    run, slot = F.col("pos") - F.col("pos") % FAN, F.col("pos") % FAN
    d = nodes.where("n > 1").withColumn("run", (run / FAN).cast("long")).withColumn("slot", slot)
    length = F.least(F.lit(FAN), F.col("n") - F.col("run") * FAN)
    w = Window.partitionBy("g", "run").orderBy("pos")
    d = d.select("*", length.alias("length"), *(F.lag("h", j).over(w).alias(f"lag{j}") for j in range(1, FAN)),
                 *(F.lead("h", j).over(w).alias(f"lead{j}") for j in range(1, FAN)))
    left = F.concat_ws("", *(F.when(F.col("slot") >= j, F.col(f"lag{j}")) for j in range(FAN - 1, 0, -1)))
    right = F.concat_ws("", *(F.when(F.col("slot") + j < F.col("length"), F.col(f"lead{j}")) for j in range(1, FAN)))
    return d.select(*nodes.columns, "run", "slot", left.alias("left"), right.alias("right"))


def levels(leaves: DataFrame) -> list[DataFrame]:
    """Tables of nodes(g, pos, n, h), a level each, from the leaves to where no group has more than one."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    out = [leaves]
    while most > 1:
        up = rungs(out[-1].select("g", "pos", "n", "h")).where("slot = 0")
        out.append(materialize(up.select("g", F.col("run").alias("pos"), F.ceil(F.col("n") / FAN).alias("n"), digest(F.col("h"), F.col("right")).alias("h")), "nodes"))
        most = -(-most // FAN)
    return out


def paths(tree: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """The leaves with ``subroot`` and ``path``: the siblings (left, right) of every level, from the leaf
    to the root of its group, then those of ``above`` (g, path), the way on from there."""
    none = F.array().cast("array<struct<left:string,right:string>>")
    done = None
    for depth in range(len(tree) - 1, -1, -1):
        nodes = tree[depth]
        own = nodes.columns if depth == 0 else ["g", "pos"]
        top = nodes.where("n = 1").select(*own, F.col("h").alias("subroot"))
        if above is None:
            top = top.withColumn("path", none)
        else:
            top = top.join(above.select("g", "path"), "g")
        if done is not None:
            up = done.select("g", F.col("pos").alias("run"), "subroot", F.col("path").alias("_on"))
            step = F.array(F.struct("left", "right"))
            top = top.unionByName(rungs(nodes).join(up, ["g", "run"]).select(*own, "subroot", F.concat(step, "_on").alias("path")))
        done = top
    return done


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda h, x: digest(x["left"], h, x["right"]))


def proof(path: Column) -> Column:
    """Digest of all siblings on a path."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""))


def merkle_manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", order: str = "doc_id",
                    found: Mapping[str, Column] | None = None) -> DataFrame:
    """(``order``, leaf, found_leaf, subroot, root, path) per row of docs.

    ``found`` holds columns as they are met now, where they are to be checked
    against the manifest; found_leaf is the leaf of that row. A row is intact if
    ``fold(path, found_leaf)`` is the root.
    """
    now = found or {}
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))        # the null group comes before the empty one
    leaves = docs.select(g.alias("g"), F.col(order).alias("id"), digest(*(field(F.col(c)) for c in columns)).alias("h"),
                         digest(*(field(now.get(c, F.col(c))) for c in columns)).alias("found"))
    tree = levels(numbered(leaves, ["id", "h"]))
    subroots = None
    for nodes in tree:
        own = nodes.where("n = 1").select(F.lit("").alias("g"), F.col("g").alias("of"), "h")
        subroots = own if subroots is None else subroots.unionByName(own)
    trunk = levels(numbered(subroots, ["of"]))
    root = trunk[-1].select("h").first()     # one row, none of an empty table
    above = materialize(paths(trunk, None).select(F.col("of").alias("g"), "path"), "trunk")
    out = paths(tree, above)
    return out.select(F.col("id").alias(order), F.col("h").alias("leaf"), F.col("found").alias("found_leaf"), "subroot",
                      F.lit(root.h if root else None).cast("string").alias("root"), "path")
