"""Surrogate keys (P-KEY).

New members get ``base + row_number() over (order by natural key)``. A global
window would pull every row into one task, so the rank is built in two passes
that stay distributed, whatever the size of the set:

1. range-partition on the order columns and sort inside each partition;
   tag rows with their partition id and in-partition position
   (``monotonically_increasing_id`` packs both) and write them once to a
   table under the checkpoint folder, so both passes read the same tags even
   if a task is recomputed or an executor is lost (range boundaries come from
   sampling and are not guaranteed to repeat);
2. count rows per partition (one row per partition), turn the counts into
   running offsets, and broadcast-join those offsets back (the side is bounded
   by the partition count).

The order columns must identify a row (callers deduplicate first), otherwise
ties are numbered arbitrarily - as in the SQL this reproduces.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimwright.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id: partition index << 33 | record number
_SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_folder: ContextVar[str | None] = ContextVar("scratch_folder", default=None)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """Tables that :func:`materialize` writes inside are removed at the end.

    For jobs that publish their results: nothing that reads such a table may be
    used after the block.
    """
    from dimwright.sources.publish import Files

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    token = _folder.set(path)
    try:
        yield path
    finally:
        _folder.reset(token)
        Files(spark, path).delete(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the checkpoint folder and read it back: the
    lineage ends there, and every later use sees the same rows."""
    spark = df.sparkSession
    root = _folder.get() or ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the tables that :func:`materialize` writes inside are removed as each is written.

    Nothing reads them again, and else they lie there until the driver happens
    to collect its garbage.
    """
    before = spark.conf.get(_SWEEP, None)
    spark.conf.set(_SWEEP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SWEEP) if before is None else spark.conf.set(_SWEEP, before)


def max_key(dim: DataFrame, key_col: str) -> Column:
    """Scalar subquery ``(select coalesce(max(key), 0) from dim)``."""
    return dim.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("long")).scalar()


def assign_keys(df: DataFrame, order_by: Sequence[str | Column], key_col: str,
                base: int | Column = 0, num_partitions: int | None = None) -> DataFrame:
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    base_col = base if isinstance(base, Column) else F.lit(base)
    # Without an explicit count the range exchange uses the session's shuffle
    # partitions and AQE may coalesce them, so a handful of new members do not
    # produce hundreds of files while a large set still spreads out.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = (ranged
                .sortWithinPartitions(*order)
                .withColumn("_kp", F.spark_partition_id().cast("long"))
                .withColumn("_kq", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("_kq", F.col("_kq") - F.shiftleft(F.col("_kp"), _POS_BITS))
    tagged = materialize(tagged, "keys")
    offsets = (tagged.groupBy("_kp").agg(F.count(F.lit(1)).alias("_kn"))
               .withColumn("_ko", F.coalesce(
                   F.sum("_kn").over(Window.orderBy("_kp").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
               .select("_kp", "_ko"))
    return (tagged.join(F.broadcast(offsets), "_kp")
            .withColumn(key_col, (base_col + F.col("_ko") + F.col("_kq") + F.lit(1)).cast("long"))
            .drop("_kp", "_kq", "_ko"))
