"""The three mutation patterns every load is built from, as pure functions.

Parquet tables cannot be updated in place, so each "statement" takes the
current table state and returns the next one:

* :func:`update_from` - ``UPDATE t SET .. FROM s WHERE ..`` (P-UPD)
* :func:`insert_missing` - insert source members absent from a dimension,
  keyed ``max(key) + row_number()`` (P-NEW)
* :func:`supersede` - deactivate current versions of staged keys (P-SCD)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.operators.keys import assign_keys, max_key

JoinSpec = Sequence[tuple[str | Column, str | Column]]


def _c(x: str | Column, alias: str | None = None) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(f"{alias}.{x}" if alias else x)


def one_per_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the smallest by ``order_by`` (then by the rest).

    PostgreSQL picks an arbitrary row when several source rows hit one
    target row; here the pick is stated. Aggregates partially before the
    shuffle (min of a struct), so a hot key costs one row per map task.
    """
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.dropDuplicates(list(keys))
    order = list(order_by or []) + [c for c in rest if c not in (order_by or [])]
    packed = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])).alias("_r")
    out = source.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_r._o{order.index(c)}").alias(c) for c in rest])


def update_from(target: DataFrame, source: DataFrame, on: JoinSpec,
                assignments: Mapping[str, Column], where: Column | None = None,
                source_unique: bool = False, source_order: Sequence[str] | None = None) -> DataFrame:
    """``UPDATE target t SET col = expr FROM source s WHERE on AND where``.

    ``on`` pairs are (target side, source side); string sides name columns of
    ``t`` / ``s``; Column sides may use ``F.col('t.x')`` / ``F.col('s.y')``.
    Assignment and ``where`` expressions see both aliases. The match flag,
    not ``coalesce``, decides: an update may legitimately write NULL.
    Output has exactly the target's rows and columns.
    """
    src_keys = [s for _, s in on if isinstance(s, str)]
    src = source
    if not source_unique:
        if len(src_keys) != len(on):
            raise ValueError("deduplicating the source needs plain column keys; pass source_unique=True")
        src = one_per_key(source, src_keys, source_order)
    src = src.withColumn("_matched", F.lit(True))
    cond = None
    for t_side, s_side in on:
        c = _c(t_side, "t") == _c(s_side, "s")
        cond = c if cond is None else cond & c
    joined = target.alias("t").join(src.alias("s"), cond, "left")
    hit = F.col("s._matched").isNotNull()
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    cols = []
    for c in target.columns:
        if c in assignments:
            cols.append(F.when(hit, assignments[c]).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.col(f"t.{c}").alias(c))
    return joined.select(*cols)


def update_where(target: DataFrame, assignments: Mapping[str, Column], where: Column) -> DataFrame:
    """``UPDATE target SET .. WHERE pred`` without a source table."""
    hit = F.coalesce(where, F.lit(False))
    return target.select(*[F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c)
                           if c in assignments else F.col(c) for c in target.columns])


def anti_join(candidates: DataFrame, existing: DataFrame, on: Sequence[str], null_aware: bool = False,
              null_safe: bool = False) -> DataFrame:
    """Rows of ``candidates`` whose ``on`` values are absent from ``existing``.

    Default: ``LEFT JOIN .. WHERE right IS NULL`` - a null key never matches,
    so it counts as absent. ``null_aware``: ``NOT IN`` - a null candidate is
    absent from an empty set only, and a single null in ``existing`` makes every row present.
    ``null_safe``: null equals null (``<=>``).
    """
    keys = existing.select(*on)
    if null_safe:
        cond = None
        for k in on:
            c = candidates[k].eqNullSafe(keys[k])
            cond = c if cond is None else cond & c
        return candidates.join(keys, cond, "left_anti")
    if not null_aware:
        return candidates.join(keys, list(on), "left_anti")
    if len(on) != 1:
        raise ValueError("NOT IN semantics are defined for one column")
    k = on[0]
    blocked, some = keys.filter(F.col(k).isNull()).exists(), keys.exists()
    return (candidates.join(keys.filter(F.col(k).isNotNull()), [k], "left_anti")
            .filter(~blocked & (F.col(k).isNotNull() | ~some)))


def insert_missing(dim: DataFrame, candidates: DataFrame, on: Sequence[str], key_col: str | None,
                   order_by: Sequence[str] | None = None, null_aware: bool = False,
                   distinct: bool = False) -> DataFrame:
    """Append candidate members whose ``on`` values are absent from ``dim``.

    ``candidates`` is already projected to dimension column names. New keys
    are ``coalesce(max(key), 0) + row_number() over (order by order_by)``
    (default: all candidate columns), computed without a global window.
    ``key_col=None`` appends without a generated key.
    """
    cand = candidates.distinct() if distinct else candidates
    missing = anti_join(cand, dim, on, null_aware=null_aware)
    if key_col is not None:
        order = list(order_by or cand.columns)
        missing = assign_keys(missing, order, key_col, base=max_key(dim, key_col))
    return dim.unionByName(missing, allowMissingColumns=True)


def supersede(current: DataFrame, staged_keys: DataFrame, on: Sequence[str], as_of,
              active_col: str = "is_active", stamp_col: str | None = "date_updated",
              only_active: bool = False) -> DataFrame:
    """Flag every version of a staged key inactive and restamp it.

    ``staged_keys`` may repeat keys; only its key set is used. With
    ``only_active`` rows already inactive keep their stamp (``AND is_active``).
    """
    keys = staged_keys.select(*on).distinct()
    assign = {active_col: F.lit(False)}
    if stamp_col:
        assign[stamp_col] = F.lit(as_of).cast(current.schema[stamp_col].dataType)
    where = F.col(f"t.{active_col}") if only_active else None
    return update_from(current, keys, [(k, k) for k in on], assign, where=where, source_unique=True)
