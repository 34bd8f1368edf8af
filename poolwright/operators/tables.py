"""Keyed table maintenance on DataFrames.

Each function returns the *new version* of the target; callers write it to a fresh
location (no in-place overwrite of a table that is being read).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           policy: Mapping[str, str], defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Keyed upsert with a per-column policy.

    ``policy[col]``: ``"overwrite"`` (source value when matched), ``"keep"`` (target value when
    matched), ``"coalesce"`` (COALESCE(source, target)). Unmatched source rows are inserted,
    taking ``defaults[col]`` for target columns the source does not carry. The source must be
    unique on ``keys``. One full-outer join on the key; no driver round-trip.
    """
    defaults = dict(defaults or {})
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_s_hit"))
    t = target.withColumn("_t_hit", F.lit(True))
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"_s_{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    in_target = F.col("_t_hit").isNotNull()
    in_source = F.col("_s_hit").isNotNull()
    out = []
    for c in target.columns:
        src = F.col(f"_s_{c}") if c in source.columns else None
        if c in keys:
            val = F.coalesce(F.col(c), src)
        else:
            rule = policy.get(c, "keep")
            insert_val = src if src is not None else defaults.get(c, F.lit(None))
            if src is None or rule == "keep":
                matched_val = F.col(c)
            elif rule == "overwrite":
                matched_val = src
            else:
                matched_val = F.coalesce(src, F.col(c))
            val = (F.when(in_target & in_source, matched_val).when(in_target, F.col(c))
                   .otherwise(insert_val))
        out.append(val.cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING on a composite key."""
    new = source.select(*target.columns).dropDuplicates(list(keys)).join(
        target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new)


def update_where_distinct(target: DataFrame, changes: DataFrame, key: str, cols: Mapping[str, str],
                          where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Set ``target[t_col] = changes[c_col]`` on key match where the value differs.

    ``cols`` maps target column -> changes column. ``changes`` must be unique on ``key``.
    Returns (new target, changed keys). ``where`` adds a condition on the target row.
    """
    ch = changes.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_c_{t}") for t, c in cols.items()])
    j = target.join(ch, F.col(key) == F.col("_k"), "left")
    hit = F.col("_k").isNotNull()
    if where is not None:
        hit = hit & where
    differs = None
    for t in cols:
        d = ~F.col(t).eqNullSafe(F.col(f"_c_{t}"))
        differs = d if differs is None else differs | d
    change = hit & differs
    j = j.withColumn("_changed", change)
    out = j.select(*[
        (F.when(F.col("_changed"), F.col(f"_c_{c}")).otherwise(F.col(c)) if c in cols else F.col(c)).alias(c)
        for c in target.columns
    ])
    changed = j.where(F.col("_changed")).select(key)
    return out, changed


def delete_matching(target: DataFrame, keys: DataFrame, on: Mapping[str, str] | str) -> DataFrame:
    """Drop target rows that match ``keys`` (left anti join)."""
    if isinstance(on, str):
        on = {on: on}
    k = keys.select(*[F.col(kc).alias(f"_d_{tc}") for tc, kc in on.items()]).distinct()
    cond = None
    for tc in on:
        c = F.col(tc) == F.col(f"_d_{tc}")
        cond = c if cond is None else cond & c
    return target.join(k, cond, "left_anti")


def delete_prefix(target: DataFrame, column: str, prefix: str) -> DataFrame:
    """S10 by prefix: a literal prefix (``_`` is not a wildcard)."""
    return target.where(~F.coalesce(F.col(column).startswith(prefix), F.lit(False)))
