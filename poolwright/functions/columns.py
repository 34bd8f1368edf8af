"""Column expressions shared by the operators (F1-F13, C6, C7, W1 helpers).

All built-in Spark functions: they stay inside whole-stage codegen, no Python per row.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolwright.functions import constants as K

_EPOCH = _dt.date(1970, 1, 1)
_EPOCH_TS = _dt.datetime(1970, 1, 1)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """NULLIF(TRIM(x), '')."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def days_until(c: str | Column, run_date: _dt.date) -> Column:
    """signed whole days from the run date to ``c`` (date part only)."""
    return F.datediff(col(c).cast("date"), F.lit(run_date))


def days_since(c: str | Column, run_date: _dt.date) -> Column:
    return F.datediff(F.lit(run_date), col(c).cast("date"))


def clock_bag(days: Column, window: int) -> Column:
    """0 = inside the retention window (1..window), 1 = past / today / unknown, 2 = beyond."""
    return (
        F.when((days >= 1) & (days <= window), F.lit(0))
        .when(days.isNull() | (days < 1), F.lit(1))
        .otherwise(F.lit(2))
    )


def clock_label(days: Column, window: int) -> Column:
    return (
        F.when((days >= 1) & (days <= window), F.lit("RETENTION"))
        .when(days.isNull() | (days < 1), F.lit("PAST_RETENTION"))
        .otherwise(F.lit("UPSELLING"))
    )


def lower_contains(c: str | Column, needle: str) -> Column:
    """LOWER(x) LIKE '%needle%' (NULL stays NULL)."""
    return F.lower(col(c)).contains(needle)


def is_dfv(type_col: str | Column) -> Column:
    """Deemed / flexible / variable contract type. NULL type = not DFV."""
    raw = F.lower(F.trim(F.coalesce(col(type_col).cast("string"), F.lit(""))))
    cond = raw.isin(*K.DFV_EXACT)
    for word in K.DFV_CONTAINS:
        cond = cond | raw.contains(word)
    return cond


def _pattern(name_l: Column, kind: str, p: str) -> Column:
    if kind == "contains":
        return name_l.contains(p)
    if kind == "prefix":
        return name_l.startswith(p)
    return name_l == p


def first_match(name: Column, rules: Sequence, default) -> Column:
    """Ordered (value, patterns) list on LOWER(name); first match wins."""
    name_l = F.lower(name)
    expr = None
    for value, patterns in rules:
        cond = None
        for kind, p in patterns:
            c = _pattern(name_l, kind, p)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def slug(c: str | Column) -> Column:
    """F8: non-alphanumeric runs -> '_', trim '_' at both ends, upper case."""
    s = F.regexp_replace(col(c), "[^a-zA-Z0-9]+", "_")
    return F.upper(F.btrim(s, F.lit("_")))


def ne_null_safe(a: Column, b: Column) -> Column:
    """a IS DISTINCT FROM b."""
    return ~a.eqNullSafe(b)


def complaint_text(title: str | Column, description: str | Column) -> Column:
    """the phrase may start in the title and end in the description."""
    text = F.concat(F.coalesce(col(title), F.lit("")), F.lit(" "), F.coalesce(col(description), F.lit("")))
    return F.lower(text).contains(K.COMPLAINT_TEXT)


# --- W1: best row per key as one partial aggregate ---------------------------

def asc_key(c: str | Column) -> list[Column]:
    """Ascending, NULLs last."""
    c = col(c)
    return [c.isNull(), c]


def desc_date_key(c: str | Column) -> list[Column]:
    """Descending date, NULLs last (negated epoch day)."""
    c = col(c)
    return [c.isNull(), -F.datediff(c.cast("date"), F.lit(_EPOCH))]


def desc_ts_key(c: str | Column) -> list[Column]:
    """Descending timestamp_ntz, NULLs last (negated epoch microseconds; time-zone free)."""
    c = col(c).cast("timestamp_ntz")
    return [c.isNull(), -F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_TS).cast("timestamp_ntz"), c)]


def pick_best(df: DataFrame, keys: Sequence[str], order: Iterable[Column], payload: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple.

    ``min(struct(order..., payload...))`` is a partial (map-side) aggregate: a hot key is
    reduced inside every map task before the shuffle, so no task ever holds a whole group
    and no window sort runs over the facts. ``order`` must be a total order (end with a
    unique tie-break) for the pick to be deterministic.
    """
    order = list(order)
    fields = [o.alias(f"_o{i}") for i, o in enumerate(order)] + [F.col(p).alias(p) for p in payload]
    best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{p}").alias(p) for p in payload])


def left_join_nullable(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join where many left keys may be NULL.

    NULL keys never match, but a shuffle join would hash them all to one task. Each such row gets a
    key of its own instead (a hash of the row behind a NUL, which no id starts with), so they spread
    over all tasks; ``left`` is read once, whatever join Spark picks.
    """
    own = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in left.columns]).cast("string"))
    return left.join(right, F.coalesce(F.col(left_key), own) == F.col(right_key), "left")
