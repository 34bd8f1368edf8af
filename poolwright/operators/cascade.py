"""Deletes that follow a declared graph of references.

A ``Reference`` says that a column of a table holds keys of another. Doomed rows of the target doom the rows that refer
to them (``delete``) or take the reference off them (``clear``); rows that go doom what refers to them in turn. Every
step is a semi or anti join on the reference's key, so nothing is collected; the graph must not have cycles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Reference:
    table: str
    column: str
    target: str
    key: str = "id"
    action: str = "delete"  # or "clear"


def order_of(tables: Sequence[str], references: Sequence[Reference]) -> list[str]:
    """Targets before the tables that refer to them."""
    waits = {t: {r.target for r in references if r.table == t and r.action == "delete" and r.target in tables} for t in tables}
    out: list[str] = []
    while waits:
        free = [t for t in tables if t in waits and not waits[t] - set(out)]
        if not free:
            raise ValueError(f"references go round in a circle: {sorted(waits)}")
        out += free
        waits = {t: w for t, w in waits.items() if t not in free}
    return out


def _keys(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.col(column).alias("_doomed")).where(F.col("_doomed").isNotNull()).distinct()


def cascade(tables: Mapping[str, DataFrame], references: Sequence[Reference], doomed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables after deleting ``doomed`` (rows of some of them) and all that hangs on those rows.

    Null references hold nothing. Rows of ``doomed`` count by their key, the one that references to their table name (``id``
    where none does). Tables without a reference to a doomed one come back as they are.
    """
    key_of = {r.target: r.key for r in references}
    out = dict(tables)
    dead: dict[str, DataFrame] = {t: _keys(rows, key_of.get(t, "id")) for t, rows in doomed.items()}
    for name in order_of(list(tables), references):
        own = [r for r in references if r.table == name and r.target in dead]
        rows = tables[name]
        lost: list[DataFrame] = []
        for r in own:
            hit = dead[r.target]
            if r.action == "clear":
                marked = out[name].join(hit, F.col(r.column) == F.col("_doomed"), "left")
                kept = F.when(F.col("_doomed").isNull(), F.col(r.column))
                out[name] = marked.select(*[(kept if c == r.column else F.col(c)).alias(c) for c in rows.columns])
            else:
                if name in key_of:  # others may hang on these rows
                    lost.append(_keys(rows.join(hit, F.col(r.column) == F.col("_doomed"), "left_semi"), key_of[name]))
                out[name] = out[name].join(hit, F.col(r.column) == F.col("_doomed"), "left_anti")
        if name in doomed:
            out[name] = out[name].join(dead[name], F.col(key_of.get(name, "id")) == F.col("_doomed"), "left_anti")
        for more in lost:
            dead[name] = dead[name].unionByName(more).distinct() if name in dead else more
    return out


#: what refers to a pool, and how a delete of pools reaches it
POOL_REFERENCES = (
    Reference("pool_profiles", "poolId", "pools"),
    Reference("pool_links", "parentPoolId", "pools"),
    Reference("pool_links", "childPoolId", "pools"),
    Reference("pool_rules", "poolId", "pools"),
    Reference("company_pool_placements", "sourcePoolId", "pools", action="clear"),
)
#: a wipe of pools by their ids' prefix also takes the families that route to them
WIPE_REFERENCES = (Reference("pool_rules", "poolId", "pools"), Reference("provider_families", "poolId", "pools"))


def wipe_prefix(tables: Mapping[str, DataFrame], prefix: str) -> dict[str, DataFrame]:
    """Delete the pools whose id begins with ``prefix`` (literally), with the rules and families that route to them."""
    return cascade(tables, WIPE_REFERENCES, {"pools": tables["pools"].where(F.col("id").startswith(prefix))})
