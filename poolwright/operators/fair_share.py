"""FS: fair share of companies over the private child pools of their proposed parent.

Semantics: an unprotected company already sitting in a child of its proposed parent stays
there ("kept"). The other unprotected companies of a parent that has children are taken in
company-id order and each joins the least-loaded child at that moment (load = kept count
plus companies already handed out; ties by child id). Protected companies, and parents
without children, keep the proposal. Duplicate links are collapsed first.

Scale plan (no row per slot, no array, no task that holds a parent's children or companies):
  1. a histogram per parent: how many children have each load. It has few rows, as n different loads take about
     n * n / 2 kept companies (under 45,000 rows for a billion). Running sums over it give the bands: from one load up to the next, all
     children with at most that load fill level by level, in child order, so a band is an interval of candidate
     ranks that goes round its children, and the last band takes whoever is left;
  2. candidates are ranked by company id with the distributed rank, and find their band by merging the ranks
     with the bands' first ranks (``interval_lookup``);
  3. within a band, the children are numbered in child order, again by the distributed rank; a child has a row for each band from
     its own load's on, never more rows in all than candidates and children. The candidate's place in its band,
     modulo the band's children, is the number of its child: an equi-join on (parent, band, number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poolwright.config import RunConfig
from poolwright.functions import constants as K
from poolwright.operators.ranking import distributed_rank, interval_lookup
from poolwright.session import materialize


def private_links(links: DataFrame) -> DataFrame:
    """Active shared-parent -> private-child links, one row per pair."""
    return links.where(
        F.coalesce(F.col("isActive"), F.lit(True))
        & F.col("parentType").cast("string").isin(*K.SHARED_TYPES)
        & (F.col("childType").cast("string") == "PRIVATE")
    ).select(F.col("parentPoolId").alias("fs_parent"), F.col("childPoolId").alias("fs_child")).distinct()


def bands(loads: DataFrame, need: DataFrame) -> DataFrame:
    """(fs_parent, have_n, band, first, kids): the bands that each parent's candidates fill.

    ``loads``: fs_parent, fs_child, have_n; ``need``: fs_parent, need_n (candidates, at least one). A band begins with the
    candidate of rank ``first``, at the level over ``have_n``, and ``kids`` children take part in it.
    """
    hist = loads.groupBy("fs_parent", "have_n").agg(F.count(F.lit(1)).alias("c"))
    lower = Window.partitionBy("fs_parent").orderBy("have_n").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("c").over(lower), F.lit(0))
    held = F.coalesce(F.sum(F.col("c") * F.col("have_n")).over(lower), F.lit(0))
    # raising all children below to this load takes what they lack
    filled = hist.select("fs_parent", "have_n", (below + F.col("c")).alias("kids"), (below * F.col("have_n") - held + 1).alias("first"),
                         F.row_number().over(Window.partitionBy("fs_parent").orderBy("have_n")).alias("band"))
    return filled.join(need, "fs_parent").where(F.col("first") <= F.col("need_n")).drop("need_n")


def numbered_children(loads: DataFrame, filled: DataFrame) -> DataFrame:
    """(fs_parent, band, number, fs_child): the children of each band, numbered from 0 in child order."""
    last = filled.groupBy("fs_parent").agg(F.max("band").alias("last"))
    own = loads.join(filled.select("fs_parent", "have_n", "band"), ["fs_parent", "have_n"]).join(last, "fs_parent")
    every = own.select("fs_parent", "fs_child", F.explode(F.sequence("band", "last")).alias("band"))
    ranked = distributed_rank(every, ["fs_parent", "band"], ["fs_child"], "number")
    return ranked.select("fs_parent", "band", (F.col("number") - 1).alias("number"), F.col("fs_child").alias("assigned_child"))


def fair_share(routed: DataFrame, links: DataFrame, cfg: RunConfig) -> DataFrame:
    """FS: routed rows with ``proposed_pool_id`` replaced by the private child where it applies.

    ``parent_pool_id`` keeps the T5 value (the callback parent is not lost).
    """
    lk = private_links(links)
    parents = lk.select(F.col("fs_parent").alias("_has_kids")).distinct()
    unprotected = ~F.coalesce(F.col("is_protected"), F.lit(False))

    flagged = (
        routed.join(lk.select(F.col("fs_parent").alias("_kp"), F.col("fs_child").alias("kept_child")),
                    (F.col("proposed_pool_id") == F.col("_kp")) & (F.col("current_pool_id") == F.col("kept_child")) & unprotected,
                    "left")
        .drop("_kp")
        .join(parents, F.col("proposed_pool_id") == F.col("_has_kids"), "left")
    )
    is_cand = unprotected & F.col("_has_kids").isNotNull() & F.col("kept_child").isNull()
    # feeds the loads, the candidates and the pass-through rows: cut here, once
    flagged = materialize(flagged.withColumn("_cand", is_cand))

    kept = flagged.where(F.col("kept_child").isNotNull()).groupBy(
        F.col("proposed_pool_id").alias("fs_parent"), F.col("kept_child").alias("fs_child")
    ).agg(F.count(F.lit(1)).alias("have_n"))
    loads = lk.join(kept, ["fs_parent", "fs_child"], "left").select(
        "fs_parent", "fs_child", F.coalesce(F.col("have_n"), F.lit(0)).alias("have_n"))
    cands = flagged.where(F.col("_cand")).select(F.col("proposed_pool_id").alias("fs_parent"), "company_id")
    need = cands.groupBy("fs_parent").agg(F.count(F.lit(1)).alias("need_n"))

    filled = materialize(bands(loads, need))
    asked = distributed_rank(cands, ["fs_parent"], ["company_id"], "first")
    placed = interval_lookup(asked.withColumn("rank", F.col("first")), filled.withColumn("start", F.col("first")), ["fs_parent"], "first", ["band", "start", "kids"])
    placed = placed.select("company_id", "fs_parent", "band", F.pmod(F.col("rank") - F.col("start"), F.col("kids")).alias("number"))
    dealt = placed.join(numbered_children(loads, filled), ["fs_parent", "band", "number"]).select("company_id", "assigned_child")
    out = flagged.join(dealt, "company_id", "left")
    final = F.when(~unprotected, F.col("proposed_pool_id")).otherwise(
        F.coalesce(F.col("kept_child"), F.col("assigned_child"), F.col("proposed_pool_id")))
    return out.withColumn("proposed_pool_id", final).select(*routed.columns)
