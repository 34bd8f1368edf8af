"""Apply a move batch (AP1-AP8): companies, placement history, audits, campaign refresh.

All outputs are computed from the same input versions, which is the snapshot rule the
database gets from one statement with several data-modifying parts. Generated ids are
``sha2(run_id : kind : company)`` so a retried run writes the same rows.
Scale: the batch and the company/placement tables are joined on the company id (one shuffle per
side); whether pools and links are broadcast is left to Spark's size threshold, and a company
with many history rows to adaptive skew splitting.
A batch may name a company more than once. Each named pool is validated; of a company's valid
moves the one with the smallest pool id, then campaign, counts (``one_move``), so the outputs
of AP2-AP5 never repeat a company.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.config import RunConfig
from poolwright.functions import constants as K
from poolwright.functions.columns import ne_null_safe
from poolwright.operators.tables import update_where_distinct


def run_ts(cfg: RunConfig):
    """The run timestamp as a time-zone free literal."""
    return F.lit(cfg.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def gen_id(cfg: RunConfig, kind: str, company_col: str = "company_id"):
    return F.sha2(F.concat_ws(":", F.lit(cfg.run_id), F.lit(kind), F.col(company_col)), 256)


def check_actor(cfg: RunConfig) -> None:
    """AP7: refuse to run without an actor identity."""
    if not cfg.actor or not str(cfg.actor).strip():
        raise ValueError("apply needs an actor id (RunConfig.actor)")


def _campaign(pool_type):
    """Default campaign: the batch value, else the pool itself when the pool is shared."""
    shared = pool_type.cast("string").isin(*K.SHARED_TYPES)
    return F.coalesce(F.nullif(F.col("proposed_campaign_id"), F.lit("")), F.when(shared, F.col("proposed_pool_id")))


def validate_batch(batch: DataFrame, companies: DataFrame, pools: DataFrame, links: DataFrame,
                   cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """AP1: known company and pool; shared pool, or private pool with an active private link.

    Returns (valid moves with old pool and campaign, rejected batch rows with a reason).
    """
    p = pools.select(F.col("id").alias("p_id"), F.col("type").alias("p_type"))
    live = (F.col("isActive") == True) & (F.col("childType").cast("string") == "PRIVATE")  # noqa: E712
    linked = links.where(live).select(F.col("childPoolId").alias("l_child")).distinct()
    c = companies.select(F.col("id").alias("c_id"), F.col("poolId").alias("old_pool_id"))
    j = (
        batch.where(F.col("proposed_pool_id").isNotNull())
        .join(c, F.col("company_id") == F.col("c_id"), "left")
        .join(p, F.col("proposed_pool_id") == F.col("p_id"), "left")
        .join(linked, F.col("proposed_pool_id") == F.col("l_child"), "left")
    )
    shared = F.col("p_type").cast("string").isin(*K.SHARED_TYPES)
    private_ok = (F.col("p_type").cast("string") == "PRIVATE") & F.col("l_child").isNotNull()
    reason = (
        F.when(F.col("c_id").isNull(), F.lit("unknown company"))
        .when(F.col("p_id").isNull(), F.lit("unknown pool"))
        .when(~(shared | private_ok), F.lit("private pool without active link"))
    )
    j = j.withColumn("_reason", reason)
    valid = j.where(F.col("_reason").isNull()).select(
        "company_id", "proposed_pool_id", _campaign(F.col("p_type")).alias("proposed_campaign_id"), "old_pool_id")
    rejected = j.where(F.col("_reason").isNotNull()).select(
        "company_id", "proposed_pool_id", "proposed_campaign_id", F.col("_reason").alias("reason"))
    return valid, rejected


def one_move(valid: DataFrame) -> DataFrame:
    """The move that counts of each company: smallest pool id, then campaign (null first)."""
    rest = [c for c in valid.columns if c not in ("company_id", "proposed_pool_id", "proposed_campaign_id")]
    pick = F.min(F.struct("proposed_pool_id", "proposed_campaign_id", *rest)).alias("m")
    return valid.groupBy("company_id").agg(pick).select(*[F.col("company_id") if c == "company_id" else F.col(f"m.{c}") for c in valid.columns])


def effective_moves(valid: DataFrame) -> DataFrame:
    """AP2: one move a company, and only where its pool actually changes."""
    return one_move(valid).where(ne_null_safe(F.col("old_pool_id"), F.col("proposed_pool_id")))


def apply_moves(companies: DataFrame, moves: DataFrame) -> DataFrame:
    """AP3: companies with the new pool for moved ids."""
    m = moves.select(F.col("company_id").alias("_m_id"), F.col("proposed_pool_id").alias("_m_pool"))
    j = companies.join(m, F.col("id") == F.col("_m_id"), "left")
    return j.select(*[
        (F.when(F.col("_m_id").isNotNull(), F.col("_m_pool")).otherwise(F.col("poolId")) if c == "poolId" else F.col(c)).alias(c)
        for c in companies.columns
    ])


def roll_placements(placements: DataFrame, moves: DataFrame, cfg: RunConfig) -> DataFrame:
    """AP4: close the open placement of every moved company and open the new one."""
    m = moves.select(F.col("company_id").alias("_m_id"))
    j = placements.join(m, F.col("companyId") == F.col("_m_id"), "left")
    closing = F.col("_m_id").isNotNull() & F.col("endedAt").isNull()
    closed = j.select(*[
        (F.when(closing, run_ts(cfg)).otherwise(F.col("endedAt")) if c == "endedAt" else F.col(c)).alias(c)
        for c in placements.columns
    ])
    opened = moves.select(
        gen_id(cfg, "placement").alias("id"), F.col("company_id").alias("companyId"),
        F.col("proposed_pool_id").alias("poolId"), F.col("proposed_campaign_id").alias("sourcePoolId"),
        F.lit(cfg.actor).alias("actorId"), run_ts(cfg).alias("distributedAt"),
        F.lit(None).cast("timestamp_ntz").alias("endedAt"),
    )
    return closed.unionByName(opened.select(*placements.columns))


def split_history(placements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(open rows, closed rows) of a placement history, to be stored apart."""
    is_open = F.col("endedAt").isNull()
    return placements.where(is_open), placements.where(~is_open)


def roll_open(open_rows: DataFrame, moves: DataFrame, refresh_src: DataFrame, pools: DataFrame,
              cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """AP4 + AP6 over the open placements alone: (the new open rows, the rows that close).

    Closed rows never change, so with the two kept apart a night reads a row per placed company and appends
    one per move, however long the history is. Together with the older closed rows the result is that of ``roll_and_refresh``.
    """
    rolled = roll_and_refresh(open_rows, moves, refresh_src, pools, cfg)
    return split_history(rolled)


def audit(audits: DataFrame, moves: DataFrame, cfg: RunConfig) -> DataFrame:
    """AP5: one AUTO_ASSIGN audit row per moved company, appended."""
    return audits.unionByName(audit_rows(moves, cfg).select(*audits.columns))


def audit_rows(moves: DataFrame, cfg: RunConfig) -> DataFrame:
    """The audit rows of one run's moves."""
    return moves.select(
        gen_id(cfg, "audit").alias("id"), F.col("company_id").alias("companyId"),
        F.col("proposed_pool_id").alias("poolId"), F.lit(K.AUDIT_ACTION).alias("action"),
        F.lit(cfg.actor).alias("actorId"), F.lit(None).cast("string").alias("reason"),
        run_ts(cfg).alias("createdAt"),
    )


def batch_campaigns(batch: DataFrame, pools: DataFrame, cfg: RunConfig) -> DataFrame:
    """(companyId, campaign): the batch's campaign per company (lowest when a company repeats)."""
    p = pools.select(F.col("id").alias("p_id"), F.col("type").alias("p_type"))
    return batch.join(p, F.col("proposed_pool_id") == F.col("p_id"), "inner").select(
        F.col("company_id").alias("companyId"), _campaign(F.col("p_type")).alias("campaign")
    ).where(F.col("campaign").isNotNull()).groupBy("companyId").agg(F.min("campaign").alias("campaign"))


def roll_and_refresh(placements: DataFrame, moves: DataFrame, refresh_src: DataFrame, pools: DataFrame,
                     cfg: RunConfig) -> DataFrame:
    """AP4 + AP6 in one pass over the placement history (one shuffle of the largest table).

    Same result as ``refresh_campaign(roll_placements(...))``: moved companies' open rows
    close; other open rows take the batch campaign when it differs; the new open row carries
    the batch campaign when there is one, else the move's campaign.
    """
    x = batch_campaigns(refresh_src, pools, cfg)
    m = moves.select(F.col("company_id").alias("companyId"), F.col("proposed_pool_id").alias("_m_pool"),
                     F.col("proposed_campaign_id").alias("_m_campaign"), F.lit(True).alias("_moved"))
    info = m.join(x, "companyId", "full_outer").withColumnRenamed("companyId", "_i_company")
    j = placements.join(info, F.col("companyId") == F.col("_i_company"), "left")
    is_open = F.col("endedAt").isNull()
    moved = F.coalesce(F.col("_moved"), F.lit(False))
    refresh = ~moved & is_open & F.col("campaign").isNotNull() & ne_null_safe(F.col("sourcePoolId"), F.col("campaign"))
    updated = j.select(*[
        (F.when(moved & is_open, run_ts(cfg)).otherwise(F.col("endedAt")) if c == "endedAt"
         else F.when(refresh, F.col("campaign")).otherwise(F.col("sourcePoolId")) if c == "sourcePoolId"
         else F.col(c)).alias(c) for c in placements.columns])
    opened = info.where(F.col("_moved")).select(
        gen_id(cfg, "placement", "_i_company").alias("id"), F.col("_i_company").alias("companyId"),
        F.col("_m_pool").alias("poolId"),
        F.coalesce(F.col("campaign"), F.col("_m_campaign")).alias("sourcePoolId"), F.lit(cfg.actor).alias("actorId"),
        run_ts(cfg).alias("distributedAt"), F.lit(None).cast("timestamp_ntz").alias("endedAt"),
    )
    return updated.unionByName(opened.select(*placements.columns))


def refresh_campaign(placements: DataFrame, batch: DataFrame, pools: DataFrame, cfg: RunConfig) -> DataFrame:
    """AP6: set the campaign on open placements where it differs from the batch's campaign.

    ``batch`` is the raw batch (reference behaviour) or the validated moves
    (``refresh_validated_only``); it is reduced to one campaign per company first.
    """
    x = batch_campaigns(batch, pools, cfg)
    new, _ = update_where_distinct(
        placements, x, "companyId", {"sourcePoolId": "campaign"}, where=F.col("endedAt").isNull())
    return new


@dataclass
class ApplyResult:
    companies: DataFrame
    placements: DataFrame
    audits: DataFrame
    moves: DataFrame
    rejected: DataFrame


def apply_batch(batch: DataFrame, companies: DataFrame, placements: DataFrame, audits: DataFrame,
                pools: DataFrame, links: DataFrame, cfg: RunConfig) -> ApplyResult:
    """AP1-AP7 as one job. ``moves`` has one row per moved company (its count = companies moved)."""
    check_actor(cfg)
    valid, rejected = validate_batch(batch, companies, pools, links, cfg)
    moves = effective_moves(valid)
    new_companies = apply_moves(companies, moves)
    refresh_src = valid if cfg.refresh_validated_only else batch
    refreshed = roll_and_refresh(placements, moves, refresh_src, pools, cfg)
    return ApplyResult(new_companies, refreshed, audit(audits, moves, cfg), moves, rejected)


def apply_profiles(companies: DataFrame, profile_batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """AP8: set the agent on companies where it differs; returns (companies, changed ids)."""
    pb = profile_batch.groupBy("company_id").agg(F.min("proposed_profile_id").alias("proposed_profile_id"))
    pb = pb.withColumnRenamed("company_id", "id")
    return update_where_distinct(companies, pb, "id", {"profileId": "proposed_profile_id"})
