"""Tag ladder, protection, pool proposal, parent pool, move batch and routing mode.

All narrow: column expressions over the company feature rows plus broadcast joins with the
tiny rule / pool dimensions. No shuffle of the company rows happens in this module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.config import STICKY_MOVE_TAGS, RunConfig
from poolwright.functions import constants as K
from poolwright.operators.features import pool_by_code

def _false_if_null(c: str):
    return F.coalesce(F.col(c), F.lit(False))


# every pool code the routing steps look up; one struct holds them all, so every look-up in a
# query is the same scalar sub-query and Spark evaluates it once (sub-query reuse)
LOOKUP_CODES = ("COMPLAINT", "RETENTION", "PAST_RETENTION", "UNASSIGNED")


def pool_code(pools: DataFrame, code: str):
    """Scalar sub-query: the pool id of ``code`` (NULL when absent)."""
    aggs = [F.min(F.when(F.col("code") == c, F.col("pool_id"))).alias(c) for c in LOOKUP_CODES]
    codes = pool_by_code(pools).agg(F.struct(*aggs).alias("codes"))
    return codes.scalar().getField(code)


def with_pool_codes(df: DataFrame, pools: DataFrame, codes: tuple[str, ...]) -> DataFrame:
    """Attach ``pool_<CODE>`` columns holding the scalar pool-id look-ups."""
    for c in codes:
        df = df.withColumn(f"pool_{c}", pool_code(pools, c))
    return df


def tag(features: DataFrame, pools: DataFrame, cfg: RunConfig) -> DataFrame:
    """T1 + T2: first matching rung of the ladder, and the protected flag."""
    f = with_pool_codes(features, pools, ("COMPLAINT",))
    in_complaint_pool = F.coalesce(F.col("current_pool_id") == F.col("pool_COMPLAINT"), F.lit(False))
    complaint = _false_if_null("has_complaint_note") | _false_if_null("has_complaint_transfer") | in_complaint_pool
    callback = _false_if_null("has_open_callback")
    locked = _false_if_null("is_current_pool_locked") | _false_if_null("is_gdpr_pool")
    past = _false_if_null("has_any_past_deal") & ~_false_if_null("has_rejected_deal")
    since = F.col("last_deal_days_since")
    sites = F.col("site_count")
    code = F.coalesce(F.col("win_tag_code"), F.col("win_family"))
    no_date = F.col("raw_days_left").isNull()
    days = F.col("days_left")
    clock_days = F.col("last_deal_days_left")

    lead_tag = (
        F.when(complaint, F.lit("COMPLAINT"))
        .when(callback, F.lit("CALLBACK"))
        .when(locked, F.lit("LOCKED"))
        .when(past & since.isNotNull() & (since >= cfg.care_min) & (since <= cfg.care_max), F.lit("CUSTOMER_CARE"))
        .when(past & (F.col("last_deal_raw_days_left").isNull() | (clock_days < 1)), F.lit("PAST_RETENTION"))
        .when(past & (clock_days <= cfg.window_days), F.lit("RETENTION"))
        .when(past, F.lit("UPSELLING"))
        .when(sites > cfg.corporate_max, F.lit("UNASSIGNED"))
        .when((sites >= cfg.corporate_min) & (sites <= cfg.corporate_max)
              & (_false_if_null("is_win_dfv") | no_date | (days <= cfg.corporate_days)), F.lit("CORPORATE"))
        .when(sites >= cfg.corporate_min, F.lit("UNASSIGNED"))
        .when(_false_if_null("is_exclusively_deenergised"), F.lit("UNASSIGNED"))
        .when(code.isNull(), F.lit("UNASSIGNED"))
        .when(_false_if_null("is_win_dfv") & (code == "EON"), F.lit("EON_DFV"))
        .when(no_date | (days <= 0), F.concat(F.coalesce(code, F.lit("OTHER")), F.lit("_NOW")))
        .when(days <= F.coalesce(F.col("win_window_days"), F.lit(cfg.default_window)),
              F.concat(F.coalesce(code, F.lit("OTHER")), F.lit("_IN_WINDOW")))
        .otherwise(F.lit("PRE_WINDOW"))
    )
    protected = complaint | callback | locked
    return f.withColumn("lead_tag", lead_tag).withColumn("is_protected", protected).drop("pool_COMPLAINT")


def active_rules(rules: DataFrame) -> DataFrame:
    return rules.where(F.coalesce(F.col("isActive"), F.lit(True))).select(
        F.col("tag").alias("r_tag"), F.col("poolId").alias("rule_pool_id"))


def propose(tagged: DataFrame, rules: DataFrame, pools: DataFrame, cfg: RunConfig) -> DataFrame:
    """Proposed pool. Parked: retention tags only; live: rule pool, else UNASSIGNED."""
    r = active_rules(rules)
    j = with_pool_codes(tagged, pools, ("COMPLAINT", "UNASSIGNED")).join(
        r, F.col("lead_tag") == F.col("r_tag"), "left")
    t = F.col("lead_tag")
    rest = F.coalesce(F.col("rule_pool_id"), F.col("pool_UNASSIGNED")) if cfg.mode == "live" else (
        F.when(t.isin("RETENTION", "PAST_RETENTION"), F.col("rule_pool_id")))
    proposed = (
        F.when(t == "COMPLAINT", F.coalesce(F.col("rule_pool_id"), F.col("pool_COMPLAINT")))
        .when(t == "CALLBACK", F.coalesce(F.col("callback_owner_pool_id"), F.col("current_pool_id")))
        .when(t == "LOCKED", F.col("current_pool_id"))
        .otherwise(rest)
    )
    return j.withColumn("proposed_pool_id", proposed).drop("r_tag", "rule_pool_id", "pool_COMPLAINT", "pool_UNASSIGNED")


def with_parent(proposed: DataFrame, pools: DataFrame, cfg: RunConfig) -> DataFrame:
    """T5: CALLBACK rows take the shared pool of their clock; every other row its proposal."""
    j = with_pool_codes(proposed, pools, ("RETENTION", "PAST_RETENTION", "UNASSIGNED"))
    raw = F.col("last_deal_raw_days_left")
    clock_pool = (
        F.when((raw >= 1) & (raw <= cfg.window_days), F.col("pool_RETENTION"))
        .when(raw.isNull() | (F.col("last_deal_days_left") < 1), F.col("pool_PAST_RETENTION"))
        .otherwise(F.col("pool_UNASSIGNED"))
    )
    parent = F.when(F.col("lead_tag") == "CALLBACK", clock_pool).otherwise(F.col("proposed_pool_id"))
    return j.withColumn("parent_pool_id", parent).drop("pool_RETENTION", "pool_PAST_RETENTION", "pool_UNASSIGNED")


def move_batch(routed: DataFrame, cfg: RunConfig) -> DataFrame:
    """Rows with a proposal and a parent, an applied tag, and unprotected or sticky-move."""
    cond = F.col("proposed_pool_id").isNotNull() & F.col("parent_pool_id").isNotNull()
    if cfg.apply_tags is not None:
        cond = cond & F.col("lead_tag").isin(*cfg.apply_tags)
    cond = cond & (~_false_if_null("is_protected") | F.col("lead_tag").isin(*STICKY_MOVE_TAGS))
    return routed.where(cond).select(
        "company_id", "proposed_pool_id", F.col("parent_pool_id").alias("proposed_campaign_id"))


def activate(rules: DataFrame, families: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """Switch rules and non-manual families for the routing mode.

    parked: every rule outside the keep list off, COMPLAINT / RETENTION / PAST_RETENTION on,
    non-manual families off. live: rules outside the keep list on, non-manual families on.
    Manual families are never touched.
    """
    tag_col = F.col("tag")
    if mode == "parked":
        active = (F.when(~tag_col.isin(*K.PARK_KEEP_TAGS), F.lit(False))
                  .when(tag_col.isin(*K.PARK_ON_TAGS), F.lit(True)).otherwise(F.col("isActive")))
        fam_active = F.lit(False)
    else:
        active = F.when(~tag_col.isin(*K.PARK_KEEP_TAGS), F.lit(True)).otherwise(F.col("isActive"))
        fam_active = F.lit(True)
    new_rules = rules.withColumn("isActive", active)
    manual = F.coalesce(F.col("isManual"), F.lit(False))
    new_families = families.withColumn("isActive", F.when(manual, F.col("isActive")).otherwise(fam_active))
    return new_rules, new_families
