"""Maintenance jobs on the routing tables.

Each job is a pure function from table versions to new table versions (plus change sets),
built on the keyed primitives in ``tables``. Company-grain work joins on the company id;
whether a dimension is broadcast is left to Spark's size threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.config import RunConfig
from poolwright.functions import constants as K
from poolwright.functions.columns import (
    blank_to_null, days_until, first_match, left_join_nullable, ne_null_safe, slug,
)
from poolwright.operators.apply import run_ts
from poolwright.operators.cascade import POOL_REFERENCES, cascade
from poolwright.operators.features import pool_by_code
from poolwright.operators.ranking import distributed_rank
from poolwright.operators.tables import delete_matching, insert_missing, upsert
from poolwright.operators.tagging import pool_code
from poolwright.session import materialize


def _codes(pools: DataFrame, cfg: RunConfig) -> dict:
    """Pool ids of the three clock pools as scalar look-ups (one shared sub-query)."""
    return {c: pool_code(pools, c) for c in ("RETENTION", "PAST_RETENTION", "UNASSIGNED")}


# --- M1 / M2 --------------------------------------------------------------------------

def clear_leavers(companies: DataFrame, profiles: DataFrame, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """M1: drop the agent from companies whose profile is disabled. Returns (companies, cleared ids)."""
    gone = profiles.where(F.coalesce(F.col("disabled"), F.lit(False))).select(F.col("id").alias("_gone"))
    j = companies.join(gone, F.col("profileId") == F.col("_gone"), "left")
    hit = F.col("_gone").isNotNull()
    out = j.select(*[(F.when(hit, F.lit(None).cast("string")).otherwise(F.col(c)) if c == "profileId" else F.col(c)).alias(c)
                     for c in companies.columns])
    return out, j.where(hit).select(F.col("id").alias("company_id"))


def clear_profiles(companies: DataFrame) -> DataFrame:
    """M2: clear every agent assignment."""
    return companies.withColumn("profileId", F.lit(None).cast("string"))


# --- M3 / M4 --------------------------------------------------------------------------

def provider_routes(providers: DataFrame, cfg: RunConfig) -> DataFrame:
    """M3: classify every named provider into a bucket, tag/pool code, window and pool name.

    Blank names are dropped. Collisions of a derived code get the first characters of the provider
    id as a suffix, and the whole id where those collide too. Counts are grouped and joined back
    (no window over a possibly hot code).
    """
    base = providers.select(
        F.col("id").alias("provider_id"), blank_to_null("displayName").alias("display_name"),
        F.lower(F.coalesce(F.col("displayName"), F.lit(""))).alias("name_l"),
    ).where(F.col("display_name").isNotNull())
    bucket = first_match(F.col("name_l"), K.SYNC_BUCKET_RULES, "SUPPLIER")
    b = base.withColumn("bucket", bucket).withColumn("raw_slug", slug("display_name"))
    empty_slug = F.col("raw_slug").isNull() | (F.col("raw_slug") == "")
    id_prefix = lambda n: F.upper(F.replace(F.substring("provider_id", 1, n), F.lit("-"), F.lit("")))
    shared = F.col("bucket").isin(*K.SYNC_SHARED_BUCKETS)
    tag = (
        F.when(shared, F.col("bucket"))
        .when(F.col("bucket") == "BG_LITE", F.when(empty_slug, F.lit("BG_LITE")).otherwise(F.substring("raw_slug", 1, K.SYNC_SLUG_LEN)))
        .otherwise(F.when(empty_slug, F.concat(F.lit("P_"), id_prefix(8))).otherwise(F.substring("raw_slug", 1, K.SYNC_SLUG_LEN)))
    )
    pool_name = F.col("display_name")
    for code, name in reversed(K.SYNC_SHARED_POOL_NAMES):
        pool_name = F.when(F.col("bucket") == code, F.lit(name)).otherwise(pool_name)
    coded = b.select(
        "provider_id", "display_name", "bucket", tag.alias("tag_code"),
        F.when(F.col("bucket") == "BG", F.lit(K.SYNC_BG_WINDOW)).otherwise(F.lit(365)).alias("window_days"),
        pool_name.alias("pool_name"),
    )
    counts = coded.groupBy(F.col("tag_code").alias("_tc")).agg(F.count(F.lit(1)).alias("slug_n"))
    j = coded.join(counts, F.col("tag_code") == F.col("_tc"), "left")
    suffixed = lambda own: F.concat(F.substring("tag_code", 1, K.SYNC_COLLISION_LEN), F.lit("_"), own)
    j = j.withColumn("_short", F.when(~shared & (F.col("slug_n") > 1), suffixed(id_prefix(6))).otherwise(F.col("tag_code")))
    # ids that begin alike still collide: those codes carry the whole id
    again = j.where(~shared).groupBy(F.col("_short").alias("_again")).agg(F.count(F.lit(1)).alias("short_n"))
    j = j.join(again, F.col("_short") == F.col("_again"), "left")
    whole = F.upper(F.replace(F.col("provider_id"), F.lit("-"), F.lit("")))
    final_tag = F.when(~shared & (F.col("short_n") > 1), suffixed(whole)).otherwise(F.col("_short"))
    return j.select(
        "provider_id", "display_name", "bucket", final_tag.alias("tag_code"),
        F.when(shared, F.col("bucket")).otherwise(final_tag).alias("pool_code"),
        "window_days", "pool_name",
    )


def sync_provider_dims(routes: DataFrame, pools: DataFrame, families: DataFrame, rules: DataFrame,
                       cfg: RunConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M4: upsert per-supplier pools, replace non-manual families, upsert NOW / IN_WINDOW rules."""
    routes = materialize(routes)  # pools, families and rules are made of it
    # pools: only BG_LITE / SUPPLIER buckets get their own pool; key = code, name refreshed
    new_pools = routes.where(F.col("bucket").isin("BG_LITE", "SUPPLIER")).select(
        F.col("pool_code").alias("code"), F.col("pool_name").alias("name")).distinct()
    pools2 = upsert(
        pools, new_pools, ["code"], {"name": "overwrite"},
        defaults={"id": F.concat(F.lit("pool_"), F.col("_s_code")), "type": F.lit("STANDARD"),
                  "isLocked": F.lit(False)},
    )
    p_by_code = pools2.where(F.col("code").isNotNull()).groupBy("code").agg(F.min("id").alias("_pool"))

    # families: delete non-manual rows of routed providers, insert for providers left without one
    routed_ids = routes.select(F.col("provider_id").alias("providerId"))
    non_manual = ~F.coalesce(F.col("isManual"), F.lit(False))
    kept = families.where(~non_manual).unionByName(
        delete_matching(families.where(non_manual), routed_ids, "providerId"))
    fam_new = routes.join(p_by_code, F.col("pool_code") == F.col("code"), "inner").join(
        kept.select(F.col("providerId").alias("_has")).distinct(), F.col("provider_id") == F.col("_has"), "left_anti"
    ).select(
        F.concat(F.lit("fam_"), F.col("provider_id")).alias("id"), F.col("provider_id").alias("providerId"),
        F.col("bucket").alias("family"), F.col("tag_code").alias("tagCode"), F.col("_pool").alias("poolId"),
        F.col("window_days").cast("int").alias("windowDays"), F.col("display_name").alias("displayName"),
        F.lit(True).alias("isActive"), F.lit(False).alias("isManual"), F.col("bucket").alias("matchedPattern"),
    )
    families2 = kept.unionByName(fam_new.select(*families.columns))

    # rules: {tag}_NOW at base+2n, {tag}_IN_WINDOW at base+1+2n, n = rank of the tag code
    tags = routes.where(~F.col("tag_code").isin(*K.SYNC_EXCLUDED_TAG_CODES)).select(
        "tag_code", "pool_code", "window_days").distinct()
    numbered = distributed_rank(tags.withColumn("_all", F.lit(1)), ["_all"], ["tag_code"], "_n").drop("_all").join(p_by_code, F.col("pool_code") == F.col("code"), "inner")
    now = numbered.select(
        F.concat(F.col("tag_code"), F.lit("_NOW")).alias("tag"), F.col("_pool").alias("poolId"),
        (F.lit(K.SYNC_NOW_BASE) + 2 * F.col("_n")).cast("int").alias("priority"), F.lit(True).alias("isActive"),
        F.concat(F.col("tag_code"), F.lit(" expired / no CED")).alias("description"))
    in_window = numbered.select(
        F.concat(F.col("tag_code"), F.lit("_IN_WINDOW")).alias("tag"), F.col("_pool").alias("poolId"),
        (F.lit(K.SYNC_IN_WINDOW_BASE) + 2 * F.col("_n")).cast("int").alias("priority"), F.lit(True).alias("isActive"),
        F.concat(F.col("tag_code"), F.lit(" in window 1–"), F.col("window_days").cast("string")).alias("description"))
    policy = {"poolId": "overwrite", "priority": "overwrite", "isActive": "overwrite", "description": "overwrite"}
    rules2 = upsert(rules, now.unionByName(in_window), ["tag"], policy)
    return pools2, families2, rules2


# --- M5 / M6 / M7 ---------------------------------------------------------------------

def _clock_days(best_end: DataFrame, cfg: RunConfig) -> DataFrame:
    return best_end.select(F.col("company_id").alias("_ced_co"), days_until("end_date", cfg.run_date).alias("days_left"),
                           F.col("end_date").alias("ced_end_date"))


def past_sale_companies(deals: DataFrame, mappings: DataFrame, companies: DataFrame, cfg: RunConfig) -> DataFrame:
    """Companies with a past sale: a deal or a retention mapping; with scope ``all`` every company."""
    retention = F.lower(F.coalesce(F.col("campaign"), F.col("source"), F.lit(""))).contains(K.RETENTION_TEXT)
    s = deals.select(F.col("companyId").alias("company_id")).unionByName(
        mappings.where(retention).select(F.col("companyId").alias("company_id")))
    if cfg.past_sale_scope == "all":
        s = s.unionByName(companies.select(F.col("id").alias("company_id")))
    return s.where(F.col("company_id").isNotNull()).distinct()


def reclaim(companies: DataFrame, pools: DataFrame, best_end: DataFrame, past: DataFrame,
            cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """M5: companies in parked shared pools with a past sale go to RETENTION (1..window days)
    or PAST_RETENTION (no date / expired); far-future dates stay. Returns (companies, targets)."""
    parked = pools.where(F.col("type").cast("string").isin(*K.SHARED_TYPES)
                              & ~F.coalesce(F.col("code"), F.lit("")).isin(*K.RECLAIM_KEEP_CODES)).select(F.col("id").alias("_parked"))
    codes = _codes(pools, cfg)
    j = (companies.join(parked, F.col("poolId") == F.col("_parked"), "inner")
         .join(past, F.col("id") == F.col("company_id"), "left_semi")
         .join(_clock_days(best_end, cfg), F.col("id") == F.col("_ced_co"), "left"))
    d = F.col("days_left")
    target = F.when((d >= 1) & (d <= cfg.window_days), codes["RETENTION"]).when(d.isNull() | (d < 1), codes["PAST_RETENTION"])
    targets = j.select(F.col("id").alias("company_id"), target.alias("target_pool_id"), F.col("poolId").alias("old_pool_id")).where(
        F.col("target_pool_id").isNotNull() & ne_null_safe(F.col("old_pool_id"), F.col("target_pool_id")))
    return _move(companies, targets), targets.select("company_id", "target_pool_id")


def _move(companies: DataFrame, targets: DataFrame) -> DataFrame:
    t = targets.select(F.col("company_id").alias("_t_id"), F.col("target_pool_id").alias("_t_pool"))
    j = companies.join(t, F.col("id") == F.col("_t_id"), "left")
    return j.select(*[(F.when(F.col("_t_id").isNotNull(), F.col("_t_pool")).otherwise(F.col(c)) if c == "poolId" else F.col(c)).alias(c)
                      for c in companies.columns])


def repair_far_future(companies: DataFrame, pools: DataFrame, best_end: DataFrame,
                      cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """M6: PAST_RETENTION companies whose best end date is beyond the window go to UNASSIGNED."""
    codes = _codes(pools, cfg)
    past_pool = pool_by_code(pools).where(F.col("code") == "PAST_RETENTION").select(F.col("pool_id").alias("_pp"))
    j = companies.join(past_pool, F.col("poolId") == F.col("_pp"), "inner").join(
        _clock_days(best_end, cfg), F.col("id") == F.col("_ced_co"), "inner").where(F.col("days_left") > cfg.window_days)
    misfiled = j.select(F.col("id").alias("company_id"), "name", F.col("ced_end_date").alias("end_date"), "days_left",
                        codes["UNASSIGNED"].alias("target_pool_id"))
    return _move(companies, misfiled), misfiled


def retire_pools(companies: DataFrame, placements: DataFrame, pools: DataFrame, rules: DataFrame,
                 families: DataFrame, links: DataFrame, pool_profiles: DataFrame, best_end: DataFrame,
                 cfg: RunConfig) -> dict[str, DataFrame]:
    """M7: drop every shared pool outside the keep list, moving its companies by clock first."""
    drop = pools.where(F.col("type").cast("string").isin(*K.SHARED_TYPES)
                       & ~F.coalesce(F.col("code"), F.lit("")).isin(*K.RESET_KEEP_CODES)).select(F.col("id").alias("_drop"))
    codes = _codes(pools, cfg)
    j = companies.join(drop, F.col("poolId") == F.col("_drop"), "inner").join(
        _clock_days(best_end, cfg), F.col("id") == F.col("_ced_co"), "left")
    d = F.col("days_left")
    target = (F.when((d >= 1) & (d <= cfg.window_days), codes["RETENTION"])
              .when(d.isNull() | (d < 1), codes["PAST_RETENTION"]).otherwise(codes["UNASSIGNED"]))
    # without the target pool there is nowhere to move to
    targets = j.select(F.col("id").alias("company_id"), target.alias("target_pool_id")).where(F.col("target_pool_id").isNotNull())
    closing = placements.join(drop, F.col("poolId") == F.col("_drop"), "left")
    ended = F.when(F.col("_drop").isNotNull() & F.col("endedAt").isNull(), run_ts(cfg)).otherwise(F.col("endedAt"))
    left = cascade(
        {"pools": pools, "pool_profiles": pool_profiles, "pool_links": links, "pool_rules": rules,
         "company_pool_placements": closing.select(*[(ended if c == "endedAt" else F.col(c)).alias(c) for c in placements.columns])},
        POOL_REFERENCES, {"pools": drop.select(F.col("_drop").alias("id"))})
    return {
        "companies": _move(companies, targets),
        "targets": targets,
        "placements": left["company_pool_placements"],
        "pool_profiles": left["pool_profiles"],
        "links": left["pool_links"],
        "families": families.where(F.coalesce(F.col("isManual"), F.lit(False))),
        "rules": left["pool_rules"].where(F.col("tag").isin(*K.RESET_KEEP_TAGS)),
        "pools": left["pools"],
    }


# --- M8 .. M12, M14: links and visibility ---------------------------------------------

def deactivate_links(links: DataFrame) -> DataFrame:
    """M8: switch every parent -> private link off (soft delete)."""
    private = F.col("childType").cast("string") == "PRIVATE"
    return links.withColumn("isActive", F.when(private, F.lit(False)).otherwise(F.col("isActive")))


def _owner_rows(profiles: DataFrame, pools: DataFrame, cfg: RunConfig) -> DataFrame:
    """(poolId, profileId) for each profile and its own PRIVATE pool."""
    priv = pools.where(F.col("type") == "PRIVATE").select(F.col("id").alias("_priv"))
    return profiles.join(priv, F.col("primaryPoolId") == F.col("_priv"), "inner").select(
        F.col("primaryPoolId").alias("poolId"), F.col("id").alias("profileId"))


def _is_manager(role_col: str = "role"):
    return F.upper(F.coalesce(F.col(role_col).cast("string"), F.lit(""))).isin(*K.MANAGER_ROLES)


def with_role(profiles: DataFrame, roles: DataFrame | None = None) -> DataFrame:
    """Profiles with ``role`` from what their source has: a role name, the name behind ``roleId`` in
    ``roles`` (id, name), or ``isManager``; to be asked of the source's own columns, before conforming."""
    have = {c.lower(): c for c in profiles.columns}
    if "role" in have:
        return profiles
    if "roleid" in have and roles is not None:
        named = roles.select(F.col("id").alias("_role_id"), F.upper("name").alias("role"))
        return left_join_nullable(profiles, named, have["roleid"], "_role_id").drop("_role_id")
    if "ismanager" in have:
        manager = F.coalesce(F.col(have["ismanager"]).cast("boolean"), F.lit(False))
        return profiles.withColumn("role", F.when(manager, F.lit(K.MANAGER_ROLES[0])).otherwise(F.lit("AGENT")))
    return profiles.withColumn("role", F.lit(None).cast("string"))


def hide_pools(pool_profiles: DataFrame, pools: DataFrame, profiles: DataFrame, cfg: RunConfig) -> DataFrame:
    """M9: owners keep their private pool; non-visible shared pools are unlinked; COMPLAINT
    stays linked for managers / admins only."""
    pp = insert_missing(pool_profiles, _owner_rows(profiles, pools, cfg), ["poolId", "profileId"])
    hidden = pools.where(F.col("type").cast("string").isin(*K.SHARED_TYPES)
                         & ~F.coalesce(F.col("code"), F.lit("")).isin(*K.PARKED_VISIBLE_CODES)).select("id")
    pp = delete_matching(pp, hidden, {"poolId": "id"})
    complaint = pools.where(F.col("code") == "COMPLAINT").select("id")
    non_managers = profiles.where(~_is_manager()).select("id")
    doomed = pp.join(complaint, F.col("poolId") == F.col("id"), "left_semi").join(
        non_managers, F.col("profileId") == F.col("id"), "left_semi")
    return delete_matching(pp, doomed, {"poolId": "poolId", "profileId": "profileId"})


def relink_pools(pool_profiles: DataFrame, pools: DataFrame, profiles: DataFrame, cfg: RunConfig) -> DataFrame:
    """Every agent (private link or private primary pool) sees every shared pool except
    COMPLAINT; managers / admins see COMPLAINT."""
    priv = pools.where(F.col("type") == "PRIVATE").select(F.col("id").alias("_priv"))
    agents = pool_profiles.join(priv, F.col("poolId") == F.col("_priv"), "left_semi").select(
        F.col("profileId").alias("agent")).unionByName(
        _owner_rows(profiles, pools, cfg).select(F.col("profileId").alias("agent"))).distinct()
    is_shared = F.col("type").cast("string").isin(*K.SHARED_TYPES) & (F.coalesce(F.col("code"), F.lit("")) != "COMPLAINT")
    shared = pools.where(is_shared).select(F.col("id").alias("poolId"), F.col("type").cast("string").alias("_type"))
    # each agent wants the shared pool types; equi-join on type against the pool dimension
    wants = agents.select("agent", F.explode(F.array(*[F.lit(t) for t in K.SHARED_TYPES])).alias("_type"))
    agent_rows = wants.join(shared, "_type").select("poolId", F.col("agent").alias("profileId"))
    complaint = pools.where(F.col("code") == "COMPLAINT").select(F.col("id").alias("poolId"), F.lit("COMPLAINT").alias("_c"))
    manager_rows = profiles.where(_is_manager()).select(F.col("id").alias("profileId"), F.lit("COMPLAINT").alias("_c")).join(
        complaint, "_c").select("poolId", "profileId")
    return insert_missing(pool_profiles, agent_rows.unionByName(manager_rows), ["poolId", "profileId"])


def fix_private_owner(pool_profiles: DataFrame, pools: DataFrame, profiles: DataFrame, cfg: RunConfig) -> DataFrame:
    """A private pool is linked to its owner only."""
    priv = pools.where(F.col("type") == "PRIVATE").select(F.col("id").alias("_priv"))
    owners = _owner_rows(profiles, pools, cfg)
    on_private = pool_profiles.join(priv, F.col("poolId") == F.col("_priv"), "left_semi")
    wrong = on_private.join(owners, ["poolId", "profileId"], "left_anti")
    pp = delete_matching(pool_profiles, wrong, {"poolId": "poolId", "profileId": "profileId"})
    return insert_missing(pp, owners, ["poolId", "profileId"])


def link_agents(pool_profiles: DataFrame, profiles: DataFrame, pools: DataFrame, cfg: RunConfig,
                emails: tuple[str, ...] | None = None, role: str | None = None,
                codes: tuple[str, ...] = K.LINK_POOLS_CODES) -> DataFrame:
    """Link enabled agents to the named shared pools.

    Selection: by e-mail list, else by exact role name, else every non-manager.
    """
    sel = profiles.where(~F.coalesce(F.col("disabled"), F.lit(False)))
    if emails:
        sel = sel.where(F.lower(F.col("email")).isin(*[e.lower() for e in emails]))
    elif role:
        sel = sel.where(F.upper(F.coalesce(F.col("role"), F.lit(""))) == role.upper())
    else:
        sel = sel.where(~_is_manager())
    targets = pools.where(F.col("code").isin(*codes)).select(F.col("id").alias("poolId"), F.col("code").alias("_code"))
    rows = sel.select(F.col("id").alias("profileId"), F.explode(F.array(*[F.lit(c) for c in codes])).alias("_code")).join(
        targets, "_code").select("poolId", "profileId")
    return insert_missing(pool_profiles, rows, ["poolId", "profileId"])


def refresh_fallback(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """C17 over a stored table (company_id, site_id, source, has_past_sale, last_deal_end_date): new companies are
    added; of a stored row the site and source stay, has_past_sale is never taken back, and the end date is
    replaced by a known one."""
    names = ["site_id", "source", "has_past_sale", "last_deal_end_date"]
    new = fresh.select("company_id", *[F.col(c).alias(f"_{c}") for c in names])
    j = stored.join(new, "company_id", "full_outer")
    return j.select(
        "company_id", F.coalesce("site_id", "_site_id").alias("site_id"), F.coalesce("source", "_source").alias("source"),
        (F.coalesce("has_past_sale", F.lit(False)) | F.coalesce("_has_past_sale", F.lit(False))).alias("has_past_sale"),
        F.coalesce("_last_deal_end_date", "last_deal_end_date").alias("last_deal_end_date"))


def fill_end_dates(stored: DataFrame, best_end: DataFrame) -> DataFrame:
    """Fill the end date of stored fallback rows that have none, from the companies' best end dates."""
    best = best_end.select("company_id", F.col("end_date").alias("_end"))
    filled = F.coalesce("last_deal_end_date", "_end").alias("last_deal_end_date")
    return stored.join(best, "company_id", "left").select(*[filled if c == "last_deal_end_date" else F.col(c) for c in stored.columns])


def backfill_members(members: DataFrame, profiles: DataFrame, policies: DataFrame, roster: DataFrame,
                     policy_ids: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Members without a profile take the profile owning their child pool; active members
    of the named policies are added to the parent pool roster."""
    owners = profiles.where(F.col("primaryPoolId").isNotNull()).groupBy(F.col("primaryPoolId").alias("_child")).agg(
        F.min("id").alias("_owner"))
    j = members.join(owners, F.col("childPoolId") == F.col("_child"), "left")
    fill = F.col("profileId").isNull() & F.col("_owner").isNotNull()
    members2 = j.select(*[(F.when(fill, F.col("_owner")).otherwise(F.col(c)) if c == "profileId" else F.col(c)).alias(c)
                          for c in members.columns])
    rows = members2.where((F.col("isActive") == True) & F.col("profileId").isNotNull()  # noqa: E712
                          & F.col("policyId").isin(*policy_ids)).join(
        policies.select(F.col("id").alias("policyId"), F.col("parentPoolId").alias("poolId")), "policyId"
    ).select("poolId", "profileId")
    return members2, insert_missing(roster, rows, ["poolId", "profileId"])


def member_check(members: DataFrame, policy_ids: tuple[str, ...]) -> DataFrame:
    """Check of M13, per policy that has members: all, active, with a profile, and active without one (no one to share to)."""
    active, named = F.coalesce(F.col("isActive"), F.lit(False)), F.col("profileId").isNotNull()
    return members.where(F.col("policyId").isin(*policy_ids)).groupBy("policyId").agg(
        F.count(F.lit(1)).alias("members"), F.count_if(active).alias("active"), F.count_if(named).alias("with_profile"),
        F.count_if(active & ~named).alias("missing_profile"))


def promote_campaign(pools: DataFrame, rules: DataFrame, links: DataFrame, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Shared pools that carry an active rule become CAMPAIGN; STANDARD link parents too."""
    ruled = rules.where(F.coalesce(F.col("isActive"), F.lit(True))).select(F.col("poolId").alias("_ruled")).distinct()
    j = pools.join(ruled, F.col("id") == F.col("_ruled"), "left")
    promote = F.col("_ruled").isNotNull() & (F.col("type").cast("string") != "PRIVATE")
    pools2 = j.select(*[(F.when(promote, F.lit("CAMPAIGN")).otherwise(F.col(c)) if c == "type" else F.col(c)).alias(c)
                        for c in pools.columns])
    links2 = links.withColumn("parentType", F.when(F.col("parentType").cast("string") == "STANDARD", F.lit("CAMPAIGN"))
                              .otherwise(F.col("parentType")))
    return pools2, links2


def route_code_collisions(routes: DataFrame) -> DataFrame:
    """Q25 check: supplier tag codes that still collide after the id suffix (expected empty)."""
    own = routes.where(~F.col("bucket").isin(*K.SYNC_SHARED_BUCKETS))
    return own.groupBy("tag_code").agg(F.count(F.lit(1)).alias("providers")).where(F.col("providers") > 1)
