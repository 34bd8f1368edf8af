"""Registered queries: one per operator of the inventory, each with its DuckDB twin.

``QUERIES[name] = (spark_fn(spark, sf_dir) -> DataFrame, sql_fn() -> str | None)``.
Every query reads the driver's tables through ``Fixtures`` (so its work grows with the
scale factor) and aliases every computed column to the twin's name.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from poolwright import twins
from poolwright.config import FIXTURE_CONFIG, RunConfig
from poolwright.functions import constants as K
from poolwright.functions.columns import clock_label, days_until, is_dfv
from poolwright.operators import apply as AP
from poolwright.operators import fair_share as FS
from poolwright.operators import features as C
from poolwright.operators import tagging as T
from poolwright.operators.cascade import wipe_prefix
from poolwright.plans import nightly, stages
from poolwright.session import ensure_checkpoint_dir, materialize
from poolwright.sources import conform_checked, snapshot
from poolwright.sources.fixtures import Fixtures, LinkedFixtures
from poolwright.sources.store import TableStore

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], Callable[[], str | None]]] = {}

PARKED = FIXTURE_CONFIG
PARKED_STRICT = FIXTURE_CONFIG.with_(past_sale_scope="mappings")
LIVE = FIXTURE_CONFIG.with_(mode="live", past_sale_scope="mappings")


def register(name: str, cfg: RunConfig, sql: str | None, linked: bool = False):
    """``linked``: over ``LinkedFixtures``, where most facts reach a company."""
    fixtures = LinkedFixtures if linked else Fixtures

    def deco(fn):
        QUERIES[name] = (
            lambda spark, sf_dir, _fn=fn, _cfg=cfg: _fn(fixtures(spark, sf_dir, _cfg), _cfg),
            (lambda _cfg=cfg, _sql=sql: twins.with_ctes(_cfg, _sql, linked)) if sql is not None else (lambda: None),
        )
        return fn
    return deco


def _resolved(fx: Fixtures) -> DataFrame:
    return C.resolve_contract_companies(fx.contracts, fx.company_sites, fx.site_meters)


# --- features -------------------------------------------------------------------

@register("c01_contract_companies", PARKED, "SELECT DISTINCT contract_id, company_id FROM resolved")
def c01(fx, cfg):
    return _resolved(fx).select("contract_id", "company_id").distinct()


@register("c02_best_end_date", PARKED, "SELECT company_id, site_id, end_date, bag FROM ced")
def c02(fx, cfg):
    return C.best_end_date(_resolved(fx), cfg)


@register("c03_company_clock", PARKED, f"""
SELECT company_id, end_date, CAST(end_date - DATE '{PARKED.run_date}' AS INTEGER) AS days_left,
  CASE WHEN end_date - DATE '{PARKED.run_date}' BETWEEN 1 AND {PARKED.window_days} THEN 'RETENTION'
       WHEN end_date - DATE '{PARKED.run_date}' < 1 THEN 'PAST_RETENTION' ELSE 'UPSELLING' END AS clock_bag
FROM clock""")
def c03(fx, cfg):
    clock = C.company_clock(_resolved(fx), cfg)
    d = days_until("end_date", cfg.run_date)
    return clock.select("company_id", "end_date", d.alias("days_left"), clock_label(d, cfg.window_days).alias("clock_bag"))


@register("c04_contract_facts", PARKED, "SELECT * FROM facts")
def c04(fx, cfg):
    return C.contract_facts(_resolved(fx), fx.providers, fx.provider_families, cfg)


@register("c05_winning_contract", PARKED, "SELECT * FROM winner")
def c05(fx, cfg):
    facts = C.contract_facts(_resolved(fx), fx.providers, fx.provider_families, cfg)
    return C.winning_contract(facts)


@register("c06_dfv_by_type", PARKED, f"""
SELECT ctype AS contract_type,
  CASE WHEN lower(trim(coalesce(ctype, ''))) IN ({twins.in_list(('1', '2', '4', 'deemed', 'flexible', 'variable', 'd', 'f', 'v', 'dfv', 'fvd'))})
    OR lower(ctype) LIKE '%deemed%' OR lower(ctype) LIKE '%flexible%' OR lower(ctype) LIKE '%variable%' THEN TRUE ELSE FALSE END AS is_dfv,
  count(*) AS contracts
FROM contracts GROUP BY ALL""")
def c06(fx, cfg):
    return fx.contracts.groupBy(F.col("type").alias("contract_type"), is_dfv("type").alias("is_dfv")).agg(
        F.count(F.lit(1)).alias("contracts"))


@register("c07_supplier_class", PARKED, f"""
SELECT p.id AS provider_id, p.display_name,
  {twins.case_rules('lower(p.display_name)', C.K.NIGHTLY_SUPPLIER_RULES, "'OTHER'")} AS tag_code,
  CAST({twins.case_rules('lower(p.display_name)', C.K.NIGHTLY_WINDOW_RULES, '365')} AS INTEGER) AS window_days,
  {twins.case_rules('lower(p.display_name)', C.K.NIGHTLY_FAMILY_RULES, "'OTHER'")} AS family
FROM providers p""")
def c07(fx, cfg):
    tag, window, family = C.classify_supplier(F.col("displayName"))
    return fx.providers.select(F.col("id").alias("provider_id"), F.col("displayName").alias("display_name"),
                               tag.alias("tag_code"), window.alias("window_days"), family.alias("family"))


@register("c08_last_deal", PARKED, "SELECT * FROM last_deal")
def c08(fx, cfg):
    return C.last_deal(fx.deals, fx.company_sites, fx.site_meters, fx.contracts, cfg)


@register("c08_last_deal_row_path", PARKED.with_(deal_path="row"), "SELECT * FROM last_deal")
def c08_row(fx, cfg):
    return C.last_deal(fx.deals, fx.company_sites, fx.site_meters, fx.contracts, cfg)


for _path in ("site", "company"):
    register(f"c08_last_deal_{_path}_path", PARKED.with_(deal_path=_path), "SELECT * FROM last_deal")(c08)


@register("c09_deal_companies", PARKED, "SELECT company_id FROM deal_cos")
def c09(fx, cfg):
    return C.deal_companies(fx.deals, fx.company_sites, fx.site_meters, cfg)


@register("c09_deal_companies_row_path", PARKED.with_(deal_path="row"), "SELECT company_id FROM deal_cos")
def c09_row(fx, cfg):
    return C.deal_companies(fx.deals, fx.company_sites, fx.site_meters, cfg)


@register("c10_rejected_companies", PARKED, "SELECT company_id FROM rejected")
def c10(fx, cfg):
    return C.rejected_companies(fx.deals, fx.compliance_review_entries)


@register("c11_all_meters_dead", PARKED, "SELECT company_id FROM dead")
def c11(fx, cfg):
    return C.all_meters_dead(fx.site_meters, fx.company_sites)


@register("c12_site_count", PARKED, "SELECT company_id, site_count FROM site_counts")
def c12(fx, cfg):
    return C.site_count(fx.company_sites)


@register("c13_open_callbacks", PARKED, "SELECT * FROM open_cb")
def c13(fx, cfg):
    return C.open_callbacks(fx.callbacks, fx.company_sites, fx.profiles, cfg)


@register("c14_complaint_notes", PARKED, "SELECT company_id FROM complaint_note_cos")
def c14(fx, cfg):
    return C.complaint_notes(fx.notes)


@register("c15_complaint_transfers", PARKED, "SELECT company_id FROM complaint_xfer_cos")
def c15(fx, cfg):
    return C.complaint_transfers(fx.company_pool_audits, fx.pools)


@register("c16_load_origin", PARKED, "SELECT * FROM origin")
def c16(fx, cfg):
    return C.load_origin(fx.external_site_mappings, fx.company_sites, fx.crm_load_source, cfg)


def _past_sale(fx, cfg):
    resolved = _resolved(fx)
    return C.past_sale(fx.external_site_mappings, C.best_end_date(resolved, cfg), fx.companies, cfg)


for _scope in ("all", "contracts", "mappings"):
    register(f"c17_past_sale_{_scope}", FIXTURE_CONFIG.with_(past_sale_scope=_scope), "SELECT * FROM sale")(_past_sale)


@register("c18_pool_by_code", LIVE, "SELECT code, min(id) AS pool_id FROM m4_pools WHERE trim(code) <> '' GROUP BY code")
def c18(fx, cfg):
    return C.pool_by_code(_sync(fx, cfg)[0])  # the pools that the sync derives from the suppliers


@register("c19_pool_flags", PARKED, "SELECT * FROM flags")
def c19(fx, cfg):
    return C.pool_flags(fx.companies, fx.pools, cfg)


def _features(fx, cfg):
    return C.build_features(fx, cfg)


register("c20_features_all", PARKED, "SELECT * FROM features")(_features)
register("c20_features_mappings", PARKED_STRICT, "SELECT * FROM features")(_features)


@register("c20_features_staged", PARKED, "SELECT * FROM features")
def c20_staged(fx, cfg):
    """C20 over stage tables in buckets of the company id."""
    name = f"poolwright_{uuid4().hex}"
    return stages.staged_features(fx.spark, fx, cfg, name, f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/{name}", 16)


# --- tagging ----------------------------------------------------------------------

def _routed(fx: Fixtures, cfg: RunConfig) -> DataFrame:
    feats = C.build_features(fx, cfg)
    tagged = T.tag(feats, fx.pools, cfg)
    proposed = T.propose(tagged, fx.pool_rules(cfg.mode), fx.pools, cfg)
    return T.with_parent(proposed, fx.pools, cfg)


def _tags(fx, cfg):
    return T.tag(C.build_features(fx, cfg), fx.pools, cfg).select("company_id", "lead_tag", "is_protected")


register("t01_tag_all", PARKED, "SELECT company_id, lead_tag, is_protected FROM tagged")(_tags)
register("t01_tag_mappings", PARKED_STRICT, "SELECT company_id, lead_tag, is_protected FROM tagged")(_tags)


def _proposals(fx, cfg):
    return _routed(fx, cfg).select("company_id", "lead_tag", "proposed_pool_id", "parent_pool_id")


_PROPOSAL_SQL = "SELECT company_id, lead_tag, proposed_pool_id, parent_pool_id FROM routed"
register("t03_propose_parked", PARKED, _PROPOSAL_SQL)(_proposals)
register("t03_propose_parked_strict", PARKED_STRICT, _PROPOSAL_SQL)(_proposals)
register("t04_propose_live", LIVE, _PROPOSAL_SQL)(_proposals)


def _batch(fx, cfg):
    return T.move_batch(_routed(fx, cfg), cfg)


register("t06_batch_parked", PARKED, "SELECT * FROM batch")(_batch)
register("t06_batch_live", LIVE, "SELECT * FROM batch")(_batch)


# --- fair share ------------------------------------------------------------------

def _shared(fx, cfg):
    return FS.fair_share(_routed(fx, cfg).select(*ROUTE_COLUMNS), fx.pool_links, cfg)


@register("fs_fair_share", PARKED, "SELECT company_id, lead_tag, is_protected, parent_pool_id, proposed_pool_id FROM fair")
def fs(fx, cfg):
    return _shared(fx, cfg).select("company_id", "lead_tag", "is_protected", "parent_pool_id", "proposed_pool_id")


@register("fs_fair_share_strict", PARKED_STRICT, "SELECT company_id, lead_tag, is_protected, parent_pool_id, proposed_pool_id FROM fair")
def fs_strict(fx, cfg):
    return _shared(fx, cfg).select("company_id", "lead_tag", "is_protected", "parent_pool_id", "proposed_pool_id")


# --- apply --------------------------------------------------------------------------

APPLY = PARKED.with_(fair_share=True)


#: what fair share, the move batch and the reports on them read of the routed table
ROUTE_COLUMNS = ("company_id", "current_pool_id", "lead_tag", "is_protected", "parent_pool_id", "proposed_pool_id")


def _batch_for_apply(fx, cfg):
    routed = _routed(fx, cfg).select(*ROUTE_COLUMNS)
    if cfg.fair_share:
        routed = FS.fair_share(routed, fx.pool_links, cfg)
    # the final routed table feeds validation, moves and the campaign refresh: materialise once
    routed = materialize(routed)
    return routed, T.move_batch(routed, cfg)


def _apply(fx, cfg):
    _, batch = _batch_for_apply(fx, cfg)
    return AP.apply_batch(batch, fx.companies, fx.company_pool_placements, fx.company_pool_audits,
                          fx.pools, fx.pool_links, cfg)


PLACEMENT_COLS = [("id", "id"), ("companyId", "company_id"), ("poolId", "pool_id"), ("sourcePoolId", "source_pool_id"),
                  ("actorId", "actor_id"), ("distributedAt", "distributed_at"), ("endedAt", "ended_at")]
AUDIT_COLS = [("id", "id"), ("companyId", "company_id"), ("poolId", "pool_id"), ("action", "action"),
              ("actorId", "actor_id"), ("reason", "reason"), ("createdAt", "created_at")]


def _renamed(df, cols):
    return df.select(*[F.col(a).alias(b) for a, b in cols])


def _faulty_batch(fx, cfg):
    """The batch of the day with what a hand-made one brings: companies named twice, unknown companies and
    pools, and private pools without an active link, all derived from the customers."""
    _, batch = _batch_for_apply(fx, cfg)
    k = F.col("c_custkey")
    odd = fx.raw("customer").select(
        F.when(k % 11 == 3, F.concat(F.lit("Z"), k.cast("string"))).otherwise(F.concat(F.lit("C"), k.cast("string"))).alias("company_id"),
        F.when(k % 11 == 1, F.lit("pool_PAST_RETENTION")).when(k % 11 == 2, F.lit("pool_RETENTION")).when(k % 11 == 4, F.lit("pool_NONE"))
        .when(k % 11 == 5, F.lit("priv_13")).when(k % 11 == 6, F.lit("priv_2")).otherwise(F.lit("pool_UNASSIGNED")).alias("proposed_pool_id"),
        F.when(k % 2 == 0, F.lit("pool_RETENTION")).alias("proposed_campaign_id")).where(k % 11 < 7)
    return batch.unionByName(odd)


def _faulty(fx, cfg):
    return AP.apply_batch(_faulty_batch(fx, cfg), fx.companies, fx.company_pool_placements, fx.company_pool_audits,
                          fx.pools, fx.pool_links, cfg)


for _name, _table, _pick in (
        ("ap1_rejected_faulty", "ap_rejected", lambda r: r.rejected), ("ap2_moves_faulty", "ap_moves", lambda r: r.moves),
        ("ap3_companies_faulty", "ap_companies", lambda r: _renamed(r.companies, [("id", "company_id"), ("name", "name"), ("poolId", "pool_id"), ("profileId", "profile_id")])),
        ("ap5_audits_faulty", "ap_audits", lambda r: _renamed(r.audits, AUDIT_COLS)), ("ap6_placements_faulty", "ap_placements", lambda r: _renamed(r.placements, PLACEMENT_COLS))):
    register(_name, APPLY.with_(faulty_batch=True), f"SELECT * FROM {_table}")(lambda fx, cfg, _pick=_pick: _pick(_faulty(fx, cfg)))


@register("ap1_valid_batch", APPLY, "SELECT * FROM ap_valid")
def ap1(fx, cfg):
    _, batch = _batch_for_apply(fx, cfg)
    return AP.validate_batch(batch, fx.companies, fx.pools, fx.pool_links, cfg)[0]


@register("ap1_rejected_moves", APPLY, "SELECT * FROM ap_rejected")
def ap1_rejected(fx, cfg):
    _, batch = _batch_for_apply(fx, cfg)
    return AP.validate_batch(batch, fx.companies, fx.pools, fx.pool_links, cfg)[1]


@register("ap2_effective_moves", APPLY, "SELECT * FROM ap_moves")
def ap2(fx, cfg):
    return _apply(fx, cfg).moves


@register("ap3_companies", APPLY, "SELECT company_id, name, pool_id, profile_id FROM ap_companies")
def ap3(fx, cfg):
    return _renamed(_apply(fx, cfg).companies, [("id", "company_id"), ("name", "name"), ("poolId", "pool_id"),
                                                ("profileId", "profile_id")])


@register("ap4_placements", APPLY, "SELECT * FROM ap_rolled")
def ap4(fx, cfg):
    _, batch = _batch_for_apply(fx, cfg)
    valid, _ = AP.validate_batch(batch, fx.companies, fx.pools, fx.pool_links, cfg)
    return _renamed(AP.roll_placements(fx.company_pool_placements, AP.effective_moves(valid), cfg), PLACEMENT_COLS)


@register("ap5_audits", APPLY, "SELECT * FROM ap_audits")
def ap5(fx, cfg):
    return _renamed(_apply(fx, cfg).audits, AUDIT_COLS)


@register("ap6_placements_refreshed", APPLY, "SELECT * FROM ap_placements")
def ap6(fx, cfg):
    return _renamed(_apply(fx, cfg).placements, PLACEMENT_COLS)


@register("ap6_placements_refreshed_validated", APPLY.with_(refresh_validated_only=True), "SELECT * FROM ap_placements")
def ap6v(fx, cfg):
    return _renamed(_apply(fx, cfg).placements, PLACEMENT_COLS)


@register("ap8_profile_apply", APPLY, "SELECT * FROM ap_profiles")
def ap8(fx, cfg):
    routed, _ = _batch_for_apply(fx, cfg)
    owners = fx.profiles.where(F.col("primaryPoolId").isNotNull()).select(
        F.col("id").alias("owner_id"), F.col("primaryPoolId").alias("owner_pool"))
    pb = routed.join(owners, F.col("proposed_pool_id") == F.col("owner_pool")).groupBy("company_id").agg(
        F.min("owner_id").alias("proposed_profile_id"))
    new, _ = AP.apply_profiles(fx.companies, pb)
    return new.select(F.col("id").alias("company_id"), F.col("profileId").alias("profile_id"))


# --- maintenance ----------------------------------------------------------------------

from poolwright.operators import maintenance as M  # noqa: E402

COMPANY_COLS = [("id", "company_id"), ("name", "name"), ("poolId", "pool_id"), ("profileId", "profile_id")]
POOL_COLS = [("id", "id"), ("code", "code"), ("name", "name"), ("type", "type"), ("isLocked", "is_locked")]
RULE_COLS = [("tag", "tag"), ("poolId", "pool_id"), ("priority", "priority"), ("isActive", "is_active"),
             ("description", "description")]
FAMILY_COLS = [("id", "id"), ("providerId", "provider_id"), ("family", "family"), ("tagCode", "tag_code"),
               ("poolId", "pool_id"), ("windowDays", "window_days"), ("displayName", "display_name"),
               ("isActive", "is_active"), ("isManual", "is_manual"), ("matchedPattern", "matched_pattern")]
PP_COLS = [("poolId", "pool_id"), ("profileId", "profile_id")]
LINK_COLS = [("parentPoolId", "parent_pool_id"), ("childPoolId", "child_pool_id"), ("parentType", "parent_type"),
             ("childType", "child_type"), ("isActive", "is_active")]
_SQL_COMPANIES = "SELECT company_id, name, pool_id, profile_id FROM {}"
_SQL_POOLS = "SELECT id, code, name, type, locked AS is_locked FROM {}"
_SQL_RULES = "SELECT tag, pool_id, priority, active AS is_active, description FROM {}"
_SQL_PP = "SELECT pool_id, profile_id FROM {}"


def _best_end(fx, cfg):
    return C.best_end_date(_resolved(fx), cfg)


@register("m01_janitor", PARKED, _SQL_COMPANIES.format("m1_companies"))
def m01(fx, cfg):
    return _renamed(M.clear_leavers(fx.companies, fx.profiles, cfg)[0], COMPANY_COLS)


@register("m02_clear_profiles", PARKED, "SELECT id AS company_id, name, pool_id, CAST(NULL AS VARCHAR) AS profile_id FROM companies")
def m02(fx, cfg):
    return _renamed(M.clear_profiles(fx.companies), COMPANY_COLS)


@register("m03_provider_routes", LIVE, "SELECT * FROM m3_routes")
def m03(fx, cfg):
    return M.provider_routes(fx.providers, cfg)


def _sync(fx, cfg):
    return M.sync_provider_dims(M.provider_routes(fx.providers, cfg), fx.pools, fx.provider_families,
                                fx.pool_rules(cfg.mode), cfg)


@register("m04_pools", LIVE, _SQL_POOLS.format("m4_pools"))
def m04p(fx, cfg):
    return _renamed(_sync(fx, cfg)[0], POOL_COLS)


@register("m04_families", LIVE, "SELECT id, provider_id, family, tag_code, pool_id, window_days, display_name, "
          "active AS is_active, manual AS is_manual, matched_pattern FROM m4_families")
def m04f(fx, cfg):
    return _renamed(_sync(fx, cfg)[1], FAMILY_COLS)


@register("m04_rules", LIVE, _SQL_RULES.format("m4_rules"))
def m04r(fx, cfg):
    return _renamed(_sync(fx, cfg)[2], RULE_COLS)


def _reclaim(fx, cfg):
    past = M.past_sale_companies(fx.deals, fx.external_site_mappings, fx.companies, cfg)
    return M.reclaim(fx.companies, fx.pools, _best_end(fx, cfg), past, cfg)[1]


register("m05_reclaim", PARKED, "SELECT * FROM m5_targets")(_reclaim)
register("m05_reclaim_strict", PARKED_STRICT, "SELECT * FROM m5_targets")(_reclaim)


@register("m06_far_future", PARKED, "SELECT * FROM m6_misfiled")
def m06(fx, cfg):
    return M.repair_far_future(fx.companies, fx.pools, _best_end(fx, cfg), cfg)[1]


def _retire(fx, cfg):
    return M.retire_pools(fx.companies, fx.company_pool_placements, fx.pools, fx.pool_rules(cfg.mode),
                          fx.provider_families, fx.pool_links, fx.pool_profiles, _best_end(fx, cfg), cfg)


@register("m07_companies", LIVE, _SQL_COMPANIES.format("m7_companies"))
def m07c(fx, cfg):
    return _renamed(_retire(fx, cfg)["companies"], COMPANY_COLS)


@register("m07_placements", LIVE, "SELECT * FROM m7_placements")
def m07p(fx, cfg):
    return _renamed(_retire(fx, cfg)["placements"], PLACEMENT_COLS)


def _retire_synced(fx, cfg):
    """M7 over the pools, rules and families that the sync derives from the suppliers."""
    pools, families, rules = _sync(fx, cfg)
    return M.retire_pools(fx.companies, fx.company_pool_placements, pools, rules, families, fx.pool_links, fx.pool_profiles, _best_end(fx, cfg), cfg)


@register("m07_rules", LIVE, _SQL_RULES.format("m7s_rules"))
def m07r(fx, cfg):
    return _renamed(_retire_synced(fx, cfg)["rules"], RULE_COLS)


@register("m07_pools", LIVE, _SQL_POOLS.format("m4_pools p WHERE p.id NOT IN (SELECT id FROM m7s_drop)"))
def m07pools(fx, cfg):
    return _renamed(_retire_synced(fx, cfg)["pools"], POOL_COLS)


@register("m07_families", LIVE, "SELECT id, provider_id, family, tag_code, pool_id, window_days, display_name, "
          "active AS is_active, manual AS is_manual, matched_pattern FROM m4_families WHERE manual = TRUE")
def m07f(fx, cfg):
    return _renamed(_retire_synced(fx, cfg)["families"], FAMILY_COLS)


@register("m07_links", LIVE, "SELECT parent_id AS parent_pool_id, child_id AS child_pool_id, parent_type, child_type, active AS is_active "
          "FROM links WHERE parent_id NOT IN (SELECT id FROM m7_drop) AND child_id NOT IN (SELECT id FROM m7_drop)")
def m07l(fx, cfg):
    return _renamed(_retire(fx, cfg)["links"], LINK_COLS)


@register("m07_pool_profiles", LIVE, _SQL_PP.format("m7_pool_profiles"))
def m07pp(fx, cfg):
    return _renamed(_retire(fx, cfg)["pool_profiles"], PP_COLS)


@register("m08_links_off", PARKED, "SELECT parent_id AS parent_pool_id, child_id AS child_pool_id, parent_type, child_type, "
          "CASE WHEN child_type = 'PRIVATE' THEN FALSE ELSE active END AS is_active FROM links")
def m08(fx, cfg):
    return _renamed(M.deactivate_links(fx.pool_links), LINK_COLS)


@register("m09_hide_pools", PARKED, _SQL_PP.format("m9_pool_profiles"))
def m09(fx, cfg):
    return _renamed(M.hide_pools(fx.pool_profiles, fx.pools, fx.profiles, cfg), PP_COLS)


@register("m10_relink_pools", PARKED, _SQL_PP.format("m10_pool_profiles"))
def m10(fx, cfg):
    return _renamed(M.relink_pools(fx.pool_profiles, fx.pools, fx.profiles, cfg), PP_COLS)


@register("m11_fix_private_owner", PARKED, _SQL_PP.format("m11_pool_profiles"))
def m11(fx, cfg):
    return _renamed(M.fix_private_owner(fx.pool_profiles, fx.pools, fx.profiles, cfg), PP_COLS)


@register("m12_link_agents", PARKED, _SQL_PP.format("m12_pool_profiles"))
def m12(fx, cfg):
    return _renamed(M.link_agents(fx.pool_profiles, fx.profiles, fx.pools, cfg), PP_COLS)


@register("m12_link_agents_by_role", PARKED, f"""
SELECT pool_id, profile_id FROM pool_profiles UNION
SELECT p.id, pr.id FROM profiles pr, pools p WHERE p.code IN ({twins.in_list(C.K.LINK_POOLS_CODES)}) AND pr.disabled IS NOT TRUE AND pr.role = 'MANAGER'""")
def m12r(fx, cfg):
    return _renamed(M.link_agents(fx.pool_profiles, fx.profiles, fx.pools, cfg, role="manager"), PP_COLS)


@register("m12_link_agents_by_email", PARKED, f"""
SELECT pool_id, profile_id FROM pool_profiles UNION
SELECT p.id, pr.id FROM profiles pr, pools p WHERE p.code IN ({twins.in_list(C.K.LINK_POOLS_CODES)}) AND pr.disabled IS NOT TRUE
  AND pr.email IN ('agent3@example.com', 'agent7@example.com')""")
def m12e(fx, cfg):
    return _renamed(M.link_agents(fx.pool_profiles, fx.profiles, fx.pools, cfg, emails=("Agent3@example.com", "agent7@example.com")), PP_COLS)


def _role_source(fx, kind: str):
    """The profiles as sources with another kind of role column have them."""
    manager = F.upper("role").isin(*C.K.MANAGER_ROLES)
    base = fx.profiles.drop("role")
    if kind == "is_manager":
        return M.with_role(fx.profiles.withColumn("isManager", manager).drop("role"))
    roles = fx.profiles.select(F.concat(F.lit("role_"), F.lower("role")).alias("id"), F.lower("role").alias("name")).distinct()
    given = fx.profiles.withColumn("roleId", F.concat(F.lit("role_"), F.lower("role"))).select(*base.columns, "roleId")
    return M.with_role(given, roles)


for _kind in ("is_manager", "role_id"):
    register(f"m09_hide_pools_{_kind}", PARKED, _SQL_PP.format("m9_pool_profiles"))(
        lambda fx, cfg, _kind=_kind: _renamed(M.hide_pools(fx.pool_profiles, fx.pools, _role_source(fx, _kind), cfg), PP_COLS))
    register(f"m12_link_agents_{_kind}", PARKED, _SQL_PP.format("m12_pool_profiles"))(
        lambda fx, cfg, _kind=_kind: _renamed(M.link_agents(fx.pool_profiles, _role_source(fx, _kind), fx.pools, cfg), PP_COLS))


def _stored_fallback(fx, cfg):
    """A stored fallback table of an earlier run: two customers in three, some without an end date."""
    k = F.col("c_custkey")
    return fx.raw("customer").where(k % 3 != 0).select(
        F.concat(F.lit("C"), k.cast("string")).alias("company_id"), F.concat(F.lit("old"), k.cast("string")).alias("site_id"),
        F.lit("import").alias("source"), (k % 2 == 0).alias("has_past_sale"), F.when(k % 4 == 0, F.lit("1998-01-31").cast("date")).alias("last_deal_end_date"))


_STORED = """(SELECT 'C' || c_custkey::VARCHAR AS company_id, 'old' || c_custkey::VARCHAR AS site_id, 'import' AS source,
  c_custkey % 2 = 0 AS has_past_sale, CASE WHEN c_custkey % 4 = 0 THEN DATE '1998-01-31' END AS last_deal_end_date FROM customer WHERE c_custkey % 3 <> 0)"""


@register("c17_fallback_refresh", PARKED_STRICT, f"""
SELECT company_id, site_id, source, has_past_sale, last_deal_end_date FROM sale WHERE company_id NOT IN (SELECT company_id FROM {_STORED} t)
UNION ALL
SELECT t.company_id, t.site_id, t.source, t.has_past_sale OR s.company_id IS NOT NULL, coalesce(s.last_deal_end_date, t.last_deal_end_date)
FROM {_STORED} t LEFT JOIN sale s ON s.company_id = t.company_id""")
def c17r(fx, cfg):
    return M.refresh_fallback(_stored_fallback(fx, cfg), _past_sale(fx, cfg))


@register("c17_fallback_fill", PARKED_STRICT, f"""
SELECT t.company_id, t.site_id, t.source, t.has_past_sale,
  coalesce(t.last_deal_end_date, (SELECT c.end_date FROM ced c WHERE c.company_id = t.company_id)) AS last_deal_end_date
FROM {_STORED} t""")
def c17f(fx, cfg):
    return M.fill_end_dates(_stored_fallback(fx, cfg), _best_end(fx, cfg))


@register("s10_delete_prefix", PARKED, "SELECT id, company_id, pool_id FROM placements WHERE NOT starts_with(id, 'PLX-C1')")
def s10(fx, cfg):
    from poolwright.operators.tables import delete_prefix

    kept = delete_prefix(fx.company_pool_placements, "id", "PLX-C1")
    return kept.select("id", F.col("companyId").alias("company_id"), F.col("poolId").alias("pool_id"))


# --- versioned tables, partial merges, rejects, cascades ------------------------------------

def _store(fx) -> TableStore:
    """A store of its own for each call, on the cluster's shared folder."""
    return TableStore(fx.spark, f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/store-{uuid4()}")


@register("s01_snapshot_counts", PARKED, "SELECT 'deals' AS \"table\", count(*) AS rows FROM deals UNION ALL SELECT 'notes', count(*) FROM notes UNION ALL SELECT 'profiles', count(*) FROM profiles")
def s01(fx, cfg):
    out = f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/snapshot-{uuid4()}"
    return snapshot(fx.spark, {n: getattr(fx, n) for n in ("deals", "notes", "profiles")}, out)


_EVENT_ENTITY = T_.StructType([T_.StructField("id", T_.LongType()), T_.StructField("amount", T_.IntegerType()), T_.StructField("userId", T_.StringType())])


def _checked_events(fx):
    """Events as a careless export would give them: ids with a letter, amounts in words, missing ids."""
    k = F.col("event_id")
    raw = fx.raw("events").select(
        F.when(k % 17 == 3, F.concat(F.lit("E"), k.cast("string"))).when(k % 23 != 5, k.cast("string")).alias("ID"),
        F.when(k % 13 == 1, F.lit("a dozen")).when(k % 5 != 0, (k % 1000).cast("string")).alias("Amount"), F.col("user_id").cast("string").alias("USERID"))
    return conform_checked(raw, _EVENT_ENTITY, required=["id"])


_SQL_EVENTS = """(SELECT CASE WHEN event_id % 17 = 3 THEN 'E' || event_id::VARCHAR WHEN event_id % 23 <> 5 THEN event_id::VARCHAR END AS i,
  CASE WHEN event_id % 13 = 1 THEN 'a dozen' WHEN event_id % 5 <> 0 THEN (event_id % 1000)::VARCHAR END AS a, user_id::VARCHAR AS u FROM events)"""


@register("s04_conformed_events", PARKED, f"""
SELECT i::BIGINT AS id, a::INTEGER AS amount, u AS user_id FROM {_SQL_EVENTS} x WHERE regexp_full_match(i, '[0-9]+') AND (a IS NULL OR regexp_full_match(a, '[0-9]+'))""")
def s04(fx, cfg):
    return _renamed(_checked_events(fx)[0], [("id", "id"), ("amount", "amount"), ("userId", "user_id")])


@register("s04_rejected_events", PARKED, f"""
SELECT CASE WHEN i IS NULL OR starts_with(i, 'E') THEN 'id' ELSE 'amount' END AS field, CASE WHEN i IS NULL OR starts_with(i, 'E') THEN i ELSE a END AS value, count(*) AS rows
FROM {_SQL_EVENTS} x WHERE i IS NULL OR starts_with(i, 'E') OR a = 'a dozen' GROUP BY ALL""")
def s04_rejected(fx, cfg):
    return _checked_events(fx)[1].groupBy("field", "value").agg(F.count(F.lit(1)).alias("rows"))


@register("s05_night_placements", APPLY, "SELECT * FROM ap_placements")
def s05(fx, cfg):
    """A whole night on a store, found done by its retry; the history is put together from its open and closed parts."""
    store, tables = _store(fx), nightly.from_fixtures(fx)
    for _ in range(2):
        nightly.run_night(store, tables, cfg)
    return _renamed(store.read("placements_open").unionByName(store.read("placements_closed")), PLACEMENT_COLS)


@register("s06_companies_rewritten", PARKED, _SQL_COMPANIES.format("m1_companies"))
def s06(fx, cfg):
    """M1 as a job that overwrites the table that it reads."""
    store = _store(fx)
    store.run("load", lambda tx: tx.put("companies", fx.companies))
    store.run("janitor", lambda tx: tx.put("companies", M.clear_leavers(tx.read("companies"), fx.profiles, cfg)[0]))
    return _renamed(store.read("companies"), COMPANY_COLS)


@register("s07_merged_companies", PARKED, _SQL_COMPANIES.format("m1_companies"))
def s07(fx, cfg):
    """M1 as a merge of the changed rows alone into a table in buckets."""
    store = _store(fx)
    store.run("load", lambda tx: tx.put_keyed("companies", fx.companies, ["id"], buckets=16))

    def janitor(tx):
        cleared = M.clear_leavers(tx.read("companies"), fx.profiles, cfg)[1]
        tx.merge("companies", cleared.select(F.col("company_id").alias("id"), F.lit(None).cast("string").alias("profileId")), {"profileId": "overwrite"})

    store.run("janitor", janitor)
    return _renamed(store.read("companies"), COMPANY_COLS)


@register("ap4_open_rows", APPLY, "SELECT * FROM ap_placements WHERE ended_at IS NULL OR ended_at = TIMESTAMP '2000-01-01 02:30:00'")
def ap4_open(fx, cfg):
    """The open rows after a night and those that it closed, from the open rows before."""
    _, batch = _batch_for_apply(fx, cfg)
    valid, _ = AP.validate_batch(batch, fx.companies, fx.pools, fx.pool_links, cfg)
    is_open, _ = AP.split_history(fx.company_pool_placements)
    still, closing = AP.roll_open(is_open, AP.effective_moves(valid), batch, fx.pools, cfg)
    return _renamed(still.unionByName(closing), PLACEMENT_COLS)


_WIPED = "(starts_with(pool_id, 'pool_S') AND pool_id IN (SELECT id FROM m4_pools))"


@register("s10_wipe_cascade", LIVE, f"""
SELECT 'pools' AS tbl, id FROM m4_pools WHERE NOT starts_with(id, 'pool_S')
UNION ALL SELECT 'pool_rules', tag FROM m4_rules WHERE pool_id IS NULL OR NOT {_WIPED}
UNION ALL SELECT 'provider_families', id FROM m4_families WHERE pool_id IS NULL OR NOT {_WIPED}""")
def s10_wipe(fx, cfg):
    """Pools by prefix, with the rules and families that route to them."""
    pools, families, rules = _sync(fx, cfg)
    left = wipe_prefix({"pools": pools, "pool_rules": rules, "provider_families": families}, "pool_S")
    ids = [left[t].select(F.lit(t).alias("tbl"), F.col(c).alias("id")) for t, c in (("pools", "id"), ("pool_rules", "tag"), ("provider_families", "id"))]
    return ids[0].unionByName(ids[1]).unionByName(ids[2])


@register("m14_promote_links", LIVE, "SELECT parent_id AS parent_pool_id, child_id AS child_pool_id, "
          "CASE WHEN parent_type = 'STANDARD' THEN 'CAMPAIGN' ELSE parent_type END AS parent_type, child_type, active AS is_active FROM links")
def m14l(fx, cfg):
    return _renamed(M.promote_campaign(fx.pools, fx.pool_rules(cfg.mode), fx.pool_links, cfg)[1], LINK_COLS)


@register("m14_promote_campaign", LIVE, """
SELECT id, code, name, CASE WHEN type <> 'PRIVATE' AND id IN (SELECT pool_id FROM m4_rules WHERE active IS NOT FALSE) THEN 'CAMPAIGN' ELSE type END AS type,
  locked AS is_locked FROM m4_pools""")
def m14(fx, cfg):
    pools, _, rules = _sync(fx, cfg)  # the pools and rules that the sync derives from the suppliers
    return _renamed(M.promote_campaign(pools, rules, fx.pool_links, cfg)[0], POOL_COLS)


# --- reports --------------------------------------------------------------------------

from poolwright.plans import reports as R  # noqa: E402

_RD = f"DATE '{PARKED.run_date}'"
_W = PARKED.window_days
_CED_ROWS = """(SELECT company_id, end_date, path FROM resolved WHERE end_date IS NOT NULL
  UNION ALL SELECT company_id, last_deal_end_date, 'fallback' FROM sale WHERE last_deal_end_date IS NOT NULL)"""
_ACTIVE_RULE_POOLS = "(SELECT DISTINCT pool_id FROM rules WHERE coalesce(active, TRUE))"


def _ced_rows(fx, cfg):
    resolved = _resolved(fx)
    sale = C.past_sale(fx.external_site_mappings, C.best_end_date(resolved, cfg), fx.companies, cfg)
    return R.ced_rows(resolved, sale)


@register("r01_load_origin_counts", PARKED, "SELECT source_kind, count(*) AS companies FROM features GROUP BY source_kind")
def r01(fx, cfg):
    return R.load_origin_counts(C.build_features(fx, cfg))


@register("r01_mapping_campaigns", PARKED, "SELECT coalesce(campaign, source) AS campaign, count(*) AS mappings FROM mappings GROUP BY 1")
def r01m(fx, cfg):
    return R.mapping_campaigns(fx.external_site_mappings)


@register("r02_ced_rows_by_path", PARKED, f"SELECT path, count(*) AS rows FROM {_CED_ROWS} x GROUP BY path")
def r02a(fx, cfg):
    return R.ced_rows_by_path(_ced_rows(fx, cfg))


@register("r02_both_bags", PARKED, f"""
SELECT 'companies_with_window_and_past' AS metric, count_if(has_ret = 1 AND has_past = 1) AS value FROM (
  SELECT company_id, max(CASE WHEN end_date - {_RD} BETWEEN 1 AND {_W} THEN 1 ELSE 0 END) AS has_ret,
    max(CASE WHEN end_date - {_RD} < 1 THEN 1 ELSE 0 END) AS has_past
  FROM {_CED_ROWS} x GROUP BY company_id) y""")
def r02b(fx, cfg):
    return R.both_bags(_ced_rows(fx, cfg), cfg)


@register("r02_clock_bags", PARKED, f"""
SELECT CASE WHEN end_date - {_RD} BETWEEN 1 AND {_W} THEN 'RETENTION' WHEN end_date - {_RD} < 1 THEN 'PAST_RETENTION'
            ELSE 'UPSELLING' END AS bag, count(*) AS companies
FROM (SELECT company_id, coalesce(max(CASE WHEN end_date - {_RD} BETWEEN 1 AND {_W} THEN end_date END),
                                  max(CASE WHEN end_date - {_RD} < 1 THEN end_date END), max(end_date)) AS end_date
      FROM {_CED_ROWS} x GROUP BY company_id) c
GROUP BY 1""")
def r02c(fx, cfg):
    return R.clock_bags(_ced_rows(fx, cfg), cfg)


@register("r03_feature_totals", PARKED, """
SELECT count(*) AS companies, count_if(coalesce(has_open_callback, FALSE)) AS open_callbacks,
  count_if(coalesce(has_complaint_note, FALSE)) AS complaint_notes,
  count_if(coalesce(has_complaint_transfer, FALSE)) AS complaint_transfers,
  count_if(coalesce(has_any_past_deal, FALSE)) AS with_past_deal, count_if(coalesce(is_win_dfv, FALSE)) AS win_dfv,
  count_if(coalesce(has_rejected_deal, FALSE)) AS rejected_deals,
  count_if(coalesce(is_exclusively_deenergised, FALSE)) AS all_meters_dead,
  count_if(coalesce(is_current_pool_locked, FALSE) OR coalesce(is_gdpr_pool, FALSE)) AS locked_or_gdpr
FROM features""")
def r03(fx, cfg):
    return R.feature_totals(C.build_features(fx, cfg))


@register("r04_by_tag", PARKED, "SELECT lead_tag, is_win_dfv, is_protected, count(*) AS companies FROM tagged GROUP BY ALL")
def r04a(fx, cfg):
    return R.by_tag(T.tag(C.build_features(fx, cfg), fx.pools, cfg))


@register("r04_by_tag_pool", LIVE, "SELECT lead_tag, proposed_pool_id, win_family, is_win_dfv, count(*) AS companies FROM routed GROUP BY ALL")
def r04b(fx, cfg):
    return R.by_tag_pool(_routed(fx, cfg))


@register("r04_by_parent", APPLY, "SELECT parent_pool_id, proposed_pool_id, is_protected, count(*) AS companies FROM fair GROUP BY ALL")
def r04c(fx, cfg):
    return R.by_parent(_batch_for_apply(fx, cfg)[0])


@register("r05_companies_per_pool", APPLY, """
SELECT code, name, sum(held)::BIGINT AS companies
FROM (SELECT *, (SELECT count(*) FROM ap_companies WHERE pool_id = pools.id) AS held FROM pools) x
WHERE held > 0 GROUP BY code, name""")
def r05a(fx, cfg):
    return R.companies_per_pool(_apply(fx, cfg).companies, fx.pools)


@register("r05_stuck_in_parked", APPLY, f"""
SELECT 'companies_in_parked_pools' AS metric, count_if(pool_id IN (
  SELECT id FROM pools WHERE type <> 'PRIVATE' AND coalesce(code, '') NOT IN ({twins.in_list(C.K.PARK_KEEP_TAGS)}))) AS value FROM ap_companies""")
def r05b(fx, cfg):
    return R.stuck_in_parked(_apply(fx, cfg).companies, fx.pools)


@register("r06_profiles_per_pool", PARKED, """
SELECT code, (SELECT count(*) FROM pool_profiles WHERE pool_id = pools.id) AS profiles_linked
FROM pools WHERE code IN ('RETENTION', 'PAST_RETENTION')""")
def r06a(fx, cfg):
    return R.profiles_per_pool(fx.pools, fx.pool_profiles)


@register("r06_private_owner_anomalies", PARKED, """
SELECT * FROM (
  SELECT id AS pool_id, code, name, (SELECT count(*) FROM pool_profiles WHERE pool_id = pools.id) AS agents_linked
  FROM pools WHERE type = 'PRIVATE') x
WHERE agents_linked <> 1""")
def r06b(fx, cfg):
    return R.private_owner_anomalies(fx.pools, fx.pool_profiles)


_AGENT = "agent7@example.com"


@register("r06_agent_links", PARKED, f"""
SELECT email, code FROM (SELECT id AS profile_id, email FROM profiles WHERE lower(email) = '{_AGENT}') a
NATURAL JOIN pool_profiles NATURAL JOIN (SELECT id AS pool_id, code FROM pools) b""")
def r06c(fx, cfg):
    return R.agent_links(fx.pool_profiles, fx.profiles, fx.pools, _AGENT)


_NAME_LIKE = "%#00000001%"


@register("r07_company_deep_dive", PARKED, f"""
SELECT co.id AS company_id, co.name, p.code AS pool, max(k.end_ts::DATE) AS max_end,
  CAST(max(k.end_ts::DATE) - {_RD} AS INTEGER) AS days_left
FROM companies co JOIN pools p ON p.id = co.pool_id LEFT JOIN contracts k ON k.company_ref = co.id
WHERE lower(co.name) LIKE '{_NAME_LIKE.lower()}' GROUP BY co.id, co.name, p.code""")
def r07(fx, cfg):
    return R.company_deep_dive(fx.companies, fx.pools, fx.contracts, _NAME_LIKE, cfg)


@register("r08_latest_moves", APPLY, """
SELECT created_at, company_id, (SELECT name FROM companies WHERE id = company_id) AS company_name,
  (SELECT name FROM pools WHERE id = pool_id) AS new_pool, action
FROM (SELECT *, row_number() OVER (ORDER BY created_at DESC, company_id) AS k FROM ap_audits WHERE action = 'AUTO_ASSIGN') x WHERE k <= 50""")
def r08a(fx, cfg):
    return R.latest_moves(_apply(fx, cfg).audits, fx.companies, fx.pools)


@register("r08_private_campaigns", APPLY, """
SELECT company_id, (SELECT name FROM companies WHERE id = company_id) AS company_name, (SELECT name FROM pools WHERE id = pool_id) AS pool,
  (SELECT name FROM pools WHERE id = source_pool_id) AS campaign
FROM (SELECT *, row_number() OVER (ORDER BY company_id) AS k FROM ap_placements
      WHERE ended_at IS NULL AND pool_id IN (SELECT id FROM pools WHERE type = 'PRIVATE')) x WHERE k <= 30""")
def r08b(fx, cfg):
    return R.private_campaigns(_apply(fx, cfg).placements, fx.companies, fx.pools)


@register("r09_mapping_callback_counts", PARKED, """
SELECT 'mappings' AS metric, count(*) AS value FROM mappings
UNION ALL SELECT 'retention_mappings', count_if(lower(coalesce(campaign, source, '')) LIKE '%retention%') FROM mappings
UNION ALL SELECT 'open_callbacks', count_if(status = 'SCHEDULED') FROM callbacks""")
def r09(fx, cfg):
    return R.mapping_and_callback_counts(fx.external_site_mappings, fx.callbacks)


@register("r10_active_rules", LIVE, "SELECT tag, pool_id, priority FROM m4_rules WHERE coalesce(active, TRUE)")
def r10a(fx, cfg):
    return R.active_rules(_sync(fx, cfg)[2])


@register("r10_families_by_bucket", LIVE, "SELECT family AS bucket, count(*) AS providers FROM m4_families WHERE active = TRUE GROUP BY family")
def r10b(fx, cfg):
    return R.active_families_by_bucket(_sync(fx, cfg)[1])


@register("r10_supplier_now_rules", LIVE, f"""
SELECT 'supplier_now_rules' AS metric, count_if(suffix(tag, '_NOW') AND tag NOT IN ({twins.in_list(R.SHARED_SUPPLIER_TAGS)})
  AND active = TRUE) AS value FROM m4_rules""")
def r10c(fx, cfg):
    return R.supplier_now_rules(_sync(fx, cfg)[2])


@register("r11_maintenance_counts", PARKED, f"""
SELECT 'janitor_cleared' AS metric, count(*) AS value FROM companies c
  WHERE EXISTS (SELECT 1 FROM profiles p WHERE p.id = c.profile_id AND coalesce(p.disabled, FALSE))
UNION ALL SELECT 'companies_reclaimed', count(*) FROM m5_targets
UNION ALL SELECT 'moved_to_unassigned', count(*) FROM m6_misfiled
UNION ALL SELECT 'fallback_rows', count(*) FROM sale
UNION ALL SELECT 'fallback_with_end_date', count(last_deal_end_date) FROM sale
UNION ALL SELECT 'fallback_missing_end_date', count(*) - count(last_deal_end_date) FROM sale
UNION ALL SELECT 'active_private_links', count_if(CASE WHEN child_type = 'PRIVATE' THEN FALSE ELSE active END) FROM links WHERE child_type = 'PRIVATE'
UNION ALL SELECT 'total_private_links', count(*) FROM links WHERE child_type = 'PRIVATE'
UNION ALL SELECT 'still_have_agent', count(agent) FROM (SELECT NULL::VARCHAR AS agent FROM companies) x
UNION ALL SELECT 'companies_without_agent', count(*) - count(profile_id) FROM companies
UNION ALL SELECT 'companies_in_parked_pools', count(*) FROM companies c JOIN pools p ON p.id = c.pool_id
  WHERE p.type <> 'PRIVATE' AND coalesce(p.code, '') NOT IN ({twins.in_list(C.K.PARK_KEEP_TAGS)})
UNION ALL SELECT 'companies_to_move', count(*) FROM m7_targets
UNION ALL SELECT 'on_rule_pool', count(*) FROM companies WHERE pool_id IN {_ACTIVE_RULE_POOLS}""")
def r11(fx, cfg):
    resolved = _resolved(fx)
    best = C.best_end_date(resolved, cfg)
    cleared = M.clear_leavers(fx.companies, fx.profiles, cfg)[1]
    past = M.past_sale_companies(fx.deals, fx.external_site_mappings, fx.companies, cfg)
    reclaimed = M.reclaim(fx.companies, fx.pools, best, past, cfg)[1]
    far = M.repair_far_future(fx.companies, fx.pools, best, cfg)[1]
    sale = C.past_sale(fx.external_site_mappings, best, fx.companies, cfg)
    return R.maintenance_counts(cleared, reclaimed, far, sale, M.deactivate_links(fx.pool_links),
                                M.clear_profiles(fx.companies), fx.pool_rules(cfg.mode), fx.companies, fx.pools, _retire(fx, cfg)["targets"])


# --- routing mode (T7) over the synced supplier dimensions ---------------------------------

@register("t07_activate_rules_parked", LIVE, f"""
SELECT tag, pool_id, priority,
  CASE WHEN tag NOT IN ({twins.in_list(C.K.PARK_KEEP_TAGS)}) THEN FALSE
       WHEN tag IN ({twins.in_list(C.K.PARK_ON_TAGS)}) THEN TRUE ELSE active END AS is_active, description
FROM m4_rules""")
def t07r(fx, cfg):
    _, _, rules = _sync(fx, cfg)
    return _renamed(T.activate(rules, fx.provider_families, "parked")[0], RULE_COLS)


@register("t07_activate_families_parked", LIVE, """
SELECT id, provider_id, family, tag_code, pool_id, window_days, display_name,
  CASE WHEN coalesce(manual, FALSE) THEN active ELSE FALSE END AS is_active, manual AS is_manual, matched_pattern
FROM m4_families""")
def t07f(fx, cfg):
    _, families, rules = _sync(fx, cfg)
    return _renamed(T.activate(rules, families, "parked")[1], FAMILY_COLS)



@register("t07_activate_rules_live", LIVE, f"""
SELECT tag, pool_id, priority, tag NOT IN ({twins.in_list(C.K.PARK_KEEP_TAGS)}) OR priority % 4 = 0 AS is_active, description FROM m4_rules""")
def t07rl(fx, cfg):
    _, _, rules = _sync(fx, cfg)
    return _renamed(T.activate(rules.withColumn("isActive", F.col("priority") % 4 == 0), fx.provider_families, "live")[0], RULE_COLS)


@register("t07_activate_families_live", LIVE, """
SELECT id, provider_id, family, tag_code, pool_id, window_days, display_name, NOT coalesce(manual, FALSE) AS is_active, manual AS is_manual, matched_pattern FROM m4_families""")
def t07fl(fx, cfg):
    _, families, rules = _sync(fx, cfg)
    return _renamed(T.activate(rules, families.withColumn("isActive", F.lit(False)), "live")[1], FAMILY_COLS)


# --- supplier classification through synced provider families (C4/C5/C7 family path) ------

def _synced_facts(fx, cfg):
    _, families, _ = _sync(fx, cfg)
    return C.contract_facts(_resolved(fx), fx.providers, families, cfg)


@register("c04_contract_facts_synced", LIVE, "SELECT * FROM facts_synced")
def c04s(fx, cfg):
    return _synced_facts(fx, cfg)


@register("c05_winning_contract_synced", LIVE, "SELECT * FROM winner_synced")
def c05s(fx, cfg):
    return C.winning_contract(_synced_facts(fx, cfg))


# --- members of split policies (M13) -------------------------------------------------

def _backfill(fx, cfg):
    return M.backfill_members(fx.pool_members, fx.profiles, fx.split_policies, fx.pool_profiles, K.RETENTION_POLICIES)


@register("m13_members", PARKED, "SELECT id, policy_id, child_pool_id, profile_id, active AS is_active FROM filled_members")
def m13_members(fx, cfg):
    return _backfill(fx, cfg)[0].select("id", F.col("policyId").alias("policy_id"), F.col("childPoolId").alias("child_pool_id"),
                                        F.col("profileId").alias("profile_id"), F.col("isActive").alias("is_active"))


@register("m13_roster", PARKED, """
SELECT pool_id, profile_id FROM pool_profiles
UNION
SELECT CASE policy_id WHEN 'policy_retention' THEN 'pool_RETENTION' ELSE 'pool_PAST_RETENTION' END, profile_id FROM filled_members
WHERE active AND profile_id IS NOT NULL AND policy_id <> 'policy_unassigned'""")
def m13_roster(fx, cfg):
    return _backfill(fx, cfg)[1].select(F.col("poolId").alias("pool_id"), F.col("profileId").alias("profile_id"))


@register("m13_member_check", PARKED, """
SELECT policy_id, count(*) AS members, count(*) FILTER (active) AS active, count(profile_id) AS with_profile,
  count(*) FILTER (active AND profile_id IS NULL) AS missing_profile
FROM members WHERE policy_id <> 'policy_unassigned' GROUP BY policy_id""")
def m13_member_check(fx, cfg):
    """Before the backfill, as it would be empty of findings afterwards."""
    return M.member_check(fx.pool_members, K.RETENTION_POLICIES).withColumnRenamed("policyId", "policy_id")


# --- the same operators where most facts reach a company --------------------------------

register("c08_last_deal_linked", PARKED, "SELECT * FROM last_deal", linked=True)(c08)
register("c09_deal_companies_linked", PARKED, "SELECT company_id FROM deal_cos", linked=True)(c09)
register("c16_load_origin_linked", PARKED, "SELECT * FROM origin", linked=True)(c16)
register("c17_past_sale_linked", PARKED_STRICT, "SELECT * FROM sale", linked=True)(_past_sale)
register("c20_features_linked", PARKED, "SELECT * FROM features", linked=True)(_features)
register("t03_propose_parked_linked", PARKED_STRICT, _PROPOSAL_SQL, linked=True)(_proposals)
register("fs_fair_share_linked", PARKED_STRICT, "SELECT company_id, lead_tag, is_protected, parent_pool_id, proposed_pool_id FROM fair", linked=True)(fs)
