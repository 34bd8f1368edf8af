"""Maintenance jobs are idempotent; features keep company grain (sf0.001 fixtures)."""

import pytest
from pyspark.sql import functions as F

from poolwright.operators import features as C
from poolwright.operators import maintenance as M
from poolwright.registry import LIVE, PARKED
from poolwright.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF, PARKED)


@pytest.mark.parametrize("job", ["hide_pools", "relink_pools", "fix_private_owner"])
def test_visibility_jobs_idempotent(fx, job):
    fn = getattr(M, job)
    once = fn(fx.pool_profiles, fx.pools, fx.profiles, PARKED)
    twice = fn(once, fx.pools, fx.profiles, PARKED)
    assert rows(once) == rows(twice)


def test_link_agents_idempotent(fx):
    once = M.link_agents(fx.pool_profiles, fx.profiles, fx.pools, PARKED)
    assert rows(M.link_agents(once, fx.profiles, fx.pools, PARKED)) == rows(once)
    by_mail = M.link_agents(fx.pool_profiles, fx.profiles, fx.pools, PARKED, emails=("AGENT7@example.com",))
    assert by_mail.count() >= fx.pool_profiles.count()


def test_janitor_idempotent(fx):
    once, cleared = M.clear_leavers(fx.companies, fx.profiles, PARKED)
    assert cleared.count() > 0
    again, cleared2 = M.clear_leavers(once, fx.profiles, PARKED)
    assert cleared2.count() == 0 and rows(again) == rows(once)


def test_reclaim_and_far_future_idempotent(fx):
    best = C.best_end_date(C.resolve_contract_companies(fx.contracts, fx.company_sites, fx.site_meters), PARKED)
    past = M.past_sale_companies(fx.deals, fx.external_site_mappings, fx.companies, PARKED)
    companies, targets = M.reclaim(fx.companies, fx.pools, best, past, PARKED)
    assert targets.count() > 0
    assert M.reclaim(companies, fx.pools, best, past, PARKED)[1].count() == 0
    repaired, _ = M.repair_far_future(companies, fx.pools, best, PARKED)
    assert M.repair_far_future(repaired, fx.pools, best, PARKED)[1].count() == 0


def test_provider_sync_idempotent(spark):
    fx = Fixtures(spark, SF, LIVE)
    routes = M.provider_routes(fx.providers, LIVE)
    p1, f1, r1 = M.sync_provider_dims(routes, fx.pools, fx.provider_families, fx.pool_rules(), LIVE)
    p2, f2, r2 = M.sync_provider_dims(routes, p1, f1, r1, LIVE)
    assert rows(p1) == rows(p2) and rows(f1) == rows(f2) and rows(r1) == rows(r2)
    assert routes.groupBy("tag_code").count().where("count > 1 AND tag_code NOT IN ('BG','EON','UB')").count() == 0


def test_features_one_row_per_company(fx):
    feats = C.build_features(fx, PARKED)
    n = fx.companies.count()
    assert feats.count() == n and feats.select("company_id").distinct().count() == n


def test_route_codes_unique_after_suffix(spark):
    fx = Fixtures(spark, SF, LIVE)
    assert M.route_code_collisions(M.provider_routes(fx.providers, LIVE)).count() == 0


def test_routing_with_no_contracts_and_no_deals(spark):
    """Empty fact tables: every company still gets exactly one tag."""
    from dataclasses import replace

    from poolwright.plans.nightly import from_fixtures, route
    from poolwright.sources import schemas as SC

    fx = Fixtures(spark, SF, PARKED)
    t = replace(from_fixtures(fx), contracts=spark.createDataFrame([], SC.CONTRACTS),
                deals=spark.createDataFrame([], SC.DEALS))
    routed = route(t, PARKED)
    n = fx.companies.count()
    assert routed.count() == n and routed.where(F.col("lead_tag").isNull()).count() == 0


def test_supplier_codes_are_unique_past_a_hundred_thousand_providers(spark):
    """Six-figure provider ids begin alike, so codes that still collide carry the whole id."""
    from pyspark.sql import functions as F

    from poolwright.config import RunConfig
    from poolwright.operators import maintenance as M

    providers = spark.range(99_990, 230_000).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 2 == 0, F.lit("Yu Energy")).when(F.col("id") % 3 == 0, F.lit("Yu-Energy"))
        .otherwise(F.concat(F.lit("Supplier "), F.col("id").cast("string"))).alias("displayName"))
    routes = M.provider_routes(providers, RunConfig())
    assert routes.count() == routes.select("tag_code").distinct().count() == providers.count()
