"""The end-to-end nightly job on the sf0.001 fixtures."""

from dataclasses import replace

from poolwright.plans.nightly import from_fixtures, run_nightly
from poolwright.registry import APPLY, QUERIES
from poolwright.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def test_nightly_matches_registered_apply_and_reruns_identically(spark, tmp_path):
    t = from_fixtures(Fixtures(spark, SF, APPLY))
    summary = {r["metric"]: r["value"] for r in run_nightly(spark, t, APPLY, str(tmp_path)).collect()}
    moved = QUERIES["ap2_effective_moves"][0](spark, SF).count()
    assert summary["companies_moved"] == moved
    assert summary["companies"] == Fixtures(spark, SF, APPLY).companies.count()
    root = tmp_path / APPLY.run_id
    first = sorted(tuple(r) for r in spark.read.parquet(str(root / "company_pool_placements")).collect())
    again = {r["metric"]: r["value"] for r in run_nightly(spark, t, APPLY, str(tmp_path)).collect()}
    second = sorted(tuple(r) for r in spark.read.parquet(str(root / "company_pool_placements")).collect())
    assert again == summary and first == second


def test_nightly_keeps_stored_switches_and_mode_switch_is_its_own_job(spark, tmp_path):
    from pyspark.sql import functions as F

    from poolwright.functions.constants import PARK_KEEP_TAGS
    from poolwright.plans.nightly import switch_mode

    t = from_fixtures(Fixtures(spark, SF, APPLY))
    off = t.pool_rules.withColumn("isActive", F.lit(False))  # an operator has turned all rules off
    run_nightly(spark, replace(t, pool_rules=off), APPLY, str(tmp_path / "off"))
    routed = spark.read.parquet(str(tmp_path / "off" / APPLY.run_id / "routed"))
    assert routed.where("lead_tag = 'RETENTION' and not is_protected and proposed_pool_id is not null").count() == 0
    live = {r["metric"]: r["value"] for r in switch_mode(spark, replace(t, pool_rules=off), "live", str(tmp_path / "live")).collect()}
    assert live["active_rules"] == off.where(~F.col("tag").isin(*PARK_KEEP_TAGS)).count()


def test_deal_path_comes_from_the_source(spark, tmp_path):
    """A deals source without meter or site ids goes by company, although conforming adds the columns; a missing
    one reads as no deals."""
    from dataclasses import fields

    from poolwright.operators import features as C
    from poolwright.plans.nightly import load_snapshot

    fx = Fixtures(spark, SF, APPLY)
    t = from_fixtures(fx)
    for f in fields(t):
        df = getattr(t, f.name)
        if f.name not in ("deals", "deal_columns"):
            df.write.parquet(str(tmp_path / f.name))
    without = load_snapshot(spark, str(tmp_path))
    assert without.deals.count() == 0 and C.build_features(without, APPLY).where("last_deal_days_since is not null").count() == 0
    t.deals.drop("siteMeterId", "siteId").write.parquet(str(tmp_path / "deals"))
    by_company = load_snapshot(spark, str(tmp_path))
    assert C.deal_path(by_company.deal_columns) == "company"
    have = {r["company_id"] for r in C.build_features(by_company, APPLY).where("last_deal_days_since is not null").select("company_id").collect()}
    assert have == {r["companyId"] for r in t.deals.select("companyId").collect()}
