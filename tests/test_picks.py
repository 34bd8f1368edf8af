"""The contract picks of C20: one aggregate with the rows of C5 and C2, nothing of contract grain stored or dealt twice."""

import datetime as dt

from poolwright.operators import features as C
from poolwright.registry import PARKED
from poolwright.sources import schemas as SC
from poolwright.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_picks_are_those_of_c5_and_c2(spark):
    day = lambda n: PARKED.run_date + dt.timedelta(n)
    ends = [None, day(-4000), day(-1), day(0), day(1), day(540), day(541), dt.date(1, 1, 1), dt.date(9999, 12, 31)]
    made = [(f"K{i % 50}", f"C{i % 23}", None if i % 5 == 0 else f"S{i % 3}", "companyId", ends[(i * i) % 9 if i % 23 else 0],
             None if i % 7 == 0 else f"P{i % 6}", ["1", "fixed", None][i % 3]) for i in range(600)]
    resolved = spark.createDataFrame(made, "contract_id string, company_id string, site_id string, path string, end_date date, provider_id string, contract_type string")
    # P1 stands twice, P5 has no name row, P0 has a family without a name
    providers = spark.createDataFrame([("P1", "British Gas"), ("P1", "Yu Energy"), ("P2", None), ("P3", "E.ON Next"), ("P4", "Utility Bidder"), (None, "x")], "id string, displayName string")
    families = spark.createDataFrame([("f1", "P0", "EON", "EON", None, 90, "d", True, None, None), ("f2", "P4", " ", " ", None, None, "d", True, None, None)], SC.PROVIDER_FAMILIES)
    winners, best = C.contract_picks(resolved, providers, families, PARKED)
    want = C.winning_contract(C.contract_facts(resolved, providers, families, PARKED))
    assert rows(winners.select(want.columns)) == rows(want)
    want = C.best_end_date(resolved, PARKED)
    assert rows(best.select(want.columns)) == rows(want)
    assert rows(best.select("company_id", "end_date")) == rows(C.company_clock(resolved, PARKED))


def test_no_contract_rows_are_stored(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(C, "materialize", lambda df: stored.append(df.columns) or df)
    C.feature_inputs(Fixtures(spark, SF, PARKED), PARKED)
    assert stored and not [c for c in stored if "contract_id" in c]


def test_contracts_are_dealt_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fx = Fixtures(spark, SF, PARKED)
        plan = fx.contracts._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2  # lines and orders, no third for the distinct rows
        plan = fx.site_meters._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_apply_stores_only_what_it_reads(spark, monkeypatch):
    from poolwright import registry as R
    from poolwright.operators import fair_share as FS
    stored = []
    keep = FS.materialize
    monkeypatch.setattr(FS, "materialize", lambda df: stored.append(df.columns) or keep(df))
    routed, _ = R._batch_for_apply(Fixtures(spark, SF, R.APPLY), R.APPLY)
    assert sorted(routed.columns) == sorted(R.ROUTE_COLUMNS)
    assert stored and not [c for c in stored if "win_contract_id" in c]
