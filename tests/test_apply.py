"""Apply: validation, snapshot-consistent outputs, idempotence."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from poolwright.config import RunConfig
from poolwright.operators import apply as AP
from poolwright.sources import schemas as SC

CFG = RunConfig()
POOLS = [("pool_R", "RETENTION", "Retentions", "STANDARD", False), ("pool_P", "PAST_RETENTION", "Past", "STANDARD", False),
         ("priv_1", None, "Private 1", "PRIVATE", False), ("priv_2", None, "Private 2", "PRIVATE", False)]
LINKS = [("pool_R", "priv_1", "STANDARD", "PRIVATE", True), ("pool_R", "priv_2", "STANDARD", "PRIVATE", False)]
COMPANIES = [("C1", "one", "pool_P", None), ("C2", "two", "pool_R", None), ("C3", "three", None, None),
             ("C4", "four", "pool_P", None), ("C5", "five", "pool_P", None)]
OPEN = dt.datetime(1999, 6, 1)
PLACEMENTS = [("pl1", "C1", "pool_P", "pool_P", "seed", OPEN, None), ("pl2", "C2", "pool_R", "pool_R", "seed", OPEN, None),
              ("pl4", "C4", "pool_P", None, "seed", OPEN, None)]
BATCH = [("C1", "pool_R", None),        # shared move, campaign defaults to the pool
         ("C2", "pool_R", "pool_R"),    # no-op (already there)
         ("C3", "priv_1", "pool_R"),    # private pool with an active link
         ("C4", "priv_2", "pool_R"),    # private pool, link inactive -> rejected
         ("C5", "pool_missing", None),  # unknown pool -> rejected
         ("C9", "pool_R", None)]        # unknown company -> rejected


@pytest.fixture(scope="module")
def tables(spark):
    mk = spark.createDataFrame
    return dict(companies=mk(COMPANIES, SC.COMPANIES), placements=mk(PLACEMENTS, SC.PLACEMENTS),
                audits=spark.createDataFrame([], SC.AUDITS), pools=mk(POOLS, SC.POOLS), links=mk(LINKS, SC.POOL_LINKS),
                batch=mk(BATCH, SC.APPLY_BATCH))


def run(t, batch=None, companies=None, placements=None, audits=None):
    return AP.apply_batch(batch if batch is not None else t["batch"], companies or t["companies"],
                          placements or t["placements"], audits or t["audits"], t["pools"], t["links"], CFG)


def test_moves_and_rejections(tables):
    res = run(tables)
    assert {r["company_id"] for r in res.moves.collect()} == {"C1", "C3"}
    assert {(r["company_id"], r["reason"]) for r in res.rejected.collect()} == {
        ("C4", "private pool without active link"), ("C5", "unknown pool"), ("C9", "unknown company")}
    pools = {r["id"]: r["poolId"] for r in res.companies.collect()}
    assert pools == {"C1": "pool_R", "C2": "pool_R", "C3": "priv_1", "C4": "pool_P", "C5": "pool_P"}


def test_placement_history(tables):
    res = run(tables)
    rows = res.placements.collect()
    open_rows = {}
    for r in rows:
        if r["endedAt"] is None:
            assert r["companyId"] not in open_rows, "at most one open placement per company"
            open_rows[r["companyId"]] = r
    assert open_rows["C1"]["poolId"] == "pool_R" and open_rows["C1"]["sourcePoolId"] == "pool_R"
    assert open_rows["C3"]["poolId"] == "priv_1" and open_rows["C3"]["sourcePoolId"] == "pool_R"
    closed = [r for r in rows if r["id"] == "pl1"][0]
    assert closed["endedAt"] == CFG.run_ts
    # Q4: the rejected C4 move still refreshes the campaign on its open placement (reference behaviour)
    assert open_rows["C4"]["sourcePoolId"] == "pool_R"
    assert res.audits.count() == res.moves.count() == 2


def test_refresh_validated_only(tables):
    cfg = CFG.with_(refresh_validated_only=True)
    res = AP.apply_batch(tables["batch"], tables["companies"], tables["placements"], tables["audits"],
                         tables["pools"], tables["links"], cfg)
    c4 = [r for r in res.placements.collect() if r["companyId"] == "C4" and r["endedAt"] is None][0]
    assert c4["sourcePoolId"] is None


def test_second_apply_moves_nothing(tables):
    first = run(tables)
    second = run(tables, companies=first.companies, placements=first.placements, audits=first.audits)
    assert second.moves.count() == 0
    assert second.audits.count() == first.audits.count()


def test_empty_batch(spark, tables):
    res = run(tables, batch=spark.createDataFrame([], SC.APPLY_BATCH))
    assert res.moves.count() == 0 and res.placements.count() == len(PLACEMENTS)


def test_actor_guard(tables):
    with pytest.raises(ValueError):
        AP.apply_batch(tables["batch"], tables["companies"], tables["placements"], tables["audits"],
                       tables["pools"], tables["links"], CFG.with_(actor=" "))


def test_ids_are_stable(tables):
    a = sorted(r["id"] for r in run(tables).audits.collect())
    b = sorted(r["id"] for r in run(tables).audits.collect())
    assert a == b and all(len(x) == 64 for x in a)


def test_company_named_twice_moves_once(spark, tables):
    """Of several valid moves the smallest pool id counts; no output repeats a company."""
    batch = spark.createDataFrame(BATCH + [("C1", "priv_1", "pool_R"), ("C1", "pool_missing", None), ("C2", "priv_1", None)], SC.APPLY_BATCH)
    res = run(tables, batch=batch)
    assert sorted(r["id"] for r in res.companies.collect()) == sorted(c[0] for c in COMPANIES)
    assert {(r["company_id"], r["proposed_pool_id"]) for r in res.moves.collect()} == {("C1", "pool_R"), ("C3", "priv_1")}
    ids = [r["id"] for r in res.placements.collect()]
    assert len(ids) == len(set(ids)) and res.audits.count() == 2
    assert ("C1", "unknown pool") in {(r["company_id"], r["reason"]) for r in res.rejected.collect()}
