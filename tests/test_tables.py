"""Table primitives, sources and column helpers."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolwright.functions.columns import complaint_text, is_dfv, slug
from poolwright.operators import maintenance as M
from poolwright.operators.tables import delete_matching, delete_prefix, insert_missing, update_where_distinct, upsert
from poolwright.sources import conform, read_or_empty, read_table
from poolwright.sources import schemas as SC


def test_upsert_policies(spark):
    target = spark.createDataFrame([("a", "n1", 1, "x"), ("b", "n2", 2, None)], "k string, name string, pri int, note string")
    source = spark.createDataFrame([("b", "N2", 9, "y"), ("c", "N3", 3, "z")], "k string, name string, pri int, note string")
    out = upsert(target, source, ["k"], {"name": "overwrite", "pri": "keep", "note": "coalesce"})
    got = {r["k"]: tuple(r)[1:] for r in out.collect()}
    assert got == {"a": ("n1", 1, "x"), "b": ("N2", 2, "y"), "c": ("N3", 3, "z")}


def test_insert_missing_and_delete(spark):
    t = spark.createDataFrame([("p1", "u1")], SC.POOL_PROFILES)
    s = spark.createDataFrame([("p1", "u1"), ("p2", "u1"), ("p2", "u1")], SC.POOL_PROFILES)
    out = insert_missing(t, s, ["poolId", "profileId"])
    assert sorted(tuple(r) for r in out.collect()) == [("p1", "u1"), ("p2", "u1")]
    gone = delete_matching(out, spark.createDataFrame([("p2",)], "id string"), {"poolId": "id"})
    assert [tuple(r) for r in gone.collect()] == [("p1", "u1")]


def test_update_where_distinct(spark):
    t = spark.createDataFrame([("a", None), ("b", "x"), ("c", "y")], "id string, v string")
    ch = spark.createDataFrame([("a", "x"), ("b", "x")], "id string, nv string")
    out, changed = update_where_distinct(t, ch, "id", {"v": "nv"})
    assert {r["id"]: r["v"] for r in out.collect()} == {"a": "x", "b": "x", "c": "y"}
    assert [r["id"] for r in changed.collect()] == ["a"]


def test_prefix_is_literal(spark):
    df = spark.createDataFrame([("ld_pool_1",), ("ldXpool_2",), (None,)], "id string")
    assert sorted(r["id"] or "" for r in delete_prefix(df, "id", "ld_pool_").collect()) == ["", "ldXpool_2"]


def test_conform_case_aliases_and_missing(spark):
    df = spark.createDataFrame([("1", "C1", "x")], "ID string, CompanyID string, extra string")
    out = conform(df, SC.COMPANY_SITES, {"companyId": ["company_id"]})
    assert out.columns == ["id", "companyId", "loadSourceId"]
    assert out.schema["loadSourceId"].dataType == T.StringType()
    assert tuple(out.collect()[0]) == ("1", "C1", None)


def test_read_or_empty(spark, tmp_path):
    missing = read_or_empty(spark, lambda: read_table(spark, "parquet", str(tmp_path / "nope")), SC.REVIEWS)
    assert missing.count() == 0 and missing.columns == ["id", "dealId", "status"]
    with pytest.raises(Exception):
        read_or_empty(spark, lambda: spark.sql("SELECT * FROM range(1) WHERE no_such_column = 1"), SC.REVIEWS)


def test_column_helpers(spark):
    df = spark.createDataFrame([("Yu-Energy ", "Variable rate", "ongoing", "Complaint now"),
                                ("  ", None, "call", None), ("E.ON Next", "FVD", None, "ongoing complaint")],
                               "n string, t string, title string, d string")
    rows = df.select(slug(F.trim("n")).alias("s"), is_dfv("t").alias("dfv"),
                     complaint_text("title", "d").alias("c")).collect()
    assert [tuple(r) for r in rows] == [("YU_ENERGY", True, True), ("", False, False), ("E_ON_NEXT", True, True)]


def test_backfill_members(spark):
    members = spark.createDataFrame([("pol_r", "priv_1", None, True), ("pol_r", "priv_2", "U9", True),
                                     ("pol_x", "priv_1", None, True)],
                                    "policyId string, childPoolId string, profileId string, isActive boolean")
    profiles = spark.createDataFrame([("U1", "U1", None, "AGENT", "priv_1", False)], SC.PROFILES)
    policies = spark.createDataFrame([("pol_r", "pool_R"), ("pol_x", "pool_X")], "id string, parentPoolId string")
    roster = spark.createDataFrame([], SC.POOL_PROFILES)
    m2, r2 = M.backfill_members(members, profiles, policies, roster, ("pol_r",))
    assert sorted((r["childPoolId"], r["profileId"]) for r in m2.collect()) == [
        ("priv_1", "U1"), ("priv_1", "U1"), ("priv_2", "U9")]
    assert sorted(tuple(r) for r in r2.collect()) == [("pool_R", "U1"), ("pool_R", "U9")]
    check = lambda m: {r["policyId"]: (r["members"], r["active"], r["with_profile"], r["missing_profile"])
                       for r in M.member_check(m, ("pol_r", "pol_x")).collect()}
    assert check(members) == {"pol_r": (2, 2, 1, 1), "pol_x": (1, 1, 0, 1)}
    assert check(m2) == {"pol_r": (2, 2, 2, 0), "pol_x": (1, 1, 1, 0)}
    assert check(members.limit(0)) == {}
