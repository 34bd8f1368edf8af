"""Deletes along a graph of references, conforming with rejects, snapshots with counts."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolwright.operators.cascade import Reference, cascade, order_of, wipe_prefix
from poolwright.sources import REJECTS, conform_checked, snapshot, snapshot_tables

GRAPH = [Reference("child", "parent_id", "parent"), Reference("leaf", "child_id", "child"), Reference("note", "parent_id", "parent", action="clear"), Reference("leaf", "parent_id", "parent")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_cascade_over_levels(spark):
    tables = {
        "leaf": spark.createDataFrame([(1, 11, None), (2, 12, None), (3, None, 1), (4, None, None), (5, 13, 2)], "id long, child_id long, parent_id long"),
        "note": spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, None, "c")], "id long, parent_id long, text string"),
        "child": spark.createDataFrame([(11, 1), (12, 2), (13, None)], "id long, parent_id long"),
        "parent": spark.createDataFrame([(1,), (2,), (3,)], "id long"),
        "other": spark.createDataFrame([(1,)], "id long"),
    }
    got = cascade(tables, GRAPH, {"parent": tables["parent"].where("id = 1"), "child": tables["child"].where("id = 13")})
    assert rows(got["parent"]) == [(2,), (3,)] and rows(got["child"]) == [(12, 2)]
    assert rows(got["leaf"]) == [(2, 12, None), (4, None, None)]
    assert rows(got["note"]) == [(1, None, "a"), (2, 2, "b"), (3, None, "c")]
    assert got["other"] is tables["other"] and order_of(list(tables), GRAPH).index("parent") < order_of(list(tables), GRAPH).index("leaf")
    with pytest.raises(ValueError):
        order_of(["a", "b"], [Reference("a", "x", "b"), Reference("b", "x", "a")])


def test_wipe_by_prefix(spark):
    tables = {"pools": spark.createDataFrame([("ld_pool_1",), ("ldXpoolX2",), ("p",)], "id string"),
              "pool_rules": spark.createDataFrame([("A", "ld_pool_1"), ("B", "p"), ("C", None)], "tag string, poolId string"),
              "provider_families": spark.createDataFrame([("f", "ld_pool_1"), ("g", "p")], "id string, poolId string")}
    got = wipe_prefix(tables, "ld_pool_")
    assert rows(got["pools"]) == [("ldXpoolX2",), ("p",)] and rows(got["pool_rules"]) == [("B", "p"), ("C", None)] and rows(got["provider_families"]) == [("g", "p")]


def test_conform_with_rejects(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("none", T.StringType())])
    src = spark.createDataFrame([("1", "2020-01-02", "x"), ("a1", "2020-01-02", "x"), ("2", "soon", "y"), (None, "2020-01-02", "z"), ("3", None, None)], "ID string, `the.day` string, extra string")
    good, bad = conform_checked(src, schema, {"day": ("the.day",)}, required=["id"])
    assert good.schema == schema and [r.id for r in good.orderBy("id").collect()] == [1, 3]
    assert bad.schema.names == REJECTS.names and [tuple(r)[:3] for r in bad.orderBy("field", "value").collect()] == [("day", "soon", "date"), ("id", None, "bigint"), ("id", "a1", "bigint")]
    assert '"extra":"x"' in bad.where("value = 'a1'").first()["row"]


def test_snapshot_counts_in_the_write(spark, tmp_path):
    once = {"a": spark.range(7), "b": spark.range(0)}
    assert rows(snapshot(spark, once, str(tmp_path))) == [("a", 7), ("b", 0)]
    try:
        assert rows(snapshot_tables(spark, once, "pw_snap")) == [("a", 7), ("b", 0)]
        changed = {"a": spark.range(3).select(F.col("id").cast("string").alias("other"), F.lit(1).alias("more"))}
        assert rows(snapshot_tables(spark, changed, "pw_snap")) == [("a", 3)]
        assert spark.table("pw_snap.a").columns == ["other", "more"] and spark.table("pw_snap.b").count() == 0
    finally:
        spark.sql("DROP DATABASE IF EXISTS pw_snap CASCADE")
