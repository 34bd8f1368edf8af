"""Hot and NULL join keys: same rows as the plain joins, and adaptive splitting of a hot partition."""

from pyspark.sql import functions as F

from poolwright.functions.columns import left_join_nullable
from poolwright.operators import features as C
from poolwright.operators.ranking import distributed_rank
from poolwright.registry import APPLY
from poolwright.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_null_keys_stay_unmatched_and_spread(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("key"))
    right = spark.createDataFrame([(f"k{j}", j) for j in range(1, 40)], "okey string, val int")
    got = left_join_nullable(left, right, "key", "okey")
    assert got.columns == ["id", "key", "okey", "val"]
    assert rows(got) == rows(left.join(right, F.col("key") == F.col("okey"), "left"))


def test_hot_key_is_split_at_run_time(spark):
    """A contract table in which one site holds a third of the rows gives the same pairs when splits are forced."""
    fx = Fixtures(spark, SF, APPLY)
    hot = fx.contracts.withColumn("siteId", F.when(F.col("siteId").isNotNull(), F.lit("S1")).otherwise(F.col("siteId")))
    plain = rows(C.resolve_contract_companies(hot, fx.company_sites, fx.site_meters))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        split = C.resolve_contract_companies(hot, fx.company_sites, fx.site_meters)
        assert rows(split) == plain
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rank_across_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("key"), F.xxhash64("id").alias("v")).repartition(7)
    got = distributed_rank(df, ["key"], ["v"], "r").collect()
    for key in (0, 1):
        mine = sorted((r["v"], r["r"]) for r in got if r["key"] == key)
        assert [r for _, r in mine] == list(range(1, len(mine) + 1))
