"""Dense ranks and interval look-ups over a whole table or within a key, without a task that holds a whole key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poolwright.session import materialize


def distributed_rank(df: DataFrame, within: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` with the 1-based rank by ``order`` among the rows of one ``within`` key, as ``name``.

    Rows are range-partitioned and sorted on (within, order), numbered inside each partition, and
    checkpointed, as neither the range sample nor the numbers may be computed twice. The rows of a
    key in earlier partitions come from a table of one row per (partition, key). Rows must be
    unique on (within, order).
    """
    keys = list(within)
    ordered = materialize(
        df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
        .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    stats = ordered.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    return ordered.join(offsets, ["_pid", *keys]).withColumn(
        name, F.col("_before") + (F.col("_mid") - F.col("_first")) + 1).drop("_pid", "_mid", "_first", "_before")


def interval_lookup(points: DataFrame, starts: DataFrame, within: Sequence[str], at: str, payload: Sequence[str]) -> DataFrame:
    """``points`` with the ``payload`` of the interval that each lies in: of the same ``within`` key, the last of
    ``starts`` whose ``at`` is not over the point's.

    Both are merged by one range partitioning on (within, at) and carried forward inside each partition; a partition
    that begins within an interval takes its start from the last one of the partitions before, by a table of one row per
    (partition, key). So an interval may hold any number of points. Points before every start get nulls. ``starts`` must be
    unique on (within, at).
    """
    keys, rest = list(within), [c for c in points.columns if c not in within and c != at]
    said = F.struct(F.col(at).alias("_start"), *payload)
    both = points.select(*keys, at, *rest, F.lit(None).cast(starts.select(said.alias("s")).schema["s"].dataType).alias("_said"), F.lit(1).alias("_kind")).unionByName(
        starts.select(*keys, at, said.alias("_said"), F.lit(0).alias("_kind")), allowMissingColumns=True)
    ordered = materialize(both.repartitionByRange(*keys, at, "_kind").sortWithinPartitions(*keys, at, "_kind").withColumn("_pid", F.spark_partition_id()))
    last = ordered.groupBy("_pid", *keys).agg(F.max("_said").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("_pid", *keys, F.max("_last").over(earlier).alias("_carried"))
    here = Window.partitionBy("_pid", *keys).orderBy(at, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = ordered.withColumn("_here", F.last("_said", ignorenulls=True).over(here)).where(F.col("_kind") == 1).join(carried, ["_pid", *keys])
    found = found.withColumn("_got", F.coalesce("_here", "_carried"))
    return found.select(*points.columns, *[F.col(f"_got.{c}").alias(c) for c in payload])
