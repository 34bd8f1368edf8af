"""Stage tables in buckets of the company id: what one stage shuffles by company, later stages read as it lies.

A table's buckets and its rows' order within them are in the catalog, so Spark joins and groups such tables on the
company id without an exchange. The number of buckets is that of the tasks of every later join: for a large table some
multiple of the cluster's cores, so that a bucket fits a task. Companies are one row a table here, so no bucket is hot.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from poolwright.config import RunConfig
from poolwright.operators import features as C

KEY = "company_id"


def stage_tables(spark: SparkSession, frames: Mapping[str, DataFrame], database: str, folder: str, buckets: int) -> dict[str, DataFrame]:
    """Write each frame as ``database.<name>`` under ``folder``, bucketed and sorted by company id; returns the tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    out = {}
    for name, df in frames.items():
        dealt = df.repartition(buckets, KEY)  # a file for each bucket, not one for each bucket and task
        dealt.write.mode("overwrite").option("path", f"{folder.rstrip('/')}/{name}").bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(f"`{database}`.`{name}`")
        out[name] = spark.table(f"`{database}`.`{name}`")
    return out


def staged_features(spark: SparkSession, t, cfg: RunConfig, database: str, folder: str, buckets: int) -> DataFrame:
    """C20 with every input written as a stage table: the assembly has no exchange."""
    return C.assemble(stage_tables(spark, C.feature_inputs(t, cfg), database, folder, buckets), cfg)
