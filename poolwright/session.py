"""Session helpers. The library never creates its own session inside an operator."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "poolwright") -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # the routing plans are wide (many aliases and CASE ladders): constraint propagation
        # costs seconds of driver planning per query; the operators filter NULL join keys
        # explicitly, so the filters it would infer are already in the plan
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.driver.memory", "8g")
        # checkpoint files go when the frame that they back is collected as garbage
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where it is unset, a scratch folder in local mode, as in tests;
    on a cluster that is an error, as no folder of one machine is seen by the others."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    existing = spark.sparkContext.getCheckpointDir()
    if current:
        if existing is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if existing:
        return existing
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="poolwright-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df):
    """Cut lineage with a reliable checkpoint in ``spark.checkpoint.dir`` (survives executor loss).

    Used where a frame feeds several consumers (C1, the routed table) or where its values must
    not be recomputed (range-partition sample, generated row numbers).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
