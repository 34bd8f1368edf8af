"""Reading, conforming and writing tables.

Sources are pluggable: any ``spark.read`` format. JDBC sources are read in parallel slices
(``partitionColumn``/``numPartitions``) when the caller gives bounds; counts are taken from
the written copy, never by reading the source a second time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


def _source_columns(df: DataFrame, schema: T.StructType, aliases: Mapping[str, Iterable[str]] | None) -> list[tuple[T.StructField, str | None]]:
    """Each field with the source column that it is read from: by its name, then by its aliases, whatever their case."""
    aliases = aliases or {}
    by_lower = {c.lower(): c for c in df.columns}
    return [(f, next((by_lower[n.lower()] for n in (f.name, *aliases.get(f.name, ())) if n.lower() in by_lower), None)) for f in schema.fields]


def conform(df: DataFrame, schema: T.StructType, aliases: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``.

    Columns are found case-insensitively, by the field name first and then by its aliases;
    a field with no source column becomes a typed NULL. Extra source columns are dropped. A value that
    doesn't fit its field stops the job; ``conform_checked`` sets such rows aside.
    """
    return df.select(*[(F.lit(None) if c is None else F.col(f"`{c}`")).cast(f.dataType).alias(f.name) for f, c in _source_columns(df, schema, aliases)])


#: rejected rows: the first column whose value doesn't fit, that value, the type wanted, and the whole source row
REJECTS = T.StructType([T.StructField("field", T.StringType()), T.StructField("value", T.StringType()),
                        T.StructField("wanted", T.StringType()), T.StructField("row", T.StringType())])


def conform_checked(df: DataFrame, schema: T.StructType, aliases: Mapping[str, Iterable[str]] | None = None,
                    required: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """S4 with a reject channel: (rows that fit ``schema``, the others as ``REJECTS``).

    A row is set aside if a value can't be cast to its field's type, or a ``required`` field is null. Both outputs are
    one projection and a filter over the same read; nothing is collected, and no malformed value stops the job.
    """
    need = set(required)
    found = _source_columns(df, schema, aliases)
    tried = [F.lit(None).cast(f.dataType) if c is None else F.col(f"`{c}`").try_cast(f.dataType) for f, c in found]
    bad = None
    for (f, c), value in zip(found, tried, strict=True):
        source = F.lit(None).cast("string") if c is None else F.col(f"`{c}`").cast("string")
        wrong = value.isNull() if f.name in need else source.isNotNull() & value.isNull()
        fault = F.struct(F.lit(f.name).alias("field"), source.alias("value"), F.lit(f.dataType.simpleString()).alias("wanted"))
        bad = F.when(wrong, fault) if bad is None else bad.when(wrong, fault)
    judged = df.select(bad.alias("_bad"), *[v.alias(f"_v{i}") for i, v in enumerate(tried)], F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("_row"))
    good = judged.where(F.col("_bad").isNull()).select(*[F.col(f"_v{i}").alias(f.name) for i, (f, _) in enumerate(found)])
    rejected = judged.where(F.col("_bad").isNotNull()).select("_bad.field", "_bad.value", "_bad.wanted", F.col("_row").alias("row"))
    return good, rejected


def find_column(df: DataFrame, *names: str) -> str | None:
    """Case-insensitive lookup of the first present column among ``names``."""
    by_lower = {c.lower(): c for c in df.columns}
    for name in names:
        if name.lower() in by_lower:
            return by_lower[name.lower()]
    return None


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, reader, schema: T.StructType) -> DataFrame:
    """S3: ``reader()`` returns a DataFrame; a *missing* table/path gives an empty frame.

    Only not-found errors fall back; any other failure propagates (a broken source must
    not silently read as "no rows").
    """
    try:
        return reader()
    except AnalysisException as exc:
        cls = getattr(exc, "getCondition", lambda: None)() or ""
        msg = str(exc)
        if (
            cls in ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND")
            or "TABLE_OR_VIEW_NOT_FOUND" in msg
            or "PATH_NOT_FOUND" in msg
            or "Path does not exist" in msg
        ):
            return empty(spark, schema)
        raise


def read_table(spark: SparkSession, fmt: str, path_or_table: str, **options) -> DataFrame:
    """Generic source read: parquet/orc/delta path, or a catalog table when fmt == 'table'."""
    if fmt == "table":
        return spark.table(path_or_table)
    return spark.read.format(fmt).options(**options).load(path_or_table)


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, **options) -> DataFrame:
    """S1/S2 JDBC source. ``query`` pushes a whole SELECT down to the database.

    With a numeric ``partition_column`` and bounds the read is split into ``num_partitions``
    parallel range queries instead of one single-task read.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if query is not None:
        reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table)
        if partition_column is not None:
            reader = (
                reader.option("partitionColumn", partition_column)
                .option("lowerBound", lower)
                .option("upperBound", upper)
                .option("numPartitions", num_partitions or 64)
            )
    return reader.load()


def _counted(spark: SparkSession, sources: Mapping[str, DataFrame], write) -> DataFrame:
    """Write each frame and count its rows on the way: (table, rows), no table read twice."""
    rows = []
    for name, df in sources.items():
        seen = Observation()
        write(name, df.observe(seen, F.count(F.lit(1)).alias("rows")))
        rows.append((name, seen.get["rows"]))
    return spark.createDataFrame(rows, "table string, rows long")


def snapshot(spark: SparkSession, sources: Mapping[str, DataFrame], out_dir: str,
             fmt: str = "parquet") -> DataFrame:
    """Write each source frame to ``out_dir/<name>`` (overwrite) and report row counts as (table, rows)."""
    return _counted(spark, sources, lambda name, df: df.write.mode("overwrite").format(fmt).save(f"{out_dir.rstrip('/')}/{name}"))


def snapshot_tables(spark: SparkSession, sources: Mapping[str, DataFrame], database: str, fmt: str = "parquet") -> DataFrame:
    """S1 into catalog tables ``database.<name>``; the schema is overwritten with the rows. Returns (table, rows)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    return _counted(spark, sources, lambda name, df: df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true").saveAsTable(f"`{database}`.`{name}`"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Iterable[str] = ()) -> None:
    """Overwrite one output table (versioned directories; never read-and-overwrite in place)."""
    writer = df.write.mode("overwrite").format(fmt)
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)
