"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Size of a document: its words. Sources in code point order (null last) weigh ``weights``, repeating,
and share ``share`` of all sizes; no target passes ``cap`` times its source's size, and the excess is
shared again by weight. Every document of a source expects ``target / source size`` copies. Documents
stand in order of size; the expected copies are summed up along that order, one offset in [0, 1) per
source is added, and a document is emitted once per integer that its stretch crosses.

The running sum is taken in two levels, so that a source with a third of all rows is no single task:
cells (source, size bin, hash bin) are counted with map-side sums, the cells' counts (at most
``HASH_BINS`` times a few hundred size bins a source) are summed per source, and rows are numbered
within their cell only.

Null text has size 0; a null source is a source of its own; repeated rows and ties are sampled like any
rows; a null doc_id sorts first among equals; an empty table gives no rows. Only the columns named here
are read; any further ones are left out (``mix``) or carried along (``emit``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
HASH_BINS = 64
SEED = "mix-1"


def _hash32(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _size_bin(size: Column) -> Column:
    """The size itself below 64, else its leading six bits: bins rise with the size."""
    shift = F.length(F.bin(size)) - 6
    return F.when(size < 64, size).otherwise(32 * shift + F.floor(size / F.pow(F.lit(2.0), shift))).cast("long")


def _cells(docs: DataFrame, keep: list[str]) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD_RE)), F.lit(0)).cast("long")
    rows = docs.select(*keep, F.col("doc_id").alias("_id"), F.col("source").alias("_src"), size.alias("_size"),
                       F.xxhash64("text").alias("_tie"))
    return rows.withColumns({
        "_key": F.coalesce(F.concat(F.lit("s"), F.col("_src")), F.lit("null")),
        "_bin": _size_bin(F.col("_size")),
        "_hb": _hash32(F.coalesce(F.col("_id").cast("string"), F.lit("null"))) % HASH_BINS,
    })


def source_targets(cells: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """One row a source: its words and target, by water-filling up to ``cap`` times its words.

    Sources reach their cap in order of size over weight, so those at their cap are a prefix of that order.
    """
    per = cells.groupBy("_key").agg(F.max("_src").alias("_src"), F.sum("_words").alias("source_size"))
    by_name = Window.partitionBy().orderBy(F.col("_src").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * cap)
    order = Window.partitionBy().orderBy(F.col("source_size") / F.col("w"), F.col("_src").asc_nulls_last())
    every = Window.partitionBy()
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumns({
        "goal": F.sum("source_size").over(every) * F.lit(share),
        "used": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "left": F.sum("w").over(after),
    })
    per = per.withColumn("full", F.col("cap") * F.col("left") <= (F.col("goal") - F.col("used")) * F.col("w"))
    per = per.withColumns({
        "used": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(every),
        "left": F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(every),
    })
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * (F.col("goal") - F.col("used")) / F.col("left"))
    return per.select("_key", "source_size", target.alias("target"))


def _mixed(docs: DataFrame, keep: list[str], weights, share, cap, seed) -> DataFrame:
    """A row a document with its copies; texts are read once, to count their words, and left behind."""
    rows = stored(_cells(docs, keep))
    cells = rows.groupBy("_key", "_src", "_bin", "_hb").agg(F.count("*").alias("_n"), F.sum("_size").alias("_words"))
    before = Window.partitionBy("_key").orderBy("_bin", "_hb").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("_key", "_bin", "_hb", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    starts = starts.join(F.broadcast(source_targets(cells, weights, share, cap)), "_key")  # one row a source
    within = Window.partitionBy("_key", "_bin", "_hb").orderBy("_size", "_id", "_tie")
    rows = rows.join(starts, ["_key", "_bin", "_hb"]).withColumn("_rank", F.col("_before") + F.row_number().over(within))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _hash32(F.concat(F.lit(f"{seed}:"), F.col("_key"))) / F.lit(4294967296.0)
    upto = lambda n: F.floor(n * F.col("_rate") + F.col("_off"))
    copies = F.when(F.col("_rate") >= cap, F.lit(cap)).otherwise(F.least(upto(F.col("_rank")) - upto(F.col("_rank") - 1), F.lit(cap)))
    return rows.withColumns({"_rate": rate, "_off": offset}).withColumn("_copies", copies.cast("int"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, copies, taken (size times copies)."""
    return _mixed(docs, [], weights, share, cap, seed).select(
        F.col("_id").alias("doc_id"), F.col("_src").alias("source"), F.col("_size").alias("size"), "source_size", "target",
        F.col("_copies").alias("copies"), (F.col("_size") * F.col("_copies")).alias("taken"))


def _placed(docs: DataFrame, scanned: bool) -> tuple[DataFrame, list[str]]:
    """The rows as ``_row``, and the columns that name each: its file and its place there, or a number that is stored with it."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    if scanned:
        try:
            return docs.select(whole, F.col("_metadata.file_path").alias("_n_file"), F.col("_metadata.row_index").alias("_n_row")), ["_n_file", "_n_row"]
        except AnalysisException:  # not read from files
            pass
    return stored(docs.select(whole).withColumn("_n_row", F.monotonically_increasing_id())), ["_n_row"]


def emit(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED, scanned: bool = False) -> DataFrame:
    """The mix itself: the rows of ``docs``, each repeated as often as it is taken.

    What is decided on numbers and sizes alone meets its row again. ``scanned``: ``docs`` is a table as read from its
    files, without joins or the like, so that a row's place in its file names it; any other frame is stored once.
    """
    rows, place = _placed(docs, scanned)
    asked = rows.select(*place, *[F.col("_row")[c].alias(c) for c in ("doc_id", "source", "text")])
    chosen = _mixed(asked, place, weights, share, cap, seed).where(F.col("_copies") > 0).select(*place, "_copies")
    return rows.join(chosen, place).select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).select("_row.*")


#: DuckDB twin of ``mix`` with the values above; an independent statement over one full ranking.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
b AS (
  SELECT *, CASE WHEN size < 64 THEN size ELSE 32 * (length(bin(size)) - 6) + (size >> (length(bin(size)) - 6)::BIGINT) END AS sb,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT % 64 AS hb FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS words, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM b GROUP BY source),
t AS (
  SELECT a.source, a.words, a.w, (SELECT sum(words) FROM s)::DOUBLE * 1.5 AS goal,
    coalesce((SELECT sum(2 * x.words) FROM s x WHERE x.words / x.w < a.words / a.w OR (x.words / x.w = a.words / a.w AND x.source < a.source)), 0)::DOUBLE AS used,
    (SELECT sum(x.w) FROM s x WHERE x.words / x.w > a.words / a.w OR (x.words / x.w = a.words / a.w AND (x.source >= a.source OR x.source IS NULL OR a.source IS NULL)))::DOUBLE AS rest
  FROM s a),
f AS (SELECT *, 2 * words * rest <= (goal - used) * w AS filled FROM t),
g AS (
  SELECT source, words, CASE WHEN filled THEN (2 * words)::DOUBLE
    ELSE w * (goal - (SELECT coalesce(sum(2 * words), 0) FROM f WHERE filled)::DOUBLE) / (SELECT sum(w) FROM f WHERE NOT filled)::DOUBLE END AS target
  FROM f),
r AS (
  SELECT b.doc_id, b.source, b.size, g.words AS source_size, g.target,
    CASE WHEN g.words > 0 THEN g.target / g.words ELSE 0.0 END AS rate,
    ('0x' || substr(md5('mix-1:' || CASE WHEN b.source IS NULL THEN 'null' ELSE 's' || b.source END), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS off,
    row_number() OVER (PARTITION BY b.source ORDER BY sb, hb, size, b.doc_id NULLS FIRST) AS k
  FROM b JOIN g ON b.source IS NOT DISTINCT FROM g.source),
c AS (
  SELECT *, CASE WHEN rate >= 2 THEN 2 ELSE least(floor(k * rate + off) - floor((k - 1) * rate + off), 2) END::INTEGER AS copies FROM r)
SELECT doc_id, source, size, source_size, target, copies, size * copies AS taken FROM c
"""
