"""Merkle dataset manifest: a tree of digests over the rows of every source, kept as postorder append logs.

H is the lowercase hex SHA-256 of its inputs' concatenation; digests enter as hex text. A leaf is H of a row's fields,
each ``-`` if null, else byte count, ``:``, value. Nodes of one tree fold in runs of ``FAN``: while several are left, each
run of consecutive ones (the last may be shorter, down to one) becomes its H. What is left, be it a lone leaf, is the
root of the tree. The roots of the sources, null first and then bytewise, are the leaves of the top tree.

Build: rows get their place within their tree from a range partitioning and the counts of its partitions. Aligned builders
take ``SPAN`` consecutive leaves each, a power of the fan-out, and append every node when its last leaf has come: leaves
and inner nodes in postorder, the builder's root last. The builders' roots are the leaves of the next stage, until each
tree has one builder left, so a stage is 1 / ``SPAN`` of the one below and no task holds a tree.

Proofs: the node of level l whose last leaf is e stands at e + e // FAN + e // FAN**2 + … + l in its builder's log, as
so many leaves and inner nodes were complete before. Siblings are read off the log at such positions. From the top
stage down, each builder hands its children the path above them; a path has two short texts a level.

Defined results: every row is a leaf, repeated rows too. Rows of a source ascend by doc_id, null first, and rows of one
doc_id by their leaf; equal leaves may change places. Null or empty texts are as the leaf states them. An empty table
gives no rows. Other columns are not read. Rows with null doc_id are never claimed otherwise by ``tampered``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_if_few, checkpointed, crc_mod, lower_ascii, stored

FAN = 16
#: levels that a builder folds, and its leaves
LEVELS = 2
SPAN = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5

STEP = T.StructType([T.StructField("before", T.StringType(), False), T.StructField("after", T.StringType(), False)])
PATH = T.ArrayType(STEP, False)


def field(col: Column) -> Column:
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The leaf of a row of ``FIELDS``, as 32 bytes; ``changed`` gives other values for some of them."""
    return F.unhex(F.sha2(F.concat(*(field(changed.get(c, F.col(c))) for c in FIELDS)).cast("binary"), 256))


def tampered() -> Column:
    """The leaf of the row as its holder claims it: one row in five has its text lower-cased."""
    changed = F.when(crc_mod(F.col("doc_id"), TAMPER_EVERY) == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return leaf(text=changed)


def tree_key() -> Column:
    """The source as a tree's key: null is the empty text, anything else follows an ``s``, so the order stays."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))


# --- closed forms


def height(n: int) -> int:
    """Levels above the leaves of a tree of n nodes."""
    up = 0
    while n > 1:
        n, up = -(-n // FAN), up + 1
    return up


def folds(n: int) -> int:
    """Levels that a builder folds where its tree has n nodes at the builders' base."""
    return LEVELS if n > SPAN else height(n)


def position(level: int, index: int, leaves: int) -> int:
    """Where the log of ``leaves`` leaves holds a node: nodes complete before its last leaf, and those of its own below."""
    last = min((index + 1) * FAN ** level, leaves) - 1
    before, up = 0, last
    while up:
        before, up = before + up, up // FAN
    return before + level


@cache
def positions(leaves: int, levels: int) -> list[list[int]]:
    """Positions of all nodes, level by level."""
    return [[position(k, i, leaves) for i in range(-(-leaves // FAN ** k))] for k in range(levels + 1)]


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def append_log(leaves: list[str], levels: int) -> list[str]:
    """All nodes of a builder in the order in which they complete; the root is the last."""
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(levels)]
    for at, node in enumerate(leaves):
        log.append(node)
        for run in open_runs:
            run.append(node)
            if len(run) < FAN and at + 1 < len(leaves):
                break
            node = digest(*run)
            run.clear()
            log.append(node)
    return log


def steps(log: str, leaves: int, levels: int) -> list[list[tuple[str, str]]]:
    """For every leaf of a log (hex digests back to back) its path within the builder: (left, right) siblings a level."""
    at = positions(leaves, levels)
    nodes = [[log[64 * p:64 * p + 64] for p in level] for level in at[:levels]]
    sides = [[("".join(level[i - i % FAN:i]), "".join(level[i + 1:i - i % FAN + FAN])) for i in range(len(level))] for level in nodes]
    return [[side[j // FAN ** k] for k, side in enumerate(sides)] for j in range(leaves)]


# --- building


@dataclass
class Forest:
    """Segments of the logs, a table for each stage: tree, n (leaves of the tree), block, nodes, root, and in stage 0 items."""

    stages: list[DataFrame]

    @staticmethod
    def alone(stage: int) -> Column:
        """Segments that are their tree's only one in this stage, and so hold its root."""
        return F.col("n") <= SPAN ** (stage + 1)

    def roots(self) -> DataFrame:
        """(tree, root) of every tree."""
        out = [x.where(self.alone(s) & (F.col("n") > (SPAN ** s if s else 0))).select("tree", "root") for s, x in enumerate(self.stages)]
        done = out[0]
        for x in out[1:]:
            done = done.unionByName(x)
        return done


def _builder(stage: int):
    """Build segments from rows (tree, n, rank, leaf, item) that come sorted by tree and rank, whole blocks to a task."""

    def segment(tree: str, n: int, block: int, leaves: list[bytes]) -> tuple:
        log = append_log([x.hex() for x in leaves], folds(-(-n // SPAN ** stage)))
        return tree, n, block, bytes.fromhex("".join(log)), bytes.fromhex(log[-1])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def emit(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch | None, pa.Table | None]:
            rows = rows.combine_chunks()
            tree, block = rows.column("tree").to_pylist(), rows.column("rank").to_numpy() // SPAN
            cuts = [i for i in range(1, len(tree)) if block[i] != block[i - 1] or tree[i] != tree[i - 1]]
            bounds = [0, *cuts, *([len(tree)] if last else [])]
            if len(bounds) < 2:
                return None, rows
            n, leaves = rows.column("n").to_pylist(), rows.column("leaf").to_pylist()
            made = [segment(tree[a], n[a], int(block[a]), leaves[a:b]) for a, b in zip(bounds, bounds[1:])]
            columns = [pa.array(x, t) for x, t in zip(zip(*made), (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)]
            if stage == 0:
                item = rows.column("item").slice(0, bounds[-1])
                item = item.combine_chunks() if item.num_chunks != 1 else item.chunk(0)
                columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), item))
            return pa.RecordBatch.from_arrays(columns, SEGMENT[:5 + (stage == 0)]), rows.slice(bounds[-1])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            rest = table if rest is None or not rest.num_rows else pa.concat_tables([rest, table])
            made, rest = emit(rest, last=False)
            if made is not None:
                yield made
        if rest is not None and rest.num_rows:
            made, _ = emit(rest, last=True)
            if made is not None:
                yield made

    return build


SEGMENT = ["tree", "n", "block", "nodes", "root", "items"]


def _segments(rows: DataFrame, stage: int) -> DataFrame:
    dealt = rows.withColumn("_block", F.floor(F.col("rank") / SPAN)).repartition("tree", "_block").drop("_block").sortWithinPartitions("tree", "rank")
    kinds = [T.StringType(), T.LongType(), T.LongType(), T.BinaryType(), T.BinaryType()]
    schema = T.StructType([T.StructField(c, k) for c, k in zip(SEGMENT, kinds)])
    if stage == 0:
        schema = schema.add("items", T.ArrayType(rows.schema["item"].dataType))
    return stored(dealt.mapInArrow(_builder(stage), schema))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``rank`` (from 0) by ``order`` within their tree, and ``n``, the tree's rows.

    Equal rows are parted by a salt, so that a row that repeats a million times is dealt to many tasks.
    """
    salted = rows.withColumn("_salt", F.rand(13))
    sorted_rows = stored(salted.repartitionByRange("tree", *order, "_salt").sortWithinPartitions("tree", *order, "_salt").drop("_salt")
                         .withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftright("_at", 33)  # the number of the partition that wrote the row
    seen = sorted_rows.groupBy(task.alias("_task"), "tree").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    of_tree = Window.partitionBy("tree")
    earlier = of_tree.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = seen.select("_task", "tree", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(of_tree).alias("n"))
    placed_rows = sorted_rows.withColumn("_task", task).join(broadcast_if_few(checkpointed(starts)), ["_task", "tree"])
    return placed_rows.withColumn("rank", F.col("_at") + F.col("_shift")).drop("_task", "_at", "_shift")


def build(rows: DataFrame, order: list[str]) -> Forest:
    """The logs of all trees over rows (tree, leaf, item, and the columns of ``order``)."""
    stages = [_segments(placed(rows, order).select("tree", "n", "rank", "leaf", "item"), 0)]
    most = stages[0].agg(F.max("n")).first()[0] or 0
    while most > SPAN ** len(stages):
        s = len(stages)
        nodes = stages[-1].where(~Forest.alone(s - 1)).select("tree", "n", F.col("block").alias("rank"), F.col("root").alias("leaf"))
        stages.append(_segments(nodes, s))
    return Forest(stages)


# --- proofs


def _leaves_of(n: int, stage: int, block: int) -> tuple[int, int]:
    """Leaves of a segment and the levels that it folds."""
    nodes = -(-n // SPAN ** stage)
    return min(SPAN, nodes - block * SPAN), folds(nodes)


def _path_arrays(paths: list[list[tuple[str, str]]]) -> pa.Array:
    flat = [x for p in paths for x in p]
    offs = np.cumsum([0, *(len(p) for p in paths)])
    item = pa.StructArray.from_arrays([pa.array([a for a, _ in flat], pa.string()), pa.array([b for _, b in flat], pa.string())], ["before", "after"])
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), item)


def _with_paths(forest: Forest, tops: DataFrame) -> DataFrame:
    """Segments of stage 0 with ``up``, the path from their root to the top, and the further columns of ``tops`` (tree, up, …)."""
    extra = [c for c in tops.columns if c not in ("tree", "up")]
    down: DataFrame | None = None
    for s in range(len(forest.stages) - 1, -1, -1):
        segments = forest.stages[s].drop("root")  # ``tops`` may have a root of its own, of the top tree
        own = segments.where(Forest.alone(s)).select("tree", "block").join(tops, "tree")
        above = own if down is None else own.unionByName(down)
        if s == 0:
            return segments.join(above, ["tree", "block"])

        def hand_down(batches: Iterator[pa.RecordBatch], s=s) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(batch.num_rows):
                    row = {c: batch.column(c)[r].as_py() for c in ("n", "block", "nodes", "up")}
                    m, levels = _leaves_of(row["n"], s, row["block"])
                    above = [(x["before"], x["after"]) for x in row["up"]]
                    up = _path_arrays([p + above for p in steps(row["nodes"].hex(), m, levels)])
                    same = pa.array(np.full(m, r))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("tree").take(same), pa.array(row["block"] * SPAN + np.arange(m)), up, *(batch.column(c).take(same) for c in extra)],
                        ["tree", "block", "up", *extra])

        schema = T.StructType([T.StructField("tree", T.StringType()), T.StructField("block", T.LongType()), T.StructField("up", PATH), *(tops.schema[c] for c in extra)])
        down = stored(segments.join(above, ["tree", "block"]).select("tree", "n", "block", "nodes", "up", *extra).mapInArrow(hand_down, schema))
    raise AssertionError("a forest has a stage")


def proofs(forest: Forest, tops: DataFrame) -> DataFrame:
    """One row for each leaf: item, leaf (hex), path from the leaf to the top, and the further columns of ``tops``."""
    rows = _with_paths(forest, tops)
    extra = [c for c in tops.columns if c not in ("tree", "up")]
    item = rows.schema["items"].dataType.elementType

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                n, block, up = (batch.column(c)[r].as_py() for c in ("n", "block", "up"))
                m, levels = _leaves_of(n, 0, block)
                log = batch.column("nodes")[r].as_py().hex()
                above = [(x["before"], x["after"]) for x in up]
                paths = [p + above for p in steps(log, m, levels)]
                leaves = [log[64 * p:64 * p + 64] for p in positions(m, levels)[0]]
                same = pa.array(np.full(m, r))
                yield pa.RecordBatch.from_arrays([batch.column("items")[r].values, pa.array(leaves, pa.string()), _path_arrays(paths), *(batch.column(c).take(same) for c in extra)],
                                                 ["item", "leaf", "path", *extra])

    schema = T.StructType([T.StructField("item", item), T.StructField("leaf", T.StringType()), T.StructField("path", PATH), *(tops.schema[c] for c in extra)])
    return rows.select("n", "block", "nodes", "items", "up", *extra).mapInArrow(prove, schema)


def proof_digest(path: Column) -> Column:
    """H of all siblings of a path, from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]).cast("binary"), 256))


@dataclass
class Manifest:
    """The logs of the sources' trees and of the top tree."""

    documents: Forest
    sources: Forest

    def proofs(self) -> DataFrame:
        """For each row: doc_id, leaf, claim (the claimed row's leaf), subroot, root, path."""
        spark = self.documents.stages[0].sparkSession
        nothing = spark.createDataFrame([("", [])], T.StructType([T.StructField("tree", T.StringType()), T.StructField("up", PATH)]))
        root = self.sources.roots().select("tree", F.lower(F.hex("root")).alias("root"))
        of_source = proofs(self.sources, nothing.join(root, "tree"))
        tops = stored(of_source.select(F.col("item.source_key").alias("tree"), F.col("path").alias("up"), F.col("leaf").alias("subroot"), "root"))
        out = proofs(self.documents, tops)
        return out.select("item.doc_id", "leaf", F.lower(F.hex("item.claim")).alias("claim"), "subroot", "root", "path")


def manifest(docs: DataFrame, claim: Column | None = None) -> Manifest:
    """The manifest of a table with the columns of ``FIELDS``. ``claim`` is the leaf (32 bytes) of the row as another holder
    shows it, to be checked against the manifest; by default the row's own."""
    own = leaf()
    rows = stored(docs.select("doc_id", tree_key().alias("tree"), own.alias("leaf"), (own if claim is None else claim).alias("claim")))
    trees = build(rows.select("tree", "doc_id", "leaf", F.struct("doc_id", "claim").alias("item")), ["doc_id", "leaf"])
    tops = trees.roots().select(F.lit("").alias("tree"), F.col("tree").alias("source_key"), F.col("root").alias("leaf"), F.struct(F.col("tree").alias("source_key")).alias("item"))
    return Manifest(trees, build(tops, ["source_key"]))


def verified(docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, path, folded_root (from the claimed leaf) and verified: whether that is the root."""
    got = manifest(docs, claim).proofs()
    return got.withColumn("folded_root", folded(F.col("claim"), F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))


#: The query's SQL: level by level, with the siblings of each row joined by their places.
SQL = """
WITH RECURSIVE bits AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) x(i)) y),
e AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, '') AS key, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT) AS digits FROM documents),
c AS (
  SELECT e.*, xor(list_reduce(list_prepend(4294967295, digits), lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) % 5 = 0 AS tampered FROM e, bits),
f AS (
  SELECT r, doc_id, key, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) AS claim
  FROM (SELECT *, CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS shown FROM c) x),
d AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n FROM f),
node(key, lvl, pos, h, n) AS (
  SELECT key, 0::BIGINT, pos::BIGINT, leaf, n::BIGINT FROM d
  UNION ALL SELECT key, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM node WHERE n > 1 GROUP BY key, lvl, pos // 16, n),
sub AS (SELECT key, h, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
upper_node(lvl, pos, h, n) AS (
  SELECT 0::BIGINT, pos::BIGINT, h, n::BIGINT FROM sub
  UNION ALL SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM upper_node WHERE n > 1 GROUP BY lvl, pos // 16, n),
side AS (
  SELECT d.r, s.lvl, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < d.pos // (16 ** s.lvl)::BIGINT), '') AS b,
    coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > d.pos // (16 ** s.lvl)::BIGINT), '') AS a
  FROM d JOIN node s ON s.key = d.key AND s.n > 1 AND s.pos // 16 = d.pos // (16 ** (s.lvl + 1))::BIGINT GROUP BY d.r, s.lvl
  UNION ALL
  SELECT d.r, 1000 + s.lvl, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < sub.pos // (16 ** s.lvl)::BIGINT), ''),
    coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > sub.pos // (16 ** s.lvl)::BIGINT), '')
  FROM d JOIN sub USING (key) JOIN upper_node s ON s.n > 1 AND s.pos // 16 = sub.pos // (16 ** (s.lvl + 1))::BIGINT GROUP BY d.r, s.lvl),
path AS (SELECT r, list({'b': b, 'a': a} ORDER BY lvl) AS p, string_agg(b || a, '' ORDER BY lvl) AS proof FROM side GROUP BY r),
top AS (SELECT h AS root FROM upper_node WHERE n = 1),
out AS (
  SELECT d.doc_id, leaf, sub.h AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
    coalesce(list_reduce(list_prepend({'b': claim, 'a': ''}, p), lambda x, s: {'b': sha256(s.b || x.b || s.a), 'a': ''}).b, claim) AS folded_root
  FROM d JOIN sub USING (key) LEFT JOIN path USING (r), top)
SELECT *, folded_root = root AS verified FROM out
"""
