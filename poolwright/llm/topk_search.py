"""Exact top-k inner products by dual-tree search over cover trees.

Every component x becomes floor(256 * x). The top of the tree is laid out by Spark: a bounded sample of rows
gives the centres (at most ``CENTRES``), each row belongs to its nearest centre, and large nodes are split into
blocks by a hash of the id. A block's tree is built where it is searched: a node's children are spread by
farthest-first choice until their covering radius is half the node's, with the radii as measured.

For a query node with centre q and radius a, and a data node with centre x and radius b, no inner product is
over q.x + a|x| + b|q| + ab; the pair is pruned if that is under the worst kth score of the node's queries. The
kth best score among the sample rows is a first such bound for every query, so pairs of top nodes are pruned
before anything is sent. Queries go, in packed blocks, to the data blocks that are left; a task gets one data
block and at most ``QUERY_BLOCKS`` packed blocks.

Rows whose vector is null, or holds null or non-finite components, and rows with null id take no part. Vectors
of different lengths aren't compared. Rows that repeat an id and vector count once. Ties go to the smaller id;
an empty table gives no rows; other columns are not read. Scores beyond a long are cut to its range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import checkpointed

K = 5
QUERY_EVERY = 50
CENTRES = 256
SAMPLE = 1024
NODE_ROWS = 4096
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
QUERY_BLOCKS = 16
LEAF = 256
SPREAD = 16
EXACT = float(1 << 53)


def whole_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, v): floor(256 * x) of each component as a double; rows that take part, each once."""
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform("embedding", lambda x: _floor(x.cast("double") * 256))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", scaled.alias("v")).distinct()


def _floor(x: Column) -> Column:
    """floor as a double; doubles from 2**53 on are whole, and a long would not hold them all."""
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-valued doubles; as int64, cut to its range."""
    big = (np.abs(a).max(initial=0.0)) * (np.abs(b).max(initial=0.0)) * max(a.shape[1], 1)
    if big < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    out = whole(a) @ whole(b).T if a.shape[1] else np.zeros((len(a), len(b)), object)
    return np.clip(out, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Node:
    """A cover-tree node: rows, a centre row, the covering radius, children (none for a leaf)."""

    __slots__ = ("rows", "centre", "norm", "radius", "children")

    def __init__(self, v: np.ndarray, rows: np.ndarray, at: int, dist: np.ndarray):
        self.rows, self.centre, self.children = rows, v[at], []
        self.norm = float(np.linalg.norm(v[at]))
        self.radius = float(dist.max(initial=0.0))
        stack = [(self, at, dist)]
        while stack:
            node, own, far = stack.pop()
            if len(node.rows) <= LEAF or node.radius == 0.0:
                continue
            centres, near = [own], far.copy()
            owner = np.zeros(len(node.rows), np.int64)
            while len(centres) < SPREAD and near.max() > node.radius / 2:
                c = int(node.rows[near.argmax()])
                d = np.linalg.norm(v[node.rows] - v[c], axis=1)
                closer = d < near
                owner[closer], near[closer] = len(centres), d[closer]
                centres.append(c)
            for k, c in enumerate(centres):
                mine = owner == k
                child = Node.__new__(Node)
                child.rows, child.centre, child.children = node.rows[mine], v[c], []
                child.norm, child.radius = float(np.linalg.norm(v[c])), float(near[mine].max(initial=0.0))
                node.children.append(child)
                stack.append((child, c, near[mine]))


def cover_tree(v: np.ndarray) -> Node:
    return Node(v, np.arange(len(v)), 0, np.linalg.norm(v - v[0], axis=1))


class DualSearch:
    """Top k of each query over data blocks that come one at a time; kept in no order, smallest ids among equal scores."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, bound: np.ndarray, k: int):
        self.ids, self.v, self.k, self.bound = ids, v, k, bound.astype(float)
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.tree = cover_tree(v)

    def _leaves(self, q: Node, x: Node, ids: np.ndarray, v: np.ndarray) -> None:
        for part in np.array_split(x.rows, max(1, len(x.rows) // 4096)):
            got = inner(self.v[q.rows], v[part])
            score = np.where(self.ids[q.rows][:, None] == ids[part][None, :], -np.inf, got.astype(float))
            hit = (score >= self.bound[q.rows][:, None]).any(1)
            rows = q.rows[hit]
            if len(rows) == 0:
                continue
            # whole scores under 2**53 are exact as floats; larger ones only lose order among near ties
            s = np.concatenate((self.scores[rows], score[hit]), axis=1)
            i = np.concatenate((self.found[rows], np.broadcast_to(ids[part], (len(rows), len(part)))), axis=1)
            kth = np.partition(s, -self.k, axis=1)[:, -self.k]
            best = s >= kth[:, None]
            tied = best.sum(1) > self.k
            plain = ~tied
            self.scores[rows[plain]] = s[plain][best[plain]].reshape(-1, self.k)
            self.found[rows[plain]] = i[plain][best[plain]].reshape(-1, self.k)
            if tied.any():  # of equal scores the smaller ids
                s, i = s[tied], i[tied]
                order = np.lexsort((i, -s), axis=-1)[:, :self.k]
                self.scores[rows[tied]], self.found[rows[tied]] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
            self.bound[rows] = np.maximum(self.bound[rows], kth)

    def search(self, ids: np.ndarray, v: np.ndarray) -> None:
        """Go through one data block, whose tree is built here, once for all queries."""

        def upper(q: Node, x: Node) -> float:
            top = float(q.centre @ x.centre) + q.radius * x.norm + x.radius * q.norm + q.radius * x.radius
            return top + 1e-9 * (abs(top) + q.norm * x.norm + 1.0)

        data = cover_tree(v)
        stack = [(upper(self.tree, data), self.tree, data)]
        while stack:
            top, q, x = stack.pop()
            if top < self.bound[q.rows].min():
                continue
            if not q.children and not x.children:
                self._leaves(q, x, ids, v)
                continue
            if q.children and (not x.children or q.radius >= x.radius):
                pairs = [(upper(c, x), c, x) for c in q.children]
            else:
                pairs = [(upper(q, c), q, c) for c in x.children]
            stack += sorted(pairs, key=lambda p: p[0])  # the most promising pair is taken next


def _matrix(blobs) -> np.ndarray:
    return np.stack([np.frombuffer(b, "<f8") for b in blobs])


def top_k(rows: DataFrame, k: int = K, query_every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose id is divisible by ``query_every``."""
    spark = rows.sparkSession
    out = "query_id long, rank int, vec_id long, score long"
    vectors = checkpointed(whole_vectors(rows).withColumn("dim", F.size("v")).select("vec_id", "dim", "v"))
    total = vectors.count()
    if total == 0:
        return spark.createDataFrame([], out)
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).collect()  # bounded
    wanted = min(CENTRES, max(1, total // NODE_ROWS))
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r.dim, []).append(r)
    centres = {d: np.array([r.v for r in rs[:wanted]], float).reshape(len(rs[:wanted]), d) for d, rs in by_dim.items()}
    probes = {d: (np.array([r.vec_id for r in rs]), np.array([r.v for r in rs], float).reshape(len(rs), d)) for d, rs in by_dim.items()}
    shared = spark.sparkContext.broadcast((centres, probes))  # at most SAMPLE rows

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, probe = shared.value
        for b in batches:
            dims, ids = b.column("dim").to_numpy(), b.column("vec_id").to_numpy()
            flat = b.column("v").flatten().to_numpy()
            offs = np.append(0, np.cumsum(dims))
            node, dist, bound = np.zeros(len(ids), np.int32), np.zeros(len(ids)), np.full(len(ids), -np.inf)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                v = np.stack([flat[offs[i]:offs[i + 1]] for i in at]).reshape(len(at), d)
                c = tops.get(d, np.zeros((1, d)))
                far = np.sqrt(np.maximum((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1), 0))
                node[at] = far.argmin(1)
                dist[at] = np.linalg.norm(v - c[node[at]], axis=1)
                ask = at[ids[at] % query_every == 0]
                if d in probe and len(ask):
                    pid, pv = probe[d]
                    s = np.where(ids[ask][:, None] == pid[None, :], -np.inf, inner(v[np.searchsorted(at, ask)], pv).astype(float))
                    if s.shape[1] >= k:
                        bound[ask] = np.partition(s, -k, axis=1)[:, -k]
            blobs = [flat[offs[i]:offs[i + 1]].astype("<f8").tobytes() for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("dim"), pa.array(node), pa.array(dist), pa.array(bound), pa.array(blobs, pa.binary())],
                                             names=["vec_id", "dim", "node", "dist", "bound", "v"])

    placed = checkpointed(vectors.mapInArrow(assign, "vec_id long, dim int, node int, dist double, bound double, v binary"))
    asks = placed.where(F.col("vec_id") % query_every == 0)
    # one row for each top node: at most CENTRES a vector length
    nodes = [r.asDict() for r in placed.groupBy("dim", "node").agg(F.count("*").alias("n"), F.max("dist").alias("r")).orderBy("dim", "node").collect()]
    heads = [r.asDict() for r in asks.groupBy("dim", "node").agg(F.count("*").alias("n"), F.max("dist").alias("r"), F.min("bound").alias("b")).orderBy("dim", "node").collect()]
    if not heads:
        return spark.createDataFrame([], out)

    def centre(d: int, n: int) -> np.ndarray:
        return centres.get(d, np.zeros((1, d)))[n]

    at, pairs = 0, []
    for h in heads:
        h["blocks"], h["first"] = -(-h["n"] // QUERY_ROWS), at
        at += h["blocks"]
        q = centre(h["dim"], h["node"])
        for x in nodes:
            if x["dim"] != h["dim"]:
                continue
            c = centre(x["dim"], x["node"])
            top = float(q @ c) + h["r"] * float(np.linalg.norm(c)) + x["r"] * float(np.linalg.norm(q)) + h["r"] * x["r"]
            if top + 1e-6 * (abs(top) + 1) >= h["b"]:
                pairs.append((h["dim"], h["node"], x["node"], -(-x["n"] // BLOCK_ROWS)))
    sizes = spark.createDataFrame([(x["dim"], x["node"], -(-x["n"] // BLOCK_ROWS)) for x in nodes], "dim int, node int, blocks int")
    firsts = spark.createDataFrame([(h["dim"], h["node"], h["blocks"], h["first"]) for h in heads], "dim int, node int, blocks int, first int")
    links = spark.createDataFrame(pairs, "dim int, node int, dnode int, blocks int")
    spread = F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int")

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values(["vec_id"], kind="stable")
        return pd.DataFrame([[key[0], key[1], key[2], g["vec_id"].to_numpy("<i8").tobytes(), b"".join(g["v"]), g["bound"].to_numpy("<f8").tobytes()]],
                            columns=["dim", "node", "qb", "ids", "qv", "qbound"])

    packed = asks.join(F.broadcast(firsts), ["dim", "node"]).withColumn("qb", F.col("first") + spread)
    packed = checkpointed(packed.groupBy("dim", "node", "qb").applyInPandas(pack, "dim int, node int, qb int, ids binary, qv binary, qbound binary"))
    # a row of query vectors goes to each block of data that it may find something in; only the shuffle holds those copies
    sent = packed.join(links, ["dim", "node"]).select(
        "dim", F.col("dnode").alias("node"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.floor(F.col("qb") / QUERY_BLOCKS).cast("int").alias("qg"), "qb", "ids", "qv", "qbound")
    keys = ["dim", "node", "block", "qg"]
    meet = sent.select(*keys).distinct()
    data = placed.join(F.broadcast(sizes), ["dim", "node"]).withColumn("block", spread).join(meet, keys[:3])
    data = data.select(*[F.col(c).alias(f"x_{c}") for c in keys], "vec_id", "v")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            left = left.sort_values("vec_id", kind="stable")
            ids, v = left["vec_id"].to_numpy(np.int64), _matrix(left["v"])
            right = right.sort_values("qb")
            qid, bound = np.frombuffer(b"".join(right["ids"]), "<i8"), np.frombuffer(b"".join(right["qbound"]), "<f8")
            s = DualSearch(qid, np.frombuffer(b"".join(right["qv"]), "<f8").reshape(len(qid), v.shape[1]), bound, k)
            s.search(ids, v)
            q, j = np.nonzero(np.isfinite(s.scores))
            found.append(pd.DataFrame({"query_id": qid[q], "vec_id": s.found[q, j], "score": s.scores[q, j]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    best = data.groupBy(*[f"x_{c}" for c in keys]).cogroup(sent.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


#: DuckDB twin of ``top_k`` with the values above.
SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
