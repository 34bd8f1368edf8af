"""N-gram Jaccard join of texts by PartEnum signatures, exact.

A text's set holds its distinct shingles of ``words`` words (all words as one, if there are fewer). Equal
sets are one class, and everything below works on classes. Sizes fall into bands; a set belongs to its own
band's instance and, if it may be similar to a set of the next band, to that one's. Within an instance two
similar sets differ in at most k shingles. The shingle domain is cut into n1 ranges of hash values, each into
``parts`` sub-ranges; as n1 is over k / (skip + 1), some range holds at most ``skip`` differences, so of the
subsets that leave out ``skip`` of its sub-ranges one has no difference. Each such subset's shingles make a
signature, so similar sets share one. Some ranges more than needed are made (``spare``): a set with at most
that many ranges with an empty subset has a shared signature that isn't empty, so only the rare sets beyond
that put out signatures of empty subsets, which unlike sets share by chance.

Links: each class is first held against one hub, a class in many large signature groups, that it shares most
signatures with. What links joins components; then, where a signature is shared by several components, the pairs
across them that a histogram of the shingles leaves possible are tested: the nearest ones of each class first,
then all that still lie in different components. So no pair is tested, or put out, only to confirm a known
component, and no link between components is lost. ``links`` instead tests all possible pairs and returns every
link between classes.

Signatures that are shared by the same classes are one group, so copies with a hundred signatures in common make
one row each, not a hundred. Signature groups are read as sorted runs or, where pairs are tested, in blocks of ``BLOCK`` rows by ``BLOCK``,
so no group has to fit into a task. A class is named by a 64-bit hash of its set.

Null, empty and blank texts have no shingles and link with nothing. Rows with null doc_id get a null
component and don't link. Repeated rows are in one component; an empty table gives no rows; other columns are
not read (``keep_one`` hands them on).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_few, checkpointed, lower_bytes, mix, slices, span_hashes, tasks_for, text_bytes, word_spans
from .components import components

BAND = 1.3
HIST = 256
COARSE = 64
FINE, FINE_FROM = 4096, 1024  # a finer histogram of sets of more than so many shingles
BLOCK = 1024
NEAREST = 3
U = np.uint64


class Rule(NamedTuple):
    """Shingles of ``words`` words; a link needs den * intersection >= num * union."""

    words: int = 5
    num: int = 80
    den: int = 100
    parts: int = 2
    skip: int = 1

    def most_apart(self, total: int) -> int:
        """The most shingles in one only of two linked sets whose sizes add up to ``total``."""
        return total - 2 * -(-self.num * total // (self.num + self.den))


class Instance(NamedTuple):
    edges: np.ndarray  # borders of the sub-ranges, as the first hash value of each but the first
    spare: int
    salt: np.ndarray  # one number for each range and subset
    subsets: tuple
    least: int  # least size of a set of the band below that takes part


@lru_cache(maxsize=4096)
def instance(rule: Rule, low: int, high: int) -> Instance | None:
    """None if only equal sets link in this band."""
    k = max(rule.most_apart(2 * high), rule.most_apart(2 * high - 1))
    if k == 0:
        return None
    need, spare = k // (rule.skip + 1) + 1, 0
    while True:  # as many as a set of the band's least size seldom has ranges with an empty subset
        n1 = need + spare
        empty = math.exp(-low * (rule.parts - rule.skip) / (n1 * rule.parts))
        bad = n1 * (1 - (1 - empty) ** len(list(combinations(range(rule.parts), rule.parts - rule.skip))))
        if spare >= min(bad + 3 * math.sqrt(bad) + 1, need):
            break
        spare += 1
    n = n1 * rule.parts
    edges = np.array([(j << 64) // n for j in range(1, n)], U)
    subsets = tuple(combinations(range(rule.parts), rule.parts - rule.skip))
    with np.errstate(over="ignore"):
        salt = mix(np.arange(n1 * len(subsets), dtype=U) + U(high) * U(0x9E3779B97F4A7C15)).reshape(n1, len(subsets))
    return Instance(edges, spare, salt, subsets, -(-rule.num * low // rule.den))


def bands(rule: Rule, size: int) -> list[tuple[int, int]]:
    """The bands (least, largest size) in whose instances a set of this size takes part."""
    ratio = max(BAND, 1.02 * rule.den / rule.num)
    low = 1
    while True:
        high = max(low, int(low * ratio))
        if size <= high:
            break
        low = high + 1
    out = [(low, high)]
    nxt = high + 1
    if size * rule.den >= nxt * rule.num:
        out.append((nxt, max(nxt, int(nxt * ratio))))
    return out


_of_size: dict[tuple[Rule, int], list[Instance]] = {}


def instances(rule: Rule, size: int) -> list[Instance]:
    got = _of_size.get((rule, size))
    if got is None:
        if len(_of_size) > 100_000:
            _of_size.clear()
        got = _of_size[rule, size] = [i for b in bands(rule, size) if (i := instance(rule, *b)) is not None]
    return got


def shingle_sets(rule: Rule, col: pa.Array) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of every text."""
    buf, bounds = text_bytes(col)
    buf = lower_bytes(buf)
    starts, ends, first = word_spans(buf, bounds)
    words = span_hashes(buf, starts, ends)
    out = []
    with np.errstate(over="ignore"):
        m = max(len(words) - rule.words + 1, 0)
        roll = np.zeros(m, U)
        for j in range(rule.words):
            roll = roll * U(0x9E3779B97F4A7C15) + words[j:j + m]
        roll = mix(roll)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= rule.words:
                h = np.sort(roll[a:b - rule.words + 1])
                keep = np.empty(len(h), bool)
                keep[0] = True
                np.not_equal(h[1:], h[:-1], out=keep[1:])
                out.append(h[keep])
            elif b > a:
                h = U(b - a)
                for w in words[a:b]:
                    h = mix(h * U(0xD1342543DE82EF95) + w)
                out.append(np.array([h], U))
            else:
                out.append(np.zeros(0, U))
    return out


def _sums(s: np.ndarray) -> np.ndarray:
    acc = np.zeros(len(s) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum(mix(s ^ U(0x5851F42D4C957F2D)), out=acc[1:])
    return acc


def signatures(rule: Rule, s: np.ndarray) -> np.ndarray:
    """The signatures of a set, over all instances that it takes part in."""
    out = []
    acc = None
    with np.errstate(over="ignore"):
        for i in instances(rule, len(s)):
            acc = _sums(s) if acc is None else acc
            cut = np.empty(len(i.edges) + 2, np.int64)
            cut[0], cut[-1] = 0, len(s)
            cut[1:-1] = np.searchsorted(s, i.edges)
            count = np.diff(cut).reshape(len(i.salt), -1)
            part = (acc[cut[1:]] - acc[cut[:-1]]).reshape(len(i.salt), -1)
            sums = np.column_stack([part[:, list(c)].sum(1, dtype=U) for c in i.subsets])
            full = np.column_stack([count[:, list(c)].sum(1) for c in i.subsets]) > 0
            sig = mix(sums + i.salt)
            out.append(sig[full] if (~full).any(1).sum() <= i.spare else sig.ravel())
    return np.concatenate(out) if out else np.zeros(0, U)


def _node(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(_sums(s)[-1] + U(len(s)) * U(0xD1342543DE82EF95)).astype(np.int64))


def _sketch(s: np.ndarray, bins: int = HIST) -> bytes:
    """A histogram of the set; two sets' histograms differ by no more than the sets (counts stop at 255)."""
    shift = U(64 - (bins.bit_length() - 1))
    return np.minimum(np.bincount((s >> shift).astype(np.int64), minlength=bins), 255).astype(np.uint8).tobytes()


def classes(rule: Rule, docs: DataFrame) -> DataFrame:
    """A row a document: doc_id, n_shingles, node (its class; null without shingles), sketch, fine (null for small sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                sets = shingle_sets(rule, batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([_sketch(s) for s in sets], pa.binary()), pa.array([_sketch(s, FINE) if len(s) > FINE_FROM else None for s in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "node", "sketch", "fine"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_shingles long, node long, sketch binary, fine binary")


def shared_signatures(rule: Rule, docs: DataFrame) -> DataFrame:
    """(sig, node, g, c): groups of classes that share a signature, the group's size, and how many signatures the
    group shares. A group is named by a hash over its classes; were two to get one name, they'd be tested together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task put their signatures out once
        for whole in batches:
            for batch in slices(whole):
                sigs, nodes = [], []
                for s in shingle_sets(rule, batch.column("text")):
                    if len(s) and (node := _node(s)) not in seen:
                        seen.add(node)
                        sigs.append(signatures(rule, s))
                        nodes.append(node)
                if sigs:
                    lens = [len(x) for x in sigs]
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), lens))], names=["sig", "node"])

    rows = docs.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(run, "sig long, node long")
    group = Window.partitionBy("sig")
    rows = rows.withColumns({"lo": F.min("node").over(group), "hi": F.max("node").over(group), "g": F.count("*").over(group),
                             "all": F.bit_xor(F.xxhash64("node")).over(group)})
    return rows.where(F.col("lo") < F.col("hi")).groupBy(F.xxhash64("all", "lo", "hi", "g").alias("sig"), "node", "g").agg(F.count("*").alias("c"))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    step = max(1, (1 << 20) // a.shape[1])
    return np.concatenate([np.abs(a[k:k + step].astype(np.int16) - b[k:k + step]).sum(1) for k in range(0, len(a), step)]) if len(a) else np.zeros(0, np.int64)


def near_enough(rule: Rule, pairs: DataFrame, nodes: DataFrame, histogram: str, bins: int) -> DataFrame:
    """Of the pairs (a, b), those that sizes and histograms leave possible; a pair without one passes.

    ``nodes``: node, n and the histogram.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "ha", 4 << 20):
                known = batch.column("ha").is_valid().to_numpy(zero_copy_only=False) & batch.column("hb").is_valid().to_numpy(zero_copy_only=False)
                here = batch.filter(pa.array(known))
                n, m = here.column("na").to_numpy(), here.column("nb").to_numpy()
                total = n + m
                most = total - 2 * -(-rule.num * total // (rule.num + rule.den))
                of = lambda c: text_bytes(here.column(c))[0].reshape(-1, bins)  # noqa: B023, E731
                good = ~known
                good[known] = (np.minimum(n, m) * rule.den >= np.maximum(n, m) * rule.num) & (_apart(of("ha"), of("hb")) <= most)
                mask = pa.array(good)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    have = nodes.where(F.col(histogram).isNotNull())
    of = lambda c: have.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col(histogram).alias(f"h{c}"))
    return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", "na", "nb", "ha", "hb").mapInArrow(run, "a long, b long")


def verify(rule: Rule, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those whose texts' sets link. ``texts``: node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "ta", 4 << 20):
                left, right = shingle_sets(rule, batch.column("ta")), shingle_sets(rule, batch.column("tb"))
                good = np.zeros(len(left), bool)
                for k, (x, y) in enumerate(zip(left, right)):
                    both = int((np.searchsorted(y, x, side="right") > np.searchsorted(y, x)).sum())
                    good[k] = rule.den * both >= rule.num * (len(x) + len(y) - both)
                mask = pa.array(good)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    rows = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return rows.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _tested(rule: Rule, a: np.ndarray, b: np.ndarray, comp: np.ndarray, n: np.ndarray, hist: np.ndarray, coarse: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs of rows, those of different comps that size and histogram leave possible, and how far apart."""
    ok = comp[a] != comp[b]
    ok &= np.minimum(n[a], n[b]) * rule.den >= np.maximum(n[a], n[b]) * rule.num
    a, b = a[ok], b[ok]
    total = n[a] + n[b]
    most = total - 2 * -(-rule.num * total // (rule.num + rule.den))
    for h in (coarse, hist):
        apart = _apart(h[a], h[b])
        ok = apart <= most
        a, b, most = a[ok], b[ok], most[ok]
    return a, b, apart[ok]


def _block_pairs(rule: Rule, block: pd.DataFrame, nearest: int | None) -> pd.DataFrame:
    block = block.sort_values(["sig", "node"], kind="stable")
    sig, node, comp, n, own = (block[c].to_numpy() for c in ("sig", "node", "comp", "n", "own"))
    i, j = int(block["i"].iloc[0]), int(block["j"].iloc[0])
    hist = np.frombuffer(b"".join(block["sketch"]), np.uint8).reshape(-1, HIST).astype(np.int16)
    coarse = hist.reshape(-1, COARSE, HIST // COARSE).sum(2, dtype=np.int16)
    found = []
    if i == j:  # rows d places apart, for as long as a group has such
        at, d = np.arange(len(sig)), 0
        while len(at):
            d += 1
            at = at[at + d < len(sig)]
            at = at[sig[at + d] == sig[at]]
            found.append(_tested(rule, at, at + d, comp, n, hist, coarse))
    else:  # one large group's rows of two blocks
        right = np.flatnonzero(own == j)
        found = [_tested(rule, np.full(len(right), x), right, comp, n, hist, coarse) for x in np.flatnonzero(own == i)]
    a, b, apart = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    out = pd.DataFrame({"a": np.minimum(node[a], node[b]), "b": np.maximum(node[a], node[b]), "apart": apart.astype(np.int32)}).drop_duplicates()
    if nearest is not None:
        out = out.sort_values(["apart", "a", "b"], kind="stable")
        out = out[(out.groupby("a").cumcount() < nearest) | (out.groupby("b").cumcount() < nearest)]
    return out


def possible_pairs(rule: Rule, members: DataFrame, nodes: DataFrame, nearest: int | None = None) -> DataFrame:
    """(a, b): classes of different comps that share a signature and may link by size and histogram.

    ``members``: sig, node, comp; ``nodes``: node, n, sketch. Small signature groups are taken together, about
    ``BLOCK`` rows a call; large ones are cut into blocks, and each pair of blocks is a call of its own. With
    ``nearest``, only so many of a class's pairs in a call.
    """
    group = Window.partitionBy("sig")
    total = members.count()
    rows = members.withColumns({"g": F.count("*").over(group), "c0": F.min("comp").over(group), "c1": F.max("comp").over(group)})
    rows = rows.where(F.col("c0") < F.col("c1")).withColumn("nb", F.ceil(F.col("g") / BLOCK).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.withColumns({"i": F.least("own", "o"), "j": F.greatest("own", "o")})
    calls = max(64, -(-total // BLOCK))  # so that a call of small groups has about BLOCK rows
    rows = rows.withColumn("call", F.when(F.col("nb") > 1, F.col("sig")).otherwise(F.pmod(F.xxhash64("sig"), F.lit(calls))))
    rows = rows.join(nodes.select("node", "n", "sketch"), "node")

    def test(block: pd.DataFrame) -> pd.DataFrame:
        return _block_pairs(rule, block, nearest)

    rows = rows.select("call", "i", "j", "sig", "node", "comp", "n", "sketch", "own")
    return rows.groupBy("call", "i", "j").applyInPandas(test, "a long, b long, apart int").select("a", "b").distinct()


class Join:
    """The join of one table of documents: what its steps share is kept in checkpoints."""

    def __init__(self, docs: DataFrame, rule: Rule):
        self.rule, self.docs = rule, docs.select("doc_id", "text")
        rows = checkpointed(classes(rule, docs))
        self.rows = rows.drop("sketch", "fine")
        self.shared = checkpointed(shared_signatures(rule, docs))
        first = rows.where(F.col("doc_id").isNotNull() & F.col("node").isNotNull()).groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("fine").alias("fine"))
        #: the classes that share a signature: smallest doc_id, size and histograms
        self.nodes = checkpointed(self.shared.select("node").distinct().join(first, "node"))

    def _texts(self, pairs: DataFrame) -> DataFrame:
        """(node, text) of the classes of the pairs; a repeated doc_id may bring other texts, which their hash tells."""
        rule = self.rule
        asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(self.nodes.select("node", "doc_id"), "node")
        own = broadcast_if_few(checkpointed(asked.select("doc_id", F.col("node").alias("_node"))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for whole in batches:
                for batch in slices(whole):
                    nodes, take = batch.column("_node").to_pylist(), []
                    for k, (s, n) in enumerate(zip(shingle_sets(rule, batch.column("text")), nodes)):
                        if len(s) and n not in seen and _node(s) == n:
                            seen.add(n)
                            take.append(k)
                    if take:
                        yield pa.RecordBatch.from_arrays([pa.array([nodes[k] for k in take], pa.int64()), batch.column("text").take(pa.array(take))], names=["node", "text"])

        return checkpointed(self.docs.join(own, "doc_id").select("_node", "text").mapInArrow(run, "node long, text string"))

    def _linked(self, pairs: DataFrame) -> DataFrame:
        pairs = checkpointed(pairs)
        pairs = pairs.coalesce(tasks_for(pairs.count()))
        pairs = checkpointed(near_enough(self.rule, pairs, self.nodes, "fine", FINE))
        return checkpointed(verify(self.rule, pairs.coalesce(tasks_for(pairs.count())), self._texts(pairs)))

    def _possible(self, comps: DataFrame | None, nearest: int | None = None) -> DataFrame:
        rows = self.shared.select("sig", "node")
        if comps is not None:
            rows = rows.join(comps, "node", "left")
        rows = rows.withColumn("comp", F.col("node") if comps is None else F.coalesce("comp", "node"))
        return possible_pairs(self.rule, rows, self.nodes, nearest)

    def links(self) -> DataFrame:
        """(a, b): every linked pair of different classes, as the smallest doc_id of each."""
        pairs = self._linked(self._possible(None))
        rep = lambda c: self.nodes.select(F.col("node").alias(c), F.col("doc_id").alias(f"r{c}"))
        return pairs.join(rep("a"), "a").join(rep("b"), "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()

    def _star(self) -> DataFrame:
        """(a, b): each class with the hub that it shares most signatures with; a group's hub is its class that is
        in the most and largest groups."""
        weight = self.shared.groupBy("node").agg(F.sum(F.col("g") * F.col("c")).alias("w"))
        rows = self.shared.select("sig", "node", "c").join(weight, "node")
        hub = F.max(F.struct("w", "node")).over(Window.partitionBy("sig"))["node"]
        counts = rows.withColumn("hub", hub).where(F.col("node") != F.col("hub")).groupBy("node", "hub").agg(F.sum("c").alias("c"))
        return counts.groupBy("node").agg(F.max_by("hub", F.struct("c", -F.col("hub"))).alias("b")).select(F.col("node").alias("a"), "b")

    def labels(self) -> DataFrame:
        """(node, comp) of the classes that link with another class."""
        linked = self._linked(near_enough(self.rule, self._star(), self.nodes, "sketch", HIST))
        comps = components(linked)
        for nearest in (NEAREST, None):
            more = self._linked(self._possible(comps, nearest))
            if more.limit(1).count():
                linked = checkpointed(linked.union(more))
                comps = components(linked)
        return comps

    def documents(self) -> DataFrame:
        """doc_id, n_shingles, node, component_id of every row."""
        known = F.col("doc_id").isNotNull() & F.col("node").isNotNull()
        rows = self.rows.select("doc_id", "n_shingles", F.when(known, F.col("node")).alias("node"))
        rows = rows.join(self.labels(), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        rows = checkpointed(rows)
        least = rows.where(F.col("comp").isNotNull()).groupBy("comp").agg(F.min("doc_id").alias("least"))
        out = rows.join(least, "comp", "left")
        return out.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "node")


def jaccard_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    return Join(docs, rule).documents()


def jaccard_links(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    return Join(docs, rule).links()


def keep_one(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component the document of smallest id stays.

    Rows without doc_id or shingles link with nothing and stay; repeated rows of one doc_id are one document.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col("doc_id").alias("_id"), row.alias("_row"))
    known = F.col("_id").isNotNull()
    least = jaccard_components(docs, rule).where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_id")).distinct()
    order = Window.partitionBy("_id").orderBy(F.xxhash64("_row"))
    stay = rows.where(known).join(least, "_id").withColumn("_k", F.row_number().over(order)).where(F.col("_k") == 1)
    return stay.select("_id", "_row").unionByName(rows.where(~known)).select("_row.*")
