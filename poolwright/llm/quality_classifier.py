"""Quality classifier by co-training two views of a document.

The text view sees hashed words, their beginnings and their shapes, as shares of the whole text's words; the metadata
view sees language, source and the stated number of characters. Either view is a logistic regression.
Two labels are learnt in this way: good quality, and toxic. Both views are fitted to labelled documents. Then the
unlabelled documents, all of them, are dealt by hash into shards of a fixed size; in each round each view labels those
of a shard that it is sure about (calibrated probability beyond ``SURE``), and the other view learns from all of those
too. Spark averages the shards' weights by their documents. Labelled documents kept aside calibrate both views and
weigh them into one probability of either label; a document is kept if it is at least ``KEEP`` for good quality, and
under ``TOXIC`` for toxic.

The labelled sample is bounded: ``LABELLED`` documents, those with the smallest hash of their id, reach the driver (at
most ``sum(VIEW_SIZES)`` numbers each) and every task. Other labelled documents count as unlabelled. Documents that are alike
in all features take part in the exchange once: copies leave each map task once and a shard takes one of them. Every document is scored.

Null language, source or n_chars are values of their own. A document without a word (or text) has score 0 for either
label, is not kept, and takes no part in the exchange. A document with several labels counts by their mean, from a half on as 1; null
labels don't count, and a missing column of labels is null. If either class of a label is missing, no document is rejected for it and its scores are
null. Repeated rows are scored alike; an empty table gives no rows; further columns are ignored, or handed on by ``keep_good``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, lower_bytes, mix, slices, span_hashes, text_bytes, word_spans

#: the labels that are learnt: 1 is good quality, 1 is toxic
TARGETS = ("quality", "toxic")
LABELLED = 6000  # labelled documents that the fit sees
POOL, POOL_BYTES = 8000, 32 << 20  # unlabelled documents of a shard, and their bytes, whichever gives more shards
SLICE_ROWS = 500  # of a shard that are unpacked at once
ENTRIES = 1 << 18  # of sparse rows that are worked on at once
COUNTED_BYTES = 1 << 18  # of a text at most, as its features are bounded
WORD_BITS, DIM = 15, 13  # words are hashed to 2**WORD_BITS columns, beginnings, shapes and metadata to 2**DIM each; all fit 16 bits
VIEW_SIZES = ((1 << WORD_BITS) + (2 << DIM), 1 << DIM)
TERMS = 3  # features of a word
BEGINNING = 5  # bytes
PACKED = ("tc", "tn", "mc")
ROUNDS = 3
SURE = 0.97
PENALTY = 1e-4
FIT_STEPS = 120
ROUND_STEPS = 25
KEEP = 0.5
TOXIC = 0.5

_SHAPE = np.arange(256, dtype=np.uint64)
_SHAPE[97:123] = ord("a")
_SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")
_PUNCTUATION = _SHAPE == np.arange(256)
_PUNCTUATION[[ord("a"), ord("A"), ord("0")]] = False


class Sparse(NamedTuple):
    """Rows of sparse features: entries of row i are at ptr[i]:ptr[i + 1]. Columns take 16 bits each.

    What is worked out of the entries is made for ``ENTRIES`` of them at a time, so that it stays small beside them.
    """

    ptr: np.ndarray
    col: np.ndarray
    val: np.ndarray

    def runs(self) -> Iterator[tuple[int, int]]:
        """Row ranges of about ``ENTRIES`` entries (one long row may exceed it)."""
        a, n = 0, len(self.ptr) - 1
        while a < n:
            b = max(a + 1, int(np.searchsorted(self.ptr, self.ptr[a] + ENTRIES, side="right")) - 1)
            yield a, b
            a = b

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.ptr) - 1)
        for a, b in self.runs():
            at = self.ptr[a:b + 1] - self.ptr[a]
            total = np.zeros(at[-1] + 1)
            np.cumsum(w[self.col[self.ptr[a]:self.ptr[b]]] * self.val[self.ptr[a]:self.ptr[b]], out=total[1:])
            out[a:b] = total[at[1:]] - total[at[:-1]]
        return out

    def sums(self, x: np.ndarray, size: int) -> np.ndarray:
        """The sum of the rows, each ``x`` times, by column."""
        out = np.zeros(size)
        for a, b in self.runs():
            if x[a:b].any():
                part = slice(self.ptr[a], self.ptr[b])
                out += np.bincount(self.col[part], weights=self.val[part] * np.repeat(x[a:b], np.diff(self.ptr[a:b + 1])), minlength=size)
        return out

    def pick(self, rows: np.ndarray) -> Sparse:
        lens = np.diff(self.ptr)[rows]
        ptr = np.append(0, np.cumsum(lens))
        col, val = np.empty(ptr[-1], self.col.dtype), np.empty(ptr[-1], self.val.dtype)
        for a, b in Sparse(ptr, col, val).runs():
            take = np.arange(ptr[a], ptr[b]) + np.repeat(self.ptr[rows[a:b]] - ptr[a:b], lens[a:b])
            col[ptr[a]:ptr[b]], val[ptr[a]:ptr[b]] = self.col[take], self.val[take]
        return Sparse(ptr, col, val)


def text_terms(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The feature numbers of a word (hashed word, its beginning, its shape) of all texts, and the first word of each text."""
    buf, bounds = text_bytes(col)
    starts, ends, first = word_spans(buf, bounds)
    if len(starts) == 0:
        return np.zeros((0, TERMS), np.int64), first
    bare = ends.copy()  # without the punctuation behind it
    for _ in range(3):
        bare -= (bare - starts > 1) & _PUNCTUATION[buf[bare - 1]]
    small = lower_bytes(buf)
    words = (span_hashes(small, starts, bare) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    begins = (span_hashes(small, starts, np.minimum(bare, starts + BEGINNING)) >> np.uint64(64 - DIM)).astype(np.int64) + (1 << WORD_BITS)
    # a word's shape: kinds of its first and of its last three bytes, and whether it repeats the word before
    shape = _SHAPE[buf]
    code = shape[starts]
    for k in (1, 2, 3):
        code = code * np.uint64(256) + np.where(ends - k >= starts, shape[np.maximum(ends - k, 0)], 0)
    same = np.zeros(len(starts), bool)
    same[1:] = words[1:] == words[:-1]
    code = code * np.uint64(2) + same.astype(np.uint64)
    shapes = (mix(code) >> np.uint64(64 - DIM)).astype(np.int64) + (1 << WORD_BITS) + (1 << DIM)
    return np.column_stack((words, begins, shapes)), first


def text_counts(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's words, where its features begin, the features, and how often each stands."""
    terms, first = text_terms(col)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    key, count = np.unique(np.repeat(doc, TERMS) * VIEW_SIZES[0] + terms.ravel(), return_counts=True)
    return np.diff(first), np.searchsorted(key // VIEW_SIZES[0], np.arange(len(first))), (key % VIEW_SIZES[0]).astype(np.uint16), count


def text_features(col: pa.Array) -> Sparse:
    words, ptr, cols, count = text_counts(col)
    return Sparse(ptr, cols, np.sqrt(count / np.repeat(words, np.diff(ptr))))


def meta_features(lang: list, source: list, n_chars: list) -> Sparse:
    """Hashed language, source, size class, and pairs of them."""
    import zlib

    out = []
    for a, b, n in zip(lang, source, n_chars):
        size = "-" if n is None else str(int(2 * np.log2(max(int(n), 1))))
        for x in (f"l{a}", f"s{b}", f"n{size}", f"l{a}n{size}", f"s{b}l{a}"):
            out.append(zlib.crc32(x.encode()) >> (32 - DIM))
    n = len(lang)
    return Sparse(np.arange(n + 1) * 5, np.array(out, np.uint16), np.full(5 * n, 0.5))


def _sigmoid(s: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(s, -40, 40)))


def _linear(x: Sparse, w: np.ndarray) -> np.ndarray:
    return x.dot(w[:-1]) + w[-1]


def fit_logistic(xs: list[Sparse], y: np.ndarray, size: int, weight: np.ndarray | None = None, start: np.ndarray | None = None, steps: int = FIT_STEPS) -> np.ndarray:
    """Weights and, last, the bias: full-batch Adam on the penalised log-loss, classes weighed alike. From a start, its steps get smaller.

    ``xs``: the rows, in parts that stand one after the other.
    """
    weight = np.ones(len(y)) if weight is None else weight
    for c in (0, 1):
        weight = np.where(y == c, weight / max(weight[y == c].sum(), 1e-9), weight)
    w, m, v = np.zeros(size + 1) if start is None else start.copy(), np.zeros(size + 1), np.zeros(size + 1)
    cuts = np.cumsum([len(x.ptr) - 1 for x in xs])[:-1]
    for t in range(1, steps + 1):
        rate = 0.3 if start is None else 0.1 * (1 - (t - 1) / steps)
        err = weight * (_sigmoid(np.concatenate([_linear(x, w) for x in xs])) - y)
        g = np.append(sum(x.sums(e, size) for x, e in zip(xs, np.split(err, cuts))), err.sum())
        g[:-1] += PENALTY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w


def fit_platt(s: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression of few columns (the last of ones), by Newton steps with a small ridge."""
    x = np.column_stack((s, np.ones(len(y))))
    y = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        w = w - np.linalg.solve(h, x.T @ (p - y) + 1e-2 * w)
    return w


class Target(NamedTuple):
    """What tells one label: the weights of both views, their calibration, and how they are put together."""

    text: np.ndarray
    meta: np.ndarray
    text_cal: np.ndarray
    meta_cal: np.ndarray
    both: np.ndarray

    def scores(self, text: Sparse, meta: Sparse) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of the label: by text, by metadata, by both."""
        ct, cm = (cal[0] * _linear(x, w) + cal[1] for x, w, cal in ((text, self.text, self.text_cal), (meta, self.meta, self.meta_cal)))
        return _sigmoid(ct), _sigmoid(cm), _sigmoid(self.both[0] * ct + self.both[1] * cm + self.both[2])


class Sample(NamedTuple):
    """The labelled documents: both views, a row of labels (0, 1, or -1: none) for each target, and which are for calibration only."""

    views: tuple[Sparse, Sparse]
    y: np.ndarray
    aside: np.ndarray

    def own(self, target: int) -> np.ndarray:
        return np.flatnonzero((self.y[target] >= 0) & ~self.aside[target])

    def calibrated(self, target: int, k: int, w: np.ndarray) -> np.ndarray:
        test = np.flatnonzero((self.y[target] >= 0) & self.aside[target])
        return fit_platt(_linear(self.views[k].pick(test), w), self.y[target][test].astype(float))


def exchange(sample: Sample, target: int, start: list[np.ndarray], pool: tuple[Sparse, Sparse]) -> list[np.ndarray]:
    """Weights of both views after the rounds over one shard of unlabelled documents, from those fitted to the labels alone."""
    own = sample.own(target)
    y = sample.y[target][own].astype(float)
    known = [sample.views[k].pick(own) for k in (0, 1)]
    weights, given = list(start), [np.full(len(pool[0].ptr) - 1, -1) for _ in (0, 1)]
    for _ in range(ROUNDS):
        for k in (0, 1):
            cal = sample.calibrated(target, k, weights[k])
            p = _sigmoid(cal[0] * _linear(pool[k], weights[k]) + cal[1])
            sure = np.where(p >= SURE, 1, np.where(p <= 1 - SURE, 0, -1))
            given[1 - k] = np.where(given[1 - k] >= 0, given[1 - k], sure)
        for k in (0, 1):
            rows = np.flatnonzero(given[k] >= 0)
            new = given[k][rows].astype(float)
            # the pseudo-labels of a class weigh at most as much as its labels
            share = [min(1.0, (y == c).sum() / max((new == c).sum(), 1)) for c in (0, 1)]
            weight = np.append(np.ones(len(y)), np.where(new == 1, share[1], share[0]))
            weights[k] = fit_logistic([known[k], pool[k].pick(rows)], np.append(y, new), VIEW_SIZES[k], weight, weights[k], ROUND_STEPS)
    return weights


def _features(batches: Iterator[pa.RecordBatch], keep: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """``keep``, then the features: text columns (16 bits each), how often each stands (32 bits), metadata columns (16 bits)."""
    for whole in batches:
        for batch in slices(whole):
            words, at, cols, counts = text_counts(batch.column("text"))
            cols, counts = cols.astype("<u2"), counts.astype("<u4")
            meta = meta_features(*(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars"))).col.astype("<u2")
            packed = [[x[a:b].tobytes() for a, b in zip(ends, ends[1:])] for x, ends in ((cols, at), (counts, at), (meta, np.arange(len(words) + 1) * 5))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x, pa.binary()) for x in packed)], names=[*keep, *PACKED])


def _digests(packed: pa.RecordBatch) -> np.ndarray:
    """16 bytes for each row of features; those of alike rows are alike."""
    return np.array([hashlib.blake2b(b"".join(r), digest_size=16).digest() for r in zip(*(c.to_pylist() for c in packed.columns))], "S16")


def _views(got: pa.Table | pa.RecordBatch) -> tuple[Sparse, Sparse]:
    """Both views of rows as packed by ``_features``."""
    (cols, at), (counts, _), (meta, _) = (text_bytes(got[c]) for c in PACKED)
    text = Sparse(at // 2, np.frombuffer(cols.tobytes(), "<u2"), np.empty(at[-1] // 2))
    for a, b in text.runs():
        ptr = text.ptr[a:b + 1] - text.ptr[a]
        count = np.frombuffer(counts[2 * at[a]:2 * at[b]].tobytes(), "<u4").astype(float)
        total = np.append(0.0, np.cumsum(count))
        words = (total[ptr[1:]] - total[ptr[:-1]]) / TERMS
        text.val[text.ptr[a]:text.ptr[b]] = np.sqrt(count / np.repeat(words, np.diff(ptr)))
    return text, Sparse(np.arange(got.num_rows + 1) * 5, np.frombuffer(meta.tobytes(), "<u2"), np.full(5 * got.num_rows, 0.5))


def _distinct_views(batches: list[pa.RecordBatch]) -> tuple[Sparse, Sparse]:
    """Both views of the rows, alike ones once, in an order of their own: so sums come out alike however the rows were shuffled.

    A slice after the other goes to its place, so that beside the packed rows there are only the views.
    """
    first = np.unique(np.concatenate([_digests(b) for b in batches]), return_index=True)[1]
    lens = np.concatenate([np.diff(text_bytes(b.column("tc"))[1]) // 2 for b in batches])
    ptr = np.append(0, np.cumsum(lens[first]))
    text = Sparse(ptr, np.empty(ptr[-1], np.uint16), np.empty(ptr[-1]))
    meta = Sparse(np.arange(len(first) + 1) * 5, np.empty(5 * len(first), np.uint16), np.full(5 * len(first), 0.5))
    to = np.full(len(lens), -1)
    to[first] = np.arange(len(first))
    for b, upto in zip(batches, np.cumsum([b.num_rows for b in batches])):
        mine = to[upto - b.num_rows:upto]
        new = np.flatnonzero(mine >= 0)
        mine, (a, c) = mine[new], (x.pick(new) for x in _views(b))
        at = np.arange(a.ptr[-1]) + np.repeat(ptr[mine] - a.ptr[:-1], np.diff(a.ptr))
        text.col[at], text.val[at] = a.col, a.val
        meta.col.reshape(-1, 5)[mine] = c.col.reshape(-1, 5)
    return text, meta


def labelled_sample(docs: DataFrame, known: DataFrame) -> Sample:
    """``known``: at most LABELLED rows of doc_id and the targets' labels."""
    kind = dict(docs.dtypes)["doc_id"]
    one = docs.select("doc_id", "text", "lang", "source", "n_chars").join(F.broadcast(known), "doc_id")
    schema = f"doc_id {kind}, {', '.join(f'{t} int' for t in TARGETS)}, {', '.join(f'{c} binary' for c in PACKED)}"
    each = one.mapInArrow(lambda batches: _features(batches, ("doc_id", *TARGETS)), schema)
    # one row of each id reaches the driver; which of several, and the order of rows, must not depend on the partitions
    least = each.groupBy("doc_id").agg(F.min(F.struct(*PACKED, *TARGETS)).alias("r"))
    got = least.select("doc_id", "r.*").toArrow().sort_by("doc_id")
    y = np.array([got[t].to_numpy() for t in TARGETS])
    aside = np.zeros(y.shape, bool)
    for k in range(len(TARGETS)):
        for c in (0, 1):
            aside[k, np.flatnonzero(y[k] == c)[::4]] = True  # a quarter of each class
    return Sample(_views(got), y, aside)


def co_train(sample: Sample, free: DataFrame) -> list[Target | None]:
    """The targets; None for one of which a class has under two labelled documents. ``free``: shard and features of the unlabelled documents."""
    use = [k for k in range(len(TARGETS)) if min((sample.y[k] == c).sum() for c in (0, 1)) >= 2]
    first = {}
    for t in use:
        own = sample.own(t)
        first[t] = [fit_logistic([sample.views[k].pick(own)], sample.y[t][own].astype(float), VIEW_SIZES[k]) for k in (0, 1)]
    weights = dict(first)
    if use:
        shared = free.sparkSession.sparkContext.broadcast((tuple(sample), first))  # LABELLED documents and their weights

        def run(shard: pa.Table) -> pa.Table:
            told, start = shared.value
            pool = _distinct_views(shard.select(PACKED).to_batches(max_chunksize=SLICE_ROWS))
            parts = [(t, k, w) for t in start for k, w in enumerate(exchange(Sample(*told), t, start[t], pool))]
            return pa.table({"part": pa.array([2 * t + k for t, k, _ in parts], pa.int32()), "w": pa.array([w for *_, w in parts], pa.list_(pa.float64())),
                             "n": pa.array([float(len(pool[0].ptr) - 1)] * len(parts))})

        got = free.groupBy("shard").applyInArrow(run, "part int, w array<double>, n double")
        each = got.select("part", "n", F.posexplode("w").alias("at", "x")).groupBy("part", "at").agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("x"))
        mean = each.toPandas().sort_values(["part", "at"])
        if len(mean):
            weights = {t: [mean.loc[mean["part"] == 2 * t + k, "x"].to_numpy() for k in (0, 1)] for t in use}
    out: list[Target | None] = [None] * len(TARGETS)
    for t in use:
        test = np.flatnonzero((sample.y[t] >= 0) & sample.aside[t])
        cals = [sample.calibrated(t, k, weights[t][k]) for k in (0, 1)]
        cols = [cals[k][0] * _linear(sample.views[k].pick(test), weights[t][k]) + cals[k][1] for k in (0, 1)]
        out[t] = Target(*weights[t], *cals, fit_platt(np.column_stack(cols), sample.y[t][test].astype(float)))
    return out


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, label of each target or -1) of at most LABELLED labelled documents, those of smallest hash."""
    has = [t for t in TARGETS if t in labels.columns]
    of = lambda t: F.coalesce((F.avg(t) >= 0.5).cast("int"), F.lit(-1)) if t in has else F.lit(-1)
    given = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[of(t).alias(t) for t in TARGETS])
    return given.where(F.greatest(*TARGETS) >= 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)


def unlabelled_features(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(shard, features) of all documents with a word that aren't among the known, of those alike about one a task."""
    size = F.least(F.octet_length("text"), F.lit(COUNTED_BYTES)).cast("long")
    rows, total = docs.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    shards = max(1, -(-rows // POOL), -(-total // POOL_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # 16 bytes for each document of the task
        for batch in _features(batches, ()):
            new = []
            for key, cols in zip(_digests(batch).tolist(), batch.column(0)):
                new.append(key not in seen and len(cols.as_py()) > 0)
                seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    free = docs.join(F.broadcast(known.select("doc_id")), "doc_id", "left_anti").select("text", "lang", "source", "n_chars")
    packed = free.mapInArrow(run, ", ".join(f"{c} binary" for c in PACKED))
    return packed.select(F.pmod(F.xxhash64(*PACKED), F.lit(shards)).alias("shard"), *PACKED)


def train(docs: DataFrame, labels: DataFrame) -> list[Target | None]:
    known = checkpointed(known_labels(labels))
    return co_train(labelled_sample(docs, known), unlabelled_features(docs, known))


def _scored(docs: DataFrame, labels: DataFrame, payload: Column) -> DataFrame:
    """``payload`` as _row, and _s: the scores by text, by metadata and by both, the toxic score, and whether the row is kept.

    Only the four columns that are read go to Python; the payload stays with Spark.
    """
    targets = train(docs, labels)
    names = ("text_score", "meta_score", "score", "toxic_score")
    if not any(targets):
        nothing = [F.lit(None).cast("double").alias(c) for c in names]
        return docs.select(payload.alias("_row"), F.struct(*nothing, F.lit(True).alias("kept")).alias("_s"))
    shared = docs.sparkSession.sparkContext.broadcast([t and tuple(t) for t in targets])  # 2 * sum(VIEW_SIZES) numbers, about

    @F.arrow_udf(f"struct<{', '.join(f'{c}: double' for c in names)}, kept: boolean>")
    def scores(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        quality, toxic = (t and Target(*t) for t in shared.value)
        parts = []
        for batch in slices(pa.RecordBatch.from_arrays([text, lang, source, n_chars], names=["text", "lang", "source", "n_chars"])):
            x, meta = text_features(batch.column("text")), meta_features(*(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")))
            empty, kept = np.diff(x.ptr) == 0, np.ones(batch.num_rows, bool)
            got = [np.full(batch.num_rows, np.nan) for _ in names]  # nan: no such target
            if quality:
                got[:3] = [np.where(empty, 0.0, s) for s in quality.scores(x, meta)]
                kept &= got[2] >= KEEP
            if toxic:
                got[3] = np.where(empty, 0.0, toxic.scores(x, meta)[2])
                kept &= got[3] < TOXIC
            parts.append([*got, kept])
        cols = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0)] * len(names) + [np.zeros(0, bool)]
        return pa.StructArray.from_arrays([*(pa.array(x, pa.float64(), from_pandas=True) for x in cols[:-1]), pa.array(cols[-1])], names=[*names, "kept"])

    return docs.select(payload.alias("_row"), scores("text", "lang", "source", "n_chars").alias("_s"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, text_score, meta_score, score (probabilities of good quality), toxic_score and kept."""
    return _scored(docs, labels, F.col("doc_id")).select(F.col("_row").alias("doc_id"), "_s.*")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return _scored(docs, labels, row).where("_s.kept").select("_row.*")
