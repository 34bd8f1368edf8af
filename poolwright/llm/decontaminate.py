"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over every training text.

Words are runs of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased. A window is ``WINDOW``
consecutive words of a benchmark item; an item of fewer words, but not none, is one window. The windows of a part of
the benchmark, their 64-bit hashes sorted, their normalised words and the items that hold them, are broadcast.
A document's windows of each length that the part has are looked up by hash, and a hit counts only if its bytes equal
the item's. Texts are scanned whole, in slices of rows, with no shuffle.

The broadcast is bounded: the benchmark is dealt into as many parts (by a hash of the item's text) as keep each under ``PART_BYTES``
of text, or to a single item, and the documents pass all parts one after the other, taking what was hit so far along. An
item is wholly in one part, so the result doesn't depend on the parts. Between parts the documents are written once.

Defined results: a null or empty text, or one without words, has no words and no hits and stays; an item without words
has no windows; items that repeat an id count once for a document; an item with null id marks what it hits but is neither counted
nor listed. Repeated documents each get a row; null doc_ids are kept. An empty benchmark hits nothing, an empty table
gives no rows. Further columns of documents stay as they are; a column named like an output gives way to the output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lower_bytes, mix, slices, span_hashes, stored, text_bytes, word_spans

WINDOW = 10
#: bytes of benchmark text whose windows are broadcast at a time; arrays take about five times that
PART_BYTES = 4 << 20
#: bytes of hits that are compared at a time
VERIFY_BYTES = 4 << 20

_OUTSIDE = np.zeros(256, bool)
_OUTSIDE[0x00:0x30] = _OUTSIDE[0x3A:0x61] = _OUTSIDE[0x7B:0x80] = True
_MUL = np.uint64(0x9E3779B97F4A7C15)

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]), False)
FOUND = T.StructType([T.StructField("n_words", T.LongType(), False), T.StructField("n_hit", T.LongType(), False),
                      T.StructField("items", T.ArrayType(T.LongType(), False), False), T.StructField("spans", SPANS, False)])


class Words:
    """The words of some rows: where they stand, their hashes, and their bytes joined by single blanks."""

    def __init__(self, text: pa.Array):
        raw, offsets = text_bytes(text)
        low = lower_bytes(raw)
        self.starts, self.ends, self.first = word_spans(low, offsets, _OUTSIDE)
        self.offsets = offsets
        self.hashes = span_hashes(low, self.starts, self.ends)
        lens = self.ends - self.starts
        #: where each word begins in ``flat``; a word is followed by one blank
        self.at = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens + 1, out=self.at[1:])
        self.flat = np.full(self.at[-1], 32, np.uint8)
        inside = np.ones(self.at[-1], bool)
        inside[self.at[1:] - 1] = False
        keep = np.zeros(len(low) + 1, np.int8)
        np.add.at(keep, self.starts, 1)
        np.add.at(keep, self.ends, -1)
        self.flat[inside] = low[np.cumsum(keep[:-1], dtype=np.int8).astype(bool)]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the windows of ``size`` words; none crosses a row."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            h = np.zeros(n, np.uint64)
            for k in range(size):
                h = h * _MUL + self.hashes[k:k + n]
        inside = np.ones(n, bool)
        for back in range(1, size):  # a window that starts fewer than ``size`` words before a row's first word crosses
            at = self.first[1:-1] - back
            inside[at[(at >= 0) & (at < n)]] = False
        ok = np.flatnonzero(inside)
        return ok, mix(h[ok] ^ np.uint64(size))


class Index:
    """The windows of some items: one entry for each distinct window, with the items that hold it."""

    def __init__(self, ids: np.ndarray, named: np.ndarray, text: pa.Array):
        words = Words(text)
        self.flat, parts = words.flat, []
        counts = np.diff(words.first)
        for size in range(1, WINDOW + 1):
            at, h = words.windows(size)
            row = np.searchsorted(words.first, at, side="right") - 1
            mine = np.ones(len(at), bool) if size == WINDOW else counts[row] == size
            parts.append((h[mine], words.at[at[mine]], words.at[at[mine] + size] - 1, row[mine], np.full(int(mine.sum()), size)))
        h, a, b, row, size = (np.concatenate(x) for x in zip(*parts, strict=True))
        # equal windows are equal bytes, not equal hashes: windows that share a hash are told apart by their bytes
        keys = np.array([self.flat[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)], object)
        order = np.array(sorted(range(len(h)), key=lambda i: (h[i], keys[i], row[i])), np.int64)
        h, a, b, row, size, keys = h[order], a[order], b[order], row[order], size[order], keys[order]
        fresh = np.ones(len(h), bool)
        if len(h):
            fresh[1:] = (h[1:] != h[:-1]) | (keys[1:] != keys[:-1])
        heads = np.flatnonzero(fresh)
        self.hashes, self.start, self.end = h[heads], a[heads].astype(np.int64), b[heads].astype(np.int64)
        self.sizes = sorted(set(size.tolist()))
        #: items of window w: items[bounds[w]:bounds[w + 1]], ids of named rows only
        owner = np.cumsum(fresh) - 1
        own = named[row] if len(row) else np.zeros(0, bool)
        pairs = np.unique(np.stack([owner[own], ids[row[own]]], axis=1), axis=0) if own.any() else np.zeros((0, 2), np.int64)
        self.items = pairs[:, 1].astype(np.int64)
        self.bounds = np.searchsorted(pairs[:, 0], np.arange(len(heads) + 1))

    def find(self, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence of a window of ``size`` words, verified on the bytes."""
        at, h = words.windows(size)
        lo = np.searchsorted(self.hashes, h, side="left")
        ok = lo < len(self.hashes)
        ok[ok] = self.hashes[lo[ok]] == h[ok]
        at, lo, h = at[ok], lo[ok], h[ok]
        many = np.searchsorted(self.hashes, h, side="right") - lo  # over 1 only where different windows share a hash
        rep = np.repeat(np.arange(len(at)), many)
        win = lo[rep] + (np.arange(len(rep)) - np.repeat(np.cumsum(many) - many, many))
        at = at[rep]
        a, b = words.at[at], words.at[at + size] - 1
        same = (b - a) == (self.end[win] - self.start[win])
        at, win, a, b = at[same], win[same], a[same], b[same]
        lens = b - a
        good = np.zeros(len(at), bool)
        step, done = np.cumsum(lens), 0
        while done < len(at):
            base = step[done - 1] if done else 0
            to = max(done + 1, int(np.searchsorted(step, base + VERIFY_BYTES, side="right")))
            n = lens[done:to]
            heads = np.cumsum(n) - n
            k = np.arange(int(n.sum())) - np.repeat(heads, n)
            differ = words.flat[np.repeat(a[done:to], n) + k] != self.flat[np.repeat(self.start[win[done:to]], n) + k]
            good[done:to] = np.add.reduceat(differ, heads) == 0
            done = to
        return at[good], win[good]


def _scan(index: Index, batch: pa.RecordBatch, had: pa.Array | None) -> pa.RecordBatch:
    words = Words(batch.column("text"))
    n, total = batch.num_rows, len(words.starts)
    hit = np.zeros(total + 1, np.int64)
    rows, items = [], []
    for size in index.sizes:
        at, win = index.find(words, size)
        np.add.at(hit, at, 1)
        np.add.at(hit, at + size, -1)
        row = np.searchsorted(words.first, at, side="right") - 1
        pairs = np.unique(np.stack([row, win], axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
        many = index.bounds[pairs[:, 1] + 1] - index.bounds[pairs[:, 1]]
        rep = np.repeat(np.arange(len(pairs)), many)
        rows.append(pairs[rep, 0])
        items.append(index.items[index.bounds[pairs[rep, 1]] + np.arange(len(rep)) - np.repeat(np.cumsum(many) - many, many)])
    flags = np.cumsum(hit[:-1]) > 0
    if had is not None:  # what earlier parts have hit
        back = np.repeat(np.arange(n), np.diff(had.field("spans").offsets.to_numpy()))
        old = had.field("spans").flatten()
        mark = np.zeros(total + 1, np.int64)
        np.add.at(mark, np.searchsorted(words.starts, old.field("start").to_numpy(zero_copy_only=False) + words.offsets[back]), 1)
        np.add.at(mark, np.searchsorted(words.starts, old.field("end").to_numpy(zero_copy_only=False) + words.offsets[back]), -1)
        flags |= np.cumsum(mark[:-1]) > 0
        rows.append(np.repeat(np.arange(n), np.diff(had.field("items").offsets.to_numpy())))
        items.append(had.field("items").flatten().to_numpy(zero_copy_only=False))
    found = np.unique(np.stack([np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(items or [np.zeros(0, np.int64)])], axis=1), axis=0)
    item_at = np.searchsorted(found[:, 0], np.arange(n + 1))
    sums = np.concatenate(([0], np.cumsum(flags)))
    # runs of words that are hit, cut at rows
    begins = flags.copy()
    begins[1:] &= ~flags[:-1]
    heads = words.first[:-1][words.first[:-1] < total]
    begins[heads] |= flags[heads]
    stops = flags.copy()
    stops[:-1] &= ~flags[1:]
    tails = words.first[1:][words.first[1:] > 0] - 1
    stops[tails] |= flags[tails]
    b, e = np.flatnonzero(begins), np.flatnonzero(stops)
    base = words.offsets[np.searchsorted(words.first, b, side="right") - 1]
    span_at = np.searchsorted(b, words.first)
    long = lambda x: pa.array(x, pa.int64())
    spans = pa.StructArray.from_arrays([long(words.starts[b] - base), long(words.ends[e] - base)], ["start", "end"])
    return pa.StructArray.from_arrays(
        [long(np.diff(words.first)), long(sums[words.first[1:]] - sums[words.first[:-1]]),
         pa.ListArray.from_arrays(pa.array(item_at, pa.int32()), long(found[:, 1])), pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), spans)],
        ["n_words", "n_hit", "items", "spans"])


def _pass(docs: DataFrame, part: DataFrame, keep: list[str]) -> DataFrame:
    """One scan of the documents for the windows of one part of the benchmark."""
    table = part.select("item_id", "text").toArrow()
    ids = table.column("item_id").combine_chunks()
    named = ids.is_valid().to_numpy(zero_copy_only=False)
    index = docs.sparkSession.sparkContext.broadcast(Index(ids.fill_null(0).to_numpy(), named, table.column("text").combine_chunks()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in slices(batch):
                had = x.column("_found") if "_found" in x.schema.names else None
                found = _scan(index.value, x, had)
                yield pa.RecordBatch.from_arrays([*(x.column(c) for c in keep), found], [*keep, "_found"])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("_found", FOUND, False)])
    return docs.mapInArrow(scan, schema)


def parts_of(bench: DataFrame, part_bytes: int = PART_BYTES) -> tuple[DataFrame, int]:
    """The benchmark with a ``_part`` for each item, and how many there are: none over the bound, but for single items."""
    items = bench.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where(F.col("text").isNotNull())
    n = 1 + items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // part_bytes
    while True:
        dealt = items.withColumn("_part", F.pmod(F.xxhash64("text"), F.lit(n)))
        over = dealt.groupBy("_part").agg(F.sum(F.octet_length("text")).alias("b"), F.count_distinct("text").alias("k"))
        if n == 1 or over.where((F.col("b") > part_bytes) & (F.col("k") > 1)).isEmpty():
            return dealt.dropDuplicates(["item_id", "text"]), n
        n *= 2


def scan(docs: DataFrame, bench: DataFrame, keep: tuple[str, ...] | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents (columns ``keep``, all by default) with n_words, n_hit (words inside a window), items (sorted ids
    of the benchmark items hit) and spans (runs of hit words, as byte offsets into the UTF-8 text)."""
    keep = list(docs.columns if keep is None else keep)
    keep = [c for c in keep if c not in FOUND.names and c != "_found"]
    dealt, n = parts_of(bench, part_bytes)
    if n > 1:
        dealt = stored(dealt)
    inner = [*keep, *(["text"] if "text" not in keep else [])]
    rows = docs.select(*inner)
    for part in range(n):
        last = part + 1 == n
        rows = _pass(rows, dealt.where(F.col("_part") == part), keep if last else inner)
        if not last:
            rows = stored(rows)
    return rows.select(*keep, "_found.*")


def without_spans(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents with what was hit cut out of the text (a blank stays in its place); documents that lose all their words go."""
    found = scan(docs, bench)
    raw = F.encode("text", "UTF-8")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col("spans.end"))
    ends = F.concat(F.col("spans.start"), F.array(F.octet_length("text").cast("long")))
    piece = lambda a, b: F.decode(F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")), "UTF-8")
    cut = F.array_join(F.zip_with(begins, ends, piece), " ")
    left = found.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words")))
    return left.withColumn("text", F.when(F.col("n_hit") > 0, cut).otherwise(F.col("text"))).select(*docs.columns)


def without_documents(docs: DataFrame, bench: DataFrame, share: float = 0.0) -> DataFrame:
    """The documents of whose words at most ``share`` were hit."""
    return scan(docs, bench).where(F.col("n_hit") <= F.lit(share) * F.col("n_words")).select(*docs.columns)


#: The query's SQL: windows as joined words, hits and items by joins over them.
SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1), lambda i: array_to_string(ws[i:i + 9], ' '))) AS w
  FROM bw WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT k FROM win),
spot AS (
  SELECT r, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw CROSS JOIN sizes WHERE len(ws) >= k) x),
found AS (SELECT r, i, spot.k, item_id FROM spot JOIN win ON spot.w = win.w AND spot.k = win.k),
hit AS (SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest(range(i, i + k)) AS pos FROM found) y GROUP BY r),
item AS (SELECT r, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT r, item_id FROM found WHERE item_id IS NOT NULL) z GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(item.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN item USING (r)
"""
