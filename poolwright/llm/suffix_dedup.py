"""Removal of repeated byte strings of ``MATCH`` bytes by suffix arrays over content-routed shards.

A byte goes if a string of ``MATCH`` bytes over it also starts earlier: in a document of smaller id, or earlier
in its own. So that equal strings meet, every string (window) is named by the least hash among its ``GRAM``-byte
grams; neighbouring windows mostly share it, so a text gives one entry for some 40 windows. Entries whose
name occurs once in the corpus can't repeat and are dropped; the others send their stretch of text to the
shard of their name. A shard sorts its stretches' suffixes by Larsson-Sadakane refinement (8 bytes first, then
doubling what is still tied, to 128 bytes), and finds common prefixes of neighbours by Kasai's rule that a
prefix loses one byte from a position to the next. Windows in a run of common prefixes of ``MATCH`` bytes
are equal; all but the earliest go.

A name with over ``HOT`` entries, or over ``HEAVY`` in one batch, is spread over several shards. These name the
earliest window of each of their runs by its hash, and the merge finds each name's run in the sorted order by
binary search and lets all but the earliest go. Names are counted where they meet, but a batch sends one row for
a name that it holds often, and its entries go by another way, so a name in a third of all texts is a row a
batch. Equal stretches in a batch, as in periodic texts, stand once, by the earliest; the others go. Equal whole
texts are taken once, by their smallest id; the others go as a whole.

Everything is judged on the input, and matches don't cross documents. Null text is empty. A null doc_id is an
id after all others, ordered by a hash of the text. Repeated rows of one id and text are one document and get
the same result. An empty table gives no rows; other columns are not read (``deduplicated`` hands them on).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, slices, span_hashes, text_bytes

MATCH = 100
GRAM = 24
SPAN = MATCH - GRAM + 1  # grams in a window
HOT = 16_000
HEAVY = 256
#: bytes of input for which a shard is made; about 40 bytes make an entry, and most entries occur once
SHARD_BYTES = 1 << 21
#: bytes whose grams are hashed at once, at some 50 bytes of working memory each
SLICE_BYTES = 1 << 18
U = np.uint64
_TEXT_BITS = 23  # of the text's hash, next to the id


def _grams(buf: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position; the last ones run into padding and aren't used."""
    with np.errstate(over="ignore"):
        q = _words(buf, GRAM)
        n = len(buf)
        return mix(q[:n] * U(0x9E3779B97F4A7C15) + q[8:n + 8] * U(0xD1342543DE82EF95) + q[16:n + 16] * U(0xC2B2AE3D27D4EB4F))


def _words(buf: np.ndarray, pad: int) -> np.ndarray:
    """The 8 bytes from each position as a number, over the bytes and ``pad`` zeros."""
    full = np.concatenate((buf, np.zeros(pad + 8, np.uint8)))
    return np.lib.stride_tricks.sliding_window_view(full, 8).copy().view("<u8").ravel()


def _slide_min(g: np.ndarray, w: int) -> np.ndarray:
    m, span = g, 1
    while span * 2 <= w:
        m, span = np.minimum(m[:-span], m[span:]), span * 2
    return np.minimum(m[:len(m) - (w - span)], m[w - span:]) if w > span else m


def entries(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Name, row, first window's start in the row, and number of windows (up to ``SPAN``) of all entries."""
    none = np.zeros(0, np.int64)
    if len(buf) < MATCH:
        return none, none, none, none
    g = _grams(buf)
    least = _slide_min(g, SPAN)
    lens = np.diff(bounds)
    rows = np.flatnonzero(lens >= MATCH)
    count = lens[rows] - MATCH + 1
    at = np.arange(count.sum()) + np.repeat(bounds[rows] - np.append(0, np.cumsum(count)[:-1]), count)
    row = np.repeat(rows, count)
    m = least[at]
    # an entry ends where its leftmost least gram leaves the window, so its windows all differ
    leaves = m == g[at]
    head = np.append(True, (m[1:] != m[:-1]) | (row[1:] != row[:-1]) | leaves[:-1])
    first = np.flatnonzero(head)
    return m[first].view(np.int64), row[first], at[first] - bounds[row[first]], np.diff(np.append(first, len(m)))


ENTRY, KNOWN, COUNT, GONE = range(4)  # kinds of rows; KNOWN: an entry of a name that its batch holds often


def batch_rows(name: np.ndarray, ids: np.ndarray, th: np.ndarray, lo: np.ndarray, count: np.ndarray, start: np.ndarray, raw: bytes) -> list[np.ndarray]:
    """Rows (name, id, th << 40 | lo, count, kind) of a batch's entries; ``start``: where their stretches begin in ``raw``."""
    order = np.argsort(name, kind="stable")
    head = np.append(True, name[order][1:] != name[order][:-1]) if len(name) else np.zeros(0, bool)
    size = np.diff(np.append(np.flatnonzero(head), len(name)))
    often = np.repeat(size, size)
    again = order[often > 1]
    again = again[np.lexsort((lo[again], ids[again]))]
    kind = np.full(len(name), ENTRY)
    held: dict[bytes, int] = {}
    for k, a, b in zip(again.tolist(), start[again].tolist(), (start[again] + count[again] + (MATCH - 1)).tolist()):
        first = held.setdefault(raw[a:b], k)
        if first != k:  # a repeated row of one document leaves its entries to the other; they aren't earlier
            kind[k] = GONE if (ids[first], lo[first]) != (ids[k], lo[k]) else -1
    stay = order[kind[order] == ENTRY]
    names, at, size = np.unique(name[stay], return_index=True, return_counts=True)
    many = names[size > HEAVY]
    kind[stay[np.isin(name[stay], many)]] = KNOWN
    keep = (kind == ENTRY) | (kind == KNOWN)
    # neighbouring stretches that go are put together
    gone = np.flatnonzero(kind == GONE)
    gone = gone[np.lexsort((lo[gone], th[gone], ids[gone]))]
    joins = np.append(False, (ids[gone][1:] == ids[gone][:-1]) & (th[gone][1:] == th[gone][:-1]) & (lo[gone][1:] == (lo[gone] + count[gone])[:-1])) if len(gone) else np.zeros(0, bool)
    first = np.flatnonzero(~joins)
    total = np.add.reduceat(count[gone], first) if len(gone) else np.zeros(0, np.int64)
    gone = gone[first]
    zero = np.zeros(len(many), np.int64)
    return [np.concatenate(x) for x in (
        (name[keep], many, np.zeros(len(gone), np.int64)), (ids[keep], zero, ids[gone]), ((th << 40 | lo)[keep], zero, (th << 40 | lo)[gone]),
        (count[keep], size[size > HEAVY], total), (kind[keep], zero + COUNT, np.full(len(gone), GONE)))]


def suffix_order(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order of their first 128 bytes, and for each place, whether it is tied with the place before
    on the first 64 bytes; and the words at each position. Larsson-Sadakane: only tied groups are refined."""
    n = len(text)
    words = _words(text, 264)
    key = words[:n].byteswap()
    sa = np.argsort(key).astype(np.int32)
    new = np.append(True, key[sa[1:]] != key[sa[:-1]]) if n else np.zeros(0, bool)
    place = np.arange(n, dtype=np.int32)
    rank = np.empty(n + 129, np.int32)
    rank[n:] = -1  # past the end sorts first
    rank[sa] = np.maximum.accumulate(np.where(new, place, 0))
    tied = np.zeros(n, bool)
    depth = 8
    while depth < 128:
        if depth == 64:
            tied = ~new
        alone = new & np.append(new[1:], True)
        slots = np.flatnonzero(~alone)
        if len(slots) == 0:
            return sa, np.zeros(n, bool) if depth < 64 else tied, words
        pos = sa[slots]
        both = rank[pos].astype(np.int64) << 32 | (rank[pos + depth].astype(np.int64) + 1)
        order = np.argsort(both)
        pos, both = pos[order], both[order]
        sa[slots] = pos
        cut = np.append(True, both[1:] != both[:-1])
        new[slots] = cut
        rank[pos] = np.maximum.accumulate(np.where(cut, slots, 0)).astype(np.int32)
        depth *= 2
    return sa, tied, words


def common_prefixes(sa: np.ndarray, tied: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each place, if its suffix shares ``MATCH`` bytes with the one before; only tied places can.

    Kasai: if the neighbours of position p - 1 are followed by those of p, p's prefix is one byte shorter. Only
    the heads of such chains are compared, and chains are cut after 128 positions, so 256 bytes are enough.
    """
    at = np.flatnonzero(tied)
    out = np.zeros(len(sa), bool)
    if len(at) == 0:
        return out
    pos, before = sa[at].astype(np.int64), sa[at - 1].astype(np.int64)
    order = np.argsort(pos)
    pos, before, at = pos[order], before[order], at[order]
    follows = np.append(False, (pos[1:] == pos[:-1] + 1) & (before[1:] == before[:-1] + 1))
    head = ~follows | (pos % 128 == 0)
    h = np.flatnonzero(head)
    a, b, length = pos[h], before[h], np.full(len(h), 64)
    open_ = np.arange(len(h))
    last = len(words) - 1
    while len(open_) and length[open_[0]] < 256:
        x = words[np.minimum(a[open_] + length[open_], last)] ^ words[np.minimum(b[open_] + length[open_], last)]
        same = x == 0
        apart = open_[~same]
        low = x[~same] & (~x[~same] + U(1))  # the lowest differing bit tells the first differing byte
        length[apart] += (np.log2(low.astype(np.float64)) // 8).astype(np.int64)
        open_ = open_[same]
        length[open_] += 8
    run = np.cumsum(head) - 1
    out[at] = length[run] - (pos - pos[h][run]) >= MATCH
    return out


def judge_shard(ids: np.ndarray, start: np.ndarray, count: np.ndarray, texts: list[bytes], every: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the shard's windows: entry, offset in the entry, whether an equal one is earlier, whether it is the
    earliest of its kind here. Windows without an equal are only named for entries with ``every``.

    Equal stretches are sorted once: the earliest stands for them, and all windows of the others go.
    """
    order = np.lexsort((start, ids))
    held: dict[bytes, int] = {}
    stand = np.empty(len(texts), np.int64)
    for k in order.tolist():
        stand[k] = held.setdefault(texts[k], k)
    own = np.fromiter(held.values(), np.int64, len(held))
    lens = np.fromiter(map(len, held), np.int64, len(held))
    base = np.append(0, np.cumsum(lens))
    sa, tied, words = suffix_order(np.frombuffer(b"".join(held), np.uint8))
    same = common_prefixes(sa, tied, words)
    del tied, words
    window = np.full(base[-1], -1, np.int32)  # which stretch's window begins at each position
    entry = np.repeat(np.arange(len(own)), count[own])
    offset = np.arange(len(entry)) - np.repeat(np.cumsum(count[own]) - count[own], count[own])
    window[base[entry] + offset] = entry
    run = np.cumsum(~same) - 1
    real = (window[sa] >= 0) & (same | np.append(same[1:], False) | every.any())
    place, run = sa[real], run[real]
    u = window[place]
    e, o = own[u], place - base[u]
    order = np.lexsort((start[e] + o, ids[e], run))
    e, o, run = e[order], o[order], run[order]
    head = np.append(True, run[1:] != run[:-1]) if len(run) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(head, np.arange(len(run)), 0)) if len(run) else run
    goes = (ids[e] != ids[e[first]]) | (start[e] + o != start[e[first]] + o[first])
    more = np.flatnonzero((ids != ids[stand]) | (start != start[stand]))
    me = np.repeat(more, count[more])
    mo = np.arange(len(me)) - np.repeat(np.cumsum(count[more]) - count[more], count[more])
    return np.concatenate((e, me)), np.concatenate((o, mo)), np.append(goes, np.ones(len(me), bool)), np.append(head & every[e], np.zeros(len(me), bool))


def _ranges(entry: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry, first and last offset of the stretches of neighbouring windows."""
    order = np.lexsort((offset, entry))
    e, o = entry[order], offset[order]
    head = np.append(True, (e[1:] != e[:-1]) | (o[1:] != o[:-1] + 1)) if len(e) else np.zeros(0, bool)
    tail = np.append(head[1:], True) if len(e) else head
    return e[head], o[head], o[tail]


_OUT = ["id", "th", "s", "e", "w1", "w2"]


def _rows(id_, th, s, e, w1=None, w2=None) -> pa.RecordBatch:
    none = pa.nulls(len(id_), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (id_, th, s, e)] + [none if w is None else pa.array(w) for w in (w1, w2)], names=_OUT)


def _read(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    got = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(got) if got else None


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = _read(batches)
    if t is None:
        return
    ids, th, start, count, hot = (t.column(c).to_numpy() for c in ("id", "th", "lo", "count", "hot"))
    hot = hot.astype(bool)
    texts = t.column("ctx").to_pylist()
    known = np.array([x is None for x in texts])
    if known.any():  # what a batch has found to go already
        k = np.flatnonzero(known)
        yield _rows(ids[k], th[k], start[k], start[k] + count[k] + (MATCH - 1))
        k = np.flatnonzero(~known)
        ids, th, start, count, hot, texts = ids[k], th[k], start[k], count[k], hot[k], [texts[i] for i in k.tolist()]
    if not texts:
        return
    del t
    e, o, goes, head = judge_shard(ids, start, count.astype(np.int64), texts, hot)
    if goes.any():
        re, a, b = _ranges(e[goes], o[goes])
        yield _rows(ids[re], th[re], start[re] + a, start[re] + b + MATCH)
    ask = head  # of a name that other shards hold too: the merge decides
    if ask.any():
        e, o = e[ask], o[ask]
        base = np.append(0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))))
        buf = np.frombuffer(b"".join(texts), np.uint8)
        at = base[e] + o
        w1 = span_hashes(buf, at, at + MATCH)
        w2 = span_hashes(buf[::-1], len(buf) - at - MATCH, len(buf) - at)
        s = start[e] + o
        yield _rows(ids[e], th[e], s, s + MATCH, w1.view(np.int64), w2.view(np.int64))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows named by their hash go unless they are the earliest of that name; all else is handed on."""
    t = _read(batches)
    if t is None:
        return
    cols = [t.column(c).to_numpy() for c in _OUT[:4]]
    named = t.column("w1").is_valid().to_numpy()
    if (~named).any():
        yield _rows(*(c[~named] for c in cols))
    if named.any():
        cols = [c[named] for c in cols]
        w1, w2 = (t.column(c).drop_null().to_numpy() for c in ("w1", "w2"))
        order = np.lexsort((cols[2], cols[0], w2, w1))
        key = w1[order]
        # binary search for the run of each window's name in the merged order, then for its second hash in the run
        lo, hi = np.searchsorted(key, w1), np.searchsorted(key, w1, side="right")
        second = w2[order]
        first = lo.copy()
        while True:
            off = (first < hi) & (second[np.minimum(first, len(key) - 1)] != w2)
            if not off.any():
                break
            first[off] += 1
        best = order[first]
        goes = (cols[0] != cols[0][best]) | (cols[2] != cols[2][best])
        if goes.any():
            yield _rows(*(c[goes] for c in cols))


def _identified(docs: DataFrame, *keep: Column) -> DataFrame:
    """id (null ids after all others, by the text's hash), th (bits of that hash), the kept columns, _text."""
    rows = docs.select(*keep, F.col("doc_id").alias("_d"), F.coalesce("text", F.lit("")).alias("_text"))
    h = F.xxhash64("_text")
    return rows.withColumns({
        "id": F.coalesce(F.col("_d").cast("long"), F.lit(1 << 62) + h.bitwiseAND(F.lit((1 << 61) - 1))),
        "th": h.bitwiseAND(F.lit((1 << _TEXT_BITS) - 1))}).drop("_d")


def repeated_spans(rows: DataFrame, shards: int, hot: int = HOT) -> DataFrame:
    """(id, th, spans): the removed byte ranges of each text. ``rows``: id, th, sole, _text and others.

    Both reads take all columns, so that they share one exchange of the texts with the caller's own.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            whole = whole.filter(whole.column("sole"))
            parts, at = [], 0
            for batch in slices(whole, "_text", SLICE_BYTES):
                name, row, lo, count = entries(*text_bytes(batch.column("_text")))
                parts.append((name, row + at, lo, count))
                at += batch.num_rows
            if not parts:
                continue
            name, row, lo, count = (np.concatenate(x) for x in zip(*parts))
            buf, bounds = text_bytes(whole.column("_text"))
            ids, th = whole.column("id").to_numpy()[row], whole.column("th").to_numpy()[row]
            got = batch_rows(name, ids, th, lo, count, bounds[row] + lo, memoryview(buf).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32) if k > 2 else x) for k, x in enumerate(got)], names=["name", "id", "at", "count", "kind"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text", 1 << 20):
                buf, bounds = text_bytes(batch.column("_text"))
                found = batch.column("found")
                row = np.repeat(np.arange(len(found)), np.diff(found.offsets.to_numpy()))
                # field() would not heed the slice
                lo, count, key, split, gone = (x.to_numpy(zero_copy_only=False) for x in found.flatten().flatten())
                raw, a = buf.tobytes(), bounds[row] + lo
                ctx = [None if g else raw[i:j] for i, j, g in zip(a.tolist(), (a + count + (MATCH - 1)).tolist(), gone.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(batch.column("id").to_numpy()[row]), pa.array(batch.column("th").to_numpy()[row]), pa.array(lo),
                     pa.array(count), pa.array(split.astype(bool)), pa.array(ctx, pa.binary())], names=["key", "id", "th", "lo", "count", "hot", "ctx"])

    found = rows.mapInArrow(find, "name long, id long, at long, count int, kind int")
    kind = F.col("kind")
    counted = kind.isin(ENTRY, COUNT)
    found = found.withColumn("meet", F.when(counted, F.col("name")).otherwise(F.xxhash64("id", "at")))
    here = Window.partitionBy("meet")
    n = F.sum(F.when(counted, F.when(kind == COUNT, F.col("count")).otherwise(1)).otherwise(0)).over(here)
    found = found.withColumns({"n": n, "often": F.max(kind == COUNT).over(here) & counted})
    found = found.where((kind == GONE) | (kind == KNOWN) | ((kind == ENTRY) & (F.col("n") > 1)))
    spread = (kind == KNOWN) | ((kind == ENTRY) & F.col("often"))
    parts = F.when(spread, F.lit(shards)).otherwise(F.ceil(F.col("n") / hot)).cast("long")
    split = spread | ((kind == ENTRY) & (F.col("n") > hot))
    key = F.when(split, F.xxhash64("name", F.pmod(F.xxhash64("id", "at"), parts))).when(kind == ENTRY, F.col("name")).otherwise(F.xxhash64("id", "at"))
    found = found.select("id", F.shiftright("at", 40).alias("th"), F.struct(
        F.col("at").bitwiseAND(F.lit((1 << 40) - 1)).alias("lo"), "count", key.alias("key"), split.alias("hot"), (kind == GONE).alias("gone")).alias("f"))
    found = found.groupBy("id", "th").agg(F.collect_list("f").alias("found"))  # of one text
    sent = rows.join(found, ["id", "th"]).mapInArrow(
        cut, "key long, id long, th long, lo long, count int, hot boolean, ctx binary")
    kind = "id long, th long, s long, e long, w1 long, w2 long"
    gone = sent.repartition(shards, "key").mapInArrow(_shard, kind)
    gone = gone.repartition(F.coalesce("w1", F.xxhash64("id"))).mapInArrow(_merge, kind)
    return gone.groupBy("id", "th").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("spans"))


def _apply(keep: list[str], kinds: dict[str, str], rows: DataFrame, as_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                total, spans_out, kept = [], [], []
                sole = batch.column("sole").to_pylist()
                spans = batch.column("spans").to_pylist()
                for k, text in enumerate(batch.column("_text").to_pylist()):
                    raw = text.encode()
                    if sole[k]:
                        gone: list[list[int]] = []
                        for r in spans[k] or ():
                            if gone and r["s"] <= gone[-1][1]:
                                gone[-1][1] = max(gone[-1][1], r["e"])
                            else:
                                gone.append([r["s"], r["e"]])
                    else:  # an equal text of smaller id is kept
                        gone = [[0, len(raw)]] if len(raw) >= MATCH else []
                    ends = [0, *(e for _, e in gone)]
                    left = b"".join(raw[a:b] for a, b in zip(ends, [*(s for s, _ in gone), len(raw)]))
                    kept.append(left.decode(errors="ignore") if as_text else left)
                    total.append(len(raw))
                    spans_out.append([{"start": s, "end": e} for s, e in gone])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in keep] + [pa.array(total, pa.int64()), pa.array(spans_out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                                                      pa.array(kept, pa.string() if as_text else pa.binary())], names=[*keep, "n_bytes", "spans", "kept"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", n_bytes long, spans array<struct<start: long, end: long>>, kept " + ("string" if as_text else "binary")
    return rows.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), hot: int = HOT, as_text: bool = False) -> DataFrame:
    """``keep`` (as _k0, _k1, ...), n_bytes, spans (removed byte ranges), kept (the bytes that are left, or with
    ``as_text`` the text that they make, less cut characters) of every row."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(8, -(-size // SHARD_BYTES))
    names = [f"_k{i}" for i in range(len(keep))]
    rows = _identified(docs, *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)])
    # the first id of each text, which is told by two hashes
    ids = _identified(docs).withColumns({"h1": F.xxhash64("_text"), "h2": F.xxhash64("_text", F.lit(1))})
    firsts = ids.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.first("th").alias("th")).select("id", "th").distinct()
    rows = rows.join(firsts.withColumn("sole", F.lit(True)), ["id", "th"], "left").withColumn("sole", F.coalesce("sole", F.lit(False)))
    rows = rows.select("id", "th", *names, "_text", "sole")
    out = rows.join(repeated_spans(rows, shards, hot), ["id", "th"], "left")
    return _apply(names, dict(out.dtypes), out, as_text)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts (cut characters dropped) and n_chars; rows of
    which nothing is left go."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = {c: F.col(f"_k{i}") for i, c in enumerate(docs.columns)}  # all but the text, which comes back as kept
    got = docs.select(*[F.col(f"`{c}`").isNull().alias(n) if c == "text" else F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], "doc_id", "text")
    got = remove_repeats(got, tuple(names), as_text=True).where((F.col("n_bytes") == 0) | (F.length("kept") > 0))
    own["text"] = F.when(~own["text"], F.col("kept"))
    if "n_chars" in own:
        own["n_chars"] = F.when(F.size("spans") > 0, F.length("kept")).otherwise(own["n_chars"]).cast(dict(docs.dtypes)["n_chars"])
    return got.select(*[own[c].alias(c) for c in docs.columns])
