"""Benchmark decontamination against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from poolwright.llm import decontaminate

from . import data

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG = ("The quick brown fox jumps over the lazy dog while seven wizards quietly brew strong tea, "
        "and two bakers count their loaves before the early market opens again")
BENCH = [(1, LONG), (2, "Éclair au chocolat 42"), (3, LONG + " tomorrow"), (4, None), (5, " ,;- "), (6, "zebra"), (7, "a b " * 30),
         (2, "Éclair au chocolat 42"), (None, "nameless item of five words"), (10, "ten words make one window of ten words and no")]


def words_of(text):
    return WORD.findall((text or "").translate(data.LOWER))


def brute(docs, bench):
    windows = {}
    for item, text in bench:
        w = words_of(text)
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words_of(text)
        hit, items = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                got = windows.get(tuple(w[i:i + k]))
                if got is not None:
                    hit |= set(range(i, i + k))
                    items |= got
        out.append((doc, len(w), len(hit), tuple(sorted(x for x in items if x is not None))))
    return sorted(out, key=repr)


def docs_rows():
    filler = data.prose(3, 400)
    return [(1, LONG.upper()), (2, filler + "\n" + re.sub(" ", "\t--", LONG) + ". " + filler), (3, LONG[:60]), (4, None), (5, ""), (6, "...zebra!zebra"), (7, "a b " * 40),
            (8, "éclair au CHOCOLAT 42, Éclair au chocolat 42"), (9, "ÉCLAIR au chocolat 42 Éclair au chocolat 421"), (10, "nameless item of five words"), (None, LONG), (1, LONG.upper()),
            (11, filler * 40 + LONG[10:] + filler * 40), (12, "ten words make one window of ten words and no more"), (13, "words make one window of ten words and no"), (14, LONG + " " + LONG)]


def got_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("part_bytes", [decontaminate.PART_BYTES, 400])
def test_scan_equals_brute_force(spark, part_bytes):
    docs = spark.createDataFrame(docs_rows(), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    parts = decontaminate.parts_of(bench, part_bytes)[1]
    assert (parts > 1) == (part_bytes == 400)
    found = decontaminate.scan(docs, bench, part_bytes=part_bytes)
    assert got_of(found) == brute(docs_rows(), BENCH)
    for r in found.where("n_hit > 0").collect():  # the spans hold the words that were hit, and are runs
        raw = r.text.encode()
        assert sum(len(words_of(raw[s.start:s.end].decode())) for s in r.spans) == r.n_hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_removal(spark):
    docs = spark.createDataFrame(docs_rows(), "doc_id long, text string").withColumn("lang", data_lit("en"))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    cut = decontaminate.without_spans(docs, bench)
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert {4, 5, 3, 13} <= set(left) and not {1, 6, 10, 14, None} & set(left)
    filler = data.prose(3, 400)
    assert words_of(left[2]) == words_of(filler + " " + filler) and left[12].strip() == "more"
    assert got_of(decontaminate.scan(cut, bench)) == brute(list(left.items()), BENCH)
    whole = decontaminate.without_documents(docs, bench)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(d for d, n, h, _ in brute(docs_rows(), BENCH) if d is not None and not h)


def data_lit(x):
    from pyspark.sql import functions as F

    return F.lit(x)


def test_odd_tables(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    messy = data.messy(spark).withColumn("n_words", data_lit("own")).withColumn("_found", data_lit("own"))
    rows = [(i, t) for i, t, *_ in data.messy_rows()]
    found = decontaminate.scan(messy, bench.withColumn("n_hit", data_lit(1)))
    assert got_of(found) == brute(rows, BENCH) and found.columns.count("n_words") == 1
    assert found.where("n_hit = 0 and lang is not null").count() > 0
    assert decontaminate.scan(data.messy(spark, empty=True), bench).collect() == []
    none = decontaminate.scan(messy, bench.limit(0))
    assert got_of(none) == brute(rows, []) and none.where("n_hit > 0").count() == 0


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    """With hashes of four values, results stay the same: hits are verified on the bytes."""
    real = decontaminate.Words.windows
    monkeypatch.setattr(decontaminate.Words, "windows", lambda self, size: (lambda at, h: (at, h % np.uint64(4)))(*real(self, size)))
    named = [(i, t) for i, t in BENCH if i is not None]
    index = decontaminate.Index(np.array([i for i, _ in named]), np.ones(len(named), bool), pa.array([t for _, t in named], pa.string()))
    rows = docs_rows()
    got = decontaminate._scan(index, pa.RecordBatch.from_pydict({"text": pa.array([t for _, t in rows], pa.string())}), None).to_pylist()
    assert sorted([(i, g["n_words"], g["n_hit"], tuple(g["items"])) for (i, _), g in zip(rows, got)], key=repr) == brute(rows, named)


def test_query_digest(spark):
    from poolwright.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op12_benchmark_decontamination"][0](spark, data.SF).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{data.SF}/documents.parquet").select("doc_id", "text").collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{data.SF}/benchmark.parquet").select("item_id", "text").collect()]
    for doc, n, hit, items in brute(docs, bench):
        r = got[doc]
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(items), digest, hit > 0)
