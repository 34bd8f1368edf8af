"""The pipeline, stage by stage, against brute force on the stage's own input."""

import hashlib
import os
import struct
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from poolwright.llm import bpe, quality_classifier, source_mixing

from . import data


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """Each stage's input and output over sf0.001, written and read again."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{data.SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data.SF).write.parquet(f"{root}/{k}")
        after = spark.read.parquet(f"{root}/{k}")
        out.append((docs, after))
        docs = after
    return out


def test_stage_columns(outputs):
    for before, after in outputs[:-1]:
        assert after.columns == before.columns and dict(after.dtypes) == dict(before.dtypes)


def test_quality_keeps_what_the_classifier_keeps(spark, outputs):
    before, after = outputs[0]
    labels = spark.read.parquet(f"{data.SF}/labels.parquet")
    want = {r.doc_id for r in quality_classifier.classify(before, labels).where("kept").collect()}
    assert {r.doc_id for r in after.collect()} == want and after.count() == len(want)
    told = after.join(labels, "doc_id").collect()
    assert sum(r.quality == 1 for r in told) >= 0.95 * len(told)


def test_near_duplicates_go(outputs):
    before, after = outputs[1]
    sets = {r.doc_id: data.shingles(r.text, 5) for r in before.collect()}
    comp = data.components(sets, data.linked_pairs(sets, 80, 100))
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(comp.values()))


def test_repeats_go(outputs):
    before, after = outputs[2]
    rows = {r.doc_id: r.text for r in before.collect()}
    gone = data.repeats(list(rows.items()))
    want = {}
    for i, t in rows.items():
        left = bytes(b for b, g in zip(t.encode(), gone[i]) if not g)
        if left or not t:
            want[i] = left.decode(errors="ignore")
    got = after.collect()
    assert {r.doc_id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got if sum(gone[r.doc_id]))


def test_mix_takes_what_the_twin_takes(spark, outputs, tmp_path):
    before, after = outputs[3]
    before.coalesce(1).write.parquet(str(tmp_path / "in"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/in/*.parquet'")
    want = Counter()
    for doc_id, copies in con.execute(f"SELECT doc_id, copies FROM ({source_mixing.SQL})").fetchall():
        want[doc_id] += copies
    assert Counter(r.doc_id for r in after.collect()) == +want


def test_ids_are_the_library_s(outputs):
    from tokenizers import Tokenizer

    before, after = outputs[4]
    lib = Tokenizer.from_file(bpe.vocabulary_path())
    text = {r.doc_id: r.text for r in before.collect()}
    got = after.collect()
    assert len(got) == before.count()
    for r in got:
        ids = lib.encode(text[r.doc_id] or "", add_special_tokens=False).ids
        assert bytes(r.ids) == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_equals_the_stages(spark, outputs):
    before = spark.conf.get(corpus_pipeline.BATCH)
    spark.conf.set(corpus_pipeline.BATCH, "777")
    try:
        got = corpus_pipeline.run(spark, data.SF).select("doc_id", "ids_sha256").collect()
        assert spark.conf.get(corpus_pipeline.BATCH) == "777"
    finally:
        spark.conf.set(corpus_pipeline.BATCH, before)
    want = outputs[-1][1].select("doc_id", "ids_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_go_through_all_stages(spark, empty, tmp_path):
    """Nulls, empty and long texts, repeats and clashing columns; every stage hands the columns on."""
    docs = data.messy(spark, empty)
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data.SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.schema(docs.schema).parquet(str(tmp_path / str(k))) if k < 4 else spark.read.parquet(str(tmp_path / "4"))
        assert k == 4 or docs.columns == columns
    assert (docs.count() == 0) == empty


def test_discarded_files_are_gone(spark):
    from poolwright.llm.common import discard, stored_at

    df, path = stored_at(spark.range(5))
    other, kept = stored_at(df.where("id > 2"))
    discard(spark, path)
    local = kept.removeprefix("file:")
    assert not os.path.exists(path.removeprefix("file:")) and os.path.exists(local) and other.count() == 2
