"""Joins, removal, coding and mixing against brute force, on a table with all odd cases and on a small one."""

import hashlib
import struct
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from poolwright.llm import bpe, ngram_join, queries, source_mixing, suffix_dedup

from . import data


def rows_of(spark, name):
    return queries.QUERIES[name][0](spark, data.SF).collect()


@pytest.fixture(scope="module")
def small(spark):
    return [tuple(r) for r in spark.read.parquet(f"{data.SF}/documents.parquet").select("doc_id", "text").collect()]


# --- n-gram join


@pytest.mark.parametrize("rule", [ngram_join.Rule(4, 85, 100), ngram_join.Rule(5, 80, 100), ngram_join.Rule(3, 60, 100), ngram_join.Rule(5, 80, 100, 3, 1)])
def test_similar_sets_share_a_signature(rule):
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(2, 300))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        k = int(rng.integers(0, max(1, n // 3)))
        b = np.concatenate((a[:n - k], rng.integers(0, 1 << 63, int(rng.integers(0, k + 1))).astype(np.uint64)))
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if rule.den * both >= rule.num * (len(a) + len(b) - both) and len(a) + len(b) > 2 * both:
            assert np.intersect1d(ngram_join.signatures(rule, a), ngram_join.signatures(rule, b)).size


@pytest.mark.parametrize("rule", [ngram_join.Rule(4, 85, 100), ngram_join.Rule(3, 60, 100)])
def test_join_equals_brute_force(spark, rule, small):
    join = ngram_join.Join(spark.read.parquet(f"{data.SF}/documents.parquet"), rule)
    sets = {i: data.shingles(t, rule.words) for i, t in small}
    pairs = data.linked_pairs(sets, rule.num, rule.den)
    comp = data.components(sets, pairs)
    got = join.documents().collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(s), comp[i]) for i, s in sets.items()}
    least = {}
    for i in sorted(sets):
        least.setdefault(sets[i], i)
    want = {tuple(sorted((least[sets[a]], least[sets[b]]))) for a, b in pairs if sets[a] != sets[b]}
    assert {tuple(r) for r in join.links().collect()} == want


def test_join_of_many_near_copies(spark):
    """A large group in which not all are linked to each other, in blocks of its own and with few pairs tested."""
    base = data.prose(7, 200).split()
    rng = np.random.default_rng(1)
    rows = []
    for k in range(150):
        w = list(base)
        for at in rng.integers(0, 200, k % 7):
            w[at] = f"z{k}"
        rows.append((k, " ".join(w)))
    rule = ngram_join.Rule(5, 80, 100)
    sets = {i: data.shingles(t, 5) for i, t in rows}
    comp = data.components(sets, data.linked_pairs(sets, 80, 100))
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rule).collect()
    assert {r.doc_id: r.component_id for r in got} == comp


def test_join_of_odd_rows(spark):
    got = ngram_join.jaccard_components(data.messy(spark), ngram_join.Rule(4, 85, 100)).collect()
    rows = [(i, t) for i, t, *_ in data.messy_rows()]
    assert len(got) == len(rows)
    sets = {i: data.shingles(t, 4) for i, t in rows if i is not None}
    comp = data.components(sets, data.linked_pairs(sets, 85, 100))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == sorted((i, len(sets[i]), comp[i]) for i, _ in rows if i is not None)
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert ngram_join.jaccard_components(data.messy(spark, empty=True)).collect() == []


def test_keep_one(spark):
    docs = data.messy(spark)
    got = ngram_join.keep_one(docs)
    assert got.columns == docs.columns
    ids = sorted((r.doc_id for r in got.collect()), key=lambda i: (i is None, i or 0))
    sets = {i: data.shingles(t, 5) for i, t, *_ in data.messy_rows() if i is not None}
    comp = data.components(sets, data.linked_pairs(sets, 80, 100))
    assert ids == sorted(set(comp.values())) + [None, None]
    assert ngram_join.keep_one(data.messy(spark, empty=True)).collect() == []


# --- suffix-array dedup


def kept_bytes(rows):
    gone = data.repeats(rows)
    return {i: bytes(b for b, g in zip((t or "").encode(), gone[i]) if not g) for i, t in rows}, gone


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(3)
    text = np.concatenate([rng.integers(97, 99, 700), np.tile(rng.integers(97, 123, 130), 3), np.full(300, 97)]).astype(np.uint8)
    sa, tied, words = suffix_dedup.suffix_order(text)
    raw = text.tobytes()
    assert sorted(sa.tolist()) == list(range(len(raw)))
    cut = [raw[i:i + 128] for i in sa]
    assert cut == sorted(cut)
    same = suffix_dedup.common_prefixes(sa, tied, words)
    for k in range(1, len(sa)):
        a, b = int(sa[k - 1]), int(sa[k])
        if a + 100 <= len(raw) and b + 100 <= len(raw):
            assert same[k] == (raw[a:a + 100] == raw[b:b + 100])


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_removal_equals_brute_force(spark, small, hot):
    want, gone = kept_bytes(small)
    got = suffix_dedup.remove_repeats(spark.read.parquet(f"{data.SF}/documents.parquet"), hot=hot).collect()
    assert len(got) == len(small)
    for r in got:
        assert bytes(r.kept) == want[r._k0]
        spans = [(s.start, s.end) for s in r.spans]
        flags = np.concatenate(([0], np.frombuffer(bytes(gone[r._k0]), np.uint8), [0])).astype(int)
        assert spans == list(zip(np.flatnonzero(np.diff(flags) == 1).tolist(), np.flatnonzero(np.diff(flags) == -1).tolist()))


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 3])
def test_removal_in_periodic_and_odd_texts(spark, hot):
    line = "a line of a bit under a hundred bytes that many texts share, but nothing around it"
    rows = [(i, t) for i, t, *_ in data.messy_rows() if i is not None and len(t or "") < 50_000]
    rows += [(100 + k, data.prose(300 + k, 25) + " " + line + " " + data.prose(400 + k, 25)) for k in range(12)]
    rows += [(200, "abcdefghij" * 11), (201, "q" * 99), (202, "q" * 99), (203, "r" * 400), (204, "日本語" * 100), (205, "ab" * 300 + data.prose(9, 40) + "ab" * 200)]
    want, _ = kept_bytes(rows)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), hot=hot).collect()
    assert sorted((r._k0, bytes(r.kept)) for r in got) == sorted((i, want[i]) for i, _ in rows)


def test_removal_of_odd_rows(spark):
    docs = data.messy(spark)
    got = suffix_dedup.deduplicated(docs)
    assert got.columns == docs.columns and got.schema.simpleString() == docs.schema.simpleString()
    got = got.collect()
    own = {r.doc_id: r for r in got}
    assert own[4].text is None and own[5].text == "" and own[7].text == "short"
    assert 2 not in own and None in own  # 2 equals 1; of the null ids, the one without text stays
    assert [r.text for r in got if r.doc_id is None] == [None]
    assert sum(r.doc_id == 3 for r in got) == 2
    assert suffix_dedup.deduplicated(data.messy(spark, empty=True)).collect() == []
    assert suffix_dedup.remove_repeats(data.messy(spark, empty=True)).collect() == []


# --- BPE


def reference_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


def test_encoding_equals_the_library(spark, small):
    lib = reference_tokenizer()
    text = dict(small)
    for r in rows_of(spark, "op2_bpe_roundtrip"):
        ids = lib.encode(text[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encoding_of_odd_rows(spark):
    lib = reference_tokenizer()
    docs = data.messy(spark)
    got = bpe.decode(bpe.encode(docs), keep=("doc_id", "ids")).collect()
    assert len(got) == len(data.messy_rows())
    want = sorted(((i is None, i or 0), np.array(lib.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes(), t or "") for i, t, *_ in data.messy_rows())
    assert sorted(((r.doc_id is None, r.doc_id or 0), bytes(r.ids), r.decoded) for r in got) == want
    assert bpe.decode(bpe.encode(data.messy(spark, empty=True))).collect() == []


def test_encoding_of_any_text():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    lib, coder = reference_tokenizer(), bpe.Encoder(bpe.vocabulary_path())
    piece = st.one_of(st.text(max_size=12), st.sampled_from(["aaaa", "abab", " the", "  ", "\n", "<|endoftext|>", "'ll", "１２", "\x1c", "౜"]))

    @settings(max_examples=150, deadline=None)
    @given(st.lists(piece, max_size=12).map("".join))
    def check(text):
        ids = coder.encode([text])[0]
        assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids
        assert coder.decode(ids) == text

    check()


# --- mixing


def test_mix_of_odd_rows(spark):
    got = source_mixing.mix(data.messy(spark)).collect()
    rows = data.messy_rows()
    assert len(got) == len(rows)
    words = {s: sum(len(data.words(t)) for _, t, _, x, _ in rows if x == s) for s in {r[3] for r in rows}}
    largest = {s: max(len(data.words(t)) for _, t, _, x, _ in rows if x == s) for s in words}
    target = {r.source: r.target for r in got}
    assert abs(sum(target.values()) - 1.5 * sum(words.values())) < 1e-6
    for s, n in words.items():
        assert target[s] <= 2 * n + 1e-9
        assert abs(sum(r.taken for r in got if r.source == s) - target[s]) <= 2 * largest[s] + 1e-9
    assert all(r.taken == r.size * r.copies and r.copies <= 2 for r in got)
    again = source_mixing.mix(data.messy(spark).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert source_mixing.mix(data.messy(spark, empty=True)).collect() == []


def test_emit_repeats_rows(spark):
    docs = data.messy(spark)
    out = source_mixing.emit(docs)
    assert out.columns == docs.columns
    taken = sorted((r.doc_id is None, r.doc_id or 0) for r in source_mixing.mix(docs).collect() for _ in range(r.copies))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.select("doc_id").collect()) == taken
    assert source_mixing.emit(data.messy(spark, empty=True)).collect() == []


def test_emit_of_scanned_rows_equals_that_of_stored_ones(spark, tmp_path, monkeypatch):
    """Repeated rows and clashing columns, over several files; no copy of the rows is written."""
    rows = data.messy(spark).withColumns({c: F.lit("own") for c in ("_row", "_n_file", "_n_row", "_copies", "_metadata_")})
    rows.union(rows).repartition(5).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    want = sorted(map(str, source_mixing.emit(docs).collect()))
    widths = []
    stored = source_mixing.stored
    monkeypatch.setattr(source_mixing, "stored", lambda df: widths.append(df.columns) or stored(df))
    assert sorted(map(str, source_mixing.emit(docs, scanned=True).collect())) == want
    assert widths and not any("_row" in c or "text" in c for c in widths)
    assert sorted(map(str, source_mixing.emit(data.messy(spark), scanned=True).collect())) == sorted(map(str, source_mixing.emit(data.messy(spark)).collect()))


def test_mix_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data.SF}/documents.parquet'")
    want = con.execute(source_mixing.SQL).fetchall()
    got = [tuple(r) for r in rows_of(spark, "op8_source_mixing")]
    assert sorted(got) == sorted(want)


def test_text_bytes_of_a_slice():
    from poolwright.llm.common import text_bytes

    whole = pa.array(["ab", None, "é", "", "xyz"])
    buf, bounds = text_bytes(whole.slice(1, 3))
    assert buf.tobytes() == "é".encode() and bounds.tolist() == [0, 0, 2, 2]


# --- working memory of the Python workers


def test_grams_need_little_beside_their_batch():
    """The working memory of a batch's grams goes with a slice, not with the batch; it took 47 bytes for each byte of it."""

    class Caught(Exception):
        pass

    class Rows:
        def mapInArrow(self, f, schema):
            raise Caught(f)

    try:
        suffix_dedup.repeated_spans(Rows(), 8)
    except Caught as e:
        find = e.args[0]
    texts = [data.prose(k, 300) for k in range(1000)]
    size = sum(map(len, texts))
    batch = pa.record_batch({"id": pa.array(range(1000), pa.int64()), "th": pa.array([0] * 1000, pa.int64()), "sole": [True] * 1000, "_text": texts})
    tracemalloc.start()
    try:
        got = list(find(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert size > 1 << 20 and got[0].num_rows > 10_000 and peak < 20 * size, (size, peak / size)


def test_pre_tokens_are_encoded_some_at_a_time(monkeypatch):
    texts = [data.prose(k, 60) + f" word{k} \U0001f600 naïve" for k in range(40)]
    want = [x.tolist() for x in bpe.Encoder(bpe.vocabulary_path()).encode(texts)]
    coder, most = bpe.Encoder(bpe.vocabulary_path()), []
    plain = coder.vocab.encode_words
    monkeypatch.setattr(bpe, "AT_ONCE", 7)
    monkeypatch.setattr(coder.vocab, "encode_words", lambda words: most.append(len(words)) or plain(words))
    assert [x.tolist() for x in coder.encode(texts)] == want
    assert len(most) > 2 and max(most) <= 7
