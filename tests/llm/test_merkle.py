"""The Merkle manifest against a plain tree built level by level."""

import hashlib

import pytest
from pyspark.sql import functions as F

from poolwright.llm import merkle_manifest as mm

from . import data


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row
    return h(*(field(v) for v in (doc_id, source, lang, n_chars, text)))


def levels_of(nodes):
    out = [list(nodes)]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path_of(levels, at):
    out = []
    for level in levels[:-1]:
        run = at - at % 16
        out.append((level[run:at], level[at + 1:run + 16]))
        at //= 16
    return out


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root, verified) of rows (doc_id, text, lang, source, n_chars)."""
    by_source = {}
    for row in rows:
        by_source.setdefault("" if row[3] is None else "s" + row[3], []).append(row)
    trees = {}
    for key, have in by_source.items():
        have.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[key] = levels_of([leaf_of(r) for r in have])
    order = sorted(trees, key=str.encode)
    top = levels_of([trees[k][-1][0] for k in order])
    root, out = top[-1][0] if rows else None, []
    for i, key in enumerate(order):
        for j, row in enumerate(by_source[key]):
            path = path_of(trees[key], j) + path_of(top, i)
            shown = row
            if row[0] is not None and data.crc(row[0]) % 5 == 0 and row[1] is not None:
                shown = (row[0], row[1].translate(data.LOWER), *row[2:])
            fold = leaf_of(shown)
            for before, after in path:
                fold = h(*before, fold, *after)
            out.append((row[0], leaf_of(row), trees[key][-1][0], root, h(*(x for b, a in path for x in b + a)), fold, fold == root))
    return sorted(out, key=repr)


def got_of(docs):
    got = mm.verified(docs, mm.tampered()).withColumn("proof", mm.proof_digest(F.col("path")))
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root, r.verified) for r in got.collect()), key=repr)


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 31, 255, 256])
def test_positions_in_an_append_log(leaves):
    nodes = [h(str(i)) for i in range(leaves)]
    levels = mm.folds(leaves)
    log = mm.append_log(nodes, levels)
    want = levels_of(nodes)
    assert levels == len(want) - 1 == mm.height(leaves)
    seen = set()
    for k, level in enumerate(want):
        for i, node in enumerate(level):
            at = mm.position(k, i, leaves)
            assert log[at] == node
            seen.add(at)
    assert seen == set(range(len(log)))  # each node has one place, and no place is left over
    for j, path in enumerate(mm.steps("".join(log), leaves, levels)):
        assert path == [("".join(b), "".join(a)) for b, a in path_of(want, j)]


def test_partial_builder_of_a_larger_tree():
    """The last builder of a tree that goes on above folds all its levels, even over one leaf."""
    assert mm.append_log(["a"], 2) == ["a", h("a"), h(h("a"))] and mm.folds(257) == 2


def test_odd_rows(spark):
    assert got_of(data.messy(spark)) == brute(data.messy_rows())
    assert got_of(data.messy(spark, empty=True)) == []


def test_sources_and_repeats(spark):
    """300 sources (two stages in the top tree), one of 700 rows with many repeats, null ids, and one of a single row."""
    rows = [(k, f"Text {k} A", "en", f"s{k % 299}", k) for k in range(600)]
    rows += [(k // 50, "Same Words", "fr", "hot", 1) for k in range(700)] + [(None, f"No id {k}", None, None, None) for k in range(3)] + [(9, "Sole", "en", "é", 4)]
    docs = spark.createDataFrame(rows, data.SCHEMA).repartition(5)
    got, want = got_of(docs), brute(rows)
    assert got == want and 0 < sum(not r[-1] for r in got) < len(rows)


def test_three_stages(spark):
    n = 66_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("T"), "id").alias("text"), F.lit("en").alias("lang"), F.lit("one").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    got = mm.manifest(docs)
    assert len(got.documents.stages) == 3
    levels = levels_of([leaf_of((k, f"T{k}", "en", "one", 1)) for k in range(n)])
    rows = got.proofs().where("doc_id % 7001 = 0 or doc_id >= 65990").collect()
    assert {r.root for r in rows} == {levels[-1][0]} and len(rows) == 20
    for r in rows:
        assert [(s.before, s.after) for s in r.path] == [("".join(b), "".join(a)) for b, a in path_of(levels, r.doc_id)]


def test_query_equals_brute_force(spark):
    from poolwright.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{data.SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = QUERIES["op13_merkle_manifest"][0](spark, data.SF)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
