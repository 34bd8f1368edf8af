"""Registered queries of the training-data operators: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, decontaminate, language_id, lm_scoring, merkle_manifest, ngram_join, quality_classifier, quality_rules, source_mixing, suffix_dedup, topk_search, twins, url_filters, whitening
from .common import table


def op1_ngram_jaccard_join(spark, sf_dir):
    rule = ngram_join.Rule(words=4, num=85, den=100)
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), rule).select("doc_id", "n_shingles", "component_id")


def op2_bpe_roundtrip(spark, sf_dir):
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op3_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op4_lm_scoring(spark, sf_dir):
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op5_topk_search(spark, sf_dir):
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op6_url_filters(spark, sf_dir):
    return url_filters.filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op7_quality_classifier(spark, sf_dir):
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_source_mixing(spark, sf_dir):
    return source_mixing.mix(table(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark, sf_dir):
    got = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return got.select(F.col("_k0").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_embedding_whitening(spark, sf_dir):
    white, model = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.variances)).cast("array<double>")
    rows = white.select("vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))


def op12_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=("doc_id",))
    listed = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op13_merkle_manifest(spark, sf_dir):
    got = merkle_manifest.verified(table(spark, sf_dir, "documents"), merkle_manifest.tampered())
    return got.select("doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


QUERIES = {
    "op1_ngram_jaccard_join": (op1_ngram_jaccard_join, twins.NGRAM_JOIN),
    "op2_bpe_roundtrip": (op2_bpe_roundtrip, None),
    "op3_quality_rules": (op3_quality_rules, None),
    "op4_lm_scoring": (op4_lm_scoring, None),
    "op5_topk_search": (op5_topk_search, topk_search.SQL),
    "op6_url_filters": (op6_url_filters, twins.URL_FILTERS),
    "op7_quality_classifier": (op7_quality_classifier, None),
    "op8_source_mixing": (op8_source_mixing, source_mixing.SQL),
    "op9_language_id": (op9_language_id, None),
    "op10_suffix_dedup": (op10_suffix_dedup, twins.SUFFIX_DEDUP),
    "op11_embedding_whitening": (op11_embedding_whitening, None),
    "op12_benchmark_decontamination": (op12_benchmark_decontamination, decontaminate.SQL),
    "op13_merkle_manifest": (op13_merkle_manifest, merkle_manifest.SQL),
}
