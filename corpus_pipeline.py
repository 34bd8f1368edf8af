"""The corpus pipeline: documents in, token ids of the cleaned and mixed corpus out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's docs. All but the last return the columns of ``documents``; a stage hands further columns on.
Null ids, null or empty texts, repeated rows and empty tables are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolwright.llm import bpe, ngram_join, quality_classifier, source_mixing, suffix_dedup
from poolwright.llm.common import discard, stored_at, table

#: Five words and a similarity of 0.8, as for all near-duplicate stages on word shingles.
NEAR = ngram_join.Rule(words=5, num=80, den=100)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _settings(spark: SparkSession) -> None:
    """Arrow batches of fewer rows than Spark's 10,000, as whole texts are long: Python workers stay small.

    A stage that is called alone leaves it set, as its result is run after the call; ``run`` sets back what it found.
    """
    spark.conf.set(BATCH, "1000")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps (none rejected where there are no labels to learn from)."""
    _settings(spark)
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each component of near-duplicates."""
    _settings(spark)
    return ngram_join.keep_one(docs, NEAR)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat an earlier string of 100 bytes; texts of which nothing is left go."""
    _settings(spark)
    return suffix_dedup.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    _settings(spark)
    return source_mixing.emit(docs, scanned=True)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit integers), their SHA-256 and that of the decoded text."""
    _settings(spark)
    keep = ("doc_id", "lang", "source")
    coded = bpe.decode(bpe.encode(docs, keep=keep), keep=(*keep, "ids"))
    return coded.select(*keep, (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]

#: The classifier's weights can't be stated in SQL; the pipeline is tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; the files of a stage go when the next one's are written."""
    docs, path = table(spark, sf_dir, "documents"), None
    before = spark.conf.get(BATCH)
    try:
        for k, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k + 1 < len(STAGES):
                read, (docs, path) = path, stored_at(docs)
                if read is not None:
                    discard(spark, read)
    finally:
        spark.conf.set(BATCH, before)
    return docs
