"""Quality rules: base limits, then robust multivariate outliers per language and source.

``text_statistics`` counts over whole texts. Documents that pass the base limits are turned into a vector
(log of the mean word length, and logs of the rates of symbols, repeated lines and repeated words); for each
language and source the minimum-covariance-determinant estimate is found by concentration steps from the
medians and MADs, and a document is kept if its squared Mahalanobis distance is under the chi-square cut.

A concentration step is one aggregation: a row's distance under the present estimate gives its bin, each
(cell, bin) is summed map-side, and the bins up to the ``CORE`` share of the cell's rows give the next
estimate. So no cell's rows are gathered, however many it has, and a cell hands over a bounded number of bins:
estimates go to the rows by broadcast. (Beyond ``FEW_ROWS`` cells the rows are joined by cell, and adaptive skew splitting deals with large ones.)
Language and source pairs with under ``LEAST`` rows are put together per language, and languages with under
that many rows in all. ``FLOOR``, half a percent of lines or words or half a symbol in 1,000 characters, guards against a singular scatter.

Null text counts as no words (fails the base limits); null language and null source are values of their
own; repeated rows count as rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FEW_ROWS, _SPACE, checkpointed, slices, span_hashes, text_bytes, word_spans

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
CORE = 0.75
STEPS = 5
LEAST = 60
FLOOR = (0.05, 0.05, 0.05, 0.05)
TAIL = 1e-4
DIM = 4

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IN_WORD = ~_SPACE & ~((np.arange(256) >= 0x80) & (np.arange(256) < 0xC0))  # first byte of a code point


def _chi2_cdf(x: float, half: int) -> float:
    """Chi-square distribution with an even number, 2 * half, of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(half))


def _chi2_at(p: float, half: int) -> float:
    lo, hi = 0.0, 400.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, half) < p else (lo, mid)
    return lo


#: makes the covariance of the central ``CORE`` share that of all rows, for normal data
CONSISTENCY = CORE / _chi2_cdf(_chi2_at(CORE, DIM // 2), DIM // 2 + 1)
CUT = _chi2_at(1 - TAIL, DIM // 2)


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _copies(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Marks all but the first of the items with one key in one row; items stand in order of rows."""
    order = np.lexsort((np.arange(len(keys)), keys, row))
    k, r = keys[order], row[order]
    same = np.append(False, (k[1:] == k[:-1]) & (r[1:] == r[:-1]))
    out = np.zeros(len(keys), bool)
    out[order] = same
    return out


def count_batch(col: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of an Arrow string array."""
    buf, bounds = text_bytes(col)
    starts, ends, first = word_spans(buf, bounds)
    n = len(bounds) - 1
    out = {"n_words": np.diff(first), "word_chars": _per_row(_IN_WORD[buf], bounds), "n_symbols": _per_row(_IS_SYMBOL[buf], bounds)}

    # lines: cut after every newline, and at the rows' ends
    cuts = np.flatnonzero(buf == 10)
    heads = np.sort(np.concatenate((bounds[:-1], cuts + 1)))
    tails = np.sort(np.concatenate((bounds[1:], cuts)))
    row = np.repeat(np.arange(n), _per_row(buf == 10, bounds) + 1)
    with_word = np.searchsorted(starts, tails) > np.searchsorted(starts, heads)
    heads, tails, row = heads[with_word], tails[with_word], row[with_word]
    again = _copies(span_hashes(buf, heads, tails), row)
    out["n_lines"] = np.bincount(row, minlength=n)
    out["n_dup_lines"] = np.bincount(row[again], minlength=n)

    # windows of words: candidates by a rolling hash, then compared word by word
    words = span_hashes(buf, starts, ends)
    m = len(words) - WINDOW + 1
    covered = np.zeros(len(words) + 1, np.int64)
    if m > 0:
        doc = np.repeat(np.arange(n), np.diff(first))
        with np.errstate(over="ignore"):
            key = np.zeros(m, np.uint64)
            for j in range(WINDOW):
                key = key * np.uint64(0x9E3779B97F4A7C15) + words[j:j + m]
            key ^= doc[:m].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        at = np.flatnonzero(doc[:m] == doc[WINDOW - 1:])
        at = at[np.argsort(key[at], kind="stable")]
        k = key[at]
        pair = np.flatnonzero(k[1:] == k[:-1])
        a, b = at[pair], at[pair + 1]
        same = doc[a] == doc[b]
        for j in range(WINDOW):
            same &= words[a + j] == words[b + j]
        twice = np.unique(np.concatenate((a[same], b[same])))
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + WINDOW, -1)
    out["n_repeat_words"] = _per_row(np.cumsum(covered)[:len(words)] > 0, first)
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                got = count_batch(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in ("doc_id", "lang", "source")] + [pa.array(got[c].astype(np.int64)) for c in COUNTS],
                    names=["doc_id", "lang", "source", *COUNTS])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), "text").mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def _vector() -> list[Column]:
    rate = lambda a, b, k: F.log1p(k * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
            rate("n_symbols", "word_chars", 100.0), rate("n_dup_lines", "n_lines", 10.0), rate("n_repeat_words", "n_words", 10.0)]


_X = [f"x{i}" for i in range(DIM)]
_PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]
_ESTIMATE = "cell string, " + ", ".join([f"m{i} double" for i in range(DIM)] + [f"p{i}{j} double" for i, j in _PAIRS])


def _distance() -> Column:
    d = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(_X)]
    return sum(((2 if i != j else 1) * F.col(f"p{i}{j}") * d[i] * d[j] for i, j in _PAIRS), F.lit(0.0))


def _estimate_row(cell: str, mean: np.ndarray, cov: np.ndarray) -> pd.DataFrame:
    inv = np.linalg.inv(cov)
    return pd.DataFrame([[cell, *mean, *(inv[i, j] for i, j in _PAIRS)]], columns=["cell", *(f"m{i}" for i in range(DIM)), *(f"p{i}{j}" for i, j in _PAIRS)])


def concentrate(bins: pd.DataFrame) -> pd.DataFrame:
    """The next estimate of a cell from its binned moments: the bins of least distance up to the core share."""
    bins = bins.sort_values("b")
    n = bins["n"].to_numpy().cumsum()
    upto = int(np.searchsorted(n, math.ceil(CORE * n[-1]))) + 1
    inner = bins.iloc[:upto]
    size = inner["n"].sum()
    mean = np.array([inner[f"s{i}"].sum() for i in range(DIM)]) / size
    cov = np.zeros((DIM, DIM))
    for i, j in _PAIRS:
        cov[i, j] = cov[j, i] = inner[f"q{i}{j}"].sum() / size - mean[i] * mean[j]
    return _estimate_row(bins["cell"].iloc[0], mean, CONSISTENCY * cov + np.diag(np.square(FLOOR)))


def _start(rows: pd.DataFrame) -> pd.DataFrame:
    r = rows.iloc[0]
    mean = np.array([r[f"c{i}"] for i in range(DIM)])
    spread = np.array([(r[f"u{i}"] - r[f"l{i}"]) / 1.349 for i in range(DIM)])  # quartile range of a normal
    return _estimate_row(r["cell"], mean, np.diag(np.square(spread) + np.square(FLOOR)))


def mcd_estimates(points: DataFrame, few_cells: bool = False) -> DataFrame:
    """(cell, centre, inverse scatter) from rows (cell, x0..x3). ``few_cells``: the cells are counted to be few enough for a broadcast."""
    to_all = F.broadcast if few_cells else lambda df: df
    quart = [F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(x) for x in _X]
    start = points.groupBy("cell").agg(*quart).select("cell", *[F.col(x)[k].alias(f"{n}{i}") for i, x in enumerate(_X) for k, n in enumerate("lcu")])
    est = start.groupBy("cell").applyInPandas(_start, _ESTIMATE)
    binned = F.floor(F.log(F.least(F.greatest(_distance(), F.lit(0.0)), F.lit(1e9)) + 1e-3) * 50).alias("b")
    sums = [F.count("*").alias("n")] + [F.sum(x).alias(f"s{i}") for i, x in enumerate(_X)] + [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"q{i}{j}") for i, j in _PAIRS]
    for _ in range(STEPS):
        bins = points.join(to_all(est), "cell").groupBy("cell", binned).agg(*sums)
        est = bins.groupBy("cell").applyInPandas(concentrate, _ESTIMATE)
    return est


def judge(docs: DataFrame) -> DataFrame:
    """Per document: its counts, base_failed, the squared distance (null if base_failed) and kept."""
    stats = checkpointed(text_statistics(docs).withColumn("base_failed", base_failed()))
    tag = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    points = stats.withColumns({"_l": tag("lang"), "_s": tag("source")}).withColumns(dict(zip(_X, _vector())))
    sizes = points.where(~F.col("base_failed")).groupBy("_l", "_s").agg(F.count("*").alias("_n"))
    small = F.col("_n") < LEAST
    langs = sizes.where(small).groupBy("_l").agg(F.sum("_n").alias("_nl"))
    cells = sizes.join(langs, "_l", "left").select(
        "_l", "_s", F.when(~small, F.concat_ws("\u0001", "_l", "_s")).when(F.col("_nl") >= LEAST, F.concat(F.col("_l"), F.lit("\u0001"))).otherwise("").alias("cell"))
    cells = checkpointed(cells)
    few = cells.count() <= FEW_ROWS  # estimates have a row a cell, so this bounds their broadcasts as well
    points = checkpointed(points.join(F.broadcast(cells) if few else cells, ["_l", "_s"], "left"))
    est = mcd_estimates(points.where(~F.col("base_failed")).select("cell", *_X), few)
    out = points.join(F.broadcast(est) if few else est, "cell", "left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return out.select("doc_id", "lang", "source", *COUNTS, "base_failed", "distance", (~F.col("base_failed") & (F.col("distance") <= CUT)).alias("kept"))
