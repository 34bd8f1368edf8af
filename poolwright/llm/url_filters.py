"""URL filter by a character language-model ratio, in DataFrame functions only.

Rules of host suffix and path prefix judge the URLs that they fit, the longest rule first. They also give
the training text: URLs that a rule allows, and URLs that a rule blocks. For either class a variable-order
Markov model is smoothed from order 0 up (a context's counts plus ``SMOOTH`` times the shorter context's
probability). A character is scored in the longest context that the model has, as the log of the ratio of
the two probabilities; a URL's score is the mean over its characters and its end. The threshold is the one
that parts the two classes best (sum of both rates, over bins of 1 / ``STEPS``) among the judged URLs that were held
back from training, one in ``HELD_BACK`` by a hash of the URL: a model knows the URLs that it was trained on too well.

The model has every character sequence of the training text, however rare. Where it is counted to be small it is broadcast, and
else joined by shuffle, with the same result.

A null URL, or one without ``://``, has an empty host and path and is scored as the text that it is (null:
empty). Repeated rows are judged alike; with no held-back URLs of one of the classes all other URLs are
allowed; a class without training URLs has the smoothing alone; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_few, checkpointed, lower_ascii

#: The contract's rules: (rule, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
ORDER = 4
SMOOTH = 4.0
STEPS = 64
HELD_BACK = 5
START, END = "\u0002", "\u0003"


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return lower_ascii(part(1)), part(2)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def held_back(url: Column) -> Column:
    """Whether a URL is kept from training, for the threshold; equal URLs are on one side."""
    return F.conv(F.substring(F.md5(url.cast("binary")), 1, 8), 16, 10).cast("long") % HELD_BACK == 0


def _grams(urls: DataFrame, *keep: str) -> DataFrame:
    """A row for each character and the end of a URL: that character after the ``ORDER - 1`` before it."""
    padded = F.concat(F.lit(START * (ORDER - 1)), F.col("_url"), F.lit(END))
    spots = urls.select(*keep, padded.alias("_t")).select(*keep, "_t", F.explode(F.sequence(F.lit(1), F.length("_t") - (ORDER - 1))).alias("_i"))
    return spots.select(*keep, F.substring(F.col("_t"), F.col("_i"), F.lit(ORDER)).alias("g"))


def train(labelled: DataFrame) -> DataFrame:
    """(gram, delta): log ratio of a gram's last character, accepted over rejected, after the rest of it."""
    ok = F.col("_verdict") == "allow"
    seen = _grams(labelled, "_verdict").groupBy("g").agg(F.sum(ok.cast("double")).alias("a"), F.sum((~ok).cast("double")).alias("r"))
    seen = checkpointed(seen)  # all orders are summed up from these counts
    model, shorter = None, None
    for k in range(1, ORDER + 1):
        grams = seen.groupBy(F.substring(F.col("g"), ORDER - k + 1, k).alias("g")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = Window.partitionBy(F.substring(F.col("g"), 1, k - 1))
        grams = grams.withColumns({"na": F.sum("a").over(context), "nr": F.sum("r").over(context)})
        grams = grams.withColumn("s", F.substring(F.col("g"), 2, k - 1))
        if shorter is None:
            grams = grams.withColumns({"pa0": F.lit(1 / 256), "pr0": F.lit(1 / 256)})
        else:
            grams = grams.join(shorter, "s")  # wherever a gram stands, so does its shorter one
        grams = grams.withColumns({
            "pa": (F.col("a") + SMOOTH * F.col("pa0")) / (F.col("na") + SMOOTH),
            "pr": (F.col("r") + SMOOTH * F.col("pr0")) / (F.col("nr") + SMOOTH)})
        shorter = grams.select(F.col("g").alias("s"), F.col("pa").alias("pa0"), F.col("pr").alias("pr0"))
        own = grams.select("g", (F.log("pa") - F.log("pr")).alias("delta"))
        model = own if model is None else model.unionByName(own)
    return model


def score_urls(urls: DataFrame, model: DataFrame) -> DataFrame:
    """(_url, score) of distinct URLs: the mean log ratio, each character in its longest context that the model has.

    Each distinct gram of the URLs finds its ratio once; the URLs then meet that table, broadcast if it is counted to be
    small and shuffled by gram otherwise, where adaptive skew splitting deals with the grams that stand in most URLs.
    """
    model = broadcast_if_few(model)
    grams = _grams(urls).groupBy("g").agg(F.lit(0).alias("_one"))
    found = []
    for k in range(ORDER, 0, -1):
        part = model.where(F.length("g") == k).select(F.col("g").alias(f"g{k}"), F.col("delta").alias(f"d{k}"))
        grams = grams.join(part, F.substring(F.col("g"), ORDER - k + 1, k) == F.col(f"g{k}"), "left")
        found.append(F.col(f"d{k}"))
    ratios = broadcast_if_few(checkpointed(grams.select("g", F.coalesce(*found, F.lit(0.0)).alias("delta"))))
    return _grams(urls, "_url").join(ratios, "g").groupBy("_url").agg((F.sum("delta") / F.count("*")).alias("score"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row: the lower edge of the bin from which on a URL is allowed. ``scored``: score, verdict, n."""
    b = F.floor(F.col("score") * STEPS)
    ok = F.col("_verdict") == "allow"
    bins = scored.groupBy(b.alias("b")).agg(F.sum(F.when(ok, F.col("_n")).otherwise(0)).alias("a"), F.sum(F.when(~ok, F.col("_n")).otherwise(0)).alias("r"))
    up, every = Window.partitionBy().orderBy("b"), Window.partitionBy()  # a few hundred bins
    rates = bins.select("b", (F.sum("r").over(up.rowsBetween(Window.unboundedPreceding, -1))).alias("cut"),
                        F.sum("a").over(up.rowsBetween(0, Window.unboundedFollowing)).alias("let"),
                        F.sum("a").over(every).alias("ta"), F.sum("r").over(every).alias("tr"))
    gain = F.coalesce(F.col("cut"), F.lit(0)) / F.col("tr") + F.col("let") / F.col("ta")
    best = rates.where((F.col("ta") > 0) & (F.col("tr") > 0)).select("b", gain.alias("gain"))
    return best.agg(F.max_by("b", F.struct("gain", -F.abs(F.col("b")), "b")).alias("b")).select((F.col("b") / STEPS).alias("cut"))


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the model's score of the URL and its threshold."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("_url"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("_verdict", verdict)
    judged_by_rule, held = F.col("_verdict").isNotNull(), held_back(F.col("_url"))
    model = checkpointed(train(rows.where(judged_by_rule & ~held).select("_url", "_verdict")))
    urls = rows.groupBy("_url", "_verdict").agg(F.count("*").alias("_n"))
    scores = checkpointed(urls.join(score_urls(urls.select("_url"), model), "_url"))
    cut = threshold(scores.where(judged_by_rule & held))
    # the threshold is one row; a left join keeps the pages where there is none
    out = rows.join(scores.select("_url", "score"), "_url", "left").join(F.broadcast(cut), F.lit(True), "left")
    judged = F.when(F.col("score") < F.col("cut"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce(F.col("_verdict"), judged).alias("verdict"), "score", F.col("cut").alias("threshold"))
