"""Models, rules, search and the pipeline: against brute force where there is one, else held-out accuracy."""

import hashlib
import math
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from poolwright.llm import attention_lm, language_id, lm_scoring, quality_classifier, quality_rules, queries, topk_search, url_filters

from . import data


def table(spark, name):
    return spark.read.parquet(f"{data.SF}/{name}.parquet")


# --- quality rules


def test_counts_equal_brute_force(spark):
    rows = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    got = queries.op3_quality_rules(spark, data.SF).collect()
    assert len(got) == len(rows)
    for r in got:
        want = data.counts(rows[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_rules_of_odd_rows(spark):
    got = quality_rules.judge(data.messy(spark)).collect()
    want = sorted(data.counts(t) for _, t, *_ in data.messy_rows())
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert not any(r.kept for r in got if r.n_words == 0)
    assert quality_rules.judge(data.messy(spark, empty=True)).collect() == []


def test_estimate_withstands_outliers(spark):
    """A fifth of the points lie far off; the estimate is near that of the others, by a plain concentration."""
    rng = np.random.default_rng(0)
    good = rng.multivariate_normal([1, 2, 0, 3], np.diag([1.0, 4.0, 2.0, 1.0]) + 0.5, 1600)
    bad = rng.normal(0, 0.5, (400, 4)) + [12, -9, 14, 20]
    x = np.vstack((good, bad))
    points = spark.createDataFrame([("c", *map(float, r)) for r in x], "cell string, x0 double, x1 double, x2 double, x3 double").repartition(3)
    est = quality_rules.mcd_estimates(points).collect()[0]
    mean = np.array([est[f"m{i}"] for i in range(4)])
    inv = np.zeros((4, 4))
    for i, j in quality_rules._PAIRS:
        inv[i, j] = inv[j, i] = est[f"p{i}{j}"]
    floor = np.diag(np.square(quality_rules.FLOOR))
    m, c = np.median(x, 0), np.diag(((np.quantile(x, 0.75, 0) - np.quantile(x, 0.25, 0)) / 1.349) ** 2) + floor
    for _ in range(quality_rules.STEPS):
        d = ((x - m) @ np.linalg.inv(c) * (x - m)).sum(1)
        core = x[np.argsort(d)[:math.ceil(quality_rules.CORE * len(x))]]
        m, c = core.mean(0), quality_rules.CONSISTENCY * np.cov(core.T, bias=True) + floor
    assert np.allclose(mean, m, atol=0.1) and np.allclose(np.linalg.inv(inv), c, atol=0.35)
    far = ((bad - mean) @ inv * (bad - mean)).sum(1)
    near = ((good - mean) @ inv * (good - mean)).sum(1)
    assert (far > quality_rules.CUT).all() and (near < quality_rules.CUT).mean() > 0.999


def test_planted_outliers_of_spotless_cells_are_rejected(spark):
    """Symbols, repeated lines, repeated words below the base limit; in cells of their own and put together."""
    lines = lambda seed, n: [data.prose(1000 * seed + k, 10) for k in range(n)]
    rows, bad = [], set()
    for cell, (lang, source, size) in enumerate((("en", "a", 150), ("fr", "a", 80), ("de", "b", 40), ("de", "c", 40))):
        for k in range(size):
            rows.append((1000 * cell + k, "\n".join(lines(1000 * cell + k, 12 + k % 9)), lang, source))
        text = lines(1000 * cell + 999, 20)
        share = [w for x in text for w in x.split()]
        for k, planted in enumerate((" ".join(w + "#" * (j % 3 == 0) for j, w in enumerate(share)),  # 6 to 7 symbols per 100 characters
                                     "\n".join(x + "\nread more\nread more" * (j < 16) for j, x in enumerate(text)),  # 60 % of lines
                                     " ".join(share + share[:26]))):  # 23 % of words
            i = 1000 * cell + 900 + k
            rows.append((i, planted, lang, source))
            bad.add(i)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = quality_rules.judge(docs).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == bad


# --- LM scoring


def test_gradients():
    rng = np.random.default_rng(2)
    vocab = attention_lm.vocabulary(rng.integers(0, 50, 3000).astype(float))
    p = {k: x.astype(np.float64) for k, x in attention_lm.start(vocab).items()}
    ids = rng.integers(0, 3000, (3, attention_lm.KEYS + 1))
    goal = ids[:, attention_lm.KEYS - attention_lm.QUERIES + 1:]
    args = vocab.row[ids[:, :-1]], vocab.group[goal], vocab.place[goal]
    _, d = attention_lm.gradients(p, *args)
    for k in attention_lm.NAMES:
        at = np.unravel_index(np.abs(d[k]).argmax(), d[k].shape)
        up, down = ({a: x.copy() for a, x in p.items()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        slope = (attention_lm.gradients(up, *args)[0] - attention_lm.gradients(down, *args)[0]) / 2e-5
        assert abs(slope - d[k][at]) < 1e-4 * max(1e-3, abs(slope))


def test_scores_are_log_probabilities():
    """The probabilities of all ids after a text sum to one, and do not look at what follows."""
    rng = np.random.default_rng(4)
    vocab = attention_lm.vocabulary(rng.zipf(1.5, 1500).clip(max=10_000).astype(float))
    s = attention_lm.Scorer(attention_lm.start(vocab), vocab)
    for n in (1, 15, 16, 17, 50):
        text = rng.integers(0, 1500, n).astype(np.int32)
        every = np.concatenate([np.append(text, i) for i in range(1500)]).astype(np.int32)
        got = s.log10(every, np.arange(1501) * (n + 1), 0)
        assert abs((10 ** (got - s.log10(text, np.array([0, n]), 0)[0])).sum() - 1) < 1e-4


@pytest.fixture(scope="module")
def lm_rows(spark):
    return queries.op4_lm_scoring(spark, data.SF).collect()


def check_base(got, rows):
    """Counts and unigram scores against brute force."""
    lower = [(i, data.words((t or "").translate(data.LOWER))) for i, t in rows]
    c: Counter = Counter()
    for i, w in lower:
        if data.crc(i) is not None and data.crc(i) % 10:
            c.update([*w, None])
    n, v = sum(c.values()), len(c)
    want = []
    for i, w in lower:
        t = [*w, None]
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        want.append((str(i), data.crc(i) is not None and data.crc(i) % 10 == 0, len(t), sum(c[x] > 0 for x in t), n, round(base, 4)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == sorted(want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_lm_counts_equal_brute_force(spark, lm_rows):
    check_base(lm_rows, [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()])


def test_lm_learns(spark, monkeypatch):
    """On held-out texts, training cuts a fifth of what the id counts alone leave open."""
    per = []
    for rounds in (0, lm_scoring.ROUNDS):
        monkeypatch.setattr(lm_scoring, "ROUNDS", rounds)
        held = [r for r in lm_scoring.score(table(spark, "documents")).collect() if r.held_out]
        per.append(sum(r.score for r in held) / sum(r.n_tokens for r in held))
    assert per[1] > 0.8 * per[0]


def test_lm_trains_on_every_window(monkeypatch):
    """A shard's round passes over all its windows, however many."""
    seen = []

    def gradients(p, rows, *_):
        seen.extend((rows[:, 0] * 65536 + rows[:, 1]).tolist())
        return 0.0, {k: np.zeros_like(x) for k, x in p.items()}

    monkeypatch.setattr(attention_lm, "gradients", gradients)
    every = np.arange(1 << 16)
    vocab = attention_lm.Vocabulary(*[every] * 6)
    for n in (70_000, 100):
        seen.clear()
        ids = np.zeros((n, attention_lm.KEYS + 1), np.uint16)
        ids[:, 0], ids[:, 1] = np.arange(n) // 65536, np.arange(n) % 65536
        attention_lm.train({"E": np.zeros(2), "M": np.zeros(2), "W": np.zeros(2)}, vocab, ids, 0.01, 0)
        assert set(seen) == set(range(n)) and (n < 1000 or len(seen) == n)


def test_lm_windows_have_each_id_as_goal_once(spark):
    """Each id of a text and its end is a goal once, after the ids that it is scored after; fill is none."""
    texts = {1: data.prose(1, 9000), 2: "short", 3: None, 4: " \n", 5: data.prose(2, 40)}
    path, ahead = lm_scoring.vocabulary_path(), attention_lm.KEYS - attention_lm.QUERIES + 1
    coder = lm_scoring.Tokenizer(path)
    for i, text in texts.items():
        docs = spark.createDataFrame([(i, text)], "doc_id long, text string")
        ids = [*coder.words([w.encode() for w in (text or "").lower().split()])[0].tolist(), lm_scoring.END_ID]
        seen = [lm_scoring.END_ID] * ahead + ids
        want = Counter((tuple(seen[k:k + ahead]), seen[k + ahead]) for k in range(len(ids)))
        rows, goals = lm_scoring._windows([bytes(r.ids) for r in lm_scoring.training_windows(docs, path).collect()])
        got = Counter((tuple(w[k:k + ahead]), w[k + ahead]) for w, n in zip(rows.tolist(), goals.tolist()) for k in range(n))
        assert got == want


def test_fill_does_not_count():
    rng = np.random.default_rng(3)
    vocab = attention_lm.vocabulary(rng.integers(0, 50, 3000).astype(float))
    p = {k: x.astype(np.float64) for k, x in attention_lm.start(vocab).items()}
    ids, goals, got = rng.integers(0, 3000, (3, attention_lm.KEYS + 1)), np.array([attention_lm.QUERIES, 5, 1]), []
    for fill in (7, 2900):
        for w, n in zip(ids, goals):
            w[attention_lm.KEYS - attention_lm.QUERIES + 1 + n:] = fill
        goal = ids[:, attention_lm.KEYS - attention_lm.QUERIES + 1:]
        got.append(attention_lm.gradients(p, vocab.row[ids[:, :-1]], vocab.group[goal], vocab.place[goal], goals))
    assert np.isclose(got[0][0], got[1][0]) and all(np.allclose(got[0][1][k], got[1][1][k]) for k in attention_lm.NAMES)


@pytest.mark.parametrize("by", (1, 40))
def test_lm_step_equals_its_formula(by):
    """Loss and slopes of a batch with fill, also where exponentials would overflow, against one goal after the other."""
    rng = np.random.default_rng(5)
    vocab = attention_lm.vocabulary(rng.zipf(1.5, 3000).clip(max=10_000).astype(float))
    p = {k: x.astype(np.float64) * (by if k in ("Wq", "W", "M") else 1) for k, x in attention_lm.start(vocab).items()}
    ids, goals, late = rng.integers(0, 3000, (4, attention_lm.KEYS + 1)), np.array([16, 3, 16, 1]), attention_lm.KEYS - attention_lm.QUERIES
    args = vocab.row[ids[:, :-1]], vocab.group[ids[:, late + 1:]], vocab.place[ids[:, late + 1:]], goals

    def log_share(z, at):
        return z[at] - z.max() - math.log(np.exp(z - z.max()).sum())

    def loss(p):
        out = []
        for rows, group, place, n in zip(*args):
            x = p["E"][rows] + p["P"]
            for k in range(n):
                s = x[:late + k + 1] @ p["Wk"] @ (x[late + k] @ p["Wq"]) / math.sqrt(attention_lm.WIDTH)
                a = np.exp(s - s.max())
                h = x[late + k] + (a / a.sum()) @ x[:late + k + 1] @ p["Wv"] @ p["Wo"]
                g = h + np.maximum(h @ p["W1"] + p["b1"], 0) @ p["W2"]
                out.append(-log_share(g @ p["W"] + p["b"], group[k]))
                if group[k] < attention_lm.GROUPS:
                    out[-1] -= log_share(g @ p["M"][group[k]] + p["c"][group[k]], place[k])
        return out

    got, d = attention_lm.gradients(p, *args)
    if max(loss(p)) < 30:  # shares below 1e-30 count as 1e-30
        assert abs(got - np.mean(loss(p))) < 1e-6
    for k in attention_lm.NAMES:
        at = np.unravel_index(np.abs(d[k]).argmax(), d[k].shape)
        up, down = ({a: x.copy() for a, x in p.items()} for _ in range(2))
        up[k][at] += 1e-6
        down[k][at] -= 1e-6
        slope = (np.mean(loss(up)) - np.mean(loss(down))) / 2e-6
        assert abs(slope - d[k][at]) < 1e-3 * max(1e-3, abs(slope)), k


def test_lm_step_is_not_split_by_group(monkeypatch):
    """A step takes three softmaxes over its goals, not one more for each group of ids."""
    calls = []

    class Numpy:
        def __getattr__(self, name):
            if name == "exp":
                calls.append(name)
            return getattr(np, name)

    rng = np.random.default_rng(6)
    vocab = attention_lm.vocabulary(rng.integers(0, 50, 3000).astype(float))
    ids = rng.integers(0, 3000, (attention_lm.BATCH, attention_lm.KEYS + 1))
    goal = ids[:, attention_lm.KEYS - attention_lm.QUERIES + 1:]
    monkeypatch.setattr(attention_lm, "np", Numpy())
    attention_lm.gradients(attention_lm.start(vocab), vocab.row[ids[:, :-1]], vocab.group[goal], vocab.place[goal])
    assert len(calls) <= 3


def test_lm_train_equals_adam(monkeypatch):
    rng = np.random.default_rng(7)
    p = {k: rng.standard_normal(n).astype(np.float32) for k, n in (("P", 5), ("E", 4), ("M", 3), ("W", 2), ("b", 1))}
    given = [{k: (rng.standard_normal(x.shape) * 10.0 ** rng.integers(-6, 1)).astype(np.float32) for k, x in p.items()} for _ in range(8)]
    left = iter(given)
    monkeypatch.setattr(attention_lm, "gradients", lambda *_: (0.0, next(left)))
    ids = np.zeros((4 * attention_lm.BATCH, attention_lm.KEYS + 1), np.uint16)
    vocab = attention_lm.Vocabulary(*[np.zeros(1, int)] * 6)
    got = attention_lm.train(p, vocab, ids, 0.01, 0)
    for k, x in p.items():
        x, m, v = x.astype(float), 0.0, 0.0
        for t, d in enumerate(given, 1):
            m, v = 0.9 * m + 0.1 * d[k], 0.99 * v + 0.01 * d[k].astype(float) ** 2
            x = (x - 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)) * (1 - 0.01 * attention_lm.DECAY if k in ("E", "M", "W") else 1)
        assert np.allclose(got[k], x, atol=1e-5)


def test_words_are_tokenized_many_at_once(monkeypatch):
    """The ids of each word are those of the word alone, in far fewer calls."""
    import random

    rng = random.Random(8)
    words = ["".join(rng.choice("ab1'st\u00e9\u03bb\u65e5<|>.,-_\x00\u0301\U0001f600") for _ in range(rng.randint(1, 9))) for _ in range(5000)]
    words[1000:1003] = ["a\u00a0b", "\u3000", "x" * 1000]  # white space inside, and cut words
    coder = lm_scoring.Tokenizer(lm_scoring.vocabulary_path())
    encode, calls = coder.encode, []

    def alone(w):
        return [i for k in range(0, len(w), lm_scoring.LONG_WORD) for i in encode((" " if k == 0 else "") + w[k:k + lm_scoring.LONG_WORD])]

    monkeypatch.setattr(coder, "encode", lambda s: calls.append(s) or encode(s))
    ids, starts = coder.words([w.encode() for w in words])
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [alone(w) for w in words]
    assert len(calls) < 1000
    assert [x.tolist() for x in coder.words([])] == [[], [0]]


def test_lm_of_odd_rows(spark):
    check_base(lm_scoring.score(data.messy(spark)).collect(), [(i, t) for i, t, *_ in data.messy_rows()])
    assert lm_scoring.score(data.messy(spark, empty=True)).collect() == []


# --- top-k search


def brute_top(rows, k, every):
    v = {i: [math.floor(256 * float(x)) for x in e] for i, e in rows}
    out = []
    for q in v:
        if q % every == 0:
            cut = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
            best = sorted((-cut(sum(a * b for a, b in zip(v[q], v[i]))), i) for i in v if i != q and len(v[i]) == len(v[q]))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_search_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{data.SF}/embeddings.parquet'")
    assert sorted(map(tuple, queries.op5_topk_search(spark, data.SF).collect())) == sorted(con.execute(topk_search.SQL).fetchall())


def test_search_over_several_nodes_and_ties(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "NODE_ROWS", 100)
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 150)
    monkeypatch.setattr(topk_search, "QUERY_ROWS", 8)
    monkeypatch.setattr(topk_search, "QUERY_BLOCKS", 2)
    rng = np.random.default_rng(1)
    v = np.concatenate((rng.normal(0, 0.2, (300, 6)) + rng.choice([-3, 0, 3], (300, 1)), np.tile(rng.normal(0, 1, 6), (400, 1)), rng.integers(-1, 2, (200, 6)) / 256))
    rows = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)]
    got = topk_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), query_every=10).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, 5, 10)


def test_search_of_odd_rows(spark):
    good = [(0, [1.0, -0.5]), (50, [0.25, 2.0]), (50, [0.25, 2.0]), (7, [1e6, -1e6]), (100, [3.0]), (8, [4.0]), (150, []), (1, [0.0, 0.0]), (200, [1e30, -2.0])]
    bad = [(9, None), (10, [None, 1.0]), (11, [float("nan"), 1.0]), (12, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>").withColumns({c: F.lit("own") for c in ("v", "node", "dim", "score", "rank", "block")})
    got = sorted(map(tuple, topk_search.top_k(df).collect()))
    rows = [(i, [float(np.float32(x)) for x in e]) for i, e in dict(good).items()]
    want = brute_top(rows, 5, 50)
    assert [t[:3] for t in got] == [t[:3] for t in want]
    assert all(a == b or abs(a - b) <= abs(b) * 1e-9 for a, b in zip([t[3] for t in got], [t[3] for t in want]))
    assert topk_search.top_k(df.limit(0)).collect() == []


# --- URL filters


def brute_rule(url):
    m = (url or "").split("://", 1)
    if len(m) < 2:
        return "", "", None, None
    import re

    host, path = re.match(r"([^/?#]*)([^?#]*)", m[1], re.S).groups()
    host = host.translate(data.LOWER)
    fits = [(len(r), r, v) for r, v in url_filters.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def brute_urls(urls):
    """Verdicts by the model as the module's docstring states it."""
    order, start, end = url_filters.ORDER, url_filters.START * (url_filters.ORDER - 1), url_filters.END
    held = lambda u: int(hashlib.md5(u.encode()).hexdigest()[:8], 16) % 5 == 0
    ruled = [(u or "", *brute_rule(u)) for u in urls]
    count = {"allow": Counter(), "block": Counter()}
    for u, _, _, _, v in ruled:
        if v and not held(u):
            t = start + u + end
            count[v].update(t[i:i + order] for i in range(len(t) - order + 1))
    prob, delta = {"": (1 / 256, 1 / 256)}, {}
    for k in range(1, order + 1):
        own = [Counter(), Counter()]
        context = [Counter(), Counter()]
        for c, v in enumerate(("allow", "block")):
            for g, n in count[v].items():
                own[c][g[order - k:]] += n
                context[c][g[order - k:-1]] += n
        nxt = {}
        for g in set(own[0]) | set(own[1]):
            base = prob[g[1:]] if k > 1 else prob[""]
            p = [(own[c][g] + url_filters.SMOOTH * base[c]) / (context[c][g[:-1]] + url_filters.SMOOTH) for c in (0, 1)]
            nxt[g], delta[g] = tuple(p), math.log(p[0]) - math.log(p[1])
        prob = nxt

    def score(u):
        t = start + u + end
        return sum(next((delta[t[i + order - k:i + order]] for k in range(order, 0, -1) if t[i + order - k:i + order] in delta), 0.0) for i in range(len(t) - order + 1)) / (len(u) + 1)

    bins = {"allow": Counter(), "block": Counter()}
    for u, _, _, _, v in ruled:
        if v and held(u):
            bins[v][math.floor(score(u) * url_filters.STEPS)] += 1
    na, nr = (sum(bins[v].values()) for v in ("allow", "block"))
    cut = None
    if na and nr:
        gain = {b: sum(n for x, n in bins["block"].items() if x < b) / nr + sum(n for x, n in bins["allow"].items() if x >= b) / na for b in set(bins["allow"]) | set(bins["block"])}
        cut = max(gain, key=lambda b: (round(gain[b], 9), -abs(b), b)) / url_filters.STEPS
    return [(h, p, r, v or ("block" if cut is not None and score(u) < cut else "allow")) for u, h, p, r, v in ruled]


def test_urls_equal_brute_force(spark):
    rows = table(spark, "pages").select("page_id", "url").collect()
    want = {r.page_id: w for r, w in zip(rows, brute_urls([r.url for r in rows]))}
    got = queries.op6_url_filters(spark, data.SF).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == want and len(got) == len(rows)


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "https://EXAMPLE.com/de/x?q=1", "http://a.org/fr/", "http://org/fr/1", "http://xorg/fr/1", "ftp://b.net", "http://b.net/?u", "http://b.net/e",
            "http://b.example.net/en/a", "http://b.example.net/EN/a", "x://y://z.net/", "http://c.io/\nnew#f", "http://d.io/" + "p" * 3000, "http://a.org/fr/", "HTTP://É.net/ü"]
    rows = [(None if k == 3 else k, u) for k, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("own") for c in ("host", "path", "rule", "verdict", "_url", "score", "g", "b")})
    got = url_filters.filter_urls(df)
    assert got.schema["verdict"].dataType.simpleString() == "string"
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in got.collect()) == sorted(
        (str(i), h, p, str(r), v) for (i, _), (h, p, r, v) in zip(rows, brute_urls(urls)))
    assert url_filters.filter_urls(df.limit(0)).collect() == []
    assert {r.verdict for r in url_filters.filter_urls(df.where("url like '%c.io%'")).collect()} == {"allow"}  # nothing to learn from


# --- quality classifier


def test_classifier_on_labels_that_it_has_not_seen(spark):
    """Half of the labels are taken away; the classifier agrees with at least 95 % of them."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = F.xxhash64("doc_id") % 2 == 0
    got = quality_classifier.classify(docs, labels.where(seen))
    rows = got.join(labels.where(~seen), "doc_id").collect()
    assert len(rows) > 100 and sum(r.kept == (r.quality == 1) for r in rows) >= 0.95 * len(rows)
    assert got.count() == docs.count()


def test_classifier_of_odd_rows(spark):
    docs = data.messy(spark)
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(20, 48)] + [(1, None, 0), (None, 1, 1), (25, 0, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_classifier.classify(docs, labels).collect()
    assert len(got) == len(data.messy_rows())
    assert all(r.score == 0 and not r.kept for r in got if r.doc_id in (4, 5, 6))
    kept = quality_classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    none = quality_classifier.classify(docs, labels.where("quality = 1")).collect()
    assert all(r.kept and r.score is None for r in none) and len(none) == len(got)
    assert quality_classifier.keep_good(data.messy(spark, empty=True), labels).collect() == []


def test_one_row_of_an_id_reaches_the_driver(spark, monkeypatch):
    docs = data.messy(spark)
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(20, 48)], "doc_id long, quality int, toxic int")
    verdicts = lambda rows: {(r.doc_id, round(r.score, 6), r.kept) for r in rows}
    want = verdicts(quality_classifier.classify(docs, labels).collect())
    more, got = docs.where("doc_id = 25").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("k"), []
    plain = type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda self: got.append(plain(self)) or got[-1])
    again = quality_classifier.classify(docs.unionByName(more), labels).collect()
    assert len(got) == 1 and got[0].num_rows == len(set(got[0]["doc_id"].to_pylist())) == 28  # the labelled ones
    assert verdicts(again) == want


def brute_co_training(known, shards):
    """Weights of both views by target, with dense rows. ``known``: (labels, packed features); ``shards``: lists of packed features."""
    q = quality_classifier

    def dense(rows):
        text, meta = np.zeros((len(rows), q.VIEW_SIZES[0])), np.zeros((len(rows), q.VIEW_SIZES[1]))
        for i, r in enumerate(rows):
            n = np.frombuffer(r["tn"], "<u4")
            text[i, np.frombuffer(r["tc"], "<u2")] = np.sqrt(n / (n.sum() / q.TERMS))
            np.add.at(meta[i], np.frombuffer(r["mc"], "<u2"), 0.5)
        return text, meta

    def fit(x, y, weight, start=None, steps=q.FIT_STEPS):
        weight = weight.copy()
        for c in (0, 1):
            weight[y == c] /= max(weight[y == c].sum(), 1e-9)
        x = np.column_stack((x, np.ones(len(x))))
        w, m, v = np.zeros(x.shape[1]) if start is None else start.copy(), 0, 0
        for t in range(1, steps + 1):
            g = (weight * (1 / (1 + np.exp(-(x @ w))) - y)) @ x + q.PENALTY * np.append(w[:-1], 0)
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w = w - (0.3 if start is None else 0.1 * (steps - t + 1) / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        return w

    views, out = dense([r for _, r in known]), []
    for t in range(len(q.TARGETS)):
        y = np.array([labels[t] for labels, _ in known])
        aside = np.zeros(len(y), bool)
        for c in (0, 1):
            aside[np.flatnonzero(y == c)[::4]] = True
        own, test = (y >= 0) & ~aside, (y >= 0) & aside
        line = lambda x, w: x @ w[:-1] + w[-1]
        first = [fit(x[own], y[own], np.ones(own.sum())) for x in views]
        total = [0.0, 0.0]
        for shard in shards:
            pool, w = dense(shard), list(first)
            told = [{}, {}]
            for _ in range(q.ROUNDS):
                for k in (0, 1):
                    a, b = q.fit_platt(line(views[k][test], w[k]), y[test].astype(float))
                    for i, p in enumerate(1 / (1 + np.exp(-(a * line(pool[k], w[k]) + b)))):
                        if p >= q.SURE or p <= 1 - q.SURE:
                            told[1 - k].setdefault(i, int(p >= q.SURE))
                for k in (0, 1):
                    rows = sorted(told[k])
                    new = np.array([told[k][i] for i in rows], int)
                    weight = [min(1, (y[own] == c).sum() / (new == c).sum()) for c in new]
                    w[k] = fit(np.vstack((views[k][own], pool[k][rows])), np.append(y[own], new), np.append(np.ones(own.sum()), weight), w[k], q.ROUND_STEPS)
            total = [s + len(shard) * x for s, x in zip(total, w)]
        out.append([s / sum(map(len, shards)) for s in total])
    return out


def test_co_training_over_shards_equals_brute_force(spark, monkeypatch):
    """All unlabelled documents take part, in shards of about 40."""
    q = quality_classifier
    docs = spark.read.parquet(f"{data.SF}/documents.parquet")
    labels = docs.where("doc_id % 3 = 0").select("doc_id", (F.col("lang") == "en").cast("int").alias("quality"), (F.length("text") > 1000).cast("int").alias("toxic"))
    labels = labels.withColumn("toxic", F.when(F.col("doc_id") % 2 == 0, F.col("toxic")))
    monkeypatch.setattr(q, "POOL", 40)
    known = q.known_labels(labels).cache()
    free = q.unlabelled_features(docs.unionByName(docs), known).cache()  # copies count once
    shards = {}
    for r in set(free.collect()):
        shards.setdefault(r.shard, []).append(r.asDict())
    assert len(shards) > 2
    got = q.co_train(q.labelled_sample(docs, known), free)
    told = {r.doc_id: (r.quality, r.toxic) for r in known.collect()}
    packed = pa.Table.from_batches(q._features(docs.toArrow().sort_by("doc_id").to_batches(), ("doc_id",))).to_pylist()
    rows, ids = [r for r in packed if r["doc_id"] in told], Counter(r["doc_id"] for r in packed)
    assert max(ids.values()) == 1
    want = brute_co_training([(told[r["doc_id"]], r) for r in rows], list(shards.values()))
    alone = brute_co_training([(told[r["doc_id"]], r) for r in rows], [[rows[0]]])
    assert np.abs(want[0][1] - alone[0][1]).max() > 0.01  # the exchange matters
    for target, (text, meta) in zip(got, want):
        # the step of a weight is its gradient by its size, so rounding shows in weights of hardly any gradient
        assert np.abs(target.text - text).max() < 1e-3 and np.abs(target.meta - meta).max() < 1e-3


def packed_features(texts, langs=None):
    n = len(texts)
    rows = pa.record_batch({"text": texts, "lang": langs or ["en"] * n, "source": ["s"] * n, "n_chars": [9] * n})
    return pa.Table.from_batches(list(quality_classifier._features(iter([rows]), ())))


def test_an_exchange_needs_little_beside_its_rows(monkeypatch):
    """Under 40 bytes for each entry of a shard, as several workers share an executor; with whole arrays it took 61."""
    q = quality_classifier
    monkeypatch.setattr(q, "ENTRIES", 4096)
    of = lambda n: packed_features([" ".join(f"{'ab'[k % 2]}{(k * 31 + j * 7) % 5000}" for j in range(300)) for k in range(n)], [f"l{k % 2}" for k in range(n)])
    y = np.arange(400) % 2
    sample = q.Sample(q._views(of(400)), np.array([y, y]), np.array([np.arange(400) % 8 < 2] * 2))
    start = [q.fit_logistic([x], y.astype(float), size) for x, size in zip(sample.views, q.VIEW_SIZES)]
    packed, picked = of(4000), []
    entries = sum(map(len, packed["tc"].to_pylist())) // 2
    plain = q.Sparse.pick
    monkeypatch.setattr(q.Sparse, "pick", lambda self, rows: picked.append(len(rows)) or plain(self, rows))
    tracemalloc.start()
    try:
        q.exchange(sample, 0, start, q._views(packed))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert max(picked) > 3000  # most rows are told
    assert peak < 40 * entries, peak / entries


def test_rows_in_slices_are_the_same(monkeypatch):
    """Views, products and sums do not depend on how many rows are worked on at once, nor on copies and their order."""
    q = quality_classifier
    packed = packed_features([" ".join(f"w{(k * k + j) % 50}" for j in range(1 + k % 9)) for k in range(60)] + ["one long text " * 50])
    text, meta = q._views(packed)
    x, w = np.random.default_rng(1).standard_normal(len(text.ptr) - 1), np.random.default_rng(2).standard_normal(q.VIEW_SIZES[0])
    want, sums = text.dot(w), text.sums(x, len(w))
    dense = np.zeros((len(x), len(w)))
    for i, (a, b) in enumerate(zip(text.ptr, text.ptr[1:])):
        dense[i, text.col[a:b]] = text.val[a:b]
    assert np.abs(want - dense @ w).max() < 1e-12 and np.abs(sums - x @ dense).max() < 1e-12
    monkeypatch.setattr(q, "ENTRIES", 7)
    again = q._views(packed)[0]
    assert (again.val == text.val).all() and np.abs(text.dot(w) - want).max() < 1e-12 and np.abs(text.sums(x, len(w)) - sums).max() < 1e-12
    twice = pa.concat_tables([packed.slice(20), packed])
    order = np.random.default_rng(3).permutation(len(twice))
    one, other = (q._distinct_views(t.to_batches(max_chunksize=k)) for t, k in ((packed, 11), (twice.take(pa.array(order)), 5)))
    assert all((a == b).all() for v, u in zip(one, other) for a, b in zip(v, u))
    assert sorted(one[0].dot(w)) == pytest.approx(sorted(dict.fromkeys(want.round(12))), abs=1e-9)


def test_toxic_documents_go_and_clean_ones_stay(spark):
    """Insults in a third of the documents of good quality; labels of half; the other half is judged."""
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("a").alias("source"), F.lit(9).cast("long").alias("n_chars"))
    word = lambda k: data.prose(k, 80).split()
    texts = [(k, " ".join(word(k)[:40] + (["You", "rotten", "wretch!"] if k % 3 == 0 else ["and", "so"]) + word(k)[40:])) for k in range(900)]
    docs = docs.join(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id")
    labels = docs.where("doc_id % 2 = 0").select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    got = quality_classifier.classify(docs, labels).where("doc_id % 2 = 1").collect()
    assert len(got) == 450 and all(r.score is None for r in got)  # all labels say good quality
    wrong = [r for r in got if r.kept == (r.doc_id % 3 == 0)]
    assert len(wrong) <= 4, (len(wrong), wrong[:5])
    assert all(r.toxic_score is None and r.kept for r in quality_classifier.classify(docs, labels.drop("toxic")).collect())


# --- language identification


def test_word_likelihood_sums_all_segmentations():
    pieces = language_id.Pieces(language_id.vocabulary_path())
    names = {p: k for k, p in enumerate(pieces.names)}
    prob = np.column_stack((pieces.base, np.roll(pieces.base, 7)))
    prob[-1] = language_id.STRANGE

    def brute(w, p):
        def ways(s):
            if not s:
                return 1.0
            return sum(p[k] * ways(s[n:]) for n in range(1, min(len(s), language_id.LONGEST) + 1)
                       if (k := names.get(s[:n], pieces.strange if n == 1 else None)) is not None)

        return math.log(ways(language_id.MARK + w))

    words = ["the", "schreiben", "été", "日本", "a", "zzzz", "niño"]
    got = pieces.log_likelihoods(words, prob)
    assert np.allclose(got, [[brute(w, prob[:, k]) for k in (0, 1)] for w in words])
    long = pieces.log_likelihoods(["q" * 5000], prob)
    assert np.isfinite(long).all()
    # expected counts are the slopes of the log-likelihood in the log-probabilities
    words.append("th" * 40)
    e = pieces.expected_counts(words, np.ones((len(words), 1)))
    for name in ("th", "e", "▁the", "▁t"):
        up, down = pieces.base.copy(), pieces.base.copy()
        up[names[name]] *= 1 + 1e-4
        down[names[name]] *= 1 - 1e-4
        slope = (pieces.log_likelihoods(words, up[:, None]).sum() - pieces.log_likelihoods(words, down[:, None]).sum()) / 2e-4
        assert abs(slope - e[names[name], 0]) < 1e-3 + 1e-3 * slope


def test_no_piece_of_the_vocabulary_is_too_long():
    import sentencepiece

    path = language_id.vocabulary_path()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = {model.id_to_piece(k).lower() for k in range(model.get_piece_size())}
    letters = {p for p in every if p.rfind(language_id.MARK) <= 0 and all(c.isalpha() or c == language_id.MARK for c in p)} - {""}
    pieces = language_id.Pieces(path)
    assert set(pieces.names) >= letters and language_id.LONGEST == max(map(len, letters))
    # the whole word's piece is among its segmentations
    arcs = next(pieces.lattices(["international"]))[2]
    assert pieces.names.index("▁international") in [int(piece[0]) for _, _, rows, piece in arcs if rows is not None]


def test_languages_of_held_out_texts(spark):
    got = language_id.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = got.join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (data.crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_languages_of_odd_rows(spark):
    docs = data.messy(spark)
    got = language_id.identify(docs).collect()
    assert len(got) == len(data.messy_rows())
    for r in got:
        if r.doc_id in (4, 5, 6):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        if r.doc_id is None:
            assert not r.held_out
    relabelled = docs.withColumns({"source": F.lit("z"), "n_chars": F.lit(1)})
    assert sorted(map(str, language_id.identify(relabelled).collect())) == sorted(map(str, got))
    assert {r.lang_pred for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(data.messy(spark, empty=True)).collect() == []


def test_search_with_repeated_rows_equals_its_sql(spark, tmp_path):
    """Rows that repeat an id and vector count once; an id with two vectors is two rows; ties go to the smaller id."""
    import duckdb

    from poolwright.llm import topk_search

    rng = np.random.default_rng(8)
    rows = [(k, rng.integers(-2, 3, 6).astype(float).tolist()) for k in range(220)]
    rows += rows[:60] + [(50, [0.25] * 6), (7, [2.0] * 6), (100, rows[100][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    frame.write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/e/*.parquet')")
    got = sorted((r.query_id, r.rank, r.score) for r in topk_search.top_k(frame).collect())
    assert got == sorted((q, r, x) for q, r, _, x in con.execute(topk_search.SQL).fetchall())
