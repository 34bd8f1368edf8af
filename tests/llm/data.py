"""Small tables with everything that an operator must live through, and brute-force versions of the contracts."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: columns that an operator may use inside, as further columns of the table
CLASHES = ("id", "node", "comp", "_text", "_row", "_id", "_kept", "_null", "kept", "spans", "ids", "n", "key", "block", "word", "h", "_size", "_k0")
SF = "/root/testdata/sf0.001"


def words(text) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def prose(seed: int, n: int, vocabulary: str = "the river carried small boats past old stone mills while quiet farmers counted their winter sheep near tall green hills") -> str:
    import random

    rng = random.Random(seed)
    out = [rng.choice(vocabulary.split()) for _ in range(n)]
    return " ".join(w + ("." if k % 11 == 10 else "") for k, w in enumerate(out))


def messy_rows() -> list[tuple]:
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a", len(base)), (2, base, "en", "b", len(base)), (3, base + " and one more thing", "en", "a", 5), (3, base + " and one more thing", "en", "a", 5),
        (4, None, "en", None, None), (5, "", None, "a", 0), (6, " \t\n ", "fr", "b", 4), (None, base, "en", "a", 3), (None, None, None, None, None),
        (7, "short", "en", "c", 5), (8, prose(2, 30000), "de", "a", 9), (9, "x" * 120_000, "en", "é", 2), (10, "ab " * 5000, "fr", None, 1),
        (11, "日本語 テキスト <|endoftext|> don't \x00 ౜ \U0001f600", "ja", "b", 7), (12, prose(3, 200), "en", "a", None), (13, prose(3, 200).upper(), "en", "a", 1),
        (-5, prose(4, 60) + "\n" + prose(4, 60) + "\n\n" + prose(5, 9), "fr", "b", 8), (1 << 40, prose(6, 300), "de", "c", 8),
    ]
    return rows + [(20 + k, prose(20 + k, 40 + k), ("en", "fr", "de")[k % 3], "abc"[k % 3], 40) for k in range(30)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def messy(spark, empty: bool = False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([] if empty else messy_rows(), SCHEMA)
    return df.repartition(3).withColumns({c: F.lit(f"own {c}") for c in CLASHES})


def crc(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode())


def shingles(text, k: int) -> frozenset:
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset()


def linked_pairs(sets: dict, num: int, den: int) -> list[tuple]:
    inside, common = defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            inside[x].append(i)
    for have in inside.values():
        for a, x in enumerate(have):
            for y in have[a + 1:]:
                common[x, y] += 1
    return [p for p, c in common.items() if den * c >= num * (len(sets[p[0]]) + len(sets[p[1]]) - c)]


def components(nodes, pairs) -> dict:
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def repeats(rows: list[tuple], match: int = 100) -> dict:
    """doc_id -> flags of the removed bytes, for rows (doc_id, text) without null ids."""
    first, out = {}, {}
    for i, t in sorted({(i, t or "") for i, t in rows}):
        b = t.encode()
        gone = out[i] = bytearray(len(b))
        for s in range(len(b) - match + 1):
            at = first.setdefault(b[s:s + match], (i, s))
            if at != (i, s):
                gone[s:s + match] = b"\1" * match
    return out


def counts(text) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
