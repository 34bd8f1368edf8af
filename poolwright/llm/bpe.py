"""Byte-level BPE encoding and decoding with a public vocabulary file, by a pair occurrence index.

The distinct pre-tokens of an Arrow batch are laid out as one symbol array with links to the neighbours.
An index maps each pair that has a rank to all its positions; active ranks are applied in ascending order
(a heap), all positions of a rank at once, and only the lists of the pairs next to a merge are updated.
As a token is made by one merge, and any merge that uses it ranks later (checked on loading), this gives
the merges that the usual loop over each word gives.

``encode`` adds ``ids`` (little-endian unsigned 32-bit integers, binary), ``decode`` adds ``decoded`` (text).
Null text reads as empty: no ids, decoded as the empty text. Repeated rows are encoded alike, whole texts of
any length are taken, an empty table gives no rows, and only the named columns are read.
"""

from __future__ import annotations

import heapq
import itertools
import json
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import slices

#: The byte-level pre-tokenizer's pattern (fixed value of the vocabulary's kind). White space is spelled out: the
#: regex library also counts U+001C to U+001F, the tokenizers library doesn't.
_WS = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def word_pattern(letter: str = r"\p{L}", number: str = r"\p{N}") -> str:
    return (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{_WS}{letter}{number}]+"
            rf"|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def newer_characters() -> list[str]:
    """Letters and numbers of the regex library that the tokenizers library doesn't count as such.

    The two know different versions of Unicode; only characters that Python's tables lack can differ.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    known = regex.compile(r"[\p{L}\p{N}]")
    new = (chr(c) for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn")
    return [c for c in new if known.match(c) and len(split("!" + c)) == 1]


#: Pre-tokens that a worker remembers before it starts afresh (memory only; results don't depend on it).
REMEMBERED = 150_000
AT_ONCE = 25_000  # pre-tokens


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else the next from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


class Vocabulary:
    """Ids, merges by pair, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, letters = spec["model"]["vocab"], _byte_letters()
        of = {c: b for b, c in enumerate(letters)}
        self.byte_id = np.array([ids[c] for c in letters], np.int64)
        self.bytes = [b""] * (max([*ids.values(), *(a["id"] for a in spec["added_tokens"])]) + 1)
        for text, i in ids.items():
            self.bytes[i] = bytes(of[c] for c in text)
        self.special = {}
        for a in spec["added_tokens"]:
            self.special[a["content"]] = a["id"]
            self.bytes[a["id"]] = a["content"].encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([ids[b] for _, b in pairs], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        born = np.full(len(self.bytes), -1)
        born[self.made] = np.arange(len(pairs))
        own = np.arange(len(pairs))
        if len(np.unique(self.made)) != len(pairs) or (born[self.left] >= own).any() or (born[self.right] >= own).any():
            raise ValueError("a merge uses a token that a later merge makes; ranks can't be applied in ascending order")
        keys = self.left << 32 | self.right
        self._order = np.argsort(keys)
        self._keys = keys[self._order]
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(word_pattern())
        newer = "".join(newer_characters())
        self.newer = frozenset(newer)
        plain = rf"--[{newer}]" if newer else ""
        self.careful = regex.compile(word_pattern(rf"[\p{{L}}{plain}]", rf"[\p{{N}}{plain}]"), regex.V1)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if it is no merge."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._order[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words back to back, and the number of ids of each word."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        n = int(lens.sum())
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lens)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        last = np.append(word[1:] != word[:-1], True)
        first = np.append(True, last[:-1])
        after[last], before[first] = -1, -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Put the pairs that begin at these positions into the index."""
            rank = self.ranks(sym[at], sym[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if len(at) == 0:
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            heads = rank[np.append(0, cut)].tolist()
            for r, part in zip(heads, np.split(at, cut)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(part)

        note(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[r], self.right[r]
            nxt = after[at]
            good = alive[at] & (nxt >= 0) & (sym[at] == a) & (sym[nxt] == b)
            at, nxt = at[good], nxt[good]
            if len(at) == 0:
                continue
            if a == b and len(at) > 1:  # in a run of overlapping pairs, every other one from the left
                at = np.sort(at)
                nxt = after[at]
                head = np.append(True, nxt[:-1] != at[1:])
                run = np.arange(len(at)) - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
                at, nxt = at[run % 2 == 0], nxt[run % 2 == 0]
            sym[at] = self.made[r]
            alive[nxt] = False
            far = after[nxt]
            after[at] = far
            back = far >= 0
            before[far[back]] = at[back]
            prev = before[at]
            fresh = np.concatenate((prev[prev >= 0], at[after[at] >= 0]))
            if len(fresh):
                note(np.unique(fresh))
        return sym[alive], np.bincount(word[alive], minlength=len(words))


class _Slots(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Encoder:
    """Encodes texts; remembers the ids of the pre-tokens that it has met."""

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self._reset()

    def _reset(self) -> None:
        self.slot = _Slots((s, k) for k, s in enumerate(self.vocab.special))
        self.ids = np.array(list(self.vocab.special.values()), np.int64)
        self.starts = np.arange(len(self.slot) + 1)
        self.odd = np.zeros(len(self.slot), bool)  # holds a character that the quick pattern may cut wrongly

    def _pieces(self, text: str, words: regex.Pattern) -> list[str]:
        v = self.vocab
        if v.splitter is None or not any(s in text for s in v.special):
            return words.findall(text)
        out: list[str] = []
        for part in v.splitter.split(text):
            out += [part] if part in v.special else words.findall(part)
        return out

    def _slots(self, text: str, words: regex.Pattern) -> np.ndarray:
        """The slot of each pre-token of the text; one met for the first time gets the next slot."""
        pieces, slot = self._pieces(text, words), self.slot
        return np.fromiter(map(slot.__getitem__, pieces), np.int64, len(pieces))

    def _learn(self) -> None:
        """Encode the pre-tokens that have a slot but no ids yet."""
        new = list(itertools.islice(self.slot, len(self.odd), None))
        if new:
            for k in range(0, len(new), AT_ONCE):
                ids, counts = self.vocab.encode_words([p.encode() for p in new[k:k + AT_ONCE]])
                self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(counts))
                self.ids = np.append(self.ids, ids)
            newer = self.vocab.newer
            self.odd = np.append(self.odd, [not p.isascii() and not newer.isdisjoint(p) for p in new])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.slot) > REMEMBERED:
            self._reset()
        parts = [self._slots(t, self.vocab.words) for t in texts]
        self._learn()
        again = [k for k, p in enumerate(parts) if self.odd[p].any()]
        for k in again:
            parts[k] = self._slots(texts[k], self.vocab.careful)
        if again:
            self._learn()
        out = []
        for p in parts:
            lens = self.starts[p + 1] - self.starts[p]
            total = int(lens.sum())
            take = np.arange(total) + np.repeat(self.starts[p] - (np.cumsum(lens) - lens), lens)
            out.append(self.ids[take].astype("<u4"))
        return out

    def decode(self, ids: np.ndarray) -> str:
        table = self.vocab.bytes
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", errors="replace")


def encode(docs: DataFrame, path: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``ids``: the token ids of the whole text, special tokens in it included."""
    path = path or vocabulary_path()
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for whole in batches:
            coder = coder or Encoder(path)
            for batch in slices(whole, "_text"):
                ids = coder.encode([t or "" for t in batch.column("_text").to_pylist()])
                cols = [batch.column(c) for c in keep] + [pa.array([x.tobytes() for x in ids], pa.binary())]
                del ids
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "ids"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return docs.select(*keep, docs[text].alias("_text")).mapInArrow(run, f"{schema}, ids binary")


def decode(encoded: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id", "ids")) -> DataFrame:
    """``keep`` and ``decoded``: the text of ``ids``."""
    path = path or vocabulary_path()
    kinds = dict(encoded.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for whole in batches:
            coder = coder or Encoder(path)
            for batch in slices(whole, "_ids"):
                texts = [coder.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column("_ids").to_pylist()]
                cols = [batch.column(c) for c in keep] + [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "decoded"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return encoded.select(*keep, encoded["ids"].alias("_ids")).mapInArrow(run, f"{schema}, decoded string")
