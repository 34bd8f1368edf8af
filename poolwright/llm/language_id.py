"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary.

Words are runs of letters, lower-cased and begun with a mark. A language gives each vocabulary piece a
probability, and a word the sum, over all ways to cut it into pieces, of the product of their probabilities,
found by the forward algorithm. A text's log-likelihood is the sum over its words; the prediction is the
language of highest posterior, which is also the score.

Piece probabilities come from one expectation-maximisation step over all training texts: forward-backward
under the vocabulary's own rank-based distribution gives the expected pieces of every word, summed per
language by Spark, and smoothed towards that distribution. What reaches the driver is a number for each
language and piece, so at most the vocabulary's size times the number of languages.

A letter outside the vocabulary is a piece of fixed small probability, so any word has a likelihood. Null
texts and texts without a letter are ``und`` with score 0, as are all texts if no language was learned. Rows
with null doc_id are not learned from and not held out. Repeated rows count as rows; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, slices

FOLDS, HELD_OUT = 4, 2
MARK = "▁"
#: log-probability of a letter that is no piece, alike in all languages
STRANGE = 1e-7
#: pieces' worth of the vocabulary's own distribution that is added to each language
PRIOR_PIECES = 2000.0
LONGEST = 16  # letters of the vocabulary's longest piece, with the mark
RESCALE = 12  # starts from one rescaling of the forward mass to the next
WORDS = regex.compile(r"\p{L}+")


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary's letter pieces in a trie, with a rank-based distribution over them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names: dict[str, int] = {}
        for k in range(model.get_piece_size()):
            p = model.id_to_piece(k).lower()
            if 0 < len(p) <= LONGEST and p.rfind(MARK) <= 0 and all(c.isalpha() or c == MARK for c in p):
                names.setdefault(p, len(names))
        names.setdefault(MARK, len(names))
        self.names = list(names)
        self.strange = len(names)  # the piece of letters outside the vocabulary
        weight = 1.0 / (np.arange(len(names)) + 100.0)
        self.base = np.append(weight / weight.sum(), STRANGE)
        # letters of longer pieces get a column of the trie each; column 0 leads nowhere
        letters = sorted({c for p in names if len(p) > 1 for c in p})
        self.column = np.zeros(0x110000, np.int16)
        for k, c in enumerate(letters):
            self.column[ord(c)] = k + 1
        self.single = np.full(0x110000, self.strange, np.int32)
        nodes: dict[str, int] = {"": 0}
        for p in names:
            if len(p) == 1:
                self.single[ord(p)] = names[p]
            for k in range(1, len(p) + 1):
                if len(p) > 1:
                    nodes.setdefault(p[:k], len(nodes))
        self.next = np.full((len(nodes), len(letters) + 1), -1, np.int32)
        self.piece = np.full(len(nodes), -1, np.int32)
        for p, k in nodes.items():
            if p:
                self.next[nodes[p[:-1]], self.column[ord(p[-1])]] = k
                if len(p) > 1:
                    self.piece[k] = names.get(p, -1)

    def lattices(self, words: list[str]) -> Iterator[tuple[np.ndarray, list]]:
        """For each length, the words' places in ``words`` and their lattice: (start, length, rows, piece)."""
        lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
        order = np.argsort(lens, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(lens[order])) + 1):
            if len(part) == 0:
                continue
            n = int(lens[part[0]])
            text = MARK + MARK.join(words[k] for k in part.tolist())
            code = np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(part), n)
            col = self.column[code]
            arcs = []
            for i in range(n):
                arcs.append((i, 1, None, self.single[code[:, i]]))
                rows = np.arange(len(part))
                state = self.next[0, col[:, i]]
                for length in range(2, min(LONGEST, n - i) + 1):
                    on = state >= 0
                    rows, state = rows[on], state[on]
                    if len(rows) == 0:
                        break
                    state = self.next[state, col[rows, i + length - 1]]
                    piece = np.where(state >= 0, self.piece[state], -1)
                    hit = piece >= 0
                    if hit.any():
                        arcs.append((i, length, rows[hit], piece[hit]))
            yield part, n, arcs

    def log_likelihoods(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """Log of each word's probability, summed over its segmentations; ``prob``: (pieces + 1, languages)."""
        out = np.zeros((len(words), prob.shape[1]))
        for part, n, arcs in self.lattices(words):
            forward, scale = self._forward(len(part), n, arcs, prob)
            out[part] = np.log(forward[n]) + scale
        return out

    @staticmethod
    def _forward(count: int, n: int, arcs: list, prob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        forward = np.zeros((n + 1, count, prob.shape[1]))
        forward[0] = 1.0
        scale = np.zeros((count, prob.shape[1]))
        for i, length, rows, piece in arcs:
            if length == 1 and i and i % RESCALE == 0:  # arcs come in order of their start: keep within range
                by = forward[i].copy()
                forward[i:i + LONGEST] /= by
                scale += np.log(by)
            if rows is None:
                forward[i + length] += forward[i] * prob[piece]
            else:
                forward[i + length, rows] += forward[i, rows] * prob[piece]
        return forward, scale

    def expected_counts(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected occurrences of every piece under the base distribution, weighted by ``counts`` (words, languages)."""
        out = np.zeros((len(self.base), counts.shape[1]))
        prob = self.base[:, None]
        for part, n, arcs in self.lattices(words):
            # dividing by the running forward mass at every start keeps all numbers near 1
            ahead = np.zeros((n + 1, len(part)))
            ahead[0] = 1.0
            norm = np.ones((n + 1, len(part)))
            at = 0
            for i, length, rows, piece in arcs:
                if i != at:
                    norm[i] = ahead[i]
                    ahead[i:i + LONGEST] /= norm[i]
                    at = i
                p = prob[piece, 0]
                if rows is None:
                    ahead[i + length] += ahead[i] * p
                else:
                    ahead[i + length, rows] += ahead[i, rows] * p
            back = np.zeros((n + 1, len(part)))
            back[n] = 1.0 / ahead[n]
            weight = counts[part]
            share = []
            at = n
            for i, length, rows, piece in reversed(arcs):
                p = prob[piece, 0]
                f = np.prod(norm[i + 1:i + length + 1], axis=0)  # the forward mass was divided by these on the way
                if rows is None:
                    term = p * back[i + length] / f
                    back[i] += term
                    share.append((piece, term[:, None] * weight))
                else:
                    term = p * back[i + length, rows] / f[rows]
                    back[i, rows] += term
                    share.append((piece, term[:, None] * weight[rows]))
            pieces = np.concatenate([a for a, _ in share])
            shares = np.concatenate([b for _, b in share])
            for k in range(counts.shape[1]):
                out[:, k] += np.bincount(pieces, weights=shares[:, k], minlength=len(self.base))
        return out


class _Slots(dict):
    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def _words(texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the slots of all words of all texts, and the first word of each text."""
    slots, parts = _Slots(), []
    for t in texts:
        found = WORDS.findall(t.lower()) if t else []
        parts.append(np.fromiter(map(slots.__getitem__, found), np.int64, len(found)))
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=first[1:])
    return list(slots), np.concatenate(parts) if parts else np.zeros(0, np.int64), first


def train(docs: DataFrame, path: str | None = None) -> tuple[list[str], np.ndarray] | None:
    """Languages, and the piece probabilities of each (pieces + 1, languages), from rows with a language."""
    path = path or vocabulary_path()
    known = docs.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        total: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for whole in batches:
            pieces = pieces or Pieces(path)
            for batch in slices(whole, limit=16 << 20):
                langs, of = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
                words, slots, first = _words(batch.column("text").to_pylist())
                counts = np.zeros((len(words), len(langs)))
                np.add.at(counts, (slots, np.repeat(of, np.diff(first))), 1.0)
                got = pieces.expected_counts(words, counts) if words else np.zeros((len(pieces.base), len(langs)))
                for k, lang in enumerate(langs):
                    total[lang] = total.get(lang, 0) + got[:, k]
                    rows[lang] = rows.get(lang, 0) + int((of == k).sum())
        for lang, x in total.items():
            on = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(on) + 1), pa.string()), pa.array(np.append(on, -1).astype(np.int32)), pa.array(np.append(x[on], rows[lang]))],
                names=["lang", "piece", "x"])

    sums = known.mapInArrow(run, "lang string, piece int, x double").groupBy("lang", "piece").agg(F.sum("x").alias("x")).toArrow()
    if sums.num_rows == 0:
        return None
    pieces = Pieces(path)
    langs, of = np.unique(np.array(sums.column("lang").to_pylist(), object).astype(str), return_inverse=True)
    piece, x = sums.column("piece").to_numpy(), sums.column("x").to_numpy()
    counts = np.zeros((len(pieces.base), len(langs)))
    counts[piece[piece >= 0], of[piece >= 0]] = x[piece >= 0]
    base = pieces.base[:-1, None]
    prob = (counts[:-1] + PRIOR_PIECES * base) / (counts[:-1].sum(0) + PRIOR_PIECES)
    docs_of = np.zeros(len(langs))
    docs_of[of[piece < 0]] = x[piece < 0]
    # the last two rows: letters outside the vocabulary, and the share of documents
    return langs.tolist(), np.vstack((prob, np.full((1, len(langs)), STRANGE), docs_of / docs_of.sum()))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray] | None, path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score``; reads the text only."""
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", lang_pred string, score double"
    if model is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    path = path or vocabulary_path()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary size times languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        for whole in batches:
            pieces = pieces or Pieces(path)
            langs, table = shared.value
            prob, prior = table[:-1], np.log(table[-1])
            for batch in slices(whole, "_text", 16 << 20):
                words, slots, first = _words(batch.column("_text").to_pylist())
                n = batch.num_rows
                best, score = np.full(n, "und", object), np.zeros(n)
                full = np.flatnonzero(np.diff(first) > 0)
                if len(full):
                    each = pieces.log_likelihoods(words, prob)
                    sums = np.add.reduceat(each[slots], first[full], axis=0) + prior
                    best[full] = np.array(langs, object)[sums.argmax(1)]
                    score[full] = 1.0 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in keep] + [pa.array(best.tolist(), pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def identify(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learned from the documents that are not held out."""
    fold = crc_mod(F.col("doc_id"), FOLDS)
    model = train(docs.where(fold != HELD_OUT).select("lang", "text"), path)
    rows = docs.select("doc_id", "text", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"))
    return predict(rows, model, path, ("doc_id", "held_out"))
