"""Language identification by unigram models over a fixed public piece vocabulary, summed over all segmentations.

For each language, each piece of the vocabulary has a probability. A word's probability is the sum, over every way to cut
it into pieces, of the product of their probabilities: the forward algorithm over its characters. Words begin with the
vocabulary's word mark. The probabilities come from expectation maximisation over the words of documents with a known
language: forward-backward gives the expected use of each piece, and nothing but the text is used to predict.

Words: runs of bytes beyond ASCII and of ASCII letters, lower-cased, of any length; a word without any letter counts for
nothing. A text's log likelihoods are the sums over its words, and its score the posterior probability of the best language
under equal priors (ties: the smaller name). Forward values are scaled: by a constant per character in words of up to 48
characters, which are taken many at once, and at every position in longer ones, which are taken one by one with only the
last few positions held; logarithms are exact either way.

Bound: the models are fitted to about ``per_language`` documents (300) of each language, chosen by a hash of doc_id, and to
all of their words; every text is predicted whole.

Defined results: ``und`` with score 0 if the text is null or has no letter, or no language was learned (an empty table has
no rows to learn from and gives none); rows with a null lang are not learned from; repeated rows are predicted each, and
equal texts alike. Other columns pass through, but those named like a new one are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, add_text_columns, spread

MARK = "▁"
#: Characters of the words that are taken many at once, and what each position's forward values are multiplied by there:
#: with FLOOR per unknown character it keeps 49 positions between 1e-245 and 1e196.
SHORT, SCALE = 48, 1e4
FLOOR = 1e-9
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


@lru_cache(2)
def vocabulary(path: str) -> tuple[dict[str, int], frozenset[str]]:
    """Pieces of letters (and the word mark) with their numbers, and all prefixes of pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {}
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        body = p.removeprefix(MARK)
        if p == MARK or (body and body.isalpha() and body == body.lower() and MARK not in body):
            pieces[p] = len(pieces)
    return pieces, frozenset(p[:k] for p in pieces for k in range(1, len(p) + 1))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_LETTERS).split()


def arcs(words: list[str], pieces: dict[str, int], prefixes: frozenset[str]) -> tuple[np.ndarray, ...]:
    """(word, start, end, piece) of every piece in every marked word; piece len(pieces) is an unknown character."""
    out: list[int] = []  # the four numbers of an arc in one: lengths are below 64, pieces below 65,536
    other, add, get = len(pieces), out.append, pieces.get
    for k, word in enumerate(words):
        w = MARK + word
        n = len(w)
        for i in range(n):
            at, single = (k << 6 | i) << 6, False
            for j in range(i + 1, n + 1):
                sub = w[i:j]
                if sub not in prefixes:
                    break
                p = get(sub)
                if p is not None:
                    add((at | j) << 16 | p)
                    single = single or j == i + 1
            if not single:
                add((at | i + 1) << 16 | other)
    a = np.array(out, np.int64)
    return a >> 28, a >> 22 & 63, a >> 16 & 63, a & 65535


def by_position(at: np.ndarray) -> list[np.ndarray]:
    """Indices of the arcs at each position."""
    order = np.argsort(at, kind="stable")
    return np.split(order, np.cumsum(np.bincount(at))[:-1])


def forward(words: list[str], arc: tuple[np.ndarray, ...], prob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(alpha, log likelihood) of words of at most SHORT characters: alpha[word, position, language] is SCALE^position times
    the probability of all ways to write the word up to there; prob[piece, language]."""
    k, start, end, piece = arc
    lengths = np.array([len(w) + 1 for w in words])
    size, langs = int(lengths.max()) + 1, prob.shape[1]
    alpha = np.zeros((len(words) * size, langs))
    alpha[np.arange(len(words)) * size] = 1.0
    source, target = k * size + start, k * size + end
    grown = SCALE ** np.arange(size)
    for at, group in enumerate(by_position(end)):
        if at and len(group):
            t = target[group]
            order = group[np.argsort(t, kind="stable")]
            t = target[order]
            first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            alpha[t[first]] = np.add.reduceat(alpha[source[order]] * prob[piece[order]] * grown[at - start[order], None], first)
    return alpha.reshape(len(words), size, langs), np.log(alpha[np.arange(len(words)) * size + lengths]) - lengths[:, None] * np.log(SCALE)


def forward_long(word: str, pieces: dict[str, int], longest: int, prob: np.ndarray) -> np.ndarray:
    """Log likelihoods of a word of any length, position by position; only the last ``longest`` positions are held, each with
    the logarithm it was scaled by."""
    w = MARK + word
    held, scale = {0: np.ones(prob.shape[1])}, {0: np.zeros(prob.shape[1])}
    for end in range(1, len(w) + 1):
        logs = []
        for start in range(max(0, end - longest), end):
            p = pieces.get(w[start:end], len(pieces) if end == start + 1 else None)
            if p is not None:
                logs.append(np.log(held[start]) + scale[start] + np.log(prob[p]))
        top = np.max(logs, axis=0)
        held[end], scale[end] = np.exp(np.array(logs) - top).sum(0), top
        held.pop(end - longest, None)
    return np.log(held[len(w)]) + scale[len(w)]


@dataclass
class Model:
    """langs: names; prob[piece, language], its last row for an unknown character; path: the vocabulary's file."""

    langs: list[str]
    prob: np.ndarray
    path: str


class Scorer:
    """Log likelihoods of words, those of at most SHORT characters remembered up to ``most``."""

    def __init__(self, model: Model, most: int = 400_000):
        self.model, self.most = model, most
        self.pieces, self.prefixes = vocabulary(model.path)
        self.longest = max(map(len, self.pieces), default=1)
        self.slot: dict[bytes, int] = {}
        self.table = np.zeros((1024, len(model.langs) + 1))  # the last column: whether there is a letter

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """By word; a word without a letter has zeros, as has the last column."""
        out = np.zeros((len(words), len(self.model.langs) + 1))
        real = np.array([any(c.isalpha() for c in w) for w in words], bool)
        out[real, -1] = 1
        short = [i for i in np.flatnonzero(real) if len(words[i]) <= SHORT]
        for k in range(0, len(short), 20_000):
            some = [words[i] for i in short[k : k + 20_000]]
            out[short[k : k + 20_000], :-1] = forward(some, arcs(some, self.pieces, self.prefixes), self.model.prob)[1]
        for i in np.flatnonzero(real):
            if len(words[i]) > SHORT:
                out[i, :-1] = forward_long(words[i], self.pieces, self.longest, self.model.prob)
        return out

    def learn(self, words: list[bytes]) -> None:
        """Add the words not yet known."""
        values = self.likelihoods([w.decode("utf-8", "replace") for w in words])
        n = len(self.slot)
        if n + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(n, len(words)), self.table.shape[1]))])
        self.table[n : n + len(words)] = values
        self.slot.update(zip(words, range(n, n + len(words))))

    def __call__(self, texts: list) -> dict:
        langs = self.model.langs
        rows = [words_of(t) for t in texts]
        new = list({w for r in rows for w in r} - self.slot.keys()) if langs else []
        if len(self.slot) + len(new) > self.most:
            self.slot.clear()
            new = list({w for r in rows for w in r})
        if new:
            self.learn(new)
        out: dict = {"lang_pred": [], "score": []}
        for r in rows:
            total = self.table[np.fromiter(map(self.slot.__getitem__, r), np.int64, len(r))].sum(0) if r and langs else np.zeros(len(langs) + 1)
            if not total[-1]:
                out["lang_pred"].append("und")
                out["score"].append(0.0)
                continue
            best = int(total[:-1].argmax())
            out["lang_pred"].append(langs[best])
            out["score"].append(float(1 / np.exp(np.maximum(total[:-1] - total[best], -700)).sum()))
        return out


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Append lang_pred and score."""
    return add_text_columns(df, text, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], lambda: Scorer(model), 4 << 20)


def fit(docs: DataFrame, path: str, scratch: Scratch, per_language: int = 300, rounds: int = 4) -> Model:
    """Learn from ``docs`` (doc_id, text, lang)."""
    known = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((0, 0)), path)
    share = F.create_map(*(x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, per_language / n)))))
    some = known.where(F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            for lang, c in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c)), pa.array([w.decode("utf-8", "replace") for w in c]), pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, held.values())) > 300_000:
                yield from flush()
        yield from flush()

    counts = scratch.save(some.select("text", "lang").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    pieces, prefixes = vocabulary(path)
    prob = np.full((len(pieces) + 1, len(langs)), FLOOR)
    for at, lang in enumerate(langs):
        # all words of a bounded number of documents; one longer than SHORT is learned from by its parts
        rows = counts.where(F.col("lang") == lang).orderBy(F.desc("n"), "word").collect()
        found = [(w[k : k + SHORT], r["n"]) for r in rows for w in (r["word"],) for k in range(0, len(w), SHORT) if any(c.isalpha() for c in w[k : k + SHORT])]
        if found:
            prob[:, at] = estimate([w for w, _ in found], np.array([n for _, n in found], float), pieces, prefixes, rounds)
    return Model(langs, prob, path)


def estimate(words: list[str], weight: np.ndarray, pieces: dict[str, int], prefixes: frozenset[str], rounds: int) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation over weighted words."""
    blocks = [(words[i : i + 5000], weight[i : i + 5000]) for i in range(0, len(words), 5000)]
    blocks = [(w, n, arcs(w, pieces, prefixes)) for w, n in blocks]
    p = np.full(len(pieces) + 1, 1.0 / len(pieces))
    for _ in range(rounds):
        used = np.zeros(len(pieces) + 1)
        for some, n, arc in blocks:
            k, start, end, piece = arc
            alpha, _ = forward(some, arc, p[:, None])
            size = alpha.shape[1]
            alpha, beta = alpha[:, :, 0].ravel(), np.zeros(len(some) * size)
            beta[np.arange(len(some)) * size + np.array([len(w) + 1 for w in some])] = 1.0
            for group in reversed(by_position(start)):
                if len(group):
                    np.add.at(beta, k[group] * size + start[group], beta[k[group] * size + end[group]] * p[piece[group]] * SCALE ** (end - start)[group])
            lengths = np.array([len(w) + 1 for w in some])
            share = alpha[k * size + start] * p[piece] * SCALE ** (end - start) * beta[k * size + end] / alpha[k * size + lengths[k]] * n[k]
            used += np.bincount(piece, share, len(pieces) + 1)
        p = (used + 0.01) / (used.sum() + 0.01 * len(used))
    p[-1] = FLOOR
    return np.maximum(p, FLOOR)
