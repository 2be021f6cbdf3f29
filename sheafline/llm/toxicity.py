"""Toxic spans by a linear-chain conditional random field over two tags, clean and toxic.

Tokens: runs of letters and digits (any byte beyond ASCII counts as a letter), A-Z lower-cased. A token's features are the
word and its prefixes of 4, 5 and 6 characters, so that inflected forms share what is learned of their stem.

Labelled tokens. Labels mark documents, so tokens are labelled first. A feature marks toxic tokens if it occurs in so
many toxic documents and (almost) no clean one that chance is ruled out, and after many different words: what copies of one
document share always follows the same ones. A token of a toxic document with such a feature is toxic, every other token
is clean. The field is then fitted to windows around such tokens and around tokens of clean documents that bear a candidate
feature: maximum likelihood with a Gaussian prior, by forward-backward and Adam.

Scoring. Forward-backward over the whole text gives each token's marginal. A document's score is the probability that at
least one of its tokens with a marginal of 0.1 or more is toxic (these taken as independent), else its largest marginal.
Offending spans are maximal runs of tokens with a marginal of 0.5 or more, as character offsets into the text.

Bound: the field is fitted to at most ``most`` labelled documents (8,000), of those that the table has the ones with the
smallest hashes of doc_id; of these all candidate features and all windows are used, whole. Every document is scored
whole. Labels, lang, source and doc_id never enter a score.

Defined results: a null or empty text, or one without tokens, scores 0 and has no spans; without labelled rows of both
kinds everything scores 0; rows of one doc_id with several labels count as toxic if one of them does; a score of just 0.5
is predicted 1; repeated rows are scored each, and equal texts alike; an empty table gives no rows. Other columns pass
through, but those named like a new one are replaced.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BoundedCache, Scratch, add_text_columns, spread

#: A-Z to lower case, other ASCII than letters and digits to a space: as long as the text, so offsets stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
PREFIXES = (4, 5, 6)
WINDOW = 5


def features(word: bytes) -> list[str]:
    w = word.decode("utf-8", "replace")
    return ["=" + w, *(w[:k] for k in PREFIXES if len(w) >= k)]


@dataclass
class Field:
    """weights: of the tag toxic against clean, by feature; bias; start: the first tag's log odds; trans: 2 x 2, [from, to]."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -20.0
    start: float = 0.0
    trans: tuple = ((0.0, 0.0), (0.0, 0.0))


class _Emission(BoundedCache):
    """A word's log odds of toxic against clean, before its neighbours are looked at."""

    limit = 32 << 20

    def __init__(self, model: Field):
        super().__init__()
        self.weights, self.bias = model.weights, model.bias

    def make(self, word: bytes) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))


def marginals(rows: list[np.ndarray], model: Field) -> list[np.ndarray]:
    """Each token's probability of the tag toxic, by forward-backward over all rows at once, step by step."""
    order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
    lengths = np.array([len(rows[i]) for i in order])
    out: list[np.ndarray] = [np.zeros(0)] * len(rows)
    if not len(lengths) or lengths[0] == 0:
        return out
    # tokens of all rows by position: position p of the first alive[p] rows, which lie together
    steps = int(lengths[0])
    alive = np.searchsorted(-lengths, -np.arange(steps), "left")
    offsets = np.concatenate([[0], np.cumsum(alive)])
    flat = np.concatenate([rows[i] for i in order if len(rows[i])])
    place = np.concatenate([offsets[: len(rows[i])] + k for k, i in enumerate(order) if len(rows[i])])
    e = np.empty(offsets[-1])
    e[place] = np.exp(np.clip(flat, -30, 30))
    (oo, ot), (to, tt) = (tuple(float(np.exp(x)) for x in r) for r in model.trans)
    ahead = np.empty_like(e)  # odds of toxic against clean, given what stands up to here
    a = ahead[: alive[0]]
    np.multiply(e[: alive[0]], float(np.exp(model.start)), out=a)
    for p in range(1, steps):
        lo, hi = offsets[p], offsets[p + 1]
        a = a[: alive[p]]
        a = e[lo:hi] * (ot + a * tt) / (oo + a * to)
        ahead[lo:hi] = a
    behind = np.ones_like(e)  # odds of what follows, given toxic against clean here
    b = np.ones(alive[steps - 1])
    for p in range(steps - 2, -1, -1):
        n = alive[p + 1]
        x = e[offsets[p + 1] : offsets[p + 2]] * b
        b = np.ones(alive[p])
        b[:n] = (to + x * tt) / (oo + x * ot)
        behind[offsets[p] : offsets[p + 1]] = b
    odds = ahead * behind
    p_all = (odds / (1 + odds))[place]
    for i, part in zip([i for i in order if len(rows[i])], np.split(p_all, np.cumsum([len(rows[i]) for i in order if len(rows[i])])[:-1])):
        out[i] = part
    return out


def score_of(p: np.ndarray) -> float:
    high = p[p >= 0.1]
    return float(1 - np.prod(1 - high)) if len(high) else float(p.max()) if len(p) else 0.0


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())]))


def spans_of(data: bytes, p: np.ndarray) -> list[dict]:
    """Character spans (start, end, largest marginal) of the toxic runs; ``data`` is the folded text."""
    if not len(p) or p.max() < 0.5:
        return []
    out, last, char, at = [], None, 0, 0
    for k, m in enumerate(re.finditer(rb"[^ ]+", data)):
        if p[k] < 0.5:
            continue
        char += len(data[at : m.start()].decode("utf-8"))
        end = char + len(m[0].decode("utf-8"))
        if last == k - 1:
            out[-1].update(end=end, p=max(out[-1]["p"], float(p[k])))
        else:
            out.append({"start": char, "end": end, "p": float(p[k])})
        char, at, last = end, m.end(), k
    return out


def tag(df: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """Append score, predicted (1 from a score of 0.5) and spans (character offsets of offending runs)."""

    def make():
        emission = _Emission(model)

        def run(texts: list) -> dict:
            folded = [(t or "").encode().translate(_FOLD) for t in texts]
            rows = []
            for data in folded:
                words = data.split()
                rows.append(np.fromiter(map(emission.__getitem__, words), np.float64, len(words)))
            found = marginals(rows, model)
            scores = [score_of(p) for p in found]
            return {"score": scores, "predicted": [int(s >= 0.5) for s in scores], "spans": [spans_of(d, p) for d, p in zip(folded, found)]}

        return run

    return add_text_columns(df, text, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("spans", SPAN)], make)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, scratch: Scratch, most: int = 8_000) -> Field:
    """Fit the field to the labelled documents of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # at most ``most`` rows of two numbers: small enough to send to every executor
    picked = scratch.save(known.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    train = scratch.save(spread(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")))
    totals = dict(train.groupBy("toxic").count().collect())
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return Field()

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def flush():
            rows = [(f, c, x) for x in (0, 1) for f, c in held[x].items()]
            held[0].clear()
            held[1].clear()
            if rows:
                fs, cs, xs = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(fs), pa.array(cs, pa.int64()), pa.array(xs, pa.int32())], names=["feature", "n", "toxic"])

        for batch in batches:
            for text, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[x].update({f for w in set((text or "").encode().translate(_FOLD).split()) for f in features(w)})
                if len(held[0]) + len(held[1]) > 300_000:
                    yield from flush()
        yield from flush()

    by = train.select("text", "toxic").mapInArrow(counts, "feature string, n long, toxic int").groupBy("feature").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    # so often in toxic documents alone by chance less than once in a million features
    least = max(3, math.ceil(math.log(1e-6) / math.log(n_toxic / (n_toxic + n_clean))))
    odds = n_clean / n_toxic
    able = by.where((F.col("t") >= least) & (F.col("c") <= 0.02 * F.col("t") * odds))
    candidates = {r["feature"]: r["t"] for r in able.collect()}
    if not candidates:
        return Field()

    def contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for t in batch.column(0).to_pylist():
                words = (t or "").encode().translate(_FOLD).split()
                found.update((f, a.decode("utf-8", "replace")) for a, w in zip([b"", *words], words) for f in features(w) if f in candidates)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], names=["feature", "before"])

    found = train.where("toxic = 1").select("text").mapInArrow(contexts, "feature string, before string").distinct().groupBy("feature").count().collect()
    seeds = {r["feature"] for r in found if r["count"] >= max(3, min(8, 0.3 * candidates[r["feature"]]))}
    if not seeds:
        return Field()

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, list[str]] = {}
        for batch in batches:
            out = []
            for text, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = (text or "").encode().translate(_FOLD).split()
                hits = []
                for k, w in enumerate(words):
                    if len(memo) > 100_000:
                        memo.clear()
                    fs = memo.get(w)
                    if fs is None:
                        fs = memo[w] = [f for f in features(w) if f in candidates]
                    if fs:
                        hits.append(k)
                # windows that touch are one; a document without a hit gives its start
                runs: list[list[int]] = []
                for k in hits or [0]:
                    if runs and k - WINDOW <= runs[-1][1]:
                        runs[-1][1] = min(k + WINDOW, len(words))
                    elif words:
                        runs.append([max(0, k - WINDOW), min(len(words), k + WINDOW + 1)])
                for lo, hi in runs:
                    out.append(json.dumps([[(fs := memo.get(w) or [f for f in features(w) if f in candidates]), int(x == 1 and any(f in seeds for f in fs))] for w in words[lo:hi]]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["w"])

    rows = scratch.save(train.select("text", "toxic").mapInArrow(windows, "w string")).collect()
    return train_field([json.loads(w) for w in sorted(r["w"] for r in rows)])


class _Block:
    """Windows of about the same length as arrays; features by number."""

    def __init__(self, windows: list[list], index: dict[str, int]):
        self.n, self.longest = len(windows), max(map(len, windows))
        self.mask, self.tags = np.zeros((self.n, self.longest), bool), np.zeros((self.n, self.longest))
        cell, feat = [], []
        for i, w in enumerate(windows):
            self.mask[i, : len(w)] = True
            for j, (fs, y) in enumerate(w):
                self.tags[i, j] = y
                cell += [i * self.longest + j] * len(fs)
                feat += [index[f] for f in fs]
        self.cell, self.feat = np.array(cell, np.int64), np.array(feat, np.int64)
        inner, y0, y1 = self.mask[:, 1:], self.tags[:, :-1], self.tags[:, 1:]
        self.seen = np.array([[((1 - y0) * (1 - y1) * inner).sum(), ((1 - y0) * y1 * inner).sum()], [(y0 * (1 - y1) * inner).sum(), (y0 * y1 * inner).sum()]])

    def gradient(self, theta: np.ndarray, k: int) -> np.ndarray:
        """Of the log likelihood; theta: ``k`` weights, the bias, the start, the transitions."""
        n, longest, mask = self.n, self.longest, self.mask
        e = theta[k] + np.bincount(self.cell, theta[self.feat], n * longest).reshape(n, longest)
        tr = np.exp(theta[k + 2 :].reshape(2, 2))
        emit = np.stack([np.ones_like(e), np.exp(np.clip(e, -30, 30))], -1)
        emit[~mask] = 1.0
        alpha, beta = np.empty((longest, n, 2)), np.ones((longest, n, 2))
        alpha[0] = emit[:, 0] * np.exp([0.0, theta[k + 1]])
        alpha[0] /= alpha[0].sum(1, keepdims=True)
        for t in range(1, longest):
            a = (alpha[t - 1] @ tr) * emit[:, t]
            a /= a.sum(1, keepdims=True)
            alpha[t] = np.where(mask[:, t, None], a, alpha[t - 1])
        pairs = np.zeros((2, 2))
        for t in range(longest - 1, 0, -1):
            x = emit[:, t] * beta[t]
            joint = alpha[t - 1][:, :, None] * tr * x[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            pairs += joint[mask[:, t]].sum(0)
            b = x @ tr.T
            b /= b.sum(1, keepdims=True)
            beta[t - 1] = np.where(mask[:, t, None], b, 1.0)
        post = (alpha * beta)[..., 1] / (alpha * beta).sum(-1)
        diff = np.where(mask, self.tags - post.T, 0.0)
        grad = np.zeros_like(theta)
        grad[:k] = np.bincount(self.feat, diff.ravel()[self.cell], k)
        grad[k] = diff.sum()
        grad[k + 1] = diff[:, 0].sum()
        grad[k + 2 :] = (self.seen - pairs).ravel()
        return grad


def train_field(windows: list[list], rounds: int = 80, rate: float = 0.3, prior: float = 0.002, cells: int = 200_000) -> Field:
    """Maximum likelihood by Adam; ``windows``: lists of (features, tag), taken in blocks of similar length."""
    names = sorted({f for w in windows for fs, _ in w for f in fs})
    index = {f: k for k, f in enumerate(names)}
    blocks, now = [], []
    for w in sorted(windows, key=len):
        if now and (len(now) + 1) * len(w) > cells:
            blocks.append(_Block(now, index))
            now = []
        now.append(w)
    blocks.append(_Block(now, index))
    k = len(names)
    theta = np.zeros(k + 6)
    theta[k] = -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = sum(map(len, windows))
    for step in range(1, rounds + 1):
        grad = sum(b.gradient(theta, k) for b in blocks) / total * 100 - prior * np.where(np.arange(k + 6) == k, 0, theta)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = {f: float(theta[i]) for f, i in index.items() if abs(theta[i]) > 1e-3}
    return Field(weights, float(theta[k]), float(theta[k + 1]), tuple(map(tuple, theta[k + 2 :].reshape(2, 2).tolist())))
