"""Toxicity by subword bags: character n-gram vectors averaged into a linear
softmax, vectors and softmax trained together in numpy.

A word's vector is the mean of the vectors of its n-grams (``<word>`` in 3 to 6
characters), hashed into BUCKETS rows; a text's vector is
the mean over its distinct words, scaled by the root of their number (so that
the sway of chance words is alike in short and long texts).  An unseen misspelling so shares most of its vectors
with the word it hides.  Since the softmax is linear, scoring needs one number
per bucket; a worker remembers the sums of words it has met.

Training reads at most TRAIN_TOXIC + TRAIN_CLEAN labelled rows (those whose
hashed ids come first), whole texts, never the held-out fold.

Defined results: null and empty texts, and texts without a word, score 0;
labels that are null are not used, of several labels of a document the largest
counts; without both classes to learn from every score is 0; a null doc_id is
held out (it hashes as the empty text); an empty table gives an empty table;
columns named like a result give way to it.
"""

from __future__ import annotations

import re
from functools import partial
from math import exp

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, field

TRAIN_TOXIC = 2000
TRAIN_CLEAN = 6000
BUCKETS = 1 << 18
DIM = 4
SHORTEST, LONGEST = 3, 6
EPOCHS = 60
RATE = 0.15
#: Fixed scale of the pooled vector.
GAIN = 5.0
DECAY = 2e-5
#: Added to the root mean square of a gradient, so that n-grams of a few
#: documents, whose gradients are far smaller, move little.
DAMP = 1e-5
FOLDS = 5
WORD = re.compile(r"\w+")
MEMO_ENTRIES = 400_000
#: Words whose n-grams training handles together.
PART = 40_000


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document belongs to the fold kept from training."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def words_of(text: str | None) -> list[str]:
    """The distinct words of a whole text, in order of first occurrence."""
    return list(dict.fromkeys(WORD.findall(text.lower()))) if text else []


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram of ``words``, and the number of
    n-grams of each word (at least one: ``<w>``)."""
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    end = np.repeat(np.cumsum(lengths), lengths)
    number = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    h = np.zeros(len(chars) + 1, np.uint64)
    of, bucket = [], []
    for n in range(1, LONGEST + 1):
        h = h[:-1][:len(chars) - n + 1] * np.uint64(0x100000001B3) + chars[n - 1:] + np.uint64(1)
        if n >= SHORTEST:
            at = np.flatnonzero(np.arange(len(h)) + n <= end[:len(h)])
            x = h[at] * np.uint64(0x9E3779B97F4A7C15)
            of.append(number[at])
            bucket.append((((x ^ (x >> np.uint64(29))) >> np.uint64(7)).astype(np.int64) % BUCKETS).astype(np.int32))
    of, bucket = np.concatenate(of), np.concatenate(bucket)
    return of, bucket, np.bincount(of, minlength=len(words))


class Model:
    """Per-bucket logit weights and the bias; ``None`` weights score 0."""

    def __init__(self, weights: np.ndarray | None, bias: float):
        self.weights, self.bias, self.memo = weights, bias, {}

    def score_all(self, texts: list[str | None]) -> list[float]:
        if self.weights is None:
            return [0.0] * len(texts)
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        bags = [words_of(t) for t in texts]
        new = list(set().union(*bags).difference(memo))
        if new:
            of, bucket, size = subwords(new)
            memo.update(zip(new, (np.bincount(of, self.weights[bucket], len(new)) / size).tolist()))
        return [self._score(sum(map(memo.__getitem__, b)), len(b)) for b in bags]

    def _score(self, total: float, words: int) -> float:
        if not words:
            return 0.0
        z = min(max(GAIN * total / words ** 0.5 + self.bias, -700.0), 700.0)
        return 1 / (1 + exp(-z))

    def score(self, text: str | None) -> float:
        return self.score_all([text])[0]


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Fit vectors and softmax together by full-batch Adam on classes of equal weight."""
    vocab: dict[str, int] = {}
    doc, word, share, y = [], [], [], []
    for text, label in zip(texts, labels):
        ws = words_of(text)
        if ws:
            doc.append(np.full(len(ws), len(y), np.int32))
            word.append(np.array([vocab.setdefault(w, len(vocab)) for w in ws], np.int32))
            share.append(np.full(len(ws), len(ws) ** -0.5, np.float32))
            y.append(label)
    y = np.array(y, np.float64)
    if not len(y) or y.min() == y.max():
        return Model(None, 0.0)
    doc, word, share = map(np.concatenate, (doc, word, share))
    # The n-grams of a part of the words at a time: the driver holds little besides.
    words, parts, size = list(vocab), [], []
    del vocab
    for i in range(0, len(words), PART):
        of, gram, n = subwords(words[i:i + PART])
        parts.append((of + np.int32(i), gram))
        size.append(n)
    del words
    size = np.concatenate(size)
    rng = np.random.default_rng(seed)
    emb, soft, bias = np.zeros((BUCKETS, DIM)), rng.normal(0, 1, DIM), np.zeros(1)
    weight = 0.5 / len(y) / np.where(y == 1, y.mean(), 1 - y.mean())
    params = [emb, soft, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, epochs + 1):
        # The softmax is linear: one number per bucket goes forward and back.
        logit = emb @ soft
        of_word = sum(np.bincount(of, logit[gram], len(size)) for of, gram in parts) / size
        z = GAIN * np.bincount(doc, of_word[word] * share, len(y)) + bias[0]
        d = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight
        back = np.bincount(word, (GAIN * d)[doc] * share, len(size)) / size
        q = sum(np.bincount(gram, back[of], BUCKETS) for of, gram in parts)
        grads = [q[:, None] * soft + DECAY * emb, emb.T @ q + DECAY * soft, np.array([d.sum()])]
        for v, g, m, s in zip(params, grads, first, second):
            m *= 0.9
            m += 0.1 * g
            s *= 0.999
            s += 0.001 * g * g
            v -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + DAMP)
    return Model((emb @ soft).astype(np.float32), float(bias[0]))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int],
           id_col: str = "doc_id", text: str = "text") -> list:
    """Rows (text, label) of at most ``most[class]`` labelled documents of each
    class outside the held-out fold, the same ones each time."""
    known = (labels.where(F.col(label).isNotNull() & ~held_out(id_col))
             .groupBy(id_col).agg(F.max(label).alias("_y")))
    picked = None
    for y, n in most.items():
        part = (known.where(F.col("_y") == y).withColumn("_at", F.xxhash64(F.lit(11), F.col(id_col)))
                .orderBy("_at", id_col).limit(n))
        picked = part if picked is None else picked.unionByName(part)
    # At most sum(most) rows of two numbers, and as many texts: of an id that
    # is repeated the least one.
    return (docs.select(id_col, text).join(F.broadcast(picked), id_col)
            .groupBy(id_col).agg(F.first("_at").alias("_at"), F.min(text).alias("text"), F.first("_y").alias("y"))
            .drop(id_col).collect())


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
        text: str = "text", train_toxic: int = TRAIN_TOXIC, train_clean: int = TRAIN_CLEAN) -> Model:
    rows = sample(docs, labels, label, {1: train_toxic, 0: train_clean}, id_col, text)
    rows.sort(key=lambda r: (r["_at"], r["text"] or ""))
    texts, marks = [r["text"] for r in rows], [int(r["y"]) for r in rows]
    del rows
    return train(texts, marks)


def _scorer(weights: np.ndarray | None, bias: float):
    model = Model(weights, bias)
    return lambda texts: [model.score_all(texts)]


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
          name: str = "score") -> DataFrame:
    """``docs`` plus the probability of the toxic class of each whole text."""
    return annotate(docs, partial(_scorer, model.weights, model.bias), [field(name, T.DoubleType())], text, keep)
