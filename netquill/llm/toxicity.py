"""Operator 7, toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly.

A word's vector is the mean of the embeddings of its character n-grams (3 to 6 characters of the word
between markers, and the whole word), hashed to a fixed table, so a misspelling shares most of its
vector with the word it stands for. A text's vector is the mean of its distinct words' vectors, and a
softmax over two classes reads it. Embeddings and softmax are trained together by Adam on the labelled
texts, both classes weighing the same; no other feature and no second model takes part.

Words of few training texts (``WORD_SHARE`` of them, two at least) and n-grams of fewer than
``MIN_TEXTS`` carry no embedding, so a rare word says nothing by itself; it still counts in the mean.

Training takes at most ``per_class`` labelled texts of each class (``labels.training_rows``) in one
task; scoring reads every whole text, and since the logit is linear in the n-grams, a word costs one
lookup.

Defined results for odd input: a null, empty or wordless text has the zero vector, so its score is that
of the intercept; without labelled rows, with one class only, or without a word that training texts
share, the score is the share of toxic labels (0 without any); a text counts whole, however long;
repeated rows score alike, and a document is trained on once, however often its row is repeated;
columns named like an output are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import io
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquill.llm.common import append_columns, binaries, table
from netquill.llm.hashing import PrefixHash, U, mix
from netquill.llm.labels import fitted, fold, training_rows

BUCKETS, DIM = 1 << 16, 8
PER_CLASS = 2500
FOLDS = 5
CACHE_WORDS = 100_000
#: optimiser steps, the size of the first (it falls to nothing), and the pull of embeddings to zero
STEPS, RATE, DECAY = 80, 0.3, 1e-6
#: words of a smaller share of the training texts, and n-grams of fewer texts, carry no embedding
WORD_SHARE, MIN_TEXTS = 0.0016, 4
EDGES = b".,;:!?\"'()[]{}<>|$%&*#@~^_=+-/\\"


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words without punctuation around them."""
    return [w for w in (x.strip(EDGES) for x in text.lower().split()) if w]


def ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table places of the n-grams of each word, and how many each word has."""
    marked = [f"<{w.decode('utf-8', 'replace')}>" for w in words]
    data = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
    size = np.array([len(w) for w in marked])
    base = np.cumsum(size) - size
    hashed = PrefixHash(data)
    parts, owners = [hashed.slices(base, base + size) + U(9)], [np.arange(len(words))]
    for n in (3, 4, 5, 6):
        count = np.maximum(size - n + 1, 0)
        owner = np.repeat(np.arange(len(words)), count)
        at = base[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        parts.append(hashed.slices(at, at + n) + U(n))
        owners.append(owner)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    place = (mix(np.concatenate(parts)) >> U(48)).astype(np.int64) % BUCKETS
    return place[order], np.bincount(owner, minlength=len(words))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows, ``counts`` of them each."""
    out = np.zeros((len(counts), values.shape[1]), values.dtype)
    some = counts > 0
    if len(values):
        out[some] = np.add.reduceat(values, (np.cumsum(counts) - counts)[some], axis=0)
    return out


class _Gather:
    """Means of rows by owner, and the way back: ``items`` (rows of a table) belong to owners in runs of
    ``counts``; a mean is over ``sizes``."""

    def __init__(self, items: np.ndarray, counts: np.ndarray, sizes: np.ndarray):
        self.items, self.counts = items, counts
        self.sizes = np.maximum(sizes, 1)[:, None].astype(np.float32)
        back = np.argsort(items, kind="stable")
        self.owner = np.repeat(np.arange(len(counts), dtype=np.int32), counts)[back]
        ordered = items[back]
        self.heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        self.at = ordered[self.heads]

    def mean(self, table: np.ndarray) -> np.ndarray:
        return _sums(table[self.items], self.counts) / self.sizes

    def back(self, grad: np.ndarray, rows: int) -> np.ndarray:
        """Gradient of the table's rows from that of the means."""
        out = np.zeros((rows, grad.shape[1]), np.float32)
        out[self.at] = np.add.reduceat((grad / self.sizes).astype(np.float32)[self.owner], self.heads, axis=0)
        return out


def _train(words: _Gather, texts: _Gather, y: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, float]:
    """Adam on all texts at once: n-grams to word means to text means to the softmax. Returns the logit
    of each n-gram and the intercept."""
    rng = np.random.default_rng(7)
    params = [
        rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32) * active[:, None],
        rng.normal(0, 0.5, (DIM, 2)),
        np.zeros(2),
    ]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    weight = (0.5 / np.bincount(y, minlength=2))[y][:, None]
    target = np.eye(2)[y] * weight
    for step in range(1, STEPS + 1):
        emb, out, bias = params
        rate = RATE * (1 - (step - 1) / STEPS)
        vectors = texts.mean(words.mean(emb))
        logits = vectors @ out + bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        error = p * weight - target
        to_words = texts.back(error @ out.T, len(words.counts))
        grad = (words.back(to_words, BUCKETS) + DECAY * emb) * active[:, None]
        for k, g in enumerate((grad, vectors.T @ error + DECAY * out, error.sum(axis=0))):
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            params[k] = params[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-10)
    emb, out, bias = params
    return emb @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def fit(texts: list[bytes], labels: list[int]) -> bytes:
    """Train on labelled texts; the model as npz bytes."""
    y = np.array(labels)
    out = io.BytesIO()

    def constant() -> bytes:
        np.savez(out, constant=np.array([float(y.mean())]))
        return out.getvalue()

    if len(set(labels)) < 2:
        return constant()
    ids: dict[bytes, int] = {}
    docs = [np.array([ids.setdefault(w, len(ids)) for w in sorted(set(words_of(t)))], np.int32) for t in texts]
    sizes = np.array([len(d) for d in docs])
    shared = np.bincount(np.concatenate(docs), minlength=len(ids)) >= max(2, WORD_SHARE * len(texts))
    if not shared.any():
        return constant()
    place = np.cumsum(shared, dtype=np.int32) - 1
    docs = [place[d[shared[d]]] for d in docs]
    grams, counts = ngrams([w for w, k in ids.items() if shared[k]])
    del ids
    grams, first = grams.astype(np.int32), np.cumsum(counts) - counts
    # of how many training texts each n-gram is part
    met = np.zeros(BUCKETS, np.int32)
    for d in docs:
        n = counts[d]
        met[np.unique(grams[np.repeat(first[d] - np.cumsum(n) + n, n) + np.arange(n.sum())])] += 1
    active = met >= MIN_TEXTS
    owner = np.repeat(np.arange(len(counts)), counts)[active[grams]]
    if not len(owner):
        return constant()
    words = _Gather(grams[active[grams]], np.bincount(owner, minlength=len(counts)), counts)
    bags = _Gather(np.concatenate(docs), np.array([len(d) for d in docs]), sizes)
    scores, bias = _train(words, bags, y, active)
    np.savez(out, grams=scores.astype(np.float32), bias=np.array([bias]))
    return out.getvalue()


class Scorer:
    """Scores texts with a fitted model."""

    def __init__(self, model: bytes):
        got = np.load(io.BytesIO(model)) if model else {"constant": np.zeros(1)}
        self.constant = float(got["constant"][0]) if "constant" in got else None
        if self.constant is None:
            self.grams, self.bias = got["grams"].astype(float), float(got["bias"][0])
        self.words: dict[bytes, float] = {}

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        split = [set(words_of(t)) for t in texts]
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        known = self.words
        new = list({w for ws in split for w in ws if w not in known})
        for at in range(0, len(new), 5_000):
            part = new[at : at + 5_000]
            places, counts = ngrams(part)
            values = np.add.reduceat(self.grams[places], np.cumsum(counts) - counts) / counts
            known.update(zip(part, values.tolist()))
        # exact sums, so that the order of a set's words does not show
        found = np.array([fsum(map(known.__getitem__, ws)) / max(len(ws), 1) for ws in split])
        return 1 / (1 + np.exp(-np.clip(found + self.bias, -30, 30)))


_scorers: dict[int, Scorer] = {}


def score_toxicity(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` with toxic_score and toxic_predicted."""
    key = hash(model)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(model)
        texts = binaries(batch, "text")
        scores = np.concatenate([_scorers[key].score(texts[i : i + 500]) for i in range(0, len(texts), 500)] or [np.zeros(0)])
        return {"toxic_score": pa.array(scores), "toxic_predicted": pa.array((scores >= 0.5).astype(np.int32))}

    fields = [T.StructField("toxic_score", T.DoubleType()), T.StructField("toxic_predicted", T.IntegerType())]
    return append_columns(docs, make, fields)


def train_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> bytes:
    """A model from the labelled rows outside the held-out fold."""
    return fitted(training_rows(docs, labels, "toxic", fold(FOLDS) != 0, per_class), fit)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id",
        F.coalesce(fold(FOLDS) == 0, F.lit(False)).alias("held_out"),
        F.col("toxic_score").alias("score"),
        F.col("toxic_predicted").alias("predicted"),
    )
