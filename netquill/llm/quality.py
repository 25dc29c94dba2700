"""Operator 3, quality classifier: random Fourier features over document statistics, ridge regression
from partition-summed normal equations, and isotonic calibration.

Each text is reduced to a vector of statistics (sizes, shares of character kinds, repetition of words
and lines, word shapes). Random cosines of the standardised vector approximate a Gaussian kernel; each
partition of the training rows adds up its own ``Z'Z`` and ``Z'y``, the sums are added, and one linear
solve gives the ridge scores. Scores on a part of the rows kept out of the solve fit an isotonic curve
(pool adjacent violators), which turns a score into a share of good texts.

Training takes at most ``per_class`` labelled texts of each class (``labels.training_rows``), so the
sums are few and small; scoring reads every whole text once, without a shuffle.

Defined results for odd input: a null or empty text scores like any text, from statistics that are all
zero; without labelled rows the score is 0, with one class it is that class; columns named like an output
are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquill.llm.common import append_columns, binaries, table
from netquill.llm.labels import fold, training_rows

PER_CLASS, FOLDS, HELD_OUT = 6000, 3, 1
FEATURES, RIDGE, WIDTH = 384, 1e-3, 4.0
N_STATISTICS = 20


def statistics(text: bytes) -> list[float]:
    """The vector of one text."""
    n = len(text)
    if not n:
        return [0.0] * N_STATISTICS
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower, digit = count[65:91].sum(), count[97:123].sum(), count[48:58].sum()
    high, space = count[128:].sum(), count[9:14].sum() + count[32]
    symbols = n - upper - lower - digit - high - space
    words = text.split()
    w = max(len(words), 1)
    known = Counter(words)
    same = sum(map(eq, words, words[1:]))
    lines = text.split(b"\n")
    full = [x for x in lines if x.strip()]
    top = known.most_common(1)[0][1] if known else 0
    odd = count[35] + count[36] + count[37] + count[38] + count[42] + count[64] + count[94] + count[126]
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    return [
        np.log1p(n),
        np.log1p(w),
        n / w,
        lengths.std(),
        upper / max(upper + lower, 1),
        lower / n,
        digit / n,
        high / n,
        space / n,
        symbols / n,
        min(odd / w, 3.0),
        min(count[33] / w, 3.0),
        min(count[124] / w, 3.0),
        min((count[44] + count[46]) / w, 3.0),
        len(known) / w,
        same / w,
        top / w,
        len(set(full)) / max(len(full), 1),
        np.log1p(w / max(len(full), 1)),
        (count[60] + count[62] + count[123] + count[125] + count[61] + count[95]) / n,
    ]


def matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(-1, N_STATISTICS)


def vectors(rows: DataFrame) -> DataFrame:
    """(held, y, x): the statistics of training rows; a quarter, by hashed id, is kept for calibration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(binaries(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("held"), batch.column("y"), pa.array([r.tobytes() for r in x], pa.binary())],
                ["held", "y", "x"],
            )

    held = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(4)) == 0
    return rows.select(held.alias("held"), "y", "text").mapInArrow(run, "held boolean, y int, x binary")


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch.column("x").to_pylist())).reshape(-1, N_STATISTICS)
    return np.array(batch.column("held").to_pylist(), bool), batch.column("y").to_numpy().astype(float), x


def cosines(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features, the statistics themselves and a constant."""
    rng = np.random.default_rng(20)
    omega = rng.normal(0, 1 / WIDTH, (N_STATISTICS, FEATURES))
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((x - mean) / scale, -6, 6)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ omega + phase), z / 10, np.ones((len(x), 1))])


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing curve nearest to ``y`` (pool adjacent violators)."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, first and last score
    for s, v, w in zip(score[order], y[order], weight[order]):
        blocks.append([v, w, s, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            total = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / total, total, a[2], b[3]])
    knots = [(x, b[0]) for b in blocks for x in ((b[2], b[3]) if b[3] > b[2] else (b[2],))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


def train_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> bytes:
    """A model from the labelled rows outside the held-out fold, as npz bytes; empty without rows."""
    rows = training_rows(docs, labels, "quality", fold(FOLDS) != HELD_OUT, per_class)
    data = vectors(rows).persist()
    try:
        return _solve(data)
    finally:
        data.unpersist()


def _solve(data: DataFrame) -> bytes:
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 2 * N_STATISTICS + 1))
        for batch in batches:
            _, y, x = _arrays(batch)
            for c in (0, 1):
                own = x[y == c]
                sums[c] += np.concatenate([own.sum(axis=0), (own * own).sum(axis=0), [len(own)]])
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["part"])

    parts = [np.frombuffer(r.part).reshape(2, -1) for r in data.mapInArrow(moments, "part binary").collect()]
    total = np.sum(parts, axis=0) if parts else np.zeros((2, 2 * N_STATISTICS + 1))
    n = total[:, -1]
    out = io.BytesIO()
    if not n.all():
        if not n.any():
            return b""
        np.savez(out, constant=np.array([float(n[1] > 0)]))
        return out.getvalue()
    # both classes weigh the same
    weight = n.sum() / (2 * n)
    mean = total[:, :N_STATISTICS].sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(total[:, N_STATISTICS:-1].sum(axis=0) / n.sum() - mean**2, 1e-12)) + 1e-6

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = FEATURES + N_STATISTICS + 1
        sums = np.zeros((d + 1, d))
        for batch in batches:
            held, y, x = _arrays(batch)
            z, y = cosines(x[~held], mean, scale), y[~held]
            w = weight[y.astype(int)]
            sums[:d] += (z * w[:, None]).T @ z
            sums[d] += (z * w[:, None]).T @ (2 * y - 1)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["part"])

    # few partitions hold the bounded sample, so few sums of fixed size are added
    system = 0.0
    for r in data.coalesce(8).mapInArrow(equations, "part binary").toLocalIterator():
        system = system + np.frombuffer(r.part).reshape(FEATURES + N_STATISTICS + 2, -1)
    gram, right = system[:-1], system[-1]
    ridge = RIDGE * n.sum() / FEATURES * np.eye(len(gram))
    ridge[-1, -1] = 1e-9
    coef = np.linalg.solve(gram + ridge, right)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, y, x = _arrays(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(held), pa.array(y), pa.array(cosines(x, mean, scale) @ coef)], ["held", "y", "s"]
            )

    scored = data.mapInArrow(raw, "held boolean, y double, s double").toPandas()
    kept = scored[scored.held] if scored[scored.held].y.nunique() == 2 and scored.held.sum() >= 60 else scored
    # the curve gives shares as the labels have them in the sample
    knots, values = isotonic(kept.s.to_numpy(), kept.y.to_numpy(), np.ones(len(kept)))
    np.savez(out, mean=mean, scale=scale, coef=coef, knots=knots, values=values)
    return out.getvalue()


class Scorer:
    """Scores texts with a fitted model."""

    def __init__(self, model: bytes):
        self.model = np.load(io.BytesIO(model)) if model else {"constant": np.zeros(1)}
        self.model = {k: self.model[k] for k in self.model}

    def score(self, texts: list[bytes]) -> np.ndarray:
        m = self.model
        if "constant" in m:
            return np.full(len(texts), m["constant"][0])
        s = cosines(matrix(texts), m["mean"], m["scale"]) @ m["coef"]
        # a small slope keeps the order of texts that the curve pools
        return np.clip(0.98 * np.interp(s, m["knots"], m["values"]) + 0.02 / (1 + np.exp(-np.clip(s, -20, 20))), 0, 1)


_scorers: dict[int, Scorer] = {}


def score_quality(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` with quality_score and quality_predicted."""
    key = hash(model)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(model)
        scores = _scorers[key].score(binaries(batch, "text"))
        return {"quality_score": pa.array(scores), "quality_predicted": pa.array((scores >= 0.5).astype(np.int32))}

    fields = [T.StructField("quality_score", T.DoubleType()), T.StructField("quality_predicted", T.IntegerType())]
    return append_columns(docs, make, fields)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id",
        F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        F.col("quality_predicted").alias("predicted"),
    )
