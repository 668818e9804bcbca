"""Quality classifier: random-indexing word vectors, pooled per document, into a two-layer network in numpy.

Words (runs of word characters, and runs of signs) hash to ``SLOTS`` slots. Every slot has a sparse random index vector;
the context vector of a slot is the sum of the index vectors of its neighbours, within ``WINDOW`` places, over the
whole corpus. Tasks add up their own table of slots and send it once; the sum of all has a fixed size, whatever the
corpus. A document is the mean context vector of its words, of its distinct words, how long these means are, and how
often neighbours share an index vector. A network with one hidden layer learns from at most ``TRAIN_ROWS`` labelled
documents; a temperature fitted on rows held out of the training makes its probabilities honest.

Labels come only from rows outside the held-out fold; label, language, source and id are never inputs of a score.

Defined results: a null or empty text has an all-zero vector and gets the score of such a vector; without usable
labels every score is 0.5; a document labelled more than once counts with its mean label; unlabelled documents still
shape the word vectors; repeated rows are scored row by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import each, fields, fold_of, query, table

SLOTS = 1 << 14
DIM = 32
NONZERO = 2
WINDOW = 2
TRAIN_ROWS = 20_000  # the most labelled documents the network learns from, by seeded hash
HIDDEN = 48
EPOCHS = 40
BATCH = 256
RATE = 3e-3
DECAY = 1e-4
SEED = 7
THRESHOLD = 0.7
CHUNK = 1_000_000  # words whose neighbours are counted together
KEPT_WORDS = 500_000
TOKEN = re.compile(r"\w+|[^\w\s]+")


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries per slot; one more slot, all zero, stands between documents."""
    rng = np.random.default_rng(SEED)
    places = rng.integers(0, DIM, (SLOTS + 1, NONZERO))
    places[:, 1] = (places[:, 0] + rng.integers(1, DIM, SLOTS + 1)) % DIM
    signs = rng.choice([-1.0, 1.0], (SLOTS + 1, NONZERO))
    signs[SLOTS] = 0.0
    return places, signs


class _Slots(dict):
    """Word -> slot, kept per worker up to a bound."""

    def __missing__(self, word):
        if len(self) >= KEPT_WORDS:
            self.clear()
        slot = self[word] = xxhash.xxh32_intdigest(word, SEED) & (SLOTS - 1)
        return slot


_slots = _Slots()


def word_slots(text: str | None) -> np.ndarray:
    words = TOKEN.findall(text) if text else []
    return np.fromiter(map(_slots.__getitem__, words), dtype=np.int64, count=len(words))


# ---------------------------------------------------------------- word vectors
def add_contexts(total: np.ndarray, slots: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add to ``total`` (flat, slot by dimension) the index vectors of all neighbours in one row of slots."""
    for step in range(1, WINDOW + 1):
        for word, other in ((slots[:-step], slots[step:]), (slots[step:], slots[:-step])):
            for k in range(NONZERO):
                total += np.bincount(word * DIM + places[other, k], signs[other, k], minlength=len(total))


def _context_tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    places, signs = index_vectors()
    total = np.zeros((SLOTS + 1) * DIM)
    gap = np.full(WINDOW, SLOTS, dtype=np.int64)
    waiting, size = [], 0

    def count():
        if waiting:
            add_contexts(total, np.concatenate(waiting), places, signs)
            waiting.clear()

    for batch in batches:
        for text in batch["text"]:
            slots = word_slots(text)
            for start in range(0, len(slots), CHUNK):  # a very long text goes by parts that share their border
                part = slots[max(0, start):start + CHUNK]
                waiting += [part, gap]
                size += len(part)
                if start:
                    border = slots[start - WINDOW:start + WINDOW]
                    waiting += [_crossing(border, k) for k in range(1, WINDOW + 1)]
                if size >= CHUNK:
                    count()
                    size = 0
    count()
    rows = total.reshape(-1, DIM)[:SLOTS].astype(np.int64)
    used = np.flatnonzero(rows.any(axis=1))
    frame = pd.DataFrame(rows[used], columns=[f"c{k}" for k in range(DIM)])
    frame.insert(0, "slot", used)
    yield frame


def _crossing(border: np.ndarray, step: int) -> np.ndarray:
    """Pairs ``step`` apart that a cut in the middle of ``border`` parts, each between gaps."""
    cut, out = len(border) // 2, []
    for k in range(cut - step, cut):
        if k >= 0 and k + step < len(border):
            out += [border[k], *([SLOTS] * (step - 1)), border[k + step], *([SLOTS] * WINDOW)]
    return np.array(out, dtype=np.int64)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit context vectors per slot, from all of ``docs``; of a fixed size (SLOTS + 1 rows, the last zero)."""
    columns = [f"c{k}" for k in range(DIM)]
    schema = "slot long, " + ", ".join(f"{c} long" for c in columns)
    sums = (
        docs.select(F.col(text_col).alias("text")).mapInPandas(_context_tables, schema)
        .groupBy("slot").agg(*[F.sum(c).alias(c) for c in columns])
    ).toPandas()
    context = np.zeros((SLOTS + 1, DIM))
    context[sums["slot"].to_numpy(dtype=int)] = sums[columns].to_numpy(dtype=float)
    mass = np.abs(context).sum(axis=1, keepdims=True)
    context = context - mass * (context.sum(axis=0) / max(1.0, mass.sum()))  # what any word has beside it says little
    return (context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def document_vector(text: str | None, vectors: np.ndarray, places: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Pooled features of one document."""
    slots = word_slots(text)
    out = np.zeros(2 * DIM + 4, dtype=np.float32)
    if not len(slots):
        return out
    mean, distinct = vectors[slots].mean(axis=0), vectors[np.unique(slots)].mean(axis=0)
    out[:DIM], out[DIM:2 * DIM] = mean, distinct
    out[2 * DIM], out[2 * DIM + 1] = np.linalg.norm(mean), np.linalg.norm(distinct)
    out[2 * DIM + 2] = np.log1p(len(slots)) / 10
    if len(slots) > 1:
        a, b = slots[:-1], slots[1:]
        same = (places[a] == places[b]) & (signs[a] == signs[b])
        out[2 * DIM + 3] = same.all(axis=1).mean()
    return out


# ---------------------------------------------------------------- network
@dataclass
class Network:
    """Standardisation, two layers and a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(0.0, (x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0.0, z) - y * z)) if len(z) else 0.0


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, between 1/20 and 20."""
    low, high = -3.0, 3.0
    for _ in range(60):  # log loss has one minimum in the inverse temperature
        a, b = low + (high - low) / 3, high - (high - low) / 3
        if log_loss(z / np.exp(a), y) < log_loss(z / np.exp(b), y):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Fit on four fifths of the rows, calibrate on the rest. Rows must come in a fixed order."""
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(x))
    held = order[: len(x) // 5]
    fit = order[len(x) // 5:]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
    n = x.shape[1]
    p = [rng.normal(0, np.sqrt(2 / n), (n, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN),
         np.zeros(1)]
    first, second = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    xs, step = ((x - mean) / scale)[fit], 0
    ys = y[fit]
    for _ in range(EPOCHS):
        turn = rng.permutation(len(xs))
        for start in range(0, len(turn), BATCH):
            rows = turn[start:start + BATCH]
            a, t = xs[rows], ys[rows]
            before = a @ p[0] + p[1]
            hidden = np.maximum(0.0, before)
            delta = (sigmoid(hidden @ p[2] + p[3][0]) - t) / len(rows)
            back = np.outer(delta, p[2]) * (before > 0)
            grads = [a.T @ back + DECAY * p[0], back.sum(axis=0), hidden.T @ delta + DECAY * p[2], np.array([delta.sum()])]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    net.temperature = fit_temperature(net.logits(x[held]), y[held]) if len(held) else 1.0
    return net


class _Scorer:
    """Text -> score, or -> document vector without a network; index vectors are remade in each worker."""

    def __init__(self, vectors: np.ndarray, net: Network | None):
        self.vectors, self.net, self.index = vectors, net, None

    def __getstate__(self):
        return {"vectors": self.vectors, "net": self.net, "index": None}

    def features(self, text):
        self.index = self.index or index_vectors()
        return document_vector(text, self.vectors, *self.index)

    def vector(self, text):
        return (self.features(text).tolist(),)

    def score(self, text):
        if self.net is None:
            return (0.5,)
        return (float(self.net.scores(self.features(text)[None, :].astype(float))[0]),)


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", train_rows: int = TRAIN_ROWS) -> Network | None:
    """A network from labelled documents: at most ``train_rows`` of them, chosen by a seeded hash of their id."""
    sample = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.avg(label_col).alias("_y"))
        .orderBy(F.xxhash64(F.lit(SEED), "_id"), "_id").limit(train_rows)
    )
    rows = docs.join(F.broadcast(sample), F.col(id_col) == F.col("_id")).select(
        "_id", "_y", each(_Scorer(vectors, None).vector, fields(x=T.ArrayType(T.FloatType())))(F.col(text_col))["x"].alias("x")
    ).toPandas()
    if not len(rows):
        return None
    x = np.array(rows["x"].tolist(), dtype=float)
    order = np.lexsort((*x.T[:4], rows["_id"].to_numpy()))
    return train(x[order], (rows["_y"].to_numpy(dtype=float) >= 0.5).astype(float)[order])


def score_column(vectors: np.ndarray, net: Network | None):
    """A column function text -> score."""
    return lambda text: each(_Scorer(vectors, net).score, fields(score=T.DoubleType()))(text)["score"]


@query("op1_quality_classifier")
def op1_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id"), 4) == 2
    vectors = word_vectors(docs)
    labels = table(spark, sf_dir, "labels").where(~held_out)
    net = fit(docs.where(~held_out), labels, vectors)
    scored = docs.select("doc_id", held_out.alias("held_out"), score_column(vectors, net)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
