"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words (the last one shorter; an
empty text is one passage of no words). Every passage is encoded by shares that
don't depend on the words' meaning: character classes, word shapes, repetition,
spread of word lengths. A dense layer makes of them an instance vector ``h``;
gated attention ``softmax(w . (tanh(V h) * sigmoid(U h)))`` weighs the passages
of a document, and a logistic unit scores the weighted vector. All is learnt
from document labels alone, by full-batch Adam on at most ``MAX_TRAIN``
documents; every document is scored over all its passages.

A null text is empty. Repeated rows get equal scores. Without labelled rows of
both kinds the score is the only label seen (0 without any). An empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.labelled import held_out, training_sample
from lodestar.llm.text import slices, split_words, texts_of
from lodestar.llm.toxicity import score

MODULUS, REMAINDER = 4, 2
MAX_TRAIN = 8_000
PASSAGE = 48
HIDDEN, ATTENTION, STEPS, RATE, L2 = 16, 8, 300, 0.02, 1e-4
THRESHOLD = 0.7
SEED = 11

_CLASSES = np.zeros((256, 6), dtype=np.float32)  # capital, lower, digit, sentence mark, symbol, not ASCII
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b] = (65 <= _b <= 90, 97 <= _b <= 122, 48 <= _b <= 57, _c in ".,;:!?'\"()-", _b < 128 and not _c.isalnum() and _c not in ".,;:!?'\"()-", _b >= 128)
N_FEATURES = 16


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, first passage of each text plus the end)."""
    starts, words = split_words(texts, lower=False)
    n_words = np.diff(starts)
    n_pass = np.maximum(1, -(-n_words // PASSAGE))
    first = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(n_pass, out=first[1:])
    out = np.zeros((first[-1], N_FEATURES), dtype=np.float64)
    if not len(words):
        return out, first
    coded = words.dictionary_encode()
    codes, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    offsets = np.frombuffer(distinct.buffers()[1], dtype=np.int64, count=len(distinct) + 1)
    data = np.frombuffer(distinct.buffers()[2], dtype=np.uint8, count=offsets[-1])
    counts = np.stack([np.add.reduceat(_CLASSES[data, c], offsets[:-1]) for c in range(6)], axis=1)
    size = np.diff(offsets).astype(np.float32)
    letters = counts[:, 0] + counts[:, 1] + counts[:, 5]
    shape = np.stack([
        (counts[:, 0] >= 2) & (counts[:, 1] == 0), (counts[:, 0] == 1) & (counts[:, 1] > 0), counts[:, 4] > 0, letters == 0, size <= 3, size >= 12,
    ], axis=1).astype(np.float32)
    table = np.concatenate([counts, shape, size[:, None]], axis=1)
    owner = np.repeat(np.arange(len(texts)), n_words)
    place = np.arange(len(codes)) - np.repeat(starts[:-1], n_words)
    passage = first[owner] + place // PASSAGE
    heads = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    rows = passage[heads]
    n = np.diff(np.r_[heads, len(codes)]).astype(float)
    sums = np.stack([np.add.reduceat(table[codes, c], heads) for c in range(table.shape[1])], axis=1)
    out[rows, :6] = sums[:, :6] / np.maximum(sums[:, 12:13], 1)
    out[rows, 6:12] = sums[:, 6:12] / n[:, None]
    out[rows, 12] = np.log1p(sums[:, 12] / n)
    again = np.r_[False, (codes[1:] == codes[:-1]) & (passage[1:] == passage[:-1])]
    out[rows, 13] = np.add.reduceat(again.astype(np.float32), heads) / n
    pairs = np.sort(passage * np.int64(len(distinct)) + codes)
    fresh = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] // len(distinct)
    out[rows, 14] = np.bincount(fresh, minlength=first[-1])[rows] / n
    out[rows, 15] = np.log1p(n) / np.log1p(PASSAGE)
    return out, first


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, first[:-1], axis=0)


@dataclass
class AttentionModel:
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)
    constant: float | None = None

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, bag = self.p, np.repeat(np.arange(len(first) - 1), np.diff(first))
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        a = e / _sums(e, first)[bag]
        z = _sums(a[:, None] * h, first)
        margin = np.clip(z @ p["c"] + p["d"][0], -30, 30)
        return {"bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "y": 1 / (1 + np.exp(-margin))}

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        if not texts:
            return np.empty(0)
        x, first = passages(texts)
        return self.forward((x - self.mean) / self.scale, first)["y"]


def fit_attention(x: np.ndarray, first: np.ndarray, y: np.ndarray) -> AttentionModel:
    """Logistic loss with L2, full-batch Adam from a fixed seed."""
    rng = np.random.default_rng(SEED)
    m = AttentionModel(x.mean(axis=0), x.std(axis=0) + 1e-3)
    x = (x - m.mean) / m.scale
    k = x.shape[1]
    m.p = {"W": rng.normal(0, k**-0.5, (k, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.25, (HIDDEN, ATTENTION)), "U": rng.normal(0, 0.25, (HIDDEN, ATTENTION)),
           "w": rng.normal(0, 0.25, ATTENTION), "c": rng.normal(0, 0.25, HIDDEN), "d": np.zeros(1)}
    one, two = {k: np.zeros_like(v) for k, v in m.p.items()}, {k: np.zeros_like(v) for k, v in m.p.items()}
    for step in range(1, STEPS + 1):
        f, p = m.forward(x, first), m.p
        g = (f["y"] - y) / len(y)
        dz = g[:, None] * p["c"]
        da = (dz[f["bag"]] * f["h"]).sum(axis=1)
        de = f["a"] * (da - _sums(f["a"] * da, first)[f["bag"]])
        dt, ds = de[:, None] * p["w"] * f["s"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["s"] * (1 - f["s"])
        dh = f["a"][:, None] * dz[f["bag"]] + dt @ p["V"].T + ds @ p["U"].T
        du = dh * (1 - f["h"] ** 2)
        grads = {"W": x.T @ du, "b": du.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ g, "d": np.array([g.sum()])}
        for name, grad in grads.items():
            grad = grad + L2 * p[name]
            one[name] += 0.1 * (grad - one[name])
            two[name] += 0.001 * (grad * grad - two[name])
            p[name] = p[name] - RATE * (one[name] / (1 - 0.9**step)) / (np.sqrt(two[name] / (1 - 0.999**step)) + 1e-8)
    return m


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> AttentionModel:
    """Fit on at most ``limit`` documents; the driver gets the encoded passages of these only."""
    sample = training_sample(docs, labels, "quality", MODULUS, REMAINDER, limit)

    def encoded(parts):
        for part in parts:
            for b in slices(part):
                x, first = passages(texts_of(b))
                lists = pa.ListArray.from_arrays(pa.array((first * N_FEATURES).astype(np.int32)), pa.array(x.astype(np.float32).ravel()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), lists], names=["doc_id", "y", "x"])

    bags = sample.mapInArrow(encoded, "doc_id long, y int, x array<float>").toArrow().combine_chunks().sort_by("doc_id")
    y = bags.column("y").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return AttentionModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), constant=float(y[0]) if len(y) else 0.0)
    lists = bags.column("x").combine_chunks()
    first = np.asarray(lists.offsets.to_numpy(), dtype=np.int64) // N_FEATURES
    return fit_attention(lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES).astype(float), first - first[0], y)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
