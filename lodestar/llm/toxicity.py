"""Toxicity by a factorization machine over hashed terms.

Terms are a text's lower-case words and the first four and five characters of
longer words, each known by a 64-bit hash. A term enters the machine when its
document frequency differs between the labels (two-proportion ``|z|`` of
``MIN_Z``; the ``MAX_TERMS`` strongest). The machine adds to linear weights the
pairwise interactions ``<v_i, v_j>`` of all terms present, so two terms may mean
together what neither means alone. It is fitted by full-batch Adam on at most
``MAX_TRAIN`` labelled documents; every document is scored whole.

Inputs of a score are the text's terms only. A null text is empty; an empty text
has no terms and gets the bias alone. Without labelled rows every score is 0.
Repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.labelled import held_out, training_sample
from lodestar.llm.text import hashed, slices, split_words, texts_of, word_codes

MODULUS, REMAINDER = 3, 1
MAX_TRAIN = 12_000
MAX_TERMS = 4096
MIN_DOCS, MIN_Z = 4, 3.5
FACTORS, STEPS, RATE, L2 = 8, 250, 0.05, 1e-4
THRESHOLD = 0.7
SEED = 7


def document_terms(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term) of every distinct term of every text.

    With ``wanted`` (sorted hashes) terms are positions in it, others are left out.
    """
    starts, words = split_words(texts)
    if not len(words):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64 if wanted is not None else np.uint64)
    codes, distinct = word_codes(words)
    terms = [hashed(distinct, 1)]
    for n in (4, 5):
        terms.append(np.where([len(w) > n for w in distinct], hashed([w[:n] for w in distinct], n), np.uint64(0)))
    terms[0][[w == "" for w in distinct]] = 0
    table = np.stack(terms, axis=1)
    if wanted is not None:
        at = np.minimum(np.searchsorted(wanted, table), max(len(wanted) - 1, 0))
        table = np.where(wanted[at] == table, at, -1) if len(wanted) else np.full(table.shape, -1)
        used = (table >= 0).any(axis=1)[codes]
    else:
        used = np.ones(len(codes), dtype=bool)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))[used]
    flat = table[codes[used]]
    owner, flat = np.repeat(owner, flat.shape[1]), flat.ravel()
    fine = flat >= 0 if wanted is not None else flat != 0
    owner, flat = owner[fine], flat[fine]
    order = np.lexsort((flat, owner))
    owner, flat = owner[order], flat[order]
    first = np.ones(len(owner), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (flat[1:] != flat[:-1])
    return owner[first], flat[first]


@dataclass
class FactorizationMachine:
    terms: np.ndarray  # sorted 64-bit hashes
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        owner, term = document_terms(texts, self.terms)
        return 1 / (1 + np.exp(-np.clip(self.margins(owner, term, len(texts))[0], -30, 30)))

    def margins(self, owner: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(margin of each text, sum of the factors of its terms)."""
        v = self.factors[term]
        total = np.stack([np.bincount(owner, weights=v[:, f], minlength=n) for f in range(v.shape[1])], axis=1)
        square = np.bincount(owner, weights=(v * v).sum(axis=1), minlength=n)
        line = np.bincount(owner, weights=self.linear[term], minlength=n)
        return self.bias + line + 0.5 * ((total * total).sum(axis=1) - square), total


def fit_machine(terms: np.ndarray, owner: np.ndarray, term: np.ndarray, y: np.ndarray) -> FactorizationMachine:
    """Logistic loss with L2, full-batch Adam from a fixed seed."""
    n, k = len(y), len(terms)
    rng = np.random.default_rng(SEED)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3) if n else 1e-9
    m = FactorizationMachine(terms, float(np.log(rate / (1 - rate))), np.zeros(k), rng.normal(0, 0.01, (k, FACTORS)))
    if not n or not k:
        return m
    moments = [np.zeros(1), np.zeros(1), np.zeros(k), np.zeros(k), np.zeros((k, FACTORS)), np.zeros((k, FACTORS))]
    for step in range(1, STEPS + 1):
        margin, total = m.margins(owner, term, n)
        g = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / n
        gt = g[owner]
        linear = np.bincount(term, weights=gt, minlength=k) + L2 * m.linear
        pull = gt[:, None] * (total[owner] - m.factors[term])
        factors = np.stack([np.bincount(term, weights=pull[:, f], minlength=k) for f in range(FACTORS)], axis=1) + L2 * m.factors
        for i, grad in enumerate((np.array([g.sum()]), linear, factors)):
            a, b = moments[2 * i], moments[2 * i + 1]
            a += 0.1 * (grad - a)
            b += 0.001 * (grad * grad - b)
            move = RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
            if i == 0:
                m.bias -= float(move[0])
            elif i == 1:
                m.linear -= move
            else:
                m.factors -= move
    return m


def _z(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    p = (pos + neg) / (n_pos + n_neg)
    return (pos / n_pos - neg / n_neg) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n_pos + 1 / n_neg))


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> FactorizationMachine:
    """Fit on at most ``limit`` documents. The driver gets one count per label, at most
    ``MAX_TERMS`` terms, and the positions of these in the sample's documents."""
    sample = training_sample(docs, labels, "toxic", MODULUS, REMAINDER, limit)
    by_label = {int(r["y"]): r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = by_label.get(1, 0), by_label.get(0, 0)
    if not n_pos or not n_neg:
        return FactorizationMachine(np.empty(0, dtype=np.uint64), 30.0 if n_pos else -30.0, np.zeros(0), np.zeros((0, FACTORS)))

    def count(parts):
        for part in parts:
            for b in slices(part):
                y = b.column("y").to_numpy()
                owner, term = document_terms(texts_of(b))
                names, at = np.unique(term, return_inverse=True)
                pos = np.bincount(at, weights=y[owner], minlength=len(names)).astype(np.int64)
                both = np.bincount(at, minlength=len(names))
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(pos), pa.array(both - pos)], names=["term", "pos", "neg"])

    counts = sample.mapInArrow(count, "term long, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") + F.col("neg") >= MIN_DOCS)
    p = (F.col("pos") + F.col("neg")) / F.lit(n_pos + n_neg)
    z = (F.col("pos") / n_pos - F.col("neg") / n_neg) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * F.lit(1 / n_pos + 1 / n_neg))
    strong = counts.withColumn("z", F.abs(z)).where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "term").limit(MAX_TERMS).select("term").collect()
    terms = np.sort(np.array([r["term"] for r in strong], dtype=np.int64).view(np.uint64))

    def place(parts):
        for part in parts:
            for b in slices(part):
                owner, term = document_terms(texts_of(b), terms)
                upto = np.zeros(b.num_rows + 1, dtype=np.int32)
                np.cumsum(np.bincount(owner, minlength=b.num_rows), out=upto[1:])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.ListArray.from_arrays(pa.array(upto), pa.array(term.astype(np.int32)))], names=["doc_id", "y", "terms"])

    placed = sample.mapInArrow(place, "doc_id long, y int, terms array<int>").toArrow().combine_chunks().sort_by("doc_id")
    lists = placed.column("terms").combine_chunks()
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return fit_machine(terms, owner, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), placed.column("y").to_numpy().astype(float))


def score(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score) of every row by ``model.scores``, a list of texts at a time."""

    def run(parts):
        for part in parts:
            for b in slices(part):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.scores(texts_of(b)), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
