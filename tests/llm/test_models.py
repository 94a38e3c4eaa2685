"""The classifiers: held-out accuracy, gradients, defined results without labels."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import quality_mil, toxicity
from lodestar.llm.labelled import training_sample

SYLLABLES = ["on", "er", "re", "an", "st", "ing", "ti", "ou", "ha"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def rows(kind: str, n: int = 900) -> list[tuple]:
    """``pair``: toxic only if an insult and a group are both named. ``part``: bad if one stretch is shouted."""
    rng, out = random.Random(5), []
    for i in range(n):
        w = words(rng, rng.randint(20, 300))
        if kind == "pair":
            a, b = rng.random() < 0.5, rng.random() < 0.5
            for there, word in ((a, "zounds"), (b, "martians")):
                if there:
                    w[rng.randrange(len(w))] = word
            y = int(a and b and "martians" in w and "zounds" in w)
        else:
            bad = rng.random() < 0.4
            if bad:
                at = rng.randrange(len(w))
                w[at:at] = [x.upper() + "!!" for x in words(rng, 60)]
            y = int(not bad)
        out.append((i, " ".join(w), y))
    return out


def table(spark, kind):
    data = rows(kind)
    label = "toxic" if kind == "pair" else "quality"
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in data] + [(5000, None, "x"), (5001, "", "x"), (None, "on er", "x"), (3, data[3][1], "x")], "doc_id long, text string, score string")
    return docs.repartition(3), spark.createDataFrame([(i, y) for i, _, y in data] + [(None, 1), (7777, 1)], f"doc_id long, {label} int"), {i: y for i, _, y in data}


@pytest.mark.parametrize("kind", ["pair", "part"])
def test_held_out_accuracy(spark, kind):
    docs, labels, y = table(spark, kind)
    module, modulus, rest = (toxicity, 3, 1) if kind == "pair" else (quality_mil, 4, 2)
    run = toxicity.score_toxicity if kind == "pair" else quality_mil.score_quality
    got = run(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % modulus == rest)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= module.THRESHOLD)
    held = [(r["predicted"], y[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in y]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert len({r["score"] for r in got if r["doc_id"] in (5000, 5001)}) == 1 and len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    again = run(docs.repartition(5), labels).collect()
    assert {(r["doc_id"], round(r["score"], 9)) for r in again} == {(r["doc_id"], round(r["score"], 9)) for r in got}


@pytest.mark.parametrize("run,label", [(toxicity.score_toxicity, "toxic"), (quality_mil.score_quality, "quality")])
def test_without_labels(spark, run, label):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    assert all(r["score"] < 0.01 and r["predicted"] == 0 for r in run(docs, none).collect())
    assert run(docs.where("false"), none).count() == 0


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = spark.range(500).selectExpr("id doc_id", "cast(id % 2 as int) toxic")
    got = training_sample(docs, labels, "toxic", 3, 1, 50).collect()
    assert len(got) == 50 and all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in got)


def test_machine_margin_is_the_pairwise_sum():
    rng = np.random.default_rng(1)
    m = toxicity.FactorizationMachine(np.arange(6, dtype=np.uint64), 0.3, rng.normal(size=6), rng.normal(size=(6, 4)))
    owner, term = np.array([0, 0, 0, 2, 2]), np.array([1, 3, 4, 0, 5])
    got = m.margins(owner, term, 3)[0]
    for d in range(3):
        x = term[owner == d]
        want = m.bias + m.linear[x].sum() + sum(m.factors[a] @ m.factors[b] for i, a in enumerate(x) for b in x[:i])
        assert abs(got[d] - want) < 1e-12


def test_attention_weights_sum_to_one_and_passages_cover_the_text():
    x, first = quality_mil.passages(["", "a b", " ".join(["w"] * 200), "#" * 9000])
    assert list(np.diff(first)) == [1, 1, -(-200 // quality_mil.PASSAGE), 1] and np.isfinite(x).all()
    m = quality_mil.fit_attention(x, first, np.array([0.0, 1, 1, 0]))
    f = m.forward((x - m.mean) / m.scale, first)
    assert np.allclose(np.add.reduceat(f["a"], first[:-1]), 1)
