"""The corpus pipeline: each stage's effect on planted rows, columns, and the whole run."""

from __future__ import annotations

import random

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodestar.llm.queries import ORACLE, QUERIES

COMMON = "the of and to in is that for it with as was on are by this".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(COMMON) if rng.random() < 0.5 else "".join(rng.choice(["sto", "ri", "ver", "ne", "ka", "lu"]) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    clean = [(i, prose(i, 90), "en", "s", 0) for i in range(30)]
    item = prose(500, 30)
    words = clean[4][1].split()
    planted = [(100, clean[3][1], "en", "s", 0), (101, " ".join([*words[:40], "changed", *words[41:]]), "en", "s", 0), (102, prose(600, 60) + " " + item + " " + prose(601, 40), "en", "s", 0),
               (103, prose(700, 80) + " Write to ann@mail.example.com now.", "en", "s", 0), (104, "short", "en", "s", 0), (105, " ".join(w + "###" for w in prose(800, 80).split()), "en", "s", 0), (106, None, None, None, None)]
    spark.createDataFrame(clean + planted, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    gone = [{104, 105, 106}, {100, 101}, {102}, set()]
    for (_, stage), lost in zip(corpus_pipeline.STAGES[:-1], gone, strict=True):
        before = {r["doc_id"] for r in docs.collect()}
        docs = stage(spark, docs, tables)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = docs.collect()
        assert before - {r["doc_id"] for r in rows} == lost and len(rows) == len(before) - len(lost)
        docs = spark.createDataFrame(rows, docs.schema)
    masked = {r["doc_id"]: r for r in docs.collect()}
    assert masked[103]["text"].endswith("Write to <EMAIL> now.") and all(r["n_chars"] == len(r["text"]) for r in masked.values())
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = corpus_pipeline.STAGES[-1][1](spark, docs, tables).collect()
    assert {(r["doc_id"], tuple(r["ids"]), r["text"]) for r in out} == {(i, tuple(lib.encode(r["text"], add_special_tokens=False).ids), r["text"]) for i, r in masked.items()}
    assert {(r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, tables).collect()} == {(r["doc_id"], tuple(r["ids"])) for r in out}


def test_stages_of_nothing(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables).count() == 0


def test_thirteen_queries_and_columns(spark):
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
