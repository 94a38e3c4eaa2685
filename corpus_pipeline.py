"""From raw documents to token ids, in five stages.

Every stage but the last returns the columns of ``documents``:

1. quality rules: documents that the rules reject go;
2. n-gram Jaccard join: one document of each class stays, that of the smallest id;
3. benchmark decontamination: documents that hold an item of ``benchmark`` go;
4. personal data: every span is replaced by its kind, ``n_chars`` follows;
5. byte-level BPE: token ids and the text decoded from them.

``run`` writes each stage's rows to the folder of ``spark.checkpoint.dir`` and
reads them again, so a lost executor costs at most the stage at work. Nulls,
empty texts and tables, and repeated rows are as the operators define them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import bpe, decontam, jaccard_join, pii, quality_rules
from lodestar.session import checkpoint_dir
from lodestar.sources.tables import read

VOCABULARY = "byte_bpe_50k.json"


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = pii.mask_documents(docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", by_quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", without_benchmark),
    ("pii", masked),
    ("bpe", tokens),
]

#: Byte-pair merges can't be said in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = read(spark, sf_dir, "documents"), f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
