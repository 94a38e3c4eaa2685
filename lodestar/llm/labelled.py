"""Training samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import checkpoint_dir


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % F.lit(modulus)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether labels of this id may not be learnt from; a null id is not held out (and has no label)."""
    return F.coalesce(fold(doc_id, modulus) == F.lit(remainder), F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, limit: int) -> DataFrame:
    """(doc_id, text, y) of at most ``limit`` labelled documents outside the held-out fold, checkpointed.

    The ids are the first by a hash, so the sample does not depend on order or
    partitions. Rows with a null id or label don't count; of several labels of an
    id the largest holds, of several texts of an id the largest.
    """
    checkpoint_dir(docs.sparkSession)
    y = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(~held_out(F.col("doc_id"), modulus, remainder)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    chosen = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return d.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("y").alias("y")).checkpoint()
