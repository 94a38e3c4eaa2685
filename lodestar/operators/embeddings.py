"""Embedding refresh: change detection by model-scoped text hash, encoding, upsert.

The default encoder is JVM-side (hashed token counts + L2 normalisation from
Spark ML); a real model plugs in as an ``encoder`` callable, typically a
``mapInPandas`` over Arrow batches (the UDF-01 slot).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.columns import passage_text, text_hash
from lodestar.functions.vocab import EMBEDDING_DIM_DECLARED, PASSAGE_PREFIX, QUERY_PREFIX

Encoder = Callable[[DataFrame, str, str], DataFrame]


def property_text(properties: DataFrame) -> DataFrame:
    """SRC-02: (property_id, title, description) with a title; null description -> ''."""
    return properties.filter(F.col("title").isNotNull()).select(
        "property_id", "title", F.coalesce(F.col("description"), F.lit("")).alias("description"))


def existing_hashes(stored: DataFrame) -> DataFrame:
    """SRC-03: (property_id, text_hash) of stored embeddings (consumed by a join)."""
    return stored.select("property_id", "text_hash")


def with_hash(texts: DataFrame, model_name: str) -> DataFrame:
    t = passage_text(F.col("title"), F.col("description"))
    return texts.withColumn("text", t).withColumn("text_hash", text_hash(model_name, t))


def changed_texts(texts: DataFrame, stored: DataFrame, model_name: str) -> DataFrame:
    """EMB-01: listings whose model-scoped hash differs from the stored one or is absent."""
    h = with_hash(texts, model_name)
    s = existing_hashes(stored).withColumnRenamed("text_hash", "stored_hash")
    return h.join(s, "property_id", "left").filter(~F.col("text_hash").eqNullSafe(F.col("stored_hash"))) \
        .drop("stored_hash")


def changed_texts_anti(texts: DataFrame, stored: DataFrame, model_name: str,
                       full_refresh: bool = False) -> DataFrame:
    """JOIN-09: listings with no stored row of the same id and hash; ``full_refresh`` keeps all."""
    h = with_hash(texts, model_name)
    if full_refresh:
        return h
    return h.join(existing_hashes(stored), ["property_id", "text_hash"], "left_anti")


def hashing_encoder(dim: int = EMBEDDING_DIM_DECLARED) -> Encoder:
    """Default encoder: hashed token counts of the prefixed text, L2-normalised.

    A token's place is the first 32 bits of its md5 modulo ``dim``, which any engine
    can repeat. Tokens are hashed JVM-side; ``mapInPandas`` counts them in numpy, a
    batch at a time. A text without tokens is the zero vector. A text column whose
    name starts with an underscore is a helper: it doesn't go through Python and isn't returned.
    """
    import numpy as np
    from lodestar.functions.columns import stable_bucket
    from lodestar.operators.retrieval import tokenize

    def encode(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        placed = df.withColumn("_places", F.transform(tokenize(F.coalesce(F.col(text_col), F.lit(""))), lambda t: stable_bucket(t, dim).cast("int")))
        if text_col.startswith("_"):
            placed = placed.drop(text_col)

        def count(frames):
            for pdf in frames:
                vectors = []
                for places in pdf["_places"]:
                    v = np.bincount(places, minlength=dim).astype(float)
                    vectors.append(v / max(float(np.linalg.norm(v)), 1e-300))
                yield pdf.drop(columns="_places").assign(**{out_col: vectors})

        schema = T.StructType([f for f in placed.schema.fields if f.name not in ("_places", out_col)] + [T.StructField(out_col, T.ArrayType(T.DoubleType()))])
        return placed.mapInPandas(count, schema)
    return encode


def _prefixed(df: DataFrame, prefix: str, text_col: str) -> DataFrame:
    """The frame with its prompt text; a helper column that holds the text (underscore) is replaced by it."""
    out = df.withColumn("_prefixed", F.concat(F.lit(prefix), F.col(text_col)))
    return out.drop(text_col) if text_col.startswith("_") else out


def encode_passages(df: DataFrame, encoder: Encoder | None = None, text_col: str = "text",
                    out_col: str = "embedding") -> DataFrame:
    """EMB-02: prefix once with 'passage: ' and encode."""
    enc = encoder or hashing_encoder()
    return enc(_prefixed(df, PASSAGE_PREFIX, text_col), "_prefixed", out_col).drop("_prefixed")


def encode_queries(df: DataFrame, encoder: Encoder | None = None, text_col: str = "query_text",
                   out_col: str = "query_vector") -> DataFrame:
    """EMB-02: prefix once with 'query: ' and encode."""
    enc = encoder or hashing_encoder()
    return enc(_prefixed(df, QUERY_PREFIX, text_col), "_prefixed", out_col).drop("_prefixed")


def batch_predict_embeddings(rows: DataFrame, encoder: Encoder | None = None) -> DataFrame:
    """EMB-04: rows {text, kind} -> embedding; kind 'query' gets the query prefix, else passage."""
    enc = encoder or hashing_encoder()
    pre = rows.withColumn("_prefixed", F.when(F.col("kind") == "query", F.concat(F.lit(QUERY_PREFIX), F.col("text")))
                          .otherwise(F.concat(F.lit(PASSAGE_PREFIX), F.col("text"))))
    return enc(pre, "_prefixed", "embedding").drop("_prefixed")


def refresh_plan(texts: DataFrame, stored: DataFrame, model_name: str, generated_at: str,
                 encoder: Encoder | None = None) -> tuple[DataFrame, DataFrame]:
    """EMB-03: (rows to upsert, counts) for one refresh run.

    counts: total listings with a title, unchanged, encoded (one aggregate).
    Re-running after the upsert encodes nothing (idempotent).
    """
    h = with_hash(texts, model_name)
    s = existing_hashes(stored).withColumnRenamed("text_hash", "stored_hash")
    from pyspark import StorageLevel
    # one hashing pass feeds both the counts and the rows to encode
    tagged = h.join(s, "property_id", "left").withColumn(
        "unchanged", F.col("text_hash").eqNullSafe(F.col("stored_hash"))) \
        .select("property_id", "text", "text_hash", "unchanged").persist(StorageLevel.MEMORY_AND_DISK)
    counts = tagged.agg(F.count(F.lit(1)).alias("total"),
                        F.count_if(F.col("unchanged")).alias("unchanged"),
                        F.count_if(~F.col("unchanged")).alias("encoded"))
    todo = tagged.filter(~F.col("unchanged")).select("property_id", "text", "text_hash")
    enc = encode_passages(todo, encoder)
    rows = enc.select("property_id", "embedding", "text_hash", F.lit(model_name).alias("model_name"),
                      F.lit(generated_at).cast("timestamp_ntz").alias("generated_at"))
    return rows, counts
