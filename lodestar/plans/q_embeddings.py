"""Queries: embedding change detection, encoding and the refresh upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import embeddings as emb
from lodestar.operators import sinks
from lodestar.plans.oracle_views import tokens
from lodestar.plans.q_features import _sink_dir
from lodestar.plans.registry import query
from lodestar.sources import fixtures as fx

DIM = 64  # the stored vectors are 64-d


def texts(spark, d):
    return emb.property_text(fx.properties(spark, d))


def stored(spark, d):
    return fx.property_embeddings(spark, d)


@query("scan_existing_hashes", "SELECT property_id, text_hash FROM property_embeddings", ("property_embeddings",))
def q_existing(spark, d):
    """SRC-03: (property_id, text_hash) of the stored embeddings."""
    return emb.existing_hashes(stored(spark, d))


@query("changed_texts", "SELECT property_id, text_hash FROM changed", ("changed",))
def q_changed(spark, d):
    """EMB-01 + FN-07/08: model-scoped hash differs from the stored one or is absent."""
    return emb.changed_texts(texts(spark, d), stored(spark, d), fx.MODEL_NAME).select("property_id", "text_hash")


@query("changed_texts_anti", """
SELECT t.property_id, t.text_hash FROM text_hashes t
WHERE NOT EXISTS (SELECT 1 FROM property_embeddings e WHERE e.property_id = t.property_id AND e.text_hash = t.text_hash)""",
       ("text_hashes", "property_embeddings"))
def q_changed_anti(spark, d):
    """JOIN-09: left anti join on (id, hash)."""
    return emb.changed_texts_anti(texts(spark, d), stored(spark, d), fx.MODEL_NAME).select("property_id", "text_hash")


@query("refresh_embeddings", """
SELECT count(*) AS total, count(*) - (SELECT count(*) FROM changed) AS unchanged, (SELECT count(*) FROM changed) AS encoded
FROM text_hashes""", ("text_hashes", "changed"))
def q_refresh(spark, d):
    """EMB-03: encode changed texts, upsert them into a new table version; (total, unchanged, encoded)."""
    rows, counts = emb.refresh_plan(texts(spark, d), stored(spark, d), fx.MODEL_NAME, fx.EMBEDDED_AT,
                                    emb.hashing_encoder(DIM))
    sinks.upsert_embeddings(stored(spark, d), rows, sinks.new_version_path(_sink_dir(spark, "embeddings")))
    return counts


@query("upsert_embeddings", """
SELECT property_id, text_hash FROM property_embeddings WHERE property_id NOT IN (SELECT property_id FROM changed)
UNION ALL SELECT property_id, text_hash FROM changed""", ("property_embeddings", "changed"))
def q_upsert(spark, d):
    """SNK-03: stored rows minus the batch ids, plus the batch; read back from the new version."""
    rows, _ = emb.refresh_plan(texts(spark, d), stored(spark, d), fx.MODEL_NAME, fx.EMBEDDED_AT,
                               emb.hashing_encoder(DIM))
    path = sinks.new_version_path(_sink_dir(spark, "embeddings"))
    sinks.upsert_embeddings(stored(spark, d), rows, path)
    return spark.read.parquet(path).select("property_id", "text_hash")


def _vector_sql(rows: str) -> str:
    """Non-zero elements of the default encoder's vectors of ``rows`` (id, text, text already prefixed)."""
    return f"""
WITH places AS (SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT % {DIM} AS i
                FROM (SELECT id, unnest({tokens('text')}) AS t FROM ({rows}))),
counts AS (SELECT id, i, count(*) AS n FROM places GROUP BY id, i)
SELECT id, CAST(i AS INTEGER) AS i, round(n / sqrt(sum(n * n) OVER (PARTITION BY id)), 6) AS x FROM counts"""


def _elements(df, id_col, vector):
    return df.select(F.col(id_col).alias("id"), F.posexplode(vector).alias("i", "x")).filter("x != 0").select("id", "i", F.round("x", 6).alias("x"))


@query("encode_passages", _vector_sql("SELECT property_id AS id, 'passage: ' || text AS text FROM text_hashes SEMI JOIN changed USING (property_id)"),
       ("text_hashes", "changed"))
def q_encode(spark, d):
    """EMB-02: changed passages encoded by the default encoder: every non-zero element."""
    ch = emb.changed_texts(texts(spark, d), stored(spark, d), fx.MODEL_NAME)
    return _elements(emb.encode_passages(ch, emb.hashing_encoder(DIM)), "property_id", "embedding")


@query("batch_predict_embeddings", _vector_sql("SELECT query_id AS id, 'query: ' || query_text AS text FROM text_queries UNION ALL SELECT 'D' || query_id, 'passage: ' || query_text FROM text_queries"),
       ("text_queries",))
def q_batch_predict(spark, d):
    """EMB-04: {text, kind} rows of both kinds, each with its prefix."""
    q = fx.text_queries(spark, d)
    rows = q.select("query_id", F.col("query_text").alias("text"), F.lit("query").alias("kind")).unionByName(
        q.select(F.concat(F.lit("D"), "query_id").alias("query_id"), F.col("query_text").alias("text"), F.lit("passage").alias("kind")))
    return _elements(emb.batch_predict_embeddings(rows, emb.hashing_encoder(DIM)), "query_id", "embedding")


@query("encode_queries", _vector_sql("SELECT query_id AS id, 'query: ' || query_text AS text FROM text_queries"), ("text_queries",))
def q_encode_queries(spark, d):
    """EMB-02 (query side): 'query: ' prefix once, then the encoder."""
    return _elements(emb.encode_queries(fx.text_queries(spark, d), emb.hashing_encoder(DIM)), "query_id", "query_vector")


@query("text_search", f"""
WITH e AS ({_vector_sql("SELECT property_id AS id, 'passage: ' || text AS text FROM text_hashes")}),
q AS ({_vector_sql("SELECT query_id AS id, 'query: ' || query_text AS text FROM text_queries")}),
dots AS (SELECT q.id AS query_id, e.id AS property_id, sum(q.x * e.x) AS s FROM q JOIN e USING (i) GROUP BY 1, 2)
SELECT query_id, count(*) AS n_found, round(sum(s), 3) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC) AS r FROM dots) WHERE r <= 10 GROUP BY query_id""",
       ("text_hashes", "text_queries"))
def q_text_search(spark, d):
    """Text to vector to search in one path: passages and queries encoded, exact top-10; each list's size and summed similarity."""
    from lodestar.operators import retrieval as rt
    enc = emb.hashing_encoder(DIM)
    # only the ids go through the encoder's Python beside the tokens: no copy of a text does
    passages = emb.with_hash(texts(spark, d), fx.MODEL_NAME).select("property_id", F.col("text").alias("_text"))
    corpus = emb.encode_passages(passages, enc, "_text").select("property_id", "embedding")
    queries = emb.encode_queries(fx.text_queries(spark, d).select("query_id", F.col("query_text").alias("_text")), enc, "_text").select("query_id", "query_vector")
    return rt.vector_topk(queries, corpus, 10).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_found"), F.round(F.sum(F.lit(1.0) - F.col("cosine_distance")), 3).alias("similarity"))
