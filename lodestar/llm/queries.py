"""One thin query per operator; digests and contract columns are derived here."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import bpe, decontam, jaccard_join, pii, quality_mil, quality_rules, resampling, secrets, sharding, span_dedup, toxicity, warc, whitening
from lodestar.session import checkpoint_dir
from lodestar.sources.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract_spans(read(spark, sf_dir, "documents"))

    def number(i: int):  # a second parameter of the lambda, even one with a default, would be the index of the span
        return F.size(F.filter("base", lambda x: x["k"] == i)).cast("long")

    count = [number(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *count, F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"), pii.spelled(F.col("spans")).alias("spans"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start_word", "n_words", "hamming", "similarity")


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_entropy")


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(read(spark, sf_dir, "documents"))


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "js_chars", "js_words")


@query("op9_span_dedup")
def op9_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.remove_repeats(read(spark, sf_dir, "documents"))


@query("op10_shards")
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.assign_shards(read(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "part")


#: CRC-32 byte by byte: a 256-row table from the polynomial, then one step of all distinct features a round.
RESAMPLING_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT k, list_reduce(list_prepend(k, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS k)),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
  SELECT side, id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
features AS (
  SELECT side, r, unnest(list_concat(w, list_concat(
           list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
           list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f
  FROM words),
counted AS (SELECT side, r, f, count(*) AS n FROM features GROUP BY ALL),
steps AS (
  SELECT f, hex(encode(f)) AS x, 1 AS i, 4294967295::BIGINT AS c FROM (SELECT DISTINCT f FROM counted)
  UNION ALL
  SELECT f, x, i + 2, xor(c >> 8, v) FROM steps JOIN crc_table ON k = xor(c & 255, ('0x' || substr(x, i, 2))::BIGINT) WHERE i < length(x)),
buckets AS (SELECT f, xor(c, 4294967295) % 10000 AS b FROM steps WHERE i > length(x)),
held AS (SELECT side, r, b, sum(n) AS n FROM counted JOIN buckets USING (f) GROUP BY ALL),
totals AS (SELECT b, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 'b') AS t FROM held GROUP BY b),
sizes AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM totals),
gains AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
  FROM totals, sizes),
weights AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM held JOIN gains USING (b) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (r) WHERE side = 'd'),
ranked AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features) END AS place,
         count(*) FILTER (n_words >= 20) OVER () AS n
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM ranked
"""

WARC_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
d AS (
  SELECT page_id, payload_bytes, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS last FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM d
"""


@query("op11_resampling", RESAMPLING_SQL)
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_warc", WARC_SQL)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    index = warc.write_archives(read(spark, sf_dir, "pages"), folder)
    return warc.read_pages(index, folder)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
