"""Queries: learning-to-rank frames and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.vocab import FEATURE_COLS
from lodestar.operators import ltr
from lodestar.plans.registry import query
from lodestar.sources import fixtures as fx

LABEL_SQL = """SELECT request_id, property_id,
       CAST(max(CASE action WHEN 'inquiry' THEN 3 WHEN 'favorite' THEN 2 WHEN 'click' THEN 1 ELSE 0 END) AS BIGINT) AS label
FROM feedback_events {where} GROUP BY request_id, property_id"""

WIN90 = ("ts >= TIMESTAMP '2001-07-15 12:00:00' - INTERVAL 90 DAY AND ts <= TIMESTAMP '2001-07-15 12:00:00'")


def _per_request_sql(score: str, tie: str, cols: str) -> str:
    return f"""
WITH lab AS ({LABEL_SQL.format(where='')}),
fr AS (SELECT r.request_id, r.lexical_rank, r.score, r.me5_score, coalesce(l.label, 0) AS label
       FROM ranking_log r LEFT JOIN lab l ON l.request_id = r.request_id AND l.property_id = r.property_id),
pos AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY {score} DESC, {tie}) AS p,
               row_number() OVER (PARTITION BY request_id ORDER BY label DESC) AS ip,
               sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY request_id ORDER BY {score} DESC, {tie}
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr
        FROM fr),
pr AS (SELECT request_id, count(*) AS n,
              sum(CASE WHEN p <= 10 THEN (pow(2, label) - 1) / log2(p + 1) ELSE 0 END) AS dcg,
              sum(CASE WHEN ip <= 10 THEN (pow(2, label) - 1) / log2(ip + 1) ELSE 0 END) AS idcg,
              sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) AS nrel,
              sum(CASE WHEN label > 0 THEN cr / p ELSE 0 END) AS ap,
              sum(CASE WHEN label > 0 AND p <= 20 THEN 1 ELSE 0 END) AS hits
       FROM pos GROUP BY request_id),
m AS (SELECT request_id, CAST(n AS BIGINT) AS n_candidates, CAST(nrel AS BIGINT) AS n_relevant,
             CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END AS ndcg_at_10,
             CASE WHEN nrel > 0 THEN ap / nrel ELSE 0 END AS average_precision,
             CASE WHEN nrel > 0 THEN hits / nrel ELSE 0 END AS recall_at_20
      FROM pr)
SELECT {cols} FROM m"""


EVAL_COLS = """coalesce(round(avg(ndcg_at_10), 4), 0) AS ndcg_at_10, coalesce(round(avg(average_precision), 4), 0) AS map,
       coalesce(round(avg(recall_at_20), 4), 0) AS recall_at_20, count(*) AS n_queries"""


def labelled(spark, d):
    return ltr.labelled_log(fx.ranking_log(spark, d), fx.feedback_events(spark, d))


@query("evaluate_ranking", _per_request_sql("score", "lexical_rank", EVAL_COLS),
       ("ranking_log", "feedback_events"))
def q_evaluate_ranking(spark, d):
    """LTR-06 (flagship): NDCG@10, MAP, Recall@20 over every logged request."""
    return ltr.evaluate_ranking(labelled(spark, d))


@query("ndcg_at_k", _per_request_sql("score", "lexical_rank", "request_id, round(ndcg_at_10, 6) AS ndcg_at_10"),
       ("ranking_log", "feedback_events"))
def q_ndcg(spark, d):
    m = ltr.per_request_metrics(labelled(spark, d))
    return m.select("request_id", F.round("ndcg_at_10", 6).alias("ndcg_at_10"))


@query("average_precision",
       _per_request_sql("score", "lexical_rank", "request_id, round(average_precision, 6) AS average_precision"),
       ("ranking_log", "feedback_events"))
def q_ap(spark, d):
    m = ltr.per_request_metrics(labelled(spark, d))
    return m.select("request_id", F.round("average_precision", 6).alias("average_precision"))


@query("recall_at_k",
       _per_request_sql("score", "lexical_rank",
                        "request_id, round(recall_at_20, 6) AS recall_at_20, n_relevant, n_candidates"),
       ("ranking_log", "feedback_events"))
def q_recall(spark, d):
    m = ltr.per_request_metrics(labelled(spark, d))
    return m.select("request_id", F.round("recall_at_20", 6).alias("recall_at_20"), "n_relevant", "n_candidates")


@query("fallback_vs_rerank",
       "SELECT 'fallback' AS regime, * FROM (" +
       _per_request_sql("-lexical_rank", "lexical_rank", EVAL_COLS).strip() +
       ") UNION ALL SELECT 'rerank' AS regime, * FROM (" +
       _per_request_sql("score", "lexical_rank", EVAL_COLS).strip() + ")",
       ("ranking_log", "feedback_events"))
def q_fallback_vs_rerank(spark, d):
    return ltr.fallback_vs_rerank(labelled(spark, d))


@query("strongest_label", LABEL_SQL.format(where=""), ("feedback_events",))
def q_strongest_label(spark, d):
    return ltr.strongest_label(fx.feedback_events(spark, d))


@query("label_left_join", f"""
WITH lab AS ({LABEL_SQL.format(where='')})
SELECT r.request_id, r.property_id, r.lexical_rank, coalesce(l.label, 0) AS label
FROM ranking_log r LEFT JOIN lab l ON l.request_id = r.request_id AND l.property_id = r.property_id""",
       ("ranking_log", "feedback_events"))
def q_label_left_join(spark, d):
    r = fx.ranking_log(spark, d).select("request_id", "property_id", "lexical_rank")
    return ltr.label_left_join(r, ltr.strongest_label(fx.feedback_events(spark, d)))


FRAME_SQL = f"""
WITH lab AS ({LABEL_SQL.format(where='WHERE ' + WIN90)}),
frame AS (
  SELECT r.request_id, r.property_id, r.lexical_rank AS pool_rank,
         f_rent AS rent, f_walk_min AS walk_min, f_age_years AS age_years, f_area_m2 AS area_m2,
         f_ctr AS ctr, f_fav_rate AS fav_rate, f_inquiry_rate AS inquiry_rate, f_me5_score AS me5_score,
         f_lexical_rank AS lexical_rank, f_semantic_rank AS semantic_rank, coalesce(l.label, 0) AS label
  FROM ranking_log r LEFT JOIN lab l ON l.request_id = r.request_id AND l.property_id = r.property_id
  WHERE {WIN90.replace('ts', 'r.ts')} AND r.f_rent IS NOT NULL)
"""


def frame(spark, d):
    return ltr.training_frame(fx.ranking_log(spark, d), fx.feedback_events(spark, d), fx.AS_OF)


def _round_feats(cols):
    return [F.round(F.col(c), 6).alias(c) for c in cols]


@query("training_frame", FRAME_SQL + "SELECT request_id, property_id, label, " +
       ", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_COLS) + " FROM frame",
       ("ranking_log", "feedback_events"))
def q_training_frame(spark, d):
    f = frame(spark, d)
    return f.select("request_id", "property_id", "label", *_round_feats(FEATURE_COLS))


@query("ranker_features", FRAME_SQL + "SELECT request_id, property_id, " + ", ".join(
    (f"round(coalesce({c}, 0), 6) AS {c}" if i < 7 else f"round({c}, 6) AS {c}")
    for i, c in enumerate(FEATURE_COLS)) + " FROM frame", ("ranking_log", "feedback_events"))
def q_ranker_features(spark, d):
    f = ltr.ranker_features(frame(spark, d))
    return f.select("request_id", "property_id", *_round_feats(FEATURE_COLS))


@query("feature_matrix", FRAME_SQL + "SELECT request_id, property_id, [" + ", ".join(
    (f"round(coalesce({c}, 0), 6)" if i < 7 else f"round({c}, 6)")
    for i, c in enumerate(FEATURE_COLS)) + "] AS feature_vector FROM frame", ("ranking_log", "feedback_events"))
def q_feature_matrix(spark, d):
    f = ltr.feature_matrix(frame(spark, d))
    return f.select("request_id", "property_id",
                    F.transform("feature_vector", lambda x: F.round(x, 6)).alias("feature_vector"))


# Q-8: the production split hashes request ids with xxhash64, which DuckDB cannot
# reproduce; the checked query buckets by the numeric part of the id instead.
SPLIT_BUCKET = "('0x' || substr(md5(request_id), 1, 8))::BIGINT % 10"


@query("group_split", FRAME_SQL + """
SELECT request_id, property_id, CASE WHEN """ + SPLIT_BUCKET + """ < 8 THEN 'train' ELSE 'test' END AS split
FROM frame""", ("ranking_log", "feedback_events"))
def q_group_split(spark, d):
    return ltr.group_split(frame(spark, d)).select("request_id", "property_id", "split")


@query("train_test_disjoint", FRAME_SQL + """
SELECT request_id FROM frame WHERE """ + SPLIT_BUCKET + """ < 8
INTERSECT SELECT request_id FROM frame WHERE """ + SPLIT_BUCKET + """ >= 8""",
       ("ranking_log", "feedback_events"))
def q_train_test_disjoint(spark, d):
    return ltr.train_test_overlap(ltr.group_split(frame(spark, d)))


@query("group_sizes", FRAME_SQL + "SELECT request_id, count(*) AS group_size FROM frame GROUP BY request_id",
       ("ranking_log", "feedback_events"))
def q_group_sizes(spark, d):
    return ltr.group_sizes(frame(spark, d))


@query("group_boundaries", FRAME_SQL + """
SELECT request_id, property_id,
       CAST(row_number() OVER (PARTITION BY request_id ORDER BY pool_rank) AS BIGINT) AS pos_in_group,
       count(*) OVER (PARTITION BY request_id) AS group_size,
       row_number() OVER (PARTITION BY request_id ORDER BY pool_rank) = 1 AS is_group_start
FROM frame""", ("ranking_log", "feedback_events"))
def q_group_boundaries(spark, d):
    b = ltr.group_boundaries(frame(spark, d))
    return b.select("request_id", "property_id", "pos_in_group", "group_size", "is_group_start")


@query("request_count", FRAME_SQL + "SELECT count(*) AS n_rows, count(DISTINCT request_id) AS n_requests FROM frame",
       ("ranking_log", "feedback_events"))
def q_request_count(spark, d):
    return ltr.request_count(frame(spark, d))


@query("training_order", FRAME_SQL + "SELECT request_id, property_id, label FROM frame",
       ("ranking_log", "feedback_events"))
def q_training_order(spark, d):
    return ltr.training_order(frame(spark, d)).select("request_id", "property_id", "label")


@query("eval_mean", _per_request_sql("me5_score", "lexical_rank", EVAL_COLS), ("ranking_log", "feedback_events"))
def q_eval_mean(spark, d):
    """AGG-15: mean NDCG@10 / MAP / Recall@20 of the pools ordered by the semantic score."""
    r = fx.ranking_log(spark, d).select("request_id", "property_id", "lexical_rank", "me5_score")
    f = ltr.label_left_join(r, ltr.strongest_label(fx.feedback_events(spark, d)))
    return ltr.evaluate(ltr.per_request_metrics(f, F.col("me5_score"), F.col("lexical_rank")))


@query("fresh_features_join", FRAME_SQL + """
SELECT request_id, property_id FROM frame
WHERE property_id IN (SELECT property_id FROM feature_mart WHERE event_date = (SELECT max(event_date) FROM feature_mart))""",
       ("ranking_log", "feedback_events", "feature_mart"))
def q_fresh_features(spark, d):
    """JOIN-10: training rows whose listing is in the latest feature snapshot (semi join, no fan-out)."""
    from lodestar.operators.features import latest_partition
    from lodestar.plans.q_features import mart
    snap = latest_partition(mart(spark, d)).select("property_id")
    return frame(spark, d).join(snap, "property_id", "left_semi").select("request_id", "property_id")


@query("feedback_seed", """
WITH top AS (SELECT request_id, property_id FROM ranking_log WHERE final_rank = 1 ORDER BY ts, request_id LIMIT 1)
SELECT top.request_id, top.property_id, a.action
FROM top CROSS JOIN (VALUES ('click'), ('favorite'), ('inquiry')) a(action)""", ("ranking_log",))
def q_feedback_seed(spark, d):
    """SRC-08: one bootstrap feedback row per action on the top result of the first answered query."""
    r = fx.ranking_log(spark, d).filter(F.col("final_rank") == 1)
    first = r.agg(F.min_by(F.struct("request_id", "property_id"), F.struct("ts", "request_id")).alias("t"))
    return first.select("t.request_id", "t.property_id",
                        F.explode(F.array(*[F.lit(a) for a in ("click", "favorite", "inquiry")])).alias("action"))
