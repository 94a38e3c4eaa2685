"""Queries: monitoring checks, run history, retrain decision, log-derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.columns import local_date, ts_lit, days_before
from lodestar.functions.vocab import LISTING_FEATURES
from lodestar.operators import monitoring as mon
from lodestar.operators import quality
from lodestar.plans.q_features import mart
from lodestar.plans.registry import query
from lodestar.sources import fixtures as fx

A = "TIMESTAMP '2001-07-15 12:00:00'"
RD = f"CAST({A} + INTERVAL 9 HOUR AS DATE)"
FEATS = ", ".join(LISTING_FEATURES)


def run_date():
    return local_date(ts_lit(fx.AS_OF))


def _unpivot_sql(src: str) -> str:
    return f"(UNPIVOT ({src}) ON {FEATS} INTO NAME feature_name VALUE value)"


MART_D = "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LISTING_FEATURES) + " FROM feature_mart"
LOG_D = "SELECT " + ", ".join(f"f_{c} AS {c}" for c in LISTING_FEATURES) + " FROM ranking_log"

SKEW_SQL = f"""
WITH t AS (SELECT feature_name, avg(value) AS mean, stddev_samp(value) AS sd
           FROM {_unpivot_sql(MART_D + f" WHERE event_date BETWEEN {RD} - 90 AND {RD}")} GROUP BY feature_name),
s AS (SELECT feature_name, avg(value) AS mean, stddev_samp(value) AS sd
      FROM {_unpivot_sql(LOG_D + f" WHERE ts >= {A} - INTERVAL 24 HOUR AND ts <= {A}")} GROUP BY feature_name)
SELECT {RD} AS run_date, 'mean_drift_sigma' AS metric, t.feature_name,
       round(CASE WHEN t.sd IS NULL OR t.sd = 0 THEN NULL ELSE abs(s.mean - t.mean) / t.sd END, 6) AS value,
       CAST(0.5 AS DOUBLE) AS threshold,
       CASE WHEN t.sd IS NULL OR t.sd = 0 THEN 'OK' WHEN abs(s.mean - t.mean) / t.sd >= 0.5 THEN 'FAIL'
            WHEN abs(s.mean - t.mean) / t.sd >= 0.25 THEN 'WARN' ELSE 'OK' END AS status
FROM t JOIN s ON s.feature_name = t.feature_name"""

VOLUME_SQL = f"""
SELECT {RD} AS run_date, 'search_volume' AS metric, CAST(NULL AS VARCHAR) AS feature_name,
       CAST(count(*) AS DOUBLE) AS value, CAST(100 AS DOUBLE) AS threshold,
       CASE WHEN count(*) < 100 THEN 'WARN' ELSE 'OK' END AS status
FROM search_logs WHERE ts >= {A} - INTERVAL 24 HOUR AND ts <= {A}"""

ME5_SQL = f"""
SELECT {RD} AS run_date, 'me5_score_mean' AS metric, 'me5_score' AS feature_name,
       round(avg(me5_score), 6) AS value, CAST(0.95 AS DOUBLE) AS threshold,
       CASE WHEN count(*) = 0 THEN 'OK' WHEN avg(me5_score) NOT BETWEEN 0.3 AND 0.95 THEN 'WARN' ELSE 'OK' END AS status
FROM ranking_log WHERE ts >= {A} - INTERVAL 24 HOUR AND ts <= {A}"""

CHECKS_SQL = f"({SKEW_SQL}) UNION ALL ({VOLUME_SQL}) UNION ALL ({ME5_SQL})"
CHECK_VIEWS = ("feature_mart", "ranking_log", "search_logs")


def _round_value(df):
    return df.withColumn("value", F.round("value", 6))


def checks(spark, d):
    return _round_value(mon.validation_checks(mart(spark, d), fx.ranking_log(spark, d),
                                              fx.search_logs(spark, d), fx.AS_OF))


@query("search_logs_from_ranking_log", """
SELECT request_id, ts, query, top_k, round(latency_ms, 6) AS latency_ms, result_ids, n_results FROM search_logs""",
       ("search_logs",))
def q_search_logs(spark, d):
    """AGG-18: search_logs derived from the ranking log (Q-11)."""
    s = fx.search_logs(spark, d)
    return s.select("request_id", "ts", "query", "top_k", F.round("latency_ms", 6).alias("latency_ms"),
                    F.array_join("result_property_ids", ",").alias("result_ids"),
                    F.size("result_property_ids").cast("bigint").alias("n_results"))


@query("unpivot_features", f"SELECT feature_name, round(value, 6) AS value FROM {_unpivot_sql(MART_D)}",
       ("feature_mart",))
def q_unpivot(spark, d):
    u = mon.unpivot_features(mart(spark, d))
    return u.select("feature_name", F.round("value", 6).alias("value"))


@query("feature_moments", f"""
SELECT feature_name, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd
FROM {_unpivot_sql(MART_D)} GROUP BY feature_name""", ("feature_mart",))
def q_moments(spark, d):
    m = mon.feature_moments(mon.unpivot_features(mart(spark, d)))
    return m.select("feature_name", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


@query("feature_skew", SKEW_SQL, ("feature_mart", "ranking_log"))
def q_skew(spark, d):
    return _round_value(mon.feature_skew(mart(spark, d), fx.ranking_log(spark, d), fx.AS_OF))


@query("volume_sentinel", VOLUME_SQL, ("search_logs",))
def q_volume(spark, d):
    return mon.volume_sentinel(fx.search_logs(spark, d), fx.AS_OF)


@query("me5_sentinel", ME5_SQL, ("ranking_log",))
def q_me5_sentinel(spark, d):
    return _round_value(mon.me5_sentinel(fx.ranking_log(spark, d), fx.AS_OF))


@query("union_checks", CHECKS_SQL, CHECK_VIEWS)
def q_union_checks(spark, d):
    return checks(spark, d)


@query("metadata_columns", f"SELECT run_date, metric, feature_name, threshold, status FROM ({CHECKS_SQL})",
       CHECK_VIEWS)
def q_metadata(spark, d):
    return checks(spark, d).select("run_date", "metric", "feature_name", "threshold", "status")


@query("skew_latest", f"SELECT * FROM ({CHECKS_SQL}) WHERE run_date = {RD} ORDER BY status DESC, abs(value) DESC",
       CHECK_VIEWS)
def q_skew_latest(spark, d):
    return mon.skew_latest(checks(spark, d), run_date())


@query("append_validation_results", CHECKS_SQL, CHECK_VIEWS)
def q_append_validation(spark, d):
    """SNK-10: check rows appended under run_date partitions; read back."""
    from lodestar.operators import sinks
    from lodestar.plans.q_features import _sink_dir
    path = _sink_dir(spark, "validation_results")
    sinks.append_validation_results(checks(spark, d), path)
    return spark.read.parquet(path).select(*mon.CHECK_COLUMNS)


def _corr_sql(extra: str = "") -> str:
    return f"""
SELECT run_date, row_count, CASE WHEN isnan(c) THEN NULL ELSE round(c, 6) END AS corr_lexical_semantic,
       round(m, 6) AS mean_rrf_rank
FROM (SELECT {RD} AS run_date, count(*) AS row_count,
             corr(CAST(lexical_rank AS DOUBLE), CAST(semantic_rank AS DOUBLE)) AS c, avg(CAST(rrf_rank AS DOUBLE)) AS m
      FROM ranking_log
      WHERE CAST(ts + INTERVAL 9 HOUR AS DATE) = {RD} AND schema_version >= 2
        AND lexical_rank IS NOT NULL AND semantic_rank IS NOT NULL {extra})"""


def _corr(df):
    c = F.col("corr_lexical_semantic")
    return df.select("run_date", "row_count",
                     F.round(F.when(F.isnan(c), None).otherwise(c), 6).alias("corr_lexical_semantic"),
                     F.round("mean_rrf_rank", 6).alias("mean_rrf_rank"))


@query("rank_correlation", _corr_sql(), ("ranking_log",))
def q_rank_corr(spark, d):
    return _corr(mon.rank_correlation(fx.ranking_log(spark, d), run_date()))


@query("rank_diff_daily", f"""
SELECT a.*, b.row_count AS rows_without_sentinel, b.corr_lexical_semantic AS corr_without_sentinel
FROM ({_corr_sql()}) a, ({_corr_sql("AND lexical_rank < 10000 AND semantic_rank < 10000")}) b""", ("ranking_log",))
def q_rank_diff_daily(spark, d):
    """MON-04: the parity row plus the sentinel-free correlation (Q-10)."""
    r = fx.ranking_log(spark, d)
    a = _corr(mon.rank_correlation(r, run_date()))
    b = _corr(mon.rank_correlation(r, run_date(), exclude_sentinel=True)).select(
        F.col("row_count").alias("rows_without_sentinel"),
        F.col("corr_lexical_semantic").alias("corr_without_sentinel"))
    return a.select("*", *[b.select(c).scalar().alias(c) for c in b.columns])


@query("search_volume", f"""
SELECT count(*) AS n_searches, min(ts) AS first_ts, max(ts) AS last_ts FROM search_logs
WHERE ts >= {A} - INTERVAL 24 HOUR AND ts <= {A}""", ("search_logs",))
def q_search_volume(spark, d):
    return mon.search_volume(fx.search_logs(spark, d), fx.AS_OF)


@query("me5_mean", f"SELECT round(avg(me5_score), 6) AS me5_mean FROM ranking_log WHERE ts >= {A} - INTERVAL 24 HOUR AND ts <= {A}",
       ("ranking_log",))
def q_me5_mean(spark, d):
    return mon.me5_mean(fx.ranking_log(spark, d), fx.AS_OF).select(F.round("me5_mean", 6).alias("me5_mean"))


@query("last_run_finished_at", f"SELECT max(finished_at) AS last_run_finished_at FROM training_runs WHERE finished_at <= {A}",
       ("training_runs",))
def q_last_run(spark, d):
    return mon.last_run_finished_at(fx.training_runs(spark, d), fx.AS_OF)


@query("feedback_rows_since", f"""
SELECT count(*) AS feedback_rows FROM feedback_events
WHERE ts >= coalesce((SELECT max(finished_at) FROM training_runs WHERE finished_at <= {A}), {A} - INTERVAL 30 DAY)
  AND ts <= {A}""", ("training_runs", "feedback_events"))
def q_feedback_since(spark, d):
    last = mon.last_run_finished_at(fx.training_runs(spark, d), fx.AS_OF).scalar()
    since = F.coalesce(last, days_before(ts_lit(fx.AS_OF), 30))
    return mon.feedback_rows_since(fx.feedback_events(spark, d), since, fx.AS_OF)


@query("ndcg_in_window", f"""
SELECT round(avg(ndcg_at_10), 6) AS ndcg FROM training_runs
WHERE finished_at BETWEEN {A} - INTERVAL 30 DAY AND {A}""", ("training_runs",))
def q_ndcg_window(spark, d):
    now = ts_lit(fx.AS_OF)
    r = mon.ndcg_in_window(fx.training_runs(spark, d), days_before(now, 30), now)
    return r.select(F.round("ndcg", 6).alias("ndcg"))


RETRAIN_SQL = f"""
WITH r AS (SELECT * FROM training_runs WHERE finished_at <= {A}),
st AS (SELECT (SELECT max(finished_at) FROM r) AS last_run_finished_at,
              (SELECT avg(ndcg_at_10) FROM r WHERE finished_at BETWEEN {A} - INTERVAL 3 DAY AND {A}) AS ndcg_current,
              (SELECT avg(ndcg_at_10) FROM r WHERE finished_at BETWEEN {A} - INTERVAL 10 DAY AND {A} - INTERVAL 7 DAY) AS ndcg_week_ago),
x AS (SELECT st.*, (SELECT count(*) FROM feedback_events f
                    WHERE f.ts >= coalesce(st.last_run_finished_at, {A} - INTERVAL 30 DAY) AND f.ts <= {A}) AS feedback_rows_since_last
      FROM st),
y AS (SELECT x.*, list_filter([
        CASE WHEN feedback_rows_since_last > 10000 THEN 'feedback_rows=' || feedback_rows_since_last || '>10000' END,
        CASE WHEN ndcg_week_ago - ndcg_current >= 0.03 THEN 'ndcg_drop=' || printf('%.3f', ndcg_week_ago - ndcg_current) || '>=0.03' END,
        CASE WHEN last_run_finished_at IS NULL THEN 'no_prior_run' END,
        CASE WHEN last_run_finished_at IS NOT NULL AND epoch({A}) - epoch(last_run_finished_at) > 7 * 86400
             THEN 'last_run_age_days=' || CAST(floor((epoch({A}) - epoch(last_run_finished_at)) / 86400) AS BIGINT) || '>7' END
      ], lambda s: s IS NOT NULL) AS rs FROM x)
SELECT len(rs) > 0 AS should_retrain, array_to_string(rs, ';') AS reasons, feedback_rows_since_last,
       round(ndcg_current, 6) AS ndcg_current, round(ndcg_week_ago, 6) AS ndcg_week_ago, last_run_finished_at
FROM y"""


@query("retrain_decision", RETRAIN_SQL, ("training_runs", "feedback_events"))
def q_retrain(spark, d):
    r = mon.retrain_decision(fx.training_runs(spark, d), fx.feedback_events(spark, d), fx.AS_OF)
    return r.withColumn("ndcg_current", F.round("ndcg_current", 6)) \
        .withColumn("ndcg_week_ago", F.round("ndcg_week_ago", 6))


@query("gate_runs", "SELECT run_id, round(coalesce(ndcg_at_10, 0), 6) AS ndcg_at_10, coalesce(ndcg_at_10, 0) >= 0.6 AS passed FROM training_runs",
       ("training_runs",))
def q_gate(spark, d):
    g = mon.gate_runs(fx.training_runs(spark, d))
    return g.withColumn("ndcg_at_10", F.round("ndcg_at_10", 6))


@query("runs_recent", """
SELECT run_id, started_at, finished_at, model_path, round(ndcg_at_10, 6) AS ndcg_at_10, round(map, 6) AS map,
       round(recall_at_20, 6) AS recall_at_20
FROM training_runs ORDER BY finished_at DESC NULLS LAST, run_id LIMIT 5""", ("training_runs",))
def q_runs_recent(spark, d):
    r = mon.runs_recent(fx.training_runs(spark, d))
    return r.select("run_id", "started_at", "finished_at", "model_path",
                    *[F.round(c, 6).alias(c) for c in ("ndcg_at_10", "map", "recall_at_20")])


@query("latest_model_path", f"""
SELECT model_path FROM training_runs WHERE finished_at IS NOT NULL AND finished_at <= {A}
ORDER BY finished_at DESC, run_id DESC LIMIT 1""", ("training_runs",))
def q_latest_model(spark, d):
    return mon.latest_model_path(fx.training_runs(spark, d), fx.AS_OF)


@query("scan_top", f"""
SELECT job_id, user_email, creation_time, total_bytes_processed, round(total_bytes_processed / 1e9, 6) AS gb_processed
FROM job_audit WHERE creation_time >= {A} - INTERVAL 7 DAY AND creation_time <= {A}
ORDER BY total_bytes_processed DESC, job_id LIMIT 20""", ("job_audit",))
def q_scan_top(spark, d):
    s = mon.scan_top(fx.job_audit(spark, d), fx.AS_OF)
    return s.withColumn("gb_processed", F.round("gb_processed", 6))


@query("seed_counts", """
SELECT (SELECT count(*) FROM listings) AS n_properties, (SELECT count(*) FROM feature_mart) AS n_features,
       (SELECT count(*) FROM embeddings) AS n_embeddings""", ("listings", "feature_mart"))
def q_seed_counts(spark, d):
    from lodestar.sources.tables import read
    return mon.seed_counts(fx.listings(spark, d), mart(spark, d), read(spark, d, "embeddings"))


@query("latency_histogram", """
WITH b AS (SELECT CASE WHEN latency_ms < 1 THEN 0 ELSE
             CAST(least(floor(log2(latency_ms)) + 1, 25) AS BIGINT) END AS bucket FROM access_log)
SELECT bucket, count(*) AS n FROM b GROUP BY bucket""", ("access_log",))
def q_latency_histogram(spark, d):
    return mon.latency_histogram(fx.access_log(spark, d))


DRIFT_SQL = f"""
WITH tr AS {_unpivot_sql(MART_D)},
sv AS {_unpivot_sql(LOG_D + f" WHERE ts >= {A} - INTERVAL 28 DAY AND ts <= {A}")},
bo AS (SELECT feature_name, value, 't' AS side FROM tr UNION ALL SELECT feature_name, value, 's' FROM sv),
rng AS (SELECT feature_name, min(value) AS lo, max(value) AS hi FROM bo GROUP BY feature_name),
b AS (SELECT bo.feature_name, side,
             CASE WHEN (hi - lo) / 10 > 0 THEN least(floor((value - lo) / ((hi - lo) / 10)), 9) ELSE 0 END AS bin
      FROM bo JOIN rng ON rng.feature_name = bo.feature_name),
c AS (SELECT feature_name, bin, count_if(side = 't') AS nt, count_if(side = 's') AS ns FROM b GROUP BY feature_name, bin),
pq AS (SELECT feature_name, nt / sum(nt) OVER (PARTITION BY feature_name) AS p,
              ns / sum(ns) OVER (PARTITION BY feature_name) AS q FROM c),
t AS (SELECT feature_name, 0.5 * CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                         + 0.5 * CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END AS term FROM pq)
SELECT feature_name, round(sum(term), 6) AS js, CAST(0.3 AS DOUBLE) AS threshold, sum(term) > 0.3 AS alert
FROM t GROUP BY feature_name"""


@query("distribution_drift", DRIFT_SQL, ("feature_mart", "ranking_log"))
def q_drift(spark, d):
    """MON-06: Jensen-Shannon per listing feature, mart vs the last 28 days of logged features."""
    now = ts_lit(fx.AS_OF)
    r = fx.ranking_log(spark, d)
    serve = r.filter((F.col("ts") >= days_before(now, 28)) & (F.col("ts") <= now)) \
        .select(*[F.col(f"features.{c}").alias(c) for c in LISTING_FEATURES])
    out = mon.distribution_drift(mart(spark, d), serve)
    return out.withColumn("js", F.round("js", 6))


@query("rank_summary", """
SELECT request_id, string_agg(property_id || ':' || lexical_rank || ':' || final_rank || ':' || printf('%.4f', score) || ':' || printf('%.4f', me5_score), ';' ORDER BY final_rank) AS summary
FROM ranking_log GROUP BY request_id""", ("ranking_log",))
def q_rank_summary(spark, d):
    """PRJ-11: per request, ids with lexical and final rank in final order."""
    r = fx.ranking_log(spark, d)
    s = r.groupBy("request_id").agg(F.sort_array(F.collect_list(
        F.struct("final_rank", "property_id", "lexical_rank", "score", "me5_score"))).alias("l"))
    return s.select("request_id", F.array_join(F.transform("l", lambda x: F.concat_ws(
        ":", x["property_id"], x["lexical_rank"].cast("string"), x["final_rank"].cast("string"),
        F.format_string("%.4f", x["score"]), F.format_string("%.4f", x["me5_score"]))), ";").alias("summary"))


@query("feedback_valid", """
SELECT request_id, property_id, action, action IN ('click', 'favorite', 'inquiry') AS is_valid FROM feedback_stream""",
       ("feedback_stream",))
def q_feedback_valid(spark, d):
    """VAL-02: whitelist split of streamed feedback (valid and quarantined rows together)."""
    fb = fx.feedback_stream_rows(spark, d).select("request_id", "property_id", "action")
    valid, rejected = quality.split_feedback(fb)
    return valid.withColumn("is_valid", F.lit(True)).unionByName(
        rejected.drop("reject_reason").withColumn("is_valid", F.lit(False)))


@query("requests_valid", """
SELECT query_id, top_k, array_to_string(list_filter([
         CASE WHEN query_text IS NULL THEN 'query_missing' END,
         CASE WHEN query_text IS NOT NULL AND (length(query_text) < 1 OR length(query_text) > 512) THEN 'query_length' END,
         CASE WHEN top_k < 1 OR top_k > 100 THEN 'top_k_range' END,
         CASE WHEN max_rent < 0 THEN 'max_rent_negative' END,
         CASE WHEN max_walk_min < 0 THEN 'max_walk_min_negative' END,
         CASE WHEN max_age < 0 THEN 'max_age_negative' END], lambda s: s IS NOT NULL), ';') AS reject_reasons
FROM text_queries""", ("text_queries",))
def q_requests_valid(spark, d):
    v = quality.requests_valid(fx.text_queries(spark, d))
    return v.select("query_id", "top_k", F.array_join("reject_reasons", ";").alias("reject_reasons"))


@query("vector_contract", """
SELECT property_id, CAST(len(embedding) AS INTEGER) AS dim FROM property_embeddings
WHERE len(embedding) <> 64 OR abs(sqrt(list_sum(list_transform(embedding, lambda x: x * x))) - 1) > 1e-6""",
       ("property_embeddings",))
def q_vector_contract(spark, d):
    bad = quality.vector_contract(fx.property_embeddings(spark, d), 64)
    return bad.select("property_id", "dim")


@query("skew_join", f"""
WITH t AS (SELECT feature_name, avg(value) AS mean FROM {_unpivot_sql(MART_D + f" WHERE event_date BETWEEN {RD} - 90 AND {RD}")} GROUP BY 1),
s AS (SELECT feature_name, avg(value) AS mean FROM {_unpivot_sql(LOG_D + f" WHERE ts >= {A} - INTERVAL 24 HOUR AND ts <= {A}")} GROUP BY 1)
SELECT t.feature_name, round(t.mean, 6) AS train_mean, round(s.mean, 6) AS serve_mean
FROM t JOIN s ON s.feature_name = t.feature_name""", ("feature_mart", "ranking_log"))
def q_skew_join(spark, d):
    """JOIN-08: training stats inner join serving stats on feature_name (one-sided features vanish)."""
    t = mon.feature_moments(mon.unpivot_features(mon.training_side(mart(spark, d), fx.AS_OF)))
    s = mon.feature_moments(mon.unpivot_features(mon.serving_side(fx.ranking_log(spark, d), fx.AS_OF)))
    return t.select("feature_name", F.round("mean", 6).alias("train_mean")).join(
        s.select("feature_name", F.round("mean", 6).alias("serve_mean")), "feature_name")


@query("append_run", """
SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS run_id, round(CAST(0.5 AS DOUBLE) + CAST(o_orderkey % 400 AS DOUBLE) / 1000, 6) AS ndcg_at_10,
       CAST(NULL AS DOUBLE) AS recall_at_20, CAST(NULL AS BIGINT) AS num_leaves, CAST(0.05 AS DOUBLE) AS learning_rate
FROM orders""")
def q_append_run(spark, d):
    """SNK-04: run rows with partial metric/hyperparameter keys; missing keys are null; read back."""
    from lodestar.operators import sinks
    from lodestar.plans.q_features import _sink_dir
    runs = fx.training_runs(spark, d).select("run_id", "started_at", "finished_at", "model_path",
                                             F.col("metrics.ndcg_at_10").alias("ndcg_at_10"),
                                             F.col("hyperparams.learning_rate").alias("learning_rate"))
    path = _sink_dir(spark, "training_runs")
    sinks.append_run(runs, path)
    back = spark.read.parquet(path)
    return back.select("run_id", F.round("metrics.ndcg_at_10", 6).alias("ndcg_at_10"),
                       F.col("metrics.recall_at_20").alias("recall_at_20"),
                       F.col("hyperparams.num_leaves").alias("num_leaves"),
                       F.col("hyperparams.learning_rate").alias("learning_rate"))
