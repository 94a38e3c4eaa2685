"""Monitoring: skew, sentinels, rank correlation, retrain decision, drift, run queries.

Every check is a global or per-feature aggregate (partial aggregation map-side,
one small final task), so checks stay cheap however large the logs grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.columns import days_before, latency_bucket, local_date, safe_divide, ts_lit
from lodestar.functions.vocab import (DRIFT_THRESHOLD, LATENCY_BUCKETS, LISTING_FEATURES, ME5_MEAN_HIGH,
                                      ME5_MEAN_LOW, NDCG_DEGRADATION, NEW_FEEDBACK_ROWS_THRESHOLD,
                                      PROMOTION_METRIC, PROMOTION_THRESHOLD, SKEW_FAIL, SKEW_WARN,
                                      STALE_DAYS, TRAINING_WINDOW_DAYS, VOLUME_MIN)

CHECK_COLUMNS = ["run_date", "metric", "feature_name", "value", "threshold", "status"]


def search_logs_from_ranking_log(ranking_log: DataFrame, requests: DataFrame) -> DataFrame:
    """AGG-18: one search_logs row per request with its shown ids in display order.

    The display position counts rows by (final_rank, rrf_rank), which holds in
    both regimes: without a model final_rank is the lexical rank value. Only the
    first ``top_k`` positions were shown, so the list is bounded by top_k (<= 100).
    A request whose pool was empty keeps its row, with no ids and, where
    ``requests`` carries ``requested_at``, that instant.
    """
    r = ranking_log.select("request_id", "ts", "property_id", "final_rank", "rrf_rank", "model_path")
    order = Window.partitionBy("request_id").orderBy("final_rank", "rrf_rank", "property_id")
    shown = r.withColumn("_at", F.row_number().over(order)).join(requests.select("request_id", "top_k"), "request_id") \
        .filter(F.col("_at") <= F.col("top_k"))
    per_req = shown.groupBy("request_id").agg(
        F.min("ts").alias("ts"),
        F.transform(F.sort_array(F.collect_list(F.struct("_at", "property_id"))),
                    lambda s: s["property_id"]).alias("result_property_ids"),
        F.max("model_path").alias("model_path"),
    )
    asked = F.col("requested_at") if "requested_at" in requests.columns else F.lit(None).cast("timestamp_ntz")
    return requests.join(per_req, "request_id", "left").select(
        "request_id", F.coalesce("ts", asked).alias("ts"), "query", "filters", "top_k",
        F.coalesce("result_property_ids", F.array().cast("array<string>")).alias("result_property_ids"), "model_path", "latency_ms")


def unpivot_features(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """SET-02: wide features -> (feature_name, value) as double, nulls dropped like SQL UNPIVOT."""
    feats = features or LISTING_FEATURES
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in feats])
    return (wide.unpivot([], feats, "feature_name", "value")
            .filter(F.col("value").isNotNull()))


def feature_moments(long: DataFrame) -> DataFrame:
    """AGG-07: mean and sample standard deviation per feature."""
    return long.groupBy("feature_name").agg(F.avg("value").alias("mean"),
                                            F.stddev_samp("value").alias("sd"))


def _run_date(as_of: str) -> Column:
    return local_date(ts_lit(as_of))


def training_side(features: DataFrame, as_of: str, days: int = TRAINING_WINDOW_DAYS) -> DataFrame:
    today = _run_date(as_of)
    return features.filter(F.col("event_date").between(F.date_sub(today, days), today))


def serving_side(ranking_log: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    now = ts_lit(as_of)
    recent = ranking_log.filter((F.col("ts") >= now - F.make_interval(hours=F.lit(hours)))
                                & (F.col("ts") <= now))
    return recent.select(*[F.col(f"features.{c}").alias(c) for c in LISTING_FEATURES])


def feature_skew(features: DataFrame, ranking_log: DataFrame, as_of: str) -> DataFrame:
    """MON-01: standardized mean drift per listing feature with OK/WARN/FAIL."""
    t = feature_moments(unpivot_features(training_side(features, as_of))).alias("t")
    s = feature_moments(unpivot_features(serving_side(ranking_log, as_of))).alias("s")
    j = t.join(s, "feature_name")
    diff = F.abs(F.col("s.mean") - F.col("t.mean"))
    sd = F.col("t.sd")
    status = (F.when(sd.isNull() | (sd == 0), "OK").when(diff / sd >= SKEW_FAIL, "FAIL")
              .when(diff / sd >= SKEW_WARN, "WARN").otherwise("OK"))
    return j.select(_run_date(as_of).alias("run_date"), F.lit("mean_drift_sigma").alias("metric"),
                    "feature_name", safe_divide(diff, sd).alias("value"),
                    F.lit(SKEW_FAIL).alias("threshold"), status.alias("status"))


def volume_sentinel(search_logs: DataFrame, as_of: str) -> DataFrame:
    """MON-02: searches in the last 24 h; fewer than 100 -> WARN."""
    now = ts_lit(as_of)
    n = F.count(F.lit(1))
    recent = search_logs.filter((F.col("ts") >= now - F.make_interval(hours=F.lit(24))) & (F.col("ts") <= now))
    return recent.agg(
        _run_date(as_of).alias("run_date"), F.lit("search_volume").alias("metric"),
        F.lit(None).cast("string").alias("feature_name"), n.cast("double").alias("value"),
        F.lit(float(VOLUME_MIN)).alias("threshold"),
        F.when(n < VOLUME_MIN, "WARN").otherwise("OK").alias("status"))


def me5_sentinel(ranking_log: DataFrame, as_of: str) -> DataFrame:
    """MON-03: mean me5 score in the last 24 h outside [0.3, 0.95] -> WARN; no rows -> OK."""
    now = ts_lit(as_of)
    recent = ranking_log.filter((F.col("ts") >= now - F.make_interval(hours=F.lit(24))) & (F.col("ts") <= now))
    m = F.avg("me5_score")
    return recent.agg(
        _run_date(as_of).alias("run_date"), F.lit("me5_score_mean").alias("metric"),
        F.lit("me5_score").alias("feature_name"), m.alias("value"),
        F.lit(ME5_MEAN_HIGH).alias("threshold"),
        F.when(F.count(F.lit(1)) == 0, "OK")
        .when(~m.between(ME5_MEAN_LOW, ME5_MEAN_HIGH), "WARN").otherwise("OK").alias("status"))


def union_checks(*checks: DataFrame) -> DataFrame:
    """SET-01 / PRJ-10: all check rows in the validation_results shape."""
    out = checks[0].select(*CHECK_COLUMNS)
    for c in checks[1:]:
        out = out.unionByName(c.select(*CHECK_COLUMNS))
    return out


def validation_checks(features: DataFrame, ranking_log: DataFrame, search_logs: DataFrame,
                      as_of: str) -> DataFrame:
    """The daily check job: skew + volume + me5 sentinel rows."""
    return union_checks(feature_skew(features, ranking_log, as_of),
                        volume_sentinel(search_logs, as_of), me5_sentinel(ranking_log, as_of))


def skew_latest(checks: DataFrame, run_date: Column, severity_order: bool = False) -> DataFrame:
    """TOP-06: a day's check rows, status DESC (alphabetical, FAIL last) then |value| DESC.

    ``severity_order=True`` sorts FAIL, WARN, OK instead.
    """
    day = checks.filter(F.col("run_date") == run_date)
    if severity_order:
        sev = F.when(F.col("status") == "FAIL", 0).when(F.col("status") == "WARN", 1).otherwise(2)
        return day.orderBy(sev, F.abs("value").desc_nulls_last())
    return day.orderBy(F.col("status").desc(), F.abs("value").desc_nulls_last())


def rank_correlation(ranking_log: DataFrame, run_date: Column, exclude_sentinel: bool = False) -> DataFrame:
    """AGG-08 / MON-04: rows, corr(lexical, semantic) and mean rrf rank for one local day."""
    from lodestar.operators.features import local_day_filter, schema_version_filter
    day = schema_version_filter(local_day_filter(ranking_log, run_date))
    if exclude_sentinel:
        day = day.filter((F.col("lexical_rank") < 10000) & (F.col("semantic_rank") < 10000))
    return day.agg(
        run_date.alias("run_date"),
        F.count(F.lit(1)).alias("row_count"),
        F.corr(F.col("lexical_rank").cast("double"), F.col("semantic_rank").cast("double"))
        .alias("corr_lexical_semantic"),
        F.avg(F.col("rrf_rank").cast("double")).alias("mean_rrf_rank"))


def search_volume(search_logs: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """AGG-09: count, first and last ts of searches in the last ``hours``."""
    now = ts_lit(as_of)
    recent = search_logs.filter((F.col("ts") >= now - F.make_interval(hours=F.lit(hours))) & (F.col("ts") <= now))
    return recent.agg(F.count(F.lit(1)).alias("n_searches"), F.min("ts").alias("first_ts"),
                      F.max("ts").alias("last_ts"))


def me5_mean(ranking_log: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """AGG-10: mean me5 score in the last ``hours``; null when empty."""
    now = ts_lit(as_of)
    recent = ranking_log.filter((F.col("ts") >= now - F.make_interval(hours=F.lit(hours))) & (F.col("ts") <= now))
    return recent.agg(F.avg("me5_score").alias("me5_mean"))


def _runs_as_of(runs: DataFrame, as_of: str) -> DataFrame:
    return runs.filter(F.col("finished_at").isNotNull() & (F.col("finished_at") <= ts_lit(as_of)))


def last_run_finished_at(runs: DataFrame, as_of: str) -> DataFrame:
    """AGG-11: newest finished_at (null when there is none)."""
    return _runs_as_of(runs, as_of).agg(F.max("finished_at").alias("last_run_finished_at"))


def feedback_rows_since(feedback: DataFrame, since: Column, as_of: str) -> DataFrame:
    """AGG-12: feedback rows with since <= ts <= as_of."""
    return feedback.agg(F.count_if((F.col("ts") >= since) & (F.col("ts") <= ts_lit(as_of)))
                        .alias("feedback_rows"))


def ndcg_in_window(runs: DataFrame, start: Column, end: Column) -> DataFrame:
    """AGG-13: mean metrics.ndcg_at_10 of runs finished in [start, end] (both inclusive)."""
    inside = F.col("finished_at").between(start, end)
    return runs.agg(F.avg(F.when(inside, F.col("metrics.ndcg_at_10"))).alias("ndcg"))


def retrain_decision(runs: DataFrame, feedback: DataFrame, as_of: str,
                     feedback_threshold: int = NEW_FEEDBACK_ROWS_THRESHOLD,
                     ndcg_drop: float = NDCG_DEGRADATION, stale_days: int = STALE_DAYS) -> DataFrame:
    """MON-05: one decision row with the reasons and the inputs behind them.

    The inputs are scalar subqueries evaluated inside the plan (no driver round trip).
    """
    now = ts_lit(as_of)
    r = runs.filter(F.col("finished_at") <= now)
    fin = F.col("finished_at")
    ndcg = F.col("metrics.ndcg_at_10")
    stats = r.agg(F.struct(  # one scan of the runs for all three
        F.max("finished_at").alias("last"), F.avg(F.when(fin.between(days_before(now, 3), now), ndcg)).alias("now"),
        F.avg(F.when(fin.between(days_before(now, 10), days_before(now, 7)), ndcg)).alias("ago"))).scalar()
    last, ndcg_now, ndcg_ago = stats["last"], stats["now"], stats["ago"]
    since = F.coalesce(last, days_before(now, 30))
    counted = feedback.filter((F.col("ts") >= since) & (F.col("ts") <= now)).agg(
        F.count(F.lit(1)).alias("feedback_rows_since_last"),
        last.alias("last_run_finished_at"), ndcg_now.alias("ndcg_current"), ndcg_ago.alias("ndcg_week_ago"))
    delta = F.col("ndcg_week_ago") - F.col("ndcg_current")
    age_s = (F.unix_timestamp(now.cast("timestamp"))
             - F.unix_timestamp(F.col("last_run_finished_at").cast("timestamp")))
    reasons = F.array_compact(F.array(
        F.when(F.col("feedback_rows_since_last") > feedback_threshold,
               F.format_string(f"feedback_rows=%d>{feedback_threshold}", F.col("feedback_rows_since_last"))),
        F.when(delta >= ndcg_drop, F.format_string(f"ndcg_drop=%.3f>={ndcg_drop}", delta)),
        F.when(F.col("last_run_finished_at").isNull(), F.lit("no_prior_run")),
        F.when(F.col("last_run_finished_at").isNotNull() & (age_s > stale_days * 86400),
               F.format_string(f"last_run_age_days=%d>{stale_days}", F.floor(age_s / 86400).cast("bigint"))),
    ))
    return counted.select(
        (F.size(reasons) > 0).alias("should_retrain"),
        F.array_join(reasons, ";").alias("reasons"),
        "feedback_rows_since_last", "ndcg_current", "ndcg_week_ago", "last_run_finished_at")


def gate_runs(runs: DataFrame, metric: str = PROMOTION_METRIC,
              threshold: float = PROMOTION_THRESHOLD) -> DataFrame:
    """PRJ-09: metric >= threshold, a missing metric counting as 0.0."""
    value = F.coalesce(F.col(f"metrics.{metric}"), F.lit(0.0))
    return runs.select("run_id", value.alias(metric), (value >= threshold).alias("passed"))


def runs_recent(runs: DataFrame, n: int = 5) -> DataFrame:
    """TOP-03: the n latest runs by finished_at, flattened metrics."""
    return (runs.orderBy(F.col("finished_at").desc_nulls_last(), F.col("run_id"))
            .limit(n)
            .select("run_id", "started_at", "finished_at", "model_path",
                    F.col("metrics.ndcg_at_10").alias("ndcg_at_10"), F.col("metrics.map").alias("map"),
                    F.col("metrics.recall_at_20").alias("recall_at_20")))


def latest_model_path(runs: DataFrame, as_of: str) -> DataFrame:
    """TOP-04: model path of the newest finished run."""
    done = _runs_as_of(runs, as_of)
    return done.agg(F.max_by("model_path", F.struct("finished_at", "run_id")).alias("model_path"))


def scan_top(jobs: DataFrame, as_of: str, days: int = 7, n: int = 20) -> DataFrame:
    """TOP-05: top jobs by bytes processed in the last ``days``, gb = bytes / 1e9."""
    now = ts_lit(as_of)
    recent = jobs.filter((F.col("creation_time") >= days_before(now, days)) & (F.col("creation_time") <= now))
    return (recent.select("job_id", "user_email", "creation_time", "total_bytes_processed",
                          (F.col("total_bytes_processed") / 1e9).alias("gb_processed"))
            .orderBy(F.col("total_bytes_processed").desc(), "job_id").limit(n))


def seed_counts(listings: DataFrame, features: DataFrame, embeddings: DataFrame) -> DataFrame:
    """AGG-16: three table counts in one row (scalar subqueries)."""
    n_feat = features.agg(F.count(F.lit(1))).scalar()
    n_emb = embeddings.agg(F.count(F.lit(1))).scalar()
    return listings.agg(F.count(F.lit(1)).alias("n_properties"),
                        n_feat.alias("n_features"), n_emb.alias("n_embeddings"))


def latency_histogram(log: DataFrame, buckets: int = LATENCY_BUCKETS) -> DataFrame:
    """AGG-17: exponential buckets (growth 2, scale 1): bucket i covers [2^(i-1), 2^i)."""
    return (log.select(latency_bucket(F.col("latency_ms"), buckets).alias("bucket"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))


def distribution_drift(train: DataFrame, serve: DataFrame, features: list[str] | None = None,
                       bins: int = 10, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """MON-06: Jensen-Shannon divergence (base 2) per feature on shared equal-width bins.

    Bin edges come from the min/max of both sides together (one aggregate);
    counts are one grouped aggregate per side. Output: feature_name, js, alert.
    """
    feats = features or LISTING_FEATURES
    t = unpivot_features(train, feats).withColumn("side", F.lit("t"))
    s = unpivot_features(serve, feats).withColumn("side", F.lit("s"))
    both = t.unionByName(s)
    rng = both.groupBy("feature_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = both.join(rng, "feature_name").withColumn(
        "bin", F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)))
        .otherwise(F.lit(0)).cast("bigint"))
    counts = b.groupBy("feature_name", "bin").agg(
        F.count_if(F.col("side") == "t").alias("nt"), F.count_if(F.col("side") == "s").alias("ns"))
    tot = Window.partitionBy("feature_name")
    p = F.col("nt") / F.sum("nt").over(tot)
    q = F.col("ns") / F.sum("ns").over(tot)
    m = (p + q) / 2

    def kl(a):
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    terms = counts.select("feature_name", (0.5 * kl(p) + 0.5 * kl(q)).alias("term"))
    return (terms.groupBy("feature_name").agg(F.sum("term").alias("js"))
            .withColumn("threshold", F.lit(threshold))
            .withColumn("alert", F.col("js") > threshold))
