"""Queries: batch twins of the streaming operators, and the operators run as real streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestar.functions.columns import ts_lit
from lodestar.functions.vocab import CACHE_TTL_SECONDS, LATENCY_P95_ALERT_MS
from lodestar.plans.q_features import _sink_dir, mart
from lodestar.plans.q_monitoring import A, DRIFT_SQL, RETRAIN_SQL, q_drift
from lodestar.plans.registry import query
from lodestar.sources import fixtures as fx
from lodestar.streaming import messages as msg
from lodestar.streaming import operators as so

HOUR_RUN = 3  # the hourly variants show alert rows on the driver events, which are sparse by the minute


def _rl_messages(spark, d):
    return msg.to_message(fx.ranking_log(spark, d), {"debug_unknown_field": F.lit("dropped")})


RL_SQL = "SELECT request_id, property_id, ts, lexical_rank, final_rank, round(score, 6) AS score, f_rent FROM ranking_log"


def _rl_out(df):
    return df.select("request_id", "property_id", "ts", "lexical_rank", "final_rank",
                     F.round("score", 6).alias("score"), F.col("features.rent").alias("f_rent"))


@query("ranking_log_stream", RL_SQL, ("ranking_log",))
def q_rl_stream(spark, d):
    """STR-01: ranking-log JSON (with an unknown field) -> typed rows."""
    return _rl_out(msg.ranking_log_rows(_rl_messages(spark, d)))


FB_SQL = "SELECT request_id, property_id, action, ts FROM feedback_stream WHERE action IN ('click', 'favorite', 'inquiry')"


@query("feedback_stream", FB_SQL, ("feedback_stream",))
def q_fb_stream(spark, d):
    """STR-02: feedback JSON -> typed rows passing the action whitelist."""
    raw = msg.to_message(fx.feedback_stream_rows(spark, d).drop("event_id"))
    valid, _ = msg.feedback_rows(raw)
    return valid


def _run_stream_to_table(spark, raw_df, parse_fn, name, kind):
    """Write messages as compressed JSON files, stream them through ``parse_fn`` into parquet and what it rejects
    into a quarantine table beside it; (table, quarantine) read back."""
    base = _sink_dir(spark, name)
    raw_df.write.mode("errorifexists").option("compression", "gzip").text(f"{base}/in")
    stream = spark.readStream.schema("value string").text(f"{base}/in")
    runs = [so.stream_to_table(parse_fn(stream), f"{base}/out", f"{base}/ckpt"),
            so.stream_to_table(msg.quarantine(stream, kind), f"{base}/quarantine", f"{base}/ckpt-quarantine")]
    for q in runs:
        q.awaitTermination()
    rejected = spark.read.schema("topic string, raw string, reason string").parquet(f"{base}/quarantine")
    return spark.read.parquet(f"{base}/out"), rejected


@query("stream_to_table", RL_SQL, ("ranking_log",))
def q_stream_to_table(spark, d):
    """SNK-05: a real Structured Streaming run: JSON files -> from_json -> parquet sink with checkpoint."""
    out, _ = _run_stream_to_table(spark, _rl_messages(spark, d), msg.ranking_log_rows, "ranking_log_stream", "ranking_log")
    return _rl_out(out)


@query("record_feedback", FB_SQL, ("feedback_stream",))
def q_record_feedback(spark, d):
    """SNK-07: streamed feedback appended (valid rows) to the feedback table."""
    raw = msg.to_message(fx.feedback_stream_rows(spark, d).drop("event_id"))
    return _run_stream_to_table(spark, raw, lambda s: msg.feedback_rows(s)[0], "feedback_stream", "feedback")[0]


def _broken_feedback(spark, d):
    """Feedback messages of which every 97th is cut short and every 89th lacks its listing."""
    e = fx.feedback_stream_rows(spark, d)
    rows = e.withColumn("property_id", F.when(F.col("event_id") % 89 != 0, F.col("property_id")))
    out = rows.select("event_id", F.to_json(F.struct("request_id", "property_id", "action", "ts"), msg.JSON_OPTIONS).alias("value"))
    return out.select(F.when(F.col("event_id") % 97 == 0, F.lit("not json")).otherwise(F.col("value")).alias("value"))


@query("quarantined_messages", """
SELECT reason, count(*) AS n_messages FROM (
  SELECT CASE WHEN event_id % 97 = 0 THEN 'unparsable' WHEN event_id % 89 = 0 THEN 'missing field'
              WHEN action NOT IN ('click', 'favorite', 'inquiry') THEN 'unknown action' END AS reason
  FROM feedback_stream) WHERE reason IS NOT NULL GROUP BY reason""", ("feedback_stream",))
def q_quarantine(spark, d):
    """SNK-07: what a feedback stream rejects is kept, by reason."""
    _, bad = _run_stream_to_table(spark, _broken_feedback(spark, d), lambda s: msg.feedback_rows(s)[0], "feedback_rejects", "feedback")
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_messages"))


@query("alerts_stream", f"""
SELECT feature_name, 'jensen_shannon' AS drift_metric, js AS score, threshold FROM ({DRIFT_SQL})""",
       ("feature_mart", "ranking_log"))
def q_alerts(spark, d):
    """STR-03: drift alert messages -> alert rows (payload kept)."""
    drift = q_drift(spark, d)
    alerts = drift.select(ts_lit(fx.AS_OF).alias("alert_time"), F.lit("ranker").alias("model_resource_name"),
                          F.lit("jensen_shannon").alias("drift_metric"), "feature_name",
                          F.col("js").alias("score"), "threshold")
    rows = msg.alert_rows(msg.to_message(alerts))
    return rows.select("feature_name", "drift_metric", "score", "threshold")


def trigger_messages(spark, d):
    """Trigger messages derived from events (fixture rule), base64-encoded JSON."""
    from lodestar.sources.tables import read
    e = read(spark, d, "events")
    et, v, u = F.col("event_type"), F.col("value"), F.col("user_id")
    src = (F.when(et == "signup", " Manual ").when(et == "error", "bogus").when(et == "click", "EventArc")
           .when(et == "view", F.lit(None)).otherwise(""))
    reasons = (F.when(v > 250, F.array(F.lit("feature_drift:rent"), F.lit("volume")))
               .when(v > 100, F.array(F.lit("volume_low"))))
    params = (F.when(u % 5 == 0, F.create_map(F.lit("enable_tuning"), F.lit("false")))
              .when(u % 3 == 0, F.create_map(F.lit("learning_rate"), F.lit("0.1")))
              .otherwise(F.create_map().cast("map<string,string>")))
    body = F.to_json(F.struct(src.alias("source"), reasons.alias("reasons"), params.alias("parameters")))
    return e.select("event_id", F.base64(F.encode(body, "UTF-8")).alias("data"))


@query("trigger_events", """
SELECT event_id, source, CASE WHEN user_id % 5 = 0 THEN FALSE ELSE source = 'monitoring' END AS enable_tuning,
       CASE WHEN user_id % 5 <> 0 AND user_id % 3 = 0 THEN '0.1' ELSE '0.05' END AS learning_rate,
       CAST(CASE WHEN value > 250 THEN 2 WHEN value > 100 THEN 1 ELSE 0 END AS INTEGER) AS n_reasons
FROM (SELECT *, CASE WHEN event_type = 'signup' THEN 'manual' WHEN event_type = 'click' THEN 'eventarc'
                     WHEN value > 250 THEN 'monitoring' ELSE 'scheduler' END AS source FROM events)""")
def q_trigger(spark, d):
    """STR-04: base64 JSON -> source resolution, tuning flag, parameter overlay."""
    t = msg.trigger_events(trigger_messages(spark, d))
    return t.select("event_id", "source", "enable_tuning", F.col("parameters")["learning_rate"].alias("learning_rate"),
                    F.size("retrain_reasons").alias("n_reasons"))


def _er_sql(unit: str) -> str:
    return f"""
SELECT date_trunc('{unit}', ts) AS window_start, count(*) AS n_requests, count_if(severity IN ('ERROR', 'CRITICAL')) AS n_errors,
       round(count_if(severity IN ('ERROR', 'CRITICAL')) / count(*), 6) AS error_rate
FROM access_log GROUP BY 1"""


def _p95_sql(unit: str) -> str:
    return f"""
SELECT date_trunc('{unit}', ts) AS window_start, round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms,
       count(*) AS n_requests
FROM access_log GROUP BY 1"""


def _sustained_sql(inner: str, breach: str, unit: str, run: int) -> str:
    joins = "\n".join(f"JOIN b b{i} ON b{i}.window_start = b0.window_start - INTERVAL {i} {unit.upper()}" for i in range(1, run))
    return f"""
WITH w AS ({inner}), b AS (SELECT window_start FROM w WHERE {breach})
SELECT b0.window_start FROM b b0
{joins}"""


@query("error_rate_1m", _er_sql("minute"), ("access_log",))
def q_error_rate(spark, d):
    """STR-05: per-minute error rate."""
    return so.error_rate(fx.access_log(spark, d)).withColumn("error_rate", F.round("error_rate", 6))


@query("error_rate_alerts", _sustained_sql(_er_sql("minute"), "n_errors > 0", "minute", 10), ("access_log",))
def q_error_alerts(spark, d):
    """STR-05 second stage: rate > 0 in 10 consecutive minutes."""
    return so.error_alerts(fx.access_log(spark, d), "1 minute", 60)


@query("error_rate_alerts_hourly", _sustained_sql(_er_sql("hour"), "n_errors > 0", "hour", HOUR_RUN), ("access_log",))
def q_error_alerts_hourly(spark, d):
    """STR-05 with hours and runs of three."""
    return so.error_alerts(fx.access_log(spark, d), "1 hour", 3600, HOUR_RUN)


@query("latency_p95_1m", _p95_sql("minute"), ("access_log",))
def q_p95(spark, d):
    """STR-06: per-minute p95 latency (exact in batch)."""
    return so.latency_p95(fx.access_log(spark, d)).withColumn("p95_latency_ms", F.round("p95_latency_ms", 6))


@query("latency_alerts", _sustained_sql(_p95_sql("minute"), "p95_latency_ms > 500", "minute", 10), ("access_log",))
def q_latency_alerts(spark, d):
    """STR-06 second stage: p95 above 500 ms in 10 consecutive minutes."""
    return so.latency_alerts(fx.access_log(spark, d), "1 minute", 60)


@query("latency_alerts_hourly", _sustained_sql(_p95_sql("hour"), "p95_latency_ms > 500", "hour", HOUR_RUN), ("access_log",))
def q_latency_alerts_hourly(spark, d):
    return so.latency_alerts(fx.access_log(spark, d), "1 hour", 3600, HOUR_RUN)


DEDUP_SQL = """
WITH RECURSIVE ev AS (SELECT CAST(substr(request_id, 2) AS BIGINT) AS event_id, fingerprint, epoch_us(ts) / 1e6 AS s
                      FROM access_log),
nxt AS (SELECT a.event_id,
               (SELECT b.event_id FROM ev b WHERE b.fingerprint = a.fingerprint AND b.s >= a.s + 120
                ORDER BY b.s, b.event_id LIMIT 1) AS next_id
        FROM ev a),
heads AS (SELECT arg_min(event_id, s * 1e7 + event_id) AS id FROM ev GROUP BY fingerprint),
chain(id) AS (SELECT id FROM heads
              UNION ALL SELECT n.next_id FROM chain c JOIN nxt n ON n.event_id = c.id WHERE n.next_id IS NOT NULL)
SELECT e.event_id, e.fingerprint, e.event_id IN (SELECT id FROM chain) AS is_miss FROM ev e"""


@query("request_dedup_ttl", DEDUP_SQL, ("access_log",))
def q_dedup(spark, d):
    """STR-07: TTL cache misses per request fingerprint (1-day ttl); the oracle follows the chain
    recursively, the Spark form by pointer doubling."""
    log = fx.access_log(spark, d).withColumn("event_id", F.substring("request_id", 2, 20).cast("bigint"))
    return so.dedup_ttl(log, "fingerprint", "ts", CACHE_TTL_SECONDS).select("event_id", "fingerprint", "is_miss")


@query("feedback_attribution", """
SELECT r.request_id, r.property_id, r.ts AS r_ts, r.final_rank, f.action, f.ts AS f_ts
FROM ranking_log r LEFT JOIN feedback_events f
  ON f.request_id = r.request_id AND f.property_id = r.property_id AND f.ts >= r.ts AND f.ts <= r.ts + INTERVAL 1 DAY""",
       ("ranking_log", "feedback_events"))
def q_attribution(spark, d):
    """STR-08 / JOIN-14: interval left join of feedback onto logged candidates (batch twin)."""
    return so.feedback_attribution(fx.ranking_log(spark, d), fx.feedback_events(spark, d))


BEHAVIOUR_SQL = """
SELECT window_start, window_start + INTERVAL 28 DAY AS window_end, property_id,
       count_if(action = 'impression') AS impression_count, count_if(action = 'click') AS click_count, count_if(action = 'favorite') AS favorite_count,
       count_if(action = 'inquiry') AS inquiry_count
FROM (SELECT property_id, action, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS window_start
      FROM (SELECT property_id, action, ts FROM feedback_events
            UNION ALL SELECT unnest(result_property_ids), 'impression', ts FROM search_logs) CROSS JOIN range(0, 28) t(k))
GROUP BY window_start, property_id"""


@query("behaviour_window_stream", BEHAVIOUR_SQL, ("feedback_events", "search_logs"))
def q_behaviour_window(spark, d):
    """STR-09: 28-day windows sliding daily, per listing."""
    shown = so.shown_listings(fx.search_logs(spark, d))
    return so.behaviour_window(fx.feedback_events(spark, d).select("property_id", "action", "ts").unionByName(shown))


@query("retrain_trigger_stream", f"SELECT 'scheduler' AS source, reasons FROM ({RETRAIN_SQL}) WHERE should_retrain",
       ("training_runs", "feedback_events"))
def q_retrain_trigger(spark, d):
    """STR-10: retrain decision -> trigger message rows."""
    return _retrain_messages(spark, d, fx.AS_OF)


#: The fixtures' last run finishes on the first of August, so a retrain is due a month later.
OVERDUE = "2001-09-01 12:00:00"


@query("retrain_trigger_overdue", f"SELECT 'scheduler' AS source, reasons FROM ({RETRAIN_SQL.replace(A, f"TIMESTAMP '{OVERDUE}'")}) WHERE should_retrain",
       ("training_runs", "feedback_events"))
def q_retrain_overdue(spark, d):
    """STR-10 at an instant when a retrain is due: one message with its reasons."""
    return _retrain_messages(spark, d, OVERDUE)


def _retrain_messages(spark, d, as_of):
    from lodestar.operators.monitoring import retrain_decision
    dec = retrain_decision(fx.training_runs(spark, d), fx.feedback_events(spark, d), as_of)
    m = so.retrain_trigger_messages(dec)
    parsed = F.from_json("message", "source string, reasons array<string>")
    return m.select(parsed["source"].alias("source"), F.array_join(parsed["reasons"], ";").alias("reasons"))


def _replay(spark, df, fn, name, flush=()):
    """Run ``fn`` over ``df`` as an append stream with a watermark of ten minutes, and read its table.

    ``flush``: later rows (far in the future) that move the watermark past every real row.
    """
    from lodestar.session import conf_override, stream_state_partitions
    base = _sink_dir(spark, name)
    df.write.mode("errorifexists").parquet(f"{base}/in/part=0")
    stream = so.event_time(spark.readStream.schema(df.schema).parquet(f"{base}/in/*")).withWatermark("ts", "10 minutes")
    with conf_override(spark, stream_state_partitions(spark)):
        q = fn(stream).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt").outputMode("append").start()
    q.processAllAvailable()
    for i, row in enumerate(flush, 1):
        row.write.parquet(f"{base}/in/part={i}")
        q.processAllAvailable()
    q.stop()
    return spark.read.parquet(f"{base}/out")


def _log_and_flush(spark, d):
    log = fx.access_log(spark, d).select("request_id", "ts", "severity", "latency_ms", "fingerprint")
    late = [spark.createDataFrame([("FLUSH", "INFO", 0.0, "flush")], "request_id string, severity string, latency_ms double, fingerprint string")
            .select("request_id", F.lit(f"2{i}00-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), "severity", "latency_ms", "fingerprint") for i in (1, 2)]
    return log, late


@query("error_rate_stream", _er_sql("minute"), ("access_log",))
def q_error_rate_stream(spark, d):
    """STR-05 as a stream: per-minute error rate, each window emitted once the watermark has passed it."""
    log, late = _log_and_flush(spark, d)
    out = _replay(spark, log, so.error_rate, "error_rate_stream", late)
    return out.filter(F.year("window_start") < 2100).withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"), "error_rate": F.round("error_rate", 6)})


@query("latency_p95_stream", _p95_sql("minute"), ("access_log",))
def q_p95_stream(spark, d):
    """STR-06 as a stream: per-minute p95 latency."""
    log, late = _log_and_flush(spark, d)
    out = _replay(spark, log, so.latency_p95, "latency_p95_stream", late)
    return out.filter(F.year("window_start") < 2100).withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"), "p95_latency_ms": F.round("p95_latency_ms", 6)})


def _incidents_sql(inner: str, breach: str, unit: str, run: int) -> str:
    return f"""
WITH w AS ({inner}), b AS (SELECT window_start FROM w WHERE {breach}),
g AS (SELECT window_start, window_start - to_{unit}s(CAST(row_number() OVER (ORDER BY window_start) AS INTEGER)) AS run FROM b)
SELECT min(window_start) + INTERVAL {run - 1} {unit.upper()} AS opened_at, max(window_start) AS last_window, count(*) AS n_windows
FROM g GROUP BY run HAVING count(*) >= {run}"""


def _hourly(kind):
    """Windows of an hour and their breach, for a batch or a stream."""
    if kind == "error":
        return lambda log: so.error_windows(log, "1 hour"), F.col("n_errors") > 0
    return lambda log: so.latency_windows(log, "1 hour"), F.col("p95_latency_ms") > LATENCY_P95_ALERT_MS


def _plain_times(df):
    """Rows before the flush, with their times as the driver's tables have them."""
    first = df.columns[0]
    return df.filter(F.year(first) < 2100).withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


def _alert_stream(spark, d, kind, stage, name):
    windows, breach = _hourly(kind)
    log, late = _log_and_flush(spark, d)
    return _plain_times(_replay(spark, log, lambda s: stage(windows(s), breach, 3600, HOUR_RUN), name, late))


@query("error_rate_alerts_stream", _sustained_sql(_er_sql("hour"), "n_errors > 0", "hour", HOUR_RUN), ("access_log",))
def q_error_alerts_stream(spark, d):
    """STR-05 with its second stage in the stream: chained window aggregates on one watermark."""
    return _alert_stream(spark, d, "error", so.sustained_windows, "error_alerts_stream")


@query("latency_alerts_stream", _sustained_sql(_p95_sql("hour"), "p95_latency_ms > 500", "hour", HOUR_RUN), ("access_log",))
def q_latency_alerts_stream(spark, d):
    """STR-06 with its second stage in the stream."""
    return _alert_stream(spark, d, "latency", so.sustained_windows, "latency_alerts_stream")


@query("error_rate_incidents", _incidents_sql(_er_sql("hour"), "n_errors > 0", "hour", HOUR_RUN), ("access_log",))
def q_error_incidents(spark, d):
    """STR-05 incidents: one row per run of breaching hours, from opening to close."""
    windows, breach = _hourly("error")
    return _plain_times(so.alert_incidents(windows(fx.access_log(spark, d)), breach, 3600, HOUR_RUN))


@query("error_rate_incidents_stream", _incidents_sql(_er_sql("hour"), "n_errors > 0", "hour", HOUR_RUN), ("access_log",))
def q_error_incidents_stream(spark, d):
    """STR-05 incidents as a stream: a session per run, closed by the watermark."""
    return _alert_stream(spark, d, "error", so.alert_incidents, "error_incidents_stream")


@query("latency_incidents_stream", _incidents_sql(_p95_sql("hour"), "p95_latency_ms > 500", "hour", HOUR_RUN), ("access_log",))
def q_latency_incidents_stream(spark, d):
    """STR-06 incidents as a stream."""
    return _alert_stream(spark, d, "latency", so.alert_incidents, "latency_incidents_stream")


@query("behaviour_window_live", BEHAVIOUR_SQL, ("feedback_events", "search_logs"))
def q_behaviour_live(spark, d):
    """STR-09 as a stream: daily counts, then 28-day windows over them, each emitted once the watermark has passed it."""
    shown = so.shown_listings(fx.search_logs(spark, d))
    events = fx.feedback_events(spark, d).select("property_id", "action", "ts").unionByName(shown)
    late = [spark.range(1).select(F.lit("FLUSH").alias("property_id"), F.lit("flush").alias("action"),
                                  F.lit(f"2{i}00-01-01 00:00:00").cast("timestamp_ntz").alias("ts")) for i in (1, 2)]
    out = _replay(spark, events, so.behaviour_window, "behaviour_live", late)
    return out.filter(F.col("property_id") != "FLUSH").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("request_dedup_stream", DEDUP_SQL, ("access_log",))
def q_dedup_stream(spark, d):
    """STR-07 as a stream: state per request fingerprint that expires with the ttl."""
    log, late = _log_and_flush(spark, d)
    out = _replay(spark, log, lambda s: so.dedup_ttl_stream(s.withColumn("event_id", F.substring("request_id", 2, 20).try_cast("bigint")), "fingerprint", "ts", CACHE_TTL_SECONDS, expire=True),
                  "dedup_stream", late[:1])
    return out.filter(F.col("event_id").isNotNull()).select("event_id", F.col("key").alias("fingerprint"), "is_miss")


#: Rows of all logs for each core that a stretch of a replay holds, as far as its months allow.
REPLAY_ROWS = 250_000


def _by_time(spark, logs, base, rows_per_core=None):
    """Let ``logs`` (with ``ts``) arrive under ``base``/<name>/part=<i> in the order of time, a stretch for each step.

    They are laid down by month once; a stretch is as many whole months as make
    ``rows_per_core`` rows for each core. Small logs are one stretch.
    """
    month = F.coalesce(F.date_format("ts", "yyyyMM"), F.lit("000000"))
    staged, sizes = {}, {}
    for name, df in logs.items():
        spread = F.pmod(F.xxhash64("request_id"), F.lit(4))  # a month is four tasks' work, not one's
        df.withColumn("_month", month).repartition("_month", spread).write.mode("errorifexists").partitionBy("_month").parquet(f"{base}/staged/{name}")
        staged[name] = spark.read.schema(df.withColumn("_month", month).schema).parquet(f"{base}/staged/{name}")
        for r in staged[name].groupBy("_month").count().collect():  # a row a month
            sizes[r["_month"]] = sizes.get(r["_month"], 0) + r["count"]
    most = (rows_per_core or REPLAY_ROWS) * spark.sparkContext.defaultParallelism
    stretches, held = [[]], 0
    for m in sorted(sizes):
        if held and held + sizes[m] > most:
            stretches.append([])
            held = 0
        stretches[-1].append(m)
        held += sizes[m]
    for i, months in enumerate(stretches):
        for name, df in staged.items():
            df.filter(F.col("_month").isin(months)).drop("_month").write.mode("errorifexists").parquet(f"{base}/{name}/part={i}")
        yield months


@query("feedback_attribution_stream", """
SELECT r.request_id, r.property_id, r.final_rank, f.action
FROM ranking_log r LEFT JOIN feedback_events f
  ON f.request_id = r.request_id AND f.property_id = r.property_id AND f.ts >= r.ts AND f.ts <= r.ts + INTERVAL 1 DAY""",
       ("ranking_log", "feedback_events"))
def q_attribution_stream(spark, d):
    """JOIN-14: the stream-stream form. Both logs are replayed in the order of time as file streams with
    2-day watermarks, so the join holds a stretch and a few days; a final flush record moves the
    watermark so unmatched candidates are emitted."""
    base = _sink_dir(spark, "attribution_stream")
    rl = fx.ranking_log(spark, d).select("request_id", "property_id", "ts", "final_rank")
    fb = fx.feedback_events(spark, d)
    flush = F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    steps = _by_time(spark, {"rl": rl, "fb": fb}, base)
    next(steps)
    rs = so.event_time(spark.readStream.schema(rl.schema).parquet(f"{base}/rl/*")).withWatermark("ts", "2 days")
    fs = so.event_time(spark.readStream.schema(fb.schema).parquet(f"{base}/fb/*")).withWatermark("ts", "2 days")
    out = so.feedback_attribution(rs, fs).select("request_id", "property_id", "final_rank", "action")
    from lodestar.session import conf_override, stream_state_partitions
    with conf_override(spark, stream_state_partitions(spark)):
        q = (out.writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/ckpt").outputMode("append").start())
    q.processAllAvailable()
    for _ in steps:  # the next stretch of time arrives when the last one is through
        q.processAllAvailable()
    # flush records in a later micro-batch advance both watermarks past every real row
    spark.range(1).select(F.lit("FLUSH").alias("request_id"), F.lit("FLUSH").alias("property_id"),
                          flush.alias("ts"), F.lit(0).cast("bigint").alias("final_rank")) \
        .write.parquet(f"{base}/rl/part=flush1")
    spark.range(1).select(F.lit("FLUSH").alias("request_id"), F.lit("FLUSH").alias("property_id"),
                          F.lit("flush").alias("action"), flush.alias("ts")).write.parquet(f"{base}/fb/part=flush1")
    q.processAllAvailable()
    spark.range(1).select(F.lit("FLUSH2").alias("request_id"), F.lit("FLUSH2").alias("property_id"),
                          (flush + F.expr("INTERVAL 30 DAYS")).alias("ts"), F.lit(0).cast("bigint").alias("final_rank")) \
        .write.parquet(f"{base}/rl/part=flush2")
    q.processAllAvailable()
    q.stop()
    return spark.read.parquet(f"{base}/out").filter(~F.col("request_id").startswith("FLUSH"))
