"""Streaming operators against their batch twins and against brute force."""

import os

import pytest
from pyspark.sql import functions as F

from lodestar.sources import fixtures as fx
from lodestar.streaming import messages as msg
from lodestar.streaming import operators as so
from tests.conftest import SF_SMALL


def _write_parts(df, path, n=4):
    """Write rows as several JSON files so a stream sees several micro-batches."""
    df.repartition(n).write.mode("errorifexists").json(path)


def _brute_dedup(rows, ttl):
    last = {}
    out = {}
    for eid, key, s in sorted(rows, key=lambda r: (r[2], r[0])):
        miss = key not in last or s >= last[key] + ttl
        if miss:
            last[key] = s
        out[eid] = miss
    return out


def test_dedup_batch_matches_loop(spark):
    log = fx.access_log(spark, SF_SMALL).withColumn(
        "event_id", F.substring("request_id", 2, 20).cast("bigint"))
    got = {r["event_id"]: r["is_miss"] for r in so.dedup_ttl(log, "fingerprint", "ts", 86400).collect()}
    rows = [(r["event_id"], r["fingerprint"], r["s"]) for r in
            log.select("event_id", "fingerprint", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("s"))
            .collect()]
    assert got == _brute_dedup(rows, 86400)


def test_dedup_stream_state_matches_loop(spark, tmp_dir):
    log = fx.access_log(spark, SF_SMALL).withColumn(
        "event_id", F.substring("request_id", 2, 20).cast("bigint")).select("event_id", "fingerprint", "ts")
    # files ordered by time so each micro-batch is later than the previous one
    days = [r[0] for r in log.select(F.to_date("ts")).distinct().orderBy(1).collect()]
    src = os.path.join(tmp_dir, "in")
    for i, d in enumerate(days):
        log.filter(F.to_date("ts") == d).write.mode("errorifexists").parquet(f"{src}/part={i:03d}")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 3).parquet(f"{src}/*")
    out = so.dedup_ttl_stream(stream, "fingerprint", "ts", 86400)
    q = out.writeStream.format("memory").queryName("dedup_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r["event_id"]: r["is_miss"] for r in spark.table("dedup_out").collect()}
    rows = [(r["event_id"], r["fingerprint"], r["s"]) for r in
            log.select("event_id", "fingerprint", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("s"))
            .collect()]
    assert got == _brute_dedup(rows, 86400)


def test_stream_stream_attribution_matches_batch(spark, tmp_dir):
    rl = fx.ranking_log(spark, SF_SMALL).select("request_id", "property_id", "ts", "final_rank")
    fb = fx.feedback_events(spark, SF_SMALL)
    flush_ts = "2002-01-01 00:00:00"
    rl_f = rl.unionByName(spark.createDataFrame([("FLUSH", "FLUSH", None, 0)], rl.schema)
                          .withColumn("ts", F.lit(flush_ts).cast("timestamp_ntz")))
    fb_f = fb.unionByName(spark.createDataFrame([("FLUSH", "FLUSH", "flush", None)], fb.schema)
                          .withColumn("ts", F.lit(flush_ts).cast("timestamp_ntz")))
    _write_parts(rl_f, f"{tmp_dir}/rl")
    _write_parts(fb_f, f"{tmp_dir}/fb")
    rs = so.event_time(spark.readStream.schema(rl.schema).json(f"{tmp_dir}/rl")).withWatermark("ts", "2 days")
    fs = so.event_time(spark.readStream.schema(fb.schema).json(f"{tmp_dir}/fb")).withWatermark("ts", "2 days")
    out = so.feedback_attribution(rs, fs)
    q = out.writeStream.format("memory").queryName("attr_out").outputMode("append").start()
    q.processAllAvailable()
    # a second flush batch moves the watermark past every real row
    _write_parts(rl_f.filter(F.col("request_id") == "FLUSH").withColumn("ts", F.lit("2003-01-01 00:00:00")
                                                                        .cast("timestamp_ntz")), f"{tmp_dir}/rl/x", 1)
    q.processAllAvailable()
    q.stop()
    got = spark.table("attr_out").filter(F.col("request_id") != "FLUSH")
    want = so.feedback_attribution(so.event_time(rl), so.event_time(fb))
    key = ["request_id", "property_id", "action"]
    assert got.count() == want.count()
    assert got.select(*key).exceptAll(want.select(*key)).count() == 0


def test_windowed_error_rate_stream_matches_batch(spark, tmp_dir):
    log = fx.access_log(spark, SF_SMALL).select("ts", "severity", "latency_ms")
    flush = spark.createDataFrame([("INFO", 1.0)], "severity string, latency_ms double") \
        .withColumn("ts", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")).select(*log.columns)
    _write_parts(log.unionByName(flush), f"{tmp_dir}/log")
    s = so.event_time(spark.readStream.schema(log.schema).json(f"{tmp_dir}/log")).withWatermark("ts", "1 hour")
    q = so.error_rate(s, "1 hour").writeStream.format("memory").queryName("err_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("err_out").filter(F.col("window_start") < F.lit("2024-03-01").cast("timestamp"))
    want = so.error_rate(so.event_time(log), "1 hour")
    assert got.count() == want.count()
    assert got.select("window_start", "n_requests", "n_errors").exceptAll(
        want.select("window_start", "n_requests", "n_errors")).count() == 0


def test_parse_drops_unknown_and_quarantines(spark):
    raw = spark.createDataFrame([('{"request_id":"r","property_id":"p","action":"click","ts":"2024-01-01T00:00:00.000000","x":1}',),
                                 ("not json",)], "value string")
    ok, bad = msg.parse(raw, msg.FEEDBACK_T)
    assert ok.columns == ["request_id", "property_id", "action", "ts"] and ok.count() == 1
    assert bad.count() == 1


def test_dedup_hot_key_never_quiet_matches_loop(spark):
    """One key with gaps always below the ttl (no natural reset point), plus a cold key."""
    import random
    rnd = random.Random(5)
    rows, t = [], 0.0
    for i in range(3000):
        t += rnd.uniform(0, 40)          # ttl 300 s, gaps < 40 s: the key never goes quiet
        rows.append((i, "hot", t))
    for i in range(3000, 3050):
        rows.append((i, "cold", rnd.uniform(0, 60000)))
    df = spark.createDataFrame(rows, "event_id long, k string, s double") \
        .withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    got = {r["event_id"]: r["is_miss"] for r in so.dedup_ttl(df.repartition(7), "k", "ts", 300).collect()}
    want = _brute_dedup([(r[0], r[1], r[2]) for r in
                         df.select("event_id", "k", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)).collect()],
                        300)
    assert got == want and sum(want.values()) > 100


def _slow_runs(breaching, width, run):
    """Alert windows and incidents of breaching window starts (seconds), by a loop."""
    alerts, incidents, chain = [], [], []
    for s in sorted(breaching) + [None]:
        if chain and s != chain[-1] + width:
            if len(chain) >= run:
                incidents.append((chain[run - 1], chain[-1], len(chain)))
            chain = []
        if s is not None:
            chain.append(s)
            if len(chain) >= run:
                alerts.append(s)
    return alerts, incidents


def test_sustained_streams_over_many_batches(spark, tmp_dir):
    """Ten files, one a micro-batch, with rows that come late but within the watermark; runs cross the files."""
    import random
    rnd, rows = random.Random(11), []
    for minute in range(600):
        bad = rnd.random() < 0.85
        rows += [(minute * 60 + rnd.randrange(60), "ERROR" if bad and i == 0 else "INFO", 1.0) for i in range(3)]
    batches = [[] for _ in range(10)]
    for s, severity, ms in rows:
        late = 1 if rnd.random() < 0.1 and s % 3600 > 2700 else 0  # up to 15 minutes before the next file's first row
        batches[min(9, s // 3600 + late)].append((s, severity, ms))
    batches += [[(10 ** 8, "INFO", 1.0)], [(2 * 10 ** 8, "INFO", 1.0)]]
    for i, part in enumerate(batches):
        (spark.createDataFrame(part, "s long, severity string, latency_ms double").select(F.timestamp_seconds("s").alias("ts"), "severity", "latency_ms")
         .coalesce(1).write.parquet(f"{tmp_dir}/in/part={i:02d}"))
    breaching = sorted({s // 60 * 60 for s, severity, _ in rows if severity == "ERROR"})
    alerts, incidents = _slow_runs(breaching, 60, 10)
    assert len(alerts) > 20 and len(incidents) > 3
    for name, stage, want in (("alerts_many", so.sustained_windows, [(a,) for a in alerts]), ("incidents_many", so.alert_incidents, incidents)):
        stream = spark.readStream.schema("ts timestamp, severity string, latency_ms double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in/*")
        out = stage(so.error_windows(stream.withWatermark("ts", "90 minutes")), F.col("n_errors") > 0, 60)
        q = out.writeStream.format("memory").queryName(name).outputMode("append").start()
        q.processAllAvailable()
        q.stop()
        got = spark.table(name).select(*[F.unix_seconds(c).alias(c) if t == "timestamp" else F.col(c) for c, t in out.dtypes]).collect()
        assert sorted(tuple(r) for r in got) == sorted(want)
        batch = stage(so.error_windows(spark.read.parquet(f"{tmp_dir}/in")), F.col("n_errors") > 0, 60)
        assert batch.count() == len(want)


def test_rolling_window_spreads_after_its_last_shuffle(spark):
    """The 28-fold rows are summed where they are made: two exchanges, both of daily counts or events."""
    d = spark.createDataFrame([("a", "click", 86400), ("a", "impression", 90000), ("b", "inquiry", 86400 * 3)], "property_id string, action string, s long")
    out = so.behaviour_window(d.select("property_id", "action", F.timestamp_seconds("s").alias("ts")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Generate explode" in plan.split("Exchange hashpartitioning")[0]
    assert out.count() == 56 and out.agg(F.sum("click_count"), F.sum("impression_count"), F.sum("inquiry_count")).first() == (28, 28, 28)


def test_rolling_stream_over_many_batches(spark, tmp_dir):
    """A file a micro-batch, late rows within the watermark, quiet months, unknown actions: the batch's rows, each once.

    A listing has one state, however many windows hold its events, and old slides leave it."""
    import random
    rnd, rows = random.Random(4), []
    actions = ["impression", "click", "favorite", "inquiry", "view"]
    for day in [*range(0, 60), *range(150, 170)]:
        rows += [(f"P{rnd.randrange(6)}", rnd.choice(actions), day * 86400 + rnd.randrange(86400)) for _ in range(4)]
    files = [[] for _ in range(17)]
    for r in rows:
        files[min(16, r[2] // 864000 + (1 if rnd.random() < 0.2 and r[2] % 864000 > 700000 else 0))].append(r)
    files = [f for f in files if f] + [[("FLUSH", "view", 10 ** 9)], [("FLUSH", "view", 2 * 10 ** 9)]]
    for i, part in enumerate(files):
        (spark.createDataFrame(part, "property_id string, action string, s long").select("property_id", "action", F.timestamp_seconds("s").alias("ts"))
         .coalesce(1).write.parquet(f"{tmp_dir}/in/part={i:02d}"))
    stream = spark.readStream.schema("property_id string, action string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in/*")
    out = so.behaviour_window(stream.withWatermark("ts", "4 days"))
    q = out.writeStream.format("memory").queryName("rolling_many").outputMode("append").start()
    q.processAllAvailable()
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress]
    q.stop()
    got = spark.table("rolling_many").filter("property_id <> 'FLUSH'")
    want = so.behaviour_window(spark.read.parquet(f"{tmp_dir}/in").filter("property_id <> 'FLUSH'").select("property_id", "action", "ts"))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.count() == want.count() > 400 and got.exceptAll(want).count() == 0
    assert max(held) <= 7 and held[-1] <= 1


@pytest.mark.parametrize("buckets", [1, 3])
def test_rolling_stream_keeps_many_listings_in_few_states(spark, tmp_dir, monkeypatch, buckets):
    """The rows of the batch, with fewer states than listings: new, quiet, returning and null listings share one."""
    import random
    monkeypatch.setattr(so, "ROLLING_BUCKETS", buckets, raising=False)
    rnd, files = random.Random(7), []
    for part in range(6):
        days = range(14 * part, 14 * part + 14)
        ids = [*(f"P{k}" for k in range(5 * (part % 4), 5 * (part % 4) + 9)), None]
        files.append([(rnd.choice(ids), rnd.choice(["impression", "click", "inquiry", "view"]), d * 86400 + rnd.randrange(86400)) for d in days for _ in range(5)])
    files += [[("FLUSH", "view", 10 ** 9)], [("FLUSH", "view", 2 * 10 ** 9)]]
    for i, part in enumerate(files):
        (spark.createDataFrame(part, "property_id string, action string, s long").select("property_id", "action", F.timestamp_seconds("s").alias("ts"))
         .coalesce(1).write.parquet(f"{tmp_dir}/in/part={i:02d}"))
    stream = spark.readStream.schema("property_id string, action string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in/*")
    name = f"rolling_few_{buckets}"
    q = so.behaviour_window(stream.withWatermark("ts", "10 minutes")).writeStream.format("memory").queryName(name).outputMode("append").start()
    q.processAllAvailable()
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress]
    q.stop()
    real = "property_id IS DISTINCT FROM 'FLUSH'"
    got, want = spark.table(name).filter(real), so.behaviour_window(spark.read.parquet(f"{tmp_dir}/in").filter(real).select("property_id", "action", "ts"))
    assert got.count() == want.count() > 800 and got.exceptAll(want).count() == 0
    assert max(held) <= buckets


def test_attribution_replay_arrives_in_stretches_of_time(spark, tmp_dir, monkeypatch):
    """Many stretches give the rows of the batch join, and each holds a bounded number of rows, later than the one before."""
    from lodestar.plans import q_streaming as q
    base = os.path.join(tmp_dir, "replay")
    monkeypatch.setattr(q, "_sink_dir", lambda spark, name: base)
    total = fx.ranking_log(spark, SF_SMALL).count() + fx.feedback_events(spark, SF_SMALL).count()
    monkeypatch.setattr(q, "REPLAY_ROWS", total // 4 // spark.sparkContext.defaultParallelism)
    got = q.q_attribution_stream(spark, SF_SMALL)
    want = so.feedback_attribution(fx.ranking_log(spark, SF_SMALL), fx.feedback_events(spark, SF_SMALL)).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    parts = sorted(p for p in os.listdir(f"{base}/rl") if "flush" not in p)
    spans = [spark.read.parquet(f"{base}/rl/{p}").agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first() for p in parts]
    assert 4 <= len(spans) <= 8 and all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and max(s[2] for s in spans) < total // 3


def test_messages_are_laid_down_compressed(spark, tmp_dir, monkeypatch):
    from lodestar.plans import q_streaming as q
    base = os.path.join(tmp_dir, "messages")
    monkeypatch.setattr(q, "_sink_dir", lambda spark, name: base)
    rows = q.q_stream_to_table(spark, SF_SMALL)
    assert rows.count() == fx.ranking_log(spark, SF_SMALL).count()
    size = lambda d, end: sum(os.path.getsize(os.path.join(r, f)) for r, _, fs in os.walk(d) for f in fs if f.endswith(end))
    plain = q._rl_messages(spark, SF_SMALL).agg(F.sum(F.length("value") + 1)).first()[0]
    assert 0 < size(f"{base}/in", ".gz") < plain / 5 and size(f"{base}/in", ".txt") == 0
