"""Streaming operators. Each takes and returns DataFrames that may be streaming or batch,
so every stream has a batch twin used for checking (after a flush record moves the watermark).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.vocab import ALERT_SUSTAIN_WINDOWS, ERROR_SEVERITIES, LATENCY_P95_ALERT_MS


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Driver parquet timestamps are TIMESTAMP_NTZ; watermarks need TIMESTAMP (UTC session)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def error_windows(log: DataFrame, width: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Per tumbling window ``w``: requests and lines of severity ERROR or above."""
    return log.groupBy(F.window(ts, width).alias("w")).agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.count_if(F.col("severity").isin(*ERROR_SEVERITIES)).alias("n_errors"))


def error_rate(log: DataFrame, width: str = "1 minute", ts: str = "ts") -> DataFrame:
    """STR-05: per tumbling window: requests, lines of severity ERROR or above, and their rate."""
    return error_windows(log, width, ts).select(F.col("w.start").alias("window_start"), "n_requests", "n_errors",
                                                (F.col("n_errors") / F.col("n_requests")).alias("error_rate"))


def latency_p95(log: DataFrame, width: str = "1 minute", ts: str = "ts", exact: bool = True) -> DataFrame:
    """STR-06: per-window p95 latency (exact percentile in batch, approximate in streams)."""
    return latency_windows(log, width, ts, exact).select(F.col("w.start").alias("window_start"), "p95_latency_ms", "n_requests")


def latency_windows(log: DataFrame, width: str = "1 minute", ts: str = "ts", exact: bool = True) -> DataFrame:
    """Per tumbling window ``w``: p95 latency and requests."""
    p = F.percentile("latency_ms", 0.95) if exact else F.percentile_approx("latency_ms", 0.95, 10000)
    return log.groupBy(F.window(ts, width).alias("w")).agg(p.alias("p95_latency_ms"), F.count(F.lit(1)).alias("n_requests"))


def sustained(windows: DataFrame, breach: Column, width_seconds: int,
              run_length: int = ALERT_SUSTAIN_WINDOWS) -> DataFrame:
    """Alert windows: this window and the ``run_length - 1`` before it all breach.

    Each breaching window votes for itself and the next run_length-1 window
    starts; a start with run_length votes closes a full run. One grouped
    aggregate over window starts, no ordering over the whole series.
    """
    b = windows.filter(breach).select("window_start")
    votes = b.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(run_length - 1)),
                                           lambda k: F.col("window_start") + F.make_interval(
                                               secs=(k * width_seconds).cast("decimal(18,6)"))))
                     .alias("window_start"))
    return (votes.groupBy("window_start").agg(F.count(F.lit(1)).alias("votes"))
            .filter(F.col("votes") == run_length).select("window_start"))


def error_alerts(log: DataFrame, width: str, width_seconds: int,
                 run_length: int = ALERT_SUSTAIN_WINDOWS) -> DataFrame:
    """Error-rate alert (rate > 0 sustained ``run_length`` windows)."""
    return sustained(error_rate(log, width), F.col("error_rate") > 0, width_seconds, run_length)


def latency_alerts(log: DataFrame, width: str, width_seconds: int,
                   run_length: int = ALERT_SUSTAIN_WINDOWS,
                   threshold_ms: float = LATENCY_P95_ALERT_MS) -> DataFrame:
    return sustained(latency_p95(log, width), F.col("p95_latency_ms") > threshold_ms, width_seconds, run_length)


def sustained_windows(windows: DataFrame, breach: Column, width_seconds: int,
                      run_length: int = ALERT_SUSTAIN_WINDOWS) -> DataFrame:
    """The alerts of ``sustained`` for a batch or a stream: ``windows`` carry their window as ``w``.

    A second aggregate over sliding windows of ``run_length`` widths: one that holds
    ``run_length`` breaching windows is a full run. On a stream its event time and
    watermark are those of the first aggregate, so an alert appears as soon as no
    row of its last window can come any more, and its state is then dropped.
    """
    span = F.window(F.window_time("w"), f"{run_length * width_seconds} seconds", f"{width_seconds} seconds")
    runs = windows.filter(breach).groupBy(span.alias("run")).agg(F.count(F.lit(1)).alias("n"))
    last = F.col("run.end") - F.make_dt_interval(secs=F.lit(width_seconds))
    return runs.filter(F.col("n") == run_length).select(last.alias("window_start"))


def alert_incidents(windows: DataFrame, breach: Column, width_seconds: int,
                    run_length: int = ALERT_SUSTAIN_WINDOWS) -> DataFrame:
    """One row per run of at least ``run_length`` breaching windows, batch or stream: when its alert
    opened, its last breaching window, and its length.

    A session per run, over the first aggregate's event time: neighbours are one
    width apart, so a gap of one and a half widths holds a run together and the
    watermark closes it at the first window that doesn't breach.
    """
    # Streams want a key beside the session; the width of the windows is one that is no literal.
    width = (F.unix_seconds(F.col("w.end").cast("timestamp")) - F.unix_seconds(F.col("w.start").cast("timestamp"))).alias("window_seconds")
    session = F.session_window(F.window_time("w"), f"{width_seconds * 3 // 2} seconds").alias("session")
    runs = windows.filter(breach).groupBy(session, width).agg(
        F.min("w.start").alias("first"), F.max("w.start").alias("last_window"), F.count(F.lit(1)).alias("n_windows"))
    opened = F.col("first") + F.make_dt_interval(secs=F.lit(width_seconds * (run_length - 1)))
    return runs.filter(F.col("n_windows") >= run_length).select(opened.alias("opened_at"), "last_window", "n_windows")


def feedback_attribution(ranking: DataFrame, feedback: DataFrame, within: str = "1 day") -> DataFrame:
    """STR-08 / JOIN-14: each logged candidate with the feedback that reached it within ``within``.

    Interval left join on (request_id, property_id); on streams both sides carry
    watermarks and unmatched candidates are emitted once the watermark passes
    ts + within.
    """
    r = ranking.select("request_id", "property_id", F.col("ts").alias("r_ts"), "final_rank")
    f = feedback.select(F.col("request_id").alias("f_request_id"), F.col("property_id").alias("f_property_id"),
                        "action", F.col("ts").alias("f_ts"))
    cond = ((r["request_id"] == f["f_request_id"]) & (r["property_id"] == f["f_property_id"])
            & (f["f_ts"] >= r["r_ts"]) & (f["f_ts"] <= r["r_ts"] + F.expr(f"INTERVAL {within}")))
    return r.join(f, cond, "leftOuter").select("request_id", "property_id", "r_ts", "final_rank", "action", "f_ts")


def shown_listings(search_logs: DataFrame) -> DataFrame:
    """Impressions as events: one row per listing shown in a search."""
    return search_logs.select(F.explode("result_property_ids").alias("property_id"), F.lit("impression").alias("action"), "ts")


def behaviour_window(events: DataFrame, size: str = "28 days", slide: str = "1 day",
                     ts: str = "ts") -> DataFrame:
    """STR-09: rolling impression and action counts per listing, sliding windows; batch or stream.

    Events are counted per listing and slide first. On a stream a bucket of listings'
    counts are one state, see ``_rolling_stream``. In a batch they are dealt out by
    listing and summed along its time as changes; every window with an event is
    then made once, with no row to sort or sum for each event and window.
    In a batch a listing has one row per slide, so a hot one is no hot task.
    ``size`` must be a multiple of ``slide``.
    """
    kinds = {"impression": "impression_count", "click": "click_count", "favorite": "favorite_count", "inquiry": "inquiry_count"}
    if events.isStreaming:
        return _rolling_stream(events, kinds, size, slide, ts)
    daily = events.groupBy(F.window(ts, slide).alias("w"), "property_id").agg(
        *[F.count_if(F.col("action") == a).alias(c) for a, c in kinds.items()])
    step, whole = F.expr(f"INTERVAL {slide}"), F.expr(f"INTERVAL {size}")
    # a day's counts enter at its first window and leave after its last one: two changes, not a row a window
    at, sums = F.col("_at"), [*kinds.values(), "_n"]
    day = daily.select("property_id", F.col("w.start").alias("_day"), *kinds.values(), F.lit(1).cast("bigint").alias("_n"))
    changes = day.select("property_id", F.inline(F.array(
        F.struct((F.col("_day") - whole + step).alias("_at"), *sums),
        F.struct((F.col("_day") + step).alias("_at"), *[(-F.col(c)).alias(c) for c in sums]))))
    by_time = Window.partitionBy("property_id").orderBy("_at")  # at most two rows a listing and slide
    net = changes.repartition("property_id").groupBy("property_id", "_at").agg(*[F.sum(c).alias(c) for c in sums])
    run = net.select("property_id", "_at", F.lead("_at").over(by_time).alias("_until"), *[F.sum(c).over(by_time.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in sums])
    spread = run.filter(F.col("_n") > 0).select(F.explode(F.sequence(at, F.col("_until") - step, step)).alias("window_start"), "property_id", *kinds.values())
    return spread.select("window_start", (F.col("window_start") + whole).alias("window_end"), "property_id", *kinds.values())


#: Listings, the slides of each that have events with their counts (packed, see ``_rolling_stream``), the last window emitted.
ROLLING_STATE = "listings array<string>, slides binary, done bigint"
#: Listings share so many states: a state costs a Python call of milliseconds in each micro-batch that meets it.
ROLLING_BUCKETS = 2048


def _rolling_stream(events: DataFrame, kinds: dict[str, str], size: str, slide: str, ts: str) -> DataFrame:
    """``behaviour_window`` of a stream with a watermark: the counts per slide of a bucket of listings are one state.

    An event changes its listing's counts, not one row for each window that holds it. Once
    the watermark passes the end of a window it is final: the state hands on the
    stretches of such windows with equal counts of a listing, which become a row a window after
    it, and forgets the slides that no later window holds and the listings without any. A row is
    late when its whole slide is. A bucket's new events of a micro-batch are counted in one task,
    a piece at a time; its state is a compressed table of (listing, slide, counts).
    """
    import zlib

    import numpy as np
    import pandas as pd

    step, whole = (int(pd.Timedelta(x).value // 1000) for x in (slide, size))  # microseconds
    per, names = whole // step, list(kinds.values())

    def summed(who, days, counts):
        """One row for each listing and day, in this order."""
        order = np.lexsort((days, who))
        who, days, counts = who[order], days[order], counts[order]
        heads = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (days[1:] != days[:-1])][: len(who)])
        return who[heads], days[heads], np.add.reduceat(counts, heads, axis=0) if len(heads) else counts

    def fn(key, pdfs, state):
        listings, who, days, counts, done = [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(names)), np.int64), None
        if state.exists:
            listings, packed, done = state.get
            table = np.frombuffer(zlib.decompress(packed), np.int64).reshape(2 + len(names), -1)
            listings, who, days, counts = list(listings), table[0], table[1], table[2:].T
        if not state.hasTimedOut:
            number = {x: i for i, x in enumerate(listings)}
            for pdf in pdfs:
                codes, found = pd.factorize(pdf["property_id"], use_na_sentinel=False)
                at = np.array([number.setdefault(None if pd.isna(x) else x, len(number)) for x in found], dtype=np.int64)[codes]
                kind = pdf["_kind"].to_numpy()[:, None] == np.arange(len(names))
                who, days, counts = summed(np.concatenate([who, at]), np.concatenate([days, pdf["_day"].to_numpy()]), np.concatenate([counts, kind.astype(np.int64)]))
            listings = list(number)
        now = state.getCurrentWatermarkMs()
        last = now * 1000 // step - per  # the last window that is final
        if len(days):
            # an event comes before its windows are final, so ``done`` of the bucket holds for a new listing too
            first = days - per + 1 if done is None else np.maximum(days - per + 1, done + 1)
            opens, ends = first <= last, days < last
            both = np.column_stack([counts, np.ones(len(days), np.int64)])  # the last column: slides with events
            of, at, change = summed(np.concatenate([who[opens], who[ends]]), np.concatenate([first[opens], days[ends] + 1]), np.concatenate([both[opens], -both[ends]]))
            if len(of):
                heads = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                sums = change.cumsum(axis=0)
                sums = sums - np.repeat((sums - change)[heads], np.diff(np.r_[heads, len(of)]), axis=0)  # each listing from nothing
                until = np.r_[at[1:], last + 1]
                until[np.r_[heads[1:] - 1, len(of) - 1]] = last + 1
                held = (sums[:, -1] > 0) & (until > at)
                if held.any():
                    yield pd.DataFrame({"property_id": np.array(listings, dtype=object)[of[held]], "_from": at[held] * step, "_until": until[held] * step,
                                        **{c: sums[held, i] for i, c in enumerate(names)}})
            left = days > last
            used, who = np.unique(who[left], return_inverse=True)
            listings, days, counts = [listings[i] for i in used], days[left], counts[left]
            done = last if done is None else max(done, last)
        if not len(days):
            state.remove()
            return
        state.update((listings, zlib.compress(np.vstack([who, days, counts.T]).astype(np.int64).tobytes(), 1), int(done)))
        closes = (max(int(days.min()) - per + 1, done + 1) + per) * step // 1000
        state.setTimeoutTimestamp(max(closes - 1, now + 1))

    kind = F.lit(-1)
    for i, a in enumerate(kinds):
        kind = F.when(F.col("action") == a, F.lit(i)).otherwise(kind)
    slides = events.select("property_id", kind.alias("_kind"), F.window(ts, slide).alias("w"))
    bucket = F.pmod(F.xxhash64("property_id"), F.lit(ROLLING_BUCKETS)).cast("int").alias("_bucket")
    numbered = slides.select(bucket, "property_id", "_kind", F.expr(f"unix_micros(w.start) div {step}").alias("_day"), F.window_time("w").alias("_time"))
    runs = numbered.groupBy("_bucket").applyInPandasWithState(
        fn, "property_id string, _from bigint, _until bigint, " + ", ".join(f"{c} bigint" for c in names), ROLLING_STATE, "append", "EventTimeTimeout")
    windows = runs.select(F.explode(F.sequence("_from", F.col("_until") - step, F.lit(step).cast("bigint"))).alias("_at"), "property_id", *names)
    return windows.select(F.timestamp_micros("_at").alias("window_start"), F.timestamp_micros(F.col("_at") + whole).alias("window_end"), "property_id", *names)


# ------------------------------------------------------------------- STR-07 TTL dedup
def global_index(df: DataFrame, order_cols: list[str], name: str = "pos") -> DataFrame:
    """0-based position of every row in the total order ``order_cols``.

    Range-partitioned sort (a hot key's range is split across tasks), then
    per-partition row offsets from a table with one row per partition. No step
    sees more than one partition's rows.
    """
    from pyspark.sql import Window
    s = (df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mono", F.monotonically_increasing_id())
         .checkpoint())
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row per partition
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (s.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
            .withColumn(name, F.col("_off") + local).drop("_pid", "_mono", "_off"))


def dedup_ttl(events: DataFrame, key: str, ts: str, ttl_seconds: int) -> DataFrame:
    """STR-07 (batch, exact, distributed): flag cache misses.

    A hit is an event within ttl of its key's last miss; the window is fixed at
    the miss and does not slide. After a miss at s the next miss is the first
    event of the key at or after s + ttl ("next link"). Misses are the events
    reachable from each key's first event along next links.

    * next links: events and probes (s + ttl) sorted together by (key, time);
      a probe's count of preceding events is the position of its next event.
      Global positions come from range-partitioned sorts, so a key holding a
      third of all rows is spread over many tasks.
    * reachability: pointer doubling (J_{k+1} = J_k o J_k, joins on event id),
      log2(chain length) rounds, each checkpointed to cut lineage.
    """
    from lodestar.session import checkpoint_dir
    checkpoint_dir(events.sparkSession)
    secs = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    ev = events.select("event_id", F.col(key).alias("_k"), secs.alias("_s"))
    pos_e = global_index(ev, ["_k", "_s", "event_id"], "_pe")
    probes = ev.select("_k", (F.col("_s") + F.lit(float(ttl_seconds))).alias("_s"),
                       F.col("event_id").alias("_src"))
    pos_p = global_index(probes, ["_k", "_s", "_src"], "_pp").select("_src", "_pp")
    both = (ev.select("_k", "_s", F.lit(1).alias("_t"), F.col("event_id").alias("_id"))
            .unionByName(probes.select("_k", "_s", F.lit(0).alias("_t"), F.col("_src").alias("_id"))))
    pos_c = global_index(both, ["_k", "_s", "_t", "_id"], "_pc").filter(F.col("_t") == 0) \
        .select(F.col("_id").alias("_src"), "_k", "_pc")
    want = pos_c.join(pos_p, "_src").select("_src", "_k", (F.col("_pc") - F.col("_pp")).alias("_pe"))
    target = pos_e.select(F.col("_pe"), F.col("_k").alias("_k2"), F.col("event_id").alias("_nxt"))
    nxt = (want.join(target, "_pe", "left")
           .select(F.col("_src").alias("id"),
                   F.when(F.col("_k2") == F.col("_k"), F.col("_nxt")).alias("nxt"))
           .checkpoint())
    heads = ev.groupBy("_k").agg(F.min_by("event_id", F.struct("_s", "event_id")).alias("id")).select("id")
    path = heads.checkpoint()
    jump = nxt
    while True:
        step = path.join(jump, "id").filter(F.col("nxt").isNotNull()).select(F.col("nxt").alias("id"))
        path = path.unionByName(step).checkpoint()
        if jump.filter(F.col("nxt").isNotNull()).limit(1).count() == 0:
            break
        a, b = jump.alias("a"), jump.alias("b")
        jump = (a.join(b, F.col("a.nxt") == F.col("b.id"), "left")
                .select(F.col("a.id").alias("id"), F.col("b.nxt").alias("nxt")).checkpoint())
    misses = path.select(F.col("id").alias("event_id"), F.lit(True).alias("is_miss"))
    return events.join(misses, "event_id", "left") \
        .withColumn("is_miss", F.coalesce(F.col("is_miss"), F.lit(False)))


DEDUP_STATE = T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("last_miss", T.ArrayType(T.DoubleType()))])
#: Keys share so many states: a state costs a Python call of milliseconds in each micro-batch that meets it.
DEDUP_BUCKETS = 2048


def dedup_ttl_stream(events: DataFrame, key: str, ts: str, ttl_seconds: int, expire: bool = False) -> DataFrame:
    """STR-07 (stream): state = time of the last miss of each key, kept for a bucket of keys together; events are
    taken in event-time order within a micro-batch. Output: event_id, key, is_miss.

    With ``expire`` (needs a watermark on ``ts``) a key goes once the watermark
    passes its last miss plus the ttl, when it can tell nothing any more.
    """
    import pandas as pd

    def fn(bucket, pdfs, state):
        last = dict(zip(*state.get, strict=True)) if state.exists else {}
        if not state.hasTimedOut:
            pdf = pd.concat(list(pdfs)).sort_values(["_s", "event_id"])
            flags = []
            for k, s in zip(pdf["key"].tolist(), pdf["_s"].tolist(), strict=True):
                before = last.get(k)
                miss = before is None or s >= before + ttl_seconds
                if miss:
                    last[k] = s
                flags.append(miss)
            yield pd.DataFrame({"event_id": pdf["event_id"].to_numpy(), "key": pdf["key"].to_numpy(), "is_miss": flags})
        if expire:
            now = state.getCurrentWatermarkMs()
            last = {k: s for k, s in last.items() if (s + ttl_seconds) * 1000 > now}
            if not last:
                state.remove()
                return
        state.update((list(last), list(last.values())))
        if expire:
            state.setTimeoutTimestamp(max(int((min(last.values()) + ttl_seconds) * 1000), now + 1))

    e = events.select("event_id", F.col(key).alias("key"), F.col(ts),
                      (F.unix_micros(F.col(ts).cast("timestamp")) / 1e6).alias("_s"),
                      F.pmod(F.xxhash64(key), F.lit(DEDUP_BUCKETS)).cast("int").alias("_bucket"))
    return e.groupBy("_bucket").applyInPandasWithState(
        fn, "event_id long, key string, is_miss boolean", DEDUP_STATE.simpleString(), "append",
        "EventTimeTimeout" if expire else "NoTimeout")


def stream_to_table(stream: DataFrame, path: str, checkpoint: str, trigger_once: bool = True,
                    partition_by: list[str] | None = None):
    """SNK-05 / SNK-07: append a parsed stream to a parquet table with a checkpoint (exactly-once)."""
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


def retrain_trigger_messages(decision: DataFrame, source: str = "scheduler") -> DataFrame:
    """STR-10: a trigger message for each decision row that asks for a retrain."""
    return decision.filter(F.col("should_retrain")).select(
        F.to_json(F.struct(F.lit(source).alias("source"),
                           F.split(F.col("reasons"), ";").alias("reasons"))).alias("message"))
