"""STR-07 as a stream: keys share states, and go from them when the watermark has passed what they can tell."""

import random

from pyspark.sql import functions as F

from lodestar.streaming import operators as so
from tests.test_streaming import _brute_dedup


def test_keys_share_states_and_expire(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(so, "DEDUP_BUCKETS", 4)
    rnd, ttl, step = random.Random(3), 500, 2000
    rows = [(i, None if i % 17 == 0 else f"k{rnd.randrange(40)}", 1_700_000_000 + i // 200 * step + rnd.uniform(0, step - 1)) for i in range(800)]
    df = spark.createDataFrame(rows, "event_id long, k string, s double").withColumn("ts", F.timestamp_seconds("s"))
    flush = spark.createDataFrame([(-1, "flush", 1_900_000_000.0)], "event_id long, k string, s double").withColumn("ts", F.timestamp_seconds("s"))
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/in/*").withWatermark("ts", "0 seconds")
    df.filter("event_id < 200").write.parquet(f"{tmp_dir}/in/part=0")
    q = so.dedup_ttl_stream(stream, "k", "ts", ttl, expire=True).writeStream.format("memory").queryName("dedup_buckets").outputMode("append").start()
    q.processAllAvailable()
    held = [q.lastProgress.stateOperators[0].numRowsTotal]
    for i in range(1, 4):
        df.filter((F.col("event_id") >= 200 * i) & (F.col("event_id") < 200 * (i + 1))).write.parquet(f"{tmp_dir}/in/part={i}")
        q.processAllAvailable()
        held.append(q.lastProgress.stateOperators[0].numRowsTotal)
    flush.write.parquet(f"{tmp_dir}/in/part=9")
    q.processAllAvailable()
    held.append(q.lastProgress.stateOperators[0].numRowsTotal)
    q.stop()
    got = {r["event_id"]: (r["key"], r["is_miss"]) for r in spark.table("dedup_buckets").collect() if r["event_id"] >= 0}
    want = _brute_dedup([(r["event_id"], r["k"], r["u"] / 1e6) for r in df.select("event_id", "k", F.unix_micros("ts").alias("u")).collect()], ttl)
    assert got == {i: (k, want[i]) for i, k, _ in rows}
    assert max(held) <= 4 and held[-1] <= 1  # the flush record's own state may stay
