"""Scalar functions (FN-*) against plain Python references."""

import hashlib
import json

from pyspark.sql import functions as F

from lodestar.functions import columns as C


def test_request_cache_key_matches_python_canonical_json(spark):
    rows = [("  ワンルーム 駅近 ", 80000, None, 10, True, None, 20), ("quiet", None, "1LDK", None, None, 30, 5)]
    df = spark.createDataFrame(rows, "query string, max_rent long, layout string, max_walk_min long, "
                                     "pet_ok boolean, max_age long, top_k long")
    filt = C.sorted_struct(["max_rent", "layout", "max_walk_min", "pet_ok", "max_age"])
    got = [r[0] for r in df.select(C.request_cache_key(F.col("query"), filt, F.col("top_k"))).collect()]
    want = []
    for q, rent, layout, walk, pet, age, k in rows:
        payload = {"query": q.strip(), "filters": {"max_rent": rent, "layout": layout, "max_walk_min": walk,
                                                   "pet_ok": pet, "max_age": age}, "top_k": k}
        s = json.dumps(payload, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        want.append(hashlib.sha256(s.encode("utf-8")).hexdigest())
    assert got == want


def test_run_id_shape_and_determinism(spark):
    df = spark.createDataFrame([("2026-04-18 10:11:12", "a")], "ts string, x string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    a = df.select(C.run_id(F.col("ts"), F.col("x"))).first()[0]
    b = df.select(C.run_id(F.col("ts"), F.col("x"))).first()[0]
    assert a == b and a.startswith("20260418T101112Z-") and len(a.split("-")[1]) == 8


def test_coerce_param(spark):
    df = spark.createDataFrame([("true",), ("42",), ("0.5",), ('{"a": 1}',), ("text",)], "value string")
    r = df.select(C.coerce_param(F.col("value")).alias("c")).collect()
    assert r[0]["c"]["as_bool"] is True
    assert r[1]["c"]["as_long"] == 42
    assert r[2]["c"]["as_double"] == 0.5 and r[2]["c"]["as_long"] is None
    assert r[3]["c"]["as_json"] is not None
    assert r[4]["c"]["as_string"] == "text" and r[4]["c"]["as_double"] is None


def test_cosine_and_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<double>, b array<double>")
    r = df.select(C.cosine_distance(F.col("a"), F.col("b")).alias("d"),
                  C.l2_normalize(F.col("a")).alias("n"),
                  C.similarity_from_distance(F.lit(0.0)).alias("s")).first()
    assert abs(r["d"] - (1 - 24 / 25)) < 1e-12 and r["n"] == [0.6, 0.8] and r["s"] == 1.0


def test_local_date_and_stable_bucket(spark):
    df = spark.createDataFrame([("2001-07-15 20:00:00", "R1")], "ts string, k string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    r = df.select(C.local_date(F.col("ts")).alias("d"), C.stable_bucket(F.col("k")).alias("b")).first()
    assert str(r["d"]) == "2001-07-16" and 0 <= r["b"] < 10
