"""Quality gates: each returns the violating rows (a job fails when non-empty)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.columns import l2_norm, local_date, ts_lit
from lodestar.functions.vocab import (DEFAULT_TOP_K, FEATURE_COLS, FRESHNESS_DAYS, MAX_QUERY_CHARS,
                                      MAX_TOP_K, VALID_ACTIONS)


def _rate_bad(c: str):
    x = F.col(c)
    return x.isNotNull() & ((x < 0) | (x > 1))


def features_quality(features: DataFrame) -> DataFrame:
    """VAL-01: rows breaking the feature-mart ranges."""
    rent, walk, age = F.col("rent"), F.col("walk_min"), F.col("age_years")
    bad = (F.col("property_id").isNull()
           | rent.isNull() | (rent < 0)
           | walk.isNull() | (walk < 0) | (walk > 120)
           | age.isNull() | (age < 0) | (age > 150)
           | _rate_bad("ctr") | _rate_bad("fav_rate") | _rate_bad("inquiry_rate"))
    return features.filter(bad)


def features_freshness(features: DataFrame, as_of: str, days: int = FRESHNESS_DAYS) -> DataFrame:
    """VAL-04: one row ``stale = 1`` when the newest partition is missing or too old."""
    today = local_date(ts_lit(as_of))
    latest = features.agg(F.max("event_date").alias("latest"))
    return (latest.filter(F.col("latest").isNull() | (F.col("latest") < F.date_sub(today, days)))
            .select(F.lit(1).alias("stale")))


def split_feedback(feedback: DataFrame) -> tuple[DataFrame, DataFrame]:
    """VAL-02: (valid, rejected) by action whitelist; rejected rows keep a reason."""
    ok = F.col("action").isNotNull() & F.col("action").rlike("^(" + "|".join(VALID_ACTIONS) + ")$")
    tagged = feedback.withColumn("_ok", ok)
    valid = tagged.filter(F.col("_ok")).drop("_ok")
    rejected = (tagged.filter(~F.col("_ok")).drop("_ok")
                .withColumn("reject_reason", F.lit("action_not_allowed")))
    return valid, rejected


def requests_valid(requests: DataFrame) -> DataFrame:
    """VAL-03: request rows with defaults applied and a ``reject_reasons`` array.

    query length 1..512, top_k 1..100 (default 20), numeric limits >= 0.
    """
    top_k = F.coalesce(F.col("top_k"), F.lit(DEFAULT_TOP_K)).cast("bigint")
    q = F.col("query_text")
    reasons = F.array_compact(F.array(
        F.when(q.isNull(), F.lit("query_missing")),
        F.when(q.isNotNull() & ((F.char_length(q) < 1) | (F.char_length(q) > MAX_QUERY_CHARS)),
               F.lit("query_length")),
        F.when((top_k < 1) | (top_k > MAX_TOP_K), F.lit("top_k_range")),
        F.when(F.col("max_rent") < 0, F.lit("max_rent_negative")),
        F.when(F.col("max_walk_min") < 0, F.lit("max_walk_min_negative")),
        F.when(F.col("max_age") < 0, F.lit("max_age_negative")),
    ))
    return requests.withColumn("top_k", top_k).withColumn("reject_reasons", reasons) \
        .withColumn("is_valid", F.size("reject_reasons") == 0)


def feature_parity(df: DataFrame, prefix: str = "") -> list[str]:
    """VAL-05: differences between a frame's feature columns and the vocabulary (schema only)."""
    names = [f.name for f in df.schema.fields if f.name.startswith(prefix)]
    got = [n[len(prefix):] for n in names if n[len(prefix):] in FEATURE_COLS]
    problems = []
    if got != FEATURE_COLS:
        problems.append(f"order/names {got} != {FEATURE_COLS}")
    for f in df.schema.fields:
        if f.name[len(prefix):] in FEATURE_COLS and f.dataType.simpleString() != "double":
            problems.append(f"{f.name} is {f.dataType.simpleString()}, expected double")
    return problems


def vector_contract(embeddings: DataFrame, dim: int, tol: float = 1e-6) -> DataFrame:
    """VAL-06: rows whose vector has the wrong dimension or is not unit length."""
    n = l2_norm(F.col("embedding"))
    return (embeddings.withColumn("dim", F.size("embedding")).withColumn("norm", n)
            .filter((F.col("dim") != dim) | (F.abs(F.col("norm") - 1.0) > tol) | F.col("norm").isNull()))
