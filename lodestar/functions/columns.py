"""Scalar column functions (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.vocab import HASH_SEPARATOR, LOCAL_TZ, TITLE_DESCRIPTION_JOINER


def ts_lit(value: str) -> Column:
    """A wall-clock UTC instant as TIMESTAMP_NTZ (driver tables load as NTZ)."""
    return F.lit(value).cast("timestamp_ntz")


def safe_divide(num: Column, den: Column) -> Column:
    """SAFE_DIVIDE: null when either side is null or the divisor is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def local_date(ts: Column, tz: str = LOCAL_TZ) -> Column:
    """Calendar date of a UTC instant in ``tz``."""
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), tz))


def utc_midnight(d: Column) -> Column:
    """TIMESTAMP(date): UTC midnight of a date, as NTZ."""
    return d.cast("timestamp_ntz")


def days_before(ts: Column, days: int) -> Column:
    return ts - F.make_interval(days=F.lit(days))


def passage_text(title: Column, description: Column) -> Column:
    """title + joiner + description with both sides null-safe, whitespace-stripped."""
    raw = F.concat(F.coalesce(title, F.lit("")), F.lit(TITLE_DESCRIPTION_JOINER),
                   F.coalesce(description, F.lit("")))
    return F.regexp_replace(raw, r"^\s+|\s+$", "")


def text_hash(model_name: Column | str, text: Column) -> Column:
    """sha256 hex of model name, unit separator, text (model-scoped hash)."""
    m = F.lit(model_name) if isinstance(model_name, str) else model_name
    return F.sha2(F.concat(m, F.lit(HASH_SEPARATOR), text), 256)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def l2_norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v))


def l2_normalize(a: Column) -> Column:
    n = l2_norm(a)
    return F.when(n > 0, F.transform(a, lambda v: v / n)).otherwise(a)


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - dot(a, b) / (l2_norm(a) * l2_norm(b))


def similarity_from_distance(distance: Column) -> Column:
    """score = 1 - distance; a missing distance scores 0 (a perfect match scores 1)."""
    return F.when(distance.isNull(), F.lit(0.0)).otherwise(F.lit(1.0) - distance)


def stable_bucket(key: Column, buckets: int = 10) -> Column:
    """Process- and engine-independent hash bucket of a key: the first 32 bits of its md5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def label_gain(action: Column) -> Column:
    """Gain of one feedback action; unknown actions gain 0."""
    return (F.when(action == "inquiry", 3).when(action == "favorite", 2)
            .when(action == "click", 1).otherwise(0))


def run_id(ts: Column, *parts: Column) -> Column:
    """YYYYMMDDTHHMMSSZ-<8 hex>, deterministic from its inputs."""
    return F.concat(F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"), F.lit("-"),
                    F.substring(F.sha2(F.concat_ws("|", ts.cast("string"), *parts), 256), 1, 8))


def coerce_param(value: Column) -> Column:
    """Parameter string -> typed struct: bool, long, double, json or the string itself."""
    v = F.trim(value)
    low = F.lower(v)
    as_bool = F.when(low == "true", True).when(low == "false", False)
    return F.struct(
        as_bool.alias("as_bool"),
        F.when(as_bool.isNull(), v.try_cast("bigint")).alias("as_long"),
        F.when(as_bool.isNull(), v.try_cast("double")).alias("as_double"),
        F.try_parse_json(v).alias("as_json"),
        value.alias("as_string"),
    )


def latency_bucket(ms: Column, buckets: int = 24) -> Column:
    """Exponential bucket (growth 2, scale 1): 0 underflow, 1..buckets finite, buckets+1 overflow."""
    e = F.floor(F.log2(ms))
    # log2 may be off by one ulp at exact powers of two: correct with exact powers
    e = F.when(F.pow(F.lit(2.0), e + 1) <= ms, e + 1).when(F.pow(F.lit(2.0), e) > ms, e - 1).otherwise(e)
    return (F.when(ms < 1, F.lit(0))
            .otherwise(F.least(e + 1, F.lit(buckets + 1)))
            .cast("bigint"))


def request_cache_key(query: Column, filters: Column, top_k: Column) -> Column:
    """FN-09: sha256 of the canonical JSON {filters, query (stripped), top_k}, keys sorted,
    nulls kept, compact separators. ``filters`` is a struct whose fields are sorted by name."""
    payload = F.struct(filters.alias("filters"), F.trim(query).alias("query"), top_k.cast("bigint").alias("top_k"))
    return F.sha2(F.to_json(payload, {"ignoreNullFields": "false"}), 256)


def sorted_struct(df_cols: list[str]) -> Column:
    """Struct of ``df_cols`` with fields in name order (canonical JSON key order)."""
    return F.struct(*[F.col(c) for c in sorted(df_cols)])
