"""Message schemas and parsing for the event topics (ranking log, feedback, alerts, triggers).

Parsing uses ``from_json`` with the *table* schema, so unknown fields are
dropped and types are enforced; rows that do not parse are routed to a
quarantine frame instead of failing the stream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.vocab import FEATURE_COLS, TRIGGER_SOURCES

FEATURES_T = T.StructType([T.StructField(c, T.DoubleType()) for c in FEATURE_COLS])

RANKING_LOG_T = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("property_id", T.StringType()),
    T.StructField("schema_version", T.LongType()),
    T.StructField("lexical_rank", T.LongType()),
    T.StructField("semantic_rank", T.LongType()),
    T.StructField("rrf_rank", T.LongType()),
    T.StructField("final_rank", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("me5_score", T.DoubleType()),
    T.StructField("features", FEATURES_T),
    T.StructField("model_path", T.StringType()),
])

FEEDBACK_T = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("property_id", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
])

ALERT_T = T.StructType([
    T.StructField("alert_time", T.TimestampNTZType()),
    T.StructField("model_resource_name", T.StringType()),
    T.StructField("drift_metric", T.StringType()),
    T.StructField("feature_name", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
])

TRIGGER_T = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("reasons", T.ArrayType(T.StringType())),
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
])


# microsecond timestamps survive the JSON round trip
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def to_message(df: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Rows -> one JSON ``value`` per row (what a producer publishes)."""
    cols = [F.col(c) for c in df.columns] + [v.alias(k) for k, v in (extra or {}).items()]
    return df.select(F.to_json(F.struct(*cols), JSON_OPTIONS).alias("value"))


# required (non-null) fields per message type; a message missing one is quarantined
REQUIRED = {
    "ranking_log": ["request_id", "ts", "property_id", "lexical_rank"],
    "feedback": ["request_id", "property_id", "action", "ts"],
    "alert": ["alert_time"],
}


def parse(raw: DataFrame, schema: T.StructType, value: str = "value",
          required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantined raw rows). Unknown fields are dropped by the schema;
    malformed JSON or a missing required field sends the raw message to quarantine."""
    req = required if required is not None else [f.name for f in schema.fields]
    p = raw.withColumn("_m", F.from_json(F.col(value), schema, JSON_OPTIONS))
    ok_cond = F.col("_m").isNotNull()
    for c in req:
        ok_cond = ok_cond & F.col(f"_m.{c}").isNotNull()
    p = p.withColumn("_ok", F.coalesce(ok_cond, F.lit(False)))
    ok = p.filter(F.col("_ok")).select("_m.*")
    bad = p.filter(~F.col("_ok")).select(F.col(value).alias("raw"))
    return ok, bad


def ranking_log_rows(raw: DataFrame) -> DataFrame:
    """STR-01: nested JSON candidate rows -> typed ranking_log rows."""
    return parse(raw, RANKING_LOG_T, required=REQUIRED["ranking_log"])[0]


def feedback_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """STR-02: JSON feedback -> (valid rows, rejected rows) by the action whitelist (VAL-02)."""
    from lodestar.operators.quality import split_feedback
    rows, _ = parse(raw, FEEDBACK_T, required=REQUIRED["feedback"])
    return split_feedback(rows)


def alert_rows(raw: DataFrame) -> DataFrame:
    """STR-03: drift alert messages -> alert table rows, raw payload kept as JSON text."""
    p = raw.withColumn("_m", F.from_json(F.col("value"), ALERT_T, JSON_OPTIONS))
    ok = reduce(lambda a, c: a & F.col(f"_m.{c}").isNotNull(), REQUIRED["alert"], F.col("_m").isNotNull())
    return p.filter(F.coalesce(ok, F.lit(False))).select("_m.*", F.col("value").alias("payload"))


def quarantine(raw: DataFrame, kind: str) -> DataFrame:
    """(topic, raw, reason) of the messages that ``kind`` rejects: what its table never gets.

    reason: unparsable, missing field, or (feedback) unknown action.
    """
    from lodestar.functions.vocab import VALID_ACTIONS
    schema = {"ranking_log": RANKING_LOG_T, "feedback": FEEDBACK_T, "alert": ALERT_T}[kind]
    p = raw.withColumn("_m", F.from_json(F.col("value"), schema, JSON_OPTIONS))
    some = reduce(lambda a, f: a | F.col(f"_m.{f.name}").isNotNull(), schema.fields, F.lit(False))
    whole = reduce(lambda a, c: a & F.col(f"_m.{c}").isNotNull(), REQUIRED[kind], F.lit(True))
    reason = F.when(F.col("_m").isNull() | ~some, "unparsable").when(~whole, "missing field")
    if kind == "feedback":
        reason = reason.when(~F.col("_m.action").isin(*VALID_ACTIONS), "unknown action")
    return p.select(F.lit(kind).alias("topic"), F.col("value").alias("raw"), reason.alias("reason")).filter(F.col("reason").isNotNull())


DEFAULT_PIPELINE_PARAMETERS = {"learning_rate": "0.05", "num_leaves": "31"}


def _trigger_text(encoded: bool) -> Column:
    return F.try_to_binary(F.col("data"), F.lit("base64")).try_cast("string") if encoded else F.col("data")


def _is_trigger(encoded: bool) -> Column:
    text = _trigger_text(encoded)
    whole = F.trim(text).startswith("{") & F.json_object_keys(text).isNotNull()
    return F.coalesce(whole, F.lit(False))


def rejected_triggers(raw: DataFrame, encoded: bool = True) -> DataFrame:
    """Trigger messages that are no base64 (where encoded) or no JSON object."""
    return raw.filter(~_is_trigger(encoded))


def trigger_events(raw: DataFrame, defaults: dict[str, str] | None = None,
                   encoded: bool = True) -> DataFrame:
    """STR-04: base64 JSON trigger message -> resolved event.

    source: a known source (trimmed, lower-cased) wins; otherwise any reason
    mentioning "drift" means monitoring; otherwise scheduler. Parameters are the
    defaults overlaid by the event's own; ``enable_tuning`` defaults to
    (source = monitoring); ``retrain_reasons`` are the ones given as a parameter
    (a JSON array) or else the message's reasons. A message that is not base64 of a
    JSON object is no event; ``rejected_triggers`` has it.
    """
    dflt = defaults if defaults is not None else DEFAULT_PIPELINE_PARAMETERS
    m = raw.filter(_is_trigger(encoded)).withColumn("_m", F.from_json(_trigger_text(encoded), TRIGGER_T, JSON_OPTIONS))
    src = F.lower(F.trim(F.coalesce(F.col("_m.source"), F.lit(""))))
    drift = F.coalesce(F.exists(F.col("_m.reasons"), lambda r: F.lower(r).contains("drift")), F.lit(False))
    source = (F.when(src.isin(*TRIGGER_SOURCES), src).when(drift, F.lit("monitoring"))
              .otherwise(F.lit("scheduler")))
    base = F.create_map(*[x for k, v in dflt.items() for x in (F.lit(k), F.lit(v))]) if dflt else \
        F.create_map().cast("map<string,string>")
    given = F.coalesce(F.col("_m.parameters"), F.create_map().cast("map<string,string>"))
    # event parameters win over defaults (no reliance on the session's map-key dedup policy)
    params = F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(given), k)), given)
    tuning = F.coalesce(F.lower(params["enable_tuning"]).try_cast("boolean"), source == "monitoring")
    return m.select(*[c for c in raw.columns if c != "data"], source.alias("source"),
                    tuning.alias("enable_tuning"), params.alias("parameters"),
                    F.coalesce(F.from_json(params["retrain_reasons"], "array<string>"), F.col("_m.reasons"),
                               F.array().cast("array<string>")).alias("retrain_reasons"))
