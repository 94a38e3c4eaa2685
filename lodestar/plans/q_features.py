"""Queries: sources, cleaning, the daily feature mart and its quality gates."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestar.functions.columns import local_date, passage_text, ts_lit
from lodestar.functions.vocab import FEATURE_COLS
from lodestar.operators import features as fm
from lodestar.operators import quality, sinks
from lodestar.plans.registry import query
from lodestar.session import checkpoint_dir
from lodestar.sources import fixtures as fx

AS_OF_SQL = "TIMESTAMP '2001-07-15 12:00:00'"
RUN_DATE_SQL = f"CAST({AS_OF_SQL} + INTERVAL 9 HOUR AS DATE)"


def mart(spark, d, clean=True):
    between = fm.window_bounds(fx.AS_OF)[1], ts_lit(fx.AS_OF)  # of the logs of all time the mart's window, before they are ranked
    return fm.feature_mart(fx.listings(spark, d), fx.search_logs(spark, d, between), fx.feedback_events(spark, d, between),
                           fx.AS_OF, clean=clean)


def _r6(*cols):
    return [F.round(F.col(c), 6).alias(c) for c in cols]


@query("scan_sources", """
SELECT 'properties' AS source, count(*) AS n_rows FROM properties
UNION ALL SELECT 'search_logs', count(*) FROM search_logs
UNION ALL SELECT 'feedback_events', count(*) FROM feedback_events""",
       ("properties", "search_logs", "feedback_events"))
def q_scan_sources(spark, d):
    """SRC-01: each declared source scanned by name (row counts)."""
    srcs = {"properties": fx.properties(spark, d), "search_logs": fx.search_logs(spark, d),
            "feedback_events": fx.feedback_events(spark, d)}
    out = None
    for name, df in srcs.items():
        one = df.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n_rows"))
        out = one if out is None else out.unionByName(one)
    return out


@query("scan_property_text", """
SELECT property_id, title, coalesce(description, '') AS description FROM properties WHERE title IS NOT NULL""",
       ("properties",))
def q_scan_property_text(spark, d):
    """SRC-02: (id, title, description) for titled listings; null description -> ''."""
    from lodestar.operators.embeddings import property_text
    return property_text(fx.properties(spark, d))


@query("search_documents", """
SELECT property_id, title, description, layout, rent, walk_min, age_years, pet_ok, area_m2,
       concat_ws(' ', title, description, layout) AS searchable_text
FROM cleaned""", ("cleaned",))
def q_search_documents(spark, d):
    """SRC-04: listings projected to search documents (filterable + searchable fields)."""
    from lodestar.operators.retrieval import search_documents
    return search_documents(fm.clean_properties(fx.properties(spark, d)))


@query("clean_properties", "SELECT * EXCLUDE (description) FROM cleaned", ("cleaned",))
def q_clean_properties(spark, d):
    return fm.clean_properties(fx.properties(spark, d)).drop("description")


MART_COLS = "event_date, property_id, rent, walk_min, age_years, area_m2, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in ["ctr", "fav_rate", "inquiry_rate", "popularity_score"])


@query("property_features_daily", f"SELECT {MART_COLS} FROM feature_mart", ("feature_mart",))
def q_feature_mart(spark, d):
    """The daily feature mart (JOIN-01..03, AGG-01..04 together)."""
    m = mart(spark, d)
    return m.select(*m.columns[:6], *_r6("ctr", "fav_rate", "inquiry_rate", "popularity_score"))


@query("features_left_joins", """
SELECT property_id, impression_count, click_count, favorite_count, inquiry_count FROM feature_mart""",
       ("feature_mart",))
def q_features_left_joins(spark, d):
    basics = fm.clean_listing_numbers(fx.listings(spark, d)).select("property_id")
    j = fm.features_left_joins(basics, fm.impressions(fx.search_logs(spark, d), fx.AS_OF),
                               fm.actions(fx.feedback_events(spark, d), fx.AS_OF))
    return j.select("property_id", "impression_count", "click_count", "favorite_count", "inquiry_count")


@query("cross_join_bounds", "SELECT l.property_id, b.event_date, b.window_start FROM listings l, fm_bounds b",
       ("listings", "fm_bounds"))
def q_cross_join_bounds(spark, d):
    """JOIN-02: window bounds attached as literal columns (no join)."""
    ev, start = fm.window_bounds(fx.AS_OF)
    return fx.listings(spark, d).select("property_id", ev.alias("event_date"), start.alias("window_start"))


@query("unnest_impressions", "SELECT request_id, property_id FROM fm_exploded", ("fm_exploded",))
def q_unnest(spark, d):
    return fm.unnest_impressions(fx.search_logs(spark, d), fx.AS_OF)


@query("impressions_28d", "SELECT property_id, impression_count FROM fm_impressions", ("fm_impressions",))
def q_impressions(spark, d):
    return fm.impressions(fx.search_logs(spark, d), fx.AS_OF)


@query("actions_28d", "SELECT * FROM fm_actions", ("fm_actions",))
def q_actions(spark, d):
    return fm.actions(fx.feedback_events(spark, d), fx.AS_OF)


@query("behaviour_rates", """
SELECT property_id, round(ctr, 6) AS ctr, round(fav_rate, 6) AS fav_rate, round(inquiry_rate, 6) AS inquiry_rate
FROM feature_mart""", ("feature_mart",))
def q_rates(spark, d):
    return mart(spark, d).select("property_id", *_r6("ctr", "fav_rate", "inquiry_rate"))


@query("popularity_score", "SELECT property_id, round(popularity_score, 6) AS popularity_score FROM feature_mart",
       ("feature_mart",))
def q_popularity(spark, d):
    return mart(spark, d).select("property_id", *_r6("popularity_score"))


@query("latest_partition", f"""
SELECT property_id, event_date FROM (SELECT {MART_COLS} FROM feature_mart)
WHERE event_date = (SELECT max(event_date) FROM feature_mart)""", ("feature_mart",))
def q_latest_partition(spark, d):
    """JOIN-07 over a two-day mart: only the newest day survives."""
    today = mart(spark, d)
    earlier = today.withColumn("event_date", F.date_sub("event_date", 1))
    return fm.latest_partition(today.unionByName(earlier)).select("property_id", "event_date")


@query("time_window_filter", f"""
SELECT request_id, property_id, ts FROM ranking_log
WHERE ts >= {AS_OF_SQL} - INTERVAL 28 DAY AND ts <= {AS_OF_SQL}""", ("ranking_log",))
def q_time_window(spark, d):
    r = fx.ranking_log(spark, d).select("request_id", "property_id", "ts")
    return fm.time_window_filter(r, fx.AS_OF, 28)


@query("local_day_filter", f"""
SELECT request_id, property_id, ts FROM ranking_log
WHERE CAST(ts + INTERVAL 9 HOUR AS DATE) = {RUN_DATE_SQL}""", ("ranking_log",))
def q_local_day(spark, d):
    r = fx.ranking_log(spark, d).select("request_id", "property_id", "ts")
    return fm.local_day_filter(r, local_date(ts_lit(fx.AS_OF)))


@query("schema_version_filter", """
SELECT request_id, property_id, schema_version FROM ranking_log
WHERE schema_version >= 2 AND lexical_rank IS NOT NULL AND semantic_rank IS NOT NULL""", ("ranking_log",))
def q_schema_version(spark, d):
    return fm.schema_version_filter(fx.ranking_log(spark, d)).select("request_id", "property_id", "schema_version")


@query("struct_projection", "SELECT request_id, property_id, " + ", ".join(
    f"round(f_{c}, 6) AS {c}" for c in FEATURE_COLS) + " FROM ranking_log", ("ranking_log",))
def q_struct_projection(spark, d):
    """PRJ-03: nested features.* read as columns."""
    r = fx.ranking_log(spark, d)
    return r.select("request_id", "property_id",
                    *[F.round(F.col(f"features.{c}"), 6).alias(c) for c in FEATURE_COLS])


@query("features_quality", """
SELECT property_id, rent, walk_min, age_years, round(ctr, 6) AS ctr FROM feature_mart_raw
WHERE property_id IS NULL OR rent IS NULL OR rent < 0 OR walk_min IS NULL OR walk_min < 0 OR walk_min > 120
   OR age_years IS NULL OR age_years < 0 OR age_years > 150
   OR (ctr IS NOT NULL AND (ctr < 0 OR ctr > 1)) OR (fav_rate IS NOT NULL AND (fav_rate < 0 OR fav_rate > 1))
   OR (inquiry_rate IS NOT NULL AND (inquiry_rate < 0 OR inquiry_rate > 1))""", ("feature_mart_raw",))
def q_features_quality(spark, d):
    """VAL-01 on the raw listing columns (cleaned ones never violate)."""
    bad = quality.features_quality(mart(spark, d, clean=False))
    return bad.select("property_id", "rent", "walk_min", "age_years", F.round("ctr", 6).alias("ctr"))


@query("features_freshness", f"""
SELECT 1 AS stale FROM (SELECT max(event_date) AS latest FROM feature_mart)
WHERE latest IS NULL OR latest < {RUN_DATE_SQL} - INTERVAL 2 DAY""", ("feature_mart",))
def q_features_freshness(spark, d):
    return quality.features_freshness(mart(spark, d), fx.AS_OF)


def _sink_dir(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/lodestar-sinks/{name}-{uuid.uuid4().hex[:12]}"


@query("write_feature_mart", f"SELECT {MART_COLS} FROM feature_mart", ("feature_mart",))
def q_write_feature_mart(spark, d):
    """SNK-01: day-partitioned, id-clustered parquet write; read back."""
    path = _sink_dir(spark, "feature_mart")
    sinks.write_feature_mart(mart(spark, d), path)
    m = spark.read.parquet(path)
    return m.select("event_date", "property_id", "rent", "walk_min", "age_years", "area_m2",
                    *_r6("ctr", "fav_rate", "inquiry_rate", "popularity_score"))


@query("replace_day_partition", f"SELECT {MART_COLS} FROM feature_mart", ("feature_mart",))
def q_replace_day_partition(spark, d):
    """SNK-02: write the day twice (second run replaces it) next to an older day; read the day back."""
    path = _sink_dir(spark, "feature_mart_replace")
    m = mart(spark, d)
    sinks.write_feature_mart(m.withColumn("event_date", F.date_sub("event_date", 1)), path)
    sinks.write_feature_mart(m.withColumn("rent", F.lit(-1).cast("bigint")), path)
    sinks.replace_day_partition(m, path)
    back = spark.read.parquet(path).filter(F.col("event_date") == local_date(ts_lit(fx.AS_OF)))
    return back.select("event_date", "property_id", "rent", "walk_min", "age_years", "area_m2",
                       *_r6("ctr", "fav_rate", "inquiry_rate", "popularity_score"))
