"""Daily feature mart: cleaned listings + 28-day behaviour rates.

Impressions and actions are pre-aggregated per listing before the joins, so a
hot listing is combined map-side and every join input has one row per listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.columns import local_date, safe_divide, ts_lit, utc_midnight
from lodestar.functions.vocab import BEHAVIOUR_WINDOW_DAYS, LOCAL_TZ

FEATURE_MART_COLUMNS = ["event_date", "property_id", "rent", "walk_min", "age_years", "area_m2",
                        "ctr", "fav_rate", "inquiry_rate", "popularity_score"]


def _clean_numbers() -> dict:
    return {
        "rent": F.coalesce(F.col("rent"), F.lit(0)).cast("bigint"),
        "management_fee": F.coalesce(F.col("management_fee"), F.lit(0)).cast("bigint"),
        "area_m2": F.col("area_m2").cast("double"),
        "age_years": F.greatest(F.coalesce(F.col("age_years"), F.lit(0)), F.lit(0)).cast("bigint"),
        "walk_min": F.greatest(F.coalesce(F.col("walk_min"), F.lit(0)), F.lit(0)).cast("bigint"),
        "pet_ok": F.coalesce(F.col("pet_ok"), F.lit(False)),
    }


def clean_properties(raw: DataFrame) -> DataFrame:
    """PRJ-01: null-safe numerics, non-negative age/walk, rows without id dropped.

    Rent is filled with 0 but not clamped.
    """
    c = _clean_numbers()
    return raw.filter(F.col("property_id").isNotNull()).select(
        "property_id", "title", "description", "city", "ward",
        c["rent"].alias("rent"), c["management_fee"].alias("management_fee"), "layout",
        c["area_m2"].alias("area_m2"), c["age_years"].alias("age_years"), c["walk_min"].alias("walk_min"),
        c["pet_ok"].alias("pet_ok"), "created_at", "updated_at",
    )


def clean_listing_numbers(raw: DataFrame) -> DataFrame:
    """PRJ-01 restricted to the numeric feature columns (no text is read)."""
    c = _clean_numbers()
    return raw.filter(F.col("property_id").isNotNull()).select(
        "property_id", *[c[k].alias(k) for k in ("rent", "walk_min", "age_years", "area_m2")])


def window_bounds(as_of: str, days: int = BEHAVIOUR_WINDOW_DAYS) -> tuple[Column, Column]:
    """JOIN-02 as literals: (event_date, window_start).

    event_date is the local (Tokyo) date of ``as_of``; window_start is UTC
    midnight of event_date - ``days`` (quirk Q-6, kept).
    """
    event_date = local_date(ts_lit(as_of))
    return event_date, utc_midnight(F.date_sub(event_date, days))


def time_window_filter(df: DataFrame, as_of: str, days: int, ts: str = "ts",
                       start: Column | None = None) -> DataFrame:
    """PRJ-06: rows with start <= ts <= as_of (start defaults to as_of - days)."""
    now = ts_lit(as_of)
    lo = start if start is not None else now - F.make_interval(days=F.lit(days))
    return df.filter((F.col(ts) >= lo) & (F.col(ts) <= now))


def unnest_impressions(search_logs: DataFrame, as_of: str,
                       days: int = BEHAVIOUR_WINDOW_DAYS) -> DataFrame:
    """JOIN-03: one row per shown listing; empty arrays vanish, duplicates count."""
    _, start = window_bounds(as_of, days)
    logs = time_window_filter(search_logs, as_of, days, start=start)
    return logs.select("request_id", F.explode("result_property_ids").alias("property_id"))


def impressions(search_logs: DataFrame, as_of: str, days: int = BEHAVIOUR_WINDOW_DAYS) -> DataFrame:
    """AGG-01: impressions per listing over the window."""
    return (unnest_impressions(search_logs, as_of, days).groupBy("property_id")
            .agg(F.count(F.lit(1)).alias("impression_count")))


def actions(feedback: DataFrame, as_of: str, days: int = BEHAVIOUR_WINDOW_DAYS) -> DataFrame:
    """AGG-02: click / favorite / inquiry counts per listing over the window."""
    _, start = window_bounds(as_of, days)
    fb = time_window_filter(feedback, as_of, days, start=start)
    a = F.col("action")
    return fb.groupBy("property_id").agg(
        F.count_if(a == "click").alias("click_count"),
        F.count_if(a == "favorite").alias("favorite_count"),
        F.count_if(a == "inquiry").alias("inquiry_count"),
    )


def features_left_joins(basics: DataFrame, imps: DataFrame, acts: DataFrame) -> DataFrame:
    """JOIN-01: listings left join impressions left join actions on property_id."""
    return basics.join(imps, "property_id", "left").join(acts, "property_id", "left")


def behaviour_rates(joined: DataFrame) -> DataFrame:
    """AGG-03/04: SAFE_DIVIDE rates (null when either side is missing) and popularity."""
    i = F.col("impression_count")
    ctr = safe_divide(F.col("click_count"), i)
    fav = safe_divide(F.col("favorite_count"), i)
    inq = safe_divide(F.col("inquiry_count"), i)
    pop = (F.lit(0.4) * F.coalesce(ctr, F.lit(0.0)) + F.lit(0.2) * F.coalesce(fav, F.lit(0.0))
           + F.lit(0.2) * F.coalesce(inq, F.lit(0.0)))
    return joined.withColumns({"ctr": ctr, "fav_rate": fav, "inquiry_rate": inq, "popularity_score": pop})


def feature_mart(properties_raw: DataFrame, search_logs: DataFrame, feedback: DataFrame,
                 as_of: str, days: int = BEHAVIOUR_WINDOW_DAYS, clean: bool = True) -> DataFrame:
    """property_features_daily for the local date of ``as_of``.

    ``clean=False`` builds the same rows from the raw listing columns, which is
    what the row-level quality gate (VAL-01) inspects.
    """
    event_date, _ = window_bounds(as_of, days)
    if clean:
        basics = clean_listing_numbers(properties_raw)
    else:
        basics = properties_raw.select("property_id", "rent", "walk_min", "age_years",
                                       F.col("area_m2").cast("double").alias("area_m2"))
    joined = features_left_joins(basics, impressions(search_logs, as_of, days),
                                 actions(feedback, as_of, days))
    return behaviour_rates(joined).select(event_date.alias("event_date"), *FEATURE_MART_COLUMNS[1:])


def latest_partition(features: DataFrame) -> DataFrame:
    """JOIN-07: rows at the global MAX(event_date) (a scalar subquery, not per id)."""
    latest = features.agg(F.max("event_date")).scalar()
    return features.filter(F.col("event_date") == latest)


def local_day_filter(df: DataFrame, run_date: Column, ts: str = "ts") -> DataFrame:
    """PRJ-07: rows whose Tokyo-local date equals ``run_date``.

    The day is also given as a range of UTC instants, which the scan can push down.
    """
    start = F.to_utc_timestamp(run_date.cast("timestamp_ntz").cast("timestamp"), LOCAL_TZ).cast("timestamp_ntz")
    end = F.to_utc_timestamp(F.date_add(run_date, 1).cast("timestamp_ntz").cast("timestamp"), LOCAL_TZ).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end) & (local_date(F.col(ts)) == run_date))


def schema_version_filter(ranking_log: DataFrame, min_version: int = 2) -> DataFrame:
    """PRJ-08: logged rows of schema >= 2 with both ranks present."""
    return ranking_log.filter((F.col("schema_version") >= min_version)
                              & F.col("lexical_rank").isNotNull() & F.col("semantic_rank").isNotNull())
