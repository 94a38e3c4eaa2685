"""Domain tables derived from the driver tables (see FIXTURES.md, part B).

The reference's tables (listings, ranking log, feedback, runs, ...) are not in
the driver data, so each one is a deterministic Spark derivation of the TPC-H-ish
tables. All are lazy; every operator reads them as ordinary DataFrames. The
DuckDB twins of these definitions live in ``lodestar.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions.columns import passage_text, text_hash, ts_lit
from lodestar.sources.tables import read

# --- fixed values: fixture clock and constants ----------------------------------
AS_OF = "2001-07-15 12:00:00"          # relational domain "now" (UTC)
STREAM_AS_OF = "2024-01-31 00:00:00"   # event domain "now" (UTC)
MODEL_NAME = "e5-base"
RANKER_MODEL_PATH = "models/ranker-v2"
LISTING_CREATED_AT = "2001-01-01 00:00:00"
EMBEDDED_AT = "2001-07-01 00:00:00"
LAYOUTS = ["1K", "1LDK", "2LDK", "3LDK"]


def _pid(key: Column) -> Column:
    return F.concat(F.lit("P"), key.cast("string"))


def _rid(key: Column) -> Column:
    return F.concat(F.lit("R"), key.cast("string"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing attributes (no text) from ``part``."""
    k = F.col("p_partkey")
    layout = F.when(k % 4 == 0, LAYOUTS[0]).when(k % 4 == 1, LAYOUTS[1]) \
        .when(k % 4 == 2, LAYOUTS[2]).otherwise(LAYOUTS[3])
    return read(spark, sf_dir, "part").select(
        _pid(k).alias("property_id"),
        k,
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("city"),
        F.col("p_type").alias("ward"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(
            F.round(F.col("p_retailprice") * 100).cast("bigint")).cast("bigint").alias("rent"),
        F.when(k % 5 == 0, F.lit(None)).otherwise((k % 7) * 1000).cast("bigint").alias("management_fee"),
        layout.alias("layout"),
        (F.col("p_size") * 2.5).alias("area_m2"),
        F.when(k % 19 == 0, F.lit(None)).otherwise(k % 60 - 3).cast("bigint").alias("age_years"),
        F.when(k % 23 == 0, F.lit(None)).otherwise(F.col("p_size").cast("bigint") - 2).cast("bigint").alias("walk_min"),
        F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("pet_ok"),
        ts_lit(LISTING_CREATED_AT).alias("created_at"),
        ts_lit(LISTING_CREATED_AT).alias("updated_at"),
    )


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings with their description text (``part`` left join ``documents``)."""
    docs = read(spark, sf_dir, "documents", spread=True).select(
        F.col("doc_id").alias("p_partkey"), F.col("text").alias("description"))
    return listings(spark, sf_dir).join(docs, "p_partkey", "left").select(
        "property_id", "title", "description", "city", "ward", "rent", "management_fee",
        "layout", "area_m2", "age_years", "walk_min", "pet_ok", "created_at", "updated_at")


#: Requests of a stretch of time that are sent to every task; more meet the tables in a shuffle.
MAX_BROADCAST_REQUESTS = 1_000_000


def asked_between(spark: SparkSession, sf_dir: str, between: tuple[Column, Column], key: str) -> DataFrame:
    """Order keys (as ``key``) with an order at an instant of ``between``, both ends included."""
    asked = (read(spark, sf_dir, "orders").filter((F.col("o_orderdate") >= between[0]) & (F.col("o_orderdate") <= between[1]))
             .select(F.col("o_orderkey").alias(key)).distinct())
    return F.broadcast(asked) if asked.count() <= MAX_BROADCAST_REQUESTS else asked


def pairs(spark: SparkSession, sf_dir: str, between: tuple[Column, Column] | None = None) -> DataFrame:
    """One lineitem per (order, part), joined to its order.

    Partitioned by order key once; the dedup window and every per-request
    window downstream reuse that partitioning. ``between``: whole requests
    that were asked then, kept before anything is shuffled.
    """
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        (F.col("l_discount") + F.lit(0.0)).alias("l_discount"),   # folds -0.0 into 0.0
        (F.col("l_tax") + F.lit(0.0)).alias("l_tax"),
        "l_returnflag", "l_linestatus", "l_shipdate")
    first = F.row_number().over(
        Window.partitionBy("l_orderkey", "l_partkey").orderBy(
            "l_linenumber", "l_extendedprice", "l_suppkey", "l_quantity", "l_discount",
            "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"))
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_totalprice",
        "o_orderpriority")
    if between:
        asked = asked_between(spark, sf_dir, between, "l_orderkey")
        li, orders = li.join(asked, "l_orderkey", "left_semi"), orders.join(asked, "l_orderkey", "left_semi")
    return (li.repartition("l_orderkey").withColumn("_first", first)
            .filter(F.col("_first") == 1).drop("_first", "l_shipdate")
            .join(orders, "l_orderkey"))


def ranking_log(spark: SparkSession, sf_dir: str, between: tuple[Column, Column] | None = None) -> DataFrame:
    """Logged candidate pools: one row per (request, listing), nested 10-field features."""
    req = Window.partitionBy("l_orderkey")
    in_sem = F.col("l_quantity") <= 45
    k = F.col("l_partkey")
    p = pairs(spark, sf_dir, between)
    p = p.withColumn("lexical_rank", F.row_number().over(
        req.orderBy(F.desc("l_extendedprice"), "l_partkey")).cast("bigint"))
    p = p.withColumn("semantic_rank", F.when(in_sem, F.row_number().over(
        Window.partitionBy(F.col("l_orderkey"), in_sem).orderBy("l_discount", "l_partkey")))
        .otherwise(F.lit(10000)).cast("bigint"))
    rrf = F.lit(1.0) / (F.lit(60) + F.col("lexical_rank")) + F.when(
        F.col("semantic_rank") < 10000, F.lit(1.0) / (F.lit(60) + F.col("semantic_rank"))).otherwise(F.lit(0.0))
    p = p.withColumn("_rrf", rrf)
    p = p.withColumn("rrf_rank", F.row_number().over(
        req.orderBy(F.desc("_rrf"), "lexical_rank", "semantic_rank")).cast("bigint"))
    p = p.withColumn("final_rank", F.row_number().over(
        req.orderBy(F.desc("l_tax"), "rrf_rank")).cast("bigint"))
    p = p.withColumn("me5_score", F.lit(1.0) - F.lit(5.0) * F.col("l_discount"))
    nums = listings(spark, sf_dir).select(
        F.col("p_partkey").alias("l_partkey"), "rent", "walk_min", "age_years", "area_m2")
    p = p.join(nums, "l_partkey", "left")
    features = F.struct(
        F.col("rent").cast("double").alias("rent"),
        F.col("walk_min").cast("double").alias("walk_min"),
        F.col("age_years").cast("double").alias("age_years"),
        F.col("area_m2").cast("double").alias("area_m2"),
        F.when(k % 11 == 0, F.lit(None)).otherwise((k % 50) / 100.0).cast("double").alias("ctr"),
        ((k % 20) / 200.0).alias("fav_rate"),
        F.when(k % 9 == 0, F.lit(None)).otherwise((k % 10) / 500.0).cast("double").alias("inquiry_rate"),
        F.col("me5_score").alias("me5_score"),
        F.col("lexical_rank").cast("double").alias("lexical_rank"),
        F.col("semantic_rank").cast("double").alias("semantic_rank"),
    )
    return p.select(
        _rid(F.col("l_orderkey")).alias("request_id"),
        F.col("o_orderdate").alias("ts"),
        _pid(k).alias("property_id"),
        F.when(F.col("l_orderkey") % 13 == 0, 1).otherwise(2).cast("bigint").alias("schema_version"),
        "lexical_rank", "semantic_rank", "rrf_rank", "final_rank",
        F.col("l_tax").alias("score"),
        "me5_score",
        features.alias("features"),
        F.lit(RANKER_MODEL_PATH).alias("model_path"),
    )


def feedback_events(spark: SparkSession, sf_dir: str, between: tuple[Column, Column] | None = None) -> DataFrame:
    """Feedback per logged pair; 'view' is an unknown action (label 0, rejected by VAL-02)."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    actions = F.array_compact(F.array(
        F.when(flag.isin("A", "R"), F.lit("click")),
        F.when(flag == "R", F.lit("favorite")),
        F.when((flag == "R") & (status == "O"), F.lit("inquiry")),
        F.when((flag == "N") & (status == "F"), F.lit("view")),
    ))
    return pairs(spark, sf_dir, between).select(
        _rid(F.col("l_orderkey")).alias("request_id"),
        _pid(F.col("l_partkey")).alias("property_id"),
        F.explode(actions).alias("action"),
        F.col("o_orderdate").alias("ts"),
    )


FILTER_STRUCT = ("struct<max_rent:bigint,layout:string,max_walk_min:bigint,"
                 "pet_ok:boolean,max_age:bigint>")


def search_requests(spark: SparkSession, sf_dir: str, between: tuple[Column, Column] | None = None) -> DataFrame:
    """Request attributes of each logged search (query text, top_k, latency)."""
    orders = read(spark, sf_dir, "orders")
    if between:
        orders = orders.join(asked_between(spark, sf_dir, between, "o_orderkey"), "o_orderkey", "left_semi")
    return orders.select(
        _rid(F.col("o_orderkey")).alias("request_id"),
        F.col("o_orderpriority").alias("query"),
        F.lit(None).cast(FILTER_STRUCT).alias("filters"),
        F.lit(20).cast("bigint").alias("top_k"),
        (F.col("o_totalprice") / 1000).alias("latency_ms"),
        F.col("o_orderdate").alias("requested_at"),
    )


def search_logs(spark: SparkSession, sf_dir: str, between: tuple[Column, Column] | None = None) -> DataFrame:
    """search_logs as derived from the ranking log (AGG-18).

    ``between`` leaves out requests that weren't asked then; a few of other instants may stay, so it doesn't
    replace the reader's own filter.
    """
    from lodestar.operators.monitoring import search_logs_from_ranking_log
    return search_logs_from_ranking_log(ranking_log(spark, sf_dir, between), search_requests(spark, sf_dir, between))


def training_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    metrics = F.struct(
        (k % 500).cast("bigint").alias("best_iteration"),
        (F.lit(0.5) + (k % 400) / 1000.0).alias("ndcg_at_10"),
        (F.lit(0.3) + (k % 300) / 1000.0).alias("map"),
        (F.lit(0.6) + (k % 200) / 1000.0).alias("recall_at_20"),
    )
    hyper = F.struct(
        F.lit(31).cast("bigint").alias("num_leaves"),
        F.lit(0.05).alias("learning_rate"),
        F.lit(0.9).alias("feature_fraction"),
        F.lit(0.8).alias("bagging_fraction"),
        F.lit(500).cast("bigint").alias("num_iterations"),
        F.lit(30).cast("bigint").alias("early_stopping_rounds"),
        F.lit(50).cast("bigint").alias("min_data_in_leaf"),
        F.lit(20).cast("bigint").alias("lambdarank_truncation_level"),
    )
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), k.cast("string")).alias("run_id"),
        F.col("o_orderdate").alias("started_at"),
        F.when(k % 500 == 0, F.lit(None)).otherwise(
            F.col("o_orderdate") + F.expr("INTERVAL 2 HOURS")).cast("timestamp_ntz").alias("finished_at"),
        F.concat(F.lit("models/ranker-"), k.cast("string")).alias("model_path"),
        F.concat(F.lit("sha"), F.col("o_custkey").cast("string")).alias("git_sha"),
        F.concat(F.lit("v"), (k % 7).cast("string")).alias("dataset_version"),
        metrics.alias("metrics"),
        hyper.alias("hyperparams"),
    )


def job_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("job_id"),
        F.col("o_orderdate").alias("creation_time"),
        F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("user_email"),
        F.round(F.col("o_totalprice") * 1000000).cast("bigint").alias("total_bytes_processed"),
    )


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log lines from ``events`` (status 500 for error events)."""
    et = F.col("event_type")
    path = (F.when(et == "view", "/properties").when(et.isin("click", "purchase"), "/feedback")
            .when(et == "signup", "/healthz").otherwise("/search"))
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("request_id"),
        F.col("ts"),
        F.lit("GET").alias("method"),
        path.alias("path"),
        F.when(et == "error", 500).otherwise(200).cast("bigint").alias("status"),
        (F.col("value") * 5).alias("latency_ms"),
        F.when((et == "error") & (F.col("user_id") % 4 == 0), "CRITICAL").when(et == "error", "ERROR").otherwise("INFO").alias("severity"),
        F.concat(F.col("user_id").cast("string"), F.lit(":"), et).alias("fingerprint"),
        "user_id", "event_type",
    )


def feedback_stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback messages from ``events``: click->click, purchase->inquiry, signup->favorite."""
    et = F.col("event_type")
    action = (F.when(et == "click", "click").when(et == "purchase", "inquiry")
              .when(et == "signup", "favorite").otherwise(et))
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("request_id"),
        _pid(F.col("event_id") % 1000).alias("property_id"),
        action.alias("action"),
        F.col("ts"),
        F.col("event_id"),
    )


def text_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search requests: benchmark passages as query text plus per-ordinal facet filters."""
    q = F.col("item_id")
    return read(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("Q"), q.cast("string")).alias("query_id"),
        F.col("text").alias("query_text"),
        F.when(q % 2 == 0, F.lit(None)).otherwise(F.lit(95000)).cast("bigint").alias("max_rent"),
        F.when(q % 3 == 0, F.lit("1LDK")).alias("layout"),
        F.when(q % 4 == 1, F.lit(40)).cast("bigint").alias("max_walk_min"),
        F.when(q % 5 == 0, F.lit(True)).alias("pet_ok"),
        F.when(q % 7 == 0, F.lit(40)).cast("bigint").alias("max_age"),
        F.lit(20).cast("bigint").alias("top_k"),
    )


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query vectors for the text queries: embedding ``vec_id = item_id``."""
    qids = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("vec_id"))
    return (read(spark, sf_dir, "embeddings").join(qids, "vec_id", "left_semi")
            .select(F.concat(F.lit("Q"), F.col("vec_id").cast("string")).alias("query_id"),
                    F.col("embedding").cast("array<double>").alias("query_vector")))


def property_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored embeddings; every tenth hash is stale so change detection has work."""
    props = properties(spark, sf_dir).select("property_id", "title", "description")
    emb = read(spark, sf_dir, "embeddings").select(
        _pid(F.col("vec_id")).alias("property_id"), F.col("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    e = emb.join(props, "property_id", "left")
    stale = F.sha2(F.concat(F.lit("stale"), F.col("vec_id").cast("string")), 256)
    return e.select(
        "property_id", "embedding",
        F.when(F.col("vec_id") % 10 == 0, stale).otherwise(
            text_hash(MODEL_NAME, passage_text(F.col("title"), F.col("description")))).alias("text_hash"),
        F.lit(MODEL_NAME).alias("model_name"),
        ts_lit(EMBEDDED_AT).alias("generated_at"),
    )


def embedding_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector corpus (property_id, embedding as double array) straight from ``embeddings``."""
    return read(spark, sf_dir, "embeddings", spread=True).select(
        _pid(F.col("vec_id")).alias("property_id"), F.col("embedding").cast("array<double>").alias("embedding"))
