"""Learning-to-rank frames and ranking metrics (AGG-05/06, JOIN-04, LTR-01/02/06/07, WIN-06..09).

Per-request work is partitioned by ``request_id``; a request's rows are a logged
candidate pool, bounded by the pool size (TOP-02), so one request never grows
with the table. Metrics use one window per request plus one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.columns import days_before, label_gain, stable_bucket, ts_lit
from lodestar.functions.vocab import FEATURE_COLS, LISTING_FEATURES, TRAINING_WINDOW_DAYS


def strongest_label(feedback: DataFrame, start: Column | None = None,
                    end: Column | None = None) -> DataFrame:
    """AGG-05: strongest action per (request, listing): inquiry 3 > favorite 2 > click 1 > 0."""
    fb = feedback
    if start is not None:
        fb = fb.filter(F.col("ts") >= start)
    if end is not None:
        fb = fb.filter(F.col("ts") <= end)
    return (fb.groupBy("request_id", "property_id")
            .agg(F.max(label_gain(F.col("action"))).cast("bigint").alias("label")))


def label_left_join(ranking: DataFrame, labels: DataFrame) -> DataFrame:
    """JOIN-04: every ranked row keeps its place; unlabelled rows get label 0."""
    return (ranking.join(labels, ["request_id", "property_id"], "left")
            .withColumn("label", F.coalesce(F.col("label"), F.lit(0)).cast("bigint")))


def flatten_features(ranking: DataFrame) -> DataFrame:
    """PRJ-03: nested ``features.*`` as top-level columns (nested pruning applies)."""
    return ranking.select("*", *[F.col(f"features.{c}").alias(c) for c in FEATURE_COLS]).drop("features")


def training_frame(ranking_log: DataFrame, feedback: DataFrame, as_of: str,
                   window_days: int = TRAINING_WINDOW_DAYS) -> DataFrame:
    """LTR-01: labelled rows of the last ``window_days`` (both sides), rent present.

    Selects all ten vocabulary features, semantic_rank included; ``pool_rank``
    (the integer lexical rank) is the frame order within a request.
    """
    now = ts_lit(as_of)
    start = days_before(now, window_days)
    r = (ranking_log.filter((F.col("ts") >= start) & (F.col("ts") <= now))
         .filter(F.col("features.rent").isNotNull())
         .select("request_id", "property_id", F.col("lexical_rank").alias("pool_rank"),
                 *[F.col(f"features.{c}").alias(c) for c in FEATURE_COLS]))
    labels = strongest_label(feedback, start, now)
    return label_left_join(r, labels)


def ranker_features(frame: DataFrame) -> DataFrame:
    """PRJ-04: ordered 10-column vector; missing listing features -> 0.0, ranks as double."""
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in LISTING_FEATURES
            else F.col(c).cast("double").alias(c) for c in FEATURE_COLS]
    keep = [c for c in frame.columns if c not in FEATURE_COLS]
    return frame.select(*keep, *cols)


def feature_matrix(frame: DataFrame, out: str = "feature_vector") -> DataFrame:
    """PRJ-05: dense vector (array<double>) in vocabulary order."""
    feats = ranker_features(frame)
    return feats.select(*[c for c in feats.columns if c not in FEATURE_COLS],
                        F.array(*[F.col(c) for c in FEATURE_COLS]).alias(out))


def group_split(frame: DataFrame, train_buckets: int = 8, buckets: int = 10,
                bucket: Column | None = None) -> DataFrame:
    """LTR-02: request-level split; a request is wholly train or wholly test."""
    b = bucket if bucket is not None else stable_bucket(F.col("request_id"), buckets)
    return frame.withColumn("split", F.when(b < train_buckets, "train").otherwise("test"))


def group_sizes(frame: DataFrame) -> DataFrame:
    """AGG-06: rows per request."""
    return frame.groupBy("request_id").agg(F.count(F.lit(1)).alias("group_size"))


def group_boundaries(frame: DataFrame, order: str = "pool_rank") -> DataFrame:
    """WIN-09: position in group, group size and group-start flag under the frame order."""
    w = Window.partitionBy("request_id").orderBy(order)
    return (frame.withColumn("pos_in_group", F.row_number().over(w).cast("bigint"))
            .withColumn("group_size", F.count(F.lit(1)).over(Window.partitionBy("request_id")))
            .withColumn("is_group_start", F.lag("request_id").over(w).isNull()))


def ranked(frame: DataFrame, score: Column, tie: Column) -> DataFrame:
    """Position by score desc, ties kept in frame order (stable sort)."""
    w = Window.partitionBy("request_id").orderBy(F.col("_s").desc(), F.col("_t").asc())
    return (frame.select("request_id", F.col("label").cast("bigint").alias("_l"),
                         score.alias("_s"), tie.alias("_t"))
            .withColumn("_pos", F.row_number().over(w))
            .withColumn("_rel", (F.col("_l") > 0).cast("bigint"))
            .withColumn("_cumrel", F.sum("_rel").over(
                w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))


def ideal_dcg(k: int) -> Column:
    """Ideal DCG@k from label counts (labels are gains 0..3): best labels first."""
    n3, n2, n1 = F.col("_n3"), F.col("_n2"), F.col("_n1")
    top = F.least(F.lit(k).cast("bigint"), n3 + n2 + n1)
    seq = F.sequence(F.lit(1).cast("bigint"), top)

    def step(acc, i):
        gain = F.when(i <= n3, 7.0).when(i <= n3 + n2, 3.0).otherwise(1.0)
        return acc + gain / F.log2(i + 1)
    return F.when(top > 0, F.aggregate(seq, F.lit(0.0), step)).otherwise(F.lit(0.0))


def per_request_metrics(frame: DataFrame, score: Column | None = None, tie: Column | None = None,
                        k_ndcg: int = 10, k_recall: int = 20) -> DataFrame:
    """WIN-06/07/08: NDCG@k, average precision and recall@k for every request.

    ``frame`` needs request_id, label and the score/tie columns (defaults:
    ``score`` desc, then ``lexical_rank``).
    """
    score = score if score is not None else F.col("score")
    tie = tie if tie is not None else F.col("lexical_rank")
    r = ranked(frame, score, tie)
    gain = F.pow(F.lit(2.0), F.col("_l")) - 1
    g = r.groupBy("request_id").agg(
        F.sum(F.when(F.col("_pos") <= k_ndcg, gain / F.log2(F.col("_pos") + 1))
              .otherwise(0.0)).alias("_dcg"),
        F.sum("_rel").alias("_nrel"),
        F.sum(F.when(F.col("_rel") == 1, F.col("_cumrel") / F.col("_pos")).otherwise(0.0)).alias("_ap"),
        F.sum(F.when(F.col("_pos") <= k_recall, F.col("_rel")).otherwise(0)).alias("_hits"),
        F.count_if(F.col("_l") >= 3).alias("_n3"),
        F.count_if(F.col("_l") == 2).alias("_n2"),
        F.count_if(F.col("_l") == 1).alias("_n1"),
        F.count(F.lit(1)).alias("n_candidates"),
    )
    idcg = ideal_dcg(k_ndcg)
    return g.select(
        "request_id",
        F.when(idcg > 0, F.col("_dcg") / idcg).otherwise(0.0).alias(f"ndcg_at_{k_ndcg}"),
        F.when(F.col("_nrel") > 0, F.col("_ap") / F.col("_nrel")).otherwise(0.0).alias("average_precision"),
        F.when(F.col("_nrel") > 0, F.col("_hits") / F.col("_nrel")).otherwise(0.0).alias(f"recall_at_{k_recall}"),
        F.col("_nrel").cast("bigint").alias("n_relevant"),
        F.col("n_candidates").cast("bigint"),
    )


def evaluate(per_request: DataFrame, k_ndcg: int = 10, k_recall: int = 20) -> DataFrame:
    """AGG-15: means over requests rounded to 4 decimals; no requests -> zeros."""
    return per_request.agg(
        F.coalesce(F.round(F.avg(f"ndcg_at_{k_ndcg}"), 4), F.lit(0.0)).alias(f"ndcg_at_{k_ndcg}"),
        F.coalesce(F.round(F.avg("average_precision"), 4), F.lit(0.0)).alias("map"),
        F.coalesce(F.round(F.avg(f"recall_at_{k_recall}"), 4), F.lit(0.0)).alias(f"recall_at_{k_recall}"),
        F.count(F.lit(1)).alias("n_queries"),
    )


def labelled_log(ranking_log: DataFrame, feedback: DataFrame) -> DataFrame:
    """Every logged candidate with its strongest label (all feedback)."""
    r = ranking_log.select("request_id", "property_id", "lexical_rank", "semantic_rank",
                           "rrf_rank", "final_rank", "score")
    return label_left_join(r, strongest_label(feedback))


def evaluate_ranking(frame: DataFrame, score: Column | None = None, tie: Column | None = None,
                     k_ndcg: int = 10, k_recall: int = 20) -> DataFrame:
    """LTR-06: per-request metrics then their means, one row."""
    return evaluate(per_request_metrics(frame, score, tie, k_ndcg, k_recall), k_ndcg, k_recall)


def fallback_vs_rerank(frame: DataFrame, k_ndcg: int = 10, k_recall: int = 20) -> DataFrame:
    """LTR-07: the same logged pools evaluated under both ranking regimes.

    fallback orders by lexical rank; rerank by the logged model score (ties in
    pool order). The regimes share one scan; each is one window + aggregate.
    """
    fallback = evaluate_ranking(frame, -F.col("lexical_rank"), F.col("lexical_rank"), k_ndcg, k_recall)
    rerank = evaluate_ranking(frame, F.col("score"), F.col("lexical_rank"), k_ndcg, k_recall)
    return (fallback.select(F.lit("fallback").alias("regime"), "*")
            .unionByName(rerank.select(F.lit("rerank").alias("regime"), "*")))


def request_count(frame: DataFrame) -> DataFrame:
    """AGG-14: rows and distinct requests of a frame."""
    return frame.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.countDistinct("request_id").alias("n_requests"))


def train_test_overlap(split_frame: DataFrame) -> DataFrame:
    """SET-03: request ids present on both sides (must be empty)."""
    train = split_frame.filter(F.col("split") == "train").select("request_id")
    test = split_frame.filter(F.col("split") == "test").select("request_id")
    return train.intersect(test)


def training_order(frame: DataFrame) -> DataFrame:
    """TOP-07: rows of a request together, in lexical order, without a global sort."""
    return frame.repartition("request_id").sortWithinPartitions("request_id", "pool_rank")
