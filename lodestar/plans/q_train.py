"""Queries: LambdaRank training, scoring, importances, the training pipeline (no exact oracle), and one boosting round with its oracles.

Training uses the full parameters (500 rounds, early stopping after 30) on the
given tables. ``lambdarank_train`` and ``training_pipeline`` always train; the
queries that only use a model load the one that this session last saved for the
same tables, and train when there is none.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.vocab import FEATURE_COLS, LAMBDARANK_PARAMS, LISTING_FEATURES
from lodestar.operators import hist_trees, ltr, ltr_train, sinks
from lodestar.plans.q_features import _sink_dir
from lodestar.plans.q_ltr import FRAME_SQL, frame
from lodestar.plans.registry import query


_SAVED: dict[tuple, tuple] = {}  # (application, tables) -> (model path, its run row)


def _trained(spark, d):
    """(run row, model) of a new training; the model is saved."""
    row, model = ltr_train.training_pipeline(frame(spark, d), run_id="check", model_dir=_sink_dir(spark, "models"))
    run = row.first().asDict()
    row = spark.createDataFrame([run], row.schema)
    _SAVED[spark.sparkContext.applicationId, d] = (run["model_path"], row)
    return row, model


def _model(spark, d):
    """(run row, model) last saved for these tables, loaded; trained when there is none."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SAVED:
        _trained(spark, d)
    path, row = _SAVED[key]
    return row, ltr_train.LambdaRankModel.load(spark, path)


@query("lambdarank_train")
def q_train(spark, d):
    """LTR-03: per-round validation NDCG@5, @10 and @20 of the boosted trees, from the saved model."""
    row, _ = _trained(spark, d)
    lines = spark.read.text(row.first()["model_path"])
    head = lines.select(F.from_json("value", "i int, history array<array<double>>").alias("h")).where("h.i = -1")
    h = head.select(F.explode("h.history").alias("x"))
    return h.select(F.get("x", F.lit(0)).cast("int").alias("iteration"), F.get("x", F.lit(1)).alias("train_ndcg_at_10"),
                    *[F.get("x", F.lit(2 + i)).alias(f"valid_ndcg_at_{k}") for i, k in enumerate(ltr_train.EVAL_AT)])


@query("rerank_score")
def q_rerank_score(spark, d):
    """LTR-04: score of every candidate of the training frame by the model, saved and loaded."""
    _, model = _model(spark, d)
    f = ltr.ranker_features(frame(spark, d))
    return ltr_train.rerank_score(f, model).select("request_id", "property_id", "score")


@query("feature_importance")
def q_importance(spark, d):
    """LTR-05: normalised gain per feature."""
    _, model = _model(spark, d)
    return ltr_train.feature_importance(spark, model)


@query("training_pipeline")
def q_pipeline(spark, d):
    """LTR-08: split, train, evaluate on the held-out requests, gate; the run row, appended and read back."""
    row, _ = _trained(spark, d)
    path = _sink_dir(spark, "runs")
    sinks.append_run(row, path)
    run = spark.read.parquet(path)
    return run.select("run_id", "started_at", "finished_at", "model_path", "git_sha", "metrics.*", "hyperparams.*")


@query("write_training_artifacts")
def q_artifacts(spark, d):
    """SNK-09: model, metrics JSON and feature-importance CSV written; the CSV read back."""
    row, model = _model(spark, d)
    path = _sink_dir(spark, "training_artifacts")
    sinks.write_training_artifacts(row, ltr_train.feature_importance(spark, model), path)
    return spark.read.option("header", True).schema("feature string, gain double").csv(f"{path}/feature_importance")


# --- one boosting round, started from the semantic score, against SQL ----------------

GRADIENT_SQL = FRAME_SQL + """,
pos AS MATERIALIZED (
  SELECT request_id, pool_rank, label, """ + ", ".join(
    (f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" if c in LISTING_FEATURES else f"CAST({c} AS DOUBLE) AS {c}") for c in FEATURE_COLS) + """,
         me5_score AS s, pow(2, label) - 1 AS gain,
         row_number() OVER (PARTITION BY request_id ORDER BY me5_score DESC, pool_rank) - 1 AS p,
         row_number() OVER (ORDER BY request_id, pool_rank) AS rid
  FROM frame),
ideal AS (
  SELECT request_id, sum(gain / log2(ip + 1)) AS m
  FROM (SELECT request_id, gain, row_number() OVER (PARTITION BY request_id ORDER BY label DESC) AS ip FROM pos)
  WHERE ip <= 20 GROUP BY request_id),
prefs AS (
  SELECT a.request_id, a.p AS i, b.p AS j, CASE WHEN a.label > b.label THEN 1 ELSE -1 END AS w,
         1 / (1 + exp(CASE WHEN a.label > b.label THEN a.s - b.s ELSE b.s - a.s END)) AS rho,
         abs(a.gain - b.gain) * abs(1 / log2(a.p + 2) - 1 / log2(b.p + 2)) / m AS delta
  FROM pos a JOIN pos b ON a.request_id = b.request_id AND a.p < 20 AND b.p > a.p AND a.label <> b.label
  JOIN ideal ON ideal.request_id = a.request_id WHERE m > 0),
norm AS (
  SELECT request_id, CASE WHEN sum(rho * delta) > 0 THEN log2(1 + 2 * sum(rho * delta)) / (2 * sum(rho * delta)) ELSE 1 END AS z
  FROM prefs GROUP BY request_id),
sides AS (
  SELECT request_id, i AS p, -w * rho * delta AS g, rho * (1 - rho) * delta AS h FROM prefs
  UNION ALL SELECT request_id, j, w * rho * delta, rho * (1 - rho) * delta FROM prefs),
summed AS (SELECT request_id, p, sum(g) AS g, sum(h) AS h FROM sides GROUP BY request_id, p),
grads AS MATERIALIZED (
  SELECT pos.*, coalesce(summed.g * z, 0) AS grad, coalesce(summed.h * z, 0) AS hess
  FROM pos LEFT JOIN summed ON summed.request_id = pos.request_id AND summed.p = pos.p
  LEFT JOIN norm ON norm.request_id = pos.request_id)
"""

EDGES_SQL = """,
long AS MATERIALIZED (""" + " UNION ALL ".join(f"SELECT rid, {i} AS f, {c} AS x FROM grads" for i, c in enumerate(FEATURE_COLS)) + """),
edges AS MATERIALIZED (
  SELECT f, x AS e, row_number() OVER (PARTITION BY f ORDER BY x) - 1 AS b
  FROM (SELECT DISTINCT f, x
        FROM (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS rn, count(*) OVER (PARTITION BY f) AS n,
                     max(x) OVER (PARTITION BY f) AS mx FROM long)
        JOIN (SELECT unnest(range(1, 256)) AS k) ON rn = ceil(k / 256.0::DOUBLE * n)
        WHERE x < mx))
"""


def _tree_sql(num_leaves: int, min_rows: int) -> str:
    """Best-first growth unrolled: per split, histograms of all leaves, the best split, the new leaves."""
    parts = ["""
bins AS (SELECT v.f, v.x, count(e) AS b FROM (SELECT DISTINCT f, x FROM long) v LEFT JOIN edges ON edges.f = v.f AND e < v.x GROUP BY v.f, v.x),
rows_ AS MATERIALIZED (
  SELECT long.rid, long.f, bins.b, CAST(floor(grad * 16777216 + 0.5) AS BIGINT) AS g, CAST(floor(hess * 16777216 + 0.5) AS BIGINT) AS h
  FROM long JOIN bins ON bins.f = long.f AND bins.x = long.x JOIN grads ON grads.rid = long.rid),
a0 AS MATERIALIZED (SELECT rid, 0 AS leaf FROM grads)"""]
    for t in range(num_leaves - 1):
        parts.append(f"""
h{t} AS (SELECT leaf, f, b, sum(g) AS g, sum(h) AS h, count(*) AS n FROM rows_ JOIN a{t} USING (rid) GROUP BY leaf, f, b),
c{t} AS (SELECT leaf, f, b, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(n) OVER w AS ln,
                sum(g) OVER v AS tg, sum(h) OVER v AS th, sum(n) OVER v AS tn
         FROM h{t} WINDOW w AS (PARTITION BY leaf, f ORDER BY b), v AS (PARTITION BY leaf, f)),
g{t} AS (SELECT *, CAST(lg AS DOUBLE) * CAST(lg AS DOUBLE) / CAST(lh AS DOUBLE)
                 + CAST(tg - lg AS DOUBLE) * CAST(tg - lg AS DOUBLE) / CAST(th - lh AS DOUBLE)
                 - CAST(tg AS DOUBLE) * CAST(tg AS DOUBLE) / CAST(th AS DOUBLE) AS gain
         FROM c{t} WHERE ln >= {min_rows} AND tn - ln >= {min_rows} AND lh >= 0.001 * 16777216 AND th - lh >= 0.001 * 16777216),
s{t} AS MATERIALIZED (SELECT {t} AS split_no, * FROM g{t} WHERE gain > 0 ORDER BY gain DESC, leaf, f, b LIMIT 1),
a{t + 1} AS MATERIALIZED (
  SELECT a.rid, CASE WHEN a.leaf = x.leaf AND x.b > x.cut THEN {t + 1} ELSE a.leaf END AS leaf
  FROM a{t} a LEFT JOIN (SELECT r.rid, r.b, s.leaf, s.b AS cut FROM rows_ r JOIN s{t} s ON s.f = r.f) x ON x.rid = a.rid)""")
    chosen = " UNION ALL ".join(f"SELECT * FROM s{t}" for t in range(num_leaves - 1))
    names = "[" + ", ".join(f"'{c}'" for c in FEATURE_COLS) + "]"
    return ",".join(parts) + f"""
SELECT CAST(split_no AS INTEGER) AS split_no, CAST(leaf AS INTEGER) AS leaf, {names}[x.f + 1] AS feature, e AS threshold,
       round(gain / 16777216, 6) AS gain, CAST(lg AS BIGINT) AS left_gradient, CAST(lh AS BIGINT) AS left_hessian,
       CAST(ln AS BIGINT) AS left_rows, CAST(tn - ln AS BIGINT) AS right_rows
FROM ({chosen}) x JOIN edges ON edges.f = x.f AND edges.b = x.b"""


def _round_frame(spark, d):
    return ltr.ranker_features(frame(spark, d)).withColumn("score", F.col("me5_score"))


def _exact_edges(f):
    """Quantiles without rank error up to a million rows, as the oracle's."""
    return hist_trees.quantile_edges(f, FEATURE_COLS, accuracy=1_000_000)


@query("lambda_gradients", GRADIENT_SQL + "SELECT request_id, pool_rank, round(grad, 6) AS grad, round(hess, 6) AS hess FROM grads",
       ("ranking_log", "feedback_events"))
def q_lambda_gradients(spark, d):
    """LTR-03, first step of a round: gradient and hessian of every logged candidate, starting from the semantic score."""
    g = ltr_train.lambda_gradients(_round_frame(spark, d), truncation=int(LAMBDARANK_PARAMS["lambdarank_truncation_level"]))
    return g.select("request_id", "pool_rank", F.round("grad", 6).alias("grad"), F.round("hess", 6).alias("hess"))


@query("feature_bins", GRADIENT_SQL + EDGES_SQL + "SELECT ["
       + ", ".join(f"'{c}'" for c in FEATURE_COLS) + "][f + 1] AS feature, CAST(b AS INTEGER) AS bin, e AS upper_edge FROM edges",
       ("ranking_log", "feedback_events"))
def q_feature_bins(spark, d):
    """LTR-03: the quantile edges that bin the ten features."""
    edges = _exact_edges(_round_frame(spark, d))
    return spark.createDataFrame([(c, b, x) for c, e in edges.items() for b, x in enumerate(e)], "feature string, bin int, upper_edge double")


@query("histogram_tree", GRADIENT_SQL + EDGES_SQL + "," + _tree_sql(LAMBDARANK_PARAMS["num_leaves"], LAMBDARANK_PARAMS["min_data_in_leaf"]),
       ("ranking_log", "feedback_events"))
def q_histogram_tree(spark, d):
    """LTR-03, second step of a round: the splits of the best-first tree of 31 leaves over all rows, in the order chosen."""
    f = _round_frame(spark, d)
    edges = _exact_edges(f)
    rows = hist_trees.binned(f.select("request_id", "pool_rank", "label", "score", *FEATURE_COLS), edges)
    g = ltr_train.lambda_gradients(rows, truncation=int(LAMBDARANK_PARAMS["lambdarank_truncation_level"]))
    data = g.select(hist_trees.fixed_point(F.col("grad")).alias("_g"), hist_trees.fixed_point(F.col("hess")).alias("_h"), *FEATURE_COLS).persist()
    tree = hist_trees.grow_tree(data, FEATURE_COLS, int(LAMBDARANK_PARAMS["num_leaves"]), int(LAMBDARANK_PARAMS["min_data_in_leaf"]))
    data.unpersist()
    out = [(no, leaf, FEATURE_COLS[c], edges[FEATURE_COLS[c]][b], round(gain / hist_trees.SCALE, 6), int(left[0]), int(left[1]), int(left[2]), int(right[2]))
           for no, leaf, c, b, gain, left, right in tree.splits]
    return spark.createDataFrame(out, "split_no int, leaf int, feature string, threshold double, gain double, left_gradient bigint, "
                                      "left_hessian bigint, left_rows bigint, right_rows bigint")
