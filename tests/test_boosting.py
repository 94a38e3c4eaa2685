"""The boosting loop over blocks: gradients against plain loops, the same trees under any blocks, no shuffle in a round."""

import math

import numpy as np

from lodestar.operators import hist_trees, ltr_train
from lodestar.sources.synthetic import synthetic_ranking_frame
from lodestar.session import conf_override

PARAMS = {"min_data_in_leaf": 2, "learning_rate": 0.3, "bagging_fraction": 0.7, "bagging_freq": 2}


def slow_gradients(label, score, pool_rank, truncation):
    """One request, pair by pair."""
    rows = sorted(range(len(label)), key=lambda k: (-score[k], pool_rank[k]))
    gain = [2.0 ** x - 1 for x in label]
    best = sum(g / math.log2(p + 2) for p, g in enumerate(sorted(gain, reverse=True)[:truncation]))
    grad, hess, total = [0.0] * len(label), [0.0] * len(label), 0.0
    for p in range(min(truncation, len(rows))):
        for q in range(p + 1, len(rows)):
            a, b = rows[p], rows[q]
            if best <= 0 or label[a] == label[b]:
                continue
            hi, lo = (a, b) if label[a] > label[b] else (b, a)
            delta = abs(gain[a] - gain[b]) * abs(1 / math.log2(p + 2) - 1 / math.log2(q + 2)) / best
            rho = 1 / (1 + math.exp(score[hi] - score[lo]))
            grad[hi] -= rho * delta
            grad[lo] += rho * delta
            hess[hi] += rho * (1 - rho) * delta
            hess[lo] += rho * (1 - rho) * delta
            total += 2 * rho * delta
    z = math.log2(1 + total) / total if total > 0 else 1.0
    return [g * z for g in grad], [h * z for h in hess]


def test_gradients_of_many_requests_at_once():
    rng = np.random.default_rng(2)
    sizes = [1, 5, 30, 2, 1, 12]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    n = int(starts[-1])
    label, score, rank = rng.integers(0, 4, n), np.round(rng.normal(size=n), 1), rng.permutation(n)
    label[starts[3]:starts[4]] = 0
    grad, hess = ltr_train._gradients(starts, label, score, rank, 20)
    for a, b in zip(starts[:-1], starts[1:]):
        g, h = slow_gradients(label[a:b].tolist(), score[a:b].tolist(), rank[a:b].tolist(), 20)
        assert np.allclose(grad[a:b], g, atol=1e-12) and np.allclose(hess[a:b], h, atol=1e-12)


def _train(spark, rounds, valid=True):
    train, test = synthetic_ranking_frame(spark, n_queries=40, candidates=15, seed=3)
    return ltr_train.train_lambdarank(train, test if valid else None, {**PARAMS, "num_iterations": rounds}, checkpoint_every=2)


def test_the_same_trees_under_any_blocks(spark):
    with conf_override(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000"}):
        one = _train(spark, 3)
    with conf_override(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        many = _train(spark, 3)
    assert [t.root for t in one.trees] == [t.root for t in many.trees]
    assert len(one.history) == 3 and [h[1] is None for h in one.history] == [True, False, True]
    assert np.allclose([h[2:] for h in one.history], [h[2:] for h in many.history], atol=1e-12)
    assert [t.root for t in _train(spark, 3, valid=False).trees] == [t.root for t in one.trees]


def test_history_is_the_ndcg_of_the_saved_scores(spark):
    from pyspark.sql import functions as F

    from lodestar.operators import ltr
    _, test = synthetic_ranking_frame(spark, n_queries=40, candidates=15, seed=3)
    model = _train(spark, 2)
    for r in (1, 2):
        scored = test.withColumn("score", model.score_column(r))
        m = ltr.per_request_metrics(scored, F.col("score"), F.col("pool_rank")).agg(F.avg("ndcg_at_10")).first()[0]
        assert abs(model.history[r - 1][3] - m) < 1e-9


def test_a_round_is_one_job_and_one_for_each_step_of_its_tree(spark, monkeypatch):
    """More rounds add no other jobs than these and a checkpoint: no plan and no exchange per step."""
    measure, steps, tracker, jobs = hist_trees._measure, [], spark.sparkContext.statusTracker(), []
    monkeypatch.setattr(hist_trees, "_measure", lambda *args: (steps.append(1), measure(*args)))
    for rounds in (1, 3):
        steps.clear()
        spark.sparkContext.setJobGroup(f"boosting-{rounds}", "")
        _train(spark, rounds)
        jobs.append(len(tracker.getJobIdsForGroup(f"boosting-{rounds}")) - len(steps))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] - jobs[0] <= 2 + 1
