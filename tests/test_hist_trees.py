"""Histogram trees against a loop that tries every cut of every leaf, and their edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import hist_trees as ht

COLS = ["u", "v"]


def _data(spark, rows):
    return spark.createDataFrame(rows, "u smallint, v smallint, _g bigint, _h bigint")


def slow_tree(rows, num_leaves, min_rows):
    """(leaf, feature, bin, rows on the left) of best-first splits, every leaf searched anew each time."""
    rows = [tuple(int(x) for x in r) for r in rows]
    leaves, out = [rows], []
    while len(leaves) < num_leaves:
        best = None
        for n, leaf in enumerate(leaves):
            g, h = sum(r[2] for r in leaf), sum(r[3] for r in leaf)
            for f in range(2):
                for b in sorted({r[f] for r in leaf}):
                    left = [r for r in leaf if r[f] <= b]
                    right = [r for r in leaf if r[f] > b]
                    lh, rh = sum(r[3] for r in left), sum(r[3] for r in right)
                    if min(len(left), len(right)) < min_rows or min(lh, rh) < ht.MIN_HESSIAN * ht.SCALE:
                        continue
                    lg, rg = float(sum(r[2] for r in left)), float(sum(r[2] for r in right))
                    gain = (lg * lg / lh + rg * rg / rh) - float(g) * float(g) / h
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, n, f, b, left, right)
        if best is None:
            break
        _, n, f, b, left, right = best
        out.append((n, f, b, len(left)))
        leaves[n] = left
        leaves.append(right)
    return out


@pytest.mark.parametrize("seed,num_leaves,min_rows", [(0, 31, 5), (1, 12, 1), (2, 2, 1), (3, 1, 1)])
def test_best_first_tree_is_the_exhaustive_one(spark, seed, num_leaves, min_rows):
    rng = np.random.default_rng(seed)
    n = 400
    u, v = rng.integers(0, 40, n), rng.integers(0, 7, n)
    g = (np.sin(u / 5.0) * (v - 3) * ht.SCALE / 8 + rng.normal(0, ht.SCALE / 20, n)).astype(int)
    h = rng.integers(ht.SCALE // 100, ht.SCALE // 4, n)
    rows = [tuple(int(x) for x in r) for r in zip(u, v, g, h)]
    tree = ht.grow_tree(_data(spark, rows).repartition(5), COLS, num_leaves, min_rows)
    assert [(leaf, f, b, int(left[2])) for _, leaf, f, b, _, left, _ in tree.splits] == slow_tree(rows, num_leaves, min_rows)


def test_the_same_tree_under_any_partitioning(spark):
    rng = np.random.default_rng(5)
    rows = [(int(a), int(b), int(g), int(ht.SCALE // 9)) for a, b, g in zip(rng.integers(0, 9, 300), rng.integers(0, 9, 300), rng.integers(-ht.SCALE, ht.SCALE, 300))]
    trees = [ht.grow_tree(_data(spark, rows).repartition(k), COLS, 15, 3).bin_nodes() for k in (1, 7)]
    assert trees[0] == trees[1]


def test_ties_take_the_first_feature_and_lowest_bin(spark):
    rows = [(0, 0, -10 * ht.SCALE, ht.SCALE), (2, 2, 10 * ht.SCALE, ht.SCALE)] * 3
    tree = ht.grow_tree(_data(spark, rows), COLS, 4, 1)
    assert [(f, b) for _, _, f, b, _, _, _ in tree.splits] == [(0, 0)]
    assert tree.bin_nodes() == {"feature": "u", "threshold": 0, "left": {"value": 10.0}, "right": {"value": -10.0}}


def test_no_rows_and_rows_without_gradient_give_one_leaf(spark):
    assert ht.grow_tree(_data(spark, []), COLS, 31, 1).bin_nodes() == {"value": 0.0}
    assert ht.grow_tree(_data(spark, [(1, 2, 0, 0)] * 5), COLS, 31, 1).bin_nodes() == {"value": 0.0}


def test_edges_and_bins(spark):
    df = spark.createDataFrame([(float(i % 4), 7.0, float(i), i) for i in range(1000)], "a double, same double, wide double, other int")
    edges = ht.quantile_edges(df, ["a", "same", "wide"])
    assert edges["a"] == [0.0, 1.0, 2.0] and edges["same"] == [] and len(edges["wide"]) == 255
    got = ht.binned(df, edges)
    assert got.columns == df.columns
    rows = {r["other"]: r for r in got.collect()}
    for i in range(1000):
        assert rows[i]["a"] == i % 4 and rows[i]["same"] == 0
        assert rows[i]["wide"] == sum(e < i for e in edges["wide"])
    beyond = spark.createDataFrame([(-5.0, 1.0, 2000.0, 1)], df.schema)
    assert tuple(ht.binned(beyond, edges).first())[:3] == (0, 0, 255)


def test_raw_thresholds_send_rows_where_bins_do(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(a), float(b), int(g * ht.SCALE), ht.SCALE // 3) for a, b, g in zip(rng.normal(size=500), rng.normal(size=500), rng.normal(size=500))],
                               "u double, v double, _g bigint, _h bigint")
    from lodestar.operators.ltr_train import _as_column
    edges = ht.quantile_edges(df, COLS, steps=32)
    tree = ht.grow_tree(ht.binned(df, edges), COLS, 31, 5)
    assert len(tree.splits) == 30
    raw = df.withColumn("value", _as_column(tree.nodes(edges)))
    sums = raw.groupBy("value").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h")).collect()
    assert len(sums) == 31 and all(abs(r["value"] + r["g"] / r["h"]) < 1e-12 for r in sums)
