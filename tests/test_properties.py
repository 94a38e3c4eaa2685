"""Property tests: RRF and NDCG bounds over generated batches (one Spark job per example)."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lodestar.operators import ltr, retrieval as rt

lists = st.lists(st.tuples(st.lists(st.integers(0, 30), min_size=1, max_size=12, unique=True),
                           st.lists(st.integers(0, 30), min_size=0, max_size=12, unique=True)),
                 min_size=1, max_size=8)


@settings(max_examples=6, deadline=None)
@given(lists)
def test_rrf_bounds_and_permutation(spark, cases):
    lex, sem = [], []
    for qi, (a, b) in enumerate(cases):
        lex += [(f"q{qi}", f"p{x}", i + 1) for i, x in enumerate(a)]
        sem += [(f"q{qi}", f"p{x}", i + 1, 0.5) for i, x in enumerate(b)]
    L = spark.createDataFrame(lex, "query_id string, property_id string, lexical_rank long")
    S = spark.createDataFrame(sem, "query_id string, property_id string, semantic_rank long, me5_score double")
    Q = spark.createDataFrame([(f"q{i}", 20) for i in range(len(cases))], "query_id string, top_k long")
    out = rt.rrf_fuse(L, S, Q).collect()
    assert all(0 < r["rrf_score"] <= 2 / 61 + 1e-12 for r in out)
    per = {}
    for r in out:
        per.setdefault(r["query_id"], []).append(r["rrf_rank"])
    for qi, (a, b) in enumerate(cases):
        n = len(set(a) | set(b))
        assert sorted(per[f"q{qi}"]) == list(range(1, min(n, 100) + 1))


groups = st.lists(st.lists(st.tuples(st.integers(0, 3), st.floats(-5, 5, allow_nan=False)), min_size=1,
                           max_size=15), min_size=1, max_size=10)


@settings(max_examples=6, deadline=None)
@given(groups)
def test_metrics_in_unit_interval(spark, gs):
    rows = [(f"r{g}", lab, s, i + 1) for g, items in enumerate(gs) for i, (lab, s) in enumerate(items)]
    df = spark.createDataFrame(rows, "request_id string, label long, score double, lexical_rank long")
    for r in ltr.per_request_metrics(df).collect():
        for c in ("ndcg_at_10", "average_precision", "recall_at_20"):
            assert -1e-12 <= r[c] <= 1 + 1e-12
