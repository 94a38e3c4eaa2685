"""Hand-computed cases (the reference's unit tests, re-expressed on DataFrames)."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lodestar.functions import columns as C
from lodestar.operators import ltr, monitoring as mon, retrieval as rt, features as fm
from lodestar.operators import embeddings as emb, sinks, ltr_train
from lodestar.sources.synthetic import inline_seed, synthetic_ranking_frame
from lodestar.streaming import messages as msg


def frame(spark, rows):
    return spark.createDataFrame(rows, "request_id string, label long, score double, lexical_rank long")


def metrics(spark, rows, **kw):
    return {r["request_id"]: r for r in ltr.per_request_metrics(frame(spark, rows), **kw).collect()}


def test_ndcg_perfect_and_zero(spark):
    rows = [("a", 3, .9, 1), ("a", 2, .7, 2), ("a", 1, .5, 3), ("a", 0, .1, 4),
            ("z", 0, .9, 1), ("z", 0, .5, 2)]
    m = metrics(spark, rows, k_ndcg=4)
    assert m["a"]["ndcg_at_4"] == pytest.approx(1.0)
    assert m["z"]["ndcg_at_4"] == 0.0


def test_ndcg_imperfect_matches_formula(spark):
    rows = [("a", 0, .9, 1), ("a", 3, .7, 2), ("a", 1, .5, 3)]
    import math
    dcg = 0 / math.log2(2) + 7 / math.log2(3) + 1 / math.log2(4)
    idcg = 7 / math.log2(2) + 1 / math.log2(3)
    assert metrics(spark, rows)["a"]["ndcg_at_10"] == pytest.approx(dcg / idcg)


def test_map_and_recall(spark):
    m = metrics(spark, [("a", 1, .9, 1), ("a", 1, .8, 2), ("a", 0, .7, 3), ("a", 0, .6, 4),
                        ("n", 0, .9, 1), ("n", 0, .1, 2)])
    assert m["a"]["average_precision"] == pytest.approx(1.0)
    assert m["n"]["average_precision"] == 0.0
    r = metrics(spark, [("r", 1, .9, 1), ("r", 0, .8, 2), ("r", 1, .7, 3), ("r", 0, .6, 4), ("r", 1, .5, 5)],
                k_recall=3)
    assert r["r"]["recall_at_3"] == pytest.approx(2 / 3)


def test_ties_keep_frame_order(spark):
    # equal scores: the frame order (lexical rank) decides, like a stable sort
    m = metrics(spark, [("a", 0, .5, 1), ("a", 3, .5, 2)])
    assert m["a"]["ndcg_at_10"] < 1.0


def test_empty_evaluation_is_zero(spark):
    e = ltr.evaluate(ltr.per_request_metrics(frame(spark, []))).first()
    assert (e["ndcg_at_10"], e["map"], e["recall_at_20"], e["n_queries"]) == (0.0, 0.0, 0.0, 0)


def test_strongest_label(spark):
    fb = spark.createDataFrame([("r", "p", "click"), ("r", "p", "favorite"), ("r", "p", "inquiry"),
                                ("r", "q", "view")], "request_id string, property_id string, action string")
    got = {r["property_id"]: r["label"] for r in ltr.strongest_label(fb).collect()}
    assert got == {"p": 3, "q": 0}


def test_missing_behaviour_becomes_zero(spark):
    cols = ", ".join(f"{c} double" for c in ltr.FEATURE_COLS)
    df = spark.createDataFrame([("r", "p", None, 5.0, 3.0, 20.0, None, None, None, 0.8, 1.0, 2.0)],
                               f"request_id string, property_id string, {cols}")
    r = ltr.ranker_features(df).first()
    assert r["rent"] == 0.0 and r["ctr"] == 0.0 and r["me5_score"] == 0.8


def test_group_sizes_and_split(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 3), ("c", 1)],
                               "request_id string, pool_rank long")
    assert {r[0]: r[1] for r in ltr.group_sizes(df).collect()} == {"a": 2, "b": 3, "c": 1}
    s = ltr.group_split(df)
    assert ltr.train_test_overlap(s).count() == 0
    assert ltr.group_split(df.limit(0)).count() == 0
    per = s.groupBy("request_id").agg(F.countDistinct("split").alias("n")).collect()
    assert all(r["n"] == 1 for r in per)


def test_missing_training_columns_raise(spark):
    df = spark.createDataFrame([("a", 1)], "request_id string, label long")
    with pytest.raises(ValueError, match="rent"):
        ltr_train.check_columns(df)


def test_safe_divide_and_null_rates(spark):
    df = spark.createDataFrame([(1, 0), (None, 3), (2, 4)], "a long, b long")
    got = [r[0] for r in df.select(C.safe_divide(F.col("a"), F.col("b"))).collect()]
    assert got == [None, None, 0.5]


def test_latency_bucket(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (8.0,), (7.99,), (1e12,)], "ms double")
    got = [r[0] for r in df.select(C.latency_bucket(F.col("ms"))).collect()]
    assert got == [0, 1, 4, 3, 25]


def test_text_hash_matches_hashlib(spark):
    df = spark.createDataFrame([(" Title ", "desc\n")], "title string, description string")
    text = f"{' Title '}。{'desc'}\n".strip()
    want = hashlib.sha256(b"m" + b"\x1f" + text.encode()).hexdigest()
    got = df.select(C.text_hash("m", C.passage_text(F.col("title"), F.col("description")))).first()[0]
    assert got == want


def test_change_detection_first_rerun_edit(spark, tmp_dir):
    texts = spark.createDataFrame([("p1", "t", "d")], "property_id string, title string, description string")
    empty = spark.createDataFrame([], "property_id string, embedding array<double>, text_hash string, "
                                      "model_name string, generated_at timestamp_ntz")
    enc = emb.hashing_encoder(16)
    rows, counts = emb.refresh_plan(texts, empty, "m", "2024-01-01 00:00:00", enc)
    assert counts.first()["encoded"] == 1
    p1 = sinks.new_version_path(tmp_dir)
    assert sinks.upsert_embeddings(empty, rows, p1) == 1
    stored = spark.read.parquet(p1)
    rows2, counts2 = emb.refresh_plan(texts, stored, "m", "2024-01-01 00:00:00", enc)
    assert counts2.first()["encoded"] == 0
    assert sinks.upsert_embeddings(stored, rows2, sinks.new_version_path(tmp_dir)) == 0
    edited = texts.withColumn("description", F.lit("changed"))
    assert emb.refresh_plan(edited, stored, "m", "2024-01-01 00:00:00", enc)[1].first()["encoded"] == 1


def test_fallback_top_k_and_full_pool_log(spark):
    cands = spark.createDataFrame(
        [("q", f"p{i}", i, 100 + i, 5 - i, 0.1 * i) for i in range(1, 6)],
        "query_id string, property_id string, rrf_rank long, lexical_rank long, semantic_rank long, me5_score double")
    for c in ["rent", "walk_min", "age_years", "area_m2", "ctr", "fav_rate", "inquiry_rate"]:
        cands = cands.withColumn(c, F.lit(None).cast("double"))
    queries = spark.createDataFrame([("q", 2)], "query_id string, top_k long")
    log, results = rt.hybrid_search(cands, queries)
    assert log.count() == 5 and results.count() == 2
    assert [r["final_rank"] for r in results.orderBy("display_rank").collect()] == [101, 102]
    assert log.filter(F.col("score").isNotNull()).count() == 0


RUNS = "run_id string, finished_at timestamp_ntz, metrics struct<ndcg_at_10:double>"
NOW = "2026-04-18 10:00:00"


def decide(spark, runs, n_feedback=0):
    r = spark.createDataFrame(runs, RUNS)
    fb = spark.range(n_feedback).select(F.lit("2026-04-18 09:00:00").cast("timestamp_ntz").alias("ts"))
    return mon.retrain_decision(r, fb, NOW).first()


def test_retrain_no_prior_run(spark):
    d = decide(spark, [])
    assert d["should_retrain"] and d["reasons"] == "no_prior_run"


def test_retrain_stale_and_fresh(spark):
    import datetime as dt
    t = dt.datetime(2026, 4, 10, 10, 0)
    d = decide(spark, [("a", t, (0.7,))])
    assert d["reasons"] == "last_run_age_days=8>7"
    fresh = decide(spark, [("a", dt.datetime(2026, 4, 17, 10, 0), (0.7,))])
    assert not fresh["should_retrain"] and fresh["reasons"] == ""


def test_retrain_feedback_and_ndcg_drop(spark):
    import datetime as dt
    runs = [("old", dt.datetime(2026, 4, 9, 10, 0), (0.80,)), ("new", dt.datetime(2026, 4, 17, 10, 0), (0.70,))]
    d = decide(spark, runs, n_feedback=10001)
    assert d["reasons"].split(";") == ["feedback_rows=10001>10000", "ndcg_drop=0.100>=0.03"]


def test_trigger_source_resolution(spark):
    import base64
    import json

    def enc(o):
        return base64.b64encode(json.dumps(o).encode()).decode()
    raw = spark.createDataFrame([(1, enc({"reasons": ["Feature DRIFT on rent"]})), (2, enc({"reasons": ["x"]})),
                                 (3, enc({"source": " Manual ", "parameters": {"enable_tuning": "true"}}))],
                                "id long, data string")
    got = {r["id"]: (r["source"], r["enable_tuning"]) for r in msg.trigger_events(raw).collect()}
    assert got == {1: ("monitoring", True), 2: ("scheduler", False), 3: ("manual", True)}


def test_inline_seed(spark):
    listings, features, vecs = inline_seed(spark, "2026-04-18")
    assert listings.count() == 5
    f = features.first()
    assert (f["ctr"], f["fav_rate"], f["inquiry_rate"]) == (0.05, 0.10, 0.02)
    v = vecs.orderBy("property_id").collect()
    assert len(v[0]["embedding"]) == 768 and sum(v[2]["embedding"]) == 1.0 and v[2]["embedding"][2] == 1.0


def test_lambdarank_learns_on_synthetic(spark):
    train, test = synthetic_ranking_frame(spark, n_queries=60, candidates=20, seed=1)
    model = ltr_train.train_lambdarank(train, test, {"num_iterations": 4, "min_data_in_leaf": 10,
                                                     "learning_rate": 0.3})
    base = ltr.evaluate_ranking(test, -F.col("lexical_rank"), F.col("pool_rank")).first()["ndcg_at_10"]
    scored = ltr_train.rerank_score(test, model)
    got = ltr.evaluate_ranking(scored, F.col("score"), F.col("pool_rank")).first()["ndcg_at_10"]
    assert got > base
    imp = ltr_train.feature_importance(spark, model).collect()
    assert [r["feature"] for r in imp] == ltr.FEATURE_COLS
    assert abs(sum(r["gain"] for r in imp) - 1.0) < 1e-9


def test_feature_parity(spark):
    from lodestar.operators.quality import feature_parity
    cols = ", ".join(f"{c} double" for c in ltr.FEATURE_COLS)
    ok = spark.createDataFrame([], f"request_id string, {cols}")
    assert feature_parity(ok) == []
    bad = spark.createDataFrame([], "rent double, ctr long")
    assert feature_parity(bad)


def test_clean_properties_rules(spark):
    raw = spark.createDataFrame(
        [("p", None, None, -3, -1, None, 12), (None, 1, 1, 1, 1, True, 12)],
        "property_id string, rent long, management_fee long, age_years long, walk_min long, pet_ok boolean, area_m2 int")
    for c in ["title", "description", "city", "ward", "layout"]:
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    for c in ["created_at", "updated_at"]:
        raw = raw.withColumn(c, F.lit(None).cast("timestamp_ntz"))
    out = fm.clean_properties(raw).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["rent"], r["management_fee"], r["age_years"], r["walk_min"], r["pet_ok"], r["area_m2"]) == \
        (0, 0, 0, 0, False, 12.0)


def test_day_partitions_replace_and_delete(spark, tmp_dir):
    rows = spark.createDataFrame([("2026-04-17", "p1", 1), ("2026-04-18", "p1", 2)],
                                 "d string, property_id string, v long").withColumn("event_date", F.to_date("d")).drop("d")
    path = f"{tmp_dir}/mart"
    sinks.write_feature_mart(rows, path)
    sinks.replace_day_partition(rows.filter(F.col("v") == 2).withColumn("v", F.lit(9).cast("bigint")), path)
    got = {str(r["event_date"]): r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {"2026-04-17": 1, "2026-04-18": 9}
    kept = sinks.delete_day(spark, path, "2026-04-17", f"{tmp_dir}/mart_v2")
    assert [str(r["event_date"]) for r in spark.read.parquet(kept).collect()] == ["2026-04-18"]


def test_export_documents_batches_of_1000(spark, tmp_dir):
    import glob
    import json
    docs = spark.range(2500).select(F.format_string("P%d", F.col("id")).alias("property_id")).coalesce(1)
    sinks.export_documents(docs, f"{tmp_dir}/export", batch_size=1000)
    files = [f for f in glob.glob(f"{tmp_dir}/export/*.json")]
    sizes = sorted(sum(1 for _ in open(f)) for f in files)
    assert sizes == [500, 1000, 1000]
    assert all("property_id" in json.loads(open(f).readline()) for f in files)


def test_vector_topk_ties_nulls_and_partitionings(spark, monkeypatch):
    """Equal vectors across the cut: the ids decide, whatever the partitioning; unusable vectors take no part."""
    from lodestar.operators import retrieval as rt
    same = [(f"P{i:04d}", [1.0, 0.0, 0.5]) for i in range(300)]
    odd = [("N1", None), ("N2", [1.0, None, 0.5]), ("N3", [1.0, 0.0]), ("N4", [float("nan"), 0.0, 0.5]), (None, [1.0, 0.0, 0.5]), ("Z", [0.0, 0.0, 0.0])]
    corpus = spark.createDataFrame(same + odd, "property_id string, embedding array<double>")
    queries = spark.createDataFrame([("q1", [1.0, 0.0, 0.5]), ("q2", [0.0, 1.0, 0.0]), ("q3", None)], "query_id string, query_vector array<double>")
    want = {(q, f"P{i:04d}") for q in ("q1", "q2") for i in range(200)}
    for size in (64 << 20, 64):  # broadcast, then cogroups
        monkeypatch.setattr(rt, "MAX_BROADCAST_QUERY_BYTES", size)
        for n in (1, 7):
            got = rt.vector_topk(queries, corpus.repartition(n)).collect()
            assert {(r["query_id"], r["property_id"]) for r in got} == want and len(got) == 400
    assert rt.vector_topk(queries.filter("query_id = 'q3'"), corpus).count() == 0


def test_search_log_keeps_shown_rows_and_empty_searches(spark):
    """Fallback regime: final_rank is the lexical rank, 10000 for semantic hits; the display position decides."""
    from lodestar.operators import monitoring as mon
    log = spark.createDataFrame([("a", "P1", 1, 2), ("a", "P2", 7, 1), ("a", "P3", 10000, 3), ("a", "P4", 10000, 4)],
                                "request_id string, property_id string, final_rank long, rrf_rank long") \
        .selectExpr("*", "timestamp_ntz'2001-01-01 00:00:00' ts", "'m' model_path")
    requests = spark.createDataFrame([("a", 3), ("b", 3)], "request_id string, top_k long") \
        .selectExpr("*", "'q' query", "null filters", "1.0D latency_ms", "timestamp_ntz'2001-01-02 00:00:00' requested_at")
    got = {r["request_id"]: r for r in mon.search_logs_from_ranking_log(log, requests).collect()}
    assert got["a"]["result_property_ids"] == ["P1", "P2", "P3"]
    assert got["b"]["result_property_ids"] == [] and str(got["b"]["ts"]) == "2001-01-02 00:00:00"


def test_emitted_log_reads_back(spark):
    from lodestar.operators import retrieval as rt
    from lodestar.streaming import messages as msg
    cands = spark.createDataFrame([("q", f"P{i}", i, 10000, i, 0.0) for i in range(1, 6)],
                                  "query_id string, property_id string, lexical_rank long, semantic_rank long, rrf_rank long, me5_score double") \
        .selectExpr("*", "1L rent", "2L walk_min", "3L age_years", "4.0D area_m2", "null ctr", "null fav_rate", "null inquiry_rate")
    log, _ = rt.hybrid_search(cands, spark.createDataFrame([("q", 3)], "query_id string, top_k long"), as_of="2001-07-15 12:00:00")
    back = msg.ranking_log_rows(msg.to_message(log)).collect()
    assert len(back) == 5 and {str(r["ts"]) for r in back} == {"2001-07-15 12:00:00"}


def test_unparsable_triggers_and_alerts_are_rejected(spark):
    import base64
    from lodestar.streaming import messages as msg
    enc = lambda s: base64.b64encode(s.encode()).decode()
    rows = [(1, enc('{"source": "manual"}')), (2, enc("not json")), (3, "%%%"), (4, None), (5, enc("[1]")),
            (6, enc('{"reasons": ["x"], "parameters": {"retrain_reasons": "[\\"given\\"]"}}'))]
    raw = spark.createDataFrame(rows, "event_id long, data string")
    got = {r["event_id"]: r for r in msg.trigger_events(raw).collect()}
    assert set(got) == {1, 6} and got[6]["retrain_reasons"] == ["given"]
    assert {r["event_id"] for r in msg.rejected_triggers(raw).collect()} == {2, 3, 4, 5}
    alerts = spark.createDataFrame([("not json",), ("{}",)], "value string")
    assert msg.alert_rows(alerts).count() == 0 and msg.quarantine(alerts, "alert").count() == 2


def test_empty_upsert_leaves_a_readable_version(spark, tmp_dir):
    from lodestar.operators import sinks
    old = spark.createDataFrame([("P1", "a")], "property_id string, text_hash string")
    path = sinks.new_version_path(tmp_dir)
    assert sinks.upsert_embeddings(old, old.filter("false"), path) == 0
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("P1", "a")]


def test_critical_counts_as_an_error(spark):
    from lodestar.streaming import operators as so
    log = spark.createDataFrame([("INFO",), ("ERROR",), ("CRITICAL",), (None,)], "severity string").selectExpr("*", "timestamp'2024-01-01 00:00:10' ts")
    assert so.error_rate(log).first()["n_errors"] == 2


def test_no_machine_local_folder_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from lodestar.session import checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake)


def test_trained_model_saves_loads_and_scores_the_same(spark, tmp_dir):
    """Trees reach beyond 16 leaves, three stop metrics are kept, and a loaded model is the saved one."""
    train, test = synthetic_ranking_frame(spark, n_queries=60, candidates=20, seed=1)
    model = ltr_train.train_lambdarank(train, test, {"num_iterations": 3, "min_data_in_leaf": 2, "learning_rate": 0.3})
    assert max(t.n_leaves() for t in model.trees) > 16 and len(model.history[0]) == 2 + 3
    model.save(spark, f"{tmp_dir}/model")
    back = ltr_train.LambdaRankModel.load(spark, f"{tmp_dir}/model")
    a = {(r["request_id"], r["pool_rank"]): r["score"] for r in ltr_train.rerank_score(test, model).collect()}
    b = {(r["request_id"], r["pool_rank"]): r["score"] for r in ltr_train.rerank_score(test, back).collect()}
    assert a == b and len(set(a.values())) > 10


def test_training_on_nothing_raises(spark):
    import pytest
    train, test = synthetic_ranking_frame(spark, n_queries=2, candidates=3, seed=1)
    with pytest.raises(ValueError, match="no rows"):
        ltr_train.train_lambdarank(train.filter("false"), test)


def test_tokens_of_any_script(spark):
    from lodestar.operators.retrieval import tokenize
    texts = ["ワンルーム 2ＬＤＫ Straße", "Привет мир 駅", "ΑΒΓ x1 été", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", tokenize(F.col("t")).alias("w")).collect()
    got = {r["i"]: r["w"] for r in rows}
    assert got[0] == ["2ldk", "straße", "ワン", "ンル", "ルー", "ーム"] and got[1] == ["привет", "мир", "駅"]
    assert got[2] == ["αβγ", "x1", "été"] and got[3] == [] and got[4] is None
    import duckdb
    from lodestar.plans.oracle_views import tokens
    con = duckdb.connect()
    for i, t in enumerate(texts[:4]):
        assert con.execute(f"SELECT {tokens('t')} FROM (SELECT $v AS t)", {"v": t}).fetchone()[0] == got[i]


def test_rolling_window_counts_impressions(spark):
    from lodestar.streaming import operators as so
    ev = spark.createDataFrame([("P1", "click"), ("P1", "impression"), ("P1", "impression")], "property_id string, action string").selectExpr("*", "timestamp'2024-01-10 05:00:00' ts")
    rows = so.behaviour_window(ev).collect()
    assert len(rows) == 28 and {(r["impression_count"], r["click_count"], r["favorite_count"]) for r in rows} == {(2, 1, 0)}


def test_encoder_sends_no_text_through_python(spark):
    """A helper text column stays out of the Python step and of the result; a plain one is kept."""
    df = spark.createDataFrame([("P1", "red house"), ("P2", None), ("P3", "")], "property_id string, text string")
    enc = emb.hashing_encoder(8)
    plain = emb.encode_passages(df, enc)
    lean = emb.encode_passages(df.withColumnRenamed("text", "_text"), enc, "_text")
    assert plain.columns == ["property_id", "text", "embedding"] and lean.columns == ["property_id", "embedding"]
    assert {r["property_id"]: r["embedding"] for r in plain.collect()} == {r["property_id"]: r["embedding"] for r in lean.collect()}
    from lodestar.plans.q_embeddings import q_text_search
    from tests.conftest import SF_SMALL
    logical = q_text_search(spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    encoders = [line for line in logical.splitlines() if "MapInPandas count(" in line]
    assert encoders and not any("text" in line or "_prefixed" in line for line in encoders)
