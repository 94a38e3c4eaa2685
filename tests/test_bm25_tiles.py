"""BM25 by tiles of counts and weights: the rows of the joins, with facets, ties and odd ids, and no join of postings."""

import pytest
from pyspark.sql import functions as F

from lodestar.operators import retrieval as rt
from tests.test_plans import plan

WORDS = "red house garden sea view station quiet old new big small blue".split()
Q_SCHEMA = "query_id string, query_text string, max_rent bigint, layout string, max_walk_min bigint, pet_ok boolean, max_age bigint"
D_SCHEMA = "property_id string, searchable_text string, rent bigint, layout string, walk_min bigint, pet_ok boolean, age_years bigint"


def _tables(spark, more=()):
    docs = []
    for i in range(300):
        text = " ".join(WORDS[(i * j + j) % len(WORDS)] for j in range(1, 3 + i % 7)) if i % 10 else "red house sea"  # every tenth is a copy
        docs.append((f"P{i}", text if i % 41 else None, None if i % 11 == 0 else i, None if i % 13 == 0 else ["1K", "2K"][i % 2],
                     None if i % 7 == 0 else i % 30, None if i % 5 == 0 else i % 3 == 0, i % 50))
    queries = [("Q1", "red house", None, None, None, None, None), ("Q2", "sea view sea", 150, " ", None, None, None), ("Q3", "quiet old", None, "1K", 20, None, 30),
               ("Q4", "red big", None, None, None, True, None), ("Q5", "red big", None, None, None, False, None), ("Q6", "nothing here", None, "3K", None, None, None), ("Q7", "", None, None, None, None, None)]
    return spark.createDataFrame([*docs, *more], D_SCHEMA), spark.createDataFrame(queries, Q_SCHEMA)


def _rows(df):
    return sorted((r["query_id"], r["property_id"], round(r["bm25"], 9), r["lexical_rank"]) for r in df.collect())


def _by_joins(docs, queries, k):
    s = rt.facet_filter(rt._joined_scores(docs, queries, rt.BM25_K1, rt.BM25_B), docs, queries)
    from pyspark.sql import Window
    order = Window.partitionBy("query_id").orderBy(F.round("bm25", rt.RANK_DECIMALS).desc(), "property_id")
    return s.withColumn("lexical_rank", F.row_number().over(order)).filter(F.col("lexical_rank") <= k).filter(F.trim("property_id") != "")


@pytest.mark.parametrize("more", [[], [("P1", "red red sea", 1, "1K", 1, True, 1), (None, "red house", 1, "1K", 1, True, 1)], [(" ", "red house red", 1, "1K", 1, True, 1)]])
def test_tiles_give_the_rows_of_the_joins(spark, monkeypatch, more):
    docs, queries = _tables(spark, more)
    monkeypatch.setattr(rt, "TILE_CELLS", 20)  # several tiles of queries and of listings
    assert _rows(rt.bm25_topk(docs, queries, 7)) == _rows(_by_joins(docs, queries, 7))
    got = {(r.query_id, r.property_id, round(r.bm25, 9)) for r in rt.bm25_scores(docs, queries).collect()}
    assert got == {(r.query_id, r.property_id, round(r.bm25, 9)) for r in rt._joined_scores(docs, queries, rt.BM25_K1, rt.BM25_B).collect()}


MORE_IDS = [("P1", "red red sea", 1, "1K", 1, True, 1), ("P1", "red house", 9, "2K", 2, False, 3), ("P2", "red", 1, "1K", 1, True, 1), ("P2", "red", 1, "1K", 1, True, 1),
            (None, "red house", 1, "1K", 1, True, 1), (None, "quiet old red", 2, "1K", 2, False, 2), (" ", "red house red", 1, "1K", 1, True, 1), (" ", None, 1, None, 1, True, 1)]


@pytest.mark.parametrize("more", [MORE_IDS, MORE_IDS[:2], MORE_IDS[4:5], [(f"P{i}", "red sea " * (i % 3), i, "1K", i, True, i) for i in range(0, 300, 2)]])
def test_ids_that_repeat_are_scored_in_tiles(spark, monkeypatch, more):
    """Ids that repeat or are null take no join of postings with the queries' weights, and give its rows."""
    docs, queries = _tables(spark, more)
    expected, scores = _rows(_by_joins(docs, queries, 9)), {(r.query_id, r.property_id, round(r.bm25, 9)) for r in rt._joined_scores(docs, queries, rt.BM25_K1, rt.BM25_B).collect()}

    def joined(*_):
        raise AssertionError("postings are joined")
    monkeypatch.setattr(rt, "_joined_scores", joined)
    monkeypatch.setattr(rt, "TILE_CELLS", 20)
    hits = rt.bm25_topk(docs, queries, 9)
    assert _rows(hits) == expected and hits.count() > 30
    got = [(r.query_id, r.property_id, round(r.bm25, 9)) for r in rt.bm25_scores(docs, queries).collect()]
    assert set(got) == scores and len(got) == len(scores)


def test_postings_meet_no_join(spark):
    """A task's work on a listing is its counts times the weights, and it sends on no more than k rows for each query."""
    docs, queries = _tables(spark)
    hits = rt.bm25_topk(docs, queries, 5)
    p = plan(hits)
    assert "MapInArrow" in p and "Join" not in p and "WindowGroupLimit" in p
    assert hits.filter(F.col("query_id") == "Q1").count() == 5


def test_leaders_keep_what_rounding_may_rank(spark):
    """Equal scores stay as the k smallest ids, scores that may round alike all stay, and the limit only drops what can't rank."""
    import numpy as np
    best = rt._Leaders(1, 2)
    for s in range(0, 40, 4):
        best.add(0, np.array([1.0, 1.0, 1.0 + 1e-10, 0.5]), np.array([f"P{s + i:02d}" for i in range(4)], dtype=object))
    best.cut(0)
    assert sorted(zip(best.score[0], best.ids[0], strict=True)) == [(1.0, "P00"), (1.0, "P01"), (1.0 + 1e-10, "P02"), (1.0 + 1e-10, "P06")]


def test_tokens_without_eastern_characters_are_the_same(spark):
    texts = ["", "Ünï ñandú 12 İstanbul Ⱥ", "ＡＢ c", "築5年 駅", "a\U0001b001b", "ⰀⰁ x⺀y", "é ǅ"]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select(rt.tokenize(F.col("t")).alias("a"), rt._tokens_folded(F.col("t")).alias("b")).collect()
    assert all(r.a == r.b for r in rows)
