"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from lodestar.plans import catalog
from tests.conftest import SF_SMALL
from tools.compare import _rows, duck_conn

ORACLE = catalog.ORACLE
QUERIES = catalog.QUERIES
TRAINING = {"lambdarank_train", "rerank_score", "feature_importance", "training_pipeline",
            "write_training_artifacts"}


@pytest.fixture(scope="module")
def duck():
    return duck_conn(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows) == _rows(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - TRAINING))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0


def test_every_query_has_oracle_or_is_declared():
    no_oracle = set(QUERIES) - set(ORACLE)
    assert no_oracle <= TRAINING | {"vector_topk_ann", "ann_recall", "bm25_blocks_read"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) == {"ndcg_at_10", "map", "recall_at_20", "n_queries"}
    assert 0.0 <= rows[0]["ndcg_at_10"] <= 1.0
