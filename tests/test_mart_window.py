"""The mart reads of the logs the whole requests of its window, cut before the requests are ranked."""

from pyspark.sql import functions as F

from lodestar.functions.columns import ts_lit
from lodestar.operators import features as fm
from lodestar.plans import q_features as qf
from lodestar.sources import fixtures as fx
from tests.conftest import SF_CHECK
from tests.test_plans import plan


def test_mart_of_the_window_is_the_mart_of_all_logs(spark):
    got = qf.mart(spark, SF_CHECK)
    want = fm.feature_mart(fx.listings(spark, SF_CHECK), fx.search_logs(spark, SF_CHECK), fx.feedback_events(spark, SF_CHECK), fx.AS_OF)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert not got.filter(F.col("ctr") > 0).isEmpty()
    assert "LeftSemi" in plan(got)


def test_requests_of_a_window_stay_whole(spark, tmp_dir):
    """A request with an order row outside the window keeps it: its log is that of all its rows."""
    for name in ("lineitem", "part"):
        spark.read.parquet(f"{SF_CHECK}/{name}.parquet").write.parquet(f"{tmp_dir}/{name}.parquet")
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    early = orders.filter("o_orderkey % 3 = 0").withColumn("o_orderdate", F.lit("1990-01-01 00:00:00").cast("timestamp_ntz"))
    orders.unionByName(early).write.parquet(f"{tmp_dir}/orders.parquet")
    between = fm.window_bounds(fx.AS_OF)[1], ts_lit(fx.AS_OF)
    part, whole = fx.search_logs(spark, tmp_dir, between), fx.search_logs(spark, tmp_dir)
    columns = ["request_id", "ts", "result_property_ids"]
    assert part.count() < whole.count() / 10

    def in_window(df):
        return df.select(*columns).filter((F.col("ts") >= between[0]) & (F.col("ts") <= between[1]))
    assert in_window(part).exceptAll(in_window(whole)).isEmpty() and in_window(whole).exceptAll(in_window(part)).isEmpty()
    assert not in_window(part).isEmpty()
