"""Generated inputs used by smoke runs and tests (SRC-05, SRC-06).

These are not registered as queries: their input is made up by definition.
The synthetic frame matches the reference generator in distribution, not in
values (a seeded Spark generator replaces numpy's stream).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.vocab import EMBEDDING_DIM_DECLARED


def synthetic_ranking_frame(spark: SparkSession, n_queries: int = 40, candidates: int = 20,
                            seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """SRC-06: n_queries x candidates rows; label from score = 3*me5 + 10*ctr + N(0, 0.4).

    Cuts: > 2.5 -> 3, > 2.0 -> 2, > 1.5 -> 1, else 0. The first 80 % of the
    queries are the training side.
    """
    base = spark.range(n_queries).select(F.col("id").alias("q")).select(
        "q", F.explode(F.sequence(F.lit(1), F.lit(candidates))).alias("pos"))

    def u(lo, hi, k):
        return F.lit(lo) + (F.lit(hi) - F.lit(lo)) * F.rand(seed * 1000 + k)
    df = base.select(
        F.format_string("synreq-%04d", F.col("q")).alias("request_id"),
        "q",
        F.col("pos").cast("bigint").alias("pool_rank"),
        u(50000.0, 300000.0, 1).alias("rent"),
        F.floor(u(1.0, 30.0, 2)).cast("double").alias("walk_min"),
        F.floor(u(0.0, 40.0, 3)).cast("double").alias("age_years"),
        u(15.0, 120.0, 4).alias("area_m2"),
        u(0.0, 0.2, 5).alias("ctr"),
        u(0.0, 0.05, 6).alias("fav_rate"),
        u(0.0, 0.03, 7).alias("inquiry_rate"),
        u(0.3, 1.0, 8).alias("me5_score"),
        F.col("pos").cast("double").alias("lexical_rank"),
        F.floor(u(1.0, candidates + 1.0, 9)).cast("double").alias("semantic_rank"),
        F.randn(seed * 1000 + 10).alias("_noise"),
    )
    score = F.col("me5_score") * 3 + F.col("ctr") * 10 + F.col("_noise") * 0.4
    df = df.withColumn("label", F.when(score > 2.5, 3).when(score > 2.0, 2).when(score > 1.5, 1)
                       .otherwise(0).cast("bigint")).drop("_noise")
    cut = int(n_queries * 0.8)
    return df.filter(F.col("q") < cut).drop("q"), df.filter(F.col("q") >= cut).drop("q")


def inline_seed(spark: SparkSession, event_date: str, dim: int = EMBEDDING_DIM_DECLARED):
    """SRC-05: five listings, their daily features and one-hot vectors (smoke data)."""
    ids = spark.range(5).select(F.col("id").alias("i"))
    listings = ids.select(
        F.format_string("seed-%03d", F.col("i") + 1).alias("property_id"),
        F.format_string("Seed listing %d", F.col("i") + 1).alias("title"),
        F.lit("quiet street, near station").alias("description"),
        (F.lit(80000) + F.col("i") * 10000).cast("bigint").alias("rent"),
        F.element_at(F.array(*[F.lit(x) for x in ["1K", "1LDK", "2LDK", "1LDK", "3LDK"]]),
                     (F.col("i") + 1).cast("int")).alias("layout"),
        (F.col("i") * 3 + 5).cast("bigint").alias("walk_min"),
        (F.col("i") * 4).cast("bigint").alias("age_years"),
        (F.lit(25.0) + F.col("i") * 10).alias("area_m2"),
        (F.col("i") % 2 == 0).alias("pet_ok"),
    )
    features = listings.select(
        F.lit(event_date).cast("date").alias("event_date"), "property_id", "rent", "walk_min", "age_years",
        "area_m2", F.lit(0.05).alias("ctr"), F.lit(0.10).alias("fav_rate"), F.lit(0.02).alias("inquiry_rate"),
        F.lit(0.4 * 0.05 + 0.2 * 0.10 + 0.2 * 0.02).alias("popularity_score"))
    emb = ids.select(
        F.format_string("seed-%03d", F.col("i") + 1).alias("property_id"),
        F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda j: (j == F.col("i")).cast("double"))
        .alias("embedding"))
    return listings, features, emb
