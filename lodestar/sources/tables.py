"""Declared sources: driver parquet tables read by name (SRC-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it.

    ``spread=True`` is for tables followed by CPU-heavy row work (text, vectors):
    when the scan yields fewer splits than the session's parallelism (e.g. one
    large row group) the rows are hash-spread on their first (id) column first
    (no pre-sort, unlike round-robin). On a large input the scan already has
    enough splits and nothing is added.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        target = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < target:
            df = df.repartition(target, df.columns[0])
    return df


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> list[str]:
    """Scan declared source tables by name and expose them as temp views."""
    out = []
    for name in names or DRIVER_TABLES:
        read(spark, sf_dir, name).createOrReplaceTempView(name)
        out.append(name)
    return out
