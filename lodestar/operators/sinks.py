"""Sinks: partitioned parquet tables, upserts without a transactional format, run records.

Writes never overwrite the path they read from: an upsert writes a new version
folder and returns its path (readers switch to it), so a lost executor or a
failed job leaves the previous version intact.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.monitoring import CHECK_COLUMNS


def write_feature_mart(features: DataFrame, path: str, mode: str = "day") -> None:
    """SNK-01: ``event_date`` partitions, rows clustered by property_id inside files.

    mode="day" replaces only the partitions present in ``features`` (dynamic
    partition overwrite); mode="snapshot" rebuilds the whole table.
    """
    # range partitions on (day, id): bounded tasks, files clustered by id (min/max skipping)
    out = features.repartitionByRange("event_date", "property_id").sortWithinPartitions("event_date", "property_id")
    w = out.write.partitionBy("event_date").format("parquet")
    if mode == "snapshot":
        w.mode("overwrite").option("partitionOverwriteMode", "static").save(path)
    else:
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)


def replace_day_partition(day_rows: DataFrame, path: str) -> None:
    """SNK-02: delete the day(s) present in ``day_rows`` and insert them again."""
    write_feature_mart(day_rows, path, mode="day")


def delete_day(spark: SparkSession, path: str, day: str, new_path: str) -> str:
    """SNK-02 (delete-by-day alone): copy every other day to ``new_path``."""
    spark.read.parquet(path).filter(F.col("event_date") != F.lit(day).cast("date")) \
        .write.partitionBy("event_date").mode("errorifexists").parquet(new_path)
    return new_path


def upsert_embeddings(target: DataFrame, batch: DataFrame, new_path: str) -> int:
    """SNK-03: rows of ``target`` whose id is in ``batch`` are replaced by the batch rows.

    Writes the merged table to ``new_path`` (a new version) and returns the
    number of batch rows written. An empty batch returns 0 and the new version is
    the old table, so readers of ``new_path`` always find one.
    """
    from pyspark import StorageLevel
    b = batch.select(*target.columns).persist(StorageLevel.MEMORY_AND_DISK)  # counted and written once
    try:
        n = b.count()
        keep = target.join(b.select("property_id"), "property_id", "left_anti")
        keep.unionByName(b).repartition("property_id").write.mode("errorifexists").parquet(new_path)
        return n
    finally:
        b.unpersist()


def new_version_path(base: str) -> str:
    return f"{base.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"


METRIC_KEYS = ["best_iteration", "ndcg_at_10", "map", "recall_at_20"]
HYPER_KEYS = ["num_leaves", "learning_rate", "feature_fraction", "bagging_fraction", "num_iterations",
              "early_stopping_rounds", "min_data_in_leaf", "lambdarank_truncation_level"]
_LONGS = {"best_iteration", "num_leaves", "num_iterations", "early_stopping_rounds", "min_data_in_leaf",
          "lambdarank_truncation_level"}


def run_record(runs: DataFrame) -> DataFrame:
    """SNK-04: nested metrics (4 keys) and hyperparams (8 keys); missing keys -> null.

    ``runs`` carries the keys as flat columns (any subset).
    """
    def field(k):
        t = "bigint" if k in _LONGS else "double"
        return (F.col(k) if k in runs.columns else F.lit(None)).cast(t).alias(k)
    base = [c for c in ("run_id", "started_at", "finished_at", "model_path", "git_sha", "dataset_version")]
    return runs.select(*[(F.col(c) if c in runs.columns else F.lit(None).cast("string")).alias(c) for c in base],
                       F.struct(*[field(k) for k in METRIC_KEYS]).alias("metrics"),
                       F.struct(*[field(k) for k in HYPER_KEYS]).alias("hyperparams"))


def append_run(runs: DataFrame, path: str) -> None:
    run_record(runs).write.mode("append").parquet(path)


def export_documents(docs: DataFrame, path: str, batch_size: int = 1000) -> None:
    """SNK-08: search documents as JSON files of at most ``batch_size`` records."""
    docs.write.mode("overwrite").option("maxRecordsPerFile", batch_size).json(path)


def append_validation_results(checks: DataFrame, path: str) -> None:
    """SNK-10: check rows appended under ``run_date`` partitions."""
    checks.select(*CHECK_COLUMNS).write.mode("append").partitionBy("run_date").parquet(path)


def write_training_artifacts(metrics: DataFrame, importance: DataFrame, path: str) -> None:
    """SNK-09: metrics JSON and feature-importance CSV (feature, gain)."""
    metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    importance.select("feature", "gain").coalesce(1).write.mode("overwrite") \
        .option("header", True).csv(f"{path}/feature_importance")
