"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "lodestar",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the operators assume.

    On a cluster the session comes from the launcher; only the UTC session
    time zone and AQE matter to the operators, everything else is sizing.
    """
    cpus = os.environ.get("BENCH_CPUS", "*")
    parts = shuffle_partitions or int(os.environ.get("LODESTAR_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LODESTAR_DRIVER_MEMORY", "16g"))
    )
    if (master or "local").startswith("local") and SparkSession.getActiveSession() is None:
        builder = builder.config("spark.checkpoint.dir", os.environ.get("LODESTAR_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="lodestar-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, which must be set to storage that driver and executors reach.

    ``get_spark`` sets it for local sessions; a cluster's launcher sets its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(path)
    return path


class conf_override:
    """Temporarily set SQL confs on a session (restored on exit)."""

    def __init__(self, spark: SparkSession, values: dict[str, str]):
        self.spark, self.values, self.saved = spark, values, {}

    def __enter__(self):
        for k, v in self.values.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def stream_state_partitions(spark: SparkSession) -> dict[str, str]:
    """State partitions of a new stateful stream: one per core of the cluster.

    Fixed by the checkpoint at the first start, so it is chosen from the
    cluster size rather than inherited from a batch-tuned session setting.
    """
    return {"spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}
