"""Session construction and cluster-facing settings.

Library code never builds its own session: every operator takes the
caller's ``SparkSession`` or DataFrame.  ``build_session`` is for tests,
``bench.py`` and local runs; on a cluster the submitter owns the config.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at 100 TB as much as on a laptop: AQE re-plans
# shuffles from runtime sizes (coalescing small partitions, splitting
# skewed join partitions), and timestamps are pinned to UTC so that
# day buckets do not move with the driver's time zone.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "revspark", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("REVSPARK_DRIVER_MEM", "16g")))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names that folder (a path every executor can reach).  Only
    when it is unset *and* the master is local (tests, laptops) do we create
    one; on a cluster an unset value is a configuration error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="revspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread a tiny input over the cluster before CPU-heavy row work.

    Small parquet files arrive as one row group and so one task; text
    cleaning is CPU-bound per row, so a round-robin spread pays for itself
    there.  At scale the scan already has more splits than cores and this
    is a no-op: we never shuffle raw text without need.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
