"""Spark session settings shared by the jobs, the bench and the tests.

Queries never depend on the session time zone: all business times are
``timestamp_ntz`` and month/day buckets are computed on ``date`` values.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants at any scale.  Shuffle partition count is left to
# AQE coalescing on a cluster; tests and the bench pin it for local mode.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "stratum") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    # Catalog databases of local runs go to a fresh folder, not the working directory.
    warehouse = tempfile.mkdtemp(prefix="stratum-warehouse-", dir="/tmp")
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.warehouse.dir", warehouse)
               .config("spark.driver.memory", os.environ.get("STRATUM_DRIVER_MEM", "16g")))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets this to a shared filesystem path.  Only
    when it is unset and Spark runs in this one process (``local``) do we pick
    a fresh scratch folder; anywhere else a local folder would be a different
    one on every machine, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="stratum-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}"
