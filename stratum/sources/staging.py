"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import scratch_path


# Spark drops shuffle files when the driver's collector finds their table unused; with this, when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: what is built on it, and
    any repeated task, reads the written rows and does not redo what made them.  With
    ``release``, the shuffle files that made them go at once."""
    spark = df.sparkSession
    path = scratch_path(spark, f"staged-{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEANUP, None)
    if release:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
