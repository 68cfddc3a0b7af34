"""Sinks (A6, A7, A9, B11) and schema evolution between loads (A10).

Writes go to Parquet/Snappy.  Partitioned sinks partition by a *derived*
coarse key (day, month, tenant) - never by a raw timestamp, which would
make one directory per row (defect D14) - and rebalance on the same key
first so each task writes few files per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_of, month_of


def stamp_processed_at(df: DataFrame) -> DataFrame:
    """Lineage stamp, added only at write time (never in query results)."""
    return df.withColumn("processed_at", F.current_timestamp())


MAX_RECORDS_PER_FILE = 5_000_000


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", stamp: bool = True, incremental: bool = False) -> None:
    """Snappy Parquet, optionally partitioned.

    A write replaces the whole table, so partitions that a recompute no longer
    has are gone.  ``incremental`` replaces only the partitions that ``df`` has.

    Partitioned writes cluster rows by the partition keys with the
    ``rebalance`` hint: AQE splits a skewed (hot) partition over several
    writer tasks and merges small ones, so no single task writes a third
    of the data and the table does not fill with tiny files.
    """
    out = stamp_processed_at(df) if stamp else df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    w = (out.write.mode(mode).option("compression", "snappy")
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE))
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic" if incremental else "static").partitionBy(*partition_by)
    w.parquet(path)


def with_layout_keys(df: DataFrame, ts_col: str, grain: str = "day") -> DataFrame:
    """The tenant x date layout - adds ``dt`` (day or month of ``ts_col``)."""
    key: Column = day_of(ts_col) if grain == "day" else month_of(ts_col)
    return df.withColumn("dt", key)


def write_tenant_date_layout(df: DataFrame, path: str, ts_col: str, grain: str = "day") -> None:
    """partitionBy(dt, tenant_id) so tenant- and date-filtered reads prune directories."""
    write_parquet(with_layout_keys(df, ts_col, grain), path, ["dt", "tenant_id"])


def read_evolving(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A10: read loads whose schemas differ; missing columns become NULL.

    ``mergeSchema`` reconciles Parquet footers of all files; columns are
    matched by name, never by position.
    """
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def union_evolving(frames: list[DataFrame]) -> DataFrame:
    """A10 for in-flight frames: ``unionByName(allowMissingColumns=True)``."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
