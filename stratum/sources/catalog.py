"""Catalog operators (A1, A4, A5): layered databases over Parquet folders.

The layer namespace is three Spark databases (bronze / silver / gold) whose
tables point at folders (``CREATE TABLE ... USING parquet LOCATION``).
Registration is idempotent and partition discovery is explicit
(``recoverPartitions``), which is the user-level part of a crawler.
"""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold")


def layer_database(layer: str, prefix: str = "stratum") -> str:
    """One configured name per layer (the reference spelled it two ways, D15)."""
    if layer not in LAYERS:
        raise ValueError(layer)
    return f"{prefix}_{layer}"


def register_table(spark: SparkSession, database: str, table: str, path: str,
                   partitioned: bool = False) -> None:
    """A5: make a Parquet folder queryable as ``database.table``.

    Registering again after a reload updates the table in place: columns that
    the files have gained are added, and a table whose columns have changed
    type or gone is defined anew.  It is external, so no data is touched.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    have = {f.name: f.dataType for f in spark.table(name).schema}
    files = {f.name: f.dataType for f in spark.read.option("mergeSchema", "true").parquet(path).schema}
    new = {c: t for c, t in files.items() if c not in have}
    if any(files.get(c) != t for c, t in have.items()):
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet OPTIONS (mergeSchema 'true') LOCATION '{path}'")
    elif new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` {t.simpleString()}' for c, t in new.items())})")
    spark.catalog.refreshTable(name)
    if partitioned:
        spark.catalog.recoverPartitions(f"{database}.{table}")


def catalog_scan(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A1: lazy scan of a registered table."""
    return spark.table(f"{database}.{table}")


def select_tables(spark: SparkSession, database: str, include: list[str],
                  exclude: tuple[str, ...] = ()) -> list[str]:
    """A4: table names matching include patterns (``core_*``) and no exclude pattern."""
    names = [t.name for t in spark.catalog.listTables(database)]
    keep = [n for n in names if any(fnmatch.fnmatch(n, p) for p in include)]
    return sorted(n for n in keep if not any(fnmatch.fnmatch(n, p) for p in exclude))


def save_bucketed(df: DataFrame, database: str, table: str, path: str, key: str,
                  buckets: int) -> None:
    """Write ``df`` as a Parquet table bucketed by ``key`` at ``path``.

    Two tables bucketed on their join key with the same bucket count join
    without shuffling either side (a co-located sort-merge join).  The
    write shuffles once per load, by ``repartition(buckets, key)``, whose
    hash matches the bucket id, so each task writes one file per bucket.
    Every later join on the key reads the buckets in place.  Size
    ``buckets`` so that one bucket holds about 128-512 MB.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    (df.repartition(buckets, key).write.mode("overwrite").option("compression", "snappy")
     .option("path", path).bucketBy(buckets, key).saveAsTable(f"{database}.{table}"))
