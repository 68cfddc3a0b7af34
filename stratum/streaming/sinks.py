"""Idempotent micro-batch sinks for Structured Streaming.

The jobs G3, G4 and G7 write runs (``runs.py``); ``upsert`` is for tables whose readers want
each key in one known bucket.

``upsert`` merges a micro-batch into a keyed table.  The table is cut into a
fixed number of buckets by a hash of the key, so a key lives in one bucket
whatever its other columns say, and a batch rewrites only the buckets it
touches.  Layout under the target folder:

    v=<batch>/bucket=<b>/...     the rows of a bucket as that batch left them
    _manifest/batch=<n>          (bucket, version): the table after batch n
    _rejected/batch=<n>          rows of batch n without a complete key

A batch writes its buckets under its own version and then the manifest; the
manifest's ``_SUCCESS`` marker commits both.  A batch that died before it left
the table as it was and is simply repeated; a batch whose manifest exists is
skipped.  Versions that neither the new nor the previous manifest names are
deleted after the commit.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
Merge = Callable[[DataFrame], DataFrame]


def latest_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Latest row per key by ``order`` (a max over a struct: partial-aggregated, skew-safe)."""
    payload = [c for c in rows.columns if c not in keys]
    m = F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                       F.struct(*payload).alias("_row"))).alias("_m")
    return rows.groupBy(*keys).agg(m).select(*keys, *[F.col(f"_m._row.{c}").alias(c) for c in payload])


def summed_per_key(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Additive merge: the sums per key over old and new rows."""
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


class _Folder:
    """The few folder operations the sink needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        path = self._path("")
        self._fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def numbers(self, name: str, prefix: str) -> list[int]:
        """The numbers of the sub-folders ``<prefix><number>``, ascending."""
        if not self.exists(name):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(name))]
        return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


def _committed(folder: _Folder) -> list[int]:
    return [n for n in folder.numbers("_manifest", "batch=") if folder.exists(f"_manifest/batch={n}/_SUCCESS")]


def _manifest(spark: SparkSession, target: str, batch_id: int) -> dict[int, int]:
    """Version of every bucket (at most as many rows as there are buckets)."""
    rows = spark.read.schema("bucket int, version long").parquet(f"{target}/_manifest/batch={batch_id}").collect()
    return {r.bucket: r.version for r in rows}


def _rows_at(spark: SparkSession, target: str, versions: dict[int, int], schema) -> DataFrame:
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{target}/v={v}/bucket={b}" for b, v in sorted(versions.items())])


def read_upserted(spark: SparkSession, target: str, schema) -> DataFrame:
    """The table as the last committed batch left it."""
    done = _committed(_Folder(spark, target))
    return _rows_at(spark, target, _manifest(spark, target, done[-1]) if done else {}, schema)


def read_rejected(spark: SparkSession, target: str, schema) -> DataFrame:
    """Rows that came without a complete key, of all committed batches."""
    folder = _Folder(spark, target)
    paths = [f"{target}/_rejected/batch={n}" for n in _committed(folder) if folder.exists(f"_rejected/batch={n}")]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert(batch: DataFrame, batch_id: int, target: str, keys: list[str], merge: Merge,
           buckets: int = BUCKETS) -> None:
    """Merge ``batch`` into the table at ``target`` (see module doc).

    ``merge`` reduces old and new rows together to one row per key.
    """
    spark, target = batch.sparkSession, target.rstrip("/")
    folder = _Folder(spark, target)
    done = _committed(folder)
    if batch_id in done:
        return
    earlier = [n for n in done if n < batch_id]
    if done and not earlier or any(n > batch_id for n in done):
        raise ValueError(f"batch {batch_id} comes after batch {done[-1]} was committed")
    before = _manifest(spark, target, earlier[-1]) if earlier else {}
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    batch = batch.persist()
    try:
        batch.where(keyless).write.mode("overwrite").parquet(f"{target}/_rejected/batch={batch_id}")
        rows = batch.where(~keyless)
        touched = [r[0] for r in rows.select(bucket).distinct().collect()]   # at most ``buckets`` values
        old = {b: before[b] for b in touched if b in before}
        merged = merge(rows.unionByName(_rows_at(spark, target, old, batch.schema)))
        (merged.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{target}/v={batch_id}"))
        after = before | dict.fromkeys(touched, batch_id)
        (spark.createDataFrame(sorted(after.items()), "bucket int, version long").coalesce(1)
         .write.mode("overwrite").parquet(f"{target}/_manifest/batch={batch_id}"))
    finally:
        batch.unpersist()
    used = set(after.values()) | set(before.values())
    for v in folder.numbers("", "v="):
        if v < batch_id and v not in used:
            folder.delete(f"v={v}")
    for n in earlier[:-1]:
        folder.delete(f"_manifest/batch={n}")


def run_available_now(writer, checkpoint: str) -> None:
    """Start a ``DataStreamWriter`` with ``trigger(availableNow=True)`` and wait.

    Processes every file present at start once (the checkpoint records
    which), then stops: the incremental, bookmark-style run of G2.
    """
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()


def fresh_dir(root: str, name: str) -> str:
    """A new, unique folder name under a shared root (never reused)."""
    import uuid
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
