"""Structured Streaming versions of ingestion and funnel jobs.

All jobs read files with an explicit schema (no inference), use a
checkpoint folder (each file is processed once: the "bookmark" of G2) and
can run continuously or as ``trigger(availableNow=True)`` back-fills.
Event-time operators convert the ``timestamp_ntz`` business time to
``timestamp`` (the type watermarks require) in the session time zone.
State is bounded by watermarks except where a job is explicitly run in
complete mode for a bounded back-fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.silver import SILVER_TYPES, _op_rank
from ..sources import bronze
from .runs import Keyed, RunStore, UpsertTable
from .sinks import latest_per_key, run_available_now, summed_per_key


# ---------------------------------------------------------------- G1 / G2
def read_change_stream(spark: SparkSession, path: str, entity: str, fmt: str = "csv",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """G1: stream of Bronze change files (CSV(.gz) positional, or Parquet named)."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        raw = (r.schema(bronze.bronze_schema(entity)).option("header", "false")
               .option("quote", '"').option("escape", '"')
               .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
               .csv(path))
        return bronze.name_columns(raw, entity)
    raise ValueError("named change streams are read with read_parquet_stream")


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def ingest_changes(stream: DataFrame, target: str, checkpoint: str) -> None:
    """G1 + G2: append every change row once into a Parquet Bronze table.

    Rewrites unsplittable gzip CSV into splittable Parquet once; the
    checkpoint makes a rerun pick up only new files.
    """
    run_available_now(stream.writeStream.format("parquet").option("path", target)
                      .outputMode("append"), checkpoint)


# ---------------------------------------------------------------- G3 / G4
WINDOW_KEYS = ["tenant_id", "event_type", "hour"]
FUNNEL = "tenant_id string, event_type string, hour timestamp_ntz, event_count bigint"


def _hourly(events: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", F.col("created_at").cast("timestamp")).cast("timestamp_ntz")
    return events.groupBy("tenant_id", "event_type", hour.alias("hour")).agg(F.count(F.lit(1)).alias("event_count"))


def funnel_counts(events: DataFrame, delay: str = "1 hour", window: str = "1 hour") -> DataFrame:
    """Per (tenant, event type, tumbling hour) event counts, watermarked on created_at.

    Rows whose window already closed (window end <= watermark) are dropped as
    late by Spark's stateful operator; ``run_funnel_with_late`` (G4) counts them.
    """
    ts = F.col("created_at").cast("timestamp")
    return (events.withColumn("_ts", ts).withWatermark("_ts", delay)
            .groupBy(F.window("_ts", window).alias("w"), "tenant_id", "event_type")
            .agg(F.count(F.lit(1)).alias("event_count"))
            .select("tenant_id", "event_type",
                    F.col("w.start").cast("timestamp_ntz").alias("hour"),
                    F.to_date(F.col("w.start").cast("timestamp_ntz")).alias("day"),
                    "event_count"))


def funnel_table(spark: SparkSession, target: str) -> UpsertTable:
    """The table of ``run_funnel_upsert``: the counts of a window as its last batch had them."""
    return UpsertTable(spark, target, f"{FUNNEL}, _batch bigint", WINDOW_KEYS,
                       lambda rows: latest_per_key(rows, WINDOW_KEYS, [F.col("_batch")]))


def run_funnel_upsert(counts: DataFrame, target: str, checkpoint: str) -> None:
    """Update mode + idempotent upsert: closed and open windows are both exact
    in the table; state is evicted by the watermark."""
    table = funnel_table(counts.sparkSession, target)

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch.withColumn("_batch", F.lit(batch_id).cast("bigint")), batch_id)
    run_available_now(counts.writeStream.outputMode("update").foreachBatch(sink), checkpoint)


def late_funnel_store(spark: SparkSession, target: str) -> RunStore:
    """The tables of ``run_funnel_with_late``, committed together: counts, and the clock
    (the latest event time of each batch; one row once merged)."""
    return RunStore(spark, target, {
        "counts": Keyed(FUNNEL, lambda rows: summed_per_key(rows, WINDOW_KEYS, ["event_count"])),
        "clock": Keyed("clock int, latest timestamp_ntz", lambda rows: rows.groupBy("clock").agg(
            F.max("latest").alias("latest")))})


def run_funnel_with_late(events: DataFrame, target: str, late: str, checkpoint: str, delay: str = "1 hour") -> None:
    """Counts that late events correct, and a side table of those events.

    Counts are additive, so each micro-batch is counted by itself and added to
    the table (a batch is committed once): an event counts whenever it
    arrives, and no state is kept.  Events whose hour had closed, by the latest
    time of earlier batches less ``delay``, are also written to ``late``.
    """
    store = late_funnel_store(events.sparkSession, target)

    def sink(batch: DataFrame, batch_id: int) -> None:
        last = store.last()
        if last is not None and batch_id <= last:
            return
        latest = store.read("clock").agg(F.max("latest").alias("latest")).first()["latest"]      # one value
        closed = F.lit(latest).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
        hour_ends = F.date_trunc("hour", F.col("created_at").cast("timestamp")).cast("timestamp_ntz") \
            + F.expr("INTERVAL 1 HOUR")
        batch = batch.persist()     # read for the late events, the counts and the clock
        try:
            batch.where(hour_ends <= closed).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
            store.write("counts", batch_id, _hourly(batch))
            store.write("clock", batch_id, batch.agg(F.max("created_at").alias("latest")).select(
                F.lit(0).alias("clock"), "latest"))
        finally:
            batch.unpersist()
        store.commit(batch_id, ["counts", "clock"])
    run_available_now(events.writeStream.outputMode("append").foreachBatch(sink), checkpoint)


# ---------------------------------------------------------------- G5
def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Gap-based sessions of identified customers with ``session_window``."""
    ts = F.col("created_at").cast("timestamp")
    return (events.where(F.col("customer_id").isNotNull())
            .withColumn("_ts", ts).withWatermark("_ts", delay)
            .groupBy("customer_id", F.session_window("_ts", gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .select("customer_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("session_end"), "event_count"))


def run_sessions(sess: DataFrame, target: str, checkpoint: str, output_mode: str = "append") -> None:
    """Append mode (production): a session is written once the watermark
    closes it, state stays bounded.  Complete mode (bounded back-fills):
    every batch rewrites the whole result, so open sessions are included."""
    if output_mode == "append":
        run_available_now(sess.writeStream.format("parquet").option("path", target)
                          .outputMode("append"), checkpoint)
        return

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(target)
    run_available_now(sess.writeStream.outputMode("complete").foreachBatch(sink), checkpoint)


# ---------------------------------------------------------------- G6
def dedup_changes(changes: DataFrame, delay: str, keys: tuple[str, ...] = ("id", "op", "commit_ts")) -> DataFrame:
    """Drop re-delivered change rows (same key) seen within the watermark delay."""
    return (changes.withColumn("_ts", F.col("commit_ts").cast("timestamp"))
            .withWatermark("_ts", delay)
            .dropDuplicatesWithinWatermark(list(keys))
            .drop("_ts"))


# ---------------------------------------------------------------- G7
def merge_order(changes_cols: list[str]) -> list[Column]:
    seq = F.col("seq") if "seq" in changes_cols else F.lit(0)
    return [F.col("commit_ts"), seq, _op_rank()]


def _without_old_tombstones(days: int):
    """Drop deleted rows whose delete is older than ``days`` before the table's last change."""
    def settle(rows: DataFrame) -> DataFrame:
        last = rows.agg(F.max("commit_ts").alias("t")).first()["t"]      # one value
        old = F.col("commit_ts") < F.lit(last).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
        return rows.where(~((F.col("op") == "D") & F.coalesce(old, F.lit(False))))
    return settle


def silver_table(spark: SparkSession, target: str, schema, key: str = "id",
                 tombstone_days: int | None = None) -> UpsertTable:
    """The table of ``run_silver_upsert``: the latest change of every key."""
    columns = [f.name for f in schema]
    return UpsertTable(spark, target, schema, [key], lambda rows: latest_per_key(rows, [key], merge_order(columns)),
                       None if tombstone_days is None else _without_old_tombstones(tombstone_days))


def run_silver_upsert(changes: DataFrame, target: str, checkpoint: str, key: str = "id",
                      tombstone_days: int | None = None) -> None:
    """Each micro-batch of changes is merged latest-wins into Silver.

    Latest rows are kept with their op, so a delete is a tombstone that a
    late, older update cannot resurrect; readers filter ``op <> 'D'``
    (``silver_view``).  A batch writes its own rows; runs are merged as they add up
    (``runs.RunStore``).  With ``tombstone_days``, tombstones older than that leave when all
    runs become one; changes that come later than that may then revive a key.
    """
    table = silver_table(changes.sparkSession, target, changes.schema, key, tombstone_days)
    run_available_now(changes.writeStream.outputMode("update").foreachBatch(table.upsert), checkpoint)


def silver_view(spark: SparkSession, target: str, entity: str, schema) -> DataFrame:
    """Current Silver rows of an upserted table: tombstones removed, typed."""
    rows = silver_table(spark, target, schema).read().where(F.col("op") != "D")
    return rows.select(*[F.col(c).try_cast(t).alias(c) for c, t in SILVER_TYPES[entity].items() if c in rows.columns])
