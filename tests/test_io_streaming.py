"""Bronze CSV.gz round trip, catalog registration, and streaming sink idempotency."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from stratum.sources import bronze, catalog, sinks
from stratum.streaming.sinks import latest_per_key, read_rejected, read_upserted, upsert


def scratch():
    return tempfile.mkdtemp(prefix="stratum-test-", dir="/tmp")


def test_bronze_csv_gzip_round_trip_keeps_json_with_commas(spark, shop):
    path = os.path.join(scratch(), "core_customer")
    src = bronze.to_bronze(bronze.inserts_of(shop.customer_source), "customer")
    bronze.write_bronze_csv(src, path)
    assert any(f.endswith(".csv.gz") for f in os.listdir(path))
    back = bronze.name_columns(bronze.read_bronze_csv(spark, path, "customer"), "customer")
    assert back.count() == src.count()
    meta = back.select(F.get_json_object("metadata", "$.preferences.newsletter").alias("n"))
    assert meta.where(F.col("n").isNull()).count() == 0
    assert back.drop("seq").exceptAll(bronze.name_columns(src, "customer")).count() == 0


def test_catalog_register_and_select_by_pattern(spark, shop):
    root = scratch()
    db = catalog.layer_database("bronze", prefix="t" + os.path.basename(root).replace("-", "_"))
    for name in ("core_tenant", "core_order", "auth_user"):
        p = os.path.join(root, name)
        shop.tenant.limit(1).write.parquet(p)
        catalog.register_table(spark, db, name, p)
    assert catalog.select_tables(spark, db, ["core_*"]) == ["core_order", "core_tenant"]
    assert catalog.catalog_scan(spark, db, "core_tenant").count() == 1


def read_months(spark, path):
    return sorted((r.month, r.v) for r in spark.read.schema("v int, month string").parquet(path).collect())


def test_recompute_drops_partitions_that_are_gone(spark):
    path = os.path.join(scratch(), "gold")
    a = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "month string, v int")
    b = spark.createDataFrame([("2024-02", 20)], "month string, v int")
    sinks.write_parquet(a, path, partition_by=["month"], stamp=False)
    sinks.write_parquet(b, path, partition_by=["month"], stamp=False)
    assert read_months(spark, path) == [("2024-02", 20)]


def test_incremental_write_keeps_other_partitions(spark):
    path = os.path.join(scratch(), "gold")
    a = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "month string, v int")
    b = spark.createDataFrame([("2024-02", 20)], "month string, v int")
    sinks.write_parquet(a, path, partition_by=["month"], stamp=False)
    sinks.write_parquet(b, path, partition_by=["month"], stamp=False, incremental=True)
    assert read_months(spark, path) == [("2024-01", 1), ("2024-02", 20)]


ROWS = "op string, commit_ts timestamp_ntz, id string, status string, part string"


def changes(spark, day, rows):
    return spark.createDataFrame([(op, None, i, s, p) for op, i, s, p in rows], ROWS) \
        .withColumn("commit_ts", F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz"))


def merge(rows):
    return latest_per_key(rows, ["id"], [F.col("commit_ts")])


def state(spark, target):
    return sorted((r.id, r.op, r.status, r.part) for r in read_upserted(spark, target, ROWS).collect())


def test_upsert_replay_moves_and_deletes(spark):
    target = os.path.join(scratch(), "silver")
    b0 = changes(spark, 1, [("I", "a", "pending", "p1"), ("I", "b", "pending", "p2"), ("I", "c", "pending", None)])
    # a moves to another partition value, b is deleted by a row that has only its key
    b1 = changes(spark, 2, [("U", "a", "completed", "p2"), ("D", "b", None, None)])
    upsert(b0, 0, target, ["id"], merge)
    upsert(b1, 1, target, ["id"], merge)
    want = [("a", "U", "completed", "p2"), ("b", "D", None, None), ("c", "I", "pending", None)]
    assert state(spark, target) == want
    upsert(b1, 1, target, ["id"], merge)      # replays of committed batches change nothing
    upsert(b0, 0, target, ["id"], merge)
    assert state(spark, target) == want


def test_upsert_survives_a_crash_before_its_commit(spark):
    target = os.path.join(scratch(), "silver")
    upsert(changes(spark, 1, [("I", str(i), "pending", "p") for i in range(50)]), 0, target, ["id"], merge)
    b1 = changes(spark, 2, [("U", "7", "completed", "p")])
    upsert(b1, 1, target, ["id"], merge)
    # The crash: rows of batch 1 are written, in part, but its manifest is not.
    os.remove(os.path.join(target, "_manifest", "batch=1", "_SUCCESS"))
    for folder in glob.glob(os.path.join(target, "v=1", "bucket=*", "*.parquet")):
        os.remove(folder)
    assert len(state(spark, target)) == 50 and ("7", "I", "pending", "p") in state(spark, target)
    upsert(b1, 1, target, ["id"], merge)
    assert len(state(spark, target)) == 50 and ("7", "U", "completed", "p") in state(spark, target)


def test_upsert_rewrites_touched_buckets_only_and_keeps_keyless_rows(spark):
    target = os.path.join(scratch(), "silver")
    upsert(changes(spark, 1, [("I", str(i), "pending", "p") for i in range(200)]), 0, target, ["id"], merge, buckets=16)
    b1 = changes(spark, 2, [("U", "7", "completed", "p"), ("U", None, "lost", "p"), ("U", None, "lost", "p")])
    upsert(b1, 1, target, ["id"], merge, buckets=16)
    assert len(glob.glob(os.path.join(target, "v=1", "bucket=*"))) == 1
    assert len(state(spark, target)) == 200
    assert read_rejected(spark, target, ROWS).count() == 2
    b2 = changes(spark, 3, [("U", str(i), "done", "p") for i in range(200)])
    upsert(b2, 2, target, ["id"], merge, buckets=16)
    upsert(b2.where("id = '1'"), 3, target, ["id"], merge, buckets=16)
    assert sorted(f for f in os.listdir(target) if f.startswith("v=")) == ["v=2", "v=3"]
    assert {r[2] for r in state(spark, target)} == {"done"}


def test_catalog_updates_schema_and_partitions_in_place(spark):
    root = scratch()
    db = catalog.layer_database("silver", prefix="t" + os.path.basename(root).replace("-", "_"))
    path = os.path.join(root, "core_x")
    spark.createDataFrame([(1, "a")], "id int, p string").write.partitionBy("p").parquet(path)
    catalog.register_table(spark, db, "core_x", path, partitioned=True)
    spark.createDataFrame([(2, "new", "b")], "id int, extra string, p string").write.mode("append").partitionBy("p").parquet(path)
    catalog.register_table(spark, db, "core_x", path, partitioned=True)
    rows = sorted((r.id, r.extra, r.p) for r in catalog.catalog_scan(spark, db, "core_x").collect())
    assert rows == [(1, None, "a"), (2, "new", "b")]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_bronze_quarantine_loses_no_row(spark):
    path = os.path.join(scratch(), "bronze")
    os.makedirs(path)
    good = 'I,2024-01-01 00:00:00,i{n},1,2.00,0.00,2.00,2024-01-01 00:00:00,2024-01-01 00:00:00,o1,p1'
    lines = [good.format(n=1), good.format(n=2), "I,2024-01-01 00:00:00,short,1", good.format(n=3) + ",extra",
             good.format(n=4).replace("I,", "X,", 1), good.format(n="").replace(",i,", ",,", 1),
             good.format(n=6).replace("2024-01-01 00:00:00", "yesterday", 1)]
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    raw = bronze.read_bronze_csv(spark, path, "orderitem")
    kept, out = bronze.split_bronze(raw, "orderitem")
    assert sorted(r.id for r in kept.collect()) == ["i1", "i2"]
    assert sorted(r.fault for r in out.collect()) == sorted(
        ["malformed", "malformed", "unknown_op", "no_key", "no_commit_time"])
    assert [r.seq for r in kept.orderBy("seq").select("seq").collect()][0] is not None


def test_union_of_frames_with_different_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "q")], "x int, y string")
    assert sorted((r.x, r.y) for r in sinks.union_evolving([a, b]).collect()) == [(1, None), (2, "q")]
